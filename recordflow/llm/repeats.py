"""Removal of long repeats: every byte of a string of ``LENGTH`` bytes that also starts anywhere else.

1. Every start of ``LENGTH`` bytes gets a key that its content alone decides: the least hash of its 200-byte
   substrings (winnowing).  Neighbouring starts with one key form a run; equal strings have equal keys,
   so only runs of one key can repeat each other.  About one run goes for a hundred bytes.
2. Runs are counted by key and content.  Where the same run is found twice or more, all its starts repeat; a run
   with its least substring at two places may repeat itself, and is compared like those of 3.
3. Different runs of one key repeat each other in part.  One run of each content is compared: the bytes of the runs of
   some keys are laid side by side, their Burrows-Wheeler transform is built, and common prefix lengths are derived
   breadth first by backward extension, in order of increasing value, up to ``LENGTH``.  What is left undecided at
   that bound are the intervals of suffixes that share ``LENGTH`` bytes; starts in an interval of two or
   more are repeats.
4. Keys with more than ``CROWD`` different runs are too many for one transform; each of their starts is
   counted by its own 128-bit hash instead, which spreads any crowd.
5. Covered bytes are cut and the rest is digested.

Texts without a run of interest are digested where they are read; a table of bits, as large for any input, tells them. Only
the other texts, runs, one short text for each different run, and two joins by document move; a document's repeats are bounded
by its own length.  Equality of runs (2) and starts (4) rests on 128 bits of hash.

Defined cases: a null text is empty, and a text under ``LENGTH`` bytes has no repeats; null ids are ids like any
other; rows equal in id and text are texts of their own and repeat each other; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, small_batches, written
from .passages import bits_of, held, sharing_texts

LENGTH, GRAM, CROWD = 400, 200, 256
#: Starts of a run at most; bytes hashed in one piece; bytes of one transform, about.
RUN, PIECE, BIN = 256, 1 << 18, 1 << 17


# --- runs ----------------------------------------------------------------------------------------------------


@lru_cache(2)
def _tables(seed: int):
    rng = np.random.default_rng(seed)
    letters = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    base = int(rng.integers(0, 1 << 62)) * 4 + 3
    n = PIECE + LENGTH + 1
    powers = lambda x: np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, x, np.uint64))), dtype=np.uint64)
    up, down = powers(base), powers(pow(base, -1, 1 << 64))
    return letters, up, down


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _prefix(b: np.ndarray, seed: int) -> np.ndarray:
    letters, up, _ = _tables(seed)
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(letters[b] * up[: len(b)], dtype=np.uint64)))


def _hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """Hashes of the strings [start, end) of one piece; equal strings have equal hashes anywhere."""
    return _mixed((prefix[end] - prefix[start]) * _tables(seed)[2][start])


def runs(data: bytes) -> tuple[np.ndarray, ...]:
    """(key, content, first start, number of starts, whether starts may repeat each other) of all runs of one text."""
    parts = []
    for at in range(0, max(len(data) - LENGTH + 1, 0), PIECE):
        b = np.frombuffer(data[at : at + PIECE + LENGTH - 1], np.uint8)
        p, n = _prefix(b, 1), len(b)
        starts = np.arange(n - GRAM + 1)
        grams = _hashes(p, starts, starts + GRAM, 1)
        least, size, width = grams, 1, LENGTH - GRAM + 1
        while size * 2 <= width:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        rest = width - size
        least = np.minimum(least[:-rest], least[rest:]) if rest else least
        first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        count = np.diff(np.append(first, len(least)))
        if (count > RUN).any():  # periodic text: long runs are cut at even distances from their start
            pieces = -(-count // RUN)
            step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            left = np.repeat(count, pieces) - step * RUN
            first, count = np.repeat(first, pieces) + step * RUN, np.minimum(left, RUN)
        # equal starts of one run have the least gram at two places, one of them at a start before the last
        passed = np.concatenate(([0], np.cumsum(grams[: len(least)] == least)))
        own = passed[first + count - 1] > passed[first]
        q = _prefix(b, 2)
        content = _hashes(q, first, first + count + LENGTH - 1, 2) ^ _mixed(count.astype(np.uint64))
        parts.append((least[first], content, first + at, count, own))
    if not parts:
        return tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, bool))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _identity(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data, 5) - (1 << 63)


def _find_runs(batches):
    for b in batches:
        index, th, found = [], [], []
        for i, t in enumerate(b.column(1).to_pylist()):
            data = _bytes(t)
            r = runs(data)
            if len(r[0]):
                index.append(np.full(len(r[0]), i))
                th.append(np.full(len(r[0]), _identity(data)))
                found.append(r)
        key, content, first, count, own = (np.concatenate(x) for x in zip(*found)) if found else runs(b"")
        rows = np.concatenate(index) if index else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                b.column(0).take(pa.array(rows)),
                pa.array(np.concatenate(th) if th else rows, pa.int64()),
                pa.array(key.view(np.int64)),
                pa.array(content.view(np.int64)),
                pa.array(first.astype(np.int32)),
                pa.array(count.astype(np.int32)),
                pa.array(own),
            ],
            ["doc_id", "th", "key", "content", "first", "count", "own"],
        )


# --- common prefixes from the Burrows-Wheeler transform --------------------------------------------------------


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order; the last symbols of the texts must differ from all other symbols.

    Ranks by the first symbols are doubled; a rank is the place of the first suffix that shares it, so that only suffixes
    that still share theirs are sorted again.
    """
    n = len(symbols)
    dense = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    step, key = 1, dense
    if n and dense.max() < (1 << 15) - 1:  # four symbols at once
        padded = np.concatenate((dense + 1, np.zeros(3, np.int64)))
        step, key = 4, (padded[:n] << 45) | (padded[1 : n + 1] << 30) | (padded[2 : n + 2] << 15) | padded[3:]
    order = np.argsort(key)
    fresh = np.concatenate(([True], key[order][1:] != key[order][:-1]))
    rank = np.empty(n, np.int64)
    slots = np.arange(n)
    while True:
        rank[order[slots]] = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(slots)), 0))]
        shared = ~(fresh & np.append(fresh[1:], True))
        slots = slots[shared]
        if not len(slots):
            return order
        own = order[slots]
        behind = own + step
        key = rank[own] * (n + 1) + np.where(behind < n, rank[np.minimum(behind, n - 1)] + 1, 0)
        by = np.argsort(key)
        order[slots] = own[by]
        key = key[by]
        fresh = np.concatenate(([True], key[1:] != key[:-1]))
        step *= 2


def shared_prefixes(symbols: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, interval of each): suffixes of one interval share ``least`` symbols or more.

    ``known`` marks rows whose common prefix with the row above is decided.  For rows p < q that follow each other
    among those with one symbol c in front, the suffixes with c prepended are neighbours, and share one symbol more than
    all rows between p and q do.  So once a row between them is decided at a length, their extension is
    decided at the next: breadth first, by increasing length.  A length starts from the rows of the one before: where
    q is the row after p, it alone decides, so its extension follows at once; the other pairs, which wait until one of the rows
    between is met, are few where texts are alike.
    """
    order = suffix_array(symbols)
    n = len(order)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    front = symbols[order - 1]  # the transform; the first suffix has the last symbol in front
    by_symbol = np.argsort(front, kind="stable")
    same = front[by_symbol][1:] == front[by_symbol][:-1]
    extension = place[order - 1]
    known = np.zeros(n, bool)
    known[0] = True
    firsts = by_symbol[np.concatenate(([True], ~same))]
    known[extension[firsts]] = True  # nothing in common with the row above: another first symbol
    q, p = by_symbol[1:][same], by_symbol[:-1][same]
    after = np.full(n, -1)
    close = q == p + 1
    after[q[close]] = extension[q[close]]
    q, p = q[~close], p[~close]
    now = np.flatnonzero(known)
    for _ in range(1, least):
        follow = after[now]
        if len(q) > n >> 4:
            met = np.zeros(n, np.int32)
            met[now] = 1
            met = np.cumsum(met)
            hit = met[q] > met[p]
        else:
            now = np.sort(now)
            hit = np.searchsorted(now, q, "right") > np.searchsorted(now, p, "right")
        now = np.concatenate((follow[follow >= 0], extension[q[hit]]))
        if not len(now):
            break
        known[now] = True
        q, p = q[~hit], p[~hit]
    return order, np.cumsum(known)


def repeated_starts(texts: list[bytes], counts: np.ndarray) -> list[np.ndarray]:
    """For each text the starts, of its first ``counts``, whose ``LENGTH`` bytes start elsewhere among these too."""
    sizes = np.array([len(t) + 1 for t in texts])
    ends = np.cumsum(sizes)
    symbols = np.frombuffer(b"".join(t + b"\0" for t in texts), np.uint8).astype(np.int64) + len(texts)
    symbols[ends - 1] = np.arange(len(texts))  # every text ends with a symbol of its own
    order, interval = shared_prefixes(symbols, LENGTH)
    text = np.repeat(np.arange(len(texts)), sizes)
    offset = np.arange(len(symbols)) - np.repeat(ends - sizes, sizes)
    own = offset[order] < np.asarray(counts)[text[order]]
    many = np.bincount(interval[own], minlength=interval[-1] + 1 if len(interval) else 0)
    hit = order[own][many[interval[own]] > 1]
    flags = np.zeros(len(symbols), bool)
    flags[hit] = True
    return [np.flatnonzero(flags[e - s : e]) for s, e in zip(sizes, ends)]


def _spans(starts: np.ndarray) -> list[tuple[int, int]]:
    """Covered [start, end) of sorted starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1) + 1
    return [(int(x[0]), int(x[-1]) + LENGTH) for x in np.split(starts, cut)]


def _compared(batches):
    """Runs sorted by key to spans of repeats; the runs of one key stay together, at most CROWD."""
    held, size, key, kind = [], 0, object(), None

    def solved():
        nonlocal held, size
        out = []
        flags = repeated_starts([x[3] for x in held], np.array([x[5] for x in held]))
        for (doc, th, _, _, first, _, n), starts in zip(held, flags):
            if n == 1:  # runs found twice are covered as a whole
                out += [(doc, th, first + s, first + e) for s, e in _spans(starts)]
        held, size = [], 0
        cols = list(zip(*out)) if out else [[]] * 4
        kinds = (kind, pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "th", "s", "e"])

    for b in batches:
        kind = b.schema.field(0).type
        for row in zip(*(b.column(i).to_pylist() for i in range(7))):
            if row[2] != key:
                if size >= BIN:
                    yield solved()
                key = row[2]
            elif held and held[-1][:3] == row[:3] and held[-1][4] == row[4]:
                continue  # rows equal in id and text bring one run
            held.append(row)
            size += len(row[3])
    if held:
        yield solved()


# --- documents -------------------------------------------------------------------------------------------------


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def cut(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """(rest, bytes removed, spans removed)."""
    gone, at, rest = _merged(spans), 0, []
    for s, e in gone:
        rest.append(data[at:s])
        at = e
    return b"".join([*rest, data[at:]]), sum(e - s for s, e in gone), len(gone)


RESULT = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def _result(doc, data: bytes, spans):
    rest, removed, n = cut(data, spans)
    return doc, len(data), removed, n, hashlib.sha256(rest).hexdigest()


def _crowded_starts(rows) -> tuple[list[tuple], dict[int, list[int]]]:
    """Starts of the crowded runs of a batch: one row for each content, and those found twice in the batch by document.

    A content found twice here is settled here; its one row only tells other batches of it.
    """
    parts = []
    for i, (_, _, _, data, _, open_) in enumerate(rows):
        for x in open_:
            if x["different"] > CROWD:
                f, c = x["first"], x["count"]
                piece, at = np.frombuffer(data[f : f + c + LENGTH - 1], np.uint8), np.arange(c)
                w = np.empty(c, [("w1", np.uint64), ("w2", np.uint64)])
                for name, seed in (("w1", 3), ("w2", 4)):
                    w[name] = _hashes(_prefix(piece, seed), at, at + LENGTH, seed)
                parts.append((np.full(c, i), at + f, w))
    if not parts:
        return [], {}
    doc, place, w = (np.concatenate(x) for x in zip(*parts))
    kinds, first, kind, n = np.unique(w, return_index=True, return_inverse=True, return_counts=True)
    repeated: dict[int, list[int]] = {}
    for j in np.flatnonzero(n[kind] > 1).tolist():
        repeated.setdefault(int(doc[j]), []).append(int(place[j]))
    columns = (doc[first], place[first], np.minimum(n, 2), kinds["w1"].view(np.int64), kinds["w2"].view(np.int64))
    return list(zip(*(c.tolist() for c in columns))), repeated


def _first_pass(batches):
    """Documents with their found runs: results where all is known, else the text and the runs to compare."""
    names = [*RESULT, "kind", "th", "text", "spans", "key", "bytes", "first", "count", "n", "w1", "w2"]
    longs, pair = pa.int64(), pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
    for b in batches:
        types = [b.schema.field(0).type, longs, longs, longs, pa.string(), pa.string(), longs, pa.string(), pair, longs, pa.binary(), longs, longs, longs, longs, longs]
        out, blank = [], (None,) * 4
        rows = []
        for doc, text, th, found in zip(*(b.column(i).to_pylist() for i in range(4))):
            data, found = _bytes(text), found or []
            spans = [(x["first"], x["first"] + x["count"] + LENGTH - 1) for x in found if x["n"] > 1]
            open_ = [x for x in found if (x["different"] > 1 or x["any_own"]) and x["mine"]]
            rows.append((doc, text, th, data, spans, open_))
        once, repeated = _crowded_starts(rows)
        told = set()
        for i, (doc, text, th, data, spans, open_) in enumerate(rows):
            spans += [(p, p + LENGTH) for p in repeated.get(i, ())]
            if not any(x["n"] == 1 for x in open_):
                out.append((*_result(doc, data, spans), "done", th, *(None,) * 9))
            else:
                held = [{"s": s, "e": e} for s, e in _merged(spans)]
                out.append((doc, *blank, "text", th, text, held, *(None,) * 7))
            for x in open_:
                f, c = x["first"], x["count"]
                if x["different"] <= CROWD and (th, doc, f) not in told:
                    told.add((th, doc, f))
                    piece = data[f : f + c + LENGTH - 1]
                    out.append((doc, *blank, "run", th, None, None, x["key"], piece, f, c, x["n"], None, None))
        for i, p, n, w1, w2 in once:
            doc, th = (rows[i][0], rows[i][2]) if n == 1 else (None, None)
            out.append((doc, *blank, "start", th, None, None, None, None, p, None, n, w1, w2))
        cols = list(zip(*out)) if out else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)


def _result_batch(out: list[tuple], kind):
    cols = list(zip(*out)) if out else [[]] * 6
    types = [kind, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], [*RESULT, "th"])


def _last_pass(batches):
    for b in batches:
        out = []
        for doc, text, th, spans, more in zip(*(b.column(i).to_pylist() for i in range(5))):
            all_ = [(x["s"], x["e"]) for x in [*spans, *(more or [])]]
            out.append((*_result(doc, _bytes(text), all_), th))
        yield _result_batch(out, b.schema.field(0).type)


def _plain(bits):
    """Documents whose identity is not among the bits: nothing of them repeats."""

    def rows(batches):
        for b in batches:
            data = [_bytes(t) for t in b.column(1).to_pylist()]
            th = np.array([_identity(x) for x in data], np.int64)
            left = np.flatnonzero(~held(bits.value, th)).tolist()
            docs = b.column(0).to_pylist()
            yield _result_batch([(*_result(docs[i], data[i], []), int(th[i])) for i in left], b.schema.field(0).type)

    return rows


def _identified(bits):
    """The other documents, with their identity."""

    def rows(batches):
        for b in batches:
            th = np.array([_identity(_bytes(t)) for t in b.column(1).to_pylist()], np.int64)
            hit = pa.array(np.flatnonzero(held(bits.value, th)))
            columns = [*b.columns, pa.array(th)]
            yield pa.RecordBatch.from_arrays([c.take(hit) for c in columns], ["doc_id", "text", "th"])

    return rows


def _joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """By document: id, null or not, and text."""
    r = right.select(F.col("doc_id").alias("__d"), F.col("th").alias("__t"), *[c for c in right.columns if c not in ("doc_id", "th")])
    on = F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("th") == F.col("__t"))
    return left.join(r, on, how).drop("__d", "__t")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return _without(docs, id_col, text).select(*RESULT)


def with_passages(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The same, and shares_passage: whether another row holds 51 words in a row of this one, however few bytes they are."""
    sharing = sharing_texts(docs.select(F.col(f"`{text}`").alias("text")), _identity)
    told = _without(docs, id_col, text).join(sharing.withColumn("shares_passage", F.lit(True)), "th", "left")
    return told.select(*RESULT, F.coalesce("shares_passage", F.lit(False)).alias("shares_passage"))


def _without(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    small_batches(docs.sparkSession)
    only = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = only.schema["doc_id"].dataType.simpleString()
    found = written(
        only.mapInArrow(_find_runs, f"doc_id {kind}, th long, key long, content long, first int, count int, own boolean"), "runs"
    )
    # one row a different run: how often, and which one stands for it
    each = found.groupBy("key", "content").agg(
        F.count("*").alias("n"), F.max("own").alias("own"), F.min(F.struct("doc_id", "th", "first")).alias("one")
    )
    each = written(each, "contents")
    keys = each.groupBy("key").agg(
        F.sum("n").alias("all"), F.count("*").alias("different"), F.max("own").alias("any_own")
    )
    keys = keys.where("all > 1 OR any_own").select("key", "different", "any_own")
    facts = each.drop("own").join(keys, "key")
    me = F.struct("doc_id", "th", "first")
    told = written(found.drop("own").join(facts, ["key", "content"]).select(
        "doc_id",
        "th",
        F.struct("key", "first", "count", "n", "different", "any_own", F.col("one").eqNullSafe(me).alias("mine")).alias("x"),
    ), "told")
    forget(found)
    forget(each)
    bits = docs.sparkSession.sparkContext.broadcast(bits_of(told, "th"))
    by_doc = told.groupBy("doc_id", "th").agg(F.collect_set("x").alias("found"))
    with_identity = only.mapInArrow(_identified(bits), f"doc_id {kind}, text string, th long")
    pairs = "array<struct<s:long,e:long>>"
    result = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, th long"
    first = written(
        _joined(with_identity, by_doc, "left").select("doc_id", "text", "th", "found").mapInArrow(
            _first_pass,
            f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kind string, th long,"
            f" text string, spans {pairs}, key long, bytes binary, first long, count long, n long, w1 long, w2 long",
        ),
        "first",
    )
    forget(told)
    pieces = first.where("kind = 'run'").select("doc_id", "th", "key", "bytes", "first", "count", "n")
    # a fixed number of tasks: small ones that are joined by their bytes would take long each
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    compared = pieces.repartition(tasks, "key").sortWithinPartitions("key", "doc_id", "th", "first").mapInArrow(
        _compared, f"doc_id {kind}, th long, s long, e long"
    )
    starts = first.where("kind = 'start'").select("doc_id", "th", "first", "w1", "w2", "n")
    crowded = starts.groupBy("w1", "w2").agg(F.sum("n").alias("k")).where("k > 1").drop("k")
    crowded = starts.where("n = 1").join(crowded, ["w1", "w2"]).select(
        "doc_id", "th", F.col("first").alias("s"), (F.col("first") + LENGTH).alias("e")
    )
    more = compared.unionByName(crowded).groupBy("doc_id", "th").agg(F.collect_set(F.struct("s", "e")).alias("more"))
    open_ = first.where("kind = 'text'").select("doc_id", "th", "text", "spans")
    rest = _joined(open_, more, "left").select("doc_id", "text", "th", "spans", "more").mapInArrow(_last_pass, result)
    plain = only.mapInArrow(_plain(bits), result)
    return plain.unionByName(first.where("kind = 'done'").select(*RESULT, "th")).unionByName(rest)
