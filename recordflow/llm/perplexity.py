"""Quality classifier: interpolated modified Kneser-Ney model of bytes of trusted text, sharded joins, language quantiles.

The model counts strings of six bytes over all trusted texts (whole, no sample), five bytes of context and the byte after
them; its lower orders count in how many contexts a shorter string continues.  Texts begin with bytes that no UTF-8 holds, and
end with another.

1. Counts.  Every task sums the strings of its trusted texts, and sends them packed by shard.  A shard is a set of pairs of
   the last two bytes of a context, so that it holds everything that orders six to three of its strings need; order two and
   below come from at most 65536 numbers that are collected and broadcast.  The model is written, one row a shard and fold.
2. Requests.  Texts are dealt to chunks by their hash, compressed; a chunk sends each shard the distinct strings of its
   texts, sorted and packed.  There they meet the model, one packet at a time, and their log-probabilities go back to the chunk.
3. Scores.  The chunk joins the answers and sums them by text.  The texts are dealt once: both uses read one exchange.

A model remembers its texts.  So trusted texts are dealt into two folds by the hash of the text, each with counts of its
own, and every text, trusted or not, is scored by the fold that holds neither it nor its copies.  A document's perplexity, by
byte, is compared with quantiles of the trusted documents of its language; short texts get room in
proportion to the deviation of their mean.

What a task holds: the distinct strings of its chunk or of its shard's model, and one packet; chunks and shards grow in
number with the input.  Equal texts are one text in a chunk, and one a task on the way, so a large group of copies is no load.

Defined cases: a null or empty text has no perplexity and is rejected; a null language is a language of its own;
every language has cuts of its own at any number of trusted documents, and non-empty documents of a language without trusted
text are kept; null ids are never trusted; repeated ids are trusted if any of their labels
is good and none is bad; without trusted text every byte is as likely as any other; an empty table gives an empty result;
extra columns are ignored by ``classified`` and kept, whatever their names, by ``kept_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written

ORDER = 6
#: No UTF-8 holds these two bytes.
EDGE, STOP = b"\xff" * (ORDER - 1), b"\xfe"
#: What may follow a context: all bytes but that of the edge.
SYMBOLS = 255
#: Bytes of text whose strings are made together; bytes of a chunk's texts; distinct strings a task holds before it sends them;
#: bytes of text that are looked up at once, as each look-up makes a table of a chunk's distinct strings.
PIECE, CHUNK, HELD, LOOK = 2 << 20, 16 << 20, 4 << 20, 8 << 20
#: Bytes of trusted text to a shard of the model, and shards at least and at most.
SHARD_TEXT, SHARDS = 8 << 20, (64, 16_384)


@dataclass(frozen=True)
class Limits:
    low: float = 0.001
    high: float = 0.995
    #: Room in nats for a text of one byte; it shrinks with the root of the length.
    slack: float = 3.0
    #: Trusted documents at which a language's own quantiles weigh as much as those of all.
    shrink: float = 100.0
    #: Deviations of room for a median of one document; it shrinks with the root of their number.
    deviations: float = 2.0
    #: Ids that may be broadcast; more are joined.
    most_broadcast: int = 1_000_000


# --- strings of six bytes --------------------------------------------------------------------------------------


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The strings of all texts as numbers, and the number of strings of each text (its bytes and its end)."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    raw = b"".join(x for t in texts for x in (EDGE, t, STOP)) + b"\0\0"
    n = len(raw) - 7
    found = np.ndarray((n,), ">u8", raw, 0, (1,)).astype(np.uint64) >> np.uint64(16)
    ends = np.cumsum(sizes + ORDER - 1)[:-1]  # strings that reach into the next text
    across = np.ones(n, bool)
    across[(ends[:, None] - np.arange(1, ORDER)).ravel()] = False
    return found[across], sizes


def _dealt(k: np.ndarray, shards: int) -> np.ndarray:
    """Keys in the order of shards: shard, pair (the last two bytes of the context), the other bytes."""
    pair = (k >> np.uint64(8)) & np.uint64(0xFFFF)
    shard = ((np.arange(65536, dtype=np.uint64) * np.uint64(0x9E3779B1)) >> np.uint64(8)) % np.uint64(shards)
    low = ((k >> np.uint64(24)) << np.uint64(8)) | (k & np.uint64(0xFF))
    return (shard[pair.astype(np.int64)] << np.uint64(48)) | (pair << np.uint64(32)) | low


def _natural(key: np.ndarray) -> np.ndarray:
    """Keys of ``_dealt``, with or without their shard, as strings again."""
    pair, low = (key >> np.uint64(32)) & np.uint64(0xFFFF), key & np.uint64(0xFFFFFFFF)
    return ((low >> np.uint64(8)) << np.uint64(24)) | (pair << np.uint64(8)) | (low & np.uint64(0xFF))


def _pieces(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Texts in lists of about PIECE bytes; a longer text is a list of its own."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t) + ORDER
        if size >= PIECE:
            yield held
            held, size = [], 0
    if held:
        yield held


def _counted(k: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Different strings in the order of shards, and their counts."""
    found = pc.value_counts(pa.array(k))
    keys, n = _dealt(found.field(0).to_numpy(), shards), found.field(1).to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order]


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    keys, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")  # sorted parts merge
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def _pack(a: np.ndarray) -> bytes:
    """Numbers of 4 or 8 bytes by planes: like bytes lie together."""
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(blob: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _pack_keys(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_keys(blob: bytes) -> np.ndarray:
    return np.cumsum(_unpack(blob, np.uint64), dtype=np.uint64)


def _by_shard(keys: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The shards of sorted keys, each with its slice."""
    shard = (keys >> np.uint64(48)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1]))) if len(keys) else np.empty(0, np.int64)
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(keys)]):
        yield int(shard[a]), slice(a, b)


_BARE = np.uint64((1 << 48) - 1)


# --- counts of trusted texts -----------------------------------------------------------------------------------


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids labelled good and never bad or toxic."""
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    votes = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.coalesce(good, F.lit(False))).alias("good"))
    return votes.where("good").select("doc_id")


def fold_of(text: str = "text") -> Column:
    """The fold of a text; equal texts share it, whatever their ids."""
    return F.pmod(F.xxhash64(F.col(f"`{text}`")), F.lit(2)).cast("int")


_COUNTS = "shard int, fold int, keys binary, n binary"


def _count(shards: int):
    """(text, fold) to packets of counts."""

    def sent(fold, parts):
        keys, n = _summed(parts)
        out = [(s, fold, _pack_keys(keys[x] & _BARE), _pack(n[x])) for s, x in _by_shard(keys)]
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["shard", "fold", "keys", "n"])

    def run(batches):
        held: list[list] = [[], []]
        for b in batches:
            folds = b.column(1).to_numpy(zero_copy_only=False)
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in b.column(0).to_pylist()]
            for fold in (0, 1):
                for piece in _pieces([t for t, f in zip(texts, folds) if f == fold and t]):
                    held[fold].append(_counted(grams(piece)[0], shards))
                    if sum(len(k) for k, _ in held[fold]) >= HELD:
                        held[fold] = [_summed(held[fold])]
                        if len(held[fold][0][0]) >= HELD // 2:
                            yield sent(fold, held[fold])
                            held[fold] = []
        for fold in (0, 1):
            if held[fold]:
                yield sent(fold, held[fold])

    return run


def continuations(k: np.ndarray, n: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Strings and counts of orders six to three: below the top, how many different bytes stand before a string."""
    order = np.argsort(k)
    out = {ORDER: (k[order], n[order])}
    for j in range(ORDER - 1, 2, -1):
        shorter = out[j + 1][0] & np.uint64((1 << 8 * j) - 1)
        out[j] = np.unique(shorter, return_counts=True)
    return out


def _merge(batches):
    """Sorted packets to the model's rows (kind 0), and what the orders' discounts and order two need of a shard (kind 1)."""
    names = ["kind", "shard", "fold", "keys", "n", "order", "code", "many"]
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int64())
    at, parts = None, []

    def done():
        shard, fold = at
        keys, n = _summed(parts)
        facts = []
        orders = continuations(_natural(keys), n)
        for j, (_, c) in orders.items():
            code, many = np.unique(c[c <= 4], return_counts=True)
            facts += [(j, int(x), int(y)) for x, y in zip(code, many)]
        code, many = np.unique(orders[3][0] & np.uint64(0xFFFF), return_counts=True)
        facts += [(2, int(x), int(y)) for x, y in zip(code, many)]
        out = [(0, shard, fold, _pack_keys(keys), _pack(n), None, None, None)]
        out += [(1, shard, fold, None, None, *x) for x in facts]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    for b in batches:
        for shard, fold, keys, n in zip(*(b.column(i).to_pylist() for i in range(4))):
            if at != (shard, fold):
                if parts:
                    yield done()
                at, parts = (shard, fold), []
            parts.append((_unpack_keys(keys), _unpack(n, np.int64)))
            if sum(len(k) for k, _ in parts[1:]) > len(parts[0][0]) + PIECE:
                parts = [_summed(parts)]
    if parts:
        yield done()


def counts(docs: DataFrame, ids: DataFrame, limits: Limits, shards: int) -> DataFrame:
    """The written counts of the trusted documents' whole texts, rows of ``_merge``."""
    small_batches(docs.sparkSession)
    side = F.broadcast(ids) if ids.count() <= limits.most_broadcast else ids
    texts = docs.join(side, "doc_id", "left_semi").select("text", fold_of().alias("fold"))
    sent = texts.mapInArrow(_count(shards), _COUNTS).repartition(shards, "shard").sortWithinPartitions("shard", "fold")
    rows = "kind int, shard int, fold int, keys binary, n binary, order int, code int, many long"
    return written(sent.mapInArrow(_merge, rows), "model")


# --- probabilities ---------------------------------------------------------------------------------------------


def discounts(n: dict[int, int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and more, from how many strings have the counts 1 to 4; never nothing."""
    n1, n2, n3, n4 = (n.get(i, 0) for i in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    d = (1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(x, 0.1), i - 0.1) for i, x in zip((1, 2, 3), d))


def _off(n: np.ndarray, d: tuple) -> np.ndarray:
    return np.array((0.0, *d))[np.minimum(n, 3)]


@dataclass
class Lower:
    """Of one fold: discounts by order, and p(byte | byte before) for all 65536 pairs."""

    off: dict[int, tuple[float, float, float]]
    two: np.ndarray


def lower_orders(facts: list[tuple[int, int, int]]) -> Lower:
    """From (order, code, how many): counts of counts for orders above two, continuation counts of order two."""
    off = {j: discounts({c: m for o, c, m in facts if o == j}) for j in range(3, ORDER + 1)}
    pairs = np.zeros((256, 256), np.int64)
    for o, c, m in facts:
        if o == 2:
            pairs[c >> 8, c & 255] = m
    ones = (pairs > 0).sum(0)

    def smooth(n: np.ndarray, below: np.ndarray) -> np.ndarray:
        d = discounts({i: int((n == i).sum()) for i in (1, 2, 3, 4)})
        total = n.sum(-1, keepdims=True)
        p = (n - _off(n, d) + _off(n, d).sum(-1, keepdims=True) * below) / np.maximum(total, 1)
        return np.where(total > 0, p, below)

    level = np.full(256, 1 / SYMBOLS)
    level[EDGE[0]] = 0
    return Lower(off, smooth(pairs, smooth(ones, level)).ravel())


class Shard:
    """The part of a fold's model that its strings need."""

    def __init__(self, k: np.ndarray, n: np.ndarray, lower: Lower):
        self.two, self.orders = lower.two, []
        for j, (code, c) in sorted(continuations(k, n).items()):
            off = _off(c, lower.off[j])
            ctx = code >> np.uint64(8)
            first = np.flatnonzero(np.concatenate(([True], ctx[1:] != ctx[:-1]))) if len(ctx) else np.empty(0, np.int64)
            total = np.add.reduceat(c, first) if len(first) else c
            size = np.diff(np.append(first, len(ctx)))
            weight = (np.add.reduceat(off, first) if len(first) else off) / total
            self.orders.append((j, code, (c - off) / np.repeat(total, size), ctx[first], weight))

    def logp(self, k: np.ndarray) -> np.ndarray:
        """Log-probability of each string's last byte after its others."""
        p = self.two[(k & np.uint64(0xFFFF)).astype(np.int64)]
        for j, code, keep, ctx, weight in self.orders:
            if not len(code):
                continue
            c = k & np.uint64((1 << 8 * j) - 1)
            i = np.minimum(np.searchsorted(ctx, c >> np.uint64(8)), len(ctx) - 1)
            met = ctx[i] == c >> np.uint64(8)
            at = np.minimum(np.searchsorted(code, c), len(code) - 1)
            p = np.where(met, np.where(code[at] == c, keep[at], 0.0) + weight[i] * p, p)
        return np.log(p)


# --- texts -----------------------------------------------------------------------------------------------------


def _bundled(chunks: int):
    """(text, hash) to compressed bundles of texts by chunk; equal texts of a task go once a bundle."""

    def bundles(held):
        by: dict[int, list] = {}
        for i, t in held.items():
            by.setdefault(i % chunks, []).append((i, t))
        for c, own in sorted(by.items()):
            ids, texts = zip(*own)
            sizes = np.array([len(t) for t in texts], np.int64)
            head = np.int64(len(ids)).tobytes() + np.array(ids, np.int64).tobytes() + sizes.tobytes()
            yield c, zstandard.ZstdCompressor(level=3).compress(head + b"".join(texts))

    def sent(held):
        out = list(bundles(held))
        for i in range(0, len(out), 64):
            chunk, blob = zip(*out[i : i + 64])
            yield pa.RecordBatch.from_arrays([pa.array(chunk, pa.int32()), pa.array(blob, pa.binary())], ["chunk", "blob"])

    def run(batches):
        held, size = {}, 0
        for b in batches:
            for t, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if i not in held:
                    held[i] = t.encode("utf-8", "surrogatepass")
                    size += len(held[i])
            if size >= CHUNK:
                yield from sent(held)
                held, size = {}, 0
        yield from sent(held)

    return run


def _opened(blob: bytes) -> tuple[np.ndarray, list[bytes]]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    ids, sizes = np.frombuffer(data, np.int64, n, 8), np.frombuffer(data, np.int64, n, 8 + 8 * n)
    ends = 8 + 16 * n + np.cumsum(sizes)
    return ids, [data[e - s : e] for e, s in zip(ends.tolist(), sizes.tolist())]


_ASKED = ["shard", "kind", "chunk", "keys", "n"]
_ASKED_KINDS = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())


def _requests(shards: int):
    """Bundles sorted by chunk to packets: the distinct strings of a chunk, by shard."""

    def sent(chunk, held):
        keys = np.sort(_dealt(pc.unique(pa.chunked_array(held)).to_numpy(), shards))
        out = [(s, 2, chunk, _pack_keys(keys[x] & _BARE), None) for s, x in _by_shard(keys)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), _ASKED_KINDS)], _ASKED)

    def run(batches):
        at, held, seen = None, [], set()
        for b in batches:
            for chunk, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if chunk != at:
                    if held:
                        yield sent(at, held)
                    at, held, seen = chunk, [], set()
                ids, texts = _opened(blob)
                for piece in _pieces([t for i, t in zip(ids.tolist(), texts) if i not in seen]):
                    held.append(pc.unique(pa.array(grams(piece)[0])))
                    if sum(map(len, held[1:])) >= HELD:
                        held = [pc.unique(pa.chunked_array(held))]
                seen.update(ids.tolist())
        if held:
            yield sent(at, held)

    return run


def _answers(lower):
    """Sorted packets of a shard, the model's rows first, to (chunk, keys, log-probabilities).

    A chunk is judged by the model of the other fold, which has seen neither its texts nor copies of them.
    """
    none = np.empty(0, np.uint64), np.empty(0, np.int64)

    def run(batches):
        at, models = None, {}
        for b in batches:
            out = []
            for shard, kind, chunk, keys, n in zip(*(b.column(i).to_pylist() for i in range(5))):
                if shard != at:
                    at, models = shard, {}
                if kind < 2:
                    models[kind] = Shard(_natural(_unpack_keys(keys)), _unpack(n, np.int64), lower.value[kind])
                    continue
                fold = 1 - chunk % 2
                if fold not in models:
                    models[fold] = Shard(*none, lower.value[fold])
                asked = _unpack_keys(keys)
                p = models[fold].logp(_natural(asked)).astype(np.float32)
                out.append((chunk, _pack_keys(_natural(asked)), _pack(p)))
            cols = list(zip(*out)) if out else [[]] * 3
            kinds = (pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["chunk", "keys", "logp"])

    return run


def _sums(texts: pa.Table, answers: pa.Table) -> pa.Table:
    """The texts of a chunk and the answers to its strings: (text, logp) of each different text."""
    keys = np.concatenate([_unpack_keys(x) for x in answers.column("keys").to_pylist()])
    logp = np.concatenate([_unpack(x, np.float32) for x in answers.column("logp").to_pylist()]).astype(np.float64)
    known, seen, held, size = pa.array(keys), {}, {}, 0

    def solved():
        at = iter(held)
        k, sizes = zip(*map(grams, _pieces(list(held.values()))))
        # the result comes in chunks of its own
        found = pc.index_in(pa.chunked_array([pa.array(x) for x in k]), known).to_numpy()
        ends = np.cumsum([len(x) for x in k])
        for i, n in zip(np.split(found, ends[:-1]), sizes):
            for x in np.add.reduceat(logp[i], np.cumsum(n) - n).tolist():
                seen[next(at)] = x
        if next(at, None) is not None:
            raise ValueError("a text was not scored")

    # a bundle is small: many of them are looked up at once
    for blob in texts.column("blob").to_pylist():
        for i, t in zip(*(x if isinstance(x, list) else x.tolist() for x in _opened(blob))):
            if i not in seen and i not in held:
                held[i] = t
                size += len(t)
        if size >= LOOK:
            solved()
            held, size = {}, 0
    if held:
        solved()
    return pa.table({"text": pa.array(list(seen), pa.int64()), "logp": pa.array(list(seen.values()), pa.float64())})


def text_scores(docs: DataFrame, model: DataFrame, shards: int, size: int) -> DataFrame:
    """(text hash, log-probability of the text) of all texts, of ``size`` bytes together."""
    spark = docs.sparkSession
    small_batches(spark)
    facts = model.where("kind = 1").groupBy("fold", "order", "code").agg(F.sum("many").alias("many")).collect()
    lower = [lower_orders([(r["order"], r["code"], r["many"]) for r in facts if r["fold"] == f]) for f in (0, 1)]
    lower = spark.sparkContext.broadcast(lower)  # two tables of 65536 numbers
    chunks = 2 * -(-max(size, 1) // (2 * CHUNK))  # even: the fold of a chunk is that of its texts
    texts = docs.where("text <> ''").select("text", F.xxhash64("text").alias("hash"))
    dealt = texts.mapInArrow(_bundled(chunks), "chunk int, blob binary").repartition(chunks, "chunk")
    row = "shard int, kind int, chunk int, keys binary, n binary"
    asked = dealt.sortWithinPartitions("chunk").mapInArrow(_requests(shards), row)
    held = model.where("kind = 0").select("shard", F.col("fold").alias("kind"), F.lit(-1).alias("chunk"), "keys", "n")
    met = held.unionByName(asked).repartition(shards, "shard").sortWithinPartitions("shard", "kind")
    found = met.mapInArrow(_answers(lower), "chunk int, keys binary, logp binary")
    return dealt.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(_sums, "text long, logp double")


def _scored(docs: DataFrame, scores: DataFrame, *more: Column) -> DataFrame:
    """(doc_id, lang, n, nll, more): bytes and end, and mean negative log-probability of one, null without text."""
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    n = F.when(size > 0, size + 1).otherwise(0).cast("long").alias("n")
    only = docs.select("doc_id", "lang", n, F.xxhash64("text").alias("hash"), *more)
    met = only.join(scores.withColumnRenamed("text", "hash"), "hash", "left").drop("hash")
    return met.withColumn("nll", F.when(F.col("n") > 0, -F.col("logp") / F.col("n"))).drop("logp")


def language_cuts(good: DataFrame, limits: Limits) -> DataFrame:
    """(__lang, __low, __high) from the trusted documents' lang, __nll and __room, at any number of them.

    A cut is the language's own median and a distance from it.  The distance is that of the own quantile, shrunk towards
    the quantile of all documents' distances from their languages' medians by n / (n + shrink); the median of n documents has
    room by the deviation of all over sqrt(n).  So no language is ever measured by the level of another.  Quantiles are
    taken without the room that short texts get, as a short text's stray would else be everyone's room.
    """
    middle = written(good.groupBy("lang").agg(F.percentile_approx("__nll", 0.5, 10_000).alias("__mid"), F.count("*").alias("__count")), "middles")
    away = good.join(middle.withColumnRenamed("lang", "__lang"), F.col("lang").eqNullSafe(F.col("__lang")))
    away = away.select("__lang", "__mid", "__count", (F.col("__nll") - F.col("__mid")).alias("x"), "__room")
    # within its room a document is where the median is
    below = F.percentile_approx(F.least(F.col("x") + F.col("__room"), F.lit(0.0)), limits.low, 10_000)
    above = F.percentile_approx(F.greatest(F.col("x") - F.col("__room"), F.lit(0.0)), limits.high, 10_000)
    every = away.agg(below.alias("below"), above.alias("above"), F.sqrt(F.avg(F.col("x") * F.col("x"))).alias("spread")).first()
    share = F.col("__count") / (F.col("__count") + limits.shrink)
    room = F.lit(every["spread"]) * limits.deviations / F.sqrt("__count")
    shrunk = lambda own, all_: share * F.col(own) + (1 - share) * F.lit(all_)
    return away.groupBy("__lang", "__mid", "__count").agg(below.alias("below"), above.alias("above")).select(
        "__lang",
        (F.col("__mid") + shrunk("below", every["below"]) - room).alias("__low"),
        (F.col("__mid") + shrunk("above", every["above"]) + room).alias("__high"),
    )


def _judged(docs: DataFrame, labels: DataFrame, limits: Limits, *more: Column) -> DataFrame:
    """``_scored`` with low and high of the language, and kept."""
    ids = written(trusted_ids(labels), "trusted")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = int(min(max(size // SHARD_TEXT, SHARDS[0]), SHARDS[1]))
    model = counts(docs, ids, limits, shards)
    by_text = written(text_scores(docs, model, shards, size), "texts")
    # the mean of n bytes strays by about 1 / sqrt(n)
    room = F.lit(limits.slack) / F.sqrt(F.greatest("n", F.lit(1)))
    good = _scored(docs, by_text).where("nll IS NOT NULL").join(ids, "doc_id", "left_semi")
    good = good.select("lang", F.col("nll").alias("__nll"), room.alias("__room"))
    # one row a language: written, so that the planner sees its size before it picks the join
    own = written(language_cuts(good, limits), "cuts")
    met = _scored(docs, by_text, *more).join(own, F.col("lang").eqNullSafe(F.col("__lang")), "left")
    low, high = F.coalesce("__low", F.lit(float("-inf"))), F.coalesce("__high", F.lit(float("inf")))
    kept = F.coalesce(F.col("nll").between(low - room, high + room), F.lit(False))
    return met.withColumns({"low": low, "high": high, "kept": kept})


def classified(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row a document: doc_id, lang, n_symbols (bytes and the end), perplexity, low, high (of its language), kept."""
    return _judged(docs, labels, limits).select(
        "doc_id",
        "lang",
        F.col("n").alias("n_symbols"),
        F.exp("nll").alias("perplexity"),
        F.exp("low").alias("low"),
        F.exp("high").alias("high"),
        "kept",
    )


def kept_documents(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows and columns of ``docs`` that the classifier keeps."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return _judged(docs, labels, limits, row).where("kept").select("row.*")
