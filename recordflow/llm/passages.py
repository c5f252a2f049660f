"""Documents that share a passage of over 50 words: ``WORDS`` words in a row that another row holds too.

Words are equal by their bytes; what stands between them is free.

1. Every window of ``WORDS`` words gets the least hash of its ``GRAM``-word strings as its key.  Neighbouring windows with one
   key form a run, about one for twenty words, and equal windows have equal keys.  Runs are dealt by key and compared with
   their neighbours in order: a run that two rows hold settles both.
2. A run whose key only different runs have may share a part of them.  Where its document is not settled by another run, all
   windows of that key are dealt and compared in the same way.  The keys are told by a table of ``BITS`` bits, so other windows may
   come along; they cost time and change nothing.

Each row brings a window once, so repeats within a document don't count.  Equality rests on 128 bits of hash: key and run, or
key and window.  No group is held: rows of one key pass in order, one batch at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, small_batches, written

WORDS, GRAM = 51, 16
#: Windows of a run at most; bytes hashed in one piece; bits of a table of keys (8 MB, whatever the input).
RUN, PIECE, BITS = 256, 1 << 20, 1 << 26

_rng = np.random.default_rng(7)
_LETTERS = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LETTERS[[32, 9, 10, 11, 12, 13]] = 0
_BASES = [int(x) * 4 + 3 for x in _rng.integers(0, 1 << 62, 3)]


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, base % (1 << 64), np.uint64))), dtype=np.uint64)


_UP, _FAR = _powers(_BASES[0], 1 << 16), pow(_BASES[0], 1 << 16, 1 << 64)
_IN_RUN = _powers(_BASES[1], RUN)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


# --- windows and runs ------------------------------------------------------------------------------------------


def words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every word."""
    b = np.frombuffer(data, np.uint8)
    inside = np.concatenate(([False], (b != 32) & ((b < 9) | (b > 13))))
    starts = np.flatnonzero(inside[1:] & ~inside[:-1])
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(int(np.searchsorted(starts, starts[at] + PIECE)), at + 1)
        end = starts[to] if to < len(starts) else len(b)
        own = starts[at:to]
        within = np.arange(starts[at], end) - np.repeat(own, np.diff(np.append(own, end)))
        value = _LETTERS[b[starts[at] : end]] * _UP[within & 0xFFFF]
        if within.max() >> 16:
            value *= _powers(_FAR, int(within.max() >> 16) + 1)[within >> 16]
        out[at:to] = np.add.reduceat(value, own - starts[at])
        at = to
    return starts, mixed(out)


def _rows_of(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the strings of ``GRAM`` and of ``WORDS`` words at each place that has so many behind it."""
    x, size, powers, base = h, 1, {1: h}, _BASES[2]
    up = lambda n: np.uint64(pow(base, n, 1 << 64))
    while size * 2 <= WORDS:
        x = x[:-size] * up(size) + x[size:]
        size *= 2
        powers[size] = x

    def of(n: int) -> np.ndarray:
        total, at, count = np.zeros(max(len(h) - n + 1, 0), np.uint64), 0, len(h) - n + 1
        for s in sorted(powers, reverse=True):
            if n - at >= s:
                total = total * up(s) + powers[s][at : at + count]
                at += s
        return mixed(total)

    return of(GRAM), of(WORDS)


def _least(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def runs(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text, key, first window, windows) of all runs, and the hashes of all windows of the texts laid end to end."""
    starts, h = words(b"\n".join(texts))
    if len(h) < WORDS:
        return (*(np.empty(0, t) for t in (np.int64, np.uint64, np.int64, np.int64)), np.empty(0, np.uint64))
    text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, "right")
    grams, windows = _rows_of(h)
    key = mixed(_least(grams, WORDS - GRAM + 1))  # least values are small ones; their low bits are wanted
    whole = text[: len(windows)] == text[WORDS - 1 :]
    first = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (text[1 : len(key)] != text[: len(key) - 1]) | (whole[1:] != whole[:-1]))))
    count = np.diff(np.append(first, len(key)))
    first, count = first[whole[first]], count[whole[first]]
    pieces = -(-count // RUN)
    step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    left = np.repeat(count, pieces) - step * RUN
    first, count = np.repeat(first, pieces) + step * RUN, np.minimum(left, RUN)
    return text[first], key[first], first, count, windows


def _each(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of runs one after another, and the place of each within its run."""
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(first, count) + within, within


def _once(text, key, content):
    """One row for each key and content: (text, key, content, whether two texts have it), and the texts that share one so."""
    order = np.lexsort((text, content, key))
    text, key, content = text[order], key[order], content[order]
    group = np.ones(len(text), bool)
    group[1:] = (key[1:] != key[:-1]) | (content[1:] != content[:-1])
    new = group.copy()
    new[1:] |= text[1:] != text[:-1]
    text, key, content, group = text[new], key[new], content[new], group[new]
    first = np.flatnonzero(group)
    many = np.diff(np.append(first, len(text))) > 1
    return text[first], key[first], content[first], many, np.unique(text[np.repeat(many, np.diff(np.append(first, len(text))))])


def _dealt(identity, bits=None):
    """Arrow batches of texts to (key, content, th, sure): runs, or the windows of the runs whose key is among the bits.

    What two texts of a batch share goes once, with its key; these texts go as sure ones, under their identity, which spreads them.
    """

    def rows(batches):
        for b in batches:
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in b.column(0).to_pylist()]
            text, key, first, count, windows = runs(texts)
            if bits is not None:
                hit = held(bits.value, key)
                text, key, first, count = (x[hit] for x in (text, key, first, count))
            content = np.empty(0, np.uint64)
            if len(first):
                at, within = _each(first, count)
                if bits is None:
                    content = mixed(np.add.reduceat(windows[at] * _IN_RUN[within], np.cumsum(count) - count) + count.astype(np.uint64))
                else:
                    text, key, content = np.repeat(text, count), np.repeat(key, count), windows[at]
            text, key, content, many, shared = _once(text, key, content)
            used = np.union1d(text, shared)
            th = np.zeros(len(texts), np.int64)
            th[used] = [identity(texts[i]) for i in used.tolist()]
            own = np.unique(th[shared])
            parts = ((key.view(np.int64), own), (content.view(np.int64), own), (th[text], own), (many, np.ones(len(own), bool)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in parts], ["key", "content", "th", "sure"])

    return rows


# --- comparison ------------------------------------------------------------------------------------------------


def _neighbours(batches):
    """Rows in order of key and content: (th, null) where sure or a neighbour is equal, (th, key) where one has the key only."""
    held_, before = None, False

    def told(rows: np.ndarray, last: bool):
        same = (rows[:, 1:] == rows[:, :-1])[:2]
        key = np.concatenate(([False], same[0], [False]))
        both = np.concatenate(([False], same.all(0), [False]))
        settled, near = both[1:] | both[:-1] | (rows[3] > 0), key[1:] | key[:-1]
        use = slice(int(before), None if last else -1)
        th, k, settled, near = rows[2][use], rows[0][use], settled[use], near[use]
        sure = np.unique(th[settled])
        some = near & ~settled
        keys = pa.array(np.concatenate((np.zeros(len(sure), np.int64), k[some])), mask=np.arange(len(sure) + some.sum()) < len(sure))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate((sure, th[some]))), keys], ["th", "key"])

    for b in batches:
        if not b.num_rows:
            continue
        rows = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)])
        if held_ is not None:
            rows = np.concatenate((held_, rows), axis=1)
        if rows.shape[1] > 1 + before:
            yield told(rows, False)
        held_, before = rows[:, -2:], rows.shape[1] > 1
    if held_ is not None:
        yield told(held_, True)


def bits_of(df: DataFrame, column: str, size: int = BITS) -> np.ndarray:
    """A table of ``size`` bits with those of the low ends of a column of hashes set; as large for any input."""
    at = F.col(column).bitwiseAND(F.lit(size - 1))
    rows = df.select(F.shiftright(at, 6).alias("i"), F.expr(f"shiftleft(1L, cast({column} & 63 AS int))").alias("bit"))
    got = rows.groupBy("i").agg(F.expr("bit_or(bit)").alias("bits")).toArrow()
    table = np.zeros(size >> 6, np.int64)
    table[got.column("i").to_numpy()] = got.column("bits").to_numpy()
    return table


def held(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    x = hashes.view(np.uint64)
    word = bits.view(np.uint64)[((x & np.uint64(len(bits) * 64 - 1)) >> np.uint64(6)).astype(np.int64)]
    return (word >> (x & np.uint64(63))) & np.uint64(1) != 0


def sharing_texts(texts: DataFrame, identity) -> DataFrame:
    """``th``, the identity of every text of the one column that shares a passage with another row."""
    spark = texts.sparkSession
    small_batches(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    compared = lambda bits=None: (
        texts.mapInArrow(_dealt(identity, bits), "key long, content long, th long, sure boolean")
        .repartition(tasks, "key", *(["content"] if bits else []))
        .sortWithinPartitions("key", "content")
        .mapInArrow(_neighbours, "th long, key long")
    )
    near = written(compared(), "passages")
    settled = near.where("key IS NULL").select("th").distinct()
    open_ = near.where("key IS NOT NULL").join(settled, "th", "left_anti")
    bits = spark.sparkContext.broadcast(bits_of(open_, "key"))
    more = compared(bits).where("key IS NULL").select("th")
    found = written(settled.union(more).distinct(), "sharing")
    forget(near)
    return found
