"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint has 64 majority bits over the XXH64 hashes of a text's 3-word shingles.  Distinct fingerprints at
``LIMIT`` or fewer differing bits are linked, all of them:

1. Bits are grouped into four partitions of 16, correlated bits together, from the bit counts of all fingerprints.
2. Each partition i gets a threshold t_i >= -1 with sum(t_i) = LIMIT - 4 + 1: two fingerprints within LIMIT
   bits then differ in at most t_i bits of some partition i with t_i >= 0.  A dynamic program picks the thresholds
   with the least estimated candidate count; the estimates come from complete histograms of the
   partitions (at most 4 * 65536 counts, whatever the input).
3. A fingerprint probes a partition under the keys that blank every set of t_i of its bits, and candidates that
   share a key are verified on all 64 bits.  Crowded keys are dealt out as pairs of blocks of bounded size, so
   no task holds more than two blocks of one key.  From each block pair only a spanning forest of its links is
   emitted, so dense groups give no quadratic output while their components stay whole.
4. Components of the links join the documents by fingerprint.

Defined cases: a null or empty text, and one without words, has fingerprint 0 and is linked like any other; a text of
one or two words has one shingle; repeated rows share a fingerprint and stay rows of their own; a null id is
never a component id unless all ids of the component are null; an empty table gives an empty result; extra
columns are ignored by ``near_duplicates`` and kept by ``representatives``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written
from .graph import components

BITS, PARTS, WIDTH, LIMIT, SHINGLE, SEED = 64, 4, 16, 3, 3, 42
#: Fingerprints of one key that are compared in one piece, about.
BLOCK = 2048


# --- fingerprints ------------------------------------------------------------------------------------------


def fingerprint(text: str | None) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII letters and ASCII space only
    if not words:
        return 0
    whole = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - SHINGLE + 1)
    starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
    stops = ends[SHINGLE - 1 :].tolist() if len(words) >= SHINGLE else [len(whole)]
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(BITS, np.int64)
    for i in range(0, n, 65536):
        h = np.array([digest(whole[a:b], SEED) for a, b in zip(starts[i : i + 65536], stops[i : i + 65536])], ">u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n).view(">u8")[0])


def _fingerprints(batches):
    for b in batches:
        values = np.array([fingerprint(t) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(values)], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long."""
    small_batches(docs.sparkSession)
    only = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = only.schema["doc_id"].dataType.simpleString()
    return only.mapInArrow(_fingerprints, f"doc_id {kind}, fp long")


# --- partitions and thresholds -----------------------------------------------------------------------------


def _pair_counts(batches):
    total = np.zeros((BITS, BITS))
    for b in batches:
        x = b.column(0).to_numpy(zero_copy_only=False).astype(">u8").view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(x, axis=1).astype(np.float32)
        total += bits.T @ bits
    i, j = np.indices(total.shape)
    yield pa.RecordBatch.from_arrays(
        [pa.array(a.ravel().astype(np.int64)) for a in (i, j, total)], ["i", "j", "n"]
    )


def bit_groups(distinct: DataFrame, n: int) -> list[list[int]]:
    """Four groups of 16 bits (0 is the highest): each is grown from a free bit by the most correlated ones."""
    rows = distinct.select("fp").mapInArrow(_pair_counts, "i long, j long, n long").groupBy("i", "j").sum("n").collect()
    both = np.zeros((BITS, BITS))
    for i, j, k in rows:
        both[i, j] = k
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.outer(p * (1 - p), p * (1 - p)))
    correlation = np.abs(np.divide(both / max(n, 1) - np.outer(p, p), spread, out=np.zeros_like(both), where=spread > 0))
    np.fill_diagonal(correlation, 0)
    free, groups = list(range(BITS)), []
    while free:
        first = max(free, key=lambda b: (round(correlation[b, free].max(), 6), -b)) if len(free) > 1 else free[0]
        group = [first]
        free.remove(first)
        while len(group) < WIDTH:
            best = max(free, key=lambda b: (round(correlation[b, group].sum(), 6), -b))
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def part_values(fp: np.ndarray, group: list[int]) -> np.ndarray:
    """The bits of ``group`` as numbers below 65536."""
    out = np.zeros(len(fp), np.uint32)
    for b in group:
        out = (out << np.uint32(1)) | ((fp >> np.uint64(BITS - 1 - b)) & np.uint64(1)).astype(np.uint32)
    return out


def _histograms(groups):
    def run(batches):
        counts = np.zeros((PARTS, 1 << WIDTH), np.int64)
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for k, g in enumerate(groups):
                counts[k] += np.bincount(part_values(fp, g), minlength=1 << WIDTH)
        k, v = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(k.astype(np.int32)), pa.array(v.astype(np.int32)), pa.array(counts[k, v])], ["part", "value", "n"]
        )

    return run


def histograms(distinct: DataFrame, groups: list[list[int]]) -> np.ndarray:
    """Counts of all values of each partition: 4 by 65536."""
    rows = distinct.select("fp").mapInArrow(_histograms(groups), "part int, value int, n long")
    out = np.zeros((PARTS, 1 << WIDTH), np.int64)
    found = rows.groupBy("part", "value").agg(F.sum("n").alias("n")).toPandas()
    out[found["part"].to_numpy(), found["value"].to_numpy()] = found["n"].to_numpy()
    return out


def masks(t: int) -> list[int]:
    """Values that keep all but ``t`` of the 16 bits."""
    full = (1 << WIDTH) - 1
    return [full & ~sum(1 << b for b in c) for c in combinations(range(WIDTH), t)] if t >= 0 else []


def blanked(counts: np.ndarray, mask: int) -> np.ndarray:
    """The histogram of value & mask."""
    return np.bincount(np.arange(1 << WIDTH) & mask, weights=counts, minlength=1 << WIDTH).astype(np.int64)


def candidate_cost(counts: np.ndarray, t: int) -> float:
    """Estimated pairs under the keys of threshold ``t``, and a part for each key that has to be sent."""
    if t < 0:
        return 0.0
    if t > 1:  # as many pairs as the neighbouring threshold has, times the keys' growth and the blanked bit
        return candidate_cost(counts, t - 1) * 2 * (WIDTH - t + 1) / t
    n = float(counts.sum())
    return sum(float((blanked(counts, m).astype(float) ** 2).sum()) / 2 + 40 * n for m in masks(t))


def thresholds(counts: np.ndarray, limit: int = LIMIT) -> list[int]:
    """The cheapest t with sum(t) = limit - parts + 1, t >= -1, by dynamic programming over the partitions."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for k in range(PARTS):
        after: dict[int, tuple[float, list[int]]] = {}
        costs = {t: candidate_cost(counts[k], t) for t in range(-1, limit + 1)}
        for total, (cost, chosen) in best.items():
            for t, more in costs.items():
                x = (cost + more, [*chosen, t])
                if total + t not in after or x < after[total + t]:
                    after[total + t] = x
        best = after
    return best[limit - PARTS + 1][1]


# --- probing and verification ------------------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    """A fixed scramble of 64-bit numbers, to deal fingerprints over blocks."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _probes(groups, chosen, blocks):
    """Fingerprints to (key, fp): a key names partition, mask, value and a pair of blocks."""

    def run(batches):
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for k, g in enumerate(groups):
                if chosen[k] < 0:
                    continue
                values = part_values(fp, g)
                for j, mask in enumerate(masks(chosen[k])):
                    v = values & np.uint32(mask)
                    many = blocks[k][j].value[v].astype(np.int64)
                    mine = (_mixed(fp) % many.astype(np.uint64)).astype(np.int64)
                    most = int(many.max(initial=1))
                    for other in range(most):
                        on = np.flatnonzero(many > other)
                        lo, hi = np.minimum(mine[on], other), np.maximum(mine[on], other)
                        n = len(on)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(n, k * 4096 + j, np.int32)),
                                pa.array(v[on].astype(np.int32)),
                                pa.array(lo.astype(np.int32)),
                                pa.array(hi.astype(np.int32)),
                                pa.array(fp[on].view(np.int64)),
                            ],
                            ["probe", "value", "lo", "hi", "fp"],
                        )

    return run


class _Forest:
    """Roots of positions 0..n-1."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def settle(self) -> None:
        while not np.array_equal(top := self.up[self.up], self.up):
            self.up = top


def forest(keys: np.ndarray, fp: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, least member) of a spanning forest; ``keys`` sorted, only equal keys are compared."""
    n, f = len(fp), _Forest(len(fp))
    on = np.arange(n)
    for step in range(1, n):
        on = on[on + step < n]
        on = on[keys[on] == keys[on + step]]  # positions whose run reaches that far
        if not len(on):
            break
        apart = f.up[on] != f.up[on + step]
        near = on[apart]
        near = near[np.bitwise_count(fp[near] ^ fp[near + step]) <= limit]
        for i in near.tolist():
            a, b = f.root(i), f.root(i + step)
            if a != b:
                f.up[max(a, b)] = min(a, b)
        if len(near):
            f.settle()
    f.settle()
    member = np.flatnonzero(f.up != np.arange(n))
    return member, f.up[member]


def _verified(batches):
    """Sorted (key, fp) rows to links; a key's rows wait for the end of the key, at most two blocks of them."""
    rest: list[np.ndarray] = []

    def links(keys, fp):
        member, top = forest(keys, fp)
        return pa.RecordBatch.from_arrays(
            [pa.array(fp[member].view(np.int64)), pa.array(fp[top].view(np.int64))], ["a", "b"]
        )

    def runs(k):
        return np.concatenate(([0], np.cumsum((k[1:] != k[:-1]).any(1)))) if len(k) else np.empty(0, np.int64)

    held = None
    for b in batches:
        k = np.column_stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(4)])
        fp = b.column(4).to_numpy(zero_copy_only=False).view(np.uint64)
        if held is not None:
            k, fp = np.concatenate((held[0], k)), np.concatenate((held[1], fp))
        r = runs(k)
        if not len(r):
            continue
        cut = int(np.searchsorted(r, r[-1]))
        held = (k[cut:], fp[cut:])
        if cut:
            yield links(r[:cut], fp[:cut])
    if held is not None:
        yield links(runs(held[0]), held[1])


def links(distinct: DataFrame) -> DataFrame:
    """Spanning links (a, b) of all pairs of ``distinct`` (fp) with LIMIT or fewer differing bits."""
    sc = distinct.sparkSession.sparkContext
    n = distinct.count()
    groups = bit_groups(distinct, n)
    counts = histograms(distinct, groups)
    chosen = thresholds(counts)
    # blocks a key: 256 KB for each mask of a chosen threshold, whatever the input
    blocks = [
        [sc.broadcast(np.maximum(1, -(-blanked(counts[k], m) // BLOCK)).astype(np.int32)) for m in masks(t)]
        for k, t in enumerate(chosen)
    ]
    probes = distinct.select("fp").mapInArrow(
        _probes(groups, chosen, blocks), "probe int, value int, lo int, hi int, fp long"
    )
    key = ["probe", "value", "lo", "hi"]
    return probes.repartition(*key).sortWithinPartitions(*key).mapInArrow(_verified, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: doc_id, fingerprint (16 hex digits), component_id, component_fp (signed long)."""
    prints = written(fingerprints(docs, id_col, text), "prints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")), "distinct")
    roots = components(links(distinct))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    named = named.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    known = named.join(least, "root").select("fp", "component_id", F.col("root").alias("component_fp"))
    hex16 = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(known, "fp").select(
        "doc_id", hex16.alias("fingerprint"), "component_id", "component_fp"
    )


def representatives(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that of the least id, null ids last.

    Rows are told apart by id, text and all other columns (128 bits of hash), so rows that share an id but are no near copies
    all stay; of rows of one id the least text hash goes first.
    """
    own = [F.col(f"`{c}`") for c in docs.columns]
    one = F.col(f"`{id_col}`")
    whole = [*own, *[c.isNull() for c in own]]  # a null leaves no trace in a hash
    name = [F.xxhash64(F.lit(1), *whole).alias("r1"), F.xxhash64(F.lit(2), *whole).alias("r2")]
    order = F.struct(one.isNull().alias("late"), one.alias("id"), F.xxhash64(f"`{text}`").alias("text"), *name)
    found = near_duplicates(docs.select(order.alias("row"), F.col(f"`{text}`").alias("text")), "row", "text")
    keep = found.select(F.col("component_id.r1").alias("r1"), F.col("component_id.r2").alias("r2")).distinct()
    kept = docs.select(F.struct(*own).alias("row"), *name).join(keep, ["r1", "r2"], "left_semi")
    return kept.dropDuplicates(["r1", "r2"]).select("row.*")
