"""Mixing sources to target weights by Pareto order sampling.

1. Targets: the sources share ``share`` times all words by cyclic weights; a target stops at ``most`` times its
   source's words, and the excess is shared anew until no target is above (water filling in closed form).
2. Expected copies: within a source, documents weigh by size class (longer texts a little more), and the same water
   filling gives each class its expected copies c, at most ``most``.  floor(c) whole copies are certain.
3. The rest, pi = c - floor(c), is an unequal inclusion probability.  Documents are ranked by
   [u / (1 - u)] / [pi / (1 - pi)] with a hashed u, and the source takes ranks in order while that brings its words nearer
   to the target: a sample of fixed size in words, off by half of one document at most.

The cut in the order is found without sorting a source: two histograms of 4096 rank cells narrow it to a 2**-24
share of the ranks, and only that share is ordered.  Documents meet only tables with a few rows a source;
those are written first, so that the planner broadcasts them if their files are small, and joins otherwise.

Defined cases: a null or empty text has size 0 and is never taken; null sources form one source, last in
order; null ids are ranked by their texts; rows equal in id and text rank equally, and where the cut falls between
them a number of them is taken, so that the target is met with ties too; an empty table gives an empty result; extra columns are ignored by ``mixed_sizes`` and kept by
``mixed_documents``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import written


@dataclass(frozen=True)
class Mix:
    #: Weights of the sources by code point order, repeating; null last.
    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    most: int = 2
    #: A document's weight grows by this for every doubling of its size.
    longer: float = 0.1
    seed: int = 7


def _n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _filled(df: DataFrame, cap: str, weight: str, total: str, out: str, by: list[str]) -> DataFrame:
    """Water filling: ``out`` = least(cap, level * weight), summing to ``total`` in each group of ``by``.

    In order of cap / weight the capped ones come first; the level of the first that is not capped holds.
    """
    order = W.partitionBy(*by).orderBy("__ratio", "__tie")
    whole = W.partitionBy(*by)
    found = (
        df.withColumn("__ratio", F.col(cap) / F.col(weight))
        .withColumn("__tie", F.struct(*[c for c in df.columns if c not in by]))
        .withColumn("__before", F.sum(cap).over(order) - F.col(cap))
        .withColumn("__after", F.sum(weight).over(whole) - F.sum(weight).over(order) + F.col(weight))
        .withColumn("__level", (F.col(total) - F.col("__before")) / F.col("__after"))
        .withColumn("__free", F.col("__level") * F.col(weight) <= F.col(cap))
        .withColumn("__held", F.min(F.when(F.col("__free"), F.struct("__ratio", "__tie", "__level"))).over(whole))
    )
    level = F.col("__held.__level")
    return found.withColumn(out, F.least(F.col(cap).cast("double"), F.coalesce(level * F.col(weight), F.col(cap).cast("double")))).drop(
        "__ratio", "__tie", "__before", "__after", "__level", "__free", "__held"
    )


def _facts(id_: Column, text: Column, source: Column, mix: Mix) -> dict[str, Column]:
    """key names the source and sorts null last; u is in (0, 1)."""
    size = _n_words(text)
    hashed = F.pmod(F.xxhash64(F.lit(mix.seed), id_, text), F.lit(1 << 52))
    return {
        "key": _key(source),
        "size": size,
        "class": _class(size),
        "u": (hashed + F.lit(0.5)) / F.lit(float(1 << 52)),
    }


def _sized(docs: DataFrame, mix: Mix, id_col: str, text: str, source: str) -> DataFrame:
    id_, t, s = (F.col(f"`{c}`") for c in (id_col, text, source))
    return docs.select(id_.alias("doc_id"), *[x.alias(k) for k, x in _facts(id_, t, s, mix).items()])


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def _class(size: Column) -> Column:
    """floor(log2(size)), -1 for 0, exact."""
    return F.when(size <= 0, -1).otherwise(F.length(F.bin(size)) - 1).cast("int")


def targets(classes: DataFrame, mix: Mix) -> DataFrame:
    """(key, source_size, target) from (key, class, words): one row a source."""
    sources = classes.groupBy("key").agg(F.sum("words").alias("source_size"))
    rank = F.row_number().over(W.orderBy("key")) - 1  # over sources, the entries of the mix
    cycle = F.array(*[F.lit(w) for w in mix.weights])
    sources = (
        sources.withColumn("weight", F.get(cycle, rank % len(mix.weights)))
        .withColumn("cap", F.col("source_size") * mix.most)
        .withColumn("total", F.sum("source_size").over(W.partitionBy()) * F.lit(mix.share))
    )
    return _filled(sources, "cap", "weight", "total", "target", []).select("key", "source_size", "target")


def _cells(ranked: DataFrame, cell: Column) -> DataFrame:
    """For each source the cell in which its need ends: the last one that starts below it."""
    cells = ranked.withColumn("cell", cell).groupBy("key", "need", "cell").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(W.partitionBy("key").orderBy("cell")) - F.col("words")
    return (
        cells.withColumn("before", before)
        .where("before < need")
        .groupBy("key")
        .agg(F.max(F.struct("cell", "before")).alias("x"))
        .select("key", "x.cell", "x.before")
    )


def plan(sized: DataFrame, mix: Mix) -> DataFrame:
    """One row a source and size class: source_size, target, whole copies, pi, and the source's last rank taken."""
    classes = written(
        sized.groupBy("key", "class").agg(F.sum("size").alias("words"), F.count("*").alias("n")), "classes"
    )
    goal = classes.join(written(targets(classes, mix), "targets"), "key")
    goal = goal.withColumn("cap", F.col("words") * mix.most).withColumn(
        "weight", F.col("words") * (F.lit(1.0) + F.lit(mix.longer) * F.greatest("class", F.lit(0)))
    )
    some = _filled(goal.where("words > 0"), "cap", "weight", "target", "share", ["key"])
    copies = F.least(F.col("share") / F.col("words"), F.lit(float(mix.most)))
    some = some.withColumn("whole", F.floor(copies + F.lit(1e-12)).cast("long")).withColumn(
        "pi", F.greatest(copies - F.col("whole"), F.lit(0.0))
    )
    none = goal.where("words = 0").withColumns({"whole": F.lit(0).cast("long"), "pi": F.lit(0.0)})
    columns = ["key", "class", "words", "source_size", "target", "whole", "pi"]
    steps = written(some.select(columns).unionByName(none.select(columns)), "steps")

    needs = steps.groupBy("key").agg(
        (F.first("target") - F.sum(F.col("whole") * F.col("words"))).alias("need")
    )
    factors = written(steps.where("pi > 0").select("key", "class", "pi").join(needs, "key"), "factors")
    ranked = written(
        sized.join(factors, ["key", "class"]).select("key", "need", "size", _rank(F.col("u"), F.col("pi")).alias("rank")),
        "ranked",
    )
    first = written(_cells(ranked, F.shiftright("rank", 36)), "cells")
    inside = ranked.join(first, "key").where(F.shiftright("rank", 36) == F.col("cell"))
    inside = inside.select("key", (F.col("need") - F.col("before")).alias("need"), "size", "rank")
    second = written(_cells(inside, F.shiftright("rank", 24)), "cells")
    last = inside.join(second, "key").where(F.shiftright("rank", 24) == F.col("cell"))
    # rows of one rank are counted, as equal rows may be many; of the last rank a number is taken
    ranks = last.groupBy("key", "need", "before", "rank").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    upto = F.sum("words").over(W.partitionBy("key").orderBy("rank"))
    one = F.col("words") / F.col("n")
    rows = F.ceil((F.col("need") - (F.col("before") + upto - F.col("words"))) / one + 0.5) - 1
    taken = ranks.withColumn("k", F.least(rows, F.col("n")).cast("long")).where("k > 0")
    taken = taken.groupBy("key").agg(F.max(F.struct("rank", "k", "n")).alias("x"))
    none = F.lit(0).cast("long")
    cut = second.join(taken, "key", "left").select(
        "key", F.coalesce("x.rank", F.shiftleft("cell", 24) - 1).alias("last_rank"),
        F.coalesce("x.k", none).alias("last_k"), F.coalesce("x.n", none).alias("last_n"),
    )
    return written(steps.join(cut, "key", "left").drop("words"), "plan")


def _rank(u: Column, pi: Column) -> Column:
    """Odds of u over odds of pi as 48-bit numbers in the same order."""
    pi = F.when((pi > 0) & (pi < 1), pi).otherwise(0.5)  # a shared subexpression may be evaluated for any row
    q = (u / (1 - u)) / (pi / (1 - pi))
    return F.floor(q / (1 + q) * F.lit(float((1 << 48) - 1))).cast("long")


def _copies() -> Column:
    more = (F.col("pi") > 0) & (_rank(F.col("u"), F.col("pi")) <= F.col("last_rank"))
    return F.col("whole") + F.coalesce(more, F.lit(False)).cast("long")


def _tied() -> Column:
    """Rows of a last rank of which some are taken and some are not."""
    last = (F.col("pi") > 0) & (_rank(F.col("u"), F.col("pi")) == F.col("last_rank"))
    return F.coalesce(last & (F.col("last_k") < F.col("last_n")), F.lit(False))


def _numbered(tied: DataFrame, columns: list[str]) -> DataFrame:
    """Equal rows as one, with their number ``n`` and how many of them are ``taken``; different rows of a rank take turns in order."""
    own = tied.groupBy("key", "u", "whole", "last_k", *columns).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(W.partitionBy("key").orderBy("u", F.xxhash64(*columns)).rowsBetween(W.unboundedPreceding, 0))
    first = F.greatest(F.lit(0), F.col("last_k") - (upto - F.col("n")))
    return own.withColumn("chosen", F.least(F.col("n"), first))


def _repeated(rows: DataFrame, n: str) -> DataFrame:
    """Every row ``n`` times, with ``at`` from 0; in blocks that are dealt over all tasks, as n may be large."""
    blocks = rows.where(F.col(n) > 0).withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col(n) - 1) / BLOCK))))
    size = F.least(F.lit(BLOCK), F.col(n) - F.col("block") * BLOCK)
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = blocks.repartition(tasks).withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), size - 1)))
    return each.withColumn("at", F.col("at") + F.col("block") * BLOCK).drop("block")


_KEPT = ("doc_id", "size", "source_size", "target")
#: Copies of one row that are made in one piece.
BLOCK = 4096


def _splits(steps: DataFrame) -> bool:
    """Whether the cut of some source falls between rows of one rank; ``steps`` has a few rows a source."""
    return bool(steps.where("last_k < last_n").limit(1).count())


def mixed_sizes(docs: DataFrame, mix: Mix = Mix(), id_col="doc_id", text="text", source="source") -> DataFrame:
    """One row a document: doc_id, size, source_size, target, taken, copies."""
    sized = written(_sized(docs, mix, id_col, text, source), "sized")
    steps = plan(sized, mix)
    found = sized.join(steps, ["key", "class"])
    result = lambda copies: [F.col(c) for c in _KEPT] + [(copies * F.col("size")).alias("taken"), copies.alias("copies")]
    if not _splits(steps):
        return found.select(*result(_copies()))
    rows = _repeated(_numbered(found.where(_tied()), list(_KEPT)), "n")
    ties = rows.select(*result(F.col("whole") + (F.col("at") < F.col("chosen")).cast("long")))
    return found.where(~_tied()).select(*result(_copies())).unionByName(ties)


def mixed_documents(docs: DataFrame, mix: Mix = Mix(), id_col="doc_id", text="text", source="source") -> DataFrame:
    """The mix: every row of ``docs`` as often as it is taken, all its columns."""
    sized = written(_sized(docs, mix, id_col, text, source), "sized")
    steps = plan(sized, mix)
    splits = _splits(steps)
    steps = steps.select("key", "class", "whole", "pi", "last_rank", "last_k", "last_n")
    id_, t, s = (F.col(f"`{c}`") for c in (id_col, text, source))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    facts = _facts(id_, t, s, mix)
    own = docs.select(row.alias("row"), *[facts[k].alias(k) for k in ("key", "class", "u")])
    met = own.join(steps, ["key", "class"])
    repeated = met.where(~_tied()) if splits else met
    repeated = repeated.select("row", _copies().alias("n")).where("n > 0")
    rows = repeated.select("row", F.explode(F.expr("array_repeat(0, cast(n AS int))"))).select("row")
    if splits:
        ties = _numbered(met.where(_tied()), ["row"])
        ties = _repeated(ties.withColumn("copies", F.col("n") * F.col("whole") + F.col("chosen")), "copies")
        rows = rows.unionByName(ties.select("row"))
    return rows.select("row.*")
