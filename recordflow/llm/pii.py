r"""Personal data, in DataFrame functions only: generators, boosted trees over format and context, redaction.

1. Base kinds (email, ip, card, phone) are matched leftmost and non-overlapping, then validated.
2. High-recall generators propose further spans, which may overlap each other and base spans.
3. Every candidate gets a cell: 13 bits of format and context features.  Validators give weak labels (a candidate that
   passes its kind's validator is positive, one that fails is negative; a national phone is positive if its digits are
   as many as a phone's and a cue for phones stands before it).  Trees of depth two are boosted on the counts of the cells, which are complete statistics of all
   candidates and at most 4 * 8192 numbers, whatever the input; scoring is one native expression.
4. A candidate that fails its validator is never added.  One that passes is added where the validator decides on its own
   (``DECIDED``: every selected one is positive, so no threshold can raise the precision).  A national phone passes by its
   length alone, so it is added at or above the lowest score at which the held-out ones that pass reach ``precision``.
   Spans that touch a base span are not added.  Base spans always stay.

Matches are found by ``regexp_extract_all`` and placed by the lengths of the pieces that ``split`` leaves between
them; both walk the same matches.  Repetitions of groups are possessive, which gives the same matches (nothing
follows them) without recursion, and runs are entered at their start only, so long runs take linear time.

Defined cases: a null text is empty and has no spans; null ids pass through; repeated rows are scanned one by one; an
empty table gives an empty result; without held-out national phones their threshold is the score at which the trees
themselves give ``precision``; extra columns are ignored by
``find_personal_data`` and kept by ``redacted_documents``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

BASE = ("email", "ip", "card", "phone")
ADDED = ("spelled_email", "number_group", "iban", "national_id", "dotted_quad", "national_phone")
KINDS = (*BASE, *ADDED)
#: Kinds whose validator or strict form decides.
DECIDED = ("spelled_email", "number_group", "iban", "national_id", "dotted_quad")

_LOCAL = r"A-Za-z0-9._%+-"
#: kind: (pattern, a short pattern that every match holds, tried first)
PATTERNS = {
    "email": (rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", "[0-9]"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
    "spelled_email": (
        r"(?<![A-Za-z0-9._-])[A-Za-z0-9][A-Za-z0-9._-]*+\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:(?:\x20?[\[(]dot[\])]\x20?|\.)[A-Za-z]{2,}+(?![A-Za-z0-9]))++",
        r"[\[(]at[\])]",
    ),
    "number_group": (r"(?<![0-9])[0-9]{3,4}(?:[\x20.-][0-9]{3,6}){2,4}(?![0-9])", "[0-9]{3}[ .-]"),
    "iban": (r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b", "[A-Z]{2}[0-9]{2}"),
    "national_id": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-[0-9]{2}-"),
    "dotted_quad": (r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])", r"[0-9]\.[0-9]"),
    "national_phone": (r"(?<![0-9+])\(?[0-9]{2,5}\)?[\x20.-][0-9]{2,4}(?:[\x20.-][0-9]{2,4}){1,3}(?![0-9])", "[0-9]{2}[ .)-]"),
}

#: Words before a span that tell of personal data; fixed, lower case.
CUES = (
    "phone", "tel", "call", "mobile", "fax", "mail", "contact", "write", "reach", "card", "visa", "iban", "account",
    "ssn", "passport", "address", "server", "host", "login",
)
PHONE_CUES = ("phone", "tel", "call", "mobile", "fax", "contact", "reach")
WINDOW, BLOCK = 32, 128


@dataclass(frozen=True)
class Boosting:
    rounds: int = 24
    rate: float = 0.4
    precision: float = 0.98


def _longs(x: Column) -> Column:
    return x.cast("long")


def _matches(text: str, kind: str) -> Column:
    """Matches of a kind in order: array of (start, end, value, before, after); positions in code points.

    ``before`` and ``after`` are what stands next to the match within its gaps, so that no match walks the whole text.
    """
    quoted = lambda x: x.replace("\\", "\\\\").replace("'", "\\'")
    p, ready = (quoted(x) for x in PATTERNS[kind])
    item = "struct<start:int,end:int,value:string,before:string,after:string>"
    # appended in blocks, so that many matches of one text cost no more than a few copies each
    block = (
        f"aggregate(sequence(b * {BLOCK}, least(size(m), (b + 1) * {BLOCK}) - 1),"
        f" named_struct('at', o.at, 'out', cast(array() AS array<{item}>)),"
        " (a, k) -> named_struct("
        "  'at', a.at + length(g[k]) + length(m[k]),"
        "  'out', array_append(a.out, named_struct("
        "    'start', a.at + length(g[k]), 'end', a.at + length(g[k]) + length(m[k]), 'value', m[k],"
        f"    'before', lower(right(g[k], {WINDOW})), 'after', left(g[k + 1], 1)))))"
    )
    placed = (
        f"aggregate(sequence(0, (size(m) - 1) div {BLOCK}),"
        f" named_struct('at', 0, 'out', cast(array() AS array<array<{item}>>)),"
        " (o, b) -> element_at(transform("
        f"   array({block}), x -> named_struct('at', x.at, 'out', array_append(o.out, x.out))), 1),"
        " o -> flatten(o.out))"
    )
    # one element arrays bind m (the matches) and g (the gaps) once
    bound = (
        f"flatten(transform(filter(array(regexp_extract_all({text}, '{p}', 0)), m -> size(m) > 0), m ->"
        f" flatten(transform(array(split({text}, '{p}', -1)), g -> {placed}))))"
    )
    return F.expr(f"CASE WHEN rlike({text}, '{ready}') THEN {bound} ELSE array() END")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The check of card numbers: every second digit from the right doubled, nines cast out, sum divisible by ten."""
    places = F.split(F.reverse(digits), "")
    doubled = F.transform(
        F.filter(places, lambda c: c != ""),
        lambda c, i: F.when(i % 2 == 1, (c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")).otherwise(c.cast("int")),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _octets(value: Column) -> Column:
    return F.forall(
        F.split(value, r"\."),
        lambda p: F.length(F.ltrim(p, F.lit("0"))).isin(0, 1, 2) | ((F.length(F.ltrim(p, F.lit("0"))) == 3) & (F.ltrim(p, F.lit("0")) <= "255")),
    )


def _mod97(value: Column) -> Column:
    """The check of bank account numbers: letters as numbers from 10, the first four at the end, rest 1 of 97."""
    bare = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(bare, 5, 64), F.substring(bare, 1, 4))
    places = F.filter(F.split(turned, ""), lambda c: c != "")
    step = lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + F.try_to_number(c, F.lit("9")).cast("int")) % 97).otherwise(
        (a * 100 + F.ascii(c) - 55) % 97
    )
    return F.aggregate(places, F.lit(0), step) == 1


def _valid(kind: str, value: Column) -> Column:
    """The validator of a kind."""
    if kind in ("email", "spelled_email"):
        return F.lit(True)
    if kind in ("ip", "dotted_quad"):
        return _octets(value)
    n = F.length(_digits(value))
    if kind in ("card", "number_group"):
        # the check is made for values of fitting length only, so its arrays stay short
        return F.when(n.between(12, 19), luhn(F.substring(_digits(value), 1, 19))).otherwise(False)
    if kind in ("phone", "national_phone"):
        return n.between(9, 15)
    if kind == "iban":
        return _mod97(value)
    # areas 000, 666 and from 900, groups 00 and serials 0000 are never issued
    return ~value.rlike("^(?:000|666|9)|-00-|-0000$")


def _cued(before: Column, words: tuple[str, ...]) -> Column:
    cue = F.lit(False)
    for word in words:
        cue = cue | F.contains(before, F.lit(word))
    return cue


def _label(kind: str, m: Column) -> Column:
    """Whether a candidate is a positive example."""
    valid = _valid(kind, m["value"])
    return valid & _cued(m["before"], PHONE_CUES) if kind == "national_phone" else valid


def _cell(kind: str, m: Column) -> Column:
    """13 bits: generator, digits, and what the span and its neighbourhood look like."""
    value, before, after = m["value"], m["before"], m["after"]
    prior = F.right(before, F.lit(1))
    n = F.length(_digits(value))
    cue = _cued(before, CUES)
    group = {"email": 0, "spelled_email": 0, "ip": 1, "dotted_quad": 1, "card": 2, "number_group": 2, "iban": 3, "phone": 4, "national_phone": 4, "national_id": 5}[kind]
    bits = [
        cue,
        prior.rlike(r"[\p{L}\p{N}_=/.$#-]"),
        after.rlike(r"[\p{L}\p{N}_=/%$#-]"),
        value.rlike(r"[\x20().-]"),
        value.rlike(r"^[+(]"),
        F.replace(_digits(value), F.substring(_digits(value), 1, 1), F.lit("")) == "",  # one digit all along
        before.rlike(r"[:=]\x20?$"),
        value.rlike(r"\x20") & value.rlike(r"[.-]"),
    ]
    size = F.when(n < 9, 0).when(n < 12, 1).when(n < 16, 2).otherwise(3)
    cell = F.lit(group * 4) + size
    for b in bits:
        cell = cell * 2 + b.cast("int")
    return cell


GROUPS, CELLS = 6, 32 << 8


def _accepted(kind: str):
    return lambda m: _valid(kind, m["value"])


def _span(rank: int):
    return lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"))


def _described(kind: str, rank: int):
    def described(m: Column) -> Column:
        return F.struct(
            m["start"].alias("start"),
            F.lit(rank).alias("rank"),
            m["end"].alias("end"),
            _cell(kind, m).alias("cell"),
            _label(kind, m).cast("int").alias("label"),
            _valid(kind, m["value"]).alias("valid"),
            F.pmod(F.xxhash64(m["value"]), F.lit(4)).cast("int").alias("fold"),
        )

    return described


def candidates(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(doc_id, base, more): spans of the base kinds, and all candidates with cell, label, validity and fold."""
    only = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    found = only.withColumns({f"m_{k}": _matches("text", k) for k in KINDS})
    base, more = [], []
    for rank, kind in enumerate(KINDS):
        spans = F.col(f"m_{kind}")
        if kind in BASE:
            base.append(F.transform(F.filter(spans, _accepted(kind)), _span(rank)))
        more.append(F.transform(spans, _described(kind, rank)))
    return found.select("doc_id", F.concat(*base).alias("base"), F.concat(*more).alias("more"))


def cell_counts(found: DataFrame) -> np.ndarray:
    """Candidates by held-out, cell and label: 2 by 8192 by 2; held out are only those that a threshold may select."""
    each = found.select(F.explode("more").alias("c")).where("c.label IS NOT NULL")
    scored = [KINDS.index(k) for k in ADDED if k not in DECIDED]
    each = each.where((F.col("c.fold") != 0) | (F.col("c.rank").isin(scored) & F.col("c.valid")))
    rows = each.groupBy((F.col("c.fold") == 0).cast("int").alias("h"), "c.cell", "c.label").count().collect()
    out = np.zeros((2, CELLS, 2))
    for h, cell, label, n in rows:
        out[h, cell, label] = n
    return out


def _feature_bits() -> np.ndarray:
    return (np.arange(CELLS)[:, None] >> np.arange(13)) & 1


def boosted(counts: np.ndarray, how: Boosting) -> list[tuple[int, list[int], list[float]]]:
    """Trees (first bit, second bit of either side, four leaf scores), fitted to the counts by Newton steps."""
    bits, pos, n = _feature_bits(), counts[:, 1], counts.sum(1)
    on = np.flatnonzero(n)
    bits, pos, n = bits[on], pos[on], n[on]
    score, trees = np.zeros(len(on)), []
    if not len(on):
        return trees

    def gain(g, h):
        return g * g / (h + 1.0)

    def best(mask, g, h):
        gb, hb = bits[mask].T @ g[mask], bits[mask].T @ h[mask]
        gt, ht = g[mask].sum(), h[mask].sum()
        return int(np.argmax(gain(gb, hb) + gain(gt - gb, ht - hb)))

    for _ in range(how.rounds):
        p = 1 / (1 + np.exp(-score))
        g, h = pos - n * p, n * p * (1 - p)
        first = best(np.ones(len(on), bool), g, h)
        seconds, leaves = [], []
        for side in (0, 1):
            mask = bits[:, first] == side
            second = best(mask, g, h) if mask.any() else 0
            seconds.append(second)
            for leaf in (0, 1):
                m = mask & (bits[:, second] == leaf)
                step = how.rate * float(g[m].sum() / (h[m].sum() + 1.0))
                leaves.append(round(step, 6))
                score[m] += leaves[-1]
        trees.append((first, seconds, leaves))
    return trees


def scores(trees) -> np.ndarray:
    """The score of every cell."""
    bits, out = _feature_bits(), np.zeros(CELLS)
    for first, seconds, leaves in trees:
        side = bits[:, first]
        second = np.where(side == 1, bits[:, seconds[1]], bits[:, seconds[0]])
        out += np.array(leaves)[side * 2 + second]
    return out


def _lowest(s: np.ndarray, held: np.ndarray, how: Boosting) -> float | None:
    order = np.argsort(-s, kind="stable")
    order = order[held[order].sum(1) > 0]
    pos, n, best = np.cumsum(held[order, 1]), np.cumsum(held[order].sum(1)), None
    for i, cell in enumerate(order):
        last = i + 1 == len(order) or s[order[i + 1]] < s[cell]
        if last and pos[i] >= how.precision * n[i]:
            best = float(s[cell])
    return best


def thresholds(trees, held: np.ndarray, how: Boosting) -> list[float | None]:
    """For each group of generators the lowest score at which its held-out candidates reach the precision.

    None means that no score reaches it, and nothing of the group is added; a group without held-out candidates takes the
    score at which the trees themselves give the precision.
    """
    s, groups = scores(trees), np.arange(CELLS) >> 10
    out: list[float | None] = []
    for g in range(GROUPS):
        own = np.where((groups == g)[:, None], held, 0)
        out.append(_lowest(s, own, how) if own.sum() else float(np.log(how.precision / (1 - how.precision))))
    return out


def _score(trees, cell: Column) -> Column:
    """The trees as one native expression."""
    bit = lambda b: F.getbit(cell.cast("int"), F.lit(b)) == 1
    out = F.lit(0.0)
    for first, (left, right), x in trees:
        out = out + F.when(
            bit(first), F.when(bit(right), F.lit(x[3])).otherwise(F.lit(x[2]))
        ).otherwise(F.when(bit(left), F.lit(x[1])).otherwise(F.lit(x[0])))
    return out


def _selected(found: DataFrame, how: Boosting) -> DataFrame:
    """Adds ``added``: spans of candidates that the trees accept and that touch no base span."""
    counts = cell_counts(found)
    trees = boosted(counts[0], how)
    first = len(BASE)
    limits = F.array(*[F.lit(x).cast("double") for x in thresholds(trees, counts[1], how)])
    decided = [KINDS.index(k) for k in DECIDED]
    # no limit is null, and a comparison with null selects nothing
    good = F.filter(
        "more",
        lambda c: (c["rank"] >= first)
        & c["valid"]
        & (c["rank"].isin(decided) | (_score(trees, c["cell"]) >= F.get(limits, F.shiftright(c["cell"], 10)) - F.lit(1e-9))),
    )
    free = F.filter(
        good, lambda c: ~F.exists(F.col("base"), lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    )
    bare = F.transform(free, lambda c: F.struct(c["start"].alias("start"), c["rank"].alias("rank"), c["end"].alias("end")))
    return found.withColumn("added", F.array_distinct(bare))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(F.sort_array(spans), lambda x: F.concat_ws(":", F.get(names, x["rank"]), x["start"], x["end"])), ","
    )


def find_personal_data(docs: DataFrame, how: Boosting = Boosting(), id_col="doc_id", text="text") -> DataFrame:
    """One row a document: counts of the base kinds, digest of the base spans, all spans."""
    found = written(candidates(docs, id_col, text), "candidates")
    ranks = F.transform("base", lambda b: b["rank"])
    counts = [_longs(F.size(ranks) - F.size(F.array_remove(ranks, i))).alias(f"n_{k}") for i, k in enumerate(BASE)]
    return _selected(found, how).select(
        "doc_id",
        *counts,
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "added")).alias("spans"),
    )


def redacted_documents(docs: DataFrame, how: Boosting = Boosting(), text="text") -> DataFrame:
    """All rows and columns; in ``text`` every selected span gives way to its kind in brackets."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    held = docs.select(row.alias("row"), F.col(f"`{text}`").alias("text"))
    found = written(candidates(held, "row", "text"), "candidates")
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    # rows are selected under another name than any column takes, so none is mistaken for the row
    met = _selected(found, how).select(F.col("doc_id").alias("row"), F.sort_array(F.concat("base", "added")).alias("spans"))
    t = F.col("row").getField(text)
    cut = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(
                s["start"] >= a["at"],
                F.concat(a["out"], F.substring(t, a["at"] + 1, s["start"] - a["at"]), F.get(names, s["rank"])),
            )
            .otherwise(a["out"])
            .alias("out"),
        ),
        lambda a: F.concat(a["out"], F.substring(t, a["at"] + 1, F.length(t))),
    )
    return met.select(F.col("row").withField(f"`{text}`", F.when(t.isNotNull(), cut)).alias("row")).select("row.*")
