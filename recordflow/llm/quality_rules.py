"""Line-first quality rules, in DataFrame functions only.

Every line is judged by punctuation, navigation and boilerplate rules; failing lines are removed,
and a document that loses more than ``max_lost`` of its word characters is rejected, as is one
that fails the base rules (too few words, or too many words in repeated 3-word windows).

Defined cases: a null text has no words, lines or symbols and fails the base rules; an empty text
likewise; null ids and other null columns pass through; repeated rows are judged one by one; an
empty table gives an empty result; extra columns of the input are ignored by ``quality_rules`` and
kept by ``cleaned_documents``.  There is no shuffle: each row is judged from its own text alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_RUN, SPACES

SYMBOLS = "#*$%&|<>"

#: Fixed phrases that mark a line as boilerplate; matched in lower case, anywhere in the line.
BOILERPLATE = (
    "all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service",
    "enable javascript", "use of cookies", "lorem ipsum", "subscribe to our newsletter",
    "click here", "powered by", "alle rechte vorbehalten", "tous droits réservés",
    "todos los derechos reservados",
)

#: A whole line of one such label is navigation.
NAVIGATION = (
    "home", "menu", "login", "log in", "sign in", "sign up", "register", "search", "next",
    "previous", "back", "top", "contact", "about us", "sitemap", "share", "print", "read more",
)

#: A terminal mark, with closing marks behind it; looked for in the last characters of a line.
TERMINAL, LAST = r"[.!?…:;。！？][\"'”’»)\]]*$", 8


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    #: Share of a document's word characters that may go with its failing lines.
    max_lost: float = 0.5
    #: A line fails the punctuation rule with more symbol marks a word than this, doubled marks counted.
    max_marks_per_word: float = 0.3
    #: Lines of at least this many words need a terminal mark.
    prose_words: int = 8


def _longs(x: Column) -> Column:
    return x.cast("long")


def judged_lines(lines: Column, rules: Rules) -> Column:
    """An array of (line, chars, rule): the line's word characters and the first rule that it fails, else null.

    Each step is an array of its own, so that no text is made twice for one line.
    """
    bare = F.transform(
        lines, lambda x: F.struct(x.alias("line"), F.trim(F.regexp_replace(x, SPACE_RUN, " ")).alias("bare"))
    )
    facts = F.transform(
        bare,
        lambda x: F.struct(
            x["line"].alias("line"),
            x["bare"].alias("bare"),
            F.lower(x["bare"]).alias("low"),
            F.length(F.replace(x["bare"], F.lit(" "), F.lit(""))).alias("chars"),
            F.regexp_count(x["bare"], F.lit(f"[{SYMBOLS}]|!!+")).alias("marks"),
            F.regexp_count(x["bare"], F.lit("[|»›•·]")).alias("seps"),
        ),
    )
    counted = F.transform(
        facts,
        lambda x: x.withField("n", F.when(x["chars"] == 0, 0).otherwise(F.length(x["bare"]) - x["chars"] + 1)),
    )

    def verdict(x: Column) -> Column:
        shout = (x["n"] >= 3) & (x["low"] != x["bare"]) & (F.upper(x["bare"]) == x["bare"])
        boilerplate = F.lit(False)
        for phrase in BOILERPLATE:
            boilerplate = boilerplate | F.contains(x["low"], F.lit(phrase))
        return (
            F.when(x["n"] == 0, F.lit(None).cast("string"))
            .when((x["seps"] >= 2) & (x["seps"] * 4 >= x["n"]), "navigation")
            .when((x["n"] <= 3) & x["low"].rlike("^(" + "|".join(NAVIGATION) + r")\W*$"), "navigation")
            .when((x["marks"] > x["n"] * rules.max_marks_per_word) | shout, "punctuation")
            .when((x["n"] >= rules.prose_words) & ~F.right(x["bare"], F.lit(LAST)).rlike(TERMINAL), "punctuation")
            .when(boilerplate, "boilerplate")
        )

    return F.transform(
        counted, lambda x: F.struct(x["line"].alias("line"), x["chars"].alias("chars"), verdict(x).alias("rule"))
    )


def _judged(df: DataFrame, text: str, rules: Rules) -> DataFrame:
    """Adds one struct column ``__q``; the steps are separate projections so that no array is made twice."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    one = df.withColumn("__t", t)
    bare = F.btrim(F.col("__t"), F.lit(SPACES))
    one = one.withColumn(
        "__w", F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN))
    ).withColumn("__l", F.split("__t", "\n"))
    # A window is known by a 64-bit hash; only windows of one text are compared with each other.
    windows = "transform(sequence(0, size(__w) - 3), i -> xxhash64(__w[i], __w[i + 1], __w[i + 2]))"
    two = one.withColumn("__h", F.expr(f"CASE WHEN size(__w) >= 3 THEN {windows} ELSE array() END"))
    two = two.withColumn(
        "__s",
        F.expr(
            "CASE WHEN size(array_distinct(__h)) < size(__h)"
            " THEN sort_array(transform(__h, (h, i) -> struct(h AS h, i AS i))) ELSE array() END"
        ),
    )
    # Starts of windows found twice or more: equal to a neighbour in hash order.
    three = two.withColumn(
        "__p",
        F.expr(
            "sort_array(transform(filter(__s, (s, j) -> s.h = get(__s, j - 1).h OR s.h = get(__s, j + 1).h),"
            " s -> s.i))"
        ),
    )
    three = three.withColumn(
        "__r",
        F.expr("aggregate(transform(__p, (p, j) -> least(3, coalesce(get(__p, j + 1) - p, 3))), 0, (a, b) -> a + b)"),
    )
    three = three.withColumn("__v", judged_lines(F.col("__l"), rules))
    of = lambda name: F.aggregate(
        F.filter("__v", lambda v: v["rule"] == name), F.lit(0), lambda a, v: a + v["chars"]
    )
    four = three.withColumns(
        {
            "__c": F.length(F.array_join("__w", "")),
            "__n1": of("punctuation"),
            "__n2": of("navigation"),
            "__n3": of("boilerplate"),
            "__worded": F.transform(F.filter("__v", lambda v: v["chars"] > 0), lambda v: v["line"]),
        }
    )
    n = F.size("__w")
    failed = (n < rules.min_words) | (F.lit(100) * F.col("__r") > F.lit(rules.max_repeat_percent) * n)
    lost = F.col("__n1") + F.col("__n2") + F.col("__n3")
    return four.withColumn(
        "__q",
        F.struct(
            _longs(n).alias("n_words"),
            _longs(F.col("__c")).alias("word_chars"),
            _longs(F.regexp_count(F.col("__t"), F.lit(f"[{SYMBOLS}]"))).alias("n_symbols"),
            _longs(F.size("__worded") - F.size(F.array_distinct("__worded"))).alias("n_dup_lines"),
            _longs(F.col("__r")).alias("n_repeat_words"),
            failed.alias("base_failed"),
            (~failed & (lost <= F.col("__c") * F.lit(rules.max_lost))).alias("kept"),
            _longs(F.col("__n1")).alias("lost_punctuation"),
            _longs(F.col("__n2")).alias("lost_navigation"),
            _longs(F.col("__n3")).alias("lost_boilerplate"),
            F.array_join(
                F.transform(F.filter("__v", lambda v: v["rule"].isNull()), lambda v: v["line"]), "\n"
            ).alias("clean_text"),
        ),
    )


FACTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    "lost_punctuation", "lost_navigation", "lost_boilerplate",
)


def quality_rules(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: its id and ``FACTS``."""
    only = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return _judged(only, "text", rules).select("doc_id", *[F.col(f"__q.{x}").alias(x) for x in FACTS])


def cleaned_documents(docs: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """The kept documents with failing lines removed; all columns stay, whatever their names, and ``text`` is replaced."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    held = docs.select(row.alias("row"), F.col(f"`{text}`").alias("text"))
    # a filter may not pass a projection with a row number: pushed below, it would make every array anew in every lambda
    q = _judged(held, "text", rules).withColumn("__row", F.monotonically_increasing_id()).where("__q.kept AND __row >= 0")
    return q.select(F.col("row").withField(f"`{text}`", F.col("__q.clean_text")).alias("row")).select("row.*")
