"""Text normalisation, matching and extraction as column expressions."""

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _accents() -> tuple[str, str]:
    """Lower-case Latin letters that are one ASCII letter and a mark, and those letters."""
    pairs = []
    for code in range(0xC0, 0x250):
        c = chr(code)
        base = unicodedata.normalize("NFKD", c)
        if c == c.lower() and len(base) > 1 and base[0].isascii() and all(unicodedata.combining(x) for x in base[1:]):
            pairs.append((c, base[0]))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, PLAIN = _accents()


def fold(x: Column) -> Column:
    """Lower case without accents, for Latin letters; the native form of a compatibility decomposition."""
    return F.translate(F.lower(x), ACCENTED, PLAIN)


@F.pandas_udf(T.StringType())
def fold_any(x: pd.Series) -> pd.Series:
    """``fold`` for every script: compatibility decomposition, marks dropped, lower case."""
    strip = lambda t: "".join(c for c in unicodedata.normalize("NFKD", t.lower()) if not unicodedata.combining(c))
    return x.map(strip, na_action="ignore")


def squeeze(x: Column) -> Column:
    """White space runs to one space, ends trimmed; null to empty."""
    return F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"\s+", " "))


def norm_alnum(x: Column) -> Column:
    """Matching form: folded, everything but a-z and 0-9 to single spaces."""
    return F.trim(F.regexp_replace(fold(F.coalesce(x, F.lit(""))), "[^a-z0-9]+", " "))


def norm_ws(x: Column) -> Column:
    """State form: folded, white space squeezed, punctuation kept."""
    return squeeze(fold(x))


def norm_eval(x: Column) -> Column:
    """Rule form: as ``norm_ws``, with dashes as hyphens."""
    return squeeze(F.translate(fold(x), "–—", "--"))


def scrub(x: Column, patterns: list[str]) -> Column:
    """Removes boilerplate spans, pattern after pattern."""
    for p in patterns:
        x = F.regexp_replace(x, p, " ")
    return squeeze(x)


def assemble(*parts: Column) -> Column:
    """Non-empty parts joined by a space."""
    return F.concat_ws(" ", *[F.nullif(F.coalesce(p, F.lit("")), F.lit("")) for p in parts])


def phrase_hits(x: Column, phrases: list[str]) -> Column:
    """The phrases that ``x`` contains as plain substrings, in list order, distinct."""
    found = F.filter(F.array(*[F.lit(p) for p in phrases]), lambda p: F.contains(x, p))
    return F.array_distinct(found)


def label_hits(x: Column, rules: dict[str, str]) -> Column:
    """Labels whose pattern matches, in the order of the rules."""
    hits = [F.when(x.rlike(p), F.lit(label)) for label, p in rules.items()]
    return F.array_compact(F.array(*hits))


def snippet(x: Column, pattern: str, around: int = 120) -> Column:
    """The first match with ``around`` characters either side; empty without a match."""
    at = F.regexp_instr(x, F.lit(pattern))
    size = F.length(F.regexp_substr(x, F.lit(pattern)))
    start = F.greatest(at - around, F.lit(1))
    return F.when(at > 0, F.substring(x, start, at - start + size + around)).otherwise("")


def near(x: Column, cue: str, subject: str, within: int = 100) -> Column:
    """Whether a cue stands within so many characters of the subject, either side."""
    return x.rlike(f"(?s)(?:{cue}).{{0,{within}}}(?:{subject})|(?:{subject}).{{0,{within}}}(?:{cue})")


def sentences(x: Column) -> Column:
    """Split behind ., !, ? and ; where white space follows."""
    return F.split(x, r"(?<=[.!?;])\s+")


def same_sentence(x: Column, subject: str, cue: str, veto: str) -> Column:
    """Whether some sentence holds subject and cue and no veto."""
    return F.exists(sentences(x), lambda s: s.rlike(subject) & s.rlike(cue) & ~s.rlike(veto))


def signal_count(x: Column, patterns: list[str], first: int) -> Column:
    """How many of the patterns match within the first characters."""
    head = F.substring(x, 1, first)
    return F.aggregate(
        F.array(*[head.rlike(p).cast("int") for p in patterns]), F.lit(0), lambda a, v: a + v
    )


def windows_without(x: Column, subject: str, cue: str, around: int) -> Column:
    """Whether some non-overlapping match of the subject has no cue within ``around`` characters."""
    spans = F.regexp_extract_all(x, F.lit(f"(?s).{{0,{around}}}(?:{subject}).{{0,{around}}}"), F.lit(0))
    return F.exists(spans, lambda s: ~s.rlike(cue))


def subject_title(x: Column, units: str) -> Column:
    """The title before the name of an organisational unit."""
    return F.trim(F.get(F.split(x, rf"(?i),\s*(?:{units})\s+of\b", 2), F.lit(0)))


def relevance_text(x: Column, marker: str, after: int = 250) -> Column:
    """The text up to the first boilerplate marker that starts past ``after`` characters."""
    tail = F.substring(x, after + 1, F.length(x))
    at = F.regexp_instr(tail, F.lit(marker))
    return F.when(at > 0, F.substring(x, F.lit(1), F.lit(after) + at - 1)).otherwise(x)


def tokens(x: Column, patterns: list[str]) -> Column:
    """Sorted distinct matches of several patterns."""
    found = [F.regexp_extract_all(x, F.lit(p), F.lit(0)) for p in patterns]
    return F.array_sort(F.array_distinct(F.flatten(F.array(*found))))


#: What a reference number of a posting looks like, in upper case.
REFERENCES = (
    r"\b\d{2,4}[/-]\d{2,4}(?:[-_/][A-Z0-9]{1,12})+\b",
    r"\b[A-Z]{2,12}\d{2,4}[/-]\d{2,4}(?:[-_/][A-Z0-9]{1,12})*\b",
    r"\b(?:REF(?:ERENCE)?[.: _-]*)[A-Z0-9][A-Z0-9/_-]{3,}\b",
)


def references(title: Column) -> Column:
    """Sorted distinct reference numbers of a title, without white space."""
    found = tokens(F.upper(F.coalesce(title, F.lit(""))), list(REFERENCES))
    return F.array_sort(F.array_distinct(F.transform(found, lambda x: F.regexp_replace(x, r"\s+", ""))))


def words(x: Column) -> Column:
    """Words of normalised text."""
    return F.filter(F.split(x, " "), lambda w: w != "")


def shingles(w: Column, k: int = 5) -> Column:
    """Distinct runs of k words; fewer than k words give none."""
    n = F.size(w)
    each = F.transform(F.sequence(F.lit(1), F.greatest(n - (k - 1), F.lit(1))), lambda i: F.array_join(F.slice(w, i, k), " "))
    return F.when(n >= k, F.array_distinct(each)).otherwise(F.array().cast("array<string>"))


def between_labels(x: Column, label: str, labels: list[str]) -> Column:
    """The text behind a label, up to the next known label or the end."""
    return squeeze(F.regexp_extract(x, rf"(?s){label}\s*:?\s*(.*?)(?:(?:{'|'.join(labels)})|\z)", 1))


def safe_segment(x: Column) -> Column:
    """A path segment: letters, digits, dot, underscore and hyphen."""
    return F.regexp_replace(x, r"[^A-Za-z0-9._-]+", "_")


def cell_text(x: Column) -> Column:
    """A spreadsheet cell that is never read as a formula."""
    return F.when(x.rlike(r"^[=+\-@]"), F.concat(F.lit("'"), x)).otherwise(x)
