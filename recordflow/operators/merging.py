"""Merging the observations of one posting into one record.

The anchor, the observation of the best kind of source, gives the identity and every value that it has.  What it lacks comes
from the observations in order of quality: a resolved detail first, then the longer one, then more metadata, then the earlier
observation.  Every value is one aggregate, so a cluster is never collected but for its lists of codes and observations.

Observations carry ``obs_ord`` (their order) and the structs named in ``FIELDS``, with ``source``, ``description``,
``requirements``, ``classification`` and ``provenance``.  Null, empty and ``UNKNOWN`` values are missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow.functions import text

# Kinds of sources, best first; fields that are filled; what counts as metadata.
SOURCE_KINDS = ("DIRECT_INSTITUTION", "NATIONAL_PORTAL", "ATS", "THEMATIC_PORTAL", "SHARED_AGGREGATOR", "LINKEDIN")
OTHER_KIND = 99
FIELDS = {
    "position": ("title_normalized", "institution_raw", "institution_normalized", "department", "role_family", "role_level", "employment_type", "workplace_mode"),
    "location": ("country_code", "country_name", "city", "region"),
    "dates": ("posted_at", "deadline_at", "deadline_text", "deadline_status", "collected_at"),
    "contract": ("term_type", "duration_months", "fte"),
    "requirements": ("phd_requirement", "degree_text", "years_postdoc", "work_rights_text", "sponsorship_text", "professional_registration_text", "teaching_requirement_text"),
    "classification": ("market_tier", "role_policy_status"),
}
LISTS = ("degree_fields", "methods_required", "methods_preferred", "language_requirements")
METADATA = {
    "position": ("institution_raw", "department", "role_family", "role_level"),
    "location": ("country_code", "city"),
    "dates": ("deadline_at", "deadline_text"),
    "contract": ("term_type", "duration_months", "fte"),
}
GOOD_DETAIL = ("FULL", "PARTIAL")


def _has(df: DataFrame, path: str) -> bool:
    struct, _, name = path.partition(".")
    return struct in df.columns and name in df.schema[struct].dataType.fieldNames()


def _missing(c: Column) -> Column:
    return c.isNull() | c.cast("string").isin("", "UNKNOWN")


def resolved() -> Column:
    d = F.col("description")
    return F.coalesce(F.upper(d["detail_status"]).isin(*GOOD_DETAIL), F.lit(False)) & (F.trim(F.coalesce(d["full_jd"], F.lit(""))) != "")


def quality(df: DataFrame) -> Column:
    """(resolved, length of the detail, metadata that is there): comparable, more is better."""
    there = [f"{s}.{c}" for s, names in METADATA.items() for c in names if _has(df, f"{s}.{c}")]
    n = F.lit(0)
    for path in there:
        n = n + (~_missing(F.col(path))).cast("int")
    size = F.length(F.trim(F.coalesce(F.col("description.full_jd"), F.lit(""))))
    return F.struct(resolved().cast("int").alias("resolved"), size.alias("size"), n.alias("metadata"))


def anchor_rank(df: DataFrame) -> Column:
    """Kind of source, then source, its id and the record's id in matching form, then the order of observation."""
    kind = F.upper(F.coalesce(F.col("source.source_kind"), F.lit("")))
    place = F.lit(OTHER_KIND)
    for i, k in enumerate(SOURCE_KINDS):
        place = F.when(kind == k, i).otherwise(place)
    record = F.col("source_record_id") if "source_record_id" in df.columns else F.lit("")
    keys = (F.col("source.source_key"), F.col("source.source_job_id").cast("string"), record)
    return F.struct(place.alias("kind"), *[text.norm_alnum(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col("obs_ord").alias("ord"))


def canonical_id(key: Column, job: Column, record: Column) -> Column:
    """A digest of the anchor's id at its source, or of its record where it has none."""
    k = F.replace(text.norm_alnum(key), F.lit(" "), F.lit("_"))
    low = lambda x: F.lower(F.trim(F.coalesce(x.cast("string"), F.lit(""))))
    by_job = (k != "") & (low(job) != "")
    seed = F.when(by_job, F.concat(F.lit("source_id:"), k, F.lit(":"), low(job))).otherwise(F.concat(F.lit("source_record:"), k, F.lit(":"), low(record)))
    return F.concat(F.lit("vac_"), F.substring(F.sha1(seed), 1, 20))


def _in_order(values: Column, by: Column) -> Column:
    """The elements of arrays, array after array in the order of ``by``, each once."""
    rows = F.sort_array(F.collect_list(F.struct(by.alias("by"), values.alias("values"))))
    return F.array_distinct(F.flatten(F.transform(rows, lambda x: x["values"])))


def merged(obs: DataFrame, assigned: DataFrame) -> DataFrame:
    """One record a cluster of ``assigned`` (obs_ord, cluster)."""
    q = quality(obs)
    first = -F.col("obs_ord")
    rank = F.struct(q.alias("q"), first.alias("first"))  # the most of equal quality is the earliest
    df = obs.join(assigned, "obs_ord").withColumns({"__q": q, "__rank": rank, "__anchor": anchor_rank(obs)})
    record = F.col("source_record_id") if "source_record_id" in obs.columns else F.lit("")
    low = F.struct((-F.col("__q.resolved")).alias("a"), (-F.col("__q.size")).alias("b"), (-F.col("__q.metadata")).alias("c"), F.col("obs_ord").alias("d"))
    of_anchor = lambda c: F.min_by(c, F.col("__anchor"))
    of_best = lambda c: F.max_by(c, F.col("__rank"))
    none = F.array().cast("array<string>")
    aggregates = {
        "anchor": of_anchor(F.struct("obs_ord", "source", "description", record.alias("record"), F.col("position.title_raw").alias("title_raw"), F.col("__q").alias("q"))),
        "best": of_best(F.struct("source", "description", F.col("__q").alias("q"), resolved().alias("resolved"))),
        "deadline": F.min(F.nullif(F.col("dates.deadline_at").cast("string"), F.lit(""))),
        "statuses": F.count_distinct(F.coalesce(F.nullif(F.col("source.source_status"), F.lit("")), F.lit("UNKNOWN"))),
        "members": F.count("*"),
        "blockers": _in_order(F.coalesce("classification.blocker_codes", none), F.col("obs_ord")),
        "reviews": _in_order(F.coalesce("classification.review_codes", none), F.col("obs_ord")),
        "observed": _in_order(
            F.filter(F.coalesce(F.when(F.size("provenance.observed_by_sources") > 0, F.col("provenance.observed_by_sources")), F.array("source.source_key")), lambda x: F.coalesce(x, F.lit("")) != ""),
            F.col("obs_ord"),
        ),
        "notes": _in_order(F.coalesce("provenance.notes", none), F.col("obs_ord")),
        "observations": F.sort_array(F.collect_list(F.struct("obs_ord", F.col("source.source_key").alias("source_key"), F.col("source.source_kind").alias("source_kind"), F.col("source.source_job_id").alias("source_job_id"), F.col("source.source_status").alias("source_status"), F.col("description.detail_status").alias("detail_status")))),
    }
    fields = [(s, c) for s, names in FIELDS.items() for c in names if _has(obs, f"{s}.{c}")]
    lists = [c for c in LISTS if _has(obs, f"requirements.{c}")]
    for s, c in fields:
        x = F.col(f"{s}.{c}")
        aggregates[f"a_{s}_{c}"] = of_anchor(F.struct(x.alias("x")))["x"]
        # what the classification lacks comes from the best observation alone
        aggregates[f"b_{s}_{c}"] = of_best(F.struct(x.alias("x")))["x"] if s == "classification" else F.max_by(x, F.when(~_missing(x), F.col("__rank")))
    for c in lists:
        x = F.col(f"requirements.{c}")
        empty = F.array().cast(obs.schema["requirements"].dataType[c].dataType)
        aggregates[f"a_{c}"], aggregates[f"b_{c}"] = of_anchor(F.struct(F.coalesce(x, empty).alias("x")))["x"], _in_order(F.coalesce(x, empty), low)
    got = df.groupBy("cluster").agg(*[v.alias(k) for k, v in aggregates.items()])
    value = lambda s, c: F.when(_missing(F.col(f"a_{s}_{c}")), F.coalesce(f"b_{s}_{c}", f"a_{s}_{c}")).otherwise(F.col(f"a_{s}_{c}"))
    better = F.col("best.q") > F.col("anchor.q")
    reviews = F.when(F.col("best.resolved"), F.filter("reviews", lambda c: ~F.upper(c).rlike("DETAIL|FULL_JD"))).otherwise(F.col("reviews"))
    known = F.col("deadline").isNotNull()

    def struct(s: str) -> Column:
        out = {c: value(s, c) for x, c in fields if x == s}
        if s == "position":
            out = {"title_raw": F.col("anchor.title_raw"), **out}
        if s == "dates":
            out |= {"deadline_at": F.when(known, F.col("deadline")).otherwise(out["deadline_at"]), "deadline_status": F.when(known, "KNOWN").otherwise(out["deadline_status"])}
        if s == "requirements":
            out |= {c: F.array_distinct(F.concat(f"a_{c}", f"b_{c}")) for c in lists}
        if s == "classification":
            out |= {"blocker_codes": F.col("blockers"), "review_codes": reviews, "pre_evaluation_disposition": disposition}
        return F.struct(*[v.alias(k) for k, v in out.items()]).alias(s)

    disposition = (
        F.when(F.size("blockers") > 0, "POLICY_SKIP")
        .when(~F.col("best.resolved"), "NEEDS_DETAIL_REVIEW")
        .when(F.size(reviews) > 0, "POLICY_REVIEW")
        .otherwise("ELIGIBLE_FOR_EVALUATION")
    )
    a = F.col("anchor")
    note = F.concat(F.lit("Stage 10 central canonicalization clustered "), F.col("members").cast("string"), F.lit(" source observation(s)."))
    observed = F.when(F.size("observed") > 0, F.col("observed")).otherwise(F.array(F.coalesce(F.nullif(a["source"]["source_key"], F.lit("")), F.lit("unknown"))))
    return got.select(
        "cluster",
        canonical_id(a["source"]["source_key"], a["source"]["source_job_id"], a["record"]).alias("canonical_id"),
        a["obs_ord"].alias("anchor"),
        a["source"].alias("source"),
        F.when(better, F.col("best.description")).otherwise(a["description"]).alias("description"),
        *[struct(s) for s in dict.fromkeys([*[x for x, _ in fields], "classification"])],
        F.struct(observed.alias("observed_by_sources"), F.concat("notes", F.array(note)).alias("notes")).alias("provenance"),
        F.struct(
            a["source"]["source_key"].alias("anchor_source_key"), a["source"]["source_job_id"].alias("anchor_source_job_id"), F.col("best.source.source_key").alias("trusted_detail_source_key"),
            F.transform("observations", lambda x: x.dropFields("obs_ord")).alias("source_observations"), (F.col("statuses") > 1).alias("source_status_conflict"),
        ).alias("canonicalization"),
        "members",
    )
