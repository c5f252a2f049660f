"""Merging exact copies as observations of one posting; fields are derived so that some are missing on either side."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordflow.operators import merging

from .adapters import table
from .registry import query
from .scalars import ALNUM

_CODES = ["ROLE_STUDENT", "FULL_JD_UNAVAILABLE", "DETAIL_PARTIAL", "VISA_AMBIGUOUS"]


def _pick(values, n):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("doc_id") % n % len(values) + 1).cast("int"))


def observations(spark, sf_dir):
    i, lit = F.col("doc_id").cast("string"), F.lit
    none = F.array().cast("array<string>")
    when = lambda n, r, a, b: F.when(F.col("doc_id") % n == r, a).otherwise(b)
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("obs_ord"),
        F.concat(lit("r"), i).alias("source_record_id"),
        F.struct(F.col("source").alias("source_key"), _pick([*merging.SOURCE_KINDS, "OTHER"], 7).alias("source_kind"), when(9, 0, lit(""), i).alias("source_job_id"), when(4, 0, "CLOSED", "OPEN").alias("source_status")).alias("source"),
        F.struct(F.concat(lit("Title "), i).alias("title_raw"), when(3, 0, lit("Institute A"), when(3, 1, lit("UNKNOWN"), lit(None))).alias("institution_raw"), when(2, 0, lit("Dept"), lit("")).alias("department"), when(5, 0, "LECTURER", "UNKNOWN").alias("role_family")).alias("position"),
        F.struct(F.upper("lang").alias("country_code"), when(4, 1, lit("Köln"), lit(None)).alias("city")).alias("location"),
        F.struct(when(6, 1, lit("2026-05-01"), when(6, 2, lit("2026-03-01"), lit(""))).alias("deadline_at"), lit("UNKNOWN").alias("deadline_status")).alias("dates"),
        F.struct(when(5, 1, lit(12.0), lit(None)).alias("duration_months"), when(5, 2, "FIXED_TERM", "UNKNOWN").alias("term_type")).alias("contract"),
        F.struct(when(4, 2, "FETCH_FAILED", "FULL").alias("detail_status"), when(8, 3, F.concat("text", lit(" more")), F.col("text")).alias("full_jd")).alias("description"),
        F.struct(when(7, 3, lit("PhD"), lit(None)).alias("degree_text"), when(2, 0, F.array(lit("m1"), F.concat(lit("m"), (F.col("doc_id") % 5).cast("string"))), none).alias("methods_required")).alias("requirements"),
        F.struct(when(11, 0, F.array(lit(_CODES[0])), none).alias("blocker_codes"), when(2, 1, F.array(_pick(_CODES[1:], 3), lit(_CODES[1])), none).alias("review_codes"), when(3, 2, "CORE", "UNKNOWN").alias("market_tier")).alias("classification"),
        F.struct(when(10, 4, F.array(lit("relay"), F.col("source")), none).alias("observed_by_sources"), when(4, 3, F.array(lit("note")), none).alias("notes")).alias("provenance"),
    )


def merged(spark, sf_dir):
    obs = observations(spark, sf_dir)
    body = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("obs_ord"), F.sha2("text", 256).alias("h"))
    first = body.groupBy("h").agg(F.min("obs_ord").alias("cluster"))
    return merging.merged(obs, body.join(first, "h").select("obs_ord", "cluster"))


_KINDS = [*merging.SOURCE_KINDS, "OTHER"]
_FILL = lambda c: f"CASE WHEN coalesce(arg_min({{'x': {c}}}, a).x::VARCHAR, '') IN ('', 'UNKNOWN') THEN coalesce(arg_min({c}, low) FILTER (coalesce({c}::VARCHAR, '') NOT IN ('', 'UNKNOWN')), arg_min({{'x': {c}}}, a).x) ELSE arg_min({{'x': {c}}}, a).x END"
_DISTINCT = lambda x: f"list_filter({x}, lambda v, i: list_position({x}, v) = i)"
MERGED = f"""o AS (SELECT doc_id, text, min(doc_id) OVER (PARTITION BY text) AS cluster, source, CASE WHEN doc_id % 9 = 0 THEN '' ELSE doc_id::VARCHAR END AS job, doc_id % 7 % 7 AS kind,
    CASE WHEN doc_id % 4 = 0 THEN 'CLOSED' ELSE 'OPEN' END AS status, CASE doc_id % 3 WHEN 0 THEN 'Institute A' WHEN 1 THEN 'UNKNOWN' END AS institution, CASE WHEN doc_id % 2 = 0 THEN 'Dept' ELSE '' END AS department,
    CASE WHEN doc_id % 5 = 0 THEN 'LECTURER' ELSE 'UNKNOWN' END AS family, upper(lang) AS country, CASE WHEN doc_id % 4 = 1 THEN 'Köln' END AS city, CASE doc_id % 6 WHEN 1 THEN '2026-05-01' WHEN 2 THEN '2026-03-01' ELSE '' END AS deadline,
    CASE WHEN doc_id % 5 = 1 THEN 12.0::DOUBLE END AS months, CASE WHEN doc_id % 5 = 2 THEN 'FIXED_TERM' ELSE 'UNKNOWN' END AS term, doc_id % 4 <> 2 AS full_, CASE WHEN doc_id % 8 = 3 THEN text || ' more' ELSE text END AS jd,
    CASE WHEN doc_id % 7 = 3 THEN 'PhD' END AS degree, CASE WHEN doc_id % 2 = 0 THEN ['m1', 'm' || (doc_id % 5)] ELSE []::VARCHAR[] END AS methods,
    CASE WHEN doc_id % 11 = 0 THEN ['{_CODES[0]}'] ELSE []::VARCHAR[] END AS blockers, CASE WHEN doc_id % 2 = 1 THEN [{_CODES[1:]!r}[doc_id % 3 + 1], '{_CODES[1]}'] ELSE []::VARCHAR[] END AS reviews, CASE WHEN doc_id % 3 = 2 THEN 'CORE' ELSE 'UNKNOWN' END AS tier,
    CASE WHEN doc_id % 10 = 4 THEN ['relay', source] ELSE [source] END AS observed, CASE WHEN doc_id % 4 = 3 THEN ['note'] ELSE []::VARCHAR[] END AS notes FROM documents),
  p AS (SELECT *, full_ AND trim(jd) <> '' AS resolved, length(trim(jd)) AS size,
    (coalesce(institution, '') NOT IN ('', 'UNKNOWN'))::INT + (department <> '')::INT + (family <> 'UNKNOWN')::INT + (country <> '')::INT + (city IS NOT NULL)::INT + (deadline <> '')::INT + (term <> 'UNKNOWN')::INT + (months IS NOT NULL)::INT AS meta FROM o),
  q AS (SELECT *, (CASE WHEN kind = 6 THEN 99 ELSE kind END, {ALNUM.format(x='source')}, job, 'r' || doc_id, doc_id) AS a, (-(resolved::INT), -size, -meta, doc_id) AS low, (-(resolved::INT), -size, -meta) AS qual FROM p),
  m AS (SELECT cluster, count(*) AS members, arg_min(doc_id, a) AS anchor, arg_min(source, a) AS source_key, arg_min(job, a) AS job, arg_min(jd, a) AS a_jd, arg_min(qual, a) AS a_qual, arg_min(jd, low) AS b_jd, min(qual) AS b_qual, arg_min(source, low) AS best_source, arg_min(resolved, low) AS best_resolved,
    {_FILL('institution')} AS institution, {_FILL('department')} AS department, {_FILL('family')} AS family, {_FILL('city')} AS city, {_FILL('months')} AS months, {_FILL('term')} AS term, {_FILL('degree')} AS degree,
    CASE WHEN arg_min(tier, a) = 'UNKNOWN' THEN arg_min(tier, low) ELSE arg_min(tier, a) END AS tier, min(nullif(deadline, '')) AS deadline,
    arg_min(methods, a) || flatten(list(methods ORDER BY low)) AS methods, flatten(list(blockers ORDER BY doc_id)) AS blockers, flatten(list(reviews ORDER BY doc_id)) AS reviews, flatten(list(observed ORDER BY doc_id)) AS observed, flatten(list(notes ORDER BY doc_id)) AS notes, count(DISTINCT status) > 1 AS conflict FROM q GROUP BY cluster),
  n AS (SELECT * REPLACE (CASE WHEN best_resolved THEN list_filter(reviews, lambda c: NOT contains(c, 'DETAIL') AND NOT contains(c, 'FULL_JD')) ELSE reviews END AS reviews) FROM m)"""


def _sql(columns):
    return f"WITH {MERGED} SELECT cluster, {columns} FROM n"


@query("merge_anchor", _sql(f"""anchor, source_key, 'vac_' || left(sha1(CASE WHEN job <> '' THEN 'source_id:' || replace({ALNUM.format(x='source_key')}, ' ', '_') || ':' || job ELSE 'source_record:' || replace({ALNUM.format(x='source_key')}, ' ', '_') || ':r' || anchor END), 20) AS canonical_id, members"""))
def merge_anchor(spark, sf_dir):
    return merged(spark, sf_dir).select("cluster", "anchor", F.col("source.source_key").alias("source_key"), "canonical_id", "members")


@query("merge_quality", _sql("sha256(CASE WHEN b_qual < a_qual THEN b_jd ELSE a_jd END) AS detail, best_source"))
def merge_quality(spark, sf_dir):
    return merged(spark, sf_dir).select("cluster", F.sha2("description.full_jd", 256).alias("detail"), F.col("canonicalization.trusted_detail_source_key").alias("best_source"))


@query("merge_fields", _sql("institution, department, family, city, months, term, degree"))
def merge_fields(spark, sf_dir):
    p = lambda path, name: F.col(path).alias(name)
    return merged(spark, sf_dir).select(
        "cluster", p("position.institution_raw", "institution"), p("position.department", "department"), p("position.role_family", "family"), p("location.city", "city"),
        p("contract.duration_months", "months"), p("contract.term_type", "term"), p("requirements.degree_text", "degree"),
    )


@query("merge_deadline", _sql("coalesce(deadline, '') AS deadline_at, CASE WHEN deadline IS NULL THEN 'UNKNOWN' ELSE 'KNOWN' END AS deadline_status"))
def merge_deadline(spark, sf_dir):
    return merged(spark, sf_dir).select("cluster", F.coalesce("dates.deadline_at", F.lit("")).alias("deadline_at"), F.col("dates.deadline_status").alias("deadline_status"))


@query("merge_requirements", _sql(f"array_to_string({_DISTINCT('methods')}, ',') AS methods"))
def merge_requirements(spark, sf_dir):
    return merged(spark, sf_dir).select("cluster", F.array_join("requirements.methods_required", ",").alias("methods"))


@query(
    "merge_classification",
    _sql(f"array_to_string({_DISTINCT('blockers')}, ',') AS blocker_codes, array_to_string({_DISTINCT('reviews')}, ',') AS review_codes, tier, CASE WHEN len(blockers) > 0 THEN 'POLICY_SKIP' WHEN NOT best_resolved THEN 'NEEDS_DETAIL_REVIEW' WHEN len(reviews) > 0 THEN 'POLICY_REVIEW' ELSE 'ELIGIBLE_FOR_EVALUATION' END AS disposition"),
)
def merge_classification(spark, sf_dir):
    c = F.col("classification")
    return merged(spark, sf_dir).select("cluster", F.array_join(c["blocker_codes"], ",").alias("blocker_codes"), F.array_join(c["review_codes"], ",").alias("review_codes"), c["market_tier"].alias("tier"), c["pre_evaluation_disposition"].alias("disposition"))


@query("merge_provenance", _sql(f"array_to_string({_DISTINCT('observed')}, ',') AS observed, array_to_string({_DISTINCT('notes')} || ['Stage 10 central canonicalization clustered ' || members || ' source observation(s).'], ',') AS notes, members AS observations, conflict"))
def merge_provenance(spark, sf_dir):
    p = F.col("provenance")
    return merged(spark, sf_dir).select(
        "cluster", F.array_join(p["observed_by_sources"], ",").alias("observed"), F.array_join(p["notes"], ",").alias("notes"),
        F.size("canonicalization.source_observations").cast("long").alias("observations"), F.col("canonicalization.source_status_conflict").alias("conflict"),
    )
