"""Requests, triage, labels and outcomes over documents as jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordflow.operators import requests

from .adapters import table
from .registry import query
from .reporting import _pick, _pick_sql

_CITY, _REGION, _NAME = ["Köln", "", None], ["", "R\"1"], ["Spain", None, ""]
_TERM, _LEVEL, _STATUS, _URL = ["FIXED", None, ""], ["SENIOR", None], ["full", "odd", "PARTIAL", None], [None, "http://a", ""]


def jobs(spark, sf_dir):
    i = F.col("doc_id").cast("string")
    return table(spark, sf_dir, "documents").select(
        F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("c"), i)).alias("canonical_id"), F.concat(F.lit("r"), i).alias("source_record_id"),
        F.struct(F.concat(F.lit(" T  "), "source").alias("title_raw"), F.lit("").alias("title_normalized"), _pick(["I\tJ", None]).alias("institution_raw"), F.lit("N").alias("institution_normalized"), F.lit(None).cast("string").alias("department"), F.lit("X").alias("role_family"), _pick(_LEVEL).alias("role_level"), F.lit("E").alias("employment_type")).alias("position"),
        F.struct(_pick(_CITY).alias("city"), _pick(_REGION, 3).alias("region"), _pick(_NAME, 2).alias("country_name"), F.upper("lang").alias("country_code")).alias("location"),
        F.struct(_pick(_TERM).alias("term_type")).alias("contract"), F.struct(_pick(_STATUS).alias("detail_status")).alias("description"),
        F.struct(_pick(_URL).alias("detail_url"), _pick(_URL, 2).alias("listing_url"), F.lit("http://z").alias("apply_url")).alias("source"),
        F.regexp_replace("text", "[^ -~]", "").alias("full_text"), F.when(F.col("doc_id") % 4 == 0, "do").alias("responsibilities"),
        F.when(F.col("doc_id") % 50 == 1, 'see "dimensions"').when(F.col("doc_id") % 5 == 0, "must").alias("essential"), F.lit(None).cast("string").alias("desirable"),
    )


_J = lambda x: f"CASE WHEN {x} IS NULL THEN 'null' ELSE to_json({x})::VARCHAR END"
_OR = lambda *x: "coalesce(" + ", ".join(f"nullif({v}, '')" for v in x) + ")"
_JOBS = f"""j AS (SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN 'c' || doc_id ELSE 'r' || doc_id END AS job_id, 'T ' || source AS title, {_pick_sql(['I J', ''])} AS institution, {_pick_sql(['I J', 'N'])} AS any_institution,
    concat_ws(', ', {_OR(_pick_sql(_CITY))}, {_OR(_pick_sql(_REGION, 3))}, {_OR(_pick_sql(_NAME, 2), 'upper(lang)')}) AS place, {_OR(_pick_sql(_NAME, 2), 'upper(lang)')} AS country, {_OR(_pick_sql(_TERM), "'E'")} AS contract, {_pick_sql(_TERM)} AS term, {_pick_sql(_LEVEL)} AS seniority,
    CASE WHEN upper({_pick_sql(_STATUS)}) IN ('FULL', 'PARTIAL') THEN upper({_pick_sql(_STATUS)}) ELSE 'UNKNOWN' END AS status, regexp_replace(text, '[^ -~]', '', 'g') AS body, CASE WHEN doc_id % 4 = 0 THEN 'do' END AS resp, CASE WHEN doc_id % 50 = 1 THEN 'see "dimensions"' WHEN doc_id % 5 = 0 THEN 'must' END AS ess, {_OR(_pick_sql(_URL), _pick_sql(_URL, 2), "'http://z'")} AS url FROM documents),
  k AS (SELECT *, left(sha256('{{"desirable_criteria_text": null, "essential_criteria_text": ' || {_J('ess')} || ', "full_text": ' || {_J('body')} || ', "job_id": ' || {_J('job_id')} || ', "profile_version": "p1", "responsibilities_text": ' || {_J('resp')} || '}}'), 24) AS evaluation_id FROM j)"""


@query(
    "evaluation_inputs",
    f"""WITH {_JOBS} SELECT evaluation_id, job_id, sha256('{{"candidate_profile_version": "p1", "evaluation_id": ' || {_J('evaluation_id')} || ', "job": {{"contract_type": ' || {_J('contract')} || ', "country": ' || {_J('country')} || ', "desirable_criteria_text": null, "detail_status": ' || {_J('status')} || ', "essential_criteria_text": ' || {_J('ess')} || ', "full_text": ' || {_J('body')}
    || ', "institution": ' || {_J('institution')} || ', "job_id": ' || {_J('job_id')} || ', "location": ' || {_J('place')} || ', "responsibilities_text": ' || {_J('resp')} || ', "seniority": ' || {_J('seniority')} || ', "source_url": ' || {_J('url')} || ', "title": ' || {_J('title')} || '}}, "schema_version": "LLM_EVALUATOR_INPUT_V0.1"}}') AS payload, 0::BIGINT AS leaks FROM k""",
)
def evaluation_inputs(spark, sf_dir):
    """A key that is named within a text is quoted there, so it is no leak."""
    return requests.inputs(jobs(spark, sf_dir), "p1").select("evaluation_id", "job_id", F.sha2("payload", 256).alias("payload"), F.size("leaks").cast("long").alias("leaks"))


@query(
    "triage_inputs",
    f"""WITH {_JOBS}, m AS (SELECT job_id, '{{"contract_type":' || {_J('term')} || ',"country":' || {_J('country')} || ',"department":"","employment_type":"E","institution":' || {_J('any_institution')} || ',"location":' || {_J('place')} || ',"role_family":"X","role_level":' || {_J('seniority')} || ',"source_url":' || {_J('url')} || ',"title":' || {_J('title')} || '}}' AS metadata FROM j)
    SELECT left(sha256('{{"candidate_profile_version":"p1","job_id":' || {_J('job_id')} || ',"metadata":' || metadata || '}}'), 24) AS triage_id, job_id, metadata FROM m""",
)
def triage_inputs(spark, sf_dir):
    return requests.triage(jobs(spark, sf_dir), "p1")


@query("human_labels", "SELECT doc_id AS job_id, CASE WHEN doc_id % 3 = 0 THEN 'BOTH_WRONG' WHEN doc_id % 3 = 1 THEN 'LLM_CORRECT' END AS human_label, CASE WHEN doc_id % 3 = 0 THEN 'n' END AS human_notes FROM documents")
def human_labels(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("job_id"))
    n = F.col("job_id") % 3
    labels = d.where(n < 2).select("job_id", F.when(n == 0, " both_wrong").otherwise("LLM_correct").alias("label"), F.when(n == 0, "n").alias("notes"))
    return requests.labelled(d, labels)


@query("evaluation_outcomes", "SELECT doc_id AS job_id, CASE doc_id % 4 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'MISSING' ELSE 'EVALUATED' END AS outcome, CASE doc_id % 4 WHEN 0 THEN 'timeout' WHEN 1 THEN NULL WHEN 2 THEN 'APPLY' ELSE 'SKIP' END AS detail FROM documents")
def evaluation_outcomes(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("job_id"))
    n = F.col("job_id") % 4
    results = d.where(n != 1).select("job_id", F.when(n == 2, "APPLY").when(n == 3, "SKIP").alias("decision"), F.when(n == 0, "timeout").otherwise("").alias("error"))
    return requests.outcomes(d, results)
