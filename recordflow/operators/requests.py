"""Requests for an independent evaluation: allow-listed inputs with ids of their content, a leak check, labels and outcomes.

Ids are digests of canonical JSON: sorted keys, one spelling of separators, nulls as null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow.functions import text

# Versions, statuses, labels and keys that must never reach a prompt.
INPUT_VERSION = "LLM_EVALUATOR_INPUT_V0.1"
DETAIL = ("FULL", "PARTIAL", "UNAVAILABLE", "UNKNOWN")
LABELS = ("RULE_CORRECT", "LLM_CORRECT", "BOTH_REASONABLE", "BOTH_WRONG", "INSUFFICIENT_INFORMATION")
PROHIBITED = ("recommendation", "review_codes", "blocker_codes", "fit_signals", "dimensions", "pre_evaluation_disposition", "role_policy_status")


def json_value(x: Column) -> Column:
    """A string as JSON, null as null."""
    quoted = F.to_json(F.array(x))
    return F.when(x.isNull(), "null").otherwise(F.substring(quoted, F.lit(2), F.length(quoted) - 2))


def json_object(parts: dict[str, Column], item: str = ", ", colon: str = ": ") -> Column:
    """Strings by name as a JSON object with sorted keys; a part may be an object itself if its name ends with *."""
    out = []
    for k in sorted(parts, key=lambda k: k.rstrip("*")):
        value = parts[k] if k.endswith("*") else json_value(parts[k])
        out += [F.lit((item if out else "") + f'"{k.rstrip("*")}"' + colon), value]
    return F.concat(F.lit("{"), *out, F.lit("}"))


def _first(*parts: Column) -> Column:
    return F.coalesce(*[F.nullif(p, F.lit("")) for p in parts])


def _place(location: Column) -> Column:
    parts = [text.squeeze(x) for x in (location["city"], location["region"], _first(location["country_name"], location["country_code"]))]
    return F.concat_ws(", ", *[F.nullif(p, F.lit("")) for p in parts])


def job_id(df: DataFrame) -> Column:
    return F.trim(F.coalesce(_first(F.col("canonical_id"), F.col("source_record_id")), F.lit("")))


def inputs(jobs: DataFrame, profile_version: str) -> DataFrame:
    """(evaluation_id, payload, leaks): one request a job; jobs without an id raise.

    ``jobs`` has canonical_id, source_record_id, structs position, location, contract, description, source, and the texts
    full_text, responsibilities, essential and desirable, already cleaned and cut.  Nothing but what is named here is taken over.
    """
    id_ = job_id(jobs)
    sure = F.assert_true(id_ != "", "a job without an identifier")
    c, loc = F.col, F.col("location")
    status = F.upper(F.coalesce(c("description.detail_status"), F.lit("UNKNOWN")))
    fields = {
        "job_id": id_,
        "title": text.squeeze(c("position.title_raw")),
        "institution": text.squeeze(c("position.institution_raw")),
        "location": _place(loc),
        "country": _first(loc["country_name"], loc["country_code"]),
        "contract_type": _first(c("contract.term_type"), c("position.employment_type")),
        "seniority": c("position.role_level"),
        "detail_status": F.when(status.isin(*DETAIL), status).otherwise("UNKNOWN"),
        "full_text": c("full_text"),
        "responsibilities_text": c("responsibilities"),
        "essential_criteria_text": c("essential"),
        "desirable_criteria_text": c("desirable"),
        "source_url": _first(c("source.detail_url"), c("source.listing_url"), c("source.apply_url")),
    }
    version = F.lit(profile_version)
    seed = json_object({k: fields[k] for k in ("job_id", "full_text", "responsibilities_text", "essential_criteria_text", "desirable_criteria_text")} | {"profile_version": version})
    out = jobs.select(F.substring(F.sha2(seed, 256), 1, 24).alias("evaluation_id"), F.struct(*[v.alias(k) for k, v in fields.items()]).alias("job"), sure.alias("ok")).where("ok IS NULL")
    job = json_object({k: F.col(f"job.{k}") for k in fields})
    payload = json_object({"schema_version": F.lit(INPUT_VERSION), "evaluation_id": F.col("evaluation_id"), "candidate_profile_version": version, "job*": job})
    out = out.select("evaluation_id", F.col("job.job_id").alias("job_id"), payload.alias("payload"))
    return out.withColumn("leaks", leaks(F.col("payload")))


def leaks(payload: Column) -> Column:
    """Prohibited keys that a payload holds, in any place."""
    return F.filter(F.array(*[F.lit(k) for k in PROHIBITED]), lambda k: F.contains(payload, F.concat(F.lit('"'), k, F.lit('"'))))


def triage(jobs: DataFrame, profile_version: str) -> DataFrame:
    """(triage_id, job_id, metadata): what a quick look may see, without the text."""
    c, loc = F.col, F.col("location")
    clean = lambda *x: text.squeeze(_first(*x))
    metadata = json_object({
        "title": clean(c("position.title_raw"), c("position.title_normalized")),
        "institution": clean(c("position.institution_raw"), c("position.institution_normalized")),
        "department": clean(c("position.department")),
        "location": _place(loc),
        "country": _first(loc["country_name"], loc["country_code"]),
        "role_family": c("position.role_family"),
        "role_level": c("position.role_level"),
        "employment_type": c("position.employment_type"),
        "contract_type": c("contract.term_type"),
        "source_url": _first(c("source.detail_url"), c("source.listing_url"), c("source.apply_url")),
    }, ",", ":")
    id_ = job_id(jobs)
    sure = F.assert_true(id_ != "", "a job without an identifier")
    out = jobs.select(id_.alias("job_id"), metadata.alias("metadata"), sure.alias("ok")).where("ok IS NULL")
    seed = json_object({"job_id": c("job_id"), "metadata*": c("metadata"), "candidate_profile_version": F.lit(profile_version)}, ",", ":")
    return out.select(F.substring(F.sha2(seed, 256), 1, 24).alias("triage_id"), "job_id", "metadata")


def labelled(queue: DataFrame, labels: DataFrame) -> DataFrame:
    """``queue`` with human_label and human_notes of ``labels`` (job_id, label, notes); a label that is none raises."""
    name = F.upper(F.trim(F.coalesce("label", F.lit(""))))
    sure = F.assert_true(name.isin(*LABELS), F.concat(F.lit("invalid human review label: "), F.coalesce("label", F.lit(""))))
    own = labels.select("job_id", name.alias("human_label"), F.col("notes").alias("human_notes"), sure.alias("ok")).where("ok IS NULL").drop("ok")
    return queue.join(own, "job_id", "left")


def outcomes(worklist: DataFrame, results: DataFrame) -> DataFrame:
    """(job_id, outcome, detail): every job that was to be evaluated is EVALUATED, FAILED with its error, or MISSING."""
    met = worklist.select("job_id").join(results.select("job_id", "decision", "error"), "job_id", "left")
    failed = F.coalesce("error", F.lit("")) != ""
    outcome = F.when(failed, "FAILED").when(F.col("decision").isNotNull(), "EVALUATED").otherwise("MISSING")
    return met.select("job_id", outcome.alias("outcome"), F.when(failed, F.col("error")).otherwise(F.col("decision")).alias("detail"))
