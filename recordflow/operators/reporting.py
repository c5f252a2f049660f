"""Reports over evaluated records: flat rows, cleaned names, sections, summaries, and inventories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recordflow.functions import text

from .shadow import rank

# Statuses and orders of the reports.
ACTIONABLE = ("STRONG_APPLY", "APPLY")
FAVORABLE = ("STRONG_APPLY", "APPLY", "REVIEW")
CHANGE_EVENTS = ("NEW", "MATERIALLY_CHANGED", "REOPENED")
RECOMMENDATIONS = ("STRONG_APPLY", "APPLY", "REVIEW", "LOW_PRIORITY", "SKIP")
INSTITUTION_PATTERNS = (
    r"(?is)Organisation/Company\s+(.+?)(?=\s+(?:Department|Research Field|Researcher Profile|Positions|Application Deadline)\b)",
    r"(?is)Company/Institute\s+(.+?)(?=\s+(?:Country|City|Contact|Website|E-Mail|Phone|STATUS:)\b)",
)
CITY_PATTERN = r"(?is)\bCity\s+(.+?)(?=\s+(?:Contact|Postal|Website|E-Mail|Phone|STATUS:)\b)"
NOISY_NAMES = ("EURAXESS", "Jobs & Opportunities", "ERA Talent Platform")
LONGEST_NAME, LONGEST_CITY = 120, 60
RULE_RANK = {"SKIP": 0, "LOW_PRIORITY": 1, "REVIEW": 2, "APPLY": 3, "STRONG_APPLY": 4}
LLM_RANK = {"SKIP": 0, "REVIEW": 2, "APPLY": 3, "STRONG_APPLY": 4}
DECISION_ORDER = {"STRONG_APPLY": 0, "APPLY": 1, "REVIEW": 2}
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def _first(*parts: Column) -> Column:
    """The first part that is neither null nor empty, else empty."""
    return F.coalesce(*[F.nullif(p.cast("string"), F.lit("")) for p in parts], F.lit(""))


def _listed(x: Column) -> Column:
    return F.array_join(F.filter(F.coalesce(x, F.array().cast("array<string>")), lambda v: F.trim(v) != ""), ", ")


def flat(records: DataFrame) -> DataFrame:
    """The 34 columns of a report row from structs source, position, location, dates, description, evaluation and state."""
    c = F.col
    dims = {n: _first(c(f"evaluation.dimensions.{n}")) for n in ("scientific", "level", "methods", "language", "mobility", "registration")}
    status = F.upper(_first(c("source.source_status"), F.lit("UNKNOWN")))
    columns = {
        "canonical_id": _first(c("canonical_id")),
        "source_record_id": _first(c("source_record_id")),
        "recommendation": F.upper(_first(c("evaluation.recommendation"), F.lit("REVIEW"))),
        "pre_evaluation_disposition": F.upper(_first(c("evaluation.pre_evaluation_disposition"))),
        "seen_status": F.upper(_first(c("state.seen_status"))),
        "quality_events": _listed(c("state.quality_events")),
        "change_reasons": _listed(c("state.change_reasons")),
        "title": _first(c("position.title_raw"), c("position.title_normalized")),
        "institution": _first(c("position.institution_raw"), c("position.institution_normalized")),
        "department": _first(c("position.department")),
        "country": _first(c("location.country_name"), c("location.country_code")),
        "country_code": F.upper(_first(c("location.country_code"))),
        "city": _first(c("location.city")),
        "role_family": _first(c("evaluation.role_family"), c("position.role_family")),
        "role_level": _first(c("position.role_level")),
        **dims,
        "contract_fit": _first(c("evaluation.dimensions.contract")),
        "deadline": _first(c("dates.deadline_at"), c("dates.deadline_text")),
        "deadline_status": F.upper(_first(c("dates.deadline_status"), F.lit("UNKNOWN"))),
        "detail_status": F.upper(_first(c("description.detail_status"), F.lit("NOT_ATTEMPTED"))),
        "source": _first(c("source.provider"), c("source.source_key")),
        "source_key": _first(c("source.source_key")),
        "source_status": status,
        "lifecycle_status": F.upper(_first(c("state.lifecycle_status"), status)),
        "review_codes": _listed(c("evaluation.review_codes")),
        "blocker_codes": _listed(c("evaluation.blocker_codes")),
        "fit_signals": _listed(c("evaluation.fit_signals")),
        "reason": _first(c("evaluation.reason")),
        "url": _first(c("source.apply_url"), c("source.detail_url"), c("source.listing_url")),
    }
    return records.select(*[v.alias(k) for k, v in columns.items()])


def clean_institution(normalized: Column, raw: Column, body: Column) -> Column:
    """A short name as it is, else the one that the body labels, else empty."""
    n, r, b = text.squeeze(normalized), text.squeeze(raw), F.coalesce(body, F.lit(""))
    noisy = F.length(r) > LONGEST_NAME
    for mark in NOISY_NAMES:
        noisy = noisy | F.contains(r, F.lit(mark))
    out = F.lit("")
    for p in reversed(INSTITUTION_PATTERNS):
        found = text.squeeze(F.regexp_extract(b, p, 1))
        out = F.when(F.length(found).between(2, LONGEST_NAME), found).otherwise(out)
    return F.when((n != "") & (F.length(n) <= LONGEST_NAME), n).when((r != "") & ~noisy, r).otherwise(out)


def clean_city(city: Column, body: Column) -> Column:
    """The known city, else the one behind the last label of work locations in the body, else empty."""
    direct, b = text.squeeze(city), F.coalesce(body, F.lit(""))
    label = "Work Location(s)"
    found = text.squeeze(F.regexp_extract(F.substring_index(b, label, -1), CITY_PATTERN, 1))
    good = F.contains(b, F.lit(label)) & F.length(found).between(1, LONGEST_CITY)
    return F.when(direct != "", direct).when(good, found).otherwise("")


def parsed_deadline(x: Column) -> Column:
    """The day of a deadline as yyyy-MM-dd: an ISO time, an ISO day within text, a named month, day/month/year; else empty."""
    t = text.squeeze(x)
    whole = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:\d{2})?)?$"), F.try_to_date(F.substring(t, 1, 10), "yyyy-MM-dd"))
    inside = F.nullif(F.regexp_extract(t, r"\b(20\d{2}-\d{2}-\d{2})\b", 1), F.lit(""))
    p = r"(?i)\b(\d{1,2})(?:\s*(?:st|nd|rd|th))?[\s-]+(" + "|".join(MONTHS) + r")[a-z]*\.?[\s,-]+(20\d{2})\b"
    day, month, year = (F.regexp_extract(t, p, i) for i in (1, 2, 3))
    at = F.lit(0)
    for i, m in enumerate(MONTHS):
        at = F.when(F.lower(month) == m, i + 1).otherwise(at)
    made = lambda y, m, d: F.try_to_date(F.concat_ws("-", y, F.lpad(m.cast("string"), 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")
    named = F.when(day != "", made(year, at, day))
    q = r"\b(\d{1,2})[/.](\d{1,2})[/.](20\d{2})\b"
    numeric = F.when(F.regexp_extract(t, q, 1) != "", made(F.regexp_extract(t, q, 3), F.regexp_extract(t, q, 2), F.regexp_extract(t, q, 1)))
    say = lambda c: F.date_format(c, "yyyy-MM-dd")
    return F.coalesce(say(whole), inside, say(named), say(numeric), F.lit(""))


def agreement_class(rule: Column, llm: Column) -> Column:
    """How a rule's recommendation and an evaluation's decision agree; no decision is no result."""
    distance = F.abs(rank(llm, LLM_RANK) - rank(rule, RULE_RANK))
    return (
        F.when(F.coalesce(llm, F.lit("NOT_EVALUATED")) == "NOT_EVALUATED", "NO_LLM_RESULT")
        .when(rule == llm, "AGREEMENT")
        .when(distance.isNull(), "UNCLASSIFIED")
        .when(distance >= 2, "MAJOR_DISAGREEMENT")
        .otherwise("MINOR_DISAGREEMENT")
    )


def led_sections(jobs: DataFrame, main_ids: DataFrame, evaluations: DataFrame) -> DataFrame:
    """(section, place, job_id, source_path, llm, rule, agreement): what the evaluation decides, with the rules in its shadow.

    ``jobs`` (job_id, title, country, rule), ``main_ids`` (job_id), ``evaluations`` (job_id, origin MAIN or LLM_RESCUE, llm).
    Favorable ones of either origin are MAIN, skipped ones SKIPPED; main jobs without a result wait in NO_LLM_RESULT, rescued ones
    are left where they were.  Main jobs whose rule is at odds with the result are in DISAGREEMENTS too.  MAIN wins where
    a job has both origins.
    """
    main = main_ids.select("job_id").where("trim(job_id) <> ''").distinct()
    own = evaluations.where("origin = 'MAIN'").select("job_id", "llm")
    rescued = evaluations.where("origin = 'LLM_RESCUE'").select("job_id", "llm").join(main, "job_id", "left_anti")
    both = main.join(own, "job_id", "left").withColumn("source_path", F.lit("MAIN")).unionByName(rescued.withColumn("source_path", F.lit("RESCUE")))
    met = jobs.join(both, "job_id")
    first = met["source_path"] == "MAIN"
    agreement = F.when(first, agreement_class(F.col("rule"), F.col("llm")))
    section = F.when(F.col("llm").isin(*FAVORABLE), "MAIN").when(F.col("llm") == "SKIP", "SKIPPED").when(first, "NO_LLM_RESULT")
    sections = F.array_compact(F.array(section, F.when(F.col("agreement").isin("MAJOR_DISAGREEMENT", "MINOR_DISAGREEMENT"), "DISAGREEMENTS")))
    rows = met.withColumn("agreement", agreement).withColumn("section", F.explode(sections))
    order = F.when(F.col("section") == "MAIN", rank(F.col("llm"), DECISION_ORDER)).when(F.col("section") == "DISAGREEMENTS", (F.col("agreement") != "MAJOR_DISAGREEMENT").cast("int")).otherwise(0)
    w = W.partitionBy("section").orderBy(order, F.lower("country"), F.lower("title"), "source_path", "job_id")
    return rows.select("section", F.row_number().over(w).alias("place"), "job_id", "source_path", "llm", "rule", "agreement")


def is_open() -> Column:
    return F.col("lifecycle_status") != "CLOSED"


def payload_summary(rows: DataFrame, most: int = 10) -> DataFrame:
    """One row: counts of the views, recommendations and events, and the most frequent countries of actionable rows as JSON."""
    n = lambda c: F.count_if(c)
    actionable = F.col("recommendation").isin(*ACTIONABLE) & is_open()
    changed = F.col("seen_status").isin(*CHANGE_EVENTS)
    out = rows.agg(
        F.count("*").alias("records_observed"),
        n(actionable).alias("current_actionable"),
        n(actionable & changed).alias("today_actionable"),
        n((F.col("recommendation") == "LOW_PRIORITY") & is_open()).alias("low_priority"),
        n(F.col("recommendation") == "SKIP").alias("skipped"),
        F.to_json(F.struct(*[n(F.col("recommendation") == r).alias(r) for r in RECOMMENDATIONS])).alias("recommendations"),
        F.to_json(F.struct(*[n(F.col("seen_status") == e).alias(e) for e in ("NEW", "SEEN", "MATERIALLY_CHANGED", "REOPENED")])).alias("events"),
    )
    name = _first(F.col("country"), F.col("country_code"), F.lit("Unknown"))
    counts = rows.where(actionable).groupBy(name.alias("country")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "country").limit(most)
    top = counts.agg(F.to_json(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("o"), "country", "n"))), lambda x: F.struct(x["country"].alias("country"), x["n"].alias("n")))).alias("top_actionable_countries"))
    return out.crossJoin(top)  # one row and one row


def inventory(executions: DataFrame) -> DataFrame:
    """One row about the wired sources (shard_id, source_id, report_key, family, kind, countries, institution)."""
    named = F.coalesce(F.col("institution"), F.lit("")) != ""
    codes = executions.select(F.explode("countries").alias("c")).agg(F.array_sort(F.collect_set("c")).alias("configured_country_codes"))
    d = lambda c: F.count_distinct(c)
    one = executions.agg(
        F.count("*").alias("source_executions"), d("shard_id").alias("shards"), d("source_id").alias("source_ids"), d("report_key").alias("report_keys"),
        d("family").alias("families"), F.count_if(named).alias("institution_specific"), d(F.when(named, F.col("institution"))).alias("institutions"),
        F.array_sort(F.collect_set("kind")).alias("kinds"),
    )
    return one.crossJoin(codes)  # one row and one row


def fallback(coverage: DataFrame) -> DataFrame:
    """(run, fallback, reason): whether a run's filtered listings must give way to the global one.

    ``coverage`` (run, ord, source, stop_reason, complete, error).  An incomplete listing that no configured limit explains
    makes all of them untrusted; the first one is the reason.
    """
    bad = ~F.coalesce("complete", F.lit(False)) & ~F.col("stop_reason").isin("configured_page_limit", "configured_record_limit")
    why = F.concat(F.col("source"), F.lit(":"), F.col("stop_reason"), F.when(F.coalesce("error", F.lit("")) != "", F.concat(F.lit(" ("), F.col("error"), F.lit(")"))).otherwise(""))
    return coverage.groupBy("run").agg(F.min(F.when(bad, F.struct("ord", why.alias("why")))).alias("x")).select("run", F.col("x").isNotNull().alias("fallback"), F.col("x.why").alias("reason"))


def source_results(rows: DataFrame) -> DataFrame:
    """(shard, source, status, records, warnings, failure): what running the sources of a shard told; one row a source.

    ``rows`` (shard, source, records, failed_details, incomplete array, error).  A source that raised is ERROR and has no records;
    incomplete coverage, details that failed and no observations at all are warnings, which make it PARTIAL.
    """
    raised = F.coalesce("error", F.lit("")) != ""
    told = F.concat(
        F.transform("incomplete", lambda x: F.concat(F.lit("Incomplete coverage: "), x)),
        F.array_compact(F.array(
            F.when(F.col("failed_details") > 0, F.concat(F.lit("Full description unavailable for "), F.col("failed_details").cast("string"), F.lit(" records"))),
            F.when(F.col("records") == 0, F.lit("Zero observations in this production run; absence is not treated as closure or source failure.")),
        )),
    )
    warnings = F.when(raised, F.array().cast("array<string>")).otherwise(told)
    out = rows.withColumn("warnings", warnings)
    status = F.when(raised, "ERROR").when(F.size("warnings") > 0, "PARTIAL").otherwise("OK")
    return out.select("shard", "source", status.alias("status"), F.when(raised, 0).otherwise(F.col("records")).alias("records"), "warnings", F.coalesce("error", F.lit("")).alias("error"))


def shard_status(results: DataFrame) -> DataFrame:
    """(shard, status, records): OK if all sources are, ERROR if all failed, else PARTIAL."""
    s = F.col("status")
    status = F.when(F.bool_and(s == "OK"), "OK").when(F.bool_and(s == "ERROR"), "ERROR").otherwise("PARTIAL")
    return results.groupBy("shard").agg(status.alias("status"), F.sum("records").alias("records"))
