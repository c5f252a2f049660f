"""Reports, samples and run diagnostics over documents with derived fields."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordflow.operators import reporting, sampling

from .adapters import table
from .registry import query



def _pick(values, by=1):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.floor(F.col("doc_id") / by) % len(values) + 1).cast("int"))


def _pick_sql(values, by=1):
    return "[" + ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values) + f"][(doc_id // {by}) % {len(values)} + 1]"


RECS = ["STRONG_APPLY", "apply", "REVIEW", "LOW_PRIORITY", "SKIP", None, "REVIEW", "APPLY", "SKIP"]
SEEN = ["NEW", "seen", "MATERIALLY_CHANGED", "", "REOPENED"]
#: Report column: what the record holds as (struct, field, values, divisor), first non-empty wins.
FLAT = {
    "canonical_id": [("", "canonical_id", ["c1", "", "c3"], 1)],
    "source_record_id": [("", "source_record_id", ["r1", None], 2)],
    "recommendation": [("evaluation", "recommendation", RECS, 1)],
    "pre_evaluation_disposition": [("evaluation", "pre_evaluation_disposition", ["policy_skip", ""], 3)],
    "seen_status": [("state", "seen_status", SEEN, 2)],
    "title": [("position", "title_raw", ["Title", "", None], 1), ("position", "title_normalized", ["title n", ""], 2)],
    "institution": [("position", "institution_raw", ["", "Raw"], 1), ("position", "institution_normalized", ["Norm", None], 3)],
    "department": [("position", "department", ["D", None], 5)],
    "country": [("location", "country_name", ["Spain", "", None], 1), ("location", "country_code", ["es", "fr", ""], 2)],
    "city": [("location", "city", ["X", ""], 7)],
    "role_family": [("evaluation", "role_family", ["", "POSTDOC"], 1), ("position", "role_family", ["LECTURER", None], 3)],
    "role_level": [("position", "role_level", ["SENIOR", ""], 4)],
    "deadline": [("dates", "deadline_at", ["2026-01-01", "", None], 1), ("dates", "deadline_text", ["soon", ""], 2)],
    "deadline_status": [("dates", "deadline_status", ["known", None], 1)],
    "detail_status": [("description", "detail_status", ["full", "", "PARTIAL"], 1)],
    "source": [("source", "provider", ["P", None, ""], 1), ("source", "source_key", ["k1", "k2"], 2)],
    "source_status": [("source", "source_status", ["open", "", "closed"], 1)],
    "lifecycle_status": [("state", "lifecycle_status", ["", "closed", None], 2)],
    "reason": [("evaluation", "reason", ["because", None], 2)],
    "url": [("source", "apply_url", ["", "a://1"], 1), ("source", "detail_url", [None, "d://2"], 2), ("source", "listing_url", ["l://3"], 1)],
}
DIMS = ("scientific", "level", "methods", "language", "mobility", "registration", "contract")
LISTS = {"quality_events": ("state", 2), "change_reasons": ("state", 3), "review_codes": ("evaluation", 2), "blocker_codes": ("evaluation", 4), "fit_signals": ("evaluation", 5)}


def records(spark, sf_dir):
    structs: dict[str, dict] = {}
    for parts in FLAT.values():
        for struct, field, values, by in parts:
            structs.setdefault(struct, {})[field] = _pick(values, by)
    for name, (struct, n) in LISTS.items():
        structs[struct][name] = F.when(F.col("doc_id") % n == 0, F.array(F.lit("A"), F.lit(" "), F.lit("B_C"))).when(F.col("doc_id") % n == 1, F.array().cast("array<string>"))
    structs["evaluation"]["dimensions"] = F.struct(*[_pick([d.upper(), ""], i + 1).alias(d) for i, d in enumerate(DIMS)])
    flat = structs.pop("")
    whole = [F.struct(*[v.alias(k) for k, v in fields.items()]).alias(s) for s, fields in structs.items()]
    return table(spark, sf_dir, "documents").select("doc_id", *[v.alias(k) for k, v in flat.items()], *whole)


def _flat_sql() -> str:
    first = lambda *x: "coalesce(" + ", ".join(f"nullif({v}, '')" for v in x) + ", '')"
    col = {k: [_pick_sql(v, by) for _, _, v, by in parts] for k, parts in FLAT.items()}
    upper = {"recommendation": "REVIEW", "pre_evaluation_disposition": "", "seen_status": "", "deadline_status": "UNKNOWN", "detail_status": "NOT_ATTEMPTED", "source_status": "UNKNOWN"}
    out = {k: f"upper({first(*x, repr(upper[k]))})" if k in upper else first(*x) for k, x in col.items()}
    out["country_code"] = f"upper({first(col['country'][1])})"
    out["source_key"] = first(col["source"][1])
    out["lifecycle_status"] = f"upper({first(col['lifecycle_status'][0], out['source_status'])})"
    out |= {k: f"CASE WHEN doc_id % {n} = 0 THEN 'A, B_C' ELSE '' END" for k, (_, n) in LISTS.items()}
    out |= {("contract_fit" if d == "contract" else d): first(_pick_sql([d.upper(), ""], i + 1)) for i, d in enumerate(DIMS)}
    return ", ".join(f"{v} AS {k}" for k, v in out.items())


_ROWS = f"flat AS (SELECT {_flat_sql()} FROM documents)"


@query("flat_report_rows", f"WITH {_ROWS} SELECT * FROM flat")
def flat_report_rows(spark, sf_dir):
    return reporting.flat(records(spark, sf_dir))


_OPEN = "lifecycle_status <> 'CLOSED'"
_ACT = f"recommendation IN ('STRONG_APPLY', 'APPLY') AND {_OPEN}"
_JSON = lambda c, names: "'{' || " + " || ',' || ".join(f"'\"{x}\":' || count(*) FILTER ({c} = '{x}')" for x in names) + " || '}'"


@query(
    "report_summary_json",
    f"""WITH {_ROWS}, top AS (SELECT coalesce(nullif(country, ''), nullif(country_code, ''), 'Unknown') AS c, count(*) AS n FROM flat WHERE {_ACT} GROUP BY 1 ORDER BY n DESC, c LIMIT 10)
    SELECT count(*) AS records_observed, count(*) FILTER ({_ACT}) AS current_actionable, count(*) FILTER ({_ACT} AND seen_status IN ('NEW', 'MATERIALLY_CHANGED', 'REOPENED')) AS today_actionable,
      count(*) FILTER (recommendation = 'LOW_PRIORITY' AND {_OPEN}) AS low_priority, count(*) FILTER (recommendation = 'SKIP') AS skipped, {_JSON('recommendation', reporting.RECOMMENDATIONS)} AS recommendations,
      {_JSON('seen_status', ('NEW', 'SEEN', 'MATERIALLY_CHANGED', 'REOPENED'))} AS events, (SELECT '[' || string_agg('{{"country":"' || c || '","n":' || n || '}}', ',' ORDER BY n DESC, c) || ']' FROM top) AS top_actionable_countries FROM flat""",
)
def report_summary_json(spark, sf_dir):
    return reporting.payload_summary(reporting.flat(records(spark, sf_dir)))


NAMES = ["Universität X", "", "Jobs & Opportunities of Y", "A  spaced   name", None, "n" * 130]
BODIES = [
    "Organisation/Company Uni Z  of A Department of B", "Company/Institute Inst Q Country Spain", "nothing", "Organisation/Company " + "z" * 130 + " Department x Company/Institute Inst R City Y",
    "Work Location(s) City Old Contact a Work Location(s) Number City  New Town  Website w", "Work Location(s) none",
]


@query(
    "clean_names",
    f"""WITH d AS (SELECT doc_id, {_pick_sql(['', 'Norm Name', None, ''], 1)} AS norm, trim(regexp_replace(coalesce({_pick_sql(NAMES, 2)}, ''), '\\s+', ' ', 'g')) AS raw, {_pick_sql(BODIES, 3)} AS body, {_pick_sql(['', None, 'Here'], 1)} AS city FROM documents)
    SELECT doc_id, CASE WHEN norm = 'Norm Name' THEN norm WHEN raw <> '' AND length(raw) <= 120 AND NOT contains(raw, 'Jobs & Opportunities') THEN raw WHEN starts_with(body, 'Organisation/Company Uni') THEN 'Uni Z of A' WHEN starts_with(body, 'Company') THEN 'Inst Q' WHEN starts_with(body, 'Organisation') THEN 'Inst R' ELSE '' END AS institution,
      CASE WHEN city = 'Here' THEN city WHEN contains(body, 'New Town') THEN 'New Town' ELSE '' END AS city FROM d""",
)
def clean_names(spark, sf_dir):
    body = _pick(BODIES, 3)
    return table(spark, sf_dir, "documents").select(
        "doc_id", reporting.clean_institution(_pick(["", "Norm Name", None, ""]), _pick(NAMES, 2), body).alias("institution"), reporting.clean_city(_pick(["", None, "Here"]), body).alias("city")
    )


DEADLINES = {
    "2026-02-03T10:00:00Z": "2026-02-03", "by 2025-12-31 noon": "2025-12-31", "3rd  March 2026": "2026-03-03", "14 Sept, 2026": "2026-09-14", "31/12/2026": "2026-12-31", "7.4.2027": "2027-04-07",
    "31 Feb 2026": "", "open": "", "": "", "2026-05-06": "2026-05-06", "until 1-Jan-2027": "2027-01-01",
}


@query("deadline_days", f"SELECT doc_id, {_pick_sql(list(DEADLINES.values()))} AS day FROM documents")
def deadline_days(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", reporting.parsed_deadline(_pick(list(DEADLINES))).alias("day"))


_LLM = ["STRONG_APPLY", "SKIP", "REVIEW", "APPLY", "NOT_EVALUATED"]
_RULE = ["SKIP", "LOW_PRIORITY", "REVIEW", "APPLY", "STRONG_APPLY", "ODD"]
_RANK = "CASE {} WHEN 'SKIP' THEN 0 WHEN 'LOW_PRIORITY' THEN 1 WHEN 'REVIEW' THEN 2 WHEN 'APPLY' THEN 3 WHEN 'STRONG_APPLY' THEN 4 END"


@query(
    "led_sections",
    f"""WITH j AS (SELECT doc_id AS job_id, lang AS country, left(source, 3) AS title, {_pick_sql(_RULE, 1)} AS rule, CASE WHEN doc_id % 7 < 5 THEN {_pick_sql(_LLM, 2)} END AS llm, doc_id % 3 = 0 AS main, doc_id % 7 < 3 AS has_main, doc_id % 7 BETWEEN 2 AND 4 AS has_rescue FROM documents),
    r AS (SELECT *, 'MAIN' AS source_path, CASE WHEN has_main THEN llm END AS l FROM j WHERE main UNION ALL SELECT *, 'RESCUE', llm FROM j WHERE NOT main AND has_rescue),
    g AS (SELECT *, CASE WHEN source_path <> 'MAIN' THEN NULL WHEN coalesce(l, 'NOT_EVALUATED') = 'NOT_EVALUATED' THEN 'NO_LLM_RESULT' WHEN rule = l THEN 'AGREEMENT' WHEN rule = 'ODD' THEN 'UNCLASSIFIED'
        WHEN abs({_RANK.format('l')} - {_RANK.format('rule')}) >= 2 THEN 'MAJOR_DISAGREEMENT' ELSE 'MINOR_DISAGREEMENT' END AS agreement FROM r),
    s AS (SELECT CASE WHEN l IN ('STRONG_APPLY', 'APPLY', 'REVIEW') THEN 'MAIN' WHEN l = 'SKIP' THEN 'SKIPPED' WHEN source_path = 'MAIN' THEN 'NO_LLM_RESULT' END AS section, * FROM g UNION ALL SELECT 'DISAGREEMENTS', * FROM g WHERE agreement LIKE '%DISAGREEMENT')
    SELECT section, row_number() OVER (PARTITION BY section ORDER BY CASE section WHEN 'MAIN' THEN CASE l WHEN 'STRONG_APPLY' THEN 0 WHEN 'APPLY' THEN 1 ELSE 2 END WHEN 'DISAGREEMENTS' THEN (agreement <> 'MAJOR_DISAGREEMENT')::INT ELSE 0 END, lower(country), lower(title), source_path, job_id)::INT AS place,
      job_id, source_path, l AS llm, rule, agreement FROM s WHERE section IS NOT NULL""",
)
def led_sections(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    jobs = d.select(F.col("doc_id").alias("job_id"), F.col("lang").alias("country"), F.substring("source", 1, 3).alias("title"), _pick(_RULE).alias("rule"))
    n, llm = F.col("doc_id") % 7, _pick(_LLM, 2)
    told = F.array_compact(F.array(F.when(n < 3, "MAIN"), F.when(n.between(2, 4), "LLM_RESCUE")))
    evaluations = d.select(F.col("doc_id").alias("job_id"), llm.alias("llm"), F.explode(told).alias("origin"))
    return reporting.led_sections(jobs, d.where(F.col("doc_id") % 3 == 0).select(F.col("doc_id").alias("job_id")), evaluations)


_JOBS = f"""j AS (SELECT doc_id AS job_id, lang || '|' || source AS stratum, {_pick_sql(['STRONG_APPLY', 'REVIEW', 'LOW_PRIORITY', 'SKIP', 'REVIEW', 'SKIP', 'APPLY', 'LOW_PRIORITY', 'SKIP', 'SKIP', 'SKIP', 'REVIEW', 'REVIEW'])} AS recommendation,
    doc_id % 40 = 2 AS review_more, doc_id % 3 > 0 AS good_detail, doc_id % 50 = 5 AS is_targeted FROM documents)"""


def _turns(name: str, bucket: str, pool: str, size: str, before: list[str]) -> str:
    gone = " AND ".join(f"job_id NOT IN (SELECT job_id FROM {b})" for b in ["pos", *before])
    h = lambda key: f"sha256('seed|{bucket}|' || {key})"
    return f"""{name} AS (SELECT job_id, '{bucket}' AS bucket FROM (SELECT *, row_number() OVER (ORDER BY turn, {h('stratum')}, job_id) AS place FROM (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY {h('job_id')}, job_id) AS turn FROM j WHERE {pool} AND {gone})) WHERE place <= {size})"""


_NEG = "recommendation IN ('LOW_PRIORITY', 'SKIP') AND good_detail"
SAMPLE = f"""{_JOBS}, pos AS (SELECT job_id, 'ALL_POSITIVE' AS bucket FROM j WHERE recommendation IN ('STRONG_APPLY', 'APPLY')),
  {_turns('more', 'REVIEW_MORE_STRATIFIED', 'review_more', '30', [])}, {_turns('fill', 'E01_REVIEW_FILL', "recommendation = 'REVIEW'", '(30 - (SELECT count(*) FROM more))', ['more'])},
  {_turns('aim', 'NEGATIVE_TARGETED', f'{_NEG} AND is_targeted', '22', ['more', 'fill'])}, {_turns('blind', 'NEGATIVE_BLIND_EXPLORATION', _NEG, '23', ['more', 'fill', 'aim'])},
  {_turns('back', 'NEGATIVE_BACKFILL', _NEG, '(45 - (SELECT count(*) FROM aim) - (SELECT count(*) FROM blind))', ['more', 'fill', 'aim', 'blind'])},
  sample AS (SELECT * FROM pos UNION ALL SELECT * FROM more UNION ALL SELECT * FROM fill UNION ALL SELECT * FROM aim UNION ALL SELECT * FROM blind UNION ALL SELECT * FROM back)"""


def _sampled(spark, sf_dir):
    recs = ["STRONG_APPLY", "REVIEW", "LOW_PRIORITY", "SKIP", "REVIEW", "SKIP", "APPLY", "LOW_PRIORITY", "SKIP", "SKIP", "SKIP", "REVIEW", "REVIEW"]
    jobs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("job_id"), F.concat_ws("|", "lang", "source").alias("stratum"), _pick(recs).alias("recommendation"),
        (F.col("doc_id") % 40 == 2).alias("review_more"), (F.col("doc_id") % 3 > 0).alias("good_detail"), (F.col("doc_id") % 50 == 5).alias("is_targeted"),
    )
    return sampling.shadow_sample(jobs, "seed", 30, 45), jobs


@query("shadow_sample", f"WITH {SAMPLE} SELECT job_id, bucket FROM sample")
def shadow_sample(spark, sf_dir):
    """Half of 45 negatives are targeted: 22, as halves go to the even number."""
    return _sampled(spark, sf_dir)[0]


@query("sample_summary", f"WITH {SAMPLE} SELECT 'bucket' AS dimension, bucket AS value, count(*) AS n FROM sample GROUP BY bucket UNION ALL SELECT 'recommendation', recommendation, count(*) FROM sample JOIN j USING (job_id) GROUP BY recommendation")
def sample_summary(spark, sf_dir):
    return sampling.sample_summary(*_sampled(spark, sf_dir))


@query(
    "board_inventory",
    """WITH e AS (SELECT 's' || (doc_id % 14) AS shard_id, source AS source_id, lang || source AS report_key, lang AS family, CASE doc_id % 3 WHEN 0 THEN 'ATS' WHEN 1 THEN 'PORTAL' ELSE 'SEARCH' END AS kind, [upper(lang), CASE WHEN doc_id % 2 = 0 THEN 'NL' ELSE 'IE' END] AS countries, CASE WHEN doc_id % 4 = 0 THEN 'Uni ' || source WHEN doc_id % 4 = 1 THEN '' END AS institution FROM documents)
    SELECT count(*) AS source_executions, count(DISTINCT shard_id) AS shards, count(DISTINCT source_id) AS source_ids, count(DISTINCT report_key) AS report_keys, count(DISTINCT family) AS families, count(*) FILTER (coalesce(institution, '') <> '') AS institution_specific, count(DISTINCT nullif(institution, '')) AS institutions,
      list_sort(list(DISTINCT kind)) AS kinds, (SELECT list_sort(list(DISTINCT c)) FROM (SELECT unnest(countries) AS c FROM e)) AS configured_country_codes FROM e""",
)
def board_inventory(spark, sf_dir):
    n = F.col("doc_id") % 4
    e = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("s"), (F.col("doc_id") % 14).cast("string")).alias("shard_id"), F.col("source").alias("source_id"), F.concat("lang", "source").alias("report_key"), F.col("lang").alias("family"),
        F.when(F.col("doc_id") % 3 == 0, "ATS").when(F.col("doc_id") % 3 == 1, "PORTAL").otherwise("SEARCH").alias("kind"), F.array(F.upper("lang"), F.when(F.col("doc_id") % 2 == 0, "NL").otherwise("IE")).alias("countries"),
        F.when(n == 0, F.concat(F.lit("Uni "), "source")).when(n == 1, "").alias("institution"),
    )
    return reporting.inventory(e)


@query(
    "fallback_switch",
    """WITH c AS (SELECT user_id AS run, event_id AS ord, event_type AS source, CASE event_id % 5 WHEN 0 THEN 'request_failed' WHEN 1 THEN 'configured_page_limit' ELSE 'last_page' END AS stop_reason, event_id % 5 > 1 AND event_id % 97 <> 3 AS complete, CASE WHEN event_id % 10 = 0 THEN 'TimeoutError: x' END AS error FROM events WHERE user_id % 3 > 0 OR event_id % 5 > 0)
    SELECT run, count(*) FILTER (NOT complete AND stop_reason <> 'configured_page_limit') > 0 AS fallback, arg_min(source || ':' || stop_reason || CASE WHEN error IS NULL THEN '' ELSE ' (' || error || ')' END, ord) FILTER (NOT complete AND stop_reason <> 'configured_page_limit') AS reason FROM c GROUP BY run""",
)
def fallback_switch(spark, sf_dir):
    i = F.col("event_id")
    e = table(spark, sf_dir, "events").where((F.col("user_id") % 3 > 0) | (i % 5 > 0))
    return reporting.fallback(e.select(
        F.col("user_id").alias("run"), i.alias("ord"), F.col("event_type").alias("source"), F.when(i % 5 == 0, "request_failed").when(i % 5 == 1, "configured_page_limit").otherwise("last_page").alias("stop_reason"),
        ((i % 5 > 1) & (i % 97 != 3)).alias("complete"), F.when(i % 10 == 0, "TimeoutError: x").alias("error"),
    ))


_RESULTS = """r AS (SELECT lang AS shard, source, count(*) FILTER (doc_id % 3 > 0) AS records, count(*) FILTER (doc_id % 31 = 7) AS failed, CASE WHEN source = 'src3' OR (source LIKE '%1' AND lang = 'de') THEN 'TimeoutError: no answer' ELSE '' END AS error, min(doc_id) % 2 = 0 AS cut FROM documents GROUP BY lang, source),
  s AS (SELECT *, error <> '' AS raised, list_filter([CASE WHEN cut THEN 'Incomplete coverage: ' || source || ': empty_page' END, CASE WHEN failed > 0 THEN 'Full description unavailable for ' || failed || ' records' END, CASE WHEN records = 0 THEN 'Zero observations in this production run; absence is not treated as closure or source failure.' END], lambda x: x IS NOT NULL) AS told FROM r),
  t AS (SELECT shard, source, CASE WHEN raised THEN 'ERROR' WHEN len(told) > 0 THEN 'PARTIAL' ELSE 'OK' END AS status, CASE WHEN raised THEN 0 ELSE records END AS records, CASE WHEN raised THEN [] ELSE told END AS warnings, error FROM s)"""


def _results(spark, sf_dir):
    d = table(spark, sf_dir, "documents").groupBy(F.col("lang").alias("shard"), "source").agg(
        F.count_if(F.col("doc_id") % 3 > 0).alias("records"), F.count_if(F.col("doc_id") % 31 == 7).alias("failed_details"), (F.min("doc_id") % 2 == 0).alias("cut")
    )
    none = F.array().cast("array<string>")
    incomplete = F.when(F.col("cut"), F.array(F.concat("source", F.lit(": empty_page")))).otherwise(none)
    error = F.when((F.col("source") == "src3") | (F.endswith("source", F.lit("1")) & (F.col("shard") == "de")), "TimeoutError: no answer")
    return reporting.source_results(d.withColumns({"incomplete": incomplete, "error": error}))


@query("source_results", f"WITH {_RESULTS} SELECT shard, source, status, records, array_to_string(warnings, '; ') AS warnings, error FROM t")
def source_results(spark, sf_dir):
    return _results(spark, sf_dir).withColumn("warnings", F.array_join("warnings", "; "))


@query("shard_results", f"WITH {_RESULTS} SELECT shard, CASE WHEN bool_and(status = 'OK') THEN 'OK' WHEN bool_and(status = 'ERROR') THEN 'ERROR' ELSE 'PARTIAL' END AS status, sum(records)::BIGINT AS records FROM t GROUP BY shard")
def shard_results(spark, sf_dir):
    return reporting.shard_status(_results(spark, sf_dir))


@query("blob_ids", "SELECT doc_id, sha1('blob ' || strlen(text) || chr(0) || text) AS blob FROM documents")
def blob_ids(spark, sf_dir):
    """Ids of texts as a version control system names files: a digest behind their kind and size."""
    head = F.encode(F.concat(F.lit("blob "), F.octet_length("text").cast("string"), F.lit("\u0000")), "utf-8")
    return table(spark, sf_dir, "documents").select("doc_id", F.sha1(F.concat(head, F.encode("text", "utf-8"))).alias("blob"))


@query(
    "freeze_check",
    "SELECT doc_id, CASE WHEN doc_id % 20 = 0 THEN 'CHANGED' ELSE 'MISSING' END AS problem FROM documents WHERE doc_id % 20 = 0 OR doc_id % 33 = 1",
)
def freeze_check(spark, sf_dir):
    """A manifest of blob ids held against the files: changed ones, and those that are gone."""
    now = blob_ids(spark, sf_dir)
    manifest = now.withColumn("frozen", F.when(F.col("doc_id") % 20 == 0, "0").otherwise(F.col("blob"))).drop("blob")
    there = now.where((F.col("doc_id") % 33 != 1) | (F.col("doc_id") % 20 == 0))
    problem = F.when(F.col("blob").isNull(), "MISSING").when(F.col("blob") != F.col("frozen"), "CHANGED")
    return manifest.join(there, "doc_id", "left").select("doc_id", problem.alias("problem")).where("problem IS NOT NULL")
