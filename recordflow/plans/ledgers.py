"""The ledger over two generations of documents as records: ids change, fields change, details are lost, some are absent."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordflow.operators import collection, ledger

from .adapters import table
from .registry import query
from .scalars import WS



def records(spark, sf_dir, second: bool):
    """One generation; the second has other ids, values and statuses for some residues of the id."""
    i, s = F.col("doc_id").cast("string"), F.lit(second)
    when = lambda n, a, b: F.when(s & (F.col("doc_id") % n == 0), a).otherwise(b)
    canonical = when(7, F.concat(F.lit("K"), i), F.concat(F.lit("C"), i))
    job = when(11, F.concat(F.lit("X"), i), i)
    url = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("ex.org/job/"), i))
    title = F.regexp_extract("text", r"^([^.\n]*)", 1)
    status = (F.when(F.col("doc_id") % 10 == 0, "closed").otherwise("open")) if second else (F.when(F.col("doc_id") % 6 == 0, "CLOSED").when(F.col("doc_id") % 6 == 5, "odd").otherwise("OPEN"))
    lost = F.col("doc_id") % (9 if second else 8) == 0
    bits = F.when(F.col("doc_id") % 15 == 0, 0xFFFFF).when(F.col("doc_id") % 15 == 1, 0x3FF).otherwise(0) if second else F.lit(0)
    simhash = F.lpad(F.lower(F.hex((F.col("doc_id") * 1000003).bitwiseXOR(bits.cast("long")))), 16, "0")
    of = {
        "title": when(5, F.concat(title, F.lit(" II")), title),
        "institution": when(19, F.lit(""), F.col("source")),
        "department": when(21, F.lit(None).cast("string"), F.lit("")),
        "country_code": F.col("lang"),
        "city": when(23, F.lit("Köln"), F.lit("Koln")),
        "role_family": when(29, F.lit("lecturer"), F.lit("postdoc")),
        "employment_type": when(12, F.lit("casual"), F.lit(None).cast("string")),
        "deadline_at": when(14, F.lit("2026-01-01"), F.lit("2025-12-01")),
        "deadline_status": F.lit("known"),
        "duration_months": when(16, F.lit(24.0), F.lit(12.0)),
        "fte": when(18, F.lit(None).cast("double"), F.lit(0.5)),
        "source_status": status,
        "detail_status": F.when(lost, "FETCH_FAILED").otherwise("FULL"),
        "detail_simhash": simhash,
        "detail_words": F.when(lost, 0).otherwise(F.col("n_chars")),
        "recommendation": when(20, F.lit("skip"), F.lit("apply")),
    }
    rows = table(spark, sf_dir, "documents").where((F.col("doc_id") % 17 != 0) if second else (F.col("doc_id") % 13 != 0))
    named = collection.aliases(canonical, F.col("source"), job, [url], F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("R"), i)))
    return rows.select(F.concat(F.lit("r"), i).alias("record_id"), named.alias("aliases"), ledger.snapshot(of).alias("snapshot"))


def _at(day: int):
    return F.lit(f"2026-01-0{day} 00:00:00").cast("timestamp")


def folded(spark, sf_dir):
    first = ledger.fold(spark.createDataFrame([], ledger.LEDGER), records(spark, sf_dir, False), _at(1), ledger.WRITER_ROLE)
    return ledger.fold(first.drop("record_id", "event", "quality_event"), records(spark, sf_dir, True), _at(2), ledger.WRITER_ROLE)


def _gen(second: bool) -> str:
    when = lambda n, a, b: f"CASE WHEN doc_id % {n} = 0 THEN {a} ELSE {b} END" if second else b
    title = "regexp_extract(text, '^([^.\\n]*)', 1)"
    status = "CASE WHEN doc_id % 10 = 0 THEN 'CLOSED' ELSE 'OPEN' END" if second else "CASE WHEN doc_id % 6 = 0 THEN 'CLOSED' WHEN doc_id % 6 = 5 THEN 'UNKNOWN' ELSE 'OPEN' END"
    bits = "CASE doc_id % 15 WHEN 0 THEN 1048575 WHEN 1 THEN 1023 ELSE 0 END" if second else "0"
    ok = f"doc_id % {9 if second else 8} <> 0"
    return f"""SELECT doc_id, {when(7, "'k' || doc_id", "'c' || doc_id")} AS canonical, source || ':' || lower({when(11, "'X' || doc_id", 'doc_id::VARCHAR')}) AS job,
      CASE WHEN doc_id % 2 = 0 THEN 'url:ex.org/job/' || doc_id END AS url, CASE WHEN doc_id % 3 = 0 THEN 'source_record:' || source || ':r' || doc_id END AS rec,
      {WS.format(x=when(5, f"{title} || ' II'", title))} AS title, {WS.format(x=when(19, "''", 'source'))} AS institution, '' AS department, upper(lang) AS country_code, 'koln' AS city,
      {when(29, "'LECTURER'", "'POSTDOC'")} AS role_family, {when(12, "'CASUAL'", "'UNKNOWN'")} AS employment_type, {when(14, "'2026-01-01'", "'2025-12-01'")} AS deadline_at,
      {when(16, '24.0', '12.0')}::DOUBLE AS duration_months, {when(18, 'NULL', '0.5')}::DOUBLE AS fte, {status} AS lifecycle, {ok} AND n_chars > 0 AS resolved,
      CASE WHEN {ok} THEN xor(doc_id * 1000003, {bits}) END AS simhash, {when(20, "'SKIP'", "'APPLY'")} AS recommendation
      FROM documents WHERE {'doc_id % 17 <> 0' if second else 'doc_id % 13 <> 0'}"""


_DIFF = lambda c: f"CASE WHEN coalesce(a.{c}::VARCHAR, '') <> coalesce(b.{c}::VARCHAR, '') THEN '{c}' END"
_REASONS = "list_filter([" + ", ".join(
    [_DIFF(c) for c in ("title", "institution", "role_family")]
    + [f"CASE WHEN NOT (a.resolved AND NOT b.resolved) THEN {_DIFF(c)} END" for c in ("employment_type", "deadline_at", "duration_months", "fte")]
    + ["CASE WHEN NOT (a.resolved AND NOT b.resolved) AND a.lifecycle <> b.lifecycle THEN 'lifecycle_status' END"]
    + ["CASE WHEN a.resolved AND b.resolved AND bit_count(xor(a.simhash, b.simhash)) >= 14 THEN 'full_jd' END"]
    + ["CASE WHEN a.resolved AND b.resolved AND a.recommendation <> b.recommendation THEN 'recommendation' END"]
) + "], lambda x: x IS NOT NULL)"
_AGAIN = "a.lifecycle = 'CLOSED' AND b.lifecycle = 'OPEN'"
_KEEP = lambda c: f"CASE WHEN a.resolved AND NOT b.resolved THEN a.{c} ELSE b.{c} END"
# an id is of the strongest alias at first sight; two generations match by any alias that they share
RUN = f"""a AS ({_gen(False)}), b AS ({_gen(True)}),
  two AS (SELECT a.doc_id AS a_doc, b.doc_id AS b_doc, 'job_' || left(sha1('canonical:' || coalesce(a.canonical, b.canonical)), 20) AS state_id, a.doc_id IS NOT NULL AND b.doc_id IS NOT NULL AS both_,
    {_REASONS} AS why, {_AGAIN} AS again, a.resolved AS was_ok, b.resolved AS is_ok, coalesce(b.lifecycle, a.lifecycle) AS lifecycle_status,
    CASE WHEN b.doc_id IS NULL THEN a.duration_months WHEN a.doc_id IS NULL THEN b.duration_months ELSE {_KEEP('duration_months')} END AS duration_months,
    CASE WHEN b.doc_id IS NULL THEN a.recommendation WHEN a.doc_id IS NULL THEN b.recommendation ELSE {_KEEP('recommendation')} END AS recommendation,
    CASE WHEN b.doc_id IS NULL THEN a.institution WHEN a.doc_id IS NULL THEN b.institution WHEN a.resolved AND NOT b.resolved AND b.institution = '' THEN a.institution ELSE b.institution END AS institution,
    len(list_distinct(list_filter(['canonical:' || a.canonical, 'source_id:' || a.job, a.url, a.rec, 'canonical:' || b.canonical, 'source_id:' || b.job, b.url, b.rec], lambda x: x IS NOT NULL)))::INT AS n_aliases
    FROM a FULL JOIN b ON a.doc_id = b.doc_id AND (a.canonical = b.canonical OR a.job = b.job OR a.url = b.url OR a.rec = b.rec)),
  run AS (SELECT *, CASE WHEN b_doc IS NULL THEN NULL WHEN NOT both_ THEN 'NEW' WHEN again THEN 'REOPENED' WHEN len(why) > 0 THEN 'MATERIALLY_CHANGED' ELSE 'SEEN' END AS event,
    CASE WHEN NOT both_ THEN [] WHEN again AND NOT list_contains(why, 'lifecycle_status') THEN ['lifecycle_status'] || why ELSE why END AS reasons,
    CASE WHEN both_ AND NOT was_ok AND is_ok THEN 'DETAIL_RESOLVED' WHEN both_ AND was_ok AND NOT is_ok THEN 'DETAIL_UNRESOLVED' END AS quality_event FROM two)"""


@query("ledger_fold", f"WITH {RUN} SELECT state_id, 1 + both_::BIGINT AS times_seen, lifecycle_status, event, quality_event, n_aliases FROM run")
def ledger_fold(spark, sf_dir):
    return folded(spark, sf_dir).select("state_id", "times_seen", "lifecycle_status", "event", "quality_event", F.size("aliases").alias("n_aliases"))


@query("ledger_reasons", f"WITH {RUN} SELECT state_id, array_to_string(reasons, ',') AS reasons FROM run WHERE b_doc IS NOT NULL")
def ledger_reasons(spark, sf_dir):
    return folded(spark, sf_dir).where("record_id IS NOT NULL").select("state_id", F.array_join("change_reasons", ",").alias("reasons"))


@query("ledger_carry_forward", f"WITH {RUN} SELECT state_id, duration_months, recommendation, institution FROM run")
def ledger_carry_forward(spark, sf_dir):
    return folded(spark, sf_dir).select("state_id", "snapshot.duration_months", "snapshot.recommendation", "snapshot.institution")


@query("ledger_quality_events", f"WITH {RUN} SELECT quality_event, count(*) AS n FROM run WHERE quality_event IS NOT NULL GROUP BY 1")
def ledger_quality_events(spark, sf_dir):
    return folded(spark, sf_dir).where("quality_event IS NOT NULL").groupBy("quality_event").agg(F.count("*").alias("n"))


@query(
    "ledger_summary",
    f"""WITH {RUN} SELECT count(*) FILTER (event = 'NEW') AS new, count(*) FILTER (event = 'SEEN') AS seen, count(*) FILTER (event = 'MATERIALLY_CHANGED') AS materially_changed, count(*) FILTER (event = 'REOPENED') AS reopened,
    count(*) FILTER (quality_event = 'DETAIL_RESOLVED') AS detail_resolved, count(*) FILTER (quality_event = 'DETAIL_UNRESOLVED') AS detail_unresolved, count(b_doc) AS records_observed, count(*) AS state_jobs FROM run""",
)
def ledger_summary(spark, sf_dir):
    return ledger.summary(folded(spark, sf_dir))


@query(
    "state_id_allocation",
    """SELECT doc_id, 'job_' || left(sha1('canonical:c' || doc_id), 20) || CASE WHEN doc_id % 4 = 0 THEN '_1' WHEN doc_id % 4 = 1 THEN '_2' WHEN doc_id % 4 = 2 THEN '_1' ELSE '' END AS state_id FROM documents""",
)
def state_id_allocation(spark, sf_dir):
    """Ids of new entries beside those that are taken: the bare one, the bare one and the first number, or the bare one and the second."""
    i = F.col("doc_id").cast("string")
    fresh = table(spark, sf_dir, "documents").select("doc_id", F.array(F.struct(F.lit(0).alias("rank"), F.concat(F.lit("canonical:c"), i).alias("alias"))).alias("aliases"))
    base = F.concat(F.lit("job_"), F.substring(F.sha1(F.concat(F.lit("canonical:c"), i)), 1, 20))
    taken = F.when(F.col("doc_id") % 4 == 0, F.array(base)).when(F.col("doc_id") % 4 == 1, F.array(base, F.concat(base, F.lit("_1")))).when(F.col("doc_id") % 4 == 2, F.array(base, F.concat(base, F.lit("_2")))).otherwise(F.array().cast("array<string>"))
    there = table(spark, sf_dir, "documents").select(F.explode(taken).alias("state_id"))
    return ledger.allocated(there, fresh).select("doc_id", "state_id")


@query("lifecycle_mapping", f"WITH {RUN} SELECT lifecycle AS lifecycle_status, count(*) AS n FROM a GROUP BY 1")
def lifecycle_mapping(spark, sf_dir):
    return records(spark, sf_dir, False).groupBy("snapshot.lifecycle_status").agg(F.count("*").alias("n"))


@query("ledger_violations", f"WITH {RUN} SELECT 'job_x' AS state_id, 'state_id not unique' AS violation, 2::BIGINT AS n UNION ALL SELECT 'job_x', 'no aliases', 1 UNION ALL SELECT NULL, 'no state_id', 1")
def ledger_violations(spark, sf_dir):
    """The folded ledger is sound; three entries that are put beside it are not."""
    sound = folded(spark, sf_dir).select("state_id", "aliases")
    odd = spark.createDataFrame([("job_x", ["a"]), ("job_x", []), (None, ["b"])], "state_id string, aliases array<string>")
    return ledger.violations(sound.unionByName(odd)).groupBy("state_id", "violation").agg(F.count("*").alias("n"))
