"""Joins, filters, aggregates, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recordflow.functions import text
from recordflow.operators import classify, joins, measures, sampling

from .adapters import OBS_SQL, observations, table
from .registry import query


def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def events(spark, sf_dir):
    return table(spark, sf_dir, "events")


# --- joins -----------------------------------------------------------------------------------------------------

_ALIASES = "al AS (SELECT user_id, 'day:' || (o % 97) AS alias FROM (SELECT user_id, event_id AS o FROM events WHERE event_type = 'signup') UNION SELECT user_id, 'user:' || user_id FROM events)"


def _aliases(spark, sf_dir):
    e = events(spark, sf_dir)
    by_day = e.where("event_type = 'signup'").selectExpr("user_id", "concat('day:', event_id % 97) AS alias")
    return by_day.unionByName(e.selectExpr("user_id", "concat('user:', user_id) AS alias")).distinct()


@query(
    "alias_lookup",
    f"WITH {_ALIASES}, one AS (SELECT alias, min(user_id) AS owner FROM al GROUP BY alias HAVING count(DISTINCT user_id) = 1) SELECT al.user_id, min(owner) AS owner, count(DISTINCT owner) AS owners FROM al LEFT JOIN one USING (alias) GROUP BY al.user_id",
)
def alias_lookup(spark, sf_dir):
    al = _aliases(spark, sf_dir)
    index = joins.unambiguous(al.withColumnRenamed("user_id", "owner"), "alias", "owner")
    return joins.resolve(al, "user_id", "alias", index, "owner")


@query("alias_conflicts", f"WITH {_ALIASES} SELECT alias, count(DISTINCT user_id) AS owners FROM al GROUP BY alias HAVING count(DISTINCT user_id) > 1")
def alias_conflicts(spark, sf_dir):
    return joins.conflicts(_aliases(spark, sf_dir), "alias", "user_id")


@query("annotation_writeback", "SELECT l.doc_id, d.source, l.quality FROM labels l JOIN documents d USING (doc_id)")
def annotation_writeback(spark, sf_dir):
    return joins.complete(table(spark, sf_dir, "labels"), docs(spark, sf_dir), "doc_id").select("doc_id", "source", "quality")


@query(
    "dual_path_routing",
    """WITH m AS (SELECT doc_id FROM labels WHERE quality = 1), r AS (SELECT doc_id FROM labels UNION SELECT max(doc_id) + 1 FROM documents),
    n AS (SELECT doc_id, 'MAIN' AS route FROM m UNION ALL SELECT doc_id, 'RESCUE' FROM r WHERE doc_id NOT IN (SELECT doc_id FROM m))
    SELECT n.doc_id, CASE WHEN d.doc_id IS NULL THEN 'MISSING' ELSE route END AS route FROM n LEFT JOIN documents d USING (doc_id)""",
)
def dual_path_routing(spark, sf_dir):
    labels, d = table(spark, sf_dir, "labels"), docs(spark, sf_dir)
    rescue = labels.select("doc_id").unionByName(d.agg((F.max("doc_id") + 1).alias("doc_id")))
    return joins.routes(d, "doc_id", labels.where("quality = 1"), rescue)


@query(
    "triage_join",
    """WITH t AS (SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events WHERE event_type IN ('purchase', 'error') GROUP BY user_id)
    SELECT c_custkey, coalesce(CASE event_type WHEN 'purchase' THEN 'PASS' WHEN 'error' THEN 'REJECTED' END, 'MISSING') AS triage FROM customer LEFT JOIN t ON c_custkey = user_id""",
)
def triage_join(spark, sf_dir):
    t = joins.last_of(events(spark, sf_dir).where("event_type IN ('purchase', 'error')"), "user_id", F.col("event_id"), "event_type")
    named = t.select(F.col("user_id").alias("c_custkey"), F.when(F.col("event_type") == "purchase", "PASS").otherwise("REJECTED").alias("triage"))
    return joins.left_with(table(spark, sf_dir, "customer").select("c_custkey"), named, "c_custkey", {"triage": "MISSING"})


_RANK = "CASE role WHEN 'system' THEN 0 WHEN 'user' THEN 1 ELSE 2 END"


@query(
    "shadow_compare",
    f"""WITH a AS (SELECT conv_id, turn, {_RANK} AS r FROM conversations), b AS (SELECT conv_id, turn + 1 AS turn, {_RANK} AS s FROM conversations)
    SELECT conv_id, turn, s - r AS distance, CASE WHEN s = r THEN 'SAME' WHEN s > r THEN 'UP' ELSE 'DOWN' END AS direction,
      list_filter([CASE WHEN s <> r THEN 'DISAGREE' END, CASE WHEN abs(s - r) >= 2 THEN 'MAJOR' END], lambda x: x IS NOT NULL) AS tags FROM a JOIN b USING (conv_id, turn)""",
)
def shadow_compare(spark, sf_dir):
    from recordflow.operators import shadow

    c = table(spark, sf_dir, "conversations")
    ranks = {"system": 0, "user": 1, "assistant": 2}
    a = c.select("conv_id", "turn", F.col("role").alias("ours"))
    b = c.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("theirs"))
    met = a.join(b, ["conv_id", "turn"])
    d = shadow.rank_distance(F.col("ours"), F.col("theirs"), ranks)
    return met.select("conv_id", "turn", d.alias("distance"), shadow.direction(d).alias("direction"), shadow.tags(d).alias("tags"))


@query("agreement", f"SELECT conv_id, turn, CASE WHEN abs(s - r) >= 2 THEN 'MAJOR' WHEN s <> r THEN 'MINOR' ELSE 'AGREE' END AS agreement FROM (SELECT conv_id, turn, {_RANK} AS r, turn % 3 AS s FROM conversations)")
def agreement(spark, sf_dir):
    from recordflow.operators import shadow

    c = table(spark, sf_dir, "conversations")
    d = F.col("turn") % 3 - shadow.rank(F.col("role"), {"system": 0, "user": 1, "assistant": 2})
    return c.select("conv_id", "turn", shadow.agreement(d).alias("agreement"))


@query(
    "evidence_policy",
    "SELECT doc_id, q AS quality, least(n % 101, CASE q WHEN 'FULL' THEN 100 WHEN 'PARTIAL' THEN 80 WHEN 'TITLE' THEN 55 ELSE 30 END)::INT AS confidence FROM (SELECT doc_id, n_chars AS n, CASE WHEN n_chars >= 1000 THEN 'FULL' WHEN n_chars >= 200 THEN 'PARTIAL' WHEN n_chars > 20 THEN 'TITLE' ELSE 'NONE' END AS q FROM documents)",
)
def evidence_policy(spark, sf_dir):
    from recordflow.operators import shadow

    n = F.col("n_chars")
    q = classify.first_of([(n >= 1000, "FULL"), (n >= 200, "PARTIAL"), (n > 20, "TITLE")], "NONE")
    return docs(spark, sf_dir).select("doc_id", q.alias("quality"), shadow.capped((n % 101).cast("int"), q).alias("confidence"))


@query("cache_worklist", "SELECT conv_id, turn FROM conversations c WHERE NOT EXISTS (SELECT 1 FROM conversations k WHERE k.turn % 2 = 0 AND sha256(k.text) = sha256(c.text))")
def cache_worklist(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").withColumn("fp", F.sha2("text", 256))
    return c.join(c.where("turn % 2 = 0").select("fp"), "fp", "left_anti").select("conv_id", "turn")


@query("report_merge", "SELECT doc_id, 'MAIN' AS origin FROM labels WHERE quality = 1 UNION ALL SELECT doc_id, 'RESCUE' FROM labels WHERE quality = 0")
def report_merge(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    main = labels.where("quality = 1").select("doc_id", F.lit("MAIN").alias("origin"))
    return joins.merge_first(main, labels.select("doc_id", F.lit("RESCUE").alias("origin")), "doc_id")


@query("evidence_join", "SELECT l.doc_id, CASE WHEN quality = 1 THEN 'MAIN' ELSE 'RESCUE' END AS origin, n_chars, sha256(text) AS body FROM labels l JOIN documents d USING (doc_id)")
def evidence_join(spark, sf_dir):
    met = joins.complete(table(spark, sf_dir, "labels"), docs(spark, sf_dir), "doc_id")
    return met.select("doc_id", F.when(F.col("quality") == 1, "MAIN").otherwise("RESCUE").alias("origin"), "n_chars", F.sha2("text", 256).alias("body"))


@query(
    "source_rollup_full_outer",
    """WITH d AS (SELECT source, count(*) AS documents, count(*) FILTER (n_chars >= 200) AS full_docs FROM documents GROUP BY source),
    s AS (SELECT 'src' || (s_suppkey % 25) AS source, count(*) AS suppliers FROM supplier GROUP BY 1)
    SELECT source, coalesce(documents, 0) AS documents, coalesce(full_docs, 0) AS full_docs, coalesce(suppliers, 0) AS suppliers FROM d FULL JOIN s USING (source)""",
)
def source_rollup_full_outer(spark, sf_dir):
    d = docs(spark, sf_dir).groupBy("source").agg(F.count("*").alias("documents"), F.count_if(F.col("n_chars") >= 200).alias("full_docs"))
    s = table(spark, sf_dir, "supplier").groupBy(F.concat(F.lit("src"), F.col("s_suppkey") % 25).alias("source")).agg(F.count("*").alias("suppliers"))
    names = ("documents", "full_docs", "suppliers")
    return d.join(s, "source", "full").select("source", *[F.coalesce(c, F.lit(0)).alias(c) for c in names])


@query(
    "missing_unexpected",
    "SELECT source AS id, 'UNEXPECTED' AS side FROM (SELECT DISTINCT source FROM documents) WHERE source NOT IN (SELECT 'src' || (n_nationkey * 2) FROM nation) UNION ALL SELECT id, 'MISSING' FROM (SELECT DISTINCT 'src' || (n_nationkey * 2) AS id FROM nation) WHERE id NOT IN (SELECT source FROM documents)",
)
def missing_unexpected(spark, sf_dir):
    expected = table(spark, sf_dir, "nation").select(F.concat(F.lit("src"), F.col("n_nationkey") * 2).alias("id"))
    return joins.differences(expected, docs(spark, sf_dir).select(F.col("source").alias("id")), "id")


@query("registry_gaps", "SELECT n_nationkey, n_name FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 0)")
def registry_gaps(spark, sf_dir):
    wired = table(spark, sf_dir, "supplier").where("s_acctbal < 0").select(F.col("s_nationkey").alias("n_nationkey"))
    return table(spark, sf_dir, "nation").join(wired, "n_nationkey", "left_anti").select("n_nationkey", "n_name")


@query("finding_resolution", "SELECT o_orderkey, l_linenumber, l_returnflag AS resolution FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F'")
def finding_resolution(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    li = table(spark, sf_dir, "lineitem")
    return o.join(li, o.o_orderkey == li.l_orderkey).select("o_orderkey", "l_linenumber", F.col("l_returnflag").alias("resolution"))


@query("label_join", "SELECT l.doc_id, quality, (n_chars >= 1000)::INT AS predicted FROM labels l JOIN documents d USING (doc_id)")
def label_join(spark, sf_dir):
    met = joins.complete(table(spark, sf_dir, "labels"), docs(spark, sf_dir), "doc_id")
    return met.select("doc_id", "quality", (F.col("n_chars") >= 1000).cast("int").alias("predicted"))


@query("review_anti", "SELECT doc_id FROM documents WHERE n_chars >= 200 AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def review_anti(spark, sf_dir):
    users = table(spark, sf_dir, "labels").where("quality = 1")
    return docs(spark, sf_dir).where("n_chars >= 200").join(users, "doc_id", "left_anti").select("doc_id")


@query("cross_source_exists", "SELECT DISTINCT a.doc_id FROM documents a JOIN documents b ON a.lang = b.lang AND a.text = b.text AND a.source <> b.source")
def cross_source_exists(spark, sf_dir):
    d = docs(spark, sf_dir).select("doc_id", "lang", "source", F.sha2("text", 256).alias("body"))
    # a text has another source as soon as it has two; no pairs are made
    many = d.groupBy("lang", "body").agg(F.min("source").alias("a"), F.max("source").alias("b")).where("a <> b")
    return d.join(many, ["lang", "body"], "left_semi").select("doc_id")


# --- filters ---------------------------------------------------------------------------------------------------


@query("open_filter", "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F'")
def open_filter(spark, sf_dir):
    return table(spark, sf_dir, "orders").where("o_orderstatus <> 'F'").select("o_orderkey")


@query("review_queue", "SELECT doc_id FROM documents WHERE n_chars < 200 OR lang = 'es' OR contains(text, '!!')")
def review_queue(spark, sf_dir):
    return docs(spark, sf_dir).where((F.col("n_chars") < 200) | (F.col("lang") == "es") | F.contains("text", F.lit("!!"))).select("doc_id")


@query("targeted_negative", "SELECT doc_id FROM labels JOIN documents USING (doc_id) WHERE quality = 0 AND toxic = 0 AND n_chars >= 200")
def targeted_negative(spark, sf_dir):
    bad = table(spark, sf_dir, "labels").where("quality = 0 AND toxic = 0").select("doc_id")
    return docs(spark, sf_dir).where("n_chars >= 200").join(bad, "doc_id", "left_semi").select("doc_id")


@query("source_exclusion", r"SELECT page_id FROM pages WHERE NOT regexp_matches(lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)), '(^|\.)example\.org$')")
def source_exclusion(spark, sf_dir):
    from recordflow.functions import urls

    return table(spark, sf_dir, "pages").where(~urls.in_domain(urls.host(F.col("url")), "example.org")).select("page_id")


@query(
    "availability",
    """SELECT o_orderkey, CASE WHEN d IS NULL AND o_orderstatus = 'P' THEN 'OPEN' WHEN d < DATE '1998-01-01' THEN 'CLOSED' WHEN o_orderstatus = 'P' THEN 'OPEN' ELSE o_orderstatus END AS status,
      CASE WHEN d < DATE '1998-01-01' THEN 'deadline_past' WHEN o_orderstatus = 'P' THEN 'deadline_open' ELSE 'unchanged' END AS reason FROM (SELECT o_orderkey, o_orderstatus, o_orderdate::DATE AS d FROM orders)""",
)
def availability(spark, sf_dir):
    from recordflow.operators import rules

    o = table(spark, sf_dir, "orders").withColumn("d", F.to_date("o_orderdate"))
    status, reason = rules.availability(F.col("o_orderstatus"), F.col("o_orderstatus") == "P", F.col("d"), F.lit("1998-01-01").cast("date"))
    return o.select("o_orderkey", status.alias("status"), reason.alias("reason"))


@query("predisposition", f"WITH {OBS_SQL} SELECT obs_ord, CASE WHEN country IS NULL THEN 'BLOCKED' WHEN detail_status <> 'FULL' THEN 'REVIEW' ELSE 'ELIGIBLE' END AS disposition, list_filter([CASE WHEN detail_status <> 'FULL' THEN 'DETAIL' END, CASE WHEN title = '' THEN 'TITLE' END], lambda x: x IS NOT NULL) AS codes FROM obs")
def predisposition(spark, sf_dir):
    o = observations(spark, sf_dir)
    full = F.col("detail_status") == "FULL"
    codes = F.array_compact(F.array(F.when(~full, "DETAIL"), F.when(F.col("title") == "", "TITLE")))
    d = classify.first_of([(F.col("country").isNull(), "BLOCKED"), (~full, "REVIEW")], "ELIGIBLE")
    return o.select("obs_ord", d.alias("disposition"), codes.alias("codes"))


@query("leak_check", "SELECT event_id, contains(props, '\"k\"') OR contains(props, '9') AS leaks FROM events")
def leak_check(spark, sf_dir):
    leaks = F.exists(F.array(F.lit('"k"'), F.lit("9")), lambda k: F.contains("props", k))
    return events(spark, sf_dir).select("event_id", leaks.alias("leaks"))


# --- aggregates ------------------------------------------------------------------------------------------------


@query("report_summary", "SELECT lang, count(*) AS n, count(*) FILTER (n_chars >= 200) AS actionable, count(*) FILTER (n_chars < 200) AS low, count(DISTINCT source) AS sources FROM documents GROUP BY lang")
def report_summary(spark, sf_dir):
    return docs(spark, sf_dir).groupBy("lang").agg(
        F.count("*").alias("n"), F.count_if(F.col("n_chars") >= 200).alias("actionable"),
        F.count_if(F.col("n_chars") < 200).alias("low"), F.count_distinct("source").alias("sources"),
    )


@query("top_countries", "SELECT source, n, first_seen, row_number() OVER (ORDER BY n DESC, first_seen) AS place FROM (SELECT source, count(*) AS n, min(doc_id) AS first_seen FROM documents GROUP BY source) ORDER BY n DESC, first_seen LIMIT 10")
def top_countries(spark, sf_dir):
    return measures.top(docs(spark, sf_dir), "source", "doc_id", 10)


@query(
    "source_rows",
    "SELECT source, count(*) AS n, count(*) FILTER (lang = 'en') AS en, count(*) FILTER (n_chars < 200) AS short, round(avg(n_chars), 4) AS mean_chars FROM documents GROUP BY source",
)
def source_rows(spark, sf_dir):
    return docs(spark, sf_dir).groupBy("source").agg(
        F.count("*").alias("n"), F.count_if(F.col("lang") == "en").alias("en"),
        F.count_if(F.col("n_chars") < 200).alias("short"), F.round(F.avg("n_chars"), 4).alias("mean_chars"),
    )


@query(
    "source_diagnostics",
    "SELECT user_id, sum(event_id) AS records, list_sort(list(DISTINCT event_type)) AS kinds, CASE WHEN bool_and(event_type <> 'error') THEN 'OK' ELSE 'PARTIAL' END AS status FROM events GROUP BY user_id",
)
def source_diagnostics(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("status", F.when(F.col("event_type") == "error", "ERROR").otherwise("OK"))
    return e.groupBy("user_id").agg(
        F.sum("event_id").alias("records"), F.array_sort(F.collect_set("event_type")).alias("kinds"),
        classify.status_of(F.col("status")).alias("status"),
    )


@query(
    "run_observability",
    """WITH s AS (SELECT user_id, ts::DATE AS day, count(*) AS n, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY ALL)
    SELECT user_id, sum(n)::BIGINT AS events, sum(errors)::BIGINT AS errors, count(*) FILTER (errors = n) AS dead_days, count(*) AS days FROM s GROUP BY user_id""",
)
def run_observability(spark, sf_dir):
    shard = events(spark, sf_dir).groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors")
    )
    return shard.groupBy("user_id").agg(
        F.sum("n").alias("events"), F.sum("errors").alias("errors"),
        F.count_if(F.col("errors") == F.col("n")).alias("dead_days"), F.count("*").alias("days"),
    )


@query("user_summary", "SELECT count(*) AS rows, count(*) FILTER (quality = 1) AS surfaced, count(*) FILTER (toxic = 1) AS blocked FROM labels")
def user_summary(spark, sf_dir):
    return table(spark, sf_dir, "labels").agg(
        F.count("*").alias("rows"), F.count_if(F.col("quality") == 1).alias("surfaced"), F.count_if(F.col("toxic") == 1).alias("blocked")
    )


@query("tag_counts", "SELECT tag, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN contains(text, '|') THEN 'TABLE' END, CASE WHEN contains(text, '!!') THEN 'SHOUT' END, CASE WHEN n_chars < 200 THEN 'SHORT' END], lambda x: x IS NOT NULL)) AS tag FROM documents) GROUP BY tag")
def tag_counts(spark, sf_dir):
    tags = F.array_compact(F.array(F.when(F.contains("text", F.lit("|")), "TABLE"), F.when(F.contains("text", F.lit("!!")), "SHOUT"), F.when(F.col("n_chars") < 200, "SHORT")))
    return docs(spark, sf_dir).select(F.explode(tags).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


@query("token_metering", "SELECT role, sum(length(text))::BIGINT AS chars, sum((length(text) + 3) // 4)::BIGINT AS tokens, count(*) AS calls FROM conversations GROUP BY role")
def token_metering(spark, sf_dir):
    n = F.length("text")
    return table(spark, sf_dir, "conversations").groupBy("role").agg(
        F.sum(n).alias("chars"), F.sum(F.floor((n + 3) / 4)).cast("long").alias("tokens"), F.count("*").alias("calls")
    )


@query("coverage_by_country", "SELECT lang, list_sort(list(DISTINCT source)) AS sources, bool_and(n_chars > 0) AS complete FROM documents GROUP BY lang")
def coverage_by_country(spark, sf_dir):
    return docs(spark, sf_dir).groupBy("lang").agg(F.array_sort(F.collect_set("source")).alias("sources"), F.bool_and(F.col("n_chars") > 0).alias("complete"))


@query("overlap_histogram", "SELECT holders, count(*) AS items FROM (SELECT text, count(DISTINCT source) AS holders FROM documents GROUP BY text) GROUP BY holders")
def overlap_histogram(spark, sf_dir):
    return measures.overlap_histogram(docs(spark, sf_dir).select(F.sha2("text", 256).alias("body"), "source"), "body", "source")


@query("having_shared_keys", "SELECT l_partkey, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_suppkey) > 20")
def having_shared_keys(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count_distinct("l_suppkey").alias("suppliers")).where("suppliers > 20")


@query("reference_status", "SELECT lang, count(*) AS n, count(*) - count(DISTINCT text) AS duplicates, bool_and(n_chars > 20) AS valid FROM documents GROUP BY lang")
def reference_status(spark, sf_dir):
    d = docs(spark, sf_dir)
    return d.groupBy("lang").agg(
        F.count("*").alias("n"), (F.count("*") - F.count_distinct(F.sha2("text", 256))).alias("duplicates"), F.bool_and(F.col("n_chars") > 20).alias("valid")
    )


def _labelled(spark, sf_dir):
    return table(spark, sf_dir, "labels").join(docs(spark, sf_dir).select("doc_id", "n_chars", "text"), "doc_id").select(
        "doc_id", (F.col("quality") == 1).alias("expected"), (~F.contains("text", F.lit("!!"))).alias("predicted")
    )


_LAB = "p AS (SELECT doc_id, quality = 1 AS expected, NOT contains(text, '!!') AS predicted FROM labels JOIN documents USING (doc_id))"


@query("confusion_matrix", f"WITH {_LAB} SELECT expected, predicted, count(*) AS n FROM p GROUP BY ALL")
def confusion_matrix(spark, sf_dir):
    return measures.confusion(_labelled(spark, sf_dir), "expected", "predicted")


@query(
    "prf_gates",
    f"""WITH {_LAB}, s AS (SELECT count(*) AS n, count(*) FILTER (expected = predicted) AS ok, count(*) FILTER (predicted) AS np, count(*) FILTER (expected) AS ne, count(*) FILTER (expected AND predicted) AS hit FROM p)
    SELECT n, round(ok / n, 6) AS accuracy, round(hit / np, 6) AS precision, round(hit / ne, 6) AS recall, hit / np >= 0.8 AND hit / ne >= 0.8 AS passed FROM s""",
)
def prf_gates(spark, sf_dir):
    s = measures.scores(_labelled(spark, sf_dir), F.col("expected"), F.col("predicted"))
    return s.withColumn("passed", F.expr("precision >= 0.8 AND recall >= 0.8"))


@query(
    "nearest_rank_percentile",
    """WITH r AS (SELECT lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY n_chars) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM documents)
    SELECT lang, p, n_chars AS value FROM r, (SELECT unnest([0.5, 0.9, 0.99]::DOUBLE[]) AS p) WHERE i = round_even((n - 1) * p, 0)""",
)
def nearest_rank_percentile(spark, sf_dir):
    return measures.nearest_rank(docs(spark, sf_dir), "lang", "n_chars", [0.5, 0.9, 0.99])


@query("size_profile", "SELECT doc_id, strlen(text)::BIGINT AS bytes FROM documents ORDER BY bytes DESC, doc_id LIMIT 20")
def size_profile(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.octet_length("text").cast("long").alias("bytes")).orderBy(F.desc("bytes"), "doc_id").limit(20)


@query(
    "prefix_inventory",
    r"""WITH p AS (SELECT split_part(k, '/', 1) AS p1, split_part(k, '/', 2) AS p2, n FROM (SELECT regexp_replace(url, '^[a-z]+://', '') AS k, strlen(html)::BIGINT AS n FROM pages))
    SELECT p1, NULL AS p2, count(*) AS objects, sum(n)::BIGINT AS bytes, 1 AS level FROM p GROUP BY p1 UNION ALL SELECT p1, p2, count(*), sum(n)::BIGINT, 2 FROM p GROUP BY p1, p2""",
)
def prefix_inventory(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return measures.prefix_inventory(p, F.regexp_replace("url", "^[a-z]+://", ""), F.octet_length("html").cast("long"))


@query("month_counts", "SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL")
def month_counts(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderstatus").agg(F.count("*").alias("n"))


@query("id_digest", "SELECT source, sha256(string_agg(doc_id::VARCHAR, chr(10) ORDER BY doc_id::VARCHAR)) AS digest FROM documents GROUP BY source")
def id_digest(spark, sf_dir):
    return measures.sorted_digest(docs(spark, sf_dir), "source", "doc_id")


@query("id_digest_any_size")
def id_digest_any_size(spark, sf_dir):
    return measures.id_digest(docs(spark, sf_dir), "doc_id")


@query("migration_plan", "SELECT source, count(*) AS affected, sum(strlen(text))::BIGINT AS bytes_before, sum(strlen(substring(text, 1, 200)))::BIGINT AS bytes_after FROM documents WHERE n_chars > 200 GROUP BY source")
def migration_plan(spark, sf_dir):
    return docs(spark, sf_dir).where("n_chars > 200").groupBy("source").agg(
        F.count("*").alias("affected"), F.sum(F.octet_length("text")).alias("bytes_before"), F.sum(F.octet_length(F.substring("text", 1, 200))).alias("bytes_after")
    )


@query(
    "url_occurrences",
    "WITH u AS (SELECT page_id, split_part(url, '/', 3) AS host FROM pages), k AS (SELECT host, count(DISTINCT page_id) AS n FROM u GROUP BY host) SELECT page_id, host, n, CASE WHEN n > 1 THEN '' ELSE host END AS projected FROM u JOIN k USING (host)",
)
def url_occurrences(spark, sf_dir):
    u = table(spark, sf_dir, "pages").select("page_id", F.split_part("url", F.lit("/"), F.lit(3)).alias("host"))
    k = u.groupBy("host").agg(F.count_distinct("page_id").alias("n"))
    return u.join(k, "host").select("page_id", "host", "n", F.when(F.col("n") > 1, "").otherwise(F.col("host")).alias("projected"))


# --- windows and samples ---------------------------------------------------------------------------------------


@query("stable_rank", "SELECT doc_id, sha256('s1|b1|' || doc_id) AS stable_rank FROM documents")
def stable_rank(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", sampling.stable_rank("s1", "b1", F.col("doc_id")).alias("stable_rank"))


@query(
    "round_robin_sample",
    """WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY sha256('s1|b1|' || doc_id), doc_id) AS turn FROM documents)
    SELECT doc_id, source FROM r ORDER BY turn, sha256('s1|b1|' || source), doc_id LIMIT 97""",
)
def round_robin_sample(spark, sf_dir):
    return sampling.round_robin(docs(spark, sf_dir).select("doc_id", "source"), "doc_id", "source", 97, "s1", "b1")


@query(
    "multi_bucket_sample",
    """WITH p AS (SELECT doc_id FROM documents WHERE lang = 'es' AND n_chars > 1000), r1 AS (SELECT * FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM p)),
    a AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY sha256('s2|priority|' || doc_id), doc_id) AS turn FROM r1 WHERE lang = 'de'),
    b AS (SELECT doc_id FROM a ORDER BY turn, sha256('s2|priority|' || source), doc_id LIMIT 20),
    c AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY sha256('s2|blind|' || doc_id), doc_id) AS turn FROM r1 WHERE doc_id NOT IN (SELECT doc_id FROM b)),
    e AS (SELECT doc_id FROM c ORDER BY turn, sha256('s2|blind|' || source), doc_id LIMIT 20)
    SELECT doc_id, 'POSITIVE' AS bucket FROM p UNION ALL SELECT doc_id, 'PRIORITY' FROM b UNION ALL SELECT doc_id, 'BLIND' FROM e""",
)
def multi_bucket_sample(spark, sf_dir):
    d = docs(spark, sf_dir).select("doc_id", "source", "lang", "n_chars")
    positive = (F.col("lang") == "es") & (F.col("n_chars") > 1000)
    return sampling.buckets(d, "doc_id", "source", positive, F.col("lang") == "de", 40, "s2")


@query("first_occurrence", "SELECT sha256(text) AS body, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source FROM documents GROUP BY 1")
def first_occurrence(spark, sf_dir):
    d = docs(spark, sf_dir).select(F.sha2("text", 256).alias("body"), "doc_id", "source")
    return sampling.first_occurrence(d, "body", "doc_id", "source")


@query("audit_sample", "SELECT doc_id, sha256('run1' || chr(0) || doc_id) AS audit_rank FROM documents ORDER BY audit_rank LIMIT 25")
def audit_sample(spark, sf_dir):
    return sampling.audit(docs(spark, sf_dir).select("doc_id"), "doc_id", "run1", 25)


@query(
    "retention_plan",
    """WITH r AS (SELECT o_orderkey, o_custkey, o_orderdate, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS place FROM orders)
    SELECT o_orderkey, place::INT AS place, CASE WHEN place <= 3 THEN 'KEEP' WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 'DELETE' ELSE 'KEEP' END AS action FROM r""",
)
def retention_plan(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    old = F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp")
    plan = sampling.retention(o, "o_custkey", [F.desc("o_orderdate"), F.desc("o_orderkey")], 3, old)
    return plan.select("o_orderkey", "place", "action")


@query("latest_per_day", "SELECT user_id, ts::DATE AS day, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY ALL")
def latest_per_day(spark, sf_dir):
    return sampling.latest_per_day(events(spark, sf_dir), "user_id", F.to_date("ts"), F.struct("ts", "event_id"), "event_id", "event_type")


@query(
    "missing_days",
    "WITH d AS (SELECT DISTINCT user_id, ts::DATE AS day FROM events), s AS (SELECT user_id, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE AS day FROM d GROUP BY user_id) SELECT user_id, day FROM s EXCEPT SELECT user_id, day FROM d",
)
def missing_days(spark, sf_dir):
    return sampling.missing_days(events(spark, sf_dir), "user_id", F.to_date("ts"))


@query(
    "lifecycle_balance",
    """WITH s AS (SELECT user_id, d, sum(d) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT *, CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN -1 ELSE 0 END AS d FROM events))
    SELECT user_id, greatest(0, -min(s))::BIGINT AS orphan_done, (sum(d) + greatest(0, -min(s)))::BIGINT AS incomplete FROM s GROUP BY user_id""",
)
def lifecycle_balance(spark, sf_dir):
    step = F.when(F.col("event_type") == "signup", 1).when(F.col("event_type") == "purchase", -1).otherwise(0)
    return sampling.balance(events(spark, sf_dir), "user_id", ["ts", "event_id"], step)


@query("alias_owners", f"WITH {_ALIASES} SELECT alias, list_sort(list(DISTINCT user_id)) AS owners FROM al GROUP BY alias HAVING count(DISTINCT user_id) > 1")
def alias_owners(spark, sf_dir):
    return _aliases(spark, sf_dir).groupBy("alias").agg(F.array_sort(F.collect_set("user_id")).alias("owners")).where("size(owners) > 1")


# --- sorts and sets --------------------------------------------------------------------------------------------


@query("user_sort", "SELECT doc_id, row_number() OVER (PARTITION BY lang ORDER BY n_chars < 200, n_chars DESC, lower(source), doc_id)::INT AS place FROM documents")
def user_sort(spark, sf_dir):
    w = W.partitionBy("lang").orderBy(F.col("n_chars") < 200, F.desc("n_chars"), F.lower("source"), "doc_id")
    return docs(spark, sf_dir).select("doc_id", F.row_number().over(w).alias("place"))


@query("review_sort", "SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY coalesce(strftime(CASE WHEN o_orderkey % 3 > 0 THEN o_orderdate END, '%Y-%m-%d'), '9999-12-31'), lower(o_orderpriority), o_orderkey)::INT AS place FROM orders")
def review_sort(spark, sf_dir):
    due = F.coalesce(F.date_format(F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderdate")), "yyyy-MM-dd"), F.lit("9999-12-31"))
    w = W.partitionBy("o_orderstatus").orderBy(due, F.lower("o_orderpriority"), "o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.row_number().over(w).alias("place"))


@query("disagreement_sort", "SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY role <> 'assistant', length(text) DESC, turn)::INT AS place FROM conversations")
def disagreement_sort(spark, sf_dir):
    w = W.partitionBy("conv_id").orderBy(F.col("role") != "assistant", F.desc(F.length("text")), "turn")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.row_number().over(w).alias("place"))


@query("human_queue", "SELECT doc_id, priority, n_chars FROM (SELECT doc_id, CASE WHEN toxic = 1 THEN 3 WHEN quality = 0 THEN 2 ELSE 1 END AS priority, n_chars FROM labels JOIN documents USING (doc_id)) ORDER BY priority DESC, n_chars DESC, doc_id LIMIT 50")
def human_queue(spark, sf_dir):
    met = table(spark, sf_dir, "labels").join(docs(spark, sf_dir).select("doc_id", "n_chars"), "doc_id")
    p = F.when(F.col("toxic") == 1, 3).when(F.col("quality") == 0, 2).otherwise(1)
    return met.select("doc_id", p.alias("priority"), "n_chars").orderBy(F.desc("priority"), F.desc("n_chars"), "doc_id").limit(50)


@query("union_fanin", "SELECT source AS origin, doc_id AS id FROM documents WHERE lang = 'en' UNION ALL SELECT 'conversation', conv_id FROM conversations WHERE turn = 0")
def union_fanin(spark, sf_dir):
    a = docs(spark, sf_dir).where("lang = 'en'").select(F.col("source").alias("origin"), F.col("doc_id").alias("id"))
    b = table(spark, sf_dir, "conversations").where("turn = 0").select(F.lit("conversation").alias("origin"), F.col("conv_id").alias("id"))
    return a.unionByName(b)


@query(
    "ordered_distinct",
    r"WITH w AS (SELECT doc_id, unnest(l) AS w, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(trim(regexp_replace(text, '\s+', ' ', 'g')), ' ') AS l FROM documents)), f AS (SELECT doc_id, w, min(i) AS i FROM w GROUP BY ALL) SELECT doc_id, list(w ORDER BY i) AS codes FROM f GROUP BY doc_id",
)
def ordered_distinct(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.array_distinct(F.split(text.squeeze(F.col("text")), " ")).alias("codes"))


@query(
    "set_ops",
    "WITH a AS (SELECT doc_id FROM documents WHERE n_chars > 1000), b AS (SELECT doc_id FROM labels) SELECT 'both' AS side, doc_id FROM (SELECT doc_id FROM a INTERSECT SELECT doc_id FROM b) UNION ALL SELECT 'only', doc_id FROM (SELECT doc_id FROM a EXCEPT SELECT doc_id FROM b)",
)
def set_ops(spark, sf_dir):
    a, b = docs(spark, sf_dir).where("n_chars > 1000").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id")
    both = a.intersect(b).select(F.lit("both").alias("side"), "doc_id")
    return both.unionByName(a.subtract(b).select(F.lit("only").alias("side"), "doc_id"))
