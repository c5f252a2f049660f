"""Decisions while listings are collected, and what a report publishes."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordflow.operators import collection
from recordflow.sources import bundles
from recordflow.sources.shared import shared_dir

from .adapters import table
from .registry import query


@query(
    "country_resolution",
    """WITH d AS (SELECT doc_id, CASE WHEN doc_id % 13 > 0 THEN lang END AS listed, CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN 'it' ELSE lang END AS detail, doc_id % 11 = 0 AS bad, doc_id % 2 = 0 AS card FROM documents),
    a AS (SELECT *, coalesce(listed, CASE WHEN detail IN ('en', 'de', 'fr', 'es') THEN detail END) AS asked FROM d)
    SELECT doc_id, coalesce(detail, CASE WHEN NOT bad THEN asked END) AS country,
      CASE WHEN detail <> asked THEN 'DETAIL_MISMATCH' WHEN detail IS NOT NULL THEN 'DETAIL_MATCH' WHEN bad THEN 'UNTRUSTED_IDENTICAL_RESULT_SET' WHEN card THEN 'LISTING_CARD_VALIDATED' ELSE 'FILTER_URL_VALIDATED' END AS validation
    FROM a WHERE asked IS NOT NULL""",
)
def country_resolution(spark, sf_dir):
    i, lang = F.col("doc_id"), F.col("lang")
    detail = F.when(i % 5 == 0, F.lit(None).cast("string")).when(i % 7 == 0, "it").otherwise(lang)
    x = collection.country(F.when(i % 13 > 0, lang), detail, i % 11 == 0, i % 2 == 0, ["en", "de", "fr", "es"])
    return table(spark, sf_dir, "documents").select("doc_id", x.alias("x")).where("x IS NOT NULL").select("doc_id", "x.country", "x.validation")


@query(
    "page_resets",
    """WITH e AS (SELECT DISTINCT event_type AS listing, event_id // 40 AS page, user_id % 8 AS item FROM events),
    s AS (SELECT *, min(page) OVER (PARTITION BY listing, item) AS seen FROM e),
    l AS (SELECT listing, page, list_sort(list(item)) AS ids, count(*) AS items, count(*) FILTER (seen = page) AS new_items FROM s GROUP BY ALL),
    o AS (SELECT *, row_number() OVER w AS place, first_value(ids) OVER w AS start FROM l WINDOW w AS (PARTITION BY listing ORDER BY page))
    SELECT listing, page, items, new_items, CASE WHEN place = 1 THEN 'FIRST' WHEN new_items > 0 THEN 'NEW' WHEN place >= 3 AND ids = start THEN 'RESET' ELSE 'REPEATED' END AS kind FROM o""",
)
def page_resets(spark, sf_dir):
    e = table(spark, sf_dir, "events").selectExpr("event_type", "event_id div 40 AS page", "user_id % 8 AS item")
    return collection.page_kinds(e, "event_type", "page", "item")


@query("tenant_listings", "SELECT l_suppkey, l_partkey, arg_min(l_orderkey, (l_shipdate, l_orderkey, l_linenumber)) AS l_orderkey, min(l_shipdate) AS l_shipdate FROM lineitem GROUP BY ALL")
def tenant_listings(spark, sf_dir):
    order = ["l_shipdate", "l_orderkey", "l_linenumber"]
    return collection.across_listings(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_partkey", order, ["l_orderkey", "l_shipdate"])


@query("table_rows", "SELECT n_nationkey, n_name AS name, n_regionkey::VARCHAR AS region FROM nation WHERE n_nationkey % 3 > 0")
def table_rows(spark, sf_dir):
    """Tables with a header row, and rows of six cells or, for some, of five."""
    n = table(spark, sf_dir, "nation")
    page = F.concat(
        F.lit("<table><tr><th>Name</th><th>Region</th></tr>\n<TR class='r'><td> <b>"), "n_name", F.lit("</b>\n</td><td x='1'>"),
        F.col("n_regionkey").cast("string"), F.lit("</td><td></td><td>-</td><td>-</td>"),
        F.when(F.col("n_nationkey") % 3 > 0, "<td>-</td>").otherwise(""), F.lit("</TR></table>"),
    )
    rows = n.select("n_nationkey", F.explode(collection.table_rows(page, 6)).alias("r"))
    return rows.select("n_nationkey", F.get("r", 0).alias("name"), F.get("r", 1).alias("region"))


@query(
    "detail_attempts",
    """WITH t AS (SELECT conv_id, role <> 'user' AS away, turn, CASE length(text) % 4 WHEN 0 THEN 'BLOCKED' WHEN 1 THEN 'FETCH_FAILED' WHEN 2 THEN 'PARTIAL' ELSE 'FULL' END AS o FROM conversations WHERE text IS NOT NULL)
    SELECT conv_id, coalesce(arg_min(o, (away, turn, o)) FILTER (o NOT IN ('BLOCKED', 'FETCH_FAILED')), arg_max(o, (away, turn, o))) AS outcome, count(*) AS tries FROM t GROUP BY conv_id""",
)
def detail_attempts(spark, sf_dir):
    kind = F.length("text") % 4
    o = F.when(kind == 0, "BLOCKED").when(kind == 1, "FETCH_FAILED").when(kind == 2, "PARTIAL").otherwise("FULL")
    return collection.settled_attempts(table(spark, sf_dir, "conversations").where("text IS NOT NULL"), "conv_id", F.col("role") != "user", "turn", o)


@query(
    "identity_aliases",
    """SELECT doc_id, list_filter([(CASE WHEN doc_id % 3 = 0 THEN '0|canonical:c' || doc_id END), '1|source_id:' || source || ':' || doc_id, (CASE WHEN n_chars >= 200 THEN '2|url:' || lang || '/' || (doc_id % 10) END), '3|source_record:' || source || ':r' || doc_id], lambda x: x IS NOT NULL) AS aliases FROM documents""",
)
def identity_aliases(spark, sf_dir):
    i = F.col("doc_id").cast("string")
    url = F.when(F.col("n_chars") >= 200, F.concat("lang", F.lit("/"), (F.col("doc_id") % 10).cast("string")))
    canonical = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("C"), i))
    found = collection.aliases(canonical, F.col("source"), i, [url, url], F.concat(F.lit("R"), i))
    flat = F.transform(found, lambda x: F.concat(x["rank"].cast("string"), F.lit("|"), x["alias"]))
    return table(spark, sf_dir, "documents").select("doc_id", flat.alias("aliases"))


@query(
    "feasibility_counts",
    """WITH v AS (SELECT 'lang' AS dimension, lang AS value FROM documents UNION ALL SELECT 'source', source FROM documents UNION ALL SELECT 'size', CASE WHEN n_chars >= 200 THEN 'FULL' ELSE 'SHORT' END FROM documents),
    c AS (SELECT dimension, value, count(*) AS n FROM v GROUP BY ALL)
    SELECT dimension, value, n, row_number() OVER (PARTITION BY dimension ORDER BY n DESC, value)::INT AS place FROM c QUALIFY place <= 25""",
)
def feasibility_counts(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("lang", "source", F.when(F.col("n_chars") >= 200, "FULL").otherwise("SHORT").alias("size"))
    return collection.counts_by(d, ["lang", "source", "size"], 25)


@query(
    "metric_flatten",
    "WITH d AS (SELECT user_id, count(*)::DOUBLE AS events, max(event_id)::DOUBLE AS last_id, (max(event_id) FILTER (event_type = 'error'))::DOUBLE AS last_error FROM events GROUP BY user_id) SELECT user_id, metric, value FROM (UNPIVOT d ON events, last_id, last_error INTO NAME metric VALUE value)",
)
def metric_flatten(spark, sf_dir):
    d = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count("*").alias("events"), F.max("event_id").alias("last_id"),
        F.max(F.when(F.col("event_type") == "error", F.col("event_id"))).alias("last_error"),
    )
    return collection.flattened(d, ["user_id"], ["events", "last_id", "last_error"])


@query(
    "run_changes",
    "SELECT o_orderkey, lag(o_orderstatus) OVER w AS previous, CASE WHEN row_number() OVER w = 1 THEN 'NEW' WHEN lag(o_orderstatus) OVER w IS NOT DISTINCT FROM o_orderstatus THEN 'SAME' ELSE 'CHANGED' END AS change FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)",
)
def run_changes(spark, sf_dir):
    o = collection.run_changes(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderstatus")
    return o.select("o_orderkey", "previous", "change")


@query("visible_rows", "SELECT doc_id FROM documents WHERE NOT coalesce(contains(lower(text), 'password') OR n_chars < 20, false) AND NOT coalesce(lang = 'es' AND n_chars < 200, false)")
def visible_rows(spark, sf_dir):
    """Rows that neither tier of exclusions names."""
    first = F.contains(F.lower("text"), F.lit("password")) | (F.col("n_chars") < 20)
    second = (F.col("lang") == "es") & (F.col("n_chars") < 200)
    shown = [~F.coalesce(t, F.lit(False)) for t in (first, second)]
    return table(spark, sf_dir, "documents").where(shown[0] & shown[1]).select("doc_id")


@query("gap_register", "SELECT source, CASE WHEN max(n_chars) < 200 THEN 'NO_DETAIL' WHEN min(n_chars) < 200 THEN 'PARTIAL_DETAIL' ELSE 'COMPLETE' END AS gap, count(*) AS n, count(DISTINCT lang) AS languages FROM documents GROUP BY source")
def gap_register(spark, sf_dir):
    gap = F.when(F.max("n_chars") < 200, "NO_DETAIL").when(F.min("n_chars") < 200, "PARTIAL_DETAIL").otherwise("COMPLETE")
    return table(spark, sf_dir, "documents").groupBy("source").agg(gap.alias("gap"), F.count("*").alias("n"), F.count_distinct("lang").alias("languages"))


@query("report_publish", "SELECT lang, count(*) AS n, 2 AS generation FROM documents GROUP BY lang")
def report_publish(spark, sf_dir):
    """Payload first, read back, pointer last; a second report takes the place of the first."""
    root = shared_dir(spark, "reports")
    rows = table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n"))
    bundles.publish_report(rows.limit(0), root)
    n = bundles.publish_report(rows, root)
    return bundles.load_state(spark, root).withColumn("generation", F.lit(n))
