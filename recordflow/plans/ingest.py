"""Sources: pages as listings and details, paginated scans, bundles, caches."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recordflow.operators.joins import last_of
from recordflow.sources import bundles, html, paginated
from recordflow.sources.shared import shared_dir

from .adapters import table
from .registry import query


def pages(spark, sf_dir):
    return table(spark, sf_dir, "pages")


@query("html_text")
def html_text(spark, sf_dir):
    return html.texts(pages(spark, sf_dir))


@query("page_anchors", """SELECT page_id, href FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]+)"', 1)) AS href FROM pages) GROUP BY ALL""")
def page_anchors(spark, sf_dir):
    return html.longest_labels(html.anchors(pages(spark, sf_dir))).select("page_id", "href")


@query("anchor_labels")
def anchor_labels(spark, sf_dir):
    return html.longest_labels(html.anchors(pages(spark, sf_dir)))


@query("next_link")
def next_link(spark, sf_dir):
    return html.next_links(pages(spark, sf_dir))


@query("jsonld_find")
def jsonld_find(spark, sf_dir):
    return html.structured_data(pages(spark, sf_dir), "JobPosting")


_LISTED = """l AS (SELECT lang AS listing, doc_id, (row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) // 10 AS page, count(*) OVER (PARTITION BY lang) AS n FROM documents)"""


@query(
    "paginated_scan",
    f"""WITH {_LISTED} SELECT listing, count(*) FILTER (listing <> 'fr' OR page < 2) AS rows, CASE listing WHEN 'fr' THEN 'request_failed' WHEN 'de' THEN 'last_page' WHEN 'es' THEN 'advertised_total_reached' ELSE 'empty_page' END AS stop_reason,
    listing NOT IN ('fr', 'de') AS complete, (CASE WHEN listing = 'fr' THEN 2 ELSE max(page) + 1 + (listing = 'en')::INT END)::INT AS pages, CASE listing WHEN 'de' THEN max(n) + 5 WHEN 'es' THEN max(n) END AS advertised_total FROM l GROUP BY listing""",
)
def paginated_scan(spark, sf_dir):
    """Documents as listings by language, ten rows a page: one fails on its third page, one advertises more than it has."""
    d = table(spark, sf_dir, "documents")
    place = F.floor((F.row_number().over(W.partitionBy("lang").orderBy("doc_id")) - 1) / 10).cast("int")
    rows = d.select(F.col("lang").alias("listing"), "doc_id", (place + 1).alias("page"), F.count("*").over(W.partitionBy("lang")).alias("n"))
    listing = F.col("listing")
    last = F.max("page").over(W.partitionBy("listing"))
    stored = rows.groupBy("listing", "page", "n").agg(F.sort_array(F.collect_list(F.struct(F.col("doc_id").cast("string").alias("id"), F.lit("x").alias("payload")))).alias("rows"))
    stored = stored.select(
        "listing", "page", "rows",
        F.when(F.col("page") > 1, F.lit(0)).when(listing == "de", F.col("n") + 5).when(listing == "es", F.col("n")).cast("long").alias("total"),
        F.when(listing == "de", F.col("page") < last).alias("has_next"),
        F.when((listing == "fr") & (F.col("page") == 3), "503").alias("error"),
    )
    scan = paginated.scan_stored(stored)
    one = lambda c: F.max(c).alias(c)
    return scan.groupBy("listing").agg(F.count("id").alias("rows"), one("stop_reason"), one("complete"), one("pages"), one("advertised_total"))


@query("partition_distrust", "WITH s AS (SELECT lang, list_sort(list(DISTINCT source)) AS ids FROM documents GROUP BY lang) SELECT lang, count(*) OVER (PARTITION BY ids) > 1 AS untrusted FROM s")
def partition_distrust(spark, sf_dir):
    """Partitions that returned one and the same set of ids are not believed."""
    sets = table(spark, sf_dir, "documents").groupBy("lang").agg(F.sha2(F.array_join(F.array_sort(F.collect_set("source")), "\n"), 256).alias("ids"))
    many = sets.groupBy("ids").agg((F.count("*") > 1).alias("untrusted"))
    return sets.join(many, "ids").select("lang", "untrusted")


@query("shard_fan_in", "SELECT 's' || (doc_id % 3) AS shard_id, count(*) AS n FROM documents WHERE doc_id % 3 < 2 GROUP BY 1")
def shard_fan_in(spark, sf_dir):
    """Three bundles, one of them failed, gathered again."""
    root = shared_dir(spark, "bundles")
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    for i in range(3):
        bundles.write_bundle(d.where(F.col("doc_id") % 3 == i), root, "r1", f"s{i}", "ERROR" if i == 2 else "OK")
    records, _ = bundles.fan_in(spark, root, "r1")
    return records.groupBy("shard_id").agg(F.count("*").alias("n"))


@query("cache_last_write", "SELECT key, arg_max(value, line_no) AS value FROM (SELECT user_id AS key, event_id AS line_no, event_type AS value FROM events WHERE event_type <> 'error') GROUP BY key")
def cache_last_write(spark, sf_dir):
    """A log of JSON lines, bad ones skipped, the last value of each key."""
    line = F.when(F.col("event_type") == "error", "{bad").otherwise(F.to_json(F.struct(F.col("user_id").alias("key"), F.col("event_type").alias("value"))))
    log = table(spark, sf_dir, "events").select(F.col("event_id").alias("line_no"), line.alias("line"))
    parsed = log.select("line_no", F.from_json("line", "key long, value string").alias("x")).where("x.key IS NOT NULL")
    return last_of(parsed.select("line_no", "x.*"), "key", F.col("line_no"), "value")


@query("storage_prune", "SELECT event_id, strlen('{\"a\":' || event_id || '}')::BIGINT AS bytes FROM events")
def storage_prune(spark, sf_dir):
    """Stored structs without fields that can be derived again."""
    whole = F.struct(F.col("event_id").alias("a"), F.col("props").alias("derived"))
    return table(spark, sf_dir, "events").select("event_id", F.octet_length(F.to_json(whole.dropFields("derived"))).cast("long").alias("bytes"))
