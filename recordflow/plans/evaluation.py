"""Rule evaluators, report views and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordflow.functions import text
from recordflow.operators import checks, rules

from .adapters import OBS_SQL, observations, table
from .registry import query
from .scalars import T_WS, WS

CORE, ADJACENT = ["tion", "ung", "cion", "ment"], ["eren", "thou"]
_HITS = f"""h AS (SELECT doc_id, n_chars, lang, source, {T_WS} AS t FROM documents),
  s AS (SELECT *, list_filter({CORE!r}, lambda p: contains(t, p)) AS core, list_filter({CORE!r}, lambda p: contains(substring(t, 1, 40), p)) AS head, list_filter({ADJACENT!r}, lambda p: contains(t, p)) AS adj FROM h),
  dim AS (SELECT *, CASE WHEN len(core) >= 3 OR (len(head) > 0 AND len(core) >= 2) THEN 'STRONG' WHEN len(core) >= 1 THEN 'GOOD' WHEN len(adj) > 0 THEN 'ADJACENT' ELSE 'UNCLEAR' END AS scientific,
    CASE WHEN contains(t, 'password') THEN 'BLOCKED' WHEN contains(t, '!!') THEN 'REVIEW' ELSE 'OK' END AS mobility FROM s)"""


def dimensions(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source", text.norm_ws(F.col("text")).alias("t"))
    head = F.substring("t", 1, 40)
    t = F.col("t")
    return d.select(
        "*",
        rules.dimension(text.phrase_hits(t, CORE), text.phrase_hits(head, CORE), text.phrase_hits(t, ADJACENT)).alias("scientific"),
        F.when(F.contains(t, F.lit("password")), "BLOCKED").when(F.contains(t, F.lit("!!")), "REVIEW").otherwise("OK").alias("mobility"),
    )


@query("rule_dimensions", f"WITH {_HITS} SELECT doc_id, scientific, mobility FROM dim")
def rule_dimensions(spark, sf_dir):
    return dimensions(spark, sf_dir).select("doc_id", "scientific", "mobility")


_ROUTE = "CASE WHEN mobility = 'BLOCKED' THEN 'SKIP' WHEN n_chars < 200 THEN 'REVIEW' WHEN scientific = 'STRONG' AND mobility = 'OK' THEN 'STRONG_APPLY' WHEN scientific IN ('STRONG', 'GOOD') THEN 'GOOD_APPLY' ELSE 'LOW_PRIORITY' END"


@query("route_case", f"WITH {_HITS} SELECT doc_id, {_ROUTE} AS route FROM dim")
def route_case(spark, sf_dir):
    return routed(spark, sf_dir).select("doc_id", "route")


def route_rules():
    go = lambda x: {"route": F.lit(x)}
    strong, ok = F.col("scientific") == "STRONG", F.col("mobility") == "OK"
    return [
        rules.Rule("blocker", F.col("mobility") == "BLOCKED", go("SKIP")),
        rules.Rule("no_detail", F.col("n_chars") < 200, go("REVIEW")),
        rules.Rule("strong", strong & ok, go("STRONG_APPLY")),
        rules.Rule("good", strong | (F.col("scientific") == "GOOD"), go("GOOD_APPLY")),
    ]


def routed(spark, sf_dir):
    return rules.decide(dimensions(spark, sf_dir), route_rules(), {"route": F.lit("LOW_PRIORITY")})


@query(
    "decision_list",
    f"WITH {_HITS} SELECT doc_id, {_ROUTE} AS route, CASE WHEN mobility = 'BLOCKED' THEN ['blocker'] WHEN n_chars < 200 THEN ['no_detail'] WHEN scientific = 'STRONG' AND mobility = 'OK' THEN ['strong'] WHEN scientific IN ('STRONG', 'GOOD') THEN ['good'] ELSE [] END AS fired FROM dim",
)
def decision_list(spark, sf_dir):
    return routed(spark, sf_dir).select("doc_id", "route", "fired")


@query(
    "layered_rules",
    f"WITH {_HITS}, a AS (SELECT *, {_ROUTE} AS r FROM dim) SELECT doc_id, CASE WHEN r = 'STRONG_APPLY' AND lang = 'es' THEN 'REVIEW' WHEN r = 'LOW_PRIORITY' AND n_chars > 2000 THEN 'GOOD_APPLY' ELSE r END AS route FROM a",
)
def layered_rules(spark, sf_dir):
    route = F.col("route")
    amend = [
        rules.Rule("language", (route == "STRONG_APPLY") & (F.col("lang") == "es"), {"route": F.lit("REVIEW")}),
        rules.Rule("long", (route == "LOW_PRIORITY") & (F.col("n_chars") > 2000), {"route": F.lit("GOOD_APPLY")}),
    ]
    out = rules.layered(dimensions(spark, sf_dir), [(route_rules(), {"route": F.lit("LOW_PRIORITY")}), (amend, {"route": route})])
    return out.select("doc_id", "route")


@query("route_recall_first", f"WITH {_HITS} SELECT doc_id, CASE WHEN contains(t, 'password') OR (regexp_matches(t, 'ung') AND contains(t, '!!')) THEN 'HIDDEN' WHEN n_chars < 200 THEN 'NEEDS_DETAIL_REVIEW' ELSE 'JOBS' END AS route FROM dim")
def route_recall_first(spark, sf_dir):
    t = F.col("t")
    shown = [
        rules.Rule("excluded", F.contains(t, F.lit("password")) | (t.rlike("ung") & F.contains(t, F.lit("!!"))), {"route": F.lit("HIDDEN")}),
        rules.Rule("short", F.col("n_chars") < 200, {"route": F.lit("NEEDS_DETAIL_REVIEW")}),
    ]
    return rules.decide(dimensions(spark, sf_dir), shown, {"route": F.lit("JOBS")}).select("doc_id", "route")


@query("role_detection", f"WITH {OBS_SQL} SELECT obs_ord, CASE WHEN regexp_matches(t, 'stu') THEN 'STUDENT' WHEN country = 'DE' AND regexp_matches(t, 'ver') THEN 'SENIOR' WHEN regexp_matches(t, 'tion') THEN 'GENERIC' ELSE 'UNKNOWN' END AS role FROM (SELECT *, {WS.format(x='title')} AS t FROM obs)")
def role_detection(spark, sf_dir):
    from recordflow.operators.classify import first_of

    t = text.norm_ws(F.col("title"))
    role = first_of([(t.rlike("stu"), "STUDENT"), ((F.col("country") == "DE") & t.rlike("ver"), "SENIOR"), (t.rlike("tion"), "GENERIC")], "UNKNOWN")
    return observations(spark, sf_dir).select("obs_ord", role.alias("role"))


@query("report_views", f"WITH {_HITS}, a AS (SELECT *, {_ROUTE} AS route FROM dim) SELECT 'actionable' AS view, doc_id FROM a WHERE route IN ('STRONG_APPLY', 'GOOD_APPLY') UNION ALL SELECT 'review', doc_id FROM a WHERE route = 'REVIEW' UNION ALL SELECT 'low', doc_id FROM a WHERE route = 'LOW_PRIORITY' UNION ALL SELECT 'audit', doc_id FROM a")
def report_views(spark, sf_dir):
    views = F.array_compact(
        F.array(
            F.when(F.col("route").isin("STRONG_APPLY", "GOOD_APPLY"), "actionable"),
            F.when(F.col("route") == "REVIEW", "review"),
            F.when(F.col("route") == "LOW_PRIORITY", "low"),
            F.lit("audit"),
        )
    )
    return routed(spark, sf_dir).select(F.explode(views).alias("view"), "doc_id")  # one scan for all views


@query("jobs_rows", f"WITH {_HITS}, a AS (SELECT *, {_ROUTE} AS route FROM dim) SELECT doc_id, source, route, row_number() OVER (PARTITION BY lang ORDER BY route <> 'STRONG_APPLY', n_chars DESC, doc_id)::INT AS place FROM a WHERE route IN ('STRONG_APPLY', 'GOOD_APPLY')")
def jobs_rows(spark, sf_dir):
    from pyspark.sql import Window as W

    w = W.partitionBy("lang").orderBy(F.col("route") != "STRONG_APPLY", F.desc("n_chars"), "doc_id")
    shown = routed(spark, sf_dir).where(F.col("route").isin("STRONG_APPLY", "GOOD_APPLY"))
    return shown.select("doc_id", "source", "route", F.row_number().over(w).alias("place"))


@query("review_more_rows", f"WITH {_HITS}, a AS (SELECT *, {_ROUTE} AS route FROM dim) SELECT min(doc_id) AS doc_id, sha256(t) AS body FROM a WHERE route IN ('REVIEW', 'LOW_PRIORITY') AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1) GROUP BY t")
def review_more_rows(spark, sf_dir):
    known = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    rest = routed(spark, sf_dir).where(F.col("route").isin("REVIEW", "LOW_PRIORITY")).join(known, "doc_id", "left_anti")
    return rest.groupBy(F.sha2("t", 256).alias("body")).agg(F.min("doc_id").alias("doc_id"))


@query("llm_report_rows", f"WITH {_HITS}, a AS (SELECT *, {_ROUTE} AS route FROM dim) SELECT doc_id, route, quality, CASE WHEN (route IN ('STRONG_APPLY', 'GOOD_APPLY')) = (quality = 1) THEN 'AGREE' ELSE 'DISAGREE' END AS verdict FROM a JOIN labels USING (doc_id)")
def llm_report_rows(spark, sf_dir):
    met = routed(spark, sf_dir).select("doc_id", "route").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    same = F.col("route").isin("STRONG_APPLY", "GOOD_APPLY") == (F.col("quality") == 1)
    return met.select("doc_id", "route", "quality", F.when(same, "AGREE").otherwise("DISAGREE").alias("verdict"))


@query(
    "schema_violations",
    "SELECT o_orderkey, violation FROM (SELECT o_orderkey, unnest(list_filter([CASE WHEN o_totalprice > 400000 THEN 'o_totalprice: above 400000' END, CASE WHEN o_orderstatus NOT IN ('O', 'F') THEN 'o_orderstatus: not allowed' END, CASE WHEN o_orderpriority IS NULL THEN 'o_orderpriority: missing' END], lambda x: x IS NOT NULL)) AS violation FROM orders)",
)
def schema_violations(spark, sf_dir):
    contract = [checks.present("o_orderpriority"), checks.one_of("o_orderstatus", ["O", "F"]), checks.within("o_totalprice", None, 400000)]
    return checks.violations(table(spark, sf_dir, "orders"), "o_orderkey", contract)


@query("preflight_checks", "SELECT 'orders_nonempty' AS name, count(*) > 0 AS passed FROM orders UNION ALL SELECT 'keys_unique', count(*) = count(DISTINCT o_orderkey) FROM orders UNION ALL SELECT 'no_negative', bool_and(o_totalprice >= 0) FROM orders")
def preflight_checks(spark, sf_dir):
    return checks.gates(
        table(spark, sf_dir, "orders"),
        {"orders_nonempty": F.count("*") > 0, "keys_unique": F.count("*") == F.count_distinct("o_orderkey"), "no_negative": F.bool_and(F.col("o_totalprice") >= 0)},
    )


@query("invariants", "SELECT 'labels_known' AS name, (SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)) = 0 AS passed")
def invariants(spark, sf_dir):
    lost = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id", "left_anti")
    return checks.gates(lost, {"labels_known": F.count("*") == 0})


@query("pattern_scan", "SELECT doc_id, n FROM (SELECT doc_id, len(regexp_extract_all(text, '(?i)(?:password|token|secret)\\s*[:=]'))::BIGINT AS n FROM documents) WHERE n > 0")
def pattern_scan(spark, sf_dir):
    n = F.regexp_count("text", F.lit(r"(?i)(?:password|token|secret)\s*[:=]")).cast("long")
    return table(spark, sf_dir, "documents").select("doc_id", n.alias("n")).where("n > 0")
