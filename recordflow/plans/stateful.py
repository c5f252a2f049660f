"""State over generations: events as daily snapshots of users."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordflow.operators import state
from recordflow.sources.shared import shared_dir
from recordflow.streaming import state_stream

from .adapters import table
from .registry import query

_SNAP = """snap AS (SELECT user_id AS id, ts::DATE AS generation, arg_max(CASE WHEN event_type = 'error' THEN 'CLOSED' ELSE 'OPEN' END, (ts, event_id)) AS lifecycle,
  arg_max(event_type <> 'view', (ts, event_id)) AS resolved, arg_max(value, (ts, event_id)) AS value, arg_max(props, (ts, event_id)) AS detail FROM events GROUP BY ALL)"""
_RUN = f"""{_SNAP}, st AS (SELECT *, CASE WHEN max(resolved::INT) OVER u = 1 THEN last_value(CASE WHEN resolved THEN value END IGNORE NULLS) OVER u ELSE first_value(value) OVER u END AS stored, last_value(CASE WHEN resolved THEN detail END IGNORE NULLS) OVER u AS stored_detail,
  row_number() OVER u AS times_seen FROM snap WINDOW u AS (PARTITION BY id ORDER BY generation ROWS UNBOUNDED PRECEDING)),
lagged AS (SELECT *, lag(lifecycle) OVER w AS was, lag(stored) OVER w AS old, lag(stored_detail) OVER w AS old_detail, lag(resolved) OVER w AS was_resolved FROM st WINDOW w AS (PARTITION BY id ORDER BY generation)),
run AS (SELECT *, CASE WHEN times_seen > 1 THEN CASE WHEN was = 'CLOSED' AND lifecycle = 'OPEN' THEN ['lifecycle'] ELSE [] END || list_filter([CASE WHEN resolved AND old IS DISTINCT FROM stored THEN 'value' END, CASE WHEN resolved AND old_detail IS NOT NULL AND old_detail <> detail THEN 'detail' END], lambda x: x IS NOT NULL) ELSE [] END AS reasons FROM lagged),
ev AS (SELECT *, CASE WHEN times_seen = 1 THEN 'NEW' WHEN was = 'CLOSED' AND lifecycle = 'OPEN' THEN 'REOPENED' WHEN len(reasons) > 0 THEN 'MATERIALLY_CHANGED' ELSE 'SEEN' END AS event,
  CASE WHEN NOT was_resolved AND resolved THEN 'DETAIL_RESOLVED' WHEN was_resolved AND NOT resolved THEN 'DETAIL_UNRESOLVED' END AS quality_event FROM run)"""


#: Days of a period, so that a few generations hold all events.
_PERIOD = 11
_PERIOD_SQL = f"(DATE '2024-01-01' + (date_diff('day', DATE '2024-01-01', ts::DATE) // {_PERIOD} * {_PERIOD})::INT)"


def snapshots(spark, sf_dir, days=1):
    """The last event of each user and period of days."""
    last = F.max_by(
        F.struct(
            F.when(F.col("event_type") == "error", "CLOSED").otherwise("OPEN").alias("lifecycle"),
            (F.col("event_type") != "view").alias("resolved"),
            "value",
            F.col("props").alias("detail"),
        ),
        F.struct("ts", "event_id"),
    )
    e = table(spark, sf_dir, "events")
    start = F.lit("2024-01-01").cast("date")
    period = F.date_add(start, (F.floor(F.date_diff(F.to_date("ts"), start) / days) * days).cast("int"))
    return e.groupBy(F.col("user_id").alias("id"), period.alias("generation")).agg(last.alias("x")).select("id", "generation", "x.*")


@query("state_replay", f"WITH {_RUN} SELECT id, generation, times_seen, lifecycle, stored AS value, detail, event, quality_event, reasons FROM ev")
def state_replay(spark, sf_dir):
    return state.replay(snapshots(spark, sf_dir))


@query("change_reasons", f"WITH {_RUN} SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM ev) GROUP BY reason")
def change_reasons(spark, sf_dir):
    run = state.replay(snapshots(spark, sf_dir))
    return run.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query("quality_events", f"WITH {_RUN} SELECT id, generation, quality_event FROM ev WHERE quality_event IS NOT NULL")
def quality_events(spark, sf_dir):
    return state.replay(snapshots(spark, sf_dir)).where("quality_event IS NOT NULL").select("id", "generation", "quality_event")


@query("carry_forward", f"WITH {_RUN} SELECT id, generation, value AS seen, stored AS kept FROM ev WHERE NOT resolved")
def carry_forward(spark, sf_dir):
    seen = snapshots(spark, sf_dir)
    kept = state.replay(seen).select("id", "generation", F.col("value").alias("kept"))
    return seen.where("NOT resolved").join(kept, ["id", "generation"]).select("id", "generation", F.col("value").alias("seen"), "kept")


@query("reopened", f"WITH {_RUN} SELECT id, generation FROM ev WHERE event = 'REOPENED'")
def reopened(spark, sf_dir):
    return state.replay(snapshots(spark, sf_dir)).where("event = 'REOPENED'").select("id", "generation")


@query("baseline_relabel", f"WITH {_RUN} SELECT event, count(*) AS n FROM (SELECT CASE WHEN event = 'NEW' AND generation = DATE '2024-01-01' THEN 'BASELINE_EXISTING' ELSE event END AS event FROM ev) GROUP BY event")
def baseline_relabel(spark, sf_dir):
    run = state.baseline(state.replay(snapshots(spark, sf_dir)), F.col("generation") == F.lit("2024-01-01").cast("date"))
    return run.groupBy("event").agg(F.count("*").alias("n"))


@query("state_summary", f"WITH {_RUN} SELECT generation, count(*) FILTER (event = 'NEW') AS new, count(*) FILTER (event = 'SEEN') AS seen, count(*) FILTER (event = 'MATERIALLY_CHANGED') AS changed, count(*) FILTER (event = 'REOPENED') AS reopened FROM ev GROUP BY generation")
def state_summary(spark, sf_dir):
    n = lambda e: F.count_if(F.col("event") == e)
    run = state.replay(snapshots(spark, sf_dir))
    return run.groupBy("generation").agg(n("NEW").alias("new"), n("SEEN").alias("seen"), n("MATERIALLY_CHANGED").alias("changed"), n("REOPENED").alias("reopened"))


@query("state_step", f"WITH {_RUN.replace('ts::DATE AS generation', _PERIOD_SQL + ' AS generation')} SELECT id, min(generation) AS first_generation, max(generation) AS last_generation, count(*) AS times_seen, arg_max(lifecycle, generation) AS lifecycle, arg_max(stored, generation) AS value, arg_max(event, generation) AS event FROM ev GROUP BY id")
def state_step(spark, sf_dir):
    """Generations folded one by one."""
    now = spark.createDataFrame([], state.EMPTY_STATE)
    seen = snapshots(spark, sf_dir, _PERIOD)
    for day in [r[0] for r in seen.select("generation").distinct().orderBy("generation").collect()]:
        now = state.step(now, seen.where(F.col("generation") == F.lit(day)))
    return now.select("id", "first_generation", "last_generation", "times_seen", "lifecycle", "value", "event")


@query(
    "lifecycle_anomalies",
    """WITH s AS (SELECT user_id, d, sum(d) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT *, CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN -1 ELSE 0 END AS d FROM events)),
    b AS (SELECT user_id, greatest(0, -min(s))::BIGINT AS o, (sum(d) + greatest(0, -min(s)))::BIGINT AS i FROM s GROUP BY user_id)
    SELECT user_id, 'ORPHAN_DONE' AS code, o AS n FROM b WHERE o > 0 UNION ALL SELECT user_id, 'INCOMPLETE_START', i FROM b WHERE i > 0
    UNION ALL SELECT user_id, 'SOURCE_ERROR', count(*) FROM events WHERE event_type = 'error' GROUP BY user_id""",
)
def lifecycle_anomalies(spark, sf_dir):
    return state.anomalies(table(spark, sf_dir, "events"))


def _streamed(spark, stream, mode="append"):
    """What a stream gives, by way of Parquet in the shared folder: an appending one as files, a complete one by its last batch."""
    at = shared_dir(spark, "streamed")
    out = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True)
    if mode == "append":
        out.format("parquet").option("path", f"{at}/out").start().awaitTermination()
    else:
        out.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(f"{at}/out")).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{at}/out")


@query("state_stream", f"WITH {_RUN} SELECT id, generation, times_seen, lifecycle, stored AS value, event FROM ev")
def state_stream_(spark, sf_dir):
    """The replay as a stream of snapshots."""
    at = shared_dir(spark, "snapshots")
    snapshots(spark, sf_dir).write.mode("overwrite").parquet(f"{at}/in")
    seen = spark.read.parquet(f"{at}/in")
    stream = spark.readStream.schema(seen.schema).parquet(f"{at}/in")
    return _streamed(spark, state_stream.fold(stream))


@query("windowed_stream", "SELECT date_trunc('day', ts)::TIMESTAMP AS start, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY ALL")
def windowed_stream(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    stream = spark.readStream.schema(e.schema).parquet(f"{sf_dir}/events.parquet*")
    stream = stream.withColumn("ts", F.col("ts").cast("timestamp"))
    out = _streamed(spark, state_stream.windowed_counts(stream), "complete")
    return out.withColumn("value", F.round("value", 4))


_LOG = """l AS (SELECT 's' || (user_id % 9) AS shard_id, 'src' || (user_id % 40) AS source_id, event_id AS line_no, CASE event_type WHEN 'signup' THEN 'source_start' WHEN 'purchase' THEN 'source_done' WHEN 'error' THEN 'source_error' ELSE 'source_waiting' END AS event, event_id % 500 = 7 AS bad FROM events),
  r AS (SELECT *, sum(d) OVER (PARTITION BY shard_id, source_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, CASE event WHEN 'source_start' THEN 1 WHEN 'source_done' THEN -1 ELSE 0 END AS d FROM l WHERE NOT bad)),
  b AS (SELECT shard_id, source_id, greatest(0, -min(run))::BIGINT AS o, (sum(d) + greatest(0, -min(run)))::BIGINT AS i FROM r GROUP BY ALL)"""


@query(
    "runtime_anomalies",
    f"""WITH {_LOG} SELECT 'ORPHAN_SOURCE_DONE' AS code, 'WARNING' AS severity, shard_id, source_id, o AS n FROM b WHERE o > 0 UNION ALL SELECT 'INCOMPLETE_SOURCE_LIFECYCLE', 'ERROR', shard_id, source_id, i FROM b WHERE i > 0
    UNION ALL SELECT 'LIFECYCLE_SOURCE_ERROR', 'ERROR', shard_id, source_id, count(*) FROM l WHERE event = 'source_error' AND NOT bad GROUP BY ALL UNION ALL SELECT 'MALFORMED_LIFECYCLE_EVENT', 'WARNING', shard_id, '', count(*) FROM l WHERE bad GROUP BY ALL
    UNION ALL SELECT 'SOURCE_ERROR', 'ERROR', shard_id, source_id, 1 FROM (SELECT DISTINCT shard_id, source_id FROM l WHERE source_id LIKE '%7')
    UNION ALL SELECT 'MISSING_SHARD_ARTIFACT', 'ERROR', 's9', '', 1 UNION ALL SELECT 'UNEXPECTED_SHARD_ARTIFACT', 'WARNING', 's0', '', 1""",
)
def runtime_anomalies(spark, sf_dir):
    """The events as the log of nine shards; one shard more is expected, and one is there that is not."""
    from recordflow.operators import anomalies

    u = F.col("user_id")
    kind = F.when(F.col("event_type") == "signup", "source_start").when(F.col("event_type") == "purchase", "source_done").when(F.col("event_type") == "error", "source_error").otherwise("source_waiting")
    shard, source = F.concat(F.lit("s"), (u % 9).cast("string")), F.concat(F.lit("src"), (u % 40).cast("string"))
    e = table(spark, sf_dir, "events").select(shard.alias("shard_id"), source.alias("source_id"), F.col("event_id").alias("line_no"), kind.alias("event"))
    line = F.when(F.col("line_no") % 500 == 7, "{bad").otherwise(F.to_json(F.struct("event", "source_id")))
    shards = e.select("shard_id").distinct()
    expected = shards.where("shard_id <> 's0'").unionByName(spark.createDataFrame([("s9",)], "shard_id string"))
    results = e.select("shard_id", "source_id", F.when(F.endswith("source_id", F.lit("7")), "error").otherwise("OK").alias("status")).distinct()
    return anomalies.found(e.select("shard_id", "line_no", line.alias("line")), expected, shards, results)
