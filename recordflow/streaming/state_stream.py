"""The state fold as a stream: generations arrive as micro-batches, entities are keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT = "id long, generation date, times_seen long, lifecycle string, value double, event string"
STATE = "times_seen long, lifecycle string, value double, ever boolean, detail string"


def _fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    n, lifecycle, value, ever, detail = state.get if state.exists else (0, None, None, False, None)
    out = []
    rows = pd.concat(list(batches))  # of one entity in one micro-batch; its parts come in any order
    for r in rows.sort_values("generation").itertuples():
        known, old = n > 0, value
        if r.resolved:
            value, ever = r.value, True
        elif not known:
            value = r.value
        changed = known and r.resolved and (old != value or (detail is not None and detail != r.detail))
        reopened = known and lifecycle == "CLOSED" and r.lifecycle == "OPEN"
        event = "NEW" if not known else "REOPENED" if reopened else "MATERIALLY_CHANGED" if changed else "SEEN"
        n, lifecycle, detail = n + 1, r.lifecycle, r.detail if r.resolved else detail
        out.append((key[0], r.generation, n, lifecycle, value, event))
    state.update((n, lifecycle, value, ever, detail))
    yield pd.DataFrame(out, columns=["id", "generation", "times_seen", "lifecycle", "value", "event"])


def fold(batches: DataFrame) -> DataFrame:
    """Events of a stream of snapshots (id, generation, lifecycle, resolved, value, detail).

    Order is that of the generations within a micro-batch and of the micro-batches; event time is not used.
    """
    return batches.groupBy("id").applyInPandasWithState(_fold, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout)


def windowed_counts(events: DataFrame, late: str = "1 hour", size: str = "1 day") -> DataFrame:
    """Events by window and type; windows close once the watermark has passed them."""
    from pyspark.sql import functions as F

    counted = events.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type")
    return counted.agg(F.count("*").alias("n"), F.sum("value").alias("value")).select(
        F.col("window.start").alias("start"), "event_type", "n", "value"
    )
