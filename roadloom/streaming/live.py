"""The same operators over streams: vehicle traces with state per vehicle, and the reference ledger fed by arrivals."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from roadloom.operators.orphans import ReferenceLedger, map_parents, map_references

TRIP = "vehicle bigint, samples bigint, distance double, max_speed double, removed_at double"
_STATE = "ts double, x double, y double, samples bigint, distance double, max_speed double, removed_at double"


def _advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Adds a batch of samples to a vehicle's trip. Samples not after the last one seen are late and left out."""
    df = pd.concat(list(batches)).sort_values("ts")
    ts, x, y, samples, distance, top, gone = state.get if state.exists else (None, None, None, 0, 0.0, None, None)
    if gone is None:
        if (~df.alive).any():
            gone = float(df.ts[~df.alive].min())
            df = df[df.ts < gone]
        if ts is not None:
            df = df[df.ts > ts]
        if len(df):
            t, px, py = (np.r_[[] if ts is None else [last], df[c].to_numpy(float)] for c, last in (("ts", ts), ("x", x), ("y", y)))
            step, dt = np.hypot(np.diff(px), np.diff(py)), np.diff(t)
            samples, distance = samples + len(df), distance + float(step.sum())
            if len(step) and (dt > 0).any():
                top = max(top or 0.0, float((step[dt > 0] / dt[dt > 0]).max()))
            ts, x, y = float(t[-1]), float(px[-1]), float(py[-1])
        state.update((ts, x, y, samples, distance, top, gone))
    yield pd.DataFrame([(key[0], samples, distance, top, gone)], columns=["vehicle", "samples", "distance", "max_speed", "removed_at"])


def live_trips(samples: DataFrame) -> DataFrame:
    """Running trips per vehicle from a stream of (vehicle, ts, x, y, alive), in update mode; state is one row each."""
    return samples.groupBy("vehicle").applyInPandasWithState(_advance, TRIP, _STATE, "update", GroupStateTimeout.NoTimeout)


def windowed_counts(events: DataFrame, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Samples per vehicle and tumbling window, with a watermark that bounds the state."""
    return events.withWatermark("at", late).groupBy(F.window("at", width), "vehicle").agg(F.count("*").alias("samples"))


def follow_references(stream: DataFrame, ledger: ReferenceLedger, checkpoint: str) -> StreamingQuery:
    """Feeds a ledger from a stream of table rows: (table, row as JSON). Each micro-batch is one step of the ledger, known
    by its number, so a batch that is delivered again counts once. The ledger should have a lasting ``path``, as the
    stream's checkpoint does: opened on both, a stream goes on where it stopped."""
    spark = stream.sparkSession
    schemas = {
        "osm_node": "map_id long, node_id long, loaded_at timestamp_ntz", "osm_way": "map_id long, way_id long, loaded_at timestamp_ntz, deleted_at timestamp_ntz",
        "osm_relation": "map_id long, rel_id long, loaded_at timestamp_ntz, deleted_at timestamp_ntz", "road": "map_id long, road_id string, loaded_at timestamp_ntz, deleted_at timestamp_ntz",
        "junction": "map_id long, junction_id string, loaded_at timestamp_ntz, deleted_at timestamp_ntz", "osm_member": "member_id long, map_id long, mtype string, ref string, loaded_at timestamp_ntz",
        "junction_connection": "connection_id long, map_id long, connecting_road string, loaded_at timestamp_ntz", "road_link": "link_id long, map_id long, element_type string, element_id string, loaded_at timestamp_ntz",
    }

    def step(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        part = {t: batch.where(F.col("table") == t).select(F.from_json("row", s).alias("r")).select("r.*") for t, s in schemas.items()}
        ledger.advance(map_parents(part), map_references(part), number)
        batch.unpersist()

    assert spark is not None
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).start()
