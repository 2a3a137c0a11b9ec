"""The speed gate and one-second decimation over a stream of samples, with a state for each aircraft."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from contrail.operators.scans import reachable, whole_feet


def speed_gate(samples: DataFrame, idle: str | None = None) -> DataFrame:
    """icao, seq, t, lat, lon, accepted: each fix held against the aircraft's last accepted one, across micro-batches.

    Within a micro-batch fixes count in (t, seq) order; a fix older than the last accepted one is judged like one of the same time. With
    idle (a duration such as "30 minutes") an aircraft that sends nothing for so long starts anew.
    """
    schema = "icao string, seq long, t double, lat double, lon double, accepted boolean"

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        anchor = state.get if state.exists else None
        rows = pd.concat(list(frames)).sort_values(["t", "seq"])
        out = []
        for t, lat, lon, baro, gnd in rows[["t", "lat", "lon", "baro", "gnd"]].itertuples(index=False):
            ok = anchor is None or reachable(anchor, t, lat, lon, whole_feet(baro, gnd))
            anchor = (t, lat, lon) if ok else anchor
            out.append(ok)
        state.update(anchor)
        if idle:
            state.setTimeoutDuration(idle)
        yield rows.assign(accepted=out)[["icao", "seq", "t", "lat", "lon", "accepted"]]

    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle else GroupStateTimeout.NoTimeout
    return samples.groupBy("icao").applyInPandasWithState(run, schema, "t double, lat double, lon double", "append", timeout)


def minute_counts(samples: DataFrame, time_col: str = "ts", late: str = "10 minutes") -> DataFrame:
    """icao, start, n, ground: fixes by aircraft and minute of event time, late ones up to `late`."""
    return samples.withWatermark(time_col, late).groupBy("icao", F.window(time_col, "1 minute").alias("w")).agg(
        F.count("*").alias("n"), F.sum(F.col("gnd").cast("int")).alias("ground"),
    ).select("icao", F.col("w.start").alias("start"), "n", "ground")
