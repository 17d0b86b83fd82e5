"""Progress of long jobs from a stream of their events."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATE = "marker string, since timestamp, until timestamp, n long"


def stalls(events: DataFrame, key: str, marker: str, ts: str = "ts") -> DataFrame:
    """(key, marker, since, until, n) of a stream: spans over which a key's marker doesn't change, each given as it closes.
    Events of a key are taken in their time's order within a batch; the state of a key is one span."""

    def run(keys: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        now = state.get if state.exists else None
        rows = pd.concat(list(frames)).sort_values("ts", kind="stable")
        out = []
        for m, t in zip(rows["marker"], rows["ts"], strict=True):
            if now is not None and now[0] == m:
                now = (m, now[1], t, now[3] + 1)
            else:
                if now is not None:
                    out.append((keys[0], *now))
                now = (m, t, t, 1)
        state.update(now)
        yield pd.DataFrame(out, columns=["key", "marker", "since", "until", "n"])

    rows = events.select(F.col(key).cast("string").alias("key"), F.col(marker).cast("string").alias("marker"), F.col(ts).cast("timestamp").alias("ts"))
    return rows.groupBy("key").applyInPandasWithState(run, f"key string, {STATE}", STATE, "append", "NoTimeout")


def counts_by_window(events: DataFrame, kind: str, ts: str = "ts", width: str = "1 day", late: str = "2 days") -> DataFrame:
    """(start, kind, n): events by time and kind; those later than the watermark are left out."""
    rows = events.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), F.col(kind).alias("kind")).agg(F.count("*").alias("n"))
    return rows.select(F.col("w.start").alias("start"), "kind", "n")
