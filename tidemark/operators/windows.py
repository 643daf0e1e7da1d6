"""Event-time window aggregations.

Windows are epoch aligned, start inclusive, end exclusive, and only exist when
a row falls into them. All functions work on batch and streaming frames.
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.records import floor_to
from tidemark.schemas import SENSOR_KEY

EVENT_TIME = "event_time"


def with_event_time(df: DataFrame, ms_col: str = "timestamp", name: str = EVENT_TIME) -> DataFrame:
    """Event-time TIMESTAMP column from epoch milliseconds (for ``window`` and
    ``withWatermark``)."""
    return df.withColumn(name, F.timestamp_millis(F.col(ms_col)))


def _duration(ms: int) -> str:
    return f"{int(ms)} milliseconds"


def tumbling_sum_count(df: DataFrame, size_ms: int, key: str = "location",
                       value: str = "value", time_col: str = EVENT_TIME) -> DataFrame:
    """Per key and tumbling window: ``eventsPerWindow`` (count) and
    ``sumPerWindow`` (sum of ``value``); window bounds as epoch ms.

    Spark plans a partial aggregation before the shuffle, so a hot key costs
    one row per map task in the exchange, not one per input row.
    """
    if time_col not in df.columns:
        df = with_event_time(df, name=time_col)
    w = F.window(F.col(time_col), _duration(size_ms))
    return (df.groupBy(w.alias("w"), F.col(key))
              .agg(F.count(F.lit(1)).alias("eventsPerWindow"),
                   F.sum(F.col(value)).alias("sumPerWindow"))
              .select(F.unix_millis(F.col("w.start")).alias("windowStart"),
                      F.unix_millis(F.col("w.end")).alias("windowEnd"),
                      F.col(key).alias(key), "eventsPerWindow", "sumPerWindow"))


def _sensor_cols():
    return [F.col(c).alias(c.split(".")[-1]) for c in SENSOR_KEY]


def _order_key() -> Column:
    """``(timestamp, seq)`` as one fixed-width number: ``timestamp * 10^19 +
    seq`` in DECIMAL(38, 0) (exact for any non-negative long ``seq``). A struct
    key would force sort-based aggregation; a decimal keeps it hash-based."""
    ts = F.col("measurement.timestamp").cast("decimal(20,0)")
    return ts * F.lit(Decimal(10 ** 19)).cast("decimal(20,0)") + F.col("seq").cast("decimal(20,0)")


def _latest_aggs(fields) -> list[Column]:
    """Latest row in ``(timestamp, seq)`` order: its key, its timestamp and
    ``fields`` taken from it (one ``max_by`` per field, all hash-aggregable)."""
    key = _order_key()
    return ([F.max(key).alias("last_key"),
             F.max(F.col("measurement.timestamp")).alias("last_timestamp")]
            + [F.max_by(F.col(f), key).alias("last_" + f.split(".")[-1]) for f in fields])


def _merge_latest(fields) -> list[Column]:
    """Merge partial "latest" columns of several panes."""
    return ([F.max("last_key").alias("last_key"), F.max("last_timestamp").alias("last_timestamp")]
            + [F.max_by("last_" + f.split(".")[-1], "last_key").alias("last_" + f.split(".")[-1])
               for f in fields])


def _average_record(df: DataFrame, sum_v: str, sum_a: str, n: str) -> DataFrame:
    """Window result as a sensor record: value = mean (double), accuracy =
    mean of a double sum narrowed to float, sensor / location / timestamp of
    the latest row."""
    return df.select(
        F.struct(F.col("sensorId"), F.col("vendorId"), F.col("sensorType")).alias("sensor"),
        F.struct(F.col("last_longitude").alias("longitude"),
                 F.col("last_latitude").alias("latitude"),
                 F.col("last_height").alias("height")).alias("location"),
        F.struct((F.col(sum_v) / F.col(n)).alias("value"),
                 (F.col(sum_a) / F.col(n)).cast("float").alias("accuracy"),
                 F.col("last_timestamp").alias("timestamp")).alias("measurement"),
        F.col("windowStart"), F.col("windowEnd"), F.col(n).alias("count"),
    )


_LOC = ("location.longitude", "location.latitude", "location.height")


def sliding_average(df: DataFrame, size_ms: int, slide_ms: int) -> DataFrame:
    """Sliding average per sensor over nested sensor records.

    Two aggregations: tumbling panes of the greatest common divisor of size and
    slide (partial sums, count, latest row), then each pane is added to the
    windows that contain it. Raw rows are therefore not copied ``size / slide``
    times (the pane table is), and both stages combine map-side before their
    shuffle, so a hot sensor stays cheap.
    """
    return windows_of_panes(panes_of(df, size_ms, slide_ms), size_ms, slide_ms)


def panes_of(df: DataFrame, size_ms: int, slide_ms: int, carried: DataFrame | None = None) -> DataFrame:
    """Partial sums per sensor and pane (the greatest common divisor of size and
    slide), merged with ``carried`` panes of earlier input."""
    acc = F.col("measurement.accuracy").cast("double")
    val = F.col("measurement.value")
    pane_ms = math.gcd(size_ms, slide_ms)
    panes = (df.groupBy(*_sensor_cols(),
                        floor_to(F.col("measurement.timestamp"), pane_ms).alias("pane"))
               .agg(F.sum(val).alias("sv"), F.sum(acc).alias("sa"),
                    F.count(F.lit(1)).alias("n"), *_latest_aggs(_LOC)))
    if carried is None:
        return panes
    return (panes.unionByName(carried).groupBy("sensorId", "vendorId", "sensorType", "pane")
            .agg(F.sum("sv").alias("sv"), F.sum("sa").alias("sa"), F.sum("n").alias("n"), *_merge_latest(_LOC)))


def windows_of_panes(panes: DataFrame, size_ms: int, slide_ms: int) -> DataFrame:
    """Sliding averages from panes."""
    # window starts are the multiples of the slide in (pane - size, pane]; with
    # gaps between windows (slide > size) a pane may be in none
    last = floor_to(F.col("pane"), slide_ms)
    most = -(-size_ms // slide_ms)
    windows = (panes
               .withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
               .withColumn("windowStart", last - F.col("k").cast("long") * F.lit(slide_ms))
               .where(F.col("pane") < F.col("windowStart") + F.lit(size_ms))
               .groupBy("sensorId", "vendorId", "sensorType", "windowStart")
               .agg(F.sum("sv").alias("sv"), F.sum("sa").alias("sa"),
                    F.sum("n").alias("n"), *_merge_latest(_LOC))
               .withColumn("windowEnd", F.col("windowStart") + F.lit(size_ms)))
    return _average_record(windows, "sv", "sa", "n")


def sliding_average_builtin(df: DataFrame, size_ms: int, slide_ms: int,
                            time_col: str | None = None) -> DataFrame:
    """Same result with one ``window(ts, size, slide)`` aggregation (used in
    streams, where two chained aggregations would need extra watermarking;
    pass the watermarked ``time_col`` there)."""
    acc = F.col("measurement.accuracy").cast("double")
    ts = F.col(time_col) if time_col else F.timestamp_millis(F.col("measurement.timestamp"))
    w = F.window(ts, _duration(size_ms), _duration(slide_ms))
    agg = (df.groupBy(*_sensor_cols(), w.alias("w"))
             .agg(F.sum("measurement.value").alias("sv"), F.sum(acc).alias("sa"),
                  F.count(F.lit(1)).alias("n"), *_latest_aggs(_LOC))
             .withColumn("windowStart", F.unix_millis("w.start"))
             .withColumn("windowEnd", F.unix_millis("w.end")))
    return _average_record(agg, "sv", "sa", "n")
