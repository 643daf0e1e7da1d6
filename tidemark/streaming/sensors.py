"""Sensor pipeline on Structured Streaming.

Split by type (plain filters), localisation (column expressions), the sliding
average (built-in sliding window under a watermark) and the EMA, which keeps
one value per sensor in ``transformWithState`` (RocksDB-backed, checkpointed:
a restart resumes the averages).
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from typing import Iterator

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.geo import is_in_us
from tidemark.functions.records import localize_temperature, localize_wind
from tidemark.operators.routing import split_by_type
from tidemark.operators.windows import sliding_average_builtin
from tidemark.plans.sensors import SLIDING_REF

FLAT_SCHEMA = ("seq BIGINT, sensorId BIGINT, vendorId BIGINT, sensorType STRING, "
               "longitude DOUBLE, latitude DOUBLE, height DOUBLE, "
               "value DOUBLE, accuracy FLOAT, timestamp BIGINT")
EMA_STATE_SCHEMA = "accuracy FLOAT, value DOUBLE"


def flatten(df: DataFrame) -> DataFrame:
    return df.select("seq", "sensor.*", "location.*", "measurement.*")


def nest(df: DataFrame) -> DataFrame:
    return df.select(
        "seq",
        F.struct("sensorId", "vendorId", "sensorType").alias("sensor"),
        F.struct("longitude", "latitude", "height").alias("location"),
        F.struct("value", "accuracy", "timestamp").alias("measurement"))


class EmaProcessor(StatefulProcessor):
    """EMA with coefficient 1/2 per sensor key. The first row of a key only
    seeds the state. Rows of one micro-batch are taken in (timestamp, seq)
    order; batches in arrival order. Accuracy uses float arithmetic. A NULL
    value or accuracy counts as 0."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("ema", EMA_STATE_SCHEMA)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        batch = sorted(rows, key=lambda r: (r["timestamp"], r["seq"]))
        if self.state.exists():
            acc, val = self.state.get()
            acc = np.float32(acc)
        else:
            first, batch = batch[0], batch[1:]
            acc, val = np.float32(first["accuracy"] or 0.0), first["value"] or 0.0
        half = np.float32(2.0)
        for r in batch:
            val = (val + (r["value"] or 0.0)) / 2.0
            acc = np.float32(np.float32(acc + np.float32(r["accuracy"] or 0.0)) / half)
            out = r.asDict()
            out["value"], out["accuracy"] = float(val), float(acc)
            yield Row(**out)
        self.state.update((float(acc), float(val)))

    def close(self) -> None:
        pass


def ema_stream(records: DataFrame) -> DataFrame:
    """EMA over a stream of nested sensor records (state per sensor)."""
    flat = flatten(records)
    out = flat.groupBy("sensorId", "vendorId", "sensorType").transformWithState(
        statefulProcessor=EmaProcessor(), outputStructType=FLAT_SCHEMA,
        outputMode="Append", timeMode="None")
    return nest(out)


@dataclass
class SensorStreams:
    temperature: DataFrame
    ema: DataFrame
    sliding: DataFrame
    wind: DataFrame
    unrouted: DataFrame


def us_temperature_gauge(df: DataFrame, name: str) -> DataFrame:
    """Observed metric ``name``: mean / min / max of US temperatures in each
    micro-batch (read from ``StreamingQueryProgress.observedMetrics``)."""
    v = F.when(is_in_us("location.longitude", "location.latitude"), F.col("measurement.value"))
    return df.observe(name, F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"))


def sensor_streams(records: DataFrame, sliding=SLIDING_REF, *, watermark_ms: int) -> SensorStreams:
    """The four outputs (plus ``unrouted``) as streaming DataFrames; start
    each with its own query and checkpoint. The sliding average emits a window
    once the watermark (largest event time minus ``watermark_ms``) passes its
    end; rows later than that are dropped from the sliding average (Spark counts
    them as ``numRowsDroppedByWatermark`` in the query progress), so the bound has
    no default. The temperature output carries the gauges ``sourceTemperatureUS``
    (before conversion) and ``normalizedTemperatureUS`` (after)."""
    routed = split_by_type(records)
    temps = routed.temperature
    timed = (temps.withColumn("event_time", F.timestamp_millis("measurement.timestamp"))
                  .withWatermark("event_time", f"{int(watermark_ms)} milliseconds"))
    return SensorStreams(
        temperature=us_temperature_gauge(
            localize_temperature(us_temperature_gauge(temps, "sourceTemperatureUS")),
            "normalizedTemperatureUS"),
        ema=localize_temperature(ema_stream(temps)),
        sliding=localize_temperature(sliding_average_builtin(timed, *sliding, time_col="event_time")),
        wind=localize_wind(routed.wind),
        unrouted=routed.unrouted,
    )


class StatelessFanOut:
    """``foreachBatch`` handler writing the stateless sensor outputs from one
    read of each micro-batch: localised temperature, localised wind and
    ``unrouted``, each to ``<root>/<name>/batch=<id>`` (overwritten on
    replay, so a retried batch leaves no duplicates). Stateful outputs (EMA,
    sliding average) need their own streaming queries."""

    def __init__(self, root: str):
        self.root = root

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            routed = split_by_type(batch)
            outputs = {"temperature": localize_temperature(routed.temperature),
                       "wind": localize_wind(routed.wind),
                       "unrouted": routed.unrouted}
            for name, df in outputs.items():
                df.write.mode("overwrite").parquet(os.path.join(self.root, name, f"batch={batch_id}"))
        finally:
            batch.unpersist()
