"""Stateful outputs of micro-batches, on carried tables.

Each class is a ``foreachBatch`` handler. A micro-batch is worked on with the batch
operators, spread over tasks like any batch input (a hot key too); what
continues into the next batch is a small table (:mod:`tidemark.streaming.carried`),
not Python state. Outputs go to ``<out>/batch=<id>``, overwritten on a replay.
A restart goes on from the tables.
"""

from __future__ import annotations

import os
import time

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.records import clock_lag, floor_to, localize_temperature, localize_wind
from tidemark.operators.ema import ema_chunked
from tidemark.operators.routing import split_by_type
from tidemark.operators.stats import LAG_QUANTILES, lag_statistics, lifetime_extremes
from tidemark.operators.watermark import is_late
from tidemark.operators.windows import panes_of, windows_of_panes
from tidemark.plans.sensors import SLIDING_REF
from tidemark.schemas import SENSOR_KEY
from tidemark.streaming.carried import Carried

LAG_SCHEMA = "windowEnd BIGINT, location STRING, lag BIGINT"
EMA_SCHEMA = "sensorId BIGINT, vendorId BIGINT, sensorType STRING, value DOUBLE, accuracy FLOAT"
PANE_SCHEMA = ("sensorId BIGINT, vendorId BIGINT, sensorType STRING, pane BIGINT, sv DOUBLE, sa DOUBLE, n BIGINT, "
               "last_key DECIMAL(38,0), last_timestamp BIGINT, last_longitude DOUBLE, last_latitude DOUBLE, "
               "last_height DOUBLE")
BEFORE_ALL = -(1 << 62)                     # event time of a carried average


def _write(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(os.path.join(path, f"batch={batch_id}"))


class _Watermark:
    """Largest event time minus a bound, carried as a one-row table."""

    def __init__(self, path: str, bound_ms: int):
        if bound_ms < 0:
            raise ValueError("the out-of-orderness bound must not be negative")
        self.table, self.bound = Carried(path, "watermark BIGINT, lateRows BIGINT"), bound_ms

    def read(self, spark, batch_id: int) -> tuple[int | None, int]:
        row = self.table.read(spark, batch_id).first()
        return (row["watermark"], row["lateRows"]) if row else (None, 0)

    def after(self, top: int | None, before: int | None) -> int | None:
        seen = [w for w in (before, None if top is None else top - self.bound) if w is not None]
        return max(seen, default=None)

    def write(self, spark, watermark: int | None, late: int, batch_id: int) -> None:
        row = spark.range(1).select(F.lit(watermark).cast("long").alias("watermark"),
                                    F.lit(late).cast("long").alias("lateRows"))
        self.table.write(row, batch_id)


class LagHistory:
    """The lag histogram over the last ``history`` emitted windows.

    Every window's lag is taken when its batch arrives (``clock``: batch id to
    ms, default the wall clock) and carried with it, at most ``history`` rows,
    the latest by window end and location.
    """

    def __init__(self, path: str, history: int = 10_000, clock=None):
        if history < 1:
            raise ValueError("the history needs at least one window")
        self.table, self.history = Carried(path, LAG_SCHEMA), history
        self.clock = clock or (lambda batch_id: int(time.time() * 1000))

    def __call__(self, windows: DataFrame, batch_id: int) -> None:
        now = F.lit(int(self.clock(batch_id))).cast("long")
        new = windows.select("windowEnd", "location", clock_lag(now, F.col("windowEnd")).alias("lag"))
        both = self.table.read(windows.sparkSession, batch_id).unionByName(new)
        self.table.write(both.orderBy(F.desc("windowEnd"), F.desc("location")).limit(self.history), batch_id)

    def statistics(self, spark, batch_id: int, quantiles=LAG_QUANTILES) -> DataFrame:
        """Count, extremes, mean, deviation and quantiles after a batch."""
        return lag_statistics(self.table.at(spark, batch_id).select("lag"), quantiles)


class IntervalGauges:
    """Mean, extremes and second moment per interval, and lifetime extremes.

    Partial moments of open intervals are carried, one row an interval, and
    merged with a batch's own (count, mean and M2 combine exactly like the
    moments of the union). An interval is emitted, with the extremes of all intervals up
    to it, once the largest event time minus ``out_of_orderness_ms`` passes its
    end; rows for emitted intervals are counted in ``lateRows`` and left out.
    """

    def __init__(self, out: str, state: str, interval_ms: int, ts_col: str, metrics: dict[str, Column], *,
                 out_of_orderness_ms: int):
        if interval_ms <= 0 or not metrics:
            raise ValueError("a positive interval and at least one metric are needed")
        self.out, self.interval, self.ts_col, self.metrics = out, interval_ms, ts_col, metrics
        fields = ", ".join(f"{p}Count BIGINT, {p}Mean DOUBLE, {p}Min DOUBLE, {p}Max DOUBLE, {p}M2 DOUBLE" for p in metrics)
        self.open = Carried(f"{state}-open", f"intervalStart BIGINT, n BIGINT, {fields}")
        self.life = Carried(f"{state}-lifetime", ", ".join(f"{p}Lo DOUBLE, {p}Hi DOUBLE" for p in metrics))
        self.watermark = _Watermark(f"{state}-watermark", out_of_orderness_ms)

    def _partials(self, rows: DataFrame) -> DataFrame:
        aggs = [F.count(F.lit(1)).alias("n")]
        for p, x in self.metrics.items():
            x = x.cast("double")
            aggs += [F.count(x).alias(f"{p}Count"), F.avg(x).alias(f"{p}Mean"), F.min(x).alias(f"{p}Min"),
                     F.max(x).alias(f"{p}Max"), (F.var_pop(x) * F.count(x)).alias(f"{p}M2")]
        return rows.groupBy(floor_to(F.col(self.ts_col), self.interval).alias("intervalStart")).agg(*aggs)

    def _merge(self, a: DataFrame, b: DataFrame) -> DataFrame:
        b = b.select(*[F.col(c).alias(f"_{c}") for c in b.columns])
        both = a.join(b, F.col("intervalStart") == F.col("_intervalStart"), "full")
        cols = [F.coalesce("intervalStart", "_intervalStart").alias("intervalStart"),
                (F.coalesce("n", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("n")]
        for p in self.metrics:
            m, n = (F.coalesce(f"{s}{p}Count", F.lit(0)) for s in ("", "_"))
            gap = F.col(f"_{p}Mean") - F.col(f"{p}Mean")
            some = (m > 0) & (n > 0)
            cols += [(m + n).alias(f"{p}Count"),
                     F.when(some, F.col(f"{p}Mean") + gap * n / (m + n))
                     .otherwise(F.coalesce(f"{p}Mean", f"_{p}Mean")).alias(f"{p}Mean"),
                     F.least(f"{p}Min", f"_{p}Min").alias(f"{p}Min"), F.greatest(f"{p}Max", f"_{p}Max").alias(f"{p}Max"),
                     F.when(some, F.col(f"{p}M2") + F.col(f"_{p}M2") + gap * gap * m * n / (m + n))
                     .otherwise(F.coalesce(f"{p}M2", f"_{p}M2")).alias(f"{p}M2")]
        return both.select(*cols)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before, late_rows = self.watermark.read(spark, batch_id)
        end = floor_to(F.col(self.ts_col), self.interval) + F.lit(self.interval)
        late = is_late(end, F.lit(before).cast("long"))
        seen = batch.agg(F.max(self.ts_col).alias("top"), F.count_if(late).alias("late")).first()
        watermark = self.watermark.after(seen["top"], before)
        merged = self._merge(self.open.read(spark, batch_id), self._partials(batch.where(~late))).persist()
        try:
            closed = is_late(F.col("intervalStart") + F.lit(self.interval), F.lit(watermark).cast("long"))
            done = lifetime_extremes(merged.where(closed), list(self.metrics))
            life = self.life.read(spark, batch_id).first()
            carried = life.asDict() if life else {}
            for p in self.metrics:
                done = (done.withColumn(f"{p}LifetimeMin", F.least(f"{p}LifetimeMin", F.lit(carried.get(f"{p}Lo")).cast("double")))
                        .withColumn(f"{p}LifetimeMax", F.greatest(f"{p}LifetimeMax", F.lit(carried.get(f"{p}Hi")).cast("double"))))
            _write(done.drop(*[f"{p}Count" for p in self.metrics]), self.out, batch_id)
            self.open.write(merged.where(~closed), batch_id)
            self.life.write(merged.where(closed).agg(*[
                e for p in self.metrics for e in (
                    F.least(F.min(f"{p}Min"), F.lit(carried.get(f"{p}Lo")).cast("double")).alias(f"{p}Lo"),
                    F.greatest(F.max(f"{p}Max"), F.lit(carried.get(f"{p}Hi")).cast("double")).alias(f"{p}Hi"))]), batch_id)
        finally:
            merged.unpersist()
        self.watermark.write(spark, watermark, late_rows + seen["late"], batch_id)


class EmaBatches:
    """EMA per sensor without per-key Python state.

    The carried average of a sensor enters the micro-batch as a record before all
    others of its key; the batch operator composes it through the blocks of the batch, so
    a hot sensor's rows are spread over tasks. Rows of one batch are taken in
    (timestamp, seq) order, batches in their order. ``convert`` is applied to the output.
    """

    def __init__(self, out: str, state: str, convert=None, chunk_rows: int = 1 << 20):
        self.out, self.state, self.convert = out, Carried(state, EMA_SCHEMA), convert or (lambda df: df)
        self.chunk_rows = chunk_rows

    def __call__(self, records: DataFrame, batch_id: int) -> None:
        spark = records.sparkSession
        kinds = {f.name: f.dataType for f in records.schema.fields}
        seeds = self.state.read(spark, batch_id).select(
            F.lit(-1).cast("long").alias("seq"),
            F.struct("sensorId", "vendorId", "sensorType").cast(kinds["sensor"]).alias("sensor"),
            F.lit(None).cast(kinds["location"]).alias("location"),
            F.struct("value", "accuracy", F.lit(BEFORE_ALL).alias("timestamp")).cast(kinds["measurement"]).alias("measurement"))
        columns = ["seq", "sensor", "location", "measurement"]
        rows = records.select(*columns).unionByName(seeds)
        handles: list = []
        averaged = ema_chunked(rows, SENSOR_KEY, chunk_rows=self.chunk_rows, handles=handles).select(*columns).persist()
        try:
            _write(self.convert(averaged), self.out, batch_id)
            # the last average of a key; before any, its only row
            m = F.col("measurement")
            order = F.struct("_kind", m["timestamp"], "seq")
            last = F.max_by(F.struct(F.coalesce(m["value"], F.lit(0.0)).alias("value"),
                                     F.coalesce(m["accuracy"].cast("float"), F.lit(0.0).cast("float")).alias("accuracy")), order)
            state = (averaged.withColumn("_kind", F.lit(1)).unionByName(rows.withColumn("_kind", F.lit(0)))
                     .groupBy(*[F.col(c).alias(c.split(".")[-1]) for c in SENSOR_KEY]).agg(last.alias("_s"))
                     .select("sensorId", "vendorId", "sensorType", "_s.*"))
            self.state.write(state, batch_id)
        finally:
            averaged.unpersist()
            for handle in handles:
                handle.unpersist()


class SlidingPanes:
    """Sliding averages from carried panes: one row per sensor and pane, whatever
    the number of windows a pane is in. A window is emitted once the largest event
    time minus ``out_of_orderness_ms`` passes its end; rows none of whose windows is
    still open are counted in ``lateRows``."""

    def __init__(self, out: str, state: str, size_ms: int, slide_ms: int, *, out_of_orderness_ms: int, convert=None):
        self.out, self.size, self.slide = out, size_ms, slide_ms
        self.panes, self.convert = Carried(f"{state}-panes", PANE_SCHEMA), convert or (lambda df: df)
        self.watermark = _Watermark(f"{state}-watermark", out_of_orderness_ms)

    def __call__(self, records: DataFrame, batch_id: int) -> None:
        spark = records.sparkSession
        before, late_rows = self.watermark.read(spark, batch_id)
        ts = F.col("measurement.timestamp")
        last_end = floor_to(ts, self.slide) + F.lit(self.size)
        late = is_late(last_end, F.lit(before).cast("long"))
        seen = records.agg(F.max(ts).alias("top"), F.count_if(late).alias("late")).first()
        watermark = self.watermark.after(seen["top"], before)
        panes = panes_of(records.where(~late), self.size, self.slide, self.panes.read(spark, batch_id)).persist()
        try:
            windows = windows_of_panes(panes, self.size, self.slide)
            end = F.col("windowEnd")
            due = is_late(end, F.lit(watermark).cast("long")) & ~is_late(end, F.lit(before).cast("long"))
            _write(self.convert(windows.where(due)), self.out, batch_id)
            done = is_late(floor_to(F.col("pane"), self.slide) + F.lit(self.size), F.lit(watermark).cast("long"))
            self.panes.write(panes.where(~done), batch_id)
        finally:
            panes.unpersist()
        self.watermark.write(spark, watermark, late_rows + seen["late"], batch_id)


class SensorOutputs:
    """All sensor outputs from one read of each micro-batch: localised
    temperature and wind, ``unrouted``, the EMA and the sliding average, each in
    ``<root>/<name>/batch=<id>``."""

    def __init__(self, root: str, state: str, sliding=SLIDING_REF, *, out_of_orderness_ms: int):
        self.root = root
        self.ema = EmaBatches(os.path.join(root, "ema"), os.path.join(state, "ema"), localize_temperature)
        self.sliding = SlidingPanes(os.path.join(root, "sliding"), os.path.join(state, "sliding"), *sliding,
                                    out_of_orderness_ms=out_of_orderness_ms, convert=localize_temperature)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            routed = split_by_type(batch)
            for name, df in (("temperature", localize_temperature(routed.temperature)),
                             ("wind", localize_wind(routed.wind)), ("unrouted", routed.unrouted)):
                _write(df, os.path.join(self.root, name), batch_id)
            self.ema(routed.temperature, batch_id)
            self.sliding(routed.temperature, batch_id)
        finally:
            batch.unpersist()
