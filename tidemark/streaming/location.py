"""Location pipeline on Structured Streaming.

Two forms:

* :func:`location_windows` - one query: watermark, tolerant decode (counted
  through ``observe``), tumbling sum/count per location in append mode. Spark
  drops rows behind the watermark silently.
* :class:`LateTagger` - late rows as a separate output. A ``foreachBatch``
  query tags each record with the watermark it met (largest event time of
  earlier records, carried across micro-batches in a one-row state table) and
  writes late and on-time records, one folder per batch id, overwritten on
  replay. With ``windows_path`` it also emits the windows that the batch
  closed: the sums of open windows are carried in a table per batch, so a batch
  only depends on its own rows and on tables of the batch before it, and a
  replay gives the same folders again.

:func:`on_time_windows` aggregates the tagger's on-time table in a second
query. It suits a finished table: it reads a replayed folder twice, and its own
watermark can pass rows of a batch that it reads in parts.
"""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.records import clock_lag
from tidemark.operators.decode import tolerant_decode
from tidemark.operators.partition_watermark import STATE_SCHEMA, least_event, partition_trace
from tidemark.operators.watermark import is_late, last_seen, watermark_trace, with_arrival_order
from tidemark.operators.windows import EVENT_TIME, tumbling_sum_count, with_event_time
from tidemark.presets import REF, Preset
from tidemark.session import ensure_dir
from tidemark.streaming.carried import Carried, finished, remove
from tidemark.streaming.sinks import start_batches

DECODE_METRIC = "decode"
TAGGED_SCHEMA = ("seq BIGINT, arrival_ms BIGINT, timestamp BIGINT, key BINARY, value BINARY, "
                 "partition INT, watermark BIGINT, windowEnd BIGINT, batch BIGINT")
WINDOW_SCHEMA = "windowStart BIGINT, windowEnd BIGINT, location STRING, eventsPerWindow BIGINT, sumPerWindow DOUBLE"


def _ms(ms: int) -> str:
    return f"{int(ms)} milliseconds"


def location_windows(records: DataFrame, preset: Preset = REF,
                     metric_name: str = DECODE_METRIC) -> DataFrame:
    """Streaming on-time windows with Spark's own watermark. The decode
    counter sits right after ``withWatermark`` so the validity filter is not
    pushed below it: undecodable records still advance the watermark."""
    ev = with_event_time(records).withWatermark(EVENT_TIME, _ms(preset.out_of_orderness_ms))
    decoded = tolerant_decode(ev, keep=("seq", "timestamp", "partition", EVENT_TIME),
                              metric_name=metric_name, streaming=True)
    return tumbling_sum_count(decoded.valid, preset.window_ms)


class LateTagger:
    """``foreachBatch`` handler splitting records into late and on-time.

    State: ``<state_path>/batch=<id>`` holds, after batch ``id``, the largest
    event time per watermark group. It is written for every batch (also
    empty ones), so batch ``id`` only reads ``batch=<id - 1>``.

    ``windows_path``: on-time windows, each written once, in the folder of the
    batch that closed it, which is named in ``<windows_path>-commits`` when it is
    complete (see :func:`for_each_committed`). Open windows wait in
    ``<state_path>-open/batch=<id>``, one row per window and location.
    ``invalid_path``: on-time records that do not decode.

    Partition scope keeps one state row per source partition. With
    ``idle_timeout_ms`` a partition silent for longer follows the clock: the
    arrival times of the records and, with ``clock`` (batch id to ms, noted per
    batch so that a replay sees the same), a time that passes without records. With
    windows the watermark is monotone: a partition that appears late cannot reopen a window.
    State folders older than ``keep`` batches are deleted.
    """

    def __init__(self, preset: Preset, late_path: str, on_time_path: str, state_path: str,
                 scope: str = "global", partitions=None,
                 order_cols=("seq",), windows_path: str | None = None, invalid_path: str | None = None,
                 idle_timeout_ms: int | None = None, clock=None, keep: int = 10):
        if scope not in ("global", "partition"):
            raise ValueError(f"unknown scope {scope!r}")
        if idle_timeout_ms is not None and scope == "global":
            raise ValueError("the idle timeout is about partitions")
        self.idle_timeout_ms, self.clock, self.keep = idle_timeout_ms, clock, keep
        self.windows_path, self.invalid_path = windows_path, invalid_path
        self.open_path = f"{state_path}-open"
        self.preset = preset
        self.late_path, self.on_time_path, self.state_path = late_path, on_time_path, state_path
        self.scope, self.partitions = scope, partitions
        # ("seq",): records carry their arrival order. Otherwise a dense order
        # is ranked from these columns in every micro-batch (Kafka input:
        # ("arrival_ms", "partition", "offset")).
        self.order_cols = tuple(order_cols)

    def _previous(self, spark, batch_id: int) -> dict:
        """State after batch ``id - 1``. Every batch writes its state, so a
        missing one is lost data: late records would pass as on time."""
        if batch_id == 0:
            return {}
        folder = os.path.join(self.state_path, f"batch={batch_id - 1}")
        try:
            row = spark.read.parquet(folder).first()
        except AnalysisException as exc:
            raise RuntimeError(f"the watermark state {folder} is missing") from exc
        return row.asDict() if row else {}

    def _commit(self, batch_id: int) -> str:
        return os.path.join(f"{self.windows_path}-commits", f"commit-{batch_id}")

    def _emit_windows(self, on_time: DataFrame, batch_id: int, watermark: int | None) -> None:
        """Add the batch's sums to the open windows; write those that
        ``watermark`` closes and those that stay open."""
        spark = on_time.sparkSession
        decoded = tolerant_decode(on_time, streaming=False)
        sums = tumbling_sum_count(decoded.valid, self.preset.window_ms)
        if batch_id > 0:
            folder = os.path.join(self.open_path, f"batch={batch_id - 1}")
            try:
                carried = spark.read.schema(WINDOW_SCHEMA).parquet(folder)
            except AnalysisException as exc:
                raise RuntimeError(f"the open windows {folder} are missing") from exc
            sums = sums.unionByName(carried)
        merged = sums.groupBy("windowStart", "windowEnd", "location").agg(
            F.sum("eventsPerWindow").alias("eventsPerWindow"), F.sum("sumPerWindow").alias("sumPerWindow")
        ).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            closed = is_late(F.col("windowEnd"), F.lit(watermark).cast("long"))
            # once committed, a replay leaves the windows and their files alone
            if not finished(spark, self._commit(batch_id)):
                folder = os.path.join(self.windows_path, f"batch={batch_id}")
                merged.where(closed).write.mode("overwrite").parquet(folder)
                (spark.range(1).select(F.lit(batch_id).cast("long").alias("batch"), F.lit(folder).alias("folder"))
                 .write.mode("overwrite").parquet(self._commit(batch_id)))
            merged.where(~closed).write.mode("overwrite").parquet(os.path.join(self.open_path, f"batch={batch_id}"))
            if batch_id >= self.keep:
                remove(spark, os.path.join(self.open_path, f"batch={batch_id - self.keep}"))
        finally:
            merged.unpersist()
        if self.invalid_path:
            decoded.invalid.write.mode("overwrite").parquet(os.path.join(self.invalid_path, f"batch={batch_id}"))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        handle = None
        if self.order_cols != ("seq",):
            batch, handle = with_arrival_order(batch, self.order_cols)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)   # read once, used three times
        try:
            (self._global if self.scope == "global" else self._by_partition)(batch, batch_id)
            if batch_id >= self.keep:
                remove(batch.sparkSession, os.path.join(self.state_path, f"batch={batch_id - self.keep}"))
        finally:
            batch.unpersist()
            if handle is not None:
                handle.unpersist()

    def _outputs(self, batch: DataFrame, traced: DataFrame | None, batch_id: int, watermark: int | None) -> None:
        plain = [c for c in batch.columns if c not in ("late", "batch", "poison")]
        if traced is not None:
            cols = [c for c in traced.columns if c not in ("late", "batch", "poison")]
            (traced.filter(F.col("late")).select(*cols).write.mode("overwrite")
                   .parquet(os.path.join(self.late_path, f"batch={batch_id}")))
            (traced.filter(~F.col("late")).select(*cols).write.mode("overwrite")
                   .parquet(os.path.join(self.on_time_path, f"batch={batch_id}")))
        if self.windows_path:
            on_time = batch if traced is None else traced.filter(~F.col("late"))
            self._emit_windows(on_time.select(*plain), batch_id, watermark)

    def _global(self, batch: DataFrame, batch_id: int) -> None:
        prev = self._previous(batch.sparkSession, batch_id)
        state = last_seen(batch).select(F.greatest("all", F.lit(prev.get("all")).cast("long")).alias("all"))
        traced = None
        if not batch.isEmpty():
            traced = watermark_trace(batch, self.preset.out_of_orderness_ms, self.preset.window_ms,
                                     initial_max=prev).persist(StorageLevel.MEMORY_AND_DISK)
        latest = state.first()["all"]
        self._outputs(batch, traced, batch_id, None if latest is None else latest - self.preset.out_of_orderness_ms)
        if traced is not None:
            traced.unpersist()
        # last, so a replay after a failure finds the previous state unchanged
        state.write.mode("overwrite").parquet(os.path.join(self.state_path, f"batch={batch_id}"))

    def _clock_ms(self, spark, batch_id: int) -> int | None:
        if self.clock is None:
            return None
        folder = os.path.join(f"{self.state_path}-clock", f"batch={batch_id}")
        if not finished(spark, folder):
            spark.range(1).select(F.lit(int(self.clock(batch_id))).cast("long").alias("ms")).write.mode("overwrite").parquet(folder)
        if batch_id >= self.keep:
            remove(spark, os.path.join(f"{self.state_path}-clock", f"batch={batch_id - self.keep}"))
        return spark.read.schema("ms BIGINT").parquet(folder).first()["ms"]

    def _by_partition(self, batch: DataFrame, batch_id: int) -> None:
        """Rows (partition, maxTimestamp, lastArrival) and one without a partition
        that holds the watermark."""
        spark, bound, monotone = batch.sparkSession, self.preset.out_of_orderness_ms, bool(self.windows_path)
        table = Carried(self.state_path, STATE_SCHEMA + ", watermark BIGINT", max(2, self.keep))
        carried = table.read(spark, batch_id)
        noted = carried.where("partition IS NULL").first()
        before = noted["watermark"] if noted else None
        state, traced = carried.where("partition IS NOT NULL").drop("watermark"), None
        marks = [before]
        if not batch.isEmpty():
            traced, state = partition_trace(
                batch, bound, self.preset.window_ms, idle_timeout_ms=self.idle_timeout_ms, monotone=monotone,
                carried=state, carried_watermark=before, listed=self.partitions)
            traced = traced.persist(StorageLevel.MEMORY_AND_DISK)
            marks.append(traced.agg(F.max("watermark")).first()[0])
        state = state.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            now = self._clock_ms(spark, batch_id)
            least = state.agg(least_event(state).alias("a"), least_event(state, now, self.idle_timeout_ms).alias("b")).first()
            marks += [w - bound for w in least if w is not None]
            watermark = max([w for w in marks if w is not None], default=None)
            self._outputs(batch, traced, batch_id, watermark)
            note = spark.range(1).select(F.lit(None).cast("int").alias("partition"), F.lit(None).cast("long").alias("maxTimestamp"),
                                         F.lit(None).cast("long").alias("lastArrival"), F.lit(watermark).cast("long").alias("watermark"))
            table.write(state.withColumn("watermark", F.lit(None).cast("long")).unionByName(note), batch_id)
        finally:
            state.unpersist()
            if traced is not None:
                traced.unpersist()


def read_tagged(spark, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream over the tagger's on-time (or late) table."""
    reader = spark.readStream.schema(TAGGED_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def read_windows(spark, path: str) -> DataFrame:
    """Stream over the windows that the tagger emitted. Files of a batch that
    failed half-way may be seen again when it is replayed; a consumer that must see every
    window once uses :func:`for_each_committed`."""
    return spark.readStream.schema(WINDOW_SCHEMA).parquet(path)


def for_each_committed(spark, path: str, handler, name: str, checkpoint: str | None = None,
                       trigger: dict | None = None, app_id: str = "") -> StreamingQuery:
    """Call ``handler(windows, batch id)`` with every window once: the query
    follows the tagger's commits, each naming a folder that is complete and not
    written again. A commit met twice is dropped."""
    folder = f"{path}-commits"
    ensure_dir(spark, folder)
    commits = (spark.readStream.schema("batch BIGINT, folder STRING").option("recursiveFileLookup", "true")
               .parquet(folder).dropDuplicates(["batch"]))

    def read(batch: DataFrame, batch_id: int) -> None:
        folders = [r["folder"] for r in batch.orderBy("batch").collect()]     # one short row a commit
        if folders:
            handler(spark.read.schema(WINDOW_SCHEMA).parquet(*folders), batch_id)
    return start_batches(commits, name, read, checkpoint=checkpoint, trigger=trigger, app_id=app_id)


def with_lag_gauge(windows: DataFrame, name: str = "eventTimeLag") -> DataFrame:
    """Observed metric ``name`` per micro-batch over the emitted windows: lag
    of the wall clock (fixed per micro-batch) behind each window end, as
    count / min / max / mean / stddev in ms. The batch twin with quantiles is
    :func:`tidemark.operators.stats.lag_histogram`."""
    lag = clock_lag(F.unix_millis(F.current_timestamp()), F.col("windowEnd"))
    return windows.observe(name, F.count(lag).alias("count"), F.min(lag).alias("min"),
                           F.max(lag).alias("max"), F.avg(lag).alias("mean"),
                           F.stddev_samp(lag).alias("stddev"))


def on_time_windows(tagged_on_time: DataFrame, preset: Preset = REF,
                    metric_name: str = DECODE_METRIC) -> DataFrame:
    """Windows over a finished on-time table (see the module doc)."""
    return location_windows(tagged_on_time.drop("watermark", "windowEnd", "batch"), preset, metric_name)
