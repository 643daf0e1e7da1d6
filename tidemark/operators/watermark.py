"""Watermarks and late rows over bounded input (arrival order known).

The watermark a record meets is the largest event time seen *before* it, minus
the out-of-orderness bound. A record is late when its tumbling window has
already closed: ``windowEnd - 1 <= watermark``. Late records go to a side
output; the main aggregation only sees on-time ones.

Two scopes:

* ``global``: one watermark for the whole source (the maximum over all
  partitions, as a Spark stream has);
* ``partition``: every partition tracks its own maximum and the source
  watermark is the smallest of them. A partition that has not sent anything
  yet does not hold it back; one that falls silent stops holding it back after
  an idle timeout, if one is given.

A prefix maximum over arrival order is a global ordering problem. It is split
so that no task sees more than ``bucket_rows`` records: arrival order is cut
into fixed ranges (buckets) and each bucket computes its running maximum
locally. What came before a bucket is a prefix over the per-bucket maxima
(one row per bucket), itself done in two levels: per super-bucket of
``buckets_per_super`` buckets, plus a prefix over super-buckets. The only
unpartitioned step therefore sees ``rows / (bucket_rows * buckets_per_super)``
rows (about 60 thousand for 10^12 records). The parts are combined with
``greatest``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.records import floor_to

BUCKET_ROWS = 1 << 13
BUCKETS_PER_SUPER = 1 << 12
# up to this many partitions are columns of the plan; more are rows (``partition_watermark``)
MOST_COLUMNS = 64


def _groups(scope: str, partitions, partition_col: str):
    """(name, predicate) per watermark group."""
    if scope == "global":
        return [("all", F.lit(True))]
    if scope == "partition":
        return [(f"p{p}", F.col(partition_col) == F.lit(p)) for p in partitions]
    raise ValueError(f"unknown scope {scope!r}")


def prefix_max(df: DataFrame, masked: dict[str, Column], order_col: str = "seq",
               bucket_rows: int = BUCKET_ROWS, buckets_per_super: int = BUCKETS_PER_SUPER) -> DataFrame:
    """Add, per name in ``masked``, the largest value of that expression over the
    earlier rows (NULL if there is none)."""
    names = list(masked)
    data = df.select("*", F.floor(F.col(order_col) / F.lit(bucket_rows)).alias("_bucket"),
                     *[value.alias(f"_v_{n}") for n, value in masked.items()])

    # one row per bucket: largest value inside it
    per_bucket = (data.groupBy("_bucket").agg(*[F.max(f"_v_{n}").alias(f"_bm_{n}") for n in names])
                  .withColumn("_super", F.floor(F.col("_bucket") / F.lit(buckets_per_super))))
    # prefix over earlier super-buckets (the only unpartitioned step, tiny)
    per_super = per_bucket.groupBy("_super").agg(*[F.max(f"_bm_{n}").alias(f"_sm_{n}") for n in names])
    earlier_super = Window.orderBy("_super").rowsBetween(Window.unboundedPreceding, -1)
    super_prefix = per_super.select(
        "_super", *[F.max(f"_sm_{n}").over(earlier_super).alias(f"_sp_{n}") for n in names])
    # prefix over earlier buckets of the same super-bucket, then both combined
    earlier = Window.partitionBy("_super").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    prefix = (per_bucket
              .select("_bucket", "_super", *[F.max(f"_bm_{n}").over(earlier).alias(f"_bp_{n}") for n in names])
              .join(super_prefix, "_super", "left")
              .select("_bucket", *[F.greatest(f"_bp_{n}", f"_sp_{n}").alias(f"_before_{n}") for n in names]))

    # running maximum inside the bucket, excluding the record itself: every
    # maximum in one select, so one Window operator (one sorted pass) for all
    inside = Window.partitionBy("_bucket").orderBy(F.col(order_col)).rowsBetween(Window.unboundedPreceding, -1)
    data = data.select("*", *[F.max(f"_v_{n}").over(inside).alias(f"_in_{n}") for n in names])
    joined = data.join(prefix, "_bucket", "left")
    return joined.select(*df.columns, *[F.greatest(f"_in_{n}", f"_before_{n}").alias(n) for n in names])


def watermark_trace(df: DataFrame, out_of_orderness_ms: int, window_ms: int,
                    order_col: str = "seq", ts_col: str = "timestamp",
                    scope: str = "global", partitions=None, partition_col: str = "partition",
                    bucket_rows: int = BUCKET_ROWS, buckets_per_super: int = BUCKETS_PER_SUPER,
                    initial_max: dict | None = None, idle_timeout_ms: int | None = None,
                    arrival_col: str = "arrival_ms") -> DataFrame:
    """Add ``watermark`` (ms, NULL before any record), ``windowEnd`` and
    ``late`` to every record.

    In partition scope the partitions are those that the input (or the carried
    state) holds, unless ``partitions`` lists them.
    ``initial_max`` maps a group name (``"all"`` or ``"p<partition>"``) to the
    largest event time seen before this input (used by the stream tagger to
    carry the watermark across micro-batches).

    With ``idle_timeout_ms`` a group that has sent nothing for longer than that
    follows the clock, which is the arrival time of the record in hand: it no
    longer holds the watermark back, and what it sends after such a gap meets a
    maximum that has moved up to the end of the gap. A record without an arrival
    time moves no clock.
    """
    if out_of_orderness_ms < 0 or window_ms <= 0:
        raise ValueError("the out-of-orderness bound must not be negative, the window must be positive")
    if idle_timeout_ms is not None and idle_timeout_ms < 0:
        raise ValueError("the idle timeout must not be negative")
    if idle_timeout_ms is not None and initial_max:
        raise ValueError("idle groups need the whole input: no carried state")
    initial_max = initial_max or {}
    if scope == "partition" and partitions is None:
        partitions = seen_partitions(df, partition_col, initial_max)
        if len(partitions) > MOST_COLUMNS and not initial_max:
            from tidemark.operators.partition_watermark import partition_trace
            return partition_trace(df, out_of_orderness_ms, window_ms, order_col=order_col, ts_col=ts_col,
                                   partition_col=partition_col, arrival_col=arrival_col,
                                   idle_timeout_ms=idle_timeout_ms, buckets_per_super=buckets_per_super)[0]
    groups = _groups(scope, partitions, partition_col)
    ts, now = F.col(ts_col), F.col(arrival_col)
    buckets = {"order_col": order_col, "bucket_rows": bucket_rows, "buckets_per_super": buckets_per_super}

    data, event = df, ts
    if idle_timeout_ms is not None:
        data = prefix_max(data, {f"_last_{n}": F.when(cond, now) for n, cond in groups}, **buckets)
        gap = F.coalesce(*[F.when(cond, now - F.col(f"_last_{n}")) for n, cond in groups], F.lit(None).cast("long"))
        event = F.when(gap > idle_timeout_ms, F.greatest(ts, now)).otherwise(ts)
    data = prefix_max(data, {f"_max_{n}": F.when(cond, event) for n, cond in groups}, **buckets)

    seen = []
    for name, _ in groups:
        largest = F.col(f"_max_{name}")
        if initial_max.get(name) is not None:
            largest = F.greatest(largest, F.lit(int(initial_max[name])))
        if idle_timeout_ms is not None:
            largest = F.when(now - F.col(f"_last_{name}") > idle_timeout_ms,
                             F.greatest(largest, now)).otherwise(largest)
        seen.append(largest)
    if not seen:                       # partition scope without any partition
        seen = [F.lit(None).cast("long")]
    max_seen = seen[0] if len(seen) == 1 else F.least(*seen)
    end = floor_to(ts, window_ms) + F.lit(window_ms)
    return (data.select(*df.columns, (max_seen - F.lit(out_of_orderness_ms)).alias("watermark"), end.alias("windowEnd"))
                .withColumn("late", is_late(F.col("windowEnd"), F.col("watermark"))))


def is_late(window_end: Column, watermark: Column) -> Column:
    """A window is closed once the watermark reached its last millisecond."""
    return F.coalesce(window_end - F.lit(1) <= watermark, F.lit(False))


def split_late(traced: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(on-time records, late records) of a traced frame."""
    return traced.filter(~F.col("late")), traced.filter(F.col("late"))


def seen_partitions(df: DataFrame, partition_col: str = "partition", carried=()) -> list[int]:
    """Source partitions of the input and of the carried state (group names
    ``p<partition>``): one number per partition of the source."""
    rows = df.select(F.col(partition_col).cast("int").alias("p")).where("p IS NOT NULL").distinct().collect()
    return sorted({r["p"] for r in rows} | {int(name[1:]) for name in carried})


def last_seen(df: DataFrame, scope: str = "global", partitions=None,
              partition_col: str = "partition", ts_col: str = "timestamp") -> DataFrame:
    """One row with the largest event time per watermark group (the state the
    stream tagger carries to the next micro-batch)."""
    if scope == "partition" and partitions is None:
        partitions = seen_partitions(df, partition_col)
    groups = _groups(scope, partitions, partition_col)
    if not groups:
        return df.sparkSession.range(1).select()
    return df.agg(*[F.max(F.when(cond, F.col(ts_col))).alias(name) for name, cond in groups])


def partition_activity(df: DataFrame, num_partitions: int, idle_timeout_ms: int,
                       clock_ms: int | None = None, partition_col: str = "partition",
                       ts_col: str = "timestamp", arrival_col: str = "arrival_ms") -> DataFrame:
    """Per source partition: rows, last event time, last arrival and ``idle``.

    A partition is idle when it sent nothing, or nothing within
    ``idle_timeout_ms`` before the clock. Without a clock, the end of the
    input (latest arrival over all partitions) is the clock. ``num_partitions``
    adds the partitions below it that sent nothing; others that did send are
    listed too. The per-partition table has one row per source partition, so
    the clock window over it is small.
    """
    if num_partitions < 0 or idle_timeout_ms < 0:
        raise ValueError("the number of partitions and the timeout must not be negative")
    spark = df.sparkSession
    per = df.groupBy(F.col(partition_col).cast("int").alias("partition")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(F.col(ts_col)).alias("lastTimestamp"),
        F.max(F.col(arrival_col)).alias("lastArrival"))
    every = spark.range(num_partitions).select(F.col("id").cast("int").alias("partition"))
    table = every.join(per, "partition", "full")
    clock = (F.lit(int(clock_ms)) if clock_ms is not None
             else F.max("lastArrival").over(Window.partitionBy()))
    return (table
            .withColumn("rows", F.coalesce(F.col("rows"), F.lit(0)))
            .withColumn("idle", F.col("lastArrival").isNull()
                        | (F.col("lastArrival") < clock - F.lit(idle_timeout_ms))))


def with_arrival_order(df: DataFrame, order_cols, name: str = "seq"):
    """Dense arrival order ``name`` (0-based) from sortable columns such as a
    Kafka record's ``(arrival_ms, partition, offset)``: offsets alone are only
    ordered within one partition. Ranked with one range shuffle, no single
    task. Returns ``(frame, handle)``; call ``handle.unpersist()`` after use."""
    from tidemark.operators.ema import rank_with_handle
    ranked, handle = rank_with_handle(df.withColumn("_all", F.lit(0)), ["_all"], list(order_cols))
    return ranked.withColumn(name, F.col("_rank") - F.lit(1)).drop("_rank", "_all"), handle
