"""Watermark of the slowest source partition, for any number of partitions.

The watermark a record meets is the smallest, over the partitions that have sent
something before it, of their largest event times. Columns per partition would make the
plan grow with the source; here partitions are rows:

1. arrival order is cut into buckets; per bucket and partition the largest event
   time (and last arrival) is aggregated, and a running maximum over the buckets of a
   partition gives its state after each of its buckets;
2. that state holds at the start of every following bucket up to the partition's
   next one, so every bucket receives one row per partition seen before it
   (buckets are at least ``STATE_SHARE`` times as long as there are partitions, so
   these rows stay a small share of the records);
3. inside a bucket one pass over its records keeps the partitions in heaps by
   event time and by last arrival; a record costs the logarithm of the number of
   partitions.

With an idle timeout a partition that has sent nothing for longer follows the
clock, the arrival time of the record in hand. ``monotone`` replaces the watermark by its
largest value so far: a partition that appears late can not turn it back, so a
window once closed stays closed.

State can be carried from one input to the next (:func:`next_state`): splitting
an input anywhere gives the same trace.
"""

from __future__ import annotations

import heapq
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.records import floor_to
from tidemark.operators.watermark import BUCKET_ROWS, BUCKETS_PER_SUPER, is_late, prefix_max

STATE_SCHEMA = "partition INT, maxTimestamp BIGINT, lastArrival BIGINT"
STATE_SHARE = 16
# what runs in workers travels with the task
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class _Partitions:
    """Largest event time and last arrival per partition, and their smallest
    effective event time at a clock. Heap entries are dropped when they no
    longer agree with the tables."""

    def __init__(self, idle_timeout: int | None):
        self.timeout = idle_timeout
        self.top, self.last, self.idle = {}, {}, set()
        self.all, self.active, self.by_last, self.asleep, self.asleep_last = [], [], [], [], []

    def update(self, p, event, arrival) -> None:
        if event is not None and (p not in self.top or event > self.top[p]):
            self.top[p] = event
            heapq.heappush(self.all, (event, p))
            if self.timeout is not None:
                heapq.heappush(self.asleep if p in self.idle else self.active, (event, p))
        if self.timeout is not None and arrival is not None and arrival > self.last.get(p, arrival - 1):
            self.last[p] = arrival
            if p in self.idle:
                heapq.heappush(self.asleep_last, (-arrival, p))
            else:
                heapq.heappush(self.by_last, (arrival, p))

    def _least(self, heap, idle: bool | None):
        while heap:
            event, p = heap[0]
            if self.top.get(p) == event and (idle is None or (p in self.idle) == idle):
                return event
            heapq.heappop(heap)
        return None

    def least(self, now) -> int | None:
        if self.timeout is None or now is None:
            return self._least(self.all, None)
        while self.by_last:                          # fell silent
            arrival, p = self.by_last[0]
            if p in self.idle or self.last[p] != arrival:
                heapq.heappop(self.by_last)
            elif now - arrival > self.timeout:
                heapq.heappop(self.by_last)
                self.idle.add(p)
                heapq.heappush(self.asleep_last, (-arrival, p))
                if p in self.top:
                    heapq.heappush(self.asleep, (self.top[p], p))
            else:
                break
        while self.asleep_last:                      # heard of again, or an earlier clock
            arrival, p = -self.asleep_last[0][0], self.asleep_last[0][1]
            if p not in self.idle or self.last[p] != arrival:
                heapq.heappop(self.asleep_last)
            elif now - arrival <= self.timeout:
                heapq.heappop(self.asleep_last)
                self.idle.remove(p)
                heapq.heappush(self.by_last, (arrival, p))
                if p in self.top:
                    heapq.heappush(self.active, (self.top[p], p))
            else:
                break
        awake, silent = self._least(self.active, False), self._least(self.asleep, True)
        if silent is None:
            return awake
        silent = max(silent, now)
        return silent if awake is None else min(awake, silent)


def _running(per: DataFrame, columns, buckets_per_super: int, inclusive: bool) -> DataFrame:
    """Running maximum of ``columns`` over the buckets of a partition, in two
    levels; with or without the bucket itself."""
    per = per.withColumn("_super", F.floor(F.col("_bucket") / F.lit(buckets_per_super)))
    earlier_super = Window.partitionBy("_p").orderBy("_super").rowsBetween(Window.unboundedPreceding, -1)
    before = (per.groupBy("_p", "_super").agg(*[F.max(c).alias(c) for c in columns])
              .select("_p", "_super", *[F.max(c).over(earlier_super).alias(f"_s{c}") for c in columns]))
    upto = (Window.partitionBy("_p", "_super").orderBy("_bucket")
            .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
    return (per.select("_p", "_bucket", "_super", *[F.max(c).over(upto).alias(c) for c in columns])
            .join(before, ["_p", "_super"])
            .select("_p", "_bucket", *[F.greatest(c, f"_s{c}").alias(c) for c in columns]))


def with_event(df: DataFrame, idle_timeout_ms: int | None, order_col: str, ts_col: str, partition_col: str,
               arrival_col: str, bucket_rows: int, buckets_per_super: int, carried: DataFrame | None) -> DataFrame:
    """``df`` with ``_p``, ``_bucket``, ``_now`` and ``_event``: the event time a
    record reports, moved up to its arrival after a gap longer than the timeout."""
    idle = idle_timeout_ms is not None
    data = df.select("*", F.col(partition_col).cast("int").alias("_p"),
                     F.floor(F.col(order_col) / F.lit(bucket_rows)).alias("_bucket"),
                     (F.col(arrival_col) if idle else F.lit(None)).cast("long").alias("_now"))
    ts = F.col(ts_col).cast("long")
    if not idle:
        return data.withColumn("_event", ts)
    last = _running(data.where("_p IS NOT NULL").groupBy("_p", "_bucket").agg(F.max("_now").alias("_l")),
                    ["_l"], buckets_per_super, inclusive=False)
    if carried is not None:
        known = carried.select(F.col("partition").alias("_p"), F.col("lastArrival").alias("_c"))
        last = last.join(known, "_p", "left").select("_p", "_bucket", F.greatest("_l", "_c").alias("_l"))
    inside = Window.partitionBy("_bucket", "_p").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    data = (data.withColumn("_in", F.max("_now").over(inside))
            .join(last, ["_p", "_bucket"], "left"))
    gap = F.when(F.col("_p").isNotNull(), F.col("_now") - F.greatest("_in", "_l"))
    return (data.withColumn("_event", F.when(gap > idle_timeout_ms, F.greatest(ts, F.col("_now"))).otherwise(ts))
            .drop("_in", "_l"))


def next_state(events: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """(partition, maxTimestamp, lastArrival) after the records of
    :func:`with_event`: one row per partition seen."""
    rows = events.where("_p IS NOT NULL").groupBy(F.col("_p").alias("partition")).agg(
        F.max("_event").alias("maxTimestamp"), F.max("_now").alias("lastArrival"))
    if carried is not None:
        rows = (rows.unionByName(carried.select(*rows.columns)).groupBy("partition")
                .agg(F.max("maxTimestamp").alias("maxTimestamp"), F.max("lastArrival").alias("lastArrival")))
    return rows


def least_event(state: DataFrame, clock_ms: int | None = None, idle_timeout_ms: int | None = None) -> Column:
    """Aggregate over a state: the smallest event time at a clock (without one,
    nobody is idle)."""
    top = F.col("maxTimestamp")
    if clock_ms is not None and idle_timeout_ms is not None:
        clock = F.lit(int(clock_ms))
        top = F.when(clock - F.col("lastArrival") > idle_timeout_ms, F.greatest(top, clock)).otherwise(top)
    return F.min(top)


def _bucket_states(events: DataFrame, buckets_per_super: int, carried: DataFrame | None, first: int,
                   last: int) -> DataFrame:
    """(_at, _who, _m, _l): every partition's state at the start of every bucket."""
    per = events.where("_p IS NOT NULL").groupBy("_p", "_bucket").agg(F.max("_event").alias("_m"), F.max("_now").alias("_l"))
    if carried is not None:
        per = per.unionByName(carried.select(F.col("partition").alias("_p"), F.lit(first - 1).cast("long").alias("_bucket"),
                                             F.col("maxTimestamp").alias("_m"), F.col("lastArrival").alias("_l")))
    after = _running(per, ["_m", "_l"], buckets_per_super, inclusive=True)
    following = F.coalesce(F.lead("_bucket").over(Window.partitionBy("_p").orderBy("_bucket")), F.lit(last))
    return (after.withColumn("_to", following).where("_bucket < _to")
            .select(F.explode(F.expr("sequence(_bucket + 1, _to)")).alias("_at"), F.col("_p").alias("_who"), "_m", "_l"))


def partition_trace(df: DataFrame, out_of_orderness_ms: int, window_ms: int, *, order_col: str = "seq",
                    ts_col: str = "timestamp", partition_col: str = "partition", arrival_col: str = "arrival_ms",
                    idle_timeout_ms: int | None = None, monotone: bool = False, carried: DataFrame | None = None,
                    carried_watermark: int | None = None, bucket_rows: int | None = None,
                    buckets_per_super: int = BUCKETS_PER_SUPER, listed=None) -> tuple[DataFrame, DataFrame]:
    """``(trace, state)``: ``df`` with ``watermark``, ``windowEnd`` and ``late``
    as ``watermark_trace(scope="partition")`` adds them, and the state to carry.

    ``carried`` (``STATE_SCHEMA``) and, for ``monotone``, ``carried_watermark`` come
    from the input before. ``listed`` restricts the partitions that count. A
    record without a partition meets the watermark but moves nothing.
    """
    if out_of_orderness_ms < 0 or window_ms <= 0:
        raise ValueError("the out-of-orderness bound must not be negative, the window must be positive")
    if idle_timeout_ms is not None and idle_timeout_ms < 0:
        raise ValueError("the idle timeout must not be negative")
    if bucket_rows is None:
        seen = df.select(F.approx_count_distinct(partition_col)).first()[0]
        if carried is not None:
            seen = max(seen, carried.count())
        bucket_rows = max(BUCKET_ROWS, STATE_SHARE * seen)
    columns = df.columns
    events = with_event(df, idle_timeout_ms, order_col, ts_col, partition_col, arrival_col, bucket_rows,
                        buckets_per_super, carried)
    if listed is not None:
        events = events.withColumn("_p", F.when(F.col("_p").isin(*listed), F.col("_p")))
    state = next_state(events, carried)
    ends = df.agg(F.min(order_col).alias("lo"), F.max(order_col).alias("hi")).first()
    first, last = ((ends["lo"] or 0) // bucket_rows, (ends["hi"] or 0) // bucket_rows)
    starts = _bucket_states(events, buckets_per_super, carried, int(first), int(last))
    schema = T.StructType([*events.schema.fields, T.StructField("_least", T.LongType())])

    def walk(rows, before):
        import pyarrow as pa
        rows = rows.sort_by(order_col)
        known = _Partitions(idle_timeout_ms)
        for p, m, arrival in zip(*(before[c].to_pylist() for c in ("_who", "_m", "_l"))):
            known.update(p, m, arrival)
        out = []
        for p, event, now in zip(*(rows[c].to_pylist() for c in ("_p", "_event", "_now"))):
            out.append(known.least(now))
            if p is not None:
                known.update(p, event, now)
        return rows.append_column("_least", pa.array(out, pa.int64()))

    walked = events.groupBy("_bucket").cogroup(starts.groupBy("_at")).applyInArrow(walk, schema)
    traced = walked.select(*columns, (F.col("_least") - F.lit(out_of_orderness_ms)).alias("watermark"))
    if monotone:
        traced = prefix_max(traced, {"_before": F.col("watermark")}, order_col, bucket_rows, buckets_per_super)
        traced = traced.select(*columns, F.greatest(
            "watermark", "_before", F.lit(carried_watermark).cast("long")).alias("watermark"))
    traced = traced.withColumn("windowEnd", floor_to(F.col(ts_col), window_ms) + F.lit(window_ms))
    return traced.withColumn("late", is_late(F.col("windowEnd"), F.col("watermark"))), state
