"""Exponential moving average with coefficient 1/2 per sensor (batch form).

Per key, in ``(timestamp, seq)`` order: the first row only seeds the average
and is not emitted; every later row emits ``avg = (avg + x) / 2`` for the value
(double) and the accuracy (float arithmetic), with the row's own timestamp.
A NULL value or accuracy counts as 0, as in the decoder.

The recursion runs over blocks of 64 consecutive rows: inside a block it is
folded row by row from the state that the earlier rows left. A block changes
the state from ``s`` to ``s * 2**-n + fold from 0``, so that state is composed
from the 34 blocks before it: what is older weighs less than ``2**-2176``,
which is nothing for any finite double. NaN and infinities never fade; the
first position of each is found per key and added to the state. The accuracy
narrows to float at every step, so its state is folded once more over the
previous block. Exceptions: values beyond half the double range, whose plain
sum would overflow (the composed state does not), and a last bit of the
accuracy where 64 roundings in a row keep two neighbouring floats apart.

Two plans are offered:

* ``window``: rows are ranked by one window partitioned by the key. Simple,
  but a hot key is sorted in one task.
* ``chunked`` (default): rows get their exact rank within the key, are cut
  into chunks of ``chunk_rows`` ranks, and each chunk also receives the 2,240
  rows that precede it (a halo). A key of any size spreads over many tasks.

Ranks come from Spark's range partitioner: ``repartitionByRange(key, ts, seq)``
samples the input and cuts it into balanced sorted ranges, splitting a hot key
over as many partitions as its size needs. Inside a sorted partition
``monotonically_increasing_id`` follows the order, so a row's rank is the rows
of its key in earlier partitions (from per-(key, partition) counts: at most
``keys + partitions`` rows, which Spark's size check broadcasts) plus its
position in the partition. No step holds more than one range partition or
one chunk.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import checkpoint_root

BLOCK = 64
BLOCKS_BACK = 34                      # 34 * 64 halvings reach below every double
HALO = BLOCK * (BLOCKS_BACK + 1)      # one block more: the first may be cut short


def _next_value(avg: Column, x: Column) -> Column:
    return (avg + x) / F.lit(2.0)


def _next_accuracy(avg: Column, x: Column) -> Column:
    return ((avg + x) / F.lit(2.0)).cast("float")


def _flat_key(df: DataFrame, key_cols) -> tuple[DataFrame, list[str]]:
    names = []
    for i, c in enumerate(key_cols):
        name = f"_k{i}"
        df = df.withColumn(name, F.col(c))
        names.append(name)
    return df, names


def _specials(ranked: DataFrame, keys) -> DataFrame:
    """Per key that has any: rank of the first NaN, infinity and negative
    infinity among its values and accuracies."""
    bad = {"nan": float("nan"), "up": float("inf"), "down": float("-inf")}
    # Spark holds NaN equal to NaN
    firsts = [F.min(F.when(F.col(c) == F.lit(x), F.col("_rank"))).alias(f"{c}_{name}")
              for c in ("_v", "_a") for name, x in bad.items()]
    special = [F.col(c).isin(*bad.values()) for c in ("_v", "_a")]
    return ranked.where(special[0] | special[1]).groupBy(*keys).agg(*firsts)


def _left_by_specials(c: str, before: Column) -> Column:
    """0, or what NaN and infinities of the rows ranked below ``before`` made of the state."""
    def part(name, x):
        return F.when(F.col(f"{c}_{name}") < before, F.lit(x)).otherwise(F.lit(0.0))
    return part("nan", float("nan")) + part("up", float("inf")) + part("down", float("-inf"))


def _average(spread: DataFrame, keys, columns, specials: DataFrame | None = None) -> DataFrame:
    """The averaged rows of ``spread``: rows dealt to ``_chunk``, ``_halo``
    marking copies. Without ``specials`` a chunk holds its whole key, and NaN
    and infinities are summed over its earlier blocks."""
    rows = F.sort_array(F.collect_list(F.struct("_rank", "_halo", "_v", "_a", F.struct(*columns).alias("row"))))
    blocks = (spread.groupBy(*keys, "_chunk", F.floor((F.col("_rank") - 1) / F.lit(BLOCK)).alias("_block"))
              .agg(rows.alias("_rows"), F.min("_halo").alias("_copy")))
    order = Window.partitionBy(*keys, "_chunk").orderBy("_block")
    blocks = blocks.select("*", F.lag("_block").over(order).isNull().alias("_first"))
    # the first block is seeded by its first row, the others start from 0 here
    first = F.col("_rows")[0]
    blocks = blocks.withColumn("_fold", F.when(F.col("_first"), F.slice("_rows", 2, BLOCK)).otherwise(F.col("_rows")))

    def from_zero(c):
        zero = F.when(F.col("_first"), first[c].cast("double")).otherwise(F.lit(0.0))
        return F.aggregate("_fold", zero, lambda s, r: _next_value(s, r[c].cast("double")))
    blocks = blocks.withColumn("_own", F.struct(
        F.pow(F.lit(2.0), -F.size("_rows").cast("double")).alias("w"),
        from_zero("_v").alias("_v"), from_zero("_a").alias("_a")))
    blocks = blocks.withColumn("_past", F.collect_list("_own").over(order.rowsBetween(-BLOCKS_BACK, -1)))
    if specials is not None:
        blocks = blocks.join(specials, keys, "left")
        left = {c: _left_by_specials(c, F.col("_rows")[0]["_rank"]) for c in ("_v", "_a")}
    else:
        def bad_sum(c):
            return F.aggregate("_rows", F.lit(0.0), lambda s, r: s + F.when(
                F.abs(r[c]) >= F.lit(float("inf")), r[c].cast("double")).otherwise(F.lit(0.0)))
        earlier = order.rowsBetween(Window.unboundedPreceding, -1)
        blocks = blocks.withColumn("_bad_v", bad_sum("_v")).withColumn("_bad_a", bad_sum("_a"))
        left = {c: F.coalesce(F.sum(f"_bad{c}").over(earlier), F.lit(0.0)) for c in ("_v", "_a")}

    def composed(c):
        return F.aggregate("_past", F.lit(0.0), lambda s, b: s * b["w"] + b[c]) + left[c]
    blocks = blocks.withColumn("_state_v", composed("_v")).withColumn("_state_a", composed("_a").cast("float"))
    blocks = blocks.select("*", F.lag(F.struct("_state_a", "_fold", "_first", first["_a"].alias("seed")))
                           .over(order).alias("_prev")).where(~F.col("_copy"))
    seed_a = F.aggregate(
        "_prev._fold", F.when(F.col("_prev._first"), F.col("_prev.seed")).otherwise(F.col("_prev._state_a")),
        lambda s, r: _next_accuracy(s, r["_a"]))
    kind = "array<struct<v:double,a:float>>"
    start = F.when(F.col("_first"), F.struct(first["_v"].alias("v"), first["_a"].alias("a"))).otherwise(
        F.struct(F.col("_state_v").alias("v"), seed_a.alias("a")))

    def step(states, r):
        last = F.element_at(states, -1)
        return F.concat(states, F.array(F.struct(
            _next_value(last["v"], r["_v"]).alias("v"), _next_accuracy(last["a"], r["_a"]).alias("a")))).cast(kind)
    states = F.aggregate("_fold", F.array(start).cast(kind), step)
    states = F.when(F.col("_first"), states).otherwise(F.slice(states, 2, BLOCK))
    out = (blocks.select("_rows", states.alias("_states"))
           .select(F.explode(F.arrays_zip("_rows", "_states")).alias("_z"))
           .where(~F.col("_z._rows._halo") & (F.col("_z._rows._rank") > 1))
           .select("_z._rows.row.*", F.col("_z._states").alias("_state")))
    return out.withColumn("measurement", F.struct(
        F.col("_state.v").alias("value"), F.col("_state.a").alias("accuracy"),
        F.col("measurement.timestamp").alias("timestamp"))).drop("_state")


def _with_readings(df: DataFrame) -> DataFrame:
    return (df.withColumn("_v", F.coalesce(F.col("measurement.value").cast("double"), F.lit(0.0)))
              .withColumn("_a", F.coalesce(F.col("measurement.accuracy").cast("float"), F.lit(0.0).cast("float"))))


def ema_window(df: DataFrame, key_cols, order_cols=("measurement.timestamp", "seq")) -> DataFrame:
    """EMA with ranks from one window partitioned by the key."""
    columns = df.columns
    df, keys = _flat_key(df, key_cols)
    by_key = Window.partitionBy(*keys).orderBy(*[F.col(c) for c in order_cols])
    ranked = _with_readings(df.withColumn("_rank", F.row_number().over(by_key).cast("bigint")))
    spread = ranked.withColumn("_chunk", F.lit(0)).withColumn("_halo", F.lit(False))
    return _average(spread, keys, columns)


def rank_within_key(df: DataFrame, keys, order_cols, materialize: str = "persist") -> DataFrame:
    """See :func:`rank_with_handle`; returns the ranked frame only."""
    return rank_with_handle(df, keys, order_cols, materialize)[0]


def rank_with_handle(df: DataFrame, keys, order_cols, materialize: str = "persist"):
    """Add ``_rank`` (1-based position of the row within its key in
    ``order_cols`` order) without sorting any key in a single task. Returns
    ``(ranked, ranges)``; ``ranges.unpersist()`` frees the materialised ranges
    once the ranked frame has been used.

    The counts and the rows must come from the *same* range shuffle: the
    partitioner samples its bounds per shuffle, and two shuffles of the same
    rows may cut differently. The sorted ranges are therefore materialised
    once and both branches read them: ``persist`` (cached blocks; a lost block
    is rebuilt from the same shuffle, so bounds and order stay the same) or
    ``checkpoint`` (written to the shared checkpoint folder).
    """
    order = [F.col(c) for c in order_cols]
    key_cols = [F.col(k) for k in keys]
    ranges = (df.repartitionByRange(*key_cols, *order)
                .sortWithinPartitions(*key_cols, *order))
    if materialize == "checkpoint":
        checkpoint_root(df.sparkSession)
        ranges = ranges.checkpoint(eager=True)
    else:
        ranges = ranges.persist(StorageLevel.MEMORY_AND_DISK)
    ranged = (ranges.withColumn("_pid", F.spark_partition_id())
                    .withColumn("_id", F.monotonically_increasing_id()))
    # rows and first id per (key, range partition): at most keys + partitions
    # rows; offsets = rows of the key in earlier partitions
    counts = (ranged.groupBy(*keys, "_pid")
                    .agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
                    .withColumn("_off", F.coalesce(F.sum("_n").over(
                        Window.partitionBy(*keys).orderBy("_pid")
                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                    .drop("_n"))
    ranked = (ranged.join(counts, [*keys, "_pid"])
                    .withColumn("_rank", F.col("_off") + F.col("_id") - F.col("_first") + F.lit(1))
                    .drop("_pid", "_id", "_first", "_off"))
    return ranked, ranges


def ema_chunked(df: DataFrame, key_cols, order_cols=("measurement.timestamp", "seq"),
                chunk_rows: int = 1 << 20, materialize: str = "persist", handles: list | None = None) -> DataFrame:
    """EMA with exact ranks and overlapping chunks (see module doc). The
    materialised ranges are added to ``handles``, for a caller that frees them."""
    if chunk_rows < 1:
        raise ValueError("chunk_rows must be positive")
    columns = df.columns
    df, keys = _flat_key(df, key_cols)
    df = df.withColumn("_o0", F.col(order_cols[0])).withColumn("_o1", F.col(order_cols[1]))
    ranked, ranges = rank_with_handle(df, keys, ["_o0", "_o1"], materialize)
    if handles is not None:
        handles.append(ranges)
    ranked = _with_readings(ranked.drop("_o0", "_o1"))
    pos = F.col("_rank") - F.lit(1)
    own = F.floor(pos / F.lit(chunk_rows))
    # a row goes to its chunk and, as a copy, to those that start within the next HALO rows
    spread = (ranked.withColumn("_chunk", F.explode(F.sequence(own, F.floor((pos + F.lit(HALO)) / F.lit(chunk_rows)))))
                    .withColumn("_halo", F.col("_chunk") != own))
    return _average(spread.repartition(*keys, "_chunk"), keys, columns, _specials(ranked, keys))


def ema(df: DataFrame, key_cols, method: str = "chunked", **kw) -> DataFrame:
    if method == "window":
        return ema_window(df, key_cols, **kw)
    if method == "chunked":
        return ema_chunked(df, key_cols, **kw)
    raise ValueError(f"unknown EMA method {method!r}")
