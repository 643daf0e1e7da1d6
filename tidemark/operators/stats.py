"""Interval statistics, lifetime extremes and the event-time lag histogram."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.records import clock_lag, floor_to

# Reported lag quantiles.
LAG_QUANTILES = (0.5, 0.75, 0.95, 0.98, 0.99, 0.999)
# Ordered passes run inside ranges of this many milliseconds; only one row per
# range meets in one task.
RANGE_MS = 1 << 32


def moments(x: Column, prefix: str) -> list[Column]:
    """count, mean, min, max and second central moment (sum of squared
    deviations) of ``x``."""
    return [F.avg(x).alias(f"{prefix}Mean"), F.min(x).alias(f"{prefix}Min"),
            F.max(x).alias(f"{prefix}Max"),
            (F.var_pop(x) * F.count(x)).alias(f"{prefix}M2")]


def interval_stats(df: DataFrame, interval_ms: int, ts_col: str, metrics: dict) -> DataFrame:
    """Per epoch-aligned interval: ``n`` and the moments of every
    ``{prefix: column}`` in ``metrics``."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for prefix, col in metrics.items():
        aggs += moments(col, prefix)
    return (df.groupBy(floor_to(F.col(ts_col), interval_ms).alias("intervalStart"))
              .agg(*aggs))


def lifetime_extremes(stats: DataFrame, prefixes, order_col: str = "intervalStart") -> DataFrame:
    """Running min / max over intervals (a gauge that is never reset), in two
    levels: a prefix over ranges of ``RANGE_MS`` (one row each), joined to the
    running values inside every range."""
    ranged = stats.withColumn("_range", F.floor(F.col(order_col) / F.lit(RANGE_MS)))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per = ranged.groupBy("_range").agg(
        *[F.min(f"{p}Min").alias(f"_lo_{p}") for p in prefixes],
        *[F.max(f"{p}Max").alias(f"_hi_{p}") for p in prefixes])
    before = per.select("_range", *[F.min(f"_lo_{p}").over(earlier).alias(f"_before_lo_{p}") for p in prefixes],
                        *[F.max(f"_hi_{p}").over(earlier).alias(f"_before_hi_{p}") for p in prefixes])
    upto = Window.partitionBy("_range").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.join(before, "_range", "left")
    for p in prefixes:
        out = (out.withColumn(f"{p}LifetimeMin", F.least(F.min(f"{p}Min").over(upto), f"_before_lo_{p}"))
                  .withColumn(f"{p}LifetimeMax", F.greatest(F.max(f"{p}Max").over(upto), f"_before_hi_{p}")))
    return out.drop("_range", *[f"_before_{k}_{p}" for p in prefixes for k in ("lo", "hi")])


def observe_stats(df: DataFrame, name, x: Column) -> DataFrame:
    """Attach mean / min / max / count of ``x`` as observed metrics (a gauge
    per micro-batch in a stream, an :class:`Observation` in batch)."""
    return df.observe(name, F.avg(x).alias("mean"), F.min(x).alias("min"),
                      F.max(x).alias("max"), F.count(x).alias("count"))


def lag_histogram(windows: DataFrame, clock_ms, history: int | None = None,
                  quantiles=LAG_QUANTILES) -> DataFrame:
    """Statistics of ``clock - windowEnd`` over all emitted windows, or over the
    latest ``history`` of them (emission order: window end, then key).

    See :func:`lag_statistics` for the quantiles.
    """
    chosen = windows.select("windowEnd", "location")
    if history is not None:
        chosen = chosen.orderBy(F.col("windowEnd").desc(), F.col("location").desc()).limit(history)
    return lag_statistics(chosen.select(clock_lag(clock_ms, F.col("windowEnd")).alias("lag")), quantiles)


def lag_statistics(lags: DataFrame, quantiles=LAG_QUANTILES) -> DataFrame:
    """One row of statistics of the column ``lag``.

    Quantiles are the classic estimator: rank ``p * (n + 1)`` with linear
    interpolation, clamped to the first / last value. Ranks come from counts
    per distinct lag and a prefix in two levels (ranges of ``RANGE_MS``, then
    inside a range), so no group or task holds all windows.
    """
    counts = (lags.groupBy("lag").agg(F.count(F.lit(1)).alias("c"))
              .withColumn("_range", F.floor(F.col("lag") / F.lit(RANGE_MS))))
    d = F.col("lag").cast("double")
    in_order = Window.orderBy("_range")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    every = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = (counts.groupBy("_range").agg(F.sum("c").alias("_c"), F.min("lag").alias("_min"),
                                           F.max("lag").alias("_max"), F.sum(d * F.col("c")).alias("_sum"))
              .select("_range", F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_before"),
                      F.sum("_c").over(every).alias("n"), F.min("_min").over(every).alias("min"),
                      F.max("_max").over(every).alias("max"),
                      (F.sum("_sum").over(every) / F.sum("_c").over(every)).alias("mean")))
    inside = Window.partitionBy("_range").orderBy("lag").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (counts.join(before, "_range")
              .withColumn("_last", F.col("_before") + F.sum("c").over(inside)))
    first, last = F.col("_last") - F.col("c"), F.col("_last")

    def at(rank):                      # the lag of a 1-based rank
        return F.max(F.when((rank > first) & (rank <= last), F.col("lag")))
    aggs = [F.max(c).alias(c) for c in ("n", "min", "max", "mean")]
    gap = d - F.col("mean")
    aggs.append(F.when(F.max("n") > 1, F.sqrt(F.sum(F.col("c") * gap * gap) / (F.max("n") - 1))).alias("stddev"))
    for k, p in enumerate(quantiles):
        pos = F.lit(p) * (F.col("n") + F.lit(1)).cast("double")
        low = F.floor(pos)
        aggs += [at(F.greatest(low, F.lit(1))).alias(f"_lo{k}"), at(F.least(low + 1, F.col("n"))).alias(f"_hi{k}")]
    agg = ranked.agg(*aggs).withColumn("n", F.coalesce("n", F.lit(0)))
    cols = [F.col(c) for c in ("n", "min", "max", "mean", "stddev")]
    for k, p in enumerate(quantiles):
        pos = F.lit(p) * (F.col("n") + F.lit(1)).cast("double")
        lo, hi = F.col(f"_lo{k}").cast("double"), F.col(f"_hi{k}").cast("double")
        value = (F.when(pos < 1, F.col("min").cast("double")).when(pos >= F.col("n"), F.col("max").cast("double"))
                 .otherwise(lo + (pos - F.floor(pos)) * (hi - lo)))
        cols.append(value.alias("p" + f"{p:g}".split(".")[1].ljust(2, "0")))
    return agg.select(*cols)
