"""Interval statistics, lag histogram, routing."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.operators.routing import route_counts, split_by_type
from tidemark.operators.stats import (LAG_QUANTILES, interval_stats, lag_histogram, lifetime_extremes,
                                      observe_stats)


def _legacy_quantile(sorted_values, p):
    n = len(sorted_values)
    pos = p * (n + 1)
    if pos < 1:
        return float(sorted_values[0])
    if pos >= n:
        return float(sorted_values[-1])
    lo = int(np.floor(pos))
    d = pos - np.floor(pos)
    return sorted_values[lo - 1] + d * (sorted_values[lo] - sorted_values[lo - 1])


def test_lag_histogram_keeps_latest_windows(spark):
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 1_000_000), f"L{rnd.randint(0, 9)}") for _ in range(3000)]
    rows = list({r for r in rows})
    df = spark.createDataFrame(rows, "windowEnd long, location string")
    clock = 2_000_000
    got = lag_histogram(df, clock, history=1000).first()
    latest = sorted(rows, key=lambda r: (r[0], r[1]), reverse=True)[:1000]
    lags = sorted(clock - e for e, _ in latest)
    assert got["n"] == 1000
    assert got["min"] == lags[0] and got["max"] == lags[-1]
    assert abs(got["mean"] - np.mean(lags)) < 1e-6
    assert abs(got["stddev"] - np.std(lags, ddof=1)) < 1e-6
    for p in LAG_QUANTILES:
        label = "p" + f"{p:g}".split(".")[1].ljust(2, "0")
        assert abs(got[label] - _legacy_quantile(lags, p)) < 1e-6, label


def test_lag_histogram_uses_every_window(spark):
    rows = [(k * 7 % 50_000_000_000, f"L{k % 3}") for k in range(0, 30_000_000_000, 1_500_000)]
    df = spark.createDataFrame(rows, "windowEnd long, location string")
    got = lag_histogram(df, 60_000_000_000).first()
    lags = sorted(60_000_000_000 - e for e, _ in rows)
    assert got["n"] == len(rows) == 20_000
    for p in LAG_QUANTILES:
        label = "p" + f"{p:g}".split(".")[1].ljust(2, "0")
        assert abs(got[label] - _legacy_quantile(lags, p)) < 1e-3, label


def test_lifetime_extremes_across_ranges(spark):
    rows = [(k << 31, float((k * 37) % 11), float((k * 53) % 13)) for k in range(40)]
    df = spark.createDataFrame(rows, "intervalStart long, xMin double, xMax double")
    got = {r["intervalStart"]: (r["xLifetimeMin"], r["xLifetimeMax"])
           for r in lifetime_extremes(df, ["x"]).collect()}
    assert got == {s: (min(r[1] for r in rows[:k + 1]), max(r[2] for r in rows[:k + 1]))
                   for k, (s, _, _) in enumerate(rows)}


def test_lag_histogram_small_input_clamps(spark):
    df = spark.createDataFrame([(10, "a"), (20, "b")], "windowEnd long, location string")
    got = lag_histogram(df, 100).first()
    assert got["p50"] == _legacy_quantile([80, 90], 0.5)
    assert got["p999"] == 90.0


def test_interval_stats_and_lifetime(spark):
    rows = [(0, 1.0), (10, 3.0), (100, 10.0), (150, -5.0), (250, 2.0)]
    df = spark.createDataFrame(rows, "ts long, v double")
    s = interval_stats(df, 100, "ts", {"x": F.col("v")})
    life = {r["intervalStart"]: r for r in lifetime_extremes(s, ["x"]).collect()}
    assert life[0]["xMean"] == 2.0 and life[0]["xM2"] == 2.0 and life[0]["n"] == 2
    assert life[100]["xMin"] == -5.0 and life[100]["xMax"] == 10.0
    assert life[200]["xMin"] == 2.0
    assert life[200]["xLifetimeMin"] == -5.0 and life[200]["xLifetimeMax"] == 10.0


def test_observe_stats(spark):
    obs = Observation("g")
    df = observe_stats(spark.createDataFrame([(1.0,), (3.0,)], "v double"), obs, F.col("v"))
    df.collect()
    assert obs.get == {"mean": 2.0, "min": 1.0, "max": 3.0, "count": 2}


def test_unknown_and_null_types_are_unrouted(spark):
    df = spark.createDataFrame([("Temperature",), ("Wind",), ("Rain",), (None,), ("Wind",)],
                               "t string").select(F.struct(F.col("t").alias("sensorType")).alias("sensor"))
    routed = split_by_type(df)
    assert (routed.temperature.count(), routed.wind.count(), routed.unrouted.count()) == (1, 2, 2)
    got = {r["route"]: r["n"] for r in route_counts(df).collect()}
    assert got == {"temperature": 1, "wind": 2, "unrouted": 2}
