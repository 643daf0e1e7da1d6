"""Tumbling and sliding windows."""

from __future__ import annotations

import random

import pytest

from pyspark.sql import functions as F

from tidemark.operators.windows import sliding_average, sliding_average_builtin, tumbling_sum_count
from tidemark.operators.routing import split_by_type
from tidemark.sources.fixtures import extended_measurements

from conftest import SMALL


def test_tumbling_edges(spark):
    rows = [(999, "a", 1.0), (1000, "a", 2.0), (0, "a", 4.0), (-1, "a", 8.0), (-1000, "a", 16.0),
            (-1001, "a", 32.0), (500, "b", 64.0)]
    df = spark.createDataFrame(rows, "timestamp long, location string, value double")
    got = {(r["windowStart"], r["windowEnd"], r["location"]): (r["eventsPerWindow"], r["sumPerWindow"])
           for r in tumbling_sum_count(df, 1000).collect()}
    assert got == {
        (0, 1000, "a"): (2, 5.0),
        (1000, 2000, "a"): (1, 2.0),
        (-1000, 0, "a"): (2, 24.0),
        (-2000, -1000, "a"): (1, 32.0),
        (0, 1000, "b"): (1, 64.0),
    }


def _records(spark, rows):
    return spark.createDataFrame(rows, "seq long, id long, ts long, v double, acc float, lon double").select(
        "seq",
        F.struct(F.col("id").alias("sensorId"), (F.col("id") % 100).alias("vendorId"),
                 F.lit("Temperature").alias("sensorType")).alias("sensor"),
        F.struct(F.col("lon").alias("longitude"), F.lit(50.0).alias("latitude"),
                 F.lit(1.0).alias("height")).alias("location"),
        F.struct(F.col("v").alias("value"), F.col("acc").alias("accuracy"),
                 F.col("ts").alias("timestamp")).alias("measurement"))


def _flat(df):
    return sorted((r["sensor"]["sensorId"], r["windowStart"], r["windowEnd"], r["count"],
                   round(r["measurement"]["value"], 9), r["measurement"]["accuracy"],
                   r["measurement"]["timestamp"], r["location"]["longitude"]) for r in df.collect())


def test_sliding_panes_equal_builtin(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.randint(1, 3), rnd.randint(-5_000, 40_000), rnd.uniform(-10, 35),
             rnd.randint(-50, 49) / 10.0, float(i)) for i in range(400)]
    df = _records(spark, rows)
    assert _flat(sliding_average(df, 10_000, 1_000)) == _flat(sliding_average_builtin(df, 10_000, 1_000))
    # size not a multiple of the slide falls back to the built-in window
    assert _flat(sliding_average(df, 2_500, 1_000)) == _flat(sliding_average_builtin(df, 2_500, 1_000))


def test_sliding_latest_row_ties_break_on_seq(spark):
    # equal timestamps: the later arrival (larger seq) is the latest row
    rows = [(1, 1, 500, 1.0, 0.5, 10.0), (2, 1, 500, 3.0, 1.5, 20.0), (0, 1, 100, 5.0, 1.0, 30.0)]
    out = sliding_average(_records(spark, rows), 10_000, 1_000).filter("windowStart = 0").first()
    assert out["location"]["longitude"] == 20.0
    assert out["measurement"]["timestamp"] == 500
    assert out["measurement"]["value"] == 3.0
    assert out["measurement"]["accuracy"] == 1.0
    assert out["count"] == 3


def test_sliding_window_count_on_fixture(spark):
    temps = extended_measurements(spark, SMALL).filter("sensor.sensorType = 'Temperature'")
    n_rows = temps.count()
    total = sliding_average(temps, 36_000_000, 3_600_000).agg(F.sum("count")).first()[0]
    assert total == 10 * n_rows     # every row lands in exactly size/slide windows


@pytest.mark.parametrize("size,slide", [(10_000, 3_000), (7_000, 5_000)])
def test_sliding_panes_of_the_common_divisor(spark, size, slide):
    df = extended_measurements(spark, SMALL)
    df = split_by_type(df).temperature
    a = sliding_average(df, size * 3600, slide * 3600)
    b = sliding_average_builtin(df, size * 3600, slide * 3600)
    def rows(d):
        return sorted((r["sensor"]["sensorId"], r["windowStart"], r["windowEnd"], r["count"],
                       round(r["measurement"]["value"], 9)) for r in d.collect())
    assert rows(a) == rows(b)
