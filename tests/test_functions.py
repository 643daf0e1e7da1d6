"""Scalar column functions: unit conversions, region boxes, reflect, clock."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tidemark.functions.geo import DE_BOX, US_BOX, is_in_de, is_in_us, region_of
from tidemark.functions.records import clock_lag, epoch_millis, floor_to, range_reflect
from tidemark.functions.units import (celsius_to_fahrenheit, fahrenheit_to_celsius,
                                      kph_to_mph, mph_to_kph)


def _one(spark, col, schema="x double", rows=((1.0,),)):
    return [r[0] for r in spark.createDataFrame(list(rows), schema).select(col).collect()]


def test_unit_conversions_match_scalar_formulas(spark):
    xs = [(-40.0,), (0.0,), (21.5,), (100.0,), (37.77777,)]
    df = spark.createDataFrame(xs, "x double")
    out = df.select("x", celsius_to_fahrenheit("x").alias("cf"), fahrenheit_to_celsius("x").alias("fc"),
                    kph_to_mph("x").alias("km"), mph_to_kph("x").alias("mk")).collect()
    for r in out:
        x = r["x"]
        assert r["cf"] == (x * 9.0) / 5.0 + 32
        assert r["fc"] == ((x - 32) * 5.0) / 9.0
        assert r["km"] == x / 1.60934
        assert r["mk"] == x * 1.60934
    assert celsius_to_fahrenheit  # -40 is the fixed point
    assert out[0]["cf"] == -40.0 and out[0]["fc"] == -40.0


def _corners(box):
    w, e, s, n = box
    return [(w, s), (w, n), (e, s), (e, n)]


def test_box_corners_inside_and_one_step_outside(spark):
    for box, fn in ((US_BOX, is_in_us), (DE_BOX, is_in_de)):
        w, e, s, n = box
        inside = _corners(box)
        outside = [(math.nextafter(w, -math.inf), s), (math.nextafter(e, math.inf), n),
                   (w, math.nextafter(s, -math.inf)), (e, math.nextafter(n, math.inf))]
        df = spark.createDataFrame(inside + outside, "lon double, lat double")
        got = [r[0] for r in df.select(fn("lon", "lat")).collect()]
        assert got == [True] * 4 + [False] * 4


def test_box_nan_counts_inside_null_never(spark):
    w, e, s, n = US_BOX
    rows = [(float("nan"), s), (w, float("nan")), (float("nan"), float("nan")), (None, s), (w, None)]
    df = spark.createDataFrame(rows, "lon double, lat double")
    got = [r[0] for r in df.select(is_in_us("lon", "lat")).collect()]
    assert got == [True, True, True, False, False]


def test_region_of(spark):
    df = spark.createDataFrame([(-100.0, 40.0), (10.0, 50.0), (0.0, 0.0)], "lon double, lat double")
    assert [r[0] for r in df.select(region_of("lon", "lat")).collect()] == ["US", "DE", None]


def test_range_reflect(spark):
    df = spark.createDataFrame([(10.0, 5.0), (33.0, 5.0), (35.0, 0.0), (-9.0, -1.0), (-9.0, -2.0)],
                               "last double, change double")
    got = [r[0] for r in df.select(range_reflect("last", "change", -10.0, 35.0)).collect()]
    assert got == [15.0, 28.0, 35.0, -10.0, -7.0]


def test_epoch_millis_floors_and_ignores_session_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00.9999' AS t, "
                   "TIMESTAMP_NTZ'1969-12-31 23:59:59.9995' AS n")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        r = df.select(epoch_millis("t"), epoch_millis("n")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r[0] == 1704067200999
    assert r[1] == -1


def test_floor_to_negative_and_edges(spark):
    rows = [(999,), (1000,), (0,), (-1,), (-1000,), (-1001,)]
    got = [r[0] for r in spark.createDataFrame(rows, "ms long").select(floor_to("ms", 1000)).collect()]
    assert got == [0, 1000, 0, -1000, -1000, -2000]


def test_clock_lag(spark):
    df = spark.createDataFrame([(1000,)], "e long")
    assert df.select(clock_lag(5000, "e")).first()[0] == 4000


def test_registry_positions_lie_in_their_region(spark):
    from pyspark.sql import functions as F

    from tidemark.sources.registry import registry_of
    ids = spark.range(0, 40_000, 7).select(F.col("id").alias("sensorId"))
    big = spark.createDataFrame([(9_000_000_000_123,)], "sensorId long")
    reg = registry_of(ids.unionByName(big))
    rows = reg.select("sensorId", "region", "height",
                      is_in_us("longitude", "latitude").alias("us"),
                      is_in_de("longitude", "latitude").alias("de")).collect()
    assert len(rows) == 40_000 // 7 + 2
    for r in rows:
        assert (r["us"], r["de"]) == ((True, False) if r["region"] == "US" else (False, True))
        assert 0 <= r["height"] < 3000
