"""Registered queries (Spark) and their DuckDB oracles.

Every query reads the given tables through the fixture views and runs over
all of their rows. Output columns are plain (no timestamps, no floats) and
doubles are rounded on both sides, since sums depend on addition order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.geo import is_in_de, is_in_us
from tidemark.functions.records import localize_temperature, localize_wind, range_reflect
from tidemark.functions.units import (celsius_to_fahrenheit, fahrenheit_to_celsius,
                                      kph_to_mph, mph_to_kph)
from tidemark.operators.decode import FULL_FIELDS, dynamic_decode, invalid_count, tolerant_decode, variant_double
from tidemark.operators.ema import ema
from tidemark.operators.routing import route_counts, split_by_type
from tidemark.operators.stats import interval_stats, lag_histogram, lifetime_extremes
from tidemark.operators.watermark import partition_activity, watermark_trace
from tidemark.operators.windows import sliding_average, tumbling_sum_count
from tidemark.plans.location import location_pipeline
from tidemark.plans.sensors import SLIDING_HOURS, SLIDING_REF
from tidemark.schemas import SENSOR_KEY
from tidemark.presets import DAY, REF
from tidemark.sources.fixtures import NUM_PARTITIONS, extended_measurements, flatten_measurements, kafka_records
from tidemark.sources.registry import SENSORS_PER_INSTANCE, registry_of
from tidemark.sources.tables import read_table

# Fixed parameters of the registered queries.
STATS_INTERVAL_MS = 86_400_000           # one gauge interval per day
LAG_CLOCK_MS = 1_706_745_600_000         # 2024-02-01T00:00:00Z, after all input
REFLECT_BOUNDS = {"Temperature": (-10.0, 35.0), "Wind": (0.0, 335.0)}
SILENT_FROM_MS = 1_705_363_200_000       # 2024-01-16T00:00:00Z: partition 7 sends nothing from here on

R = 6    # digits kept of doubles
R2 = 3   # digits kept of second moments (large magnitudes)
R_MS = 3  # digits kept of statistics over millisecond lags (~1e9)


def _r(c, digits: int = R):
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), digits)


def _flat_rounded(df: DataFrame) -> DataFrame:
    return (flatten_measurements(df)
            .withColumn("value", _r("value")).withColumn("accuracy", _r("accuracy")))


# ---------------------------------------------------------------- decode
def q_decode_valid(spark, sf):
    return tolerant_decode(kafka_records(spark, sf, REF.skew_ms)).valid


def q_decode_invalid_count(spark, sf):
    return invalid_count(kafka_records(spark, sf, REF.skew_ms))


def q_decode_quarantine(spark, sf):
    bad = tolerant_decode(kafka_records(spark, sf, REF.skew_ms)).invalid
    return bad.select("seq", "timestamp", "partition", F.length("value").alias("payloadBytes"))


def q_decode_full(spark, sf):
    return tolerant_decode(kafka_records(spark, sf, REF.skew_ms), fields=FULL_FIELDS).valid


def q_decode_props(spark, sf):
    """The JSON column of the events table itself."""
    events = read_table(spark, sf, "events", ["event_id", "props"])
    d = dynamic_decode(events, payload_col="props", keep=("event_id",))
    return d.select("event_id", F.try_variant_get("payload", "$.k", "int").alias("k"))


def q_dynamic_decode(spark, sf):
    d = dynamic_decode(kafka_records(spark, sf, REF.skew_ms))
    return d.select("seq", "timestamp",
                    F.try_variant_get("payload", "$.sensorId", "int").alias("sensorId"),
                    variant_double("payload", "$.value").alias("value"),
                    F.try_variant_get("payload", "$.location", "string").alias("location"))


# ---------------------------------------------------------------- windows
def _tumbling(spark, sf, preset):
    valid = tolerant_decode(kafka_records(spark, sf, preset.skew_ms)).valid
    return tumbling_sum_count(valid, preset.window_ms).withColumn("sumPerWindow", _r("sumPerWindow"))


def q_tumbling_1s(spark, sf):
    return _tumbling(spark, sf, REF)


def q_tumbling_1d(spark, sf):
    return _tumbling(spark, sf, DAY)


# ---------------------------------------------------------------- functions
def q_unit_conversions(spark, sf):
    e = read_table(spark, sf, "events", ["event_id", "value"])
    v = F.col("value")
    return e.select("event_id", _r(v).alias("value"),
                    _r(celsius_to_fahrenheit(v)).alias("c_to_f"),
                    _r(fahrenheit_to_celsius(v)).alias("f_to_c"),
                    _r(kph_to_mph(v)).alias("kph_to_mph"),
                    _r(mph_to_kph(v)).alias("mph_to_kph"))


def q_geo_us_de(spark, sf):
    em = extended_measurements(spark, sf)
    lon, lat = F.col("location.longitude"), F.col("location.latitude")
    return em.select("seq", lon.alias("longitude"), lat.alias("latitude"),
                     is_in_us(lon, lat).alias("in_us"), is_in_de(lon, lat).alias("in_de"))


def q_reflect_step(spark, sf):
    em = extended_measurements(spark, sf)
    t = F.col("sensor.sensorType")
    lo = F.when(t == "Temperature", REFLECT_BOUNDS["Temperature"][0]).otherwise(REFLECT_BOUNDS["Wind"][0])
    hi = F.when(t == "Temperature", REFLECT_BOUNDS["Temperature"][1]).otherwise(REFLECT_BOUNDS["Wind"][1])
    step = F.col("measurement.accuracy").cast("double")
    return em.select("seq", t.alias("sensorType"),
                     _r(range_reflect(F.col("measurement.value"), step, lo, hi)).alias("nextValue"))


# ---------------------------------------------------------------- routing
def q_split_counts(spark, sf):
    return route_counts(extended_measurements(spark, sf))


def q_localized_temperature(spark, sf):
    return _flat_rounded(localize_temperature(split_by_type(extended_measurements(spark, sf)).temperature))


def q_localized_wind(spark, sf):
    return _flat_rounded(localize_wind(split_by_type(extended_measurements(spark, sf)).wind))


# ---------------------------------------------------------------- sliding / EMA
def _sliding_flat(out: DataFrame) -> DataFrame:
    return out.select(
        "sensor.sensorId", "sensor.vendorId", "sensor.sensorType", "windowStart", "windowEnd",
        "location.longitude", "location.latitude", "location.height",
        _r("measurement.value").alias("value"), _r("measurement.accuracy").alias("accuracy"),
        F.col("measurement.timestamp").alias("timestamp"), "count")


def q_sliding_hours(spark, sf):
    temps = split_by_type(extended_measurements(spark, sf)).temperature
    return _sliding_flat(localize_temperature(sliding_average(temps, *SLIDING_HOURS)))


def q_sliding_seconds(spark, sf):
    temps = split_by_type(extended_measurements(spark, sf)).temperature
    return _sliding_flat(localize_temperature(sliding_average(temps, *SLIDING_REF)))


def q_ema_temperature(spark, sf):
    temps = split_by_type(extended_measurements(spark, sf)).temperature
    return _flat_rounded(localize_temperature(ema(temps, SENSOR_KEY)))


# ---------------------------------------------------------------- watermarks
def _trace(spark, sf, scope):
    rec = kafka_records(spark, sf, DAY.skew_ms)
    return watermark_trace(rec, DAY.out_of_orderness_ms, DAY.window_ms, scope=scope)


def q_watermark_trace(spark, sf):
    return _trace(spark, sf, "global").select("seq", "partition", "timestamp", "watermark",
                                              "windowEnd", "late")


def q_watermark_trace_min_partition(spark, sf):
    return _trace(spark, sf, "partition").select("seq", "partition", "timestamp", "watermark",
                                                 "windowEnd", "late")


def q_watermark_trace_idle(spark, sf):
    """Partition 7 falls silent midway (6 takes its records over)."""
    gone = (F.col("partition") == 7) & (F.col("arrival_ms") >= SILENT_FROM_MS)
    rec = (kafka_records(spark, sf, DAY.skew_ms)
           .withColumn("partition", F.when(gone, F.lit(6)).otherwise(F.col("partition"))))
    out = watermark_trace(rec, DAY.out_of_orderness_ms, DAY.window_ms, scope="partition",
                          idle_timeout_ms=DAY.idle_timeout_ms)
    return out.select("seq", "partition", "timestamp", "watermark", "windowEnd", "late")


def q_late_rows(spark, sf):
    out = location_pipeline(kafka_records(spark, sf, DAY.skew_ms), DAY)
    return out.late.select("seq", "partition", "timestamp", "watermark")


def q_on_time_windows(spark, sf):
    out = location_pipeline(kafka_records(spark, sf, DAY.skew_ms), DAY)
    return out.main.withColumn("sumPerWindow", _r("sumPerWindow"))


def q_idle_partitions(spark, sf):
    return partition_activity(kafka_records(spark, sf, DAY.skew_ms), NUM_PARTITIONS,
                              DAY.idle_timeout_ms)


# ---------------------------------------------------------------- stats
def _us_temperature_stats(spark, sf):
    temps = split_by_type(extended_measurements(spark, sf)).temperature
    us = temps.filter(is_in_us("location.longitude", "location.latitude"))
    v = F.col("measurement.value")
    return interval_stats(us, STATS_INTERVAL_MS, "measurement.timestamp",
                          {"source": v, "normalized": celsius_to_fahrenheit(v)})


def q_interval_stats_us(spark, sf):
    s = _us_temperature_stats(spark, sf)
    return s.select("intervalStart", "n", *[
        _r(c, R2 if c.endswith("M2") else R).alias(c) for c in s.columns if c not in ("intervalStart", "n")])


def q_lifetime_minmax_us(spark, sf):
    s = lifetime_extremes(_us_temperature_stats(spark, sf), ["source", "normalized"])
    return s.select("intervalStart", _r("normalizedMean").alias("normalizedMean"),
                    *[_r(c).alias(c) for c in ("sourceLifetimeMin", "sourceLifetimeMax",
                                                "normalizedLifetimeMin", "normalizedLifetimeMax")])


def q_lag_quantiles(spark, sf):
    main = location_pipeline(kafka_records(spark, sf, REF.skew_ms), REF).main
    h = lag_histogram(main, LAG_CLOCK_MS)
    return h.select("n", "min", "max",
                    *[_r(c, R_MS).alias(c) for c in h.columns if c not in ("n", "min", "max")])


# ---------------------------------------------------------------- registry
def q_sensor_registry(spark, sf):
    reg = registry_of(read_table(spark, sf, "events", ["user_id"]), "user_id", SENSORS_PER_INSTANCE)
    return reg.withColumn("longitude", _r("longitude")).withColumn("latitude", _r("latitude"))


QUERIES = {
    "decode_valid": q_decode_valid,
    "decode_invalid_count": q_decode_invalid_count,
    "decode_quarantine": q_decode_quarantine,
    "decode_full": q_decode_full,
    "decode_props": q_decode_props,
    "dynamic_decode": q_dynamic_decode,
    "tumbling_sum_count_1s": q_tumbling_1s,
    "tumbling_sum_count_1d": q_tumbling_1d,
    "unit_conversions": q_unit_conversions,
    "geo_us_de": q_geo_us_de,
    "reflect_step": q_reflect_step,
    "split_counts": q_split_counts,
    "localized_temperature": q_localized_temperature,
    "localized_wind": q_localized_wind,
    "sliding_avg_temperature": q_sliding_hours,
    "sliding_avg_temperature_10s": q_sliding_seconds,
    "ema_temperature": q_ema_temperature,
    "watermark_trace": q_watermark_trace,
    "watermark_trace_min_partition": q_watermark_trace_min_partition,
    "watermark_trace_idle": q_watermark_trace_idle,
    "late_rows": q_late_rows,
    "on_time_windows": q_on_time_windows,
    "idle_partitions": q_idle_partitions,
    "interval_stats_us": q_interval_stats_us,
    "lifetime_minmax_us": q_lifetime_minmax_us,
    "lag_quantiles": q_lag_quantiles,
    "sensor_registry": q_sensor_registry,
}
