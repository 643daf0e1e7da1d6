"""Deterministic stand-ins for the two live sources, derived from the given
tables so that their size grows with them.

* :func:`kafka_records` - Kafka-shaped JSON records: eight partitions of which
  0 and 4 stay silent, event time lagging arrival by a fixed skew per
  partition, and a deterministic share of payloads cut short (corrupt).
* :func:`extended_measurements` - nested sensor records: the reporting user
  becomes the sensor, its attributes follow fixed rules.

Every input row is used; nothing is filtered away to make a test cheaper.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.records import epoch_millis
from tidemark.presets import REF
from tidemark.sources.tables import read_table

# Fixed values of the record source: partition count, silent partitions,
# one corrupt payload per this many records, bytes kept of a corrupt payload.
NUM_PARTITIONS = 8
IDLE_PARTITIONS = (0, 4)
POISON_EVERY = 97
CORRUPT_PREFIX_BYTES = 10


def active_partition(seq) -> F.Column:
    """Spread records over the active partitions 1, 2, 3, 5, 6, 7 (0 and 4
    are silent) by arrival order."""
    k = F.pmod(seq, F.lit(6))
    return (k + F.lit(1) + (k >= 3).cast("long")).cast("int")


def kafka_records(spark: SparkSession, sf_dir: str, skew_ms: int = REF.skew_ms) -> DataFrame:
    """``seq, arrival_ms, timestamp, key, value, partition`` (+ ``poison``).

    ``value`` is the JSON payload as bytes; every 97th record carries only the
    first 10 bytes of it. ``timestamp`` (event time, ms) lags the arrival time
    by ``partition * skew_ms``.
    """
    events = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    # nation is the 25-row city list: Spark's size-checked auto broadcast
    # picks a broadcast hash join for it; no hint is forced.
    rows = events.join(nation, F.pmod(events.user_id, F.lit(25)) == nation.n_nationkey)
    seq = F.col("event_id")
    arrival = epoch_millis("ts")
    partition = active_partition(seq)
    payload = F.to_json(F.struct(
        F.pmod(F.col("user_id"), F.lit(100)).cast("int").alias("sensorId"),
        F.col("value").alias("value"),
        F.col("n_name").alias("location"),
        F.concat(F.lit("m"), seq.cast("string")).alias("measurementInformation"),
    )).cast("binary")
    poison = F.pmod(seq, F.lit(POISON_EVERY)) == 0
    return rows.select(
        seq.alias("seq"),
        arrival.alias("arrival_ms"),
        (arrival - partition.cast("long") * F.lit(skew_ms)).alias("timestamp"),
        F.lit(None).cast("binary").alias("key"),
        F.when(poison, F.substring(payload, 1, CORRUPT_PREFIX_BYTES)).otherwise(payload).alias("value"),
        partition.alias("partition"),
        poison.alias("poison"),
    )


def extended_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested sensor records ``seq, sensor{..}, location{..}, measurement{..}``.

    Even users sit in the US box, odd ones in the DE box; users 0, 1 mod 4
    are temperature sensors, 2, 3 mod 4 wind sensors (type index ``(id / 2) % 2``).
    """
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value"])
    uid = F.col("user_id")
    even = F.pmod(uid, F.lit(2)) == 0
    sensor = F.struct(
        uid.alias("sensorId"),
        F.pmod(uid, F.lit(100)).alias("vendorId"),
        F.when(F.pmod(uid, F.lit(4)).isin(0, 1), "Temperature").otherwise("Wind").alias("sensorType"),
    )
    location = F.struct(
        F.when(even, F.lit(-125.0011) + F.pmod(uid, F.lit(59)))
         .otherwise(F.lit(5.8663153) + F.pmod(uid, F.lit(10)) * F.lit(0.9)).alias("longitude"),
        F.when(even, F.lit(24.9493) + F.pmod(uid, F.lit(25)))
         .otherwise(F.lit(47.2701114) + F.pmod(uid, F.lit(8))).alias("latitude"),
        F.pmod(uid * F.lit(37), F.lit(3000)).cast("double").alias("height"),
    )
    measurement = F.struct(
        F.col("value").alias("value"),
        ((F.pmod(F.col("event_id"), F.lit(100)) - F.lit(50)).cast("double") / F.lit(10.0))
        .cast("float").alias("accuracy"),
        epoch_millis("ts").alias("timestamp"),
    )
    return e.select(F.col("event_id").alias("seq"), sensor.alias("sensor"),
                    location.alias("location"), measurement.alias("measurement"))


def flatten_measurements(df: DataFrame) -> DataFrame:
    """Flat columns of a nested sensor record (for output and comparison)."""
    return df.select(
        "seq", "sensor.sensorId", "sensor.vendorId", "sensor.sensorType",
        "location.longitude", "location.latitude", "location.height",
        F.col("measurement.value").alias("value"),
        F.col("measurement.accuracy").alias("accuracy"),
        F.col("measurement.timestamp").alias("timestamp"),
    )
