"""Record schemas of the two measurement pipelines."""

from __future__ import annotations

from pyspark.sql import types as T

# Kafka-shaped record. ``timestamp`` is event time in epoch milliseconds, as in
# the record the pipelines consume; the Kafka connector's own ``timestamp`` is a
# TIMESTAMP and is converted by :func:`tidemark.sources.kafka.from_kafka_frame`.
KAFKA_RECORD = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("partition", T.IntegerType()),
])

# JSON payload of a record (full and pruned form).
MEASUREMENT = T.StructType([
    T.StructField("sensorId", T.IntegerType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("location", T.StringType()),
    T.StructField("measurementInformation", T.StringType()),
])
SIMPLE_MEASUREMENT = T.StructType(MEASUREMENT.fields[:3])

# Output of the per-location tumbling window.
WINDOWED_MEASUREMENTS = T.StructType([
    T.StructField("windowStart", T.LongType()),
    T.StructField("windowEnd", T.LongType()),
    T.StructField("location", T.StringType()),
    T.StructField("eventsPerWindow", T.LongType()),
    T.StructField("sumPerWindow", T.DoubleType()),
])

# The two sensor types, in ordinal order.
SENSOR_TYPES = ("Temperature", "Wind")

SENSOR = T.StructType([
    T.StructField("sensorId", T.LongType()),
    T.StructField("vendorId", T.LongType()),
    T.StructField("sensorType", T.StringType()),
])
LOCATION = T.StructType([
    T.StructField("longitude", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("height", T.DoubleType()),
])
MEASUREMENT_VALUE = T.StructType([
    T.StructField("value", T.DoubleType()),
    T.StructField("accuracy", T.FloatType()),
    T.StructField("timestamp", T.LongType()),
])
# Nested sensor record; ``seq`` (arrival order) is carried beside it so that
# "latest row" has a deterministic tie-break.
EXTENDED_MEASUREMENT = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("sensor", SENSOR),
    T.StructField("location", LOCATION),
    T.StructField("measurement", MEASUREMENT_VALUE),
])

SENSOR_KEY = ("sensor.sensorId", "sensor.vendorId", "sensor.sensorType")
