"""Routing of sensor records by type, and keyed fan-out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import SENSOR_KEY, SENSOR_TYPES

ROUTES = {"Temperature": "temperature", "Wind": "wind"}
UNROUTED = "unrouted"


def route_of(sensor_type_col: str = "sensor.sensorType") -> F.Column:
    """Output name per record: one per known sensor type, ``unrouted`` for an
    unknown or NULL type (kept instead of failing the job)."""
    expr = F.lit(UNROUTED)
    for sensor_type in reversed(SENSOR_TYPES):
        expr = F.when(F.col(sensor_type_col) == sensor_type, ROUTES[sensor_type]).otherwise(expr)
    return expr


@dataclass
class Routed:
    temperature: DataFrame
    wind: DataFrame
    unrouted: DataFrame


def split_by_type(df: DataFrame, sensor_type_col: str = "sensor.sensorType") -> Routed:
    """One filter per output over the same input: each output is a plain
    filter, so every consumer's plan keeps its pushdown."""
    t = F.col(sensor_type_col)
    return Routed(
        temperature=df.filter(t == SENSOR_TYPES[0]),
        wind=df.filter(t == SENSOR_TYPES[1]),
        unrouted=df.filter(t.isNull() | ~t.isin(*SENSOR_TYPES)),
    )


def route_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(route_of().alias("route")).agg(F.count(F.lit(1)).alias("n"))


def key_by_sensor(df: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Hash-partition by the sensor key once, so keyed consumers that group by
    a superset of it (tumbling windows per sensor, EMA per sensor) need no
    further exchange. Off by default in the pipelines: with one hot sensor a
    raw-row shuffle by sensor puts that sensor in one task, while the
    aggregations combine map-side and shuffle far less."""
    cols = [F.col(c) for c in SENSOR_KEY]
    return df.repartition(num_partitions, *cols) if num_partitions else df.repartition(*cols)


def fan_out(df: DataFrame) -> DataFrame:
    """Share one computed input between several outputs of a batch job.

    ``MEMORY_AND_DISK`` keeps it spillable; a lost executor recomputes lost
    blocks from lineage.
    """
    return df.persist(StorageLevel.MEMORY_AND_DISK)
