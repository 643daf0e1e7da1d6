"""Sensor registry: the fixed attributes each sensor id implies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.geo import DE_BOX, US_BOX
from tidemark.schemas import SENSOR_TYPES

# Fixed value: sensors owned by one source instance.
SENSORS_PER_INSTANCE = 10_000
# Spread of positions: Knuth's multiplicative hash constants (any odd numbers
# would do); heights lie in [0, MAX_HEIGHT).
HASH_A, HASH_B, HASH_SPACE = 2654435761, 40503, 1 << 32
MAX_HEIGHT = 3000


def _unit(sensor_id, factor: int):
    """Deterministic value in [0, 1) per sensor (multiplicative hashing). The
    id is reduced below 2^31 first, so the product fits in a long."""
    reduced = F.pmod(sensor_id, F.lit(1 << 31))
    return F.pmod(reduced * F.lit(factor), F.lit(HASH_SPACE)).cast("double") / F.lit(float(HASH_SPACE))


def registry_of(sensor_ids: DataFrame, id_col: str = "sensorId",
                per_instance: int = SENSORS_PER_INSTANCE) -> DataFrame:
    """Attributes of every distinct sensor id in ``sensor_ids``.

    ``sensorId = instance * per_instance + localIndex``; ``vendorId = id % 100``;
    type ``SENSOR_TYPES[(localIndex / 2) % 2]``; the first half of an
    instance's sensors are placed in the US, the rest in DE, each at a fixed
    position inside its region box, with a height in [0, 3000).
    """
    local = F.pmod(F.col("sensorId"), F.lit(per_instance))
    type_index = F.pmod(F.floor(local / F.lit(2)), F.lit(2))
    return (sensor_ids.select(F.col(id_col).cast("long").alias("sensorId")).distinct()
            .select(
                "sensorId",
                F.floor(F.col("sensorId") / F.lit(per_instance)).cast("long").alias("instance"),
                local.alias("localIndex"),
                F.pmod(F.col("sensorId"), F.lit(100)).alias("vendorId"),
                F.when(type_index == 0, SENSOR_TYPES[0]).otherwise(SENSOR_TYPES[1]).alias("sensorType"),
                F.when(local < F.lit(per_instance // 2), "US").otherwise("DE").alias("region"),
            )
            .transform(_with_position))


def _with_position(df: DataFrame) -> DataFrame:
    """Fixed position inside the sensor's region box and a height."""
    sid, us = F.col("sensorId"), F.col("region") == "US"

    def inside(lo_us, hi_us, lo_de, hi_de, factor):
        u = _unit(sid, factor)
        return F.when(us, F.lit(lo_us) + u * F.lit(hi_us - lo_us)).otherwise(F.lit(lo_de) + u * F.lit(hi_de - lo_de))

    return df.select(
        "*",
        inside(US_BOX[0], US_BOX[1], DE_BOX[0], DE_BOX[1], HASH_A).alias("longitude"),
        inside(US_BOX[2], US_BOX[3], DE_BOX[2], DE_BOX[3], HASH_B).alias("latitude"),
        F.pmod(F.pmod(sid, F.lit(1 << 31)) * F.lit(HASH_B), F.lit(MAX_HEIGHT)).cast("double").alias("height"))
