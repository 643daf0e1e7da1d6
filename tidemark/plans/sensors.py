"""Sensor pipeline (batch): nested sensor records split by type into four
outputs - localised temperature, EMA then localise, sliding average then
localise, localised wind - plus ``unrouted`` records of unknown type."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidemark.functions.records import localize_temperature, localize_wind
from tidemark.operators.ema import ema
from tidemark.operators.routing import fan_out, key_by_sensor, split_by_type
from tidemark.operators.windows import sliding_average
from tidemark.schemas import SENSOR_KEY

# Sliding window of 10 s every 1 s; HOURS is the preset scaled
# by 3,600 for the sparse fixture.
SLIDING_REF = (10_000, 1_000)
SLIDING_HOURS = (36_000_000, 3_600_000)


@dataclass
class SensorOutputs:
    temperature: DataFrame
    ema: DataFrame
    sliding: DataFrame
    wind: DataFrame
    unrouted: DataFrame


def sensor_pipeline(records: DataFrame, sliding=SLIDING_HOURS, ema_method: str = "chunked",
                    prepartition: bool = False, share_input: bool = False) -> SensorOutputs:
    """Averages run in Celsius and are converted afterwards (order matters
    for the EMA). ``share_input`` persists the input once for the four
    consumers; ``prepartition`` shuffles raw rows by sensor once up front."""
    if prepartition:
        records = key_by_sensor(records)
    if share_input:
        records = fan_out(records)
    routed = split_by_type(records)
    temps = routed.temperature
    return SensorOutputs(
        temperature=localize_temperature(temps),
        ema=localize_temperature(ema(temps, SENSOR_KEY, method=ema_method)),
        sliding=localize_temperature(sliding_average(temps, *sliding)),
        wind=localize_wind(routed.wind),
        unrouted=routed.unrouted,
    )
