"""Record-level column functions of the sensor pipeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.geo import is_in_us
from tidemark.functions.units import celsius_to_fahrenheit, kph_to_mph


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_millis(ts) -> Column:
    """Epoch milliseconds of a TIMESTAMP or TIMESTAMP_NTZ column, floored.

    NTZ values are read as UTC wall time without consulting the session time
    zone, so the result does not depend on ``spark.sql.session.timeZone``.
    """
    micros = F.timestamp_diff("MICROSECOND",
                              F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                              _c(ts).cast("timestamp_ntz"))
    return F.floor(micros / F.lit(1000)).cast("long")


def floor_to(ms, size_ms: int) -> Column:
    """Start of the epoch-aligned interval of ``size_ms`` holding ``ms``."""
    ms = _c(ms)
    return ms - F.pmod(ms, F.lit(size_ms))


def localize(df: DataFrame, convert) -> DataFrame:
    """Convert ``measurement.value`` with ``convert`` when the location is in
    the US; rows elsewhere pass unchanged. ``withField`` rebuilds the nested
    record with one field replaced, so every output is a new row."""
    in_us = is_in_us("location.longitude", "location.latitude")
    value = F.col("measurement.value")
    return df.withColumn(
        "measurement",
        F.col("measurement").withField("value", F.when(in_us, convert(value)).otherwise(value)))


def localize_temperature(df: DataFrame) -> DataFrame:
    """Celsius -> Fahrenheit inside the US box."""
    return localize(df, celsius_to_fahrenheit)


def localize_wind(df: DataFrame) -> DataFrame:
    """km/h -> mph inside the US box."""
    return localize(df, kph_to_mph)


def range_reflect(last, change, lo, hi) -> Column:
    """One bounded random-walk step: ``last + change`` when that stays inside
    ``[lo, hi]`` (inclusive), otherwise the step is reflected: ``last - change``."""
    last, change = _c(last), _c(change)
    lo = lo if isinstance(lo, Column) else F.lit(lo)
    hi = hi if isinstance(hi, Column) else F.lit(hi)
    stepped = last + change
    return F.when(stepped.between(lo, hi), stepped).otherwise(last - change)


def clock_lag(clock_ms, window_end_ms) -> Column:
    """Wall clock minus window end, in ms. The clock is a parameter (a long or
    a column); in a stream pass ``epoch_millis(current_timestamp())``, which
    Spark fixes per micro-batch."""
    clock = clock_ms if isinstance(clock_ms, Column) else F.lit(int(clock_ms))
    return clock - _c(window_end_ms)
