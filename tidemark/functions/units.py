"""Unit conversions as column expressions (JVM-side, codegen friendly).

The operation order of each formula is kept, so results are bit-equal to the
scalar formulas they replace.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: kilometres per mile.
KM_PER_MILE = 1.60934


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def fahrenheit_to_celsius(x) -> Column:
    return ((_c(x) - F.lit(32.0)) * F.lit(5.0)) / F.lit(9.0)


def celsius_to_fahrenheit(x) -> Column:
    return (_c(x) * F.lit(9.0)) / F.lit(5.0) + F.lit(32.0)


def mph_to_kph(x) -> Column:
    return _c(x) * F.lit(KM_PER_MILE)


def kph_to_mph(x) -> Column:
    return _c(x) / F.lit(KM_PER_MILE)
