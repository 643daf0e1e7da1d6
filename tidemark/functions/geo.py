"""Bounding-box region tests as column expressions.

A coordinate is inside a box when it is not outside either bound, so NaN
counts as inside on that axis (it is neither above nor below a bound). Spark
orders NaN above every number, which would flip that, hence the explicit
``isnan`` arm. NULL coordinates are never inside.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (west, east, south, north) in degrees, bounds inclusive.
US_BOX = (-125.0011, -66.9326, 24.9493, 49.5904)
DE_BOX = (5.8663153, 15.0419319, 47.2701114, 55.099161)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _axis_inside(x: Column, lo: float, hi: float) -> Column:
    return F.coalesce(F.isnan(x) | x.between(F.lit(lo), F.lit(hi)), F.lit(False))


def in_box(lon, lat, box) -> Column:
    west, east, south, north = box
    lon, lat = _c(lon), _c(lat)
    return _axis_inside(lon, west, east) & _axis_inside(lat, south, north)


def is_in_us(lon, lat) -> Column:
    return in_box(lon, lat, US_BOX)


def is_in_de(lon, lat) -> Column:
    return in_box(lon, lat, DE_BOX)


def region_of(lon, lat) -> Column:
    """'US', 'DE' or NULL."""
    return F.when(is_in_us(lon, lat), "US").when(is_in_de(lon, lat), "DE")
