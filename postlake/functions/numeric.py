"""Math expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlake.functions._util import as_col

# Earth radius in miles and the mile→kilometre factor of the
# distance helper.
EARTH_RADIUS_MI = 3961
KM_PER_MI = 1.60934


def safe_add(cols: Sequence) -> Column:
    """Sum of the columns with null read as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(as_col(c), F.lit(0)) for c in cols])


def safe_subtract(cols: Sequence) -> Column:
    """First column minus the others, null read as 0."""
    parts = [F.coalesce(as_col(c), F.lit(0)) for c in cols]
    return reduce(lambda a, b: a - b, parts)


def safe_divide(numerator, denominator) -> Column:
    """``numerator / nullif(denominator, 0)``: null instead of a division error."""
    return as_col(numerator) / F.nullif(as_col(denominator), F.lit(0))


def width_bucket(value, lo, hi, n) -> Column:
    """Equi-width bucket 1..n of ``value`` in [lo, hi); below → 0, at/above hi → n+1."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.width_bucket(as_col(value), lit(lo), lit(hi), lit(n))


def degrees_to_radians(c) -> Column:
    return F.acos(F.lit(-1)) * as_col(c) / 180


def haversine(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    """Great-circle distance with a 3961-mile radius; ``unit`` is ``mi`` or ``km``."""
    if unit == "mi":
        rate = 1
    elif unit == "km":
        rate = KM_PER_MI
    else:
        raise ValueError(f"unit must be one of 'mi' or 'km', got {unit!r}")
    la1, lo1, la2, lo2 = (as_col(c) for c in (lat1, lon1, lat2, lon2))
    a = (F.pow(F.sin(F.radians((la2 - la1) / 2)), 2)
         + F.cos(F.radians(la1)) * F.cos(F.radians(la2)) * F.pow(F.sin(F.radians((lo2 - lo1) / 2)), 2))
    return 2 * EARTH_RADIUS_MI * F.asin(F.sqrt(a)) * F.lit(rate)
