"""Small helpers shared by the expression builders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def contains_any(s: Column, words) -> Column:
    """True when ``s`` contains any of ``words`` (plain substring tests)."""
    return reduce(lambda a, b: a | b, [s.contains(w) for w in words])


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and pass it to ``body`` (a Column → Column function).

    Branches of ``CASE WHEN`` defeat common-subexpression elimination, so an
    expensive input (a regex match list, a lower-cased text) used in several
    branches would be recomputed for each; binding it as a lambda variable
    computes it once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
