"""Projections and predicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def cast_columns(df: DataFrame, mapping: Mapping[str, str], safe: bool = True,
                 keep: Sequence[str] = ()) -> DataFrame:
    """Typed projection: each ``name: type`` of ``mapping`` in order, then ``keep`` as is.

    ``safe`` uses ``try_cast`` so text that does not parse (a deadline written
    in words, say) becomes null instead of failing the job.
    """
    cols = []
    for name, typ in mapping.items():
        c = F.col(name)
        cols.append((c.try_cast(typ) if safe else c.cast(typ)).alias(name))
    return df.select(*cols, *[F.col(k) for k in keep])


def star(df: DataFrame, except_: Sequence[str] = (), relation_alias: str | None = None,
         prefix: str = "", suffix: str = "") -> list[Column]:
    """Every column except ``except_`` (case-insensitive), as a list of Columns.

    With ``relation_alias`` the columns are qualified by it; they are renamed
    to ``prefix + name + suffix`` only when a prefix or suffix is given. The
    list may be empty.
    """
    skip = {e.lower() for e in except_}
    out = []
    for name in df.columns:
        if name.lower() in skip:
            continue
        c = F.col(f"{relation_alias}.`{name}`") if relation_alias else F.col(f"`{name}`")
        if prefix or suffix:
            c = c.alias(f"{prefix}{name}{suffix}")
        out.append(c)
    return out


def select_star(df: DataFrame, **kwargs) -> DataFrame:
    return df.select(*star(df, **kwargs))


def nullcheck(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Turn ``''`` into null on every string column (or on ``cols`` only)."""
    wanted = None if cols is None else {c.lower() for c in cols}
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType) and (wanted is None or f.name.lower() in wanted):
            c = F.nullif(c, F.lit("")).alias(f.name)
        out.append(c)
    return df.select(*out)


def search(df: DataFrame, col: str, pattern: str, regex: bool = True) -> DataFrame:
    """Rows whose ``col`` matches ``pattern`` ignoring case; null never matches."""
    c = F.col(col)
    hit = c.rlike("(?i)" + pattern) if regex else F.lower(c).contains(pattern.lower())
    return df.where(F.coalesce(hit, F.lit(False)))


def group_by_first_n(df: DataFrame, n: int, *aggs: Column) -> DataFrame:
    """Group by the first ``n`` columns of ``df`` and apply ``aggs``."""
    return df.groupBy(*df.columns[:n]).agg(*aggs)
