"""Unions, anti joins and two-way differences."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: default name of the column that records each row's input.
SOURCE_COLUMN = "_dbt_source_relation"


def union_relations(relations: Mapping[str, DataFrame] | Sequence[tuple[str, DataFrame]],
                    column_override: Mapping[str, str] | None = None,
                    include: Sequence[str] = (), exclude: Sequence[str] = (),
                    source_column_name: str | None = SOURCE_COLUMN,
                    where: str | None = None) -> DataFrame:
    """Union all by name over the superset of columns.

    Columns are matched case-insensitively and keep the first-seen spelling,
    position and type (``column_override`` replaces a type); an input without a
    column contributes nulls. ``include`` and ``exclude`` (case-insensitive)
    cannot both be given. Each input is filtered by ``where`` before the union,
    and ``source_column_name`` (when not None) records the input's name.
    """
    if include and exclude:
        raise ValueError("Both include and exclude were provided; give one of them")
    items = list(relations.items()) if isinstance(relations, Mapping) else list(relations)
    if not items:
        raise ValueError("union_relations needs at least one relation")
    override = {k.lower(): v for k, v in (column_override or {}).items()}
    inc = {c.lower() for c in include}
    exc = {c.lower() for c in exclude}
    superset: dict[str, tuple[str, T.DataType]] = {}
    for _, df in items:
        for f in df.schema.fields:
            key = f.name.lower()
            if inc and key not in inc:
                continue
            if key in exc:
                continue
            if key not in superset:
                superset[key] = (f.name, f.dataType)
    if not superset:
        raise ValueError("union_relations: no columns left after include/exclude")
    parts = []
    for name, df in items:
        if where:
            df = df.where(where)
        present = {f.name.lower(): f.name for f in df.schema.fields}
        cols = []
        if source_column_name:
            cols.append(F.lit(name).cast("string").alias(source_column_name))
        for key, (out_name, typ) in superset.items():
            target = override.get(key, typ)
            if key in present:
                cols.append(F.col(f"`{present[key]}`").cast(target).alias(out_name))
            else:
                cols.append(F.lit(None).cast(target).alias(out_name))
        parts.append(df.select(*cols))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _like_to_regex(pattern: str) -> str:
    """SQL LIKE pattern → anchored regex (``%`` any run, ``_`` one char, ``\\`` escapes)."""
    out = []
    chars = iter(pattern)
    for ch in chars:
        if ch == "\\":
            nxt = next(chars, "")
            out.append(re.escape(nxt))
        elif ch == "%":
            out.append(".*")
        elif ch == "_":
            out.append(".")
        else:
            out.append(re.escape(ch))
    return "^" + "".join(out) + "$"


def _matches(names: Sequence[str], pattern: str, exclude: str = "") -> list[str]:
    inc = re.compile(_like_to_regex(pattern), re.IGNORECASE)
    exc = re.compile(_like_to_regex(exclude), re.IGNORECASE) if exclude else None
    return sorted(n for n in names if inc.match(n) and not (exc and exc.match(n)))


def relations_by_pattern(spark: SparkSession, table_pattern: str, exclude: str = "",
                         database: str | None = None, schema_pattern: str | None = None) -> list[str]:
    """Catalog tables/views whose name is LIKE ``table_pattern`` and not LIKE ``exclude``.

    Matching ignores case. ``schema_pattern`` looks in all schemas LIKE it and
    gives names with their schema (temporary views belong to none and are left
    out). Only catalog metadata is read; no data moves.
    """
    if schema_pattern is None:
        return _matches([t.name for t in spark.catalog.listTables(database)], table_pattern, exclude)
    out = []
    for schema in _matches([d.name for d in spark.catalog.listDatabases()], schema_pattern):
        names = [t.name for t in spark.catalog.listTables(schema) if not t.isTemporary]
        out += [f"{schema}.{n}" for n in _matches(names, table_pattern, exclude)]
    return out


def union_by_pattern(spark: SparkSession, table_pattern: str, exclude: str = "",
                     database: str | None = None, schema_pattern: str | None = None, **union_kwargs) -> DataFrame:
    names = relations_by_pattern(spark, table_pattern, exclude, database, schema_pattern)
    if not names:
        raise ValueError(f"no relation matches {table_pattern!r}")
    return union_relations([(n, spark.table(n)) for n in names], **union_kwargs)


def union_by_prefix(spark: SparkSession, prefix: str, exclude: str = "",
                    database: str | None = None, schema_pattern: str | None = None, **union_kwargs) -> DataFrame:
    """The union of the relations whose names start with ``prefix`` (taken literally)."""
    literal = prefix.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return union_by_pattern(spark, literal + "%", exclude, database, schema_pattern, **union_kwargs)


def anti_join(child: DataFrame, parent: DataFrame, child_cols: Sequence[str],
              parent_cols: Sequence[str]) -> DataFrame:
    """Child rows whose key has no match in the parent (left anti join)."""
    cond = [child[c] == parent[p] for c, p in zip(child_cols, parent_cols)]
    return child.join(parent, cond, "left_anti")


def two_way_except(a: DataFrame, b: DataFrame, label_col: str = "which_diff",
                   a_label: str = "a_minus_b", b_label: str = "b_minus_a") -> DataFrame:
    """Distinct rows of ``a`` not in ``b`` and of ``b`` not in ``a``, labelled.

    Each input is read once: both are tagged, stacked and grouped by all
    columns (nulls are equal there), which combines repeated rows before the
    one shuffle.
    """
    cols = a.columns
    both = a.withColumns({"_in_a": F.lit(True), "_in_b": F.lit(False)}).union(
        b.toDF(*cols).withColumns({"_in_a": F.lit(False), "_in_b": F.lit(True)}))
    sides = both.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.bool_or("_in_a").alias("_in_a"), F.bool_or("_in_b").alias("_in_b"))
    return sides.where(F.col("_in_a") != F.col("_in_b")).select(
        *[F.col(f"`{c}`") for c in cols], F.when(F.col("_in_a"), F.lit(a_label)).otherwise(F.lit(b_label)).alias(label_col))
