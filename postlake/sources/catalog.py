"""Relations, ad-hoc SQL and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def materialize(df: DataFrame, name: str, kind: str = "view", path: str | None = None) -> DataFrame:
    """Register ``df`` as ``name``: a temp view (``view``) or a written table (``table``).

    A table is written as Parquet to ``path`` (a shared folder) and the view is
    pointed at the written files, which also cuts the lineage. Without a path
    it is a managed table: ``saveAsTable`` writes where the session's catalog
    keeps tables (``spark.sql.warehouse.dir``, shared on a cluster).
    """
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind != "table":
        raise ValueError(f"kind must be 'view' or 'table', got {kind!r}")
    if path:
        df.write.mode("overwrite").parquet(path)
        spark.read.parquet(path).createOrReplaceTempView(name)
        return spark.table(name)
    df.write.mode("overwrite").saveAsTable(name)
    return spark.table(name)


def run_sql(spark: SparkSession, text: str, max_rows: int | None = None) -> DataFrame:
    """Run SQL over the registered relations; ``max_rows`` caps the result (a display cap)."""
    out = spark.sql(text)
    return out.limit(max_rows) if max_rows is not None else out


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ``df`` as CSV with a header row (one file per task, no index column).

    Lists, structs and maps, which CSV does not have, are written as JSON
    text; binary columns as base64. A quote inside a value is doubled.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            c = F.to_json(c)
        elif isinstance(f.dataType, T.BinaryType):
            c = F.base64(c)
        cols.append(c.alias(f.name))
    df.select(*cols).write.mode(mode).option("header", True).option("escape", '"').csv(path)
