"""Counts of a streaming query's micro-batches (H1, H3, H5).

The counts are observed while a batch is written, in the same pass, and kept
as one small row for each query and batch in a folder of its own. A replayed
batch rewrites its row, so the sums over the folder are those of the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Local property in which Spark keeps a streaming query's id while it runs a batch.
QUERY_ID = "sql.streaming.queryId"


def query_id(batch: DataFrame) -> str:
    """The id of the query that runs this batch; it stays over restarts from one checkpoint."""
    query = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
    if not query:
        raise RuntimeError("no streaming query id: this runs as a foreachBatch function")
    return query


def write_counts(spark: SparkSession, folder: str, query: str, batch_id: int, numbers: dict[str, int]) -> None:
    """Keep a batch's counts: one row of name and number each, in the batch's own folder."""
    rows = [(name, int(n or 0)) for name, n in sorted(numbers.items())]
    df = spark.createDataFrame(rows, "name string, n long").withColumn("query", F.lit(query)).withColumn("batch", F.lit(batch_id).cast("long"))
    (df.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("query", "batch").parquet(folder))


def read_counts(spark: SparkSession, folder: str) -> DataFrame:
    """``query, batch, name, n`` of all batches counted below ``folder``."""
    return spark.read.schema("name string, n long, query string, batch long").parquet(folder).select("query", "batch", "name", "n")
