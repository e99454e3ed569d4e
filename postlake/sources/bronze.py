"""Bronze Parquet: schema-tolerant scan (A1) and partitioned batch writes (A2).

Bronze files are written one batch at a time, each with the types pandas
happened to infer for that batch: an int column is int64 in one file and
double in the next, an all-null column has the null type. A single
``spark.read.parquet(root)`` (even with ``mergeSchema``) refuses such a set, so
the scan groups files by footer signature and reads each group with its own
schema, then aligns the groups by name.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.session import checkpoint
from postlake.sources.contract import Contract, contract_types
from postlake.sources.manifest import list_files, read_listed, read_manifest

# Column of a micro-batch that holds its logged time.
BATCH_TIME = "_batch_time"
BATCH_PARTITIONS = ["batch_date", "batch_hour", "batch_minute", "batch_second"]


# Folders and files up to which a scan of mixed signatures hands their paths to Spark's reader; beyond, executors read them.
MAX_PATHS = 10_000


def list_signatures(spark: SparkSession, root: str) -> DataFrame:
    """``(path, signature)`` for every Parquet file under ``root`` (listing and footers on executors)."""
    return list_files(spark, root).select("path", "signature")


def _paths_by_signature(sigs: DataFrame, max_paths: int) -> dict[str, list[str]] | None:
    """Signature → folders that hold only its files, and its files in other folders; None if these are over ``max_paths``."""
    folder = sigs.withColumn("folder", F.regexp_replace("path", "/[^/]*$", ""))
    per = folder.groupBy("folder").agg(F.min("signature").alias("signature"),
                                       (F.min("signature") != F.max("signature")).alias("mixed")).limit(max_paths + 1).collect()
    if len(per) > max_paths:
        return None
    names = sorted(r["folder"] + "/" for r in per)
    nested = {n for n, after in zip(names, names[1:]) if after.startswith(n)}
    single = {r["folder"] for r in per if r["mixed"] or r["folder"] + "/" in nested}
    by_sig: dict[str, list[str]] = {}
    for r in per:
        if r["folder"] not in single:
            by_sig.setdefault(r["signature"], []).append(r["folder"])
    if single:
        wanted = sigs.sparkSession.createDataFrame([(x,) for x in sorted(single)], "folder string")
        files = folder.join(wanted, "folder", "left_semi").limit(max_paths + 1).collect()
        if len(files) > max_paths:
            return None
        for r in files:
            by_sig.setdefault(r["signature"], []).append(r["path"])
    return by_sig


def scan_bronze(spark: SparkSession, root: str, contract: Contract | None = None,
                with_batch_columns: bool = False, manifest: bool = False, max_paths: int = MAX_PATHS) -> DataFrame:
    """Read every Parquet file under ``root``, matching columns by name.

    Files are grouped by footer signature; with one signature the folder is
    read as is, otherwise each group is read with its own schema (Parquet
    pushdown and pruning stay intact), and the groups are unioned by name
    (missing columns → null). A contract gives its fields their types; nulls
    stay null, absent fields are null and columns outside the contract are
    kept. Without one, Spark widens numeric types. Footers are read once. In
    the mixed case the driver gets a folder for all files of one signature in
    it, and single files only from folders that mix signatures. If that makes
    over ``max_paths`` paths, none of them goes to the driver: the executors
    read the listed files themselves (whole columns, no pushdown).

    ``manifest``: the files and signatures come from the manifest of ``root``,
    without listing it or reading footers; it must be up to date
    (``update_manifest``).

    ``with_batch_columns`` adds the ``batch_*`` / ``run_id`` values of the path
    as strings, written as in the path (``05`` stays ``05``); they replace data
    columns of those names. Without it such data columns are kept.
    """
    sigs = checkpoint(read_manifest(spark, root) if manifest else list_files(spark, root))
    samples = sigs.groupBy("signature").agg(F.min("path").alias("path")).orderBy("signature").collect()
    if not samples:
        raise FileNotFoundError(f"no Parquet files under {root}")
    reader = spark.read.option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    path, extra = F.col("_metadata.file_path"), []
    if len(samples) == 1:
        # one physical schema: read the folder itself, no file list on the driver
        frames = [reader.parquet(root)]
    elif (by_sig := _paths_by_signature(sigs, max_paths)) is not None:
        frames = [reader.parquet(*sorted(by_sig[k])) for k in sorted(by_sig)]
    else:
        schemas = [reader.parquet(r["path"]).schema for r in samples]
        name = "_path"
        while any(name in s.names for s in schemas):
            name += "_"
        path, extra = F.col(name), [name]
        frames = [read_listed(sigs.where(F.col("signature") == r["signature"]), s, name) for r, s in zip(samples, schemas)]
    if with_batch_columns:
        seen = sigs.agg(*[F.max(F.col("path").contains(f"/{c}=")).alias(c) for c in (*BATCH_PARTITIONS, "run_id")]).first()
        of_path = [c for c in (*BATCH_PARTITIONS, "run_id") if seen[c]]
        frames = [df.select(*[F.col(f"`{c}`") for c in df.columns if c not in of_path],
                            *[F.nullif(F.regexp_extract(path, f"/{c}=([^/]*)/", 1), F.lit("")).alias(c)
                              for c in of_path]) for df in frames]
    frames = [df.drop(*extra) for df in frames]
    parts = [contract_types(df, contract) if contract is not None else df for df in frames]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def path_values(ts: Column, partition_cols: Sequence[str]) -> list[Column]:
    """Partition values of a timestamp column (UTC)."""
    forms = {"batch_date": "yyyy-MM-dd", "batch_hour": "HH", "batch_minute": "mm", "batch_second": "ss"}
    return [F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), forms[c]).alias(c) for c in partition_cols]


def batch_columns(ts: dt.datetime) -> dict[str, str]:
    """Partition values of a batch timestamp (UTC)."""
    return {"batch_date": ts.strftime("%Y-%m-%d"), "batch_hour": ts.strftime("%H"),
            "batch_minute": ts.strftime("%M"), "batch_second": ts.strftime("%S")}


def write_bronze(df: DataFrame, root: str, run_id: str, batch_ts: dt.datetime | Column | None = None,
                 partition_cols: Sequence[str] = ("batch_date", "batch_hour")) -> None:
    """Write one batch under ``root/batch_date=.../batch_hour=.../run_id=<run_id>/``.

    Each run id gets its own directory and the write replaces only that
    directory (dynamic partition overwrite), so replaying a batch with the same
    run id and time rewrites it instead of duplicating it. A run id names one
    batch of one writer: a second batch under it and the same time replaces the
    first. ``batch_ts`` may be a timestamp column of ``df``; it is not written.
    Date and hour are the default partitions; minute and second are available
    but make many small directories at scale.
    """
    if isinstance(batch_ts, Column):
        cols = path_values(batch_ts, partition_cols)
    else:
        vals = batch_columns(batch_ts or dt.datetime.now(dt.timezone.utc))
        cols = [F.lit(vals[c]).alias(c) for c in partition_cols]
    kept = [F.col(f"`{c}`") for c in df.columns if c != BATCH_TIME]
    out = df.select(*kept, *cols, F.lit(run_id).alias("run_id"))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols, "run_id").parquet(root))
