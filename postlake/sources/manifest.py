"""Manifest of bronze files (A1): one row per file, kept beside the data and extended batch by batch.

The manifest is a log in ``root/_manifest`` (a name that Spark's readers skip): each update adds one part with the
files it found new or changed, and those it found gone. The state of a path is its row of the highest ``listed_at``.
Footers are read once per file, on the executors, when the file enters the manifest.
"""

from __future__ import annotations

import time
import uuid
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.session import checkpoint, ensure_library

FOLDER = "_manifest"
FILE = "path string, size long, modified timestamp, signature string, row_groups int, row_count long"
LOG = FILE + ", present boolean, listed_at long"

# Bytes of files that one task reads, and rows of an Arrow batch, where executors read the files of a manifest.
TASK_BYTES = 128 << 20
BATCH_ROWS = 2_000

_BUCKET_SCHEMES = {"s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "gcs": "gs"}


def _opener():
    """``open(path)`` on pyarrow's file systems; one client per scheme and host, reused for every file of the task."""
    import pyarrow.fs as pafs

    clients = {}

    def open_file(path: str):
        # paths come as Hadoop writes them: names are not percent-encoded, a % belongs to the name
        scheme, _, rest = path.partition(":") if "://" in path or path.startswith("file:") else ("", "", path)
        host = urlsplit(path).netloc if rest.startswith("//") else ""
        inner = rest[2 + len(host):] if rest.startswith("//") else rest
        scheme = _BUCKET_SCHEMES.get(scheme, scheme)
        if scheme in ("", "file", "hdfs", "viewfs", "s3", "gs"):
            if (scheme, host) not in clients:
                uri = f"{scheme}://{host}/" if scheme not in ("", "file") else "file:///"
                clients[scheme, host] = pafs.FileSystem.from_uri(uri)[0]
            return clients[scheme, host].open_input_file(host + inner if scheme in ("s3", "gs") else inner)
        fs, inner = pafs.FileSystem.from_uri(path)  # other stores: resolve per file
        return fs.open_input_file(inner)

    return open_file


def _footers(batches):
    """``mapInPandas`` body: each file's footer schema signature, row groups and rows (one footer per file)."""
    import pyarrow.parquet as pq

    open_file = _opener()
    for pdf in batches:
        rows = []
        for path in pdf["path"]:
            with open_file(path) as fh:
                meta = pq.ParquetFile(fh).metadata
            schema = meta.schema.to_arrow_schema()
            rows.append(("|".join(f"{f.name}:{f.type}" for f in schema if not f.name.startswith("__index_level")),
                         meta.num_row_groups, meta.num_rows))
        yield pdf.assign(**dict(zip(("signature", "row_groups", "row_count"), map(list, zip(*rows)) if rows else ([], [], []))))


def _path(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path on it with scheme and host."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(hadoop)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(folder)
            .select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified")))


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """``path, size, modified, signature, row_groups, row_count`` of every Parquet file under ``root``, footers read on the executors."""
    ensure_library(spark)
    return _files(spark, root).mapInPandas(_footers, FILE)


def _log(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root.rstrip('/')}/{FOLDER}"
    fs, hadoop = _path(spark, path)
    if not fs.exists(hadoop):
        return spark.createDataFrame([], LOG + ", part string")
    return spark.read.schema(LOG + ", part string").parquet(path)


def _state(log: DataFrame) -> DataFrame:
    names = [f.name for f in T._parse_datatype_string(LOG).fields if f.name != "path"]
    return log.groupBy("path").agg(F.max_by(F.struct(*names), "listed_at").alias("last")).where("last.present").select("path", "last.*")


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """The files of ``root`` as the manifest knows them: ``path, size, modified, signature, row_groups, row_count``."""
    return _state(_log(spark, root)).drop("present", "listed_at")


def update_manifest(spark: SparkSession, root: str, folder: str | None = None, part: str | None = None) -> None:
    """Bring the manifest up to date with the files below ``root``, or only with those below ``root/folder``.

    Only files that are new, or whose size or time changed, have their footers read. Files that are gone are marked
    so. A batch writer names its own ``folder`` (nothing else is listed then) and a ``part`` of its own, which a
    replay replaces. Writers of different folders do not disturb each other.
    """
    ensure_library(spark)
    root = root.rstrip("/")
    fs, scope = _path(spark, f"{root}/{folder}" if folder else root)
    log = _log(spark, root)
    if part is not None:
        log = log.where(~F.col("part").eqNullSafe(part))
    last = log.agg(F.max("listed_at")).first()[0] or 0
    stamp = max(int(time.time() * 1e6), last + 1)
    known = _state(log)
    if folder:
        known = known.where(F.startswith("path", F.lit(scope.toString() + "/")))
    there = _files(spark, scope.toString()) if fs.exists(scope) else spark.createDataFrame([], "path string, size long, modified timestamp")
    fresh = there.join(known, ["path", "size", "modified"], "left_anti").mapInPandas(_footers, FILE).withColumn("present", F.lit(True))
    gone = known.join(there, "path", "left_anti").drop("listed_at").withColumn("present", F.lit(False))
    changes = checkpoint(fresh.unionByName(gone).withColumn("listed_at", F.lit(stamp).cast("long")))
    if part is None and changes.isEmpty():
        return
    changes.coalesce(1 + changes.rdd.getNumPartitions() // 64).write.mode("overwrite").parquet(f"{root}/{FOLDER}/part={part or uuid.uuid4().hex}")


def compact_manifest(spark: SparkSession, root: str) -> None:
    """Replace the manifest's parts by one. Parts that other writers add meanwhile stay; a stop in between leaves rows twice, which does no harm."""
    path = f"{root.rstrip('/')}/{FOLDER}"
    fs, hadoop = _path(spark, path)
    if not fs.exists(hadoop):
        return
    parts = [s.getPath() for s in fs.listStatus(hadoop) if s.getPath().getName().startswith("part=")]
    names = [p.getName().removeprefix("part=") for p in parts]
    log = checkpoint(_state(_log(spark, root).where(F.col("part").isin(names))))
    log.coalesce(1 + log.rdd.getNumPartitions() // 64).write.parquet(f"{path}/part=compact-{uuid.uuid4().hex}")
    for p in parts:
        fs.delete(p, True)


def read_listed(files: DataFrame, schema: T.StructType, path_column: str) -> DataFrame:
    """Rows of listed files of one signature, read on the executors: no path passes through the driver.

    ``files`` has ``path, size, row_groups``. Row groups are dealt to tasks of about ``TASK_BYTES``; one is read in
    batches of ``BATCH_ROWS`` rows. ``path_column`` holds each row's file. A lost task reads its row groups again.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    ensure_library(files.sparkSession)
    out = T.StructType([*schema.fields, T.StructField(path_column, T.StringType())])
    arrow, rows = to_arrow_schema(out), BATCH_ROWS

    def read(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        open_file = _opener()
        for batch in batches:
            for path, group in zip(batch.column("path").to_pylist(), batch.column("row_group").to_pylist()):
                with open_file(path) as fh:
                    file = pq.ParquetFile(fh)
                    for got in file.iter_batches(batch_size=rows, row_groups=[group], use_threads=False):
                        at = {name: i for i, name in enumerate(got.schema.names)}
                        cols = [got.column(at[f.name]).cast(f.type) if f.name in at else pa.nulls(got.num_rows, f.type) for f in list(arrow)[:-1]]
                        yield pa.RecordBatch.from_arrays([*cols, pa.array([path] * got.num_rows, pa.string())], schema=arrow)

    total = files.agg(F.sum("size")).first()[0] or 0
    tasks = max(files.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    groups = (files.where("row_groups > 0").select("path", F.explode(F.sequence(F.lit(0), F.col("row_groups") - 1)).alias("row_group"))
              .repartition(int(tasks), "path", "row_group"))
    return groups.mapInArrow(read, out)
