"""Session helpers: one place for the settings every job in the library relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Settings the library's jobs assume. UTC keeps batch paths and timestamp casts
# independent of the machine's zone; AQE re-plans joins and coalesces shuffle
# partitions at run time and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # remove checkpoint files once their RDDs are no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # let the JIT compile large generated methods (wide parse + aggregate stages)
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def build_session(master: str = "local[*]", app: str = "postlake",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ensure_library(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that one is
    used as is. Only a local-mode session (tests, a laptop) without the setting
    gets a fresh folder of its own; a cluster session without it is an error,
    because a machine-local folder does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) so checkpointed stages survive executor loss")
    path = tempfile.mkdtemp(prefix="postlake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def ensure_library(spark: SparkSession) -> None:
    """Make ``postlake`` importable in the Python workers (once per SparkContext).

    The operators that run Python in tasks (ordered scan, footer reader, page
    cutter) refer to functions of this package; the package is zipped and
    added with ``addPyFile``, which ships it to every executor.
    """
    sc = spark.sparkContext
    if getattr(sc, "_postlake_shipped", False):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="postlake-pyfiles-"), "postlake.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    sc._postlake_shipped = True


def checkpoint(df):
    """Materialise ``df`` in the session's checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)



def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the session's checkpoint folder; it is deleted when the driver's JVM ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def stored(df, name: str):
    """``df`` written as Parquet in the session's checkpoint folder and read back: cuts the lineage, keeps column pruning."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Arrow batches of whole texts: rows and bytes that a Python worker and the JVM hold at a time for each task.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def short_batches(spark: SparkSession) -> None:
    """Lower the session's limits of an Arrow batch to BATCH_ROWS and BATCH_BYTES."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        now = int(spark.conf.get(key).rstrip("b"))
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))


#: Text that one task of :func:`spread` is dealt, on average.
TASK_BYTES = 8 << 20


def spread(df, text: str):
    """``df`` dealt over tasks of TASK_BYTES of the column ``text``, at least one a core, for work on its rows that is far dearer than moving them.

    The bytes are counted first: neither the files' size (a small table can make long texts, a file can be one
    unsplittable row group) nor the partitions of a shuffle before tell how much text a task gets.
    """
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES)))
