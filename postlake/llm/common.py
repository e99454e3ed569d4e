"""Helpers shared by the training-data operators: tables in the shared folder,
distributed running sums, joins that split hot keys, and files of raw bytes."""

from __future__ import annotations

import ctypes
import functools
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import BATCH_BYTES, BATCH_ROWS, ensure_checkpoint_dir, ensure_library, short_batches

#: A key is hot when it holds over 1/HOT_SHARE of all rows, so there are fewer than HOT_SHARE hot keys.
HOT_SHARE = 10_000


def prepare(spark: SparkSession) -> None:
    """Make the shared folder and the library's code available to the session, and its Arrow batches small."""
    ensure_checkpoint_dir(spark)
    ensure_library(spark)
    short_batches(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; it is deleted when the driver's JVM ends."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


@functools.cache
def _trim():
    """The C library's call that gives free memory back to the system, or nothing where there is none."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):
        return lambda keep: 0


def tidy() -> None:
    """Give memory that Arrow and the C library keep for later back to the system: Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def tidied(batches):
    """The batches of a task, with :func:`tidy` before each and after the last."""
    try:
        for b in batches:
            tidy()
            yield b
    finally:
        tidy()


def slices(column: pa.Array, most_bytes: int, most_rows: int):
    """(first row, row behind the last) of runs of rows with strings of up to ``most_bytes``; a longer string is alone."""
    _, off = text_bytes(column)
    lo = 0
    while lo < len(column):
        hi = min(lo + most_rows, int(np.searchsorted(off, off[lo] + most_bytes, "right")) - 1)
        yield lo, max(lo + 1, hi)
        lo = max(lo + 1, hi)


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, with underscores behind those that ``columns`` have already (Spark's names ignore case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back (cuts the lineage)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables of :func:`materialize` whose successors are written; no frame that is still to run may read them."""
    for table in tables:
        spark = table.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.scratch)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def crc_of(col: Column | str) -> Column:
    """crc32 of a column's value as text."""
    return F.crc32((F.col(col) if isinstance(col, str) else col).cast("string").cast("binary"))


def crc_text(value) -> int:
    """The same on the Python side."""
    return zlib.crc32(str(value).encode())


def running_sum(df: DataFrame, order: list, values: dict[str, str], name: str) -> DataFrame:
    """Add running sums: ``values`` maps each new column to the column that it sums over all rows before, in ``order``.

    The rows are range-partitioned and sorted; each sorted partition adds its own running sums and is written with its
    number, then the totals of the partitions (one row each) shift the sums. Null values count as 0. Rows equal in
    ``order`` come in any order among themselves.
    """
    prepare(df.sparkSession)
    outs = list(values)
    schema = T.StructType(df.schema.fields + [T.StructField("_part", T.IntegerType())]
                          + [T.StructField(x, T.LongType()) for o in outs for x in (o, f"_end_{o}")])

    def local(batches):
        from pyspark import TaskContext

        part, so_far = TaskContext.get().partitionId(), dict.fromkeys(outs, 0)
        for b in tidied(batches):
            added = [pa.array(np.full(b.num_rows, part, np.int32))]
            for o in outs:
                v = b.column(b.schema.names.index(values[o])).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
                ends = so_far[o] + np.cumsum(v, dtype=np.int64)
                added += [pa.array(ends - v), pa.array(ends)]
                if len(ends):
                    so_far[o] = int(ends[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, *added], names=schema.names)

    parts = materialize(df.sort(*order).mapInArrow(local, schema), name)
    # one row for each sorted partition: bounded by the number of shuffle partitions, not by the data
    totals = parts.groupBy("_part").agg(*[F.max(f"_end_{o}").alias(f"_end_{o}") for o in outs])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = totals.select("_part", *[F.coalesce(F.sum(f"_end_{o}").over(before), F.lit(0)).alias(f"_shift_{o}") for o in outs])
    out = parts.join(F.broadcast(shift), "_part")
    return out.select(*[F.col(c) for c in df.columns], *[(F.col(o) + F.col(f"_shift_{o}")).alias(o) for o in outs])


def attach(left: DataFrame, right: DataFrame, key: str, weight: str, spread: list[str], total: int | None = None) -> DataFrame:
    """Left join of ``right`` (one row for each key, ``weight`` = its rows on the left) without a hot shuffle key.

    Keys with over 1/HOT_SHARE of the total weight are fewer than HOT_SHARE, whatever the data: they are broadcast.
    Rows of those keys, and rows with a null key, go through the shuffle join under a salt from the ``spread``
    columns. ``right`` is read twice and should be a written table. ``weight`` is dropped; ``total`` is its sum, if known.
    """
    if total is None:
        total = right.agg(F.sum(weight)).first()[0] or 0
    floor = total // HOT_SHARE
    values = [c for c in right.columns if c not in (key, weight)]
    pack = right.select(F.col(key).alias("_key"), F.struct(*values).alias("_value"), weight)
    hot = pack.where(F.col(weight) > floor).select(F.col("_key").alias("_hot"), F.col("_value").alias("_hot_value"))
    cold = pack.where(F.col(weight) <= floor).select("_key", "_value", F.lit(0).alias("_zero"))
    out = left.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
    salt = F.when(F.col(key).isNotNull() & F.col("_hot").isNull(), F.lit(0)) \
        .otherwise(1 + F.pmod(F.xxhash64(*spread), F.lit(1 << 30)).cast("int"))
    out = out.withColumn("_salt", salt).join(
        cold, (F.col(key) == F.col("_key")) & (F.col("_salt") == F.col("_zero")), "left")
    found = F.coalesce("_hot_value", "_value")
    return out.select(*[F.col(c) for c in left.columns], *[found[v].alias(v) for v in values])


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all strings of an array, and the n + 1 offsets of the strings in them (null: empty)."""
    texts = texts.cast(pa.large_string()).fill_null("") if texts.null_count else texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def segment_sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` between successive offsets (0 for empty segments)."""
    out = np.zeros(len(offsets) - 1, np.int64)
    filled = offsets[:-1] < offsets[1:]
    if filled.any():
        out[filled] = np.add.reduceat(flags, offsets[:-1][filled], dtype=np.int64)
    return out


def word_counts(texts: pa.Array) -> np.ndarray:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in each string (null: 0)."""
    raw, off = text_bytes(texts)
    space = _SPACE[raw]
    starts = ~space
    starts[1:] &= space[:-1]
    inner = off[:-1][(off[:-1] < off[1:])]
    starts[inner] = ~space[inner]
    return segment_sums(starts, off)


@F.arrow_udf(T.LongType())
def word_count(texts: pa.Array) -> pa.Array:
    tidy()
    return pa.array(word_counts(texts))


def smallest(df: DataFrame, group: str, order: list, most: int, ways: int = 64) -> DataFrame:
    """The first ``most`` rows of each group by ``order``, whose first term is a hash.

    Every task keeps at most ``most`` rows of a group and way, each way of a hot group is picked in a task of its own,
    and at most ``ways * most`` rows of a group meet in the end.
    """
    first = df.withColumn("_way", F.pmod(order[0], F.lit(ways)))
    first = first.withColumn("_turn", F.row_number().over(Window.partitionBy(group, "_way").orderBy(*order))).where(F.col("_turn") <= most)
    last = first.withColumn("_turn", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("_turn") <= most)
    return last.drop("_way", "_turn")


def write_blobs(df: DataFrame, column: str, path: str, tail: bytes) -> None:
    """Write each value of a binary column as one file: the value's bytes, then ``tail``.

    Uses Spark's text writer, one row a file, so task retries and any Hadoop file system work as for other tables.
    The line separator, written after each row, is ``tail``: the last bytes of the file format's footer.
    """
    (df.select(F.col(column).cast("string").alias("value")).write
       .option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1")
       .option("lineSep", tail.decode("latin-1")).text(path))


def read_blobs(spark: SparkSession, path: str) -> DataFrame:
    """The files of ``write_blobs``: path, content."""
    return spark.read.format("binaryFile").load(path).select("path", "content")
