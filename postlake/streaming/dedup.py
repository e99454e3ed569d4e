"""First sightings of an id within a stream (H5).

:func:`dedup_stream` keeps the first record of each key; :func:`mark_stream`
keeps every record and says which ones are first sightings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postlake.streaming.runs import query_id, write_counts


def _event_time(df: DataFrame, ts: str):
    """``ts`` (a timestamp of either kind, or epoch seconds) as the ``timestamp`` that watermarks need."""
    typ = dict(df.dtypes)[ts]
    return F.timestamp_seconds(F.col(ts)) if typ in ("bigint", "int", "double") else F.col(ts).cast("timestamp")


def dedup_stream(df: DataFrame, key: str, ts: str, delay: str | None = None) -> DataFrame:
    """Keep one record per ``key``: that of the first micro-batch that has the key.

    Without ``delay`` the guarantee is exact whatever the order of arrival:
    no record is dropped but repeats, and the state holds every key seen.
    With ``delay`` the state is bounded by a watermark on ``ts``: a repeat
    within ``delay`` of event time is dropped, a key that comes back later
    counts as new, and a record that arrives more than ``delay`` behind the
    newest event time of the batches before is dropped even if its key is new.
    """
    timed = df.withColumn("_event_time", _event_time(df, ts))
    if delay is None:
        return timed.dropDuplicates([key])
    return timed.withWatermark("_event_time", delay).dropDuplicatesWithinWatermark([key])


def new_ids_per_minute(df: DataFrame, key: str, ts: str, delay: str = "1 hour") -> DataFrame:
    """Count of new keys per event-time minute (append mode, closed by the watermark).

    The watermark's guarantee is that of :func:`dedup_stream` with ``delay``.
    """
    firsts = dedup_stream(df, key, ts, delay)
    return (firsts.groupBy(F.window("_event_time", "1 minute").alias("w"))
                  .agg(F.count(F.lit(1)).alias("new_ids"))
                  .select(F.col("w.start").alias("minute"), "new_ids"))


_NEW, _ROW = "_mark_new", "_mark_row"


def mark_batch(batch: DataFrame, batch_id: int, key: str, order: Sequence[str], out: str, counts: str | None = None) -> None:
    """Write one micro-batch of :func:`mark_stream` with ``is_new`` (the ``foreachBatch`` body).

    The batch holds every record, and once more a record of each key that the
    stream's state did not know. Of such a key, the first record by ``order``
    (ties by the record's content, then by a number that tells equal records
    apart) is new. Numbers, not keys, join the marks to the records, so a key
    with most of the batch is one aggregate row and no join key.
    """
    query = query_id(batch)
    data = [c for c in batch.columns if c != _NEW]
    batch = batch.withColumn(_ROW, F.monotonically_increasing_id()).persist()
    try:
        place = F.struct(*order, F.xxhash64(*data).alias("_mark_hash"), _ROW)
        firsts = batch.groupBy(key).agg(F.max(_NEW).alias(_NEW), F.min(F.when(~F.col(_NEW), place)).alias("first"))
        firsts = firsts.where(_NEW).select(F.col(f"first.{_ROW}").alias("_mark_first"))
        rows = batch.where(~F.col(_NEW)).join(firsts, F.col(_ROW) == F.col("_mark_first"), "left") \
            .select(*[F.col(f"`{c}`") for c in data], F.col("_mark_first").isNotNull().alias("is_new"),
                    F.lit(query).alias("query"), F.lit(batch_id).cast("long").alias("batch"))
        seen = Observation("marked")
        rows.observe(seen, F.count(F.lit(1)).alias("records"), F.count_if("is_new").alias("new"), F.count_if(~F.col("is_new")).alias("repeated")) \
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("query", "batch").parquet(out)
        if counts:
            write_counts(batch.sparkSession, counts, query, batch_id, seen.get)
    finally:
        batch.unpersist()


def mark_stream(df: DataFrame, key: str, order: Sequence[str], out: str, checkpoint_location: str,
                available_now: bool = False, counts: str | None = None) -> StreamingQuery:
    """Write every record to ``out`` with ``is_new``: true for a key's first record, false for its repeats.

    First is by micro-batch, then by ``order``; of records that are equal
    throughout, one is new. The keys seen are the query's own state, in its
    checkpoint: a batch looks up its own keys only, nothing is dropped as late,
    and a batch replayed after a failure finds the state of the batch before
    it and rewrites its own rows. ``out`` has a folder for each query id and
    batch, so queries (or one that starts over with a new checkpoint, which
    knows no keys) share it without touching each other's rows. The state
    holds every key; for more keys than fit in executors' memory, set
    ``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider.

    ``counts``: folder to which each batch writes its records, new and repeated
    (see :mod:`postlake.streaming.runs`).
    """
    # the same source twice: all records, and one of each key that is new to the state
    flagged = df.withColumn(_NEW, F.lit(False))
    both = flagged.unionByName(df.dropDuplicates([key]).withColumn(_NEW, F.lit(True)))
    writer = both.writeStream.option("checkpointLocation", checkpoint_location).foreachBatch(
        lambda b, i: mark_batch(b, i, key, list(order), out, counts))
    return (writer.trigger(availableNow=True) if available_now else writer).start()
