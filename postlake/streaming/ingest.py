"""Micro-batch ingest of posting records into bronze Parquet (H1-H4).

The stream is read, decoded and split into good and bad records; every
micro-batch is written with :func:`write_bronze` under a run id made of a
prefix, the query's id and the batch id, in the folder of the batch's logged
time. Spark commits the batch in the checkpoint only after ``foreachBatch``
returns; a replayed batch has the same ids and the same logged time, also in
another hour, and rewrites its own directory. So a failure between write and
commit neither loses nor duplicates records, and queries that write into one
root (or a query that starts over with a new checkpoint, which has a new id)
never replace each other's batches. A stop drains: ``availableNow`` processes
what is there and ends.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postlake.sources.bronze import BATCH_TIME, path_values, write_bronze
from postlake.sources.contract import Contract, apply_contract, posting_contract
from postlake.sources.manifest import update_manifest
from postlake.streaming.runs import query_id, write_counts

# Fixed value: idle interval after which the consumer service writes what it has.
IDLE_FLUSH = "30 seconds"


def split_bad(df: DataFrame, contract: Contract | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, bad): bad = undecodable value, or no id, title and URL at all.

    Good records are projected onto the contract (defaults filled).
    """
    contract = contract or posting_contract()
    decoded = F.col("_decoded") if "_decoded" in df.columns else F.lit(True)
    empty = F.col("job_id").isNull() & F.col("title").isNull() & F.col("url").isNull()
    bad_flag = ~decoded | empty
    time = [BATCH_TIME] if BATCH_TIME in df.columns else []
    good = apply_contract(df.where(~bad_flag), contract, stamps=time)
    bad_cols = ["_raw"] if "_raw" in df.columns else []
    at = F.col(BATCH_TIME) if time else F.current_timestamp()
    bad = df.where(bad_flag).select(*bad_cols, *time, at.alias("_quarantined_at"),
                                    F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns
                                                         if c not in ("_raw", "_decoded", BATCH_TIME)])).alias("_record"))
    return good, bad


def ingest_batch(batch: DataFrame, batch_id: int, root: str, quarantine: str | None,
                 run_prefix: str, contract: Contract | None,
                 partition_cols: Sequence[str], counts: str | None = None, manifest: bool = False) -> None:
    """Write one micro-batch (the ``foreachBatch`` body).

    The batch is decoded once and kept for its two writes (good and bad);
    a lost cached block is recomputed from the same micro-batch offsets.
    Good and bad records are counted as they are written.
    """
    query = query_id(batch)
    batch = batch.persist()
    try:
        good, bad = split_bad(batch, contract)
        run_id = f"{run_prefix}_{query}_{batch_id:08d}"
        seen = {"good": Observation("good"), "bad": Observation("bad")}
        one = F.count(F.lit(1)).alias("n")
        write_bronze(good.observe(seen["good"], one), root, run_id, F.col(BATCH_TIME), partition_cols)
        if quarantine:
            write_bronze(bad.observe(seen["bad"], one), quarantine, run_id, F.col(BATCH_TIME), partition_cols)
        if manifest and (time := batch.select(*path_values(F.col(BATCH_TIME), partition_cols)).first()):
            folder = "/".join(f"{c}={v}" for c, v in time.asDict().items())
            update_manifest(batch.sparkSession, root, f"{folder}/run_id={run_id}", part=run_id)
        if counts:
            written = ("good", "bad") if quarantine else ("good",)
            write_counts(batch.sparkSession, counts, query, batch_id, {name: seen[name].get["n"] for name in written})
    finally:
        batch.unpersist()


def ingest_stream(stream: DataFrame, root: str, checkpoint_location: str,
                  quarantine: str | None = None, contract: Contract | None = None,
                  run_prefix: str = "ingest", available_now: bool = False,
                  processing_time: str = IDLE_FLUSH,
                  partition_cols: Sequence[str] = ("batch_date", "batch_hour"),
                  counts: str | None = None, manifest: bool = False) -> StreamingQuery:
    """Start the ingest query (H1). ``available_now`` drains and stops (H4).

    ``counts``: folder to which each batch writes how many good and bad records it held.
    ``manifest``: each batch adds its files to the manifest of ``root``.

    A micro-batch takes all that has arrived; a limit is the source's option
    ``maxOffsetsPerTrigger`` (Kafka) or ``maxFilesPerTrigger`` (files).
    """
    # in a stream, current_timestamp() is the micro-batch's logged time
    writer = (stream.withColumn(BATCH_TIME, F.current_timestamp()).writeStream
              .option("checkpointLocation", checkpoint_location)
              .foreachBatch(lambda b, i: ingest_batch(b, i, root, quarantine, run_prefix,
                                                      contract, partition_cols, counts, manifest)))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=processing_time)
    return writer.start()
