"""Stream source and keyed publish.

Kafka is the production source/sink; its connector (and the Avro functions)
are separate Spark packages, so both are used only when present. File
streams (Parquet/JSON) take the same path in tests and in small setups.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from postlake.sources.contract import Contract, posting_contract

# Length of the schema-registry header in front of each message
# (one magic byte and a four-byte schema id), and the consumer's default: read
# the topic from the earliest offset. A micro-batch has no limit of its own.
REGISTRY_HEADER_BYTES = 5
KAFKA_SOURCE_DEFAULTS = {"startingOffsets": "earliest"}
# Fixed value: the consumer writes what it has after so long without a full batch.
FLUSH_DELAY = "30s"


CORRUPT = "_corrupt_record"


def decode_value(value: Column, contract: Contract, avro_schema: str | None = None) -> Column:
    """Message bytes → contract struct, with a ``_corrupt_record`` field for JSON.

    With an Avro schema and the Avro functions available, the registry header
    is skipped and the rest decoded as Avro (an undecodable value gives a null
    struct); otherwise the value is read as JSON text, and a value that is
    not valid JSON keeps its text in ``_corrupt_record``. Both run in
    PERMISSIVE mode, so a bad message never fails the batch.
    """
    if avro_schema is not None:
        try:
            from pyspark.sql.avro.functions import from_avro
        except ImportError as e:  # pragma: no cover - depends on packages
            raise RuntimeError("Avro decoding needs the spark-avro package") from e
        body = F.expr(f"substring(value, {REGISTRY_HEADER_BYTES + 1})")
        return from_avro(body, avro_schema, {"mode": "PERMISSIVE"})
    schema = T.StructType(list(contract.schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    return F.from_json(value.cast("string"), schema,
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def read_stream(spark: SparkSession, fmt: str, options: Mapping[str, str] | None = None,
                contract: Contract | None = None, path: str | None = None,
                avro_schema: str | None = None, flush_rows: int | None = None,
                flush_delay: str = FLUSH_DELAY) -> DataFrame:
    """Streaming frame of decoded records plus ``_raw`` (the undecoded text) and ``_decoded``
    (false for a message that could not be decoded).

    ``kafka``: subscribe with the given options (earliest offsets unless told
    otherwise; no limit on a micro-batch unless ``maxOffsetsPerTrigger`` is
    given) and decode ``value``. ``json`` text files: each line is a
    message, decoded like a Kafka value. ``parquet``: files already typed by
    the contract schema.

    ``flush_rows``: a micro-batch waits for so many new messages, but no longer than
    ``flush_delay`` after the first of them, so that few large files are written (Kafka;
    run the query with a short trigger interval). A file source has no such count and is
    flushed by the trigger alone; asking for it there is an error.
    """
    if flush_rows is not None and fmt != "kafka":
        raise ValueError(f"a {fmt} source does not count what is waiting; use the trigger interval")
    contract = contract or posting_contract()
    opts = dict(options or {})
    if fmt == "kafka":
        for k, v in KAFKA_SOURCE_DEFAULTS.items():
            opts.setdefault(k, v)
        if flush_rows is not None:
            opts |= {"minOffsetsPerTrigger": str(flush_rows), "maxTriggerDelay": flush_delay}
        raw = spark.readStream.format("kafka").options(**opts).load()
        value = F.col("value")
    elif fmt == "json":
        raw = spark.readStream.options(**opts).text(path)
        value = F.col("value")
    elif fmt == "parquet":
        df = spark.readStream.options(**opts).schema(contract.schema).parquet(path)
        return df.withColumn("_raw", F.lit(None).cast("string")).withColumn("_decoded", F.lit(True))
    else:
        raise ValueError(f"unsupported stream format {fmt!r}")
    dec = raw.select(value.cast("string").alias("_raw"),
                     decode_value(value, contract, avro_schema).alias("_rec"))
    ok = F.col("_rec").isNotNull()
    if avro_schema is None:
        ok = ok & F.col(f"_rec.{CORRUPT}").isNull()
    return dec.select(*[F.col(f"_rec.{n}") for n in contract.names], "_raw", ok.alias("_decoded"))


def avro_value(record: Column, avro_schema: str, schema_id: int) -> Column:
    """Avro message body behind the registry header: magic byte 0 and the schema id in four bytes.

    Needs the spark-avro package, which is not installed here: untested.
    """
    try:
        from pyspark.sql.avro.functions import to_avro
    except ImportError as e:  # pragma: no cover - depends on packages
        raise RuntimeError("Avro encoding needs the spark-avro package") from e
    header = F.lit(bytearray(b"\x00" + schema_id.to_bytes(4, "big")))
    return F.concat(header, to_avro(record, avro_schema))


def keyed_records(df: DataFrame, key_col: str = "job_id", avro_schema: str | None = None,
                  schema_id: int = 0) -> DataFrame:
    """``key, value`` pairs: key = the id, else a hash of the record (stable on replay).

    The value is the record as JSON, or in Avro when a schema is given.
    """
    record = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    text = F.to_json(record)
    key = F.coalesce(F.nullif(F.col(key_col).cast("string"), F.lit("")), F.sha2(text, 256))
    value = text if avro_schema is None else avro_value(record, avro_schema, schema_id)
    return df.select(key.alias("key"), value.alias("value"))


def write_keyed(df: DataFrame, key_col: str, fmt: str, options: Mapping[str, str] | None = None,
                path: str | None = None, avro_schema: str | None = None, schema_id: int = 0) -> None:
    """Publish records keyed by ``key_col`` (batch write; ``kafka`` or a ``json`` folder)."""
    kv = keyed_records(df, key_col, avro_schema, schema_id)
    if fmt == "kafka":
        kv.write.format("kafka").options(**dict(options or {})).save()
    elif fmt == "json":
        kv.write.mode("append").json(path)
    else:
        raise ValueError(f"unsupported sink format {fmt!r}")


def write_keyed_stream(df: DataFrame, key_col: str, fmt: str, checkpoint_location: str,
                       options: Mapping[str, str] | None = None, path: str | None = None,
                       available_now: bool = False, avro_schema: str | None = None,
                       schema_id: int = 0) -> StreamingQuery:
    """The same for a streaming frame: starts a query that appends keyed records."""
    if fmt not in ("kafka", "json"):
        raise ValueError(f"unsupported sink format {fmt!r}")
    writer = (keyed_records(df, key_col, avro_schema, schema_id).writeStream.format(fmt)
              .options(**dict(options or {})).option("checkpointLocation", checkpoint_location).outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path) if path else writer.start()
