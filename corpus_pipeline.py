"""The corpus pipeline: quality, near-duplicates, benchmark passages, mixing, token files.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet in the shared folder and
reads back as the next stage's documents. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm import decontam, mixing, quality, simhash, tokens
from postlake.llm.common import materialize, prepare, release, unused
from postlake.llm.queries import table, tokenizer_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates: that of the smallest id, and of its texts that of the smallest hash.

    Rows are told apart by id and text, so different texts of one id are documents of their own; of rows equal in both,
    one is kept. Documents without an id come after all others, so one is kept only where no document of its component has an id.
    """
    # a key without nulls, as columns: the texts are shuffled once, by it, copies of a row are dropped before and after
    # that, and what the component's heads are joined to has the same partitioning
    key = unused(docs.columns, "no_id", "id", "hash")
    keyed = docs.withColumns(dict(zip(key, (F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), F.sha2(F.coalesce("text", F.lit("")), 256)))))
    groups = simhash.near_duplicates(keyed.select(F.struct(*key).alias("key"), "text"), "key")
    heads = groups.where(F.col("key") == F.col("component_id")).select(*[F.col(f"key.{k}").alias(k) for k in key]).distinct()
    return keyed.dropDuplicates(key).join(heads, key, "left_semi").select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix draws, a row for each time; ``n_chars`` follows the text of a cut document."""
    mixed = mixing.mix(docs, names=tuple(unused(docs.columns, "mix_shard", "mix_epoch")))
    return mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back: doc_id, start, n_tokens, ids_crc32."""
    return tokens.encode_documents(docs, tokenizer_path())


STAGES = [("quality", keep_quality), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_benchmark),
          ("mixing", mix_sources), ("tokens", write_token_files)]

#: No SQL states the classifier, the mix's draws or the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table ``documents`` on."""
    prepare(spark)
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            release(before)
        before = docs
    return docs
