"""The registered queries of the numbered operators, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import codes, decontam, divergence, langid, mixing, personal, quality, search, secrets, simhash, tokens, urls, warc
from .common import attach, materialize, prepare, scratch_path

URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page's html as WARC records in seekable Zstandard bundles and read the bundles back."""
    prepare(spark)
    pages = table(spark, sf_dir, "pages")
    path = scratch_path(spark, "warc")
    warc.write_archive(pages, path)
    return warc.read_archive(spark, path).select(
        F.col("record_key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents' sources to their target weights: the words taken of each document."""
    prepare(spark)
    plan = mixing.plan_mix(mixing.document_sizes(table(spark, sf_dir, "documents")))
    each = plan.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d["words"])
    return each.select("doc_id", "size", F.col("source_words").alias("source_size"), "target", taken.alias("taken"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base patterns and inferred formats of credentials in every text."""
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and its component of near-duplicates."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold passages of benchmark items, with the items and places."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    scored = quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op7_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every document's token ids as Simple-8b files and read the files back."""
    prepare(spark)
    return tokens.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge every page's url by rules and the host graph's ranks."""
    return urls.judge_urls(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return langid.predict_language(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op10_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best vectors by integer inner product for every vector whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    return search.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors, found in GNATs over the codebooks' entries, and their errors summed over labels."""
    coded, books = codes.compress(table(spark, sf_dir, "embeddings"))
    # a label may hold a third of all rows: sums are made before the shuffle, and joined on by attach()
    coded = materialize(coded.withColumn("lkey", mixing.source_key("label")), "vector-codes")
    sums = materialize(coded.groupBy("lkey").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("sum"), F.count("*").alias("rows")), "vector-errors")
    out = attach(coded, sums.withColumn("label_error", F.least("sum", F.lit(codes.LONG_MAX).cast("decimal(38,0)")).cast("long")).drop("sum"),
                 "lkey", "rows", ["id", "code"])
    return out.select(F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error",
                      F.lit(books.sha256() if books else None).cast("string").alias("codebooks_sha256"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source from every other of its language, and the terms it uses more than its language."""
    return divergence.audit_sources(table(spark, sf_dir, "documents"))


def op13_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text: counts by kind, the base rules' digest, all spans."""
    found = personal.find_personal(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("personal", lambda s: s["kind"] == kind)).cast("long")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("personal", lambda s: s["kind"].isin(*personal.KINDS))
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in personal.KINDS],
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("personal")).alias("spans"))


QUERIES = {"op1_warc": op1_warc, "op2_mixing": op2_mixing, "op3_secrets": op3_secrets, "op4_simhash": op4_simhash,
           "op5_decontamination": op5_decontamination, "op6_quality": op6_quality, "op7_tokens": op7_tokens,
           "op8_urls": op8_urls, "op9_language": op9_language, "op10_search": op10_search,
           "op11_codes": op11_codes, "op12_divergence": op12_divergence, "op13_personal": op13_personal}

WARC_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(encode(coalesce(html, ''))) AS hex FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first_id FROM p)
SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes,
  list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(hex, (i // 8 * 10 + 1)::BIGINT, 10))::BIGINT >> (35 - 5 * (i % 8))::BIGINT) & 31) + 1, 1)
    FOR i IN range(0, 32)], 'string_agg', '') AS payload_digest,
  CASE WHEN first_id IS NULL OR page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_id IS NULL OR page_id IS NOT DISTINCT FROM first_id THEN NULL ELSE first_id END AS refers_to
FROM f
"""

SEARCH_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""

ORACLES = {"op1_warc": WARC_SQL, "op8_urls": urls.judge_sql(URL_RULES), "op10_search": SEARCH_SQL,
           "op11_codes": codes.codes_sql(), "op12_divergence": divergence.audit_sql()}
