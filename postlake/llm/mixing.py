"""Mix sources to target weights with a multivariate-hypergeometric splitting tree.

Each source is a line of words: its documents in the order of a seeded hash, twice over. The first ``quota`` words of
the line belong to the mix, so a source whose target is above its size repeats documents, and none comes more than
twice. The line is cut into blocks; the exact block quotas of all sources are split over the output shards by a tree
whose nodes draw from the multivariate hypergeometric distribution, and each shard draws its share of every source's
permuted blocks, disjoint from all other shards', and shuffles its documents.
"""

from __future__ import annotations

from math import gcd

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import attach, materialize, prepare, running_sum, unused, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
BLOCK_WORDS = 4096
#: Words of an output shard, if no number of shards is given.
SHARD_WORDS = 2_000_000
SEED = 42
#: Levels of the tree that one task splits for one node.
LEVELS = 6
#: numpy draws from urns of fewer than 1e9; larger mixes get longer blocks.
MOST_BLOCKS = 500_000_000


def source_key(source: str) -> Column:
    """A key without nulls that sorts by code point, null last."""
    return F.coalesce(F.concat(F.lit("a"), F.col(source).cast("string")), F.lit("b"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """One row per source: skey, words, docs, sid (rank by key), base (words of the sources before), target (double).

    The k-th source weighs ``weights[k % len(weights)]``. The sources share ``share`` times all words by weight; a
    target stops at ``repeats`` times its source's words and the excess goes to the others by weight, until none is
    above. ``sizes`` has skey, size.
    """
    sums = sizes.groupBy("skey").agg(F.sum("size").alias("words"), F.count("*").alias("docs"), F.lit(1).alias("one"))
    ranked = running_sum(sums, ["skey"], {"sid": "one", "base": "words"}, "mix-sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    ranked = materialize(ranked.drop("one").withColumn("weight", weight), "mix-ranked")
    most = repeats * F.col("words").cast("double")
    first = ranked.agg(F.sum("words").alias("words"), F.sum("weight").alias("weight")).first()
    total = share * (first["words"] or 0)
    level, before = total / first["weight"] if first["weight"] else 0.0, None
    while level != before:  # the words per weight rise while more sources reach their limit
        full = F.lit(level) * F.col("weight") >= most
        row = ranked.agg(F.sum(F.when(full, most)).alias("full"), F.sum(F.when(~full, F.col("weight"))).alias("weight")).first()
        before = level
        if row["weight"]:
            level = max(level, (total - (row["full"] or 0.0)) / row["weight"])
    return ranked.withColumn("target", F.least(F.lit(level) * F.col("weight"), most)).drop("weight")


def split_quotas(quotas: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """Split block quotas (sid, blocks) over the shards: sid, blocks, shard, taken.

    A node of the tree stands for a run of shards and holds a quota of every source. It draws the left half's blocks
    from the multivariate hypergeometric distribution, in proportion to the halves' numbers of shards; the rest goes
    right. All quotas are met exactly, and shards' totals differ by rounding only. A node's group has one row for each
    source that has blocks there.
    """
    def split(lo: int, hi: int, counts: np.ndarray, levels: int):
        if hi - lo == 1 or levels == 0:
            yield lo, hi, counts
            return
        mid = (lo + hi) // 2
        n = int(counts.sum())
        rng = np.random.Generator(np.random.PCG64([seed, lo, hi]))
        left = rng.multivariate_hypergeometric(counts, round(n * (mid - lo) / (hi - lo)), method="marginals")
        yield from split(lo, mid, left, levels - 1)
        yield from split(mid, hi, counts - left, levels - 1)

    def node(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("sid")
        out = []
        for lo, hi, counts in split(int(rows["lo"].iloc[0]), int(rows["hi"].iloc[0]), rows["taken"].to_numpy(np.int64), LEVELS):
            out.append(pd.DataFrame({"sid": rows["sid"], "blocks": rows["blocks"], "lo": lo, "hi": hi, "taken": counts})[counts > 0])
        return pd.concat(out)

    nodes = quotas.where("blocks > 0").select("sid", "blocks", F.lit(0).alias("lo"), F.lit(shards).alias("hi"), F.col("blocks").alias("taken"))
    width = shards
    while width > 1:
        nodes = nodes.groupBy("lo", "hi").applyInPandas(node, "sid long, blocks long, lo int, hi int, taken long")
        width = -(-width // 2 ** LEVELS)
    return nodes.select("sid", "blocks", F.col("lo").alias("shard"), "taken")


def draw_blocks(shares: DataFrame, seed: int = SEED) -> DataFrame:
    """One row per block: sid, block, shard. A source's blocks, in a seeded permutation, go to the shards in turn."""
    from pyspark.sql import Window

    turn = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.withColumn("first", F.coalesce(F.sum("taken").over(turn), F.lit(0)))

    def permuted(batches):
        for b in batches:
            for sid, blocks, shard, taken, first in zip(*(b.column(i).to_pylist() for i in range(5))):
                rng = np.random.Generator(np.random.PCG64([seed, sid, blocks]))
                step = int(rng.integers(1, blocks + 1))
                while gcd(step, blocks) > 1:
                    step += 1
                at = int(rng.integers(0, blocks))
                for lo in range(first, first + taken, 100_000):
                    own = (at + step * np.arange(lo, min(lo + 100_000, first + taken), dtype=np.int64)) % blocks
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(own), sid, np.int64)), pa.array(own), pa.array(np.full(len(own), shard, np.int32))],
                        names=["sid", "block", "shard"])

    return shares.select("sid", "blocks", "shard", "taken", "first").mapInArrow(permuted, "sid long, block long, shard int")


def plan_mix(sizes: DataFrame, id_col: str = "doc_id", weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS,
             block_words: int = BLOCK_WORDS, shards: int | None = None, seed: int = SEED) -> DataFrame:
    """What the mix takes of each document.

    ``sizes``: id column, skey, size (words). Returns id, skey, size, rows (rows alike in these three, which are taken
    alike), words and target of the source, and draws: an array of struct(epoch, words, shard) with one entry for each
    time that the document comes into the mix. The last document of a quota is cut, so that a source's words are its
    target, rounded (but for less than a word for each of ``rows``). Empty documents are never drawn. Without ``shards``
    there is one for every SHARD_WORDS words.
    """
    spark = sizes.sparkSession
    prepare(spark)
    sizes = materialize(sizes.select(F.col(id_col).alias("id"), "skey", "size"), "mix-sizes")
    sources = source_targets(sizes, weights, share, repeats)
    total = sources.agg(F.sum("target")).first()[0] or 0.0
    width = max(block_words, int(total) // MOST_BLOCKS + 1)
    shards = shards or max(1, -(-int(total) // SHARD_WORDS))
    sources = materialize(sources.withColumn("quota", F.round("target").cast("long"))
                          .withColumn("blocks", F.ceil(F.col("quota") / width).cast("long")), "mix-targets")
    blocks = materialize(draw_blocks(split_quotas(sources.select("sid", "blocks"), shards, seed), seed), "mix-blocks")
    known = attach(sizes, sources.select("skey", "docs", "sid", "base", "target", "quota", F.col("words").alias("source_words")),
                   "skey", "docs", ["id", "size"])
    units = known.groupBy("id", "skey", "size", "sid", "base", "target", "quota", "source_words").agg(F.count("*").alias("rows"))
    units = units.withColumn("line", F.col("rows") * F.col("size")).withColumn("_order", F.xxhash64("id", F.lit(seed)))
    line = running_sum(units, ["sid", "_order", "id", "size"], {"at": "line"}, "mix-line").withColumn("at", F.col("at") - F.col("base"))
    entries = []
    for epoch in range(repeats):
        begin = F.col("at") + epoch * F.col("source_words")
        taken = F.greatest(F.lit(0), F.least(F.col("line"), F.col("quota") - begin))
        nowhere = -1 - F.pmod(F.xxhash64("id", "size"), F.lit(1 << 30))  # rows that take no part spread out in the join
        line = line.withColumn(f"_words{epoch}", F.floor(F.when(F.col("rows") > 0, taken) / F.col("rows")).cast("long")) \
            .withColumn("block", F.when(taken > 0, F.floor(begin / width).cast("long")).otherwise(nowhere))
        line = line.join(blocks.withColumnRenamed("shard", f"_shard{epoch}"), ["sid", "block"], "left").drop("block")
        entries.append(F.struct(F.lit(epoch).alias("epoch"), F.col(f"_words{epoch}").alias("words"), F.col(f"_shard{epoch}").alias("shard")))
    draws = F.filter(F.array(*entries), lambda d: d["words"] > 0)
    return line.select(F.col("id").alias(id_col), "skey", "size", "rows", "source_words", "target", draws.alias("draws"))


def document_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    return docs.select(F.col(id_col), source_key(source_col).alias("skey"), word_count(F.col(text_col)).alias("size"))


@F.arrow_udf(T.StringType())
def _first_words(texts: pa.Array, counts: pa.Array) -> pa.Array:
    import re

    return pa.array([None if t is None else "".join(re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", t)[:n])
                     for t, n in zip(texts.to_pylist(), counts.to_pylist())], pa.string())


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED,
        names: tuple[str, str] = ("mix_shard", "mix_epoch"), **how) -> DataFrame:
    """The mixed documents: all columns of ``docs``, a row for each draw, with its shard and epoch (``names``).

    A document that the mix takes in part has its first words only. Rows of a shard are together in a task, in random
    (seeded) order. Null texts and texts without words are never drawn. Columns of ``docs`` named as in ``names``
    are replaced; all others keep their values, whatever their names. ``how``: as for ``plan_mix``.
    """
    docs = docs.drop(*names)
    own_size, own_skey, key, skey, size, draws, draw, part = unused(
        [*docs.columns, *names], "own_size", "own_skey", "key", "skey", "size", "draws", "draw", "part")
    plan = plan_mix(document_sizes(docs, id_col, text_col, source_col), id_col, seed=seed, **how).where(F.size("draws") > 0)
    plan = plan.select(F.col(id_col).alias(key), F.col("skey").alias(skey), F.col("size").alias(size), F.col("draws").alias(draws))
    # null-safe throughout: a null filter on the size would count the words once more. A row that repeats through the
    # table is one key with one row on the plan's side; the adaptive skew join splits its copies
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    sized = docs.withColumn(own_size, word_count(F.col(text_col))).withColumn(own_skey, source_key(source_col))
    drawn = sized.join(plan, same(id_col, key) & same(own_skey, skey) & same(own_size, size))
    drawn = drawn.withColumn(draw, F.explode(draws))
    words = F.col(draw)["words"]
    drawn = drawn.withColumn(part, _first_words(F.when(words < F.col(size), F.col(text_col)), words))
    out = drawn.select(*[F.coalesce(part, c).alias(c) if c == text_col else F.col(c) for c in docs.columns],
                       F.col(draw)["shard"].alias(names[0]), F.col(draw)["epoch"].alias(names[1]))
    return out.repartition(names[0]).sortWithinPartitions(names[0], F.xxhash64(F.lit(seed), F.col(id_col), names[1]))
