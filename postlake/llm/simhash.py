"""SimHash near-duplicates: 64-bit fingerprints of word shingles, pigeonhole blocks, exact Hamming distance.

Fingerprints are cut into blocks; two that differ in at most k of 64 bits agree in all but k of the blocks, so they
share the key made of some choice of ``blocks - k`` blocks. Distinct fingerprints are joined on these keys and each
pair's distance is verified. A key that too many fingerprints share gets finer keys instead of its pairs: each of its
fingerprints is listed under all values within half of k bits (rounded up for one of a pair, down for the other), where
any two of them within k bits meet. The components of the links are labelled by minimum propagation.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import attach, materialize, prepare, release, tidy

SHINGLE = 3
MAX_BITS = 2
BLOCKS = 5
#: A key of more fingerprints gets finer keys.
BUCKET = 64
SEED = 42
_STEP = 1 << 18


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of a text."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(line, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    begin, end = (ends - lengths)[:len(words) - shingle + 1], ends[shingle - 1:]
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(begin), _STEP):
        part = [xxh64_intdigest(line[a:b], SEED) for a, b in zip(begin[lo:lo + _STEP].tolist(), end[lo:lo + _STEP].tolist())]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(begin), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """id, fp (the fingerprint's bits as a signed long) of every row."""
    @F.arrow_udf(T.LongType())
    def of(texts: pa.Array) -> pa.Array:
        tidy()
        known: dict = {}
        out = np.empty(len(texts), np.uint64)
        for i, t in enumerate(texts.to_pylist()):
            if (fp := known.get(t)) is None:
                fp = known[t] = fingerprint(t, shingle)
            out[i] = fp
        return pa.array(out.view(np.int64))

    return docs.select(F.col(id_col).alias("id"), of(F.col(text_col)).alias("fp"))


def _block_keys(fp, blocks: int, max_bits: int):
    """One key per choice of blocks: the choice's number and the bits of its blocks, all others zero."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - max_bits)):
        mask = sum(((1 << edges[b + 1]) - (1 << edges[b])) for b in chosen)
        keys.append(F.struct(F.lit(number).alias("n"), fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)).alias("bits")))
    return F.array(*keys)


def _masks(bits: int) -> list[int]:
    """All 64-bit masks with at most ``bits`` ones, as signed longs."""
    out = [0]
    for n in range(1, bits + 1):
        out += [sum(1 << b for b in c) for c in combinations(range(64), n)]
    return [m - (1 << 64) if m >> 63 else m for m in out]


def links(fps: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS, bucket: int = BUCKET) -> DataFrame:
    """Links a < b between distinct fingerprints, enough that the components are those of all pairs within ``max_bits``.

    ``fps`` has one row per distinct ``fp``. Keys of up to ``bucket`` fingerprints give all their close pairs. For
    others, a fingerprint is linked with the smallest one at each value within reach of both; such two are always close.
    """
    if not 0 <= max_bits < blocks:
        raise ValueError("max_bits must be below the number of blocks")
    # a task's rows grow tenfold: spread them first, however few files hold them
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = fps.repartition(tasks, "fp").select("fp", F.explode(_block_keys(F.col("fp"), blocks, max_bits)).alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("n > 1")
    shared = materialize(shared, "simhash-keys")
    close = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits
    found = shared.where("n = 2").select(F.col("lo").alias("a"), F.col("hi").alias("b")).where(close("a", "b"))
    more = shared.where("n > 2").select("key", "n", F.col("n").alias("weight"))
    members = attach(keyed, more, "key", "weight", ["fp"]).where("n is not null")
    members = materialize(members.select("key", "fp", "n"), "simhash-members")
    small = members.where(F.col("n") <= bucket)
    pairs = small.select("key", F.col("fp").alias("a")).join(small.select("key", F.col("fp").alias("b")), "key") \
        .where((F.col("a") < F.col("b")) & close("a", "b")).select("a", "b")
    masks = F.transform(F.array(*[F.lit(m) for m in _masks((max_bits + 1) // 2)]), lambda m: F.struct(
        m.bitwiseXOR(F.col("fp")).alias("at"), (F.bit_count(m) <= max_bits // 2).alias("near")))
    spread = members.where(F.col("n") > bucket).select("fp").distinct().select(F.col("fp").alias("b"), F.explode(masks).alias("m"))
    spread = spread.select("b", "m.at", "m.near")
    stars = spread.groupBy("at").agg(F.min(F.when(F.col("near"), F.col("b"))).alias("a"), F.count("*").alias("weight")).where("weight > 1 and a is not null")
    star = attach(spread.select("b", "at"), materialize(stars, "simhash-stars"), "at", "weight", ["b"]) \
        .where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return found.union(pairs).union(star.where(close("a", "b")).select("a", "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links a, b: node, label (the smallest node), for all nodes that have a link.

    Alternates large-star and small-star steps: every step hooks a node's neighbours to the smallest one, until each
    component is a star. Steps grow with the logarithm of the longest path; a step's hot node is pre-aggregated (its
    minimum) and joined back by ``attach``.
    """
    edges = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "cc-edges")
    print_of = lambda e: tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
    before = print_of(edges)
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        first = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("weight")), "cc-low")
        large = attach(both, first, "u", "weight", ["v"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "cc-large")
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("weight")), "cc-low")
        hooked = attach(large, low, "u", "weight", ["v"])
        small = hooked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).distinct()
        small = materialize(small, "cc-edges")
        release(edges, first, large, low)
        # done when nothing changed: every node hangs on one smaller node, which hangs on none
        now = print_of(small)
        if now == before:
            return small.select(F.col("u").alias("node"), F.col("v").alias("label")) \
                .union(small.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
        edges, before = small, now


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    blocks: int = BLOCKS, bucket: int = BUCKET) -> DataFrame:
    """Per row of ``docs``: id, fingerprint (16 lowercase hex digits), component_id (smallest id of the component).

    Fingerprints link at ``max_bits`` or fewer differing bits; a component is what links reach. Null and empty texts
    have the fingerprint zero, which links like any other. Null ids get a component, but are no component's id unless
    it has no other. Repeated rows give a result each. Very long texts are hashed in pieces of bounded memory.
    """
    prepare(docs.sparkSession)
    rows = materialize(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    distinct = materialize(rows.groupBy("fp").agg(F.min("id").alias("first"), F.count("*").alias("rows")), "simhash-distinct")
    labels = components(links(distinct.select("fp"), max_bits, blocks, bucket))
    labelled = distinct.join(labels, distinct["fp"] == labels["node"], "left").select("fp", "first", "rows", F.coalesce("label", "fp").alias("label"))
    labelled = materialize(labelled, "simhash-labelled")
    heads = materialize(labelled.groupBy("label").agg(F.min("first").alias("component_id"), F.count("*").alias("weight")), "simhash-heads")
    named = materialize(attach(labelled, heads, "label", "weight", ["fp"]).select("fp", "rows", "component_id"), "simhash-named")
    out = attach(rows, named, "fp", "rows", ["id"])
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
