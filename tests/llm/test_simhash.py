import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from helpers import documents, prose
from postlake.llm import queries, simhash
from postlake.llm.common import prepare

SF = "/root/testdata/sf0.001"


def brute_fingerprint(text, shingle=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    parts = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    ones = Counter(b for p in parts for h in [xxhash.xxh64_intdigest(p.encode(), 42)] for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(parts))


def brute_components(fps, max_bits):
    """fps: id -> fingerprint. Smallest id reachable over links of at most max_bits."""
    left, out = set(fps), {}
    while left:
        seed = min(left)
        seen, todo = {seed}, [seed]
        while todo:
            a = todo.pop()
            near = {b for b in left - seen if (fps[a] ^ fps[b]).bit_count() <= max_bits}
            seen |= near
            todo += near
        out.update(dict.fromkeys(seen, min(seen)))
        left -= seen
    return out


def test_fingerprint_and_spark_agree(spark):
    rng = random.Random(3)
    texts = [None, "", " \n\t", "One", "one two", "a b c", "A É ß x", "a\x0bb\x0cc d", prose(rng, 500), "x " * 1000]
    for t in texts:
        assert simhash.fingerprint(t) == brute_fingerprint(t)
    h = spark.sql("select xxhash64('a b c') as h").first().h
    assert simhash.fingerprint("a b c") == h % 2 ** 64


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(simhash, "_STEP", 7)
    text = prose(random.Random(5), 100)
    assert simhash.fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize("max_bits,blocks,bucket", [(2, 5, 64), (2, 5, 2), (2, 3, 4), (3, 5, 2), (1, 4, 2), (0, 3, 2), (4, 6, 3)])
def test_components_of_planted_fingerprints(spark, max_bits, blocks, bucket):
    prepare(spark)
    rng = random.Random(max_bits * 100 + bucket)
    fps = [rng.getrandbits(64) for _ in range(12)]
    for _ in range(120):  # chains and clusters of neighbours at 0 to 5 bits
        f = rng.choice(fps)
        for b in rng.sample(range(64), rng.randint(0, 5)):
            f ^= 1 << b
        fps.append(f)
    distinct = sorted(set(fps))
    signed = {f: f - 2 ** 64 if f >> 63 else f for f in distinct}
    df = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    links = simhash.links(df, max_bits, blocks, bucket)
    back = {s: f for f, s in signed.items()}
    for r in links.collect():
        assert (back[r.a] ^ back[r.b]).bit_count() <= max_bits and r.a < r.b
    labels = {r.node: r.label for r in simhash.components(links).collect()}
    got = {f: labels.get(s, s) for f, s in signed.items()}
    want = brute_components({s: f for f, s in signed.items()}, max_bits)
    assert {signed[f]: c for f, c in got.items()} == want


def test_components_of_a_long_path(spark):
    prepare(spark)
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    rows = simhash.components(edges).collect()
    assert len(rows) == 201 and {r.label for r in rows} == {0}
    assert simhash.components(edges.limit(0)).count() == 0


def test_documents(spark):
    rng = random.Random(9)
    base = prose(rng, 400)
    rows = [(10, base), (4, base.upper()), (7, base + " tail"), (11, None), (12, ""), (13, "  \n"), (20, prose(rng, 50)), (20, prose(rng, 60)), (4, base.upper()), (None, base)]
    docs = documents(spark, rows, {"fp": 1, "component_id": "clash", "id": 0})
    out = simhash.near_duplicates(docs).collect()
    assert len(out) == len(rows)
    fps = {i: brute_fingerprint(r[1]) for i, r in enumerate(rows)}
    comp = brute_components(fps, 2)
    ids = {c: min((rows[i][0] for i in fps if comp[i] == c and rows[i][0] is not None), default=None) for c in set(comp.values())}
    want = sorted((str(rows[i][0]), f"{fps[i]:016x}", ids[comp[i]]) for i in fps)
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in out) == want
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_query(spark):
    out = queries.op4_simhash(spark, SF)
    docs = {r.doc_id: r.text for r in spark.read.parquet(SF + "/documents.parquet").collect()}
    fps = {i: brute_fingerprint(t) for i, t in docs.items()}
    want = brute_components(fps, 2)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in out.collect()} == {i: (f"{f:016x}", want[i]) for i, f in fps.items()}
