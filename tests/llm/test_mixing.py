import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from helpers import documents
from postlake.llm import mixing, queries

SF = "/root/testdata/sf0.001"


def targets(sizes):
    """Brute force of the target rule: sources by code point, null last."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in full)
        open_ = sum(weight[s] for s in names if s not in full)
        out = {s: 2.0 * sizes[s] if s in full else rest * weight[s] / open_ for s in names}
        new = {s for s in names if s not in full and out[s] > 2 * sizes[s]}
        if not new:
            return out
        full |= new


def check(spark, docs):
    rows = docs.select("doc_id", "text", "source").collect()
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows]
    sums = Counter()
    for r, n in zip(rows, size):
        sums[r.source] += n
    want = targets(dict(sums))
    plan = mixing.plan_mix(mixing.document_sizes(docs), block_words=50, shards=8).toPandas()
    each = plan.loc[plan.index.repeat(plan["rows"])]
    assert sorted(each["size"]) == sorted(size)
    taken = Counter()
    for _, p in plan.iterrows():
        words = sum(d["words"] for d in p["draws"])
        assert words <= 2 * p["size"] and all(0 <= d["shard"] < 8 for d in p["draws"])
        source = None if p["skey"] == "b" else p["skey"][1:]
        taken[source] += words * p["rows"]
        assert p["target"] == pytest.approx(want[source]) and p["source_words"] == sums[source]
    for s in sums:
        assert abs(taken[s] - want[s]) <= 0.5 + 2 * (plan["rows"].max() - 1)
    return plan


def test_targets_and_words(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "w " * int(rng.integers(0, 60)), "en", f"s{min(int(rng.integers(0, 9)), 6)}") for i in range(300)]
    rows += [(1000, None, "en", "s1"), (1001, " \n ", "en", "s1"), (1002, "a b c", "en", None), (1003, "x " * 5000, "en", "S")]
    check(spark, documents(spark, rows, {"size": 1, "skey": "clash", "id": 2}))


def test_reruns_agree_and_partitions_do_not_matter(spark):
    docs = documents(spark, [(i, "a b c " * (i % 9), "en", f"s{i % 4}") for i in range(200)])
    key = lambda p: sorted((r.doc_id, [tuple(d.values()) if isinstance(d, dict) else tuple(d) for d in r.draws]) for r in p.itertuples())
    assert key(check(spark, docs)) == key(check(spark, docs.repartition(5)))


def test_repeated_rows_are_taken_alike(spark):
    check(spark, documents(spark, [(7, "a b c d", "en", "s")] * 5 + [(8, "e f", "en", "s"), (None, "g h", "en", "t"), (None, "g h", "en", "t")]))


def test_quotas_are_split_exactly(spark):
    quotas = spark.createDataFrame([(i, int(b)) for i, b in enumerate([1000, 0, 3, 77, 1, 250])], "sid long, blocks long")
    shares = mixing.split_quotas(quotas, 100)
    pdf = shares.toPandas()
    assert pdf.groupby("sid")["taken"].sum().to_dict() == {0: 1000, 2: 3, 3: 77, 4: 1, 5: 250}
    per = pdf.groupby("shard")["taken"].sum().reindex(range(100), fill_value=0)
    assert per.max() - per.min() <= 2
    blocks = mixing.draw_blocks(shares).toPandas()
    assert len(blocks) == 1331 and not blocks.duplicated(["sid", "block"]).any()
    for sid, own in blocks.groupby("sid"):
        assert sorted(own["block"]) == list(range(len(own)))


def test_split_has_the_hypergeometric_mean(spark):
    quotas = spark.createDataFrame([(0, 60), (1, 40)], "sid long, blocks long")
    half = [mixing.split_quotas(quotas, 2, seed=s).where("sid = 0 and shard = 0").first().taken for s in range(12)]
    assert abs(np.mean(half) - 30) < 3 and len(set(half)) > 1


def test_mix_returns_documents(spark):
    rows = [(i, f"w{i} " * (i + 1), "en", f"s{i % 3}") for i in range(40)] + [(99, "", "en", "s0"), (98, None, "en", None)]
    docs = documents(spark, rows, {"mix_shard": "clash"})
    plan = mixing.plan_mix(mixing.document_sizes(docs), shards=4).toPandas()
    want = {r.doc_id: sum(d["words"] for d in r.draws) for r in plan.itertuples()}
    mixed = mixing.mix(docs, shards=4)
    got = Counter()
    texts = {r[0]: r[1] for r in rows}
    for r in mixed.collect():
        got[r.doc_id] += len(r.text.split())
        assert texts[r.doc_id].startswith(r.text) and r.mix_shard in range(4)
    assert got == {k: v for k, v in want.items() if v}
    assert mixed.columns == [c for c in docs.columns if c != "mix_shard"] + ["mix_shard", "mix_epoch"]


@pytest.mark.parametrize("rows", [[], [(1, "", "en", "a"), (2, None, "en", None)]])
def test_nothing_to_mix(spark, rows):
    docs = documents(spark, rows)
    plan = mixing.plan_mix(mixing.document_sizes(docs)).collect()
    assert len(plan) == len(rows) and all(r.draws == [] and r.target == 0 for r in plan)
    assert mixing.mix(docs).count() == 0


def test_query(spark):
    got = queries.op2_mixing(spark, SF).toPandas()
    docs = pd.read_parquet(SF + "/documents.parquet")
    size = docs["text"].map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")))
    both = got.merge(pd.DataFrame({"doc_id": docs["doc_id"], "source": docs["source"], "want": size}), on="doc_id")
    assert len(both) == len(docs) and (both["want"] == both["size"]).all()
    want = targets(size.groupby(docs["source"]).sum().to_dict())
    for s, own in both.groupby("source"):
        assert own["target"].iloc[0] == pytest.approx(want[s]) and abs(own["taken"].sum() - want[s]) < 1
    assert (both["taken"] <= 2 * both["size"]).all()
    assert {c: t for c, t in queries.op2_mixing(spark, SF).dtypes} == {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"}


def test_weights_cycle(spark):
    sizes = spark.createDataFrame([(f"a{i:02d}", 1000) for i in range(7)], "skey string, size long")
    got = {r.skey: r.target for r in mixing.source_targets(sizes).collect()}
    want = targets({f"{i:02d}": 1000 for i in range(7)})
    assert got == pytest.approx({f"a{k}": v for k, v in want.items()})
