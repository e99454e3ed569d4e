import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postlake.llm import common


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \t\n\x0b\x0cé ", max_size=12)), max_size=8))
def test_word_counts(texts):
    want = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    assert common.word_counts(pa.array(texts, pa.string())).tolist() == want


def test_word_counts_of_a_slice():
    a = pa.array(["x", "a b", None, "c d e", ""], pa.string()).slice(1, 3)
    assert common.word_counts(a).tolist() == [2, 0, 3]


def test_running_sum(spark):
    common.prepare(spark)
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("v"))
    rows = common.running_sum(df.repartition(7), ["k"], {"before": "v", "twice": "v"}, "test-sum").orderBy("k").collect()
    total = 0
    for r in rows:
        assert r.before == r.twice == total
        total += r.v or 0
    assert common.running_sum(df.limit(0), ["k"], {"before": "v"}, "test-sum").count() == 0


@pytest.mark.parametrize("share", [10_000, 4])
def test_attach_hot_cold_null(spark, monkeypatch, share):
    common.prepare(spark)
    monkeypatch.setattr(common, "HOT_SHARE", share)
    left = spark.createDataFrame([(i, None if i % 10 == 0 else "hot" if i % 2 else f"k{i % 7}") for i in range(200)] + [(500, "alone")], "i long, k string")
    right = left.where("k is not null and k <> 'alone'").groupBy("k").agg(F.count("*").alias("n")).withColumn("name", F.upper("k"))
    out = common.attach(left, common.materialize(right, "test-right"), "k", "n", ["i"])
    rows = out.collect()
    assert out.columns == ["i", "k", "name"] and len(rows) == 201
    assert all(r.name == (None if r.k in (None, "alone") else r.k.upper()) for r in rows)


def test_blobs_round_trip(spark, tmp_dir):
    common.prepare(spark)
    data = [bytes(range(256)), b"\n\r\n", b"\xff" * 1000]
    df = spark.createDataFrame([(bytearray(d),) for d in data], "b binary").repartition(1)
    common.write_blobs(df, "b", tmp_dir + "/x", b"\xb1\xea\x92\x8f")
    got = sorted(bytes(r.content) for r in common.read_blobs(spark, tmp_dir + "/x").collect())
    assert got == sorted(d + b"\xb1\xea\x92\x8f" for d in data)
