import os
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as P
from postlake.llm import decontam, quality, simhash
from postlake.llm.common import materialize, prepare, scratch_path
from postlake.llm.mixing import plan_mix
from helpers import prose
from test_decontam import norm
from test_mixing import targets
from test_simhash import brute_components, brute_fingerprint
from test_tokens import want_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    prepare(spark)
    docs = spark.read.parquet(SF + "/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        out.append(materialize(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(stages):
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes


def test_quality_stage(spark, stages):
    labels = spark.read.parquet(SF + "/labels.parquet")
    want = {r.doc_id for r in quality.score_quality(stages[0], labels).where("predicted = 1").collect()}
    assert set(texts(stages[1])) == want and 0 < len(want) < stages[0].count()


def test_near_duplicate_stage(stages):
    before, after = texts(stages[1]), texts(stages[2])
    groups = brute_components({i: brute_fingerprint(t) for i, t in before.items()}, 2)
    assert set(after) == {i for i, c in groups.items() if i == c} and stages[2].count() == len(after) < len(before)
    assert simhash.MAX_BITS == 2 and simhash.SHINGLE == 3


def test_decontamination_stage(spark, stages):
    before, after = texts(stages[2]), texts(stages[3])
    items = [norm(r.text) for r in spark.read.parquet(SF + "/benchmark.parquet").collect()]
    holds = {i for i, t in before.items() if any(x in norm(t) for x in items)}
    gone = set(before) - set(after)
    found = {r.doc_id for r in decontam.contaminated(stages[2], spark.read.parquet(SF + "/benchmark.parquet")).collect()}
    assert holds <= gone == found


def test_mixing_stage(stages):
    size, taken = Counter(), Counter()
    before = {r.doc_id: r for r in stages[3].collect()}
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    for r in before.values():
        size[r.source] += words(r.text)
    for r in stages[4].collect():
        taken[r.source] += words(r.text)
        assert before[r.doc_id].text.startswith(r.text) and r.n_chars == len(r.text)
    for s, want in targets(dict(size)).items():
        assert abs(taken[s] - want) < 1


def test_token_stage(stages):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.tokenizer_path())
    rows = [(r.doc_id, r.text) for r in stages[4].collect()]
    want = want_rows(rows, lambda x: t.encode(x or "", add_special_tokens=False).ids)
    assert [tuple(r) for r in stages[5].orderBy("start").collect()] == want


def test_run_and_registration(spark, stages):
    assert sorted(map(tuple, E.queries()["pipeline"](spark, SF).collect())) == sorted(map(tuple, stages[5].collect()))
    assert sum(n.startswith("op") for n in E.queries()) == 13 and "pipeline" not in E.oracle_sql()


def test_stages_with_nothing(spark, stages):
    empty = stages[0].limit(0)
    for name, stage in P.STAGES:
        assert stage(spark, empty, SF).collect() == []


def test_near_duplicate_stage_without_ids(spark):
    from helpers import documents

    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (None, "q w e r t y u"), (3, "a b c d e f"), (3, "a b c d e f"), (9, "a b c d e f"), (4, None)]
    out = P.drop_near_duplicates(spark, documents(spark, rows), SF).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in out) == [("3", "a b c d e f"), ("4", "None"), ("None", "q w e r t y u")]


def test_near_duplicate_stage_shared_ids(spark):
    from helpers import documents

    rng = random.Random(5)
    a, b, c, long = prose(rng, 12), prose(rng, 12), prose(rng, 12), prose(rng, 400)
    near = next(t for t in (" ".join(w for j, w in enumerate(long.split()) if j != i) for i in range(400))
                if 0 < (simhash.fingerprint(t) ^ simhash.fingerprint(long)).bit_count() <= simhash.MAX_BITS)
    rows = [(5, a), (5, b), (5, b), (2, c), (6, a), (7, c), (7, "x " + b), (None, long), (None, near), (None, long)]
    for df in (documents(spark, rows), documents(spark, rows[::-1]).repartition(3)):
        out = [(r.doc_id, r.text) for r in P.drop_near_duplicates(spark, df, SF).collect()]
        assert len(out) == 5 and set(out) - {(None, long), (None, near)} == {(5, a), (5, b), (2, c), (7, "x " + b)}


#: Names that the stages and operators use inside or give their results.
CLASHES = ("score predicted held_out key _key no_id id hash row _row _row_id mix_shard mix_epoch own_size own_skey skey size draws draw part found label "
           "fp component_id fingerprint start end edits windows item item_id n_tokens turn _id _draw _part _own_size good lines rows quota block").split()


@pytest.mark.parametrize("number", range(4))
def test_stages_keep_columns_of_any_name(spark, stages, number):
    docs = stages[number]
    wide = docs.select("*", *[F.concat(F.lit(f"{c} of "), F.col("doc_id")).alias(c) for c in CLASHES], F.lit(3).alias("MIX_Shard2"))
    out = P.STAGES[number][1](spark, wide, SF)
    assert out.columns == wide.columns and out.dtypes == wide.dtypes
    rows = out.collect()
    assert len(rows) == stages[number + 1].count()
    assert all(r[c] == f"{c} of {r.doc_id}" for r in rows for c in CLASHES)


def test_token_stage_with_columns_of_any_name(spark, stages):
    docs = stages[1].limit(20)
    wide = docs.select("*", *[F.lit("x").alias(c) for c in CLASHES])
    assert sorted(map(tuple, P.write_token_files(spark, wide, SF).collect())) == sorted(map(tuple, P.write_token_files(spark, docs, SF).collect()))


def text_shuffles(df):
    """Exchanges that move texts: lines of the formatted plan's details."""
    plan = df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return [x for x in re.split(r"\n\(\d+\) ", plan) if re.match(r"Exchange", x) and re.search(r"Input \[\d+\]: .*\b(text|first)#", x)], plan


def test_texts_are_shuffled_once(spark, stages, monkeypatch):
    monkeypatch.setattr(P.mixing, "plan_mix", lambda *a, **k: materialize(plan_mix(*a, **k), "test-plan"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved, plan = text_shuffles(P.drop_near_duplicates(spark, stages[1], SF))
        assert len(moved) == 1, plan
        assert text_shuffles(P.drop_benchmark(spark, stages[2], SF))[0] == []
        moved, plan = text_shuffles(P.mix_sources(spark, stages[3], SF))
        assert len(moved) == 2, plan  # to the plan of the mix, and to the shards
        assert plan.count(") ArrowEvalPython") == 2, plan  # the words are counted once and cut once
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_run_deletes_tables_it_has_replaced(spark, stages, tmp_dir):
    import glob

    folder = os.path.dirname(scratch_path(spark, "test")).removeprefix("file:")
    before = set(glob.glob(folder + "/pipeline-*"))
    P.run(spark, SF).count()
    assert [x.split("/")[-1].split("-")[1] for x in set(glob.glob(folder + "/pipeline-*")) - before] == ["tokens"]
