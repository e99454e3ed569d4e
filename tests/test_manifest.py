import datetime as dt
import os
import shutil

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from postlake.operators.marts import file_counts, file_non_null_counts
from postlake.sources import manifest as MF
from postlake.sources.bronze import scan_bronze, write_bronze
from postlake.sources.contract import posting_contract
from postlake.sources.manifest import compact_manifest, read_manifest, update_manifest
from postlake.sources.stream_io import read_stream
from postlake.streaming.ingest import ingest_stream


def _file(path, **cols):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table(cols), path, row_group_size=2)


def _mixed(root):
    _file(f"{root}/batch_date=2024-01-01/batch_hour=05/run_id=a/1.parquet", job_id=["1", "2", "3"], salary_min=[10, None, 30],
          tags=pa.array([[], [], []], pa.list_(pa.null())), title=pa.nulls(3))
    _file(f"{root}/batch_date=2024-01-01/batch_hour=06/run_id=b/1.parquet", job_id=["4", "5"], salary_min=[1.5, None], tags=[["x", None], None],
          title=["t", None], updated_at=pa.array([dt.datetime(2024, 1, 1), None], pa.timestamp("us")), _path=["own", "own"])
    _file(f"{root}/batch_date=2024-01-01/batch_hour=06/run_id=b/2.parquet", job_id=["6"], category=["c"], posted=pa.array([dt.date(2024, 1, 2)]))
    _file(f"{root}/batch_date=2024-01-01/batch_hour=07/run_id=c%3A1/1.parquet", job_id=pa.array([], pa.string()), salary_min=pa.array([], pa.int64()))


@pytest.mark.parametrize("contract", [posting_contract(), None])
def test_executors_read_what_spark_reads(spark, tmp_dir, contract):
    """The way without a path list gives the rows, columns and types of the way with one, also for a root without a manifest."""
    root = tmp_dir + "/bronze"
    _mixed(root)
    update_manifest(spark, root)
    if contract is None:  # a timestamp and a null-typed column have no common type with the others' strings only under a contract
        for name in ("batch_hour=05/run_id=a/1.parquet",):
            shutil.rmtree(os.path.dirname(f"{root}/batch_date=2024-01-01/{name}"))
        update_manifest(spark, root)
    want = scan_bronze(spark, root, contract, with_batch_columns=True)
    key = lambda rows: sorted(map(repr, rows))
    for manifest, paths in ((True, 10_000), (True, 2), (False, 0)):
        got = scan_bronze(spark, root, contract, with_batch_columns=True, manifest=manifest, max_paths=paths)
        assert got.dtypes == want.dtypes
        assert key(got.collect()) == key(want.collect())
    plain = scan_bronze(spark, root, contract, manifest=True, max_paths=0)
    assert "run_id" not in plain.columns and "_path" in plain.columns and plain.count() == want.count() == (6 if contract else 3)


def test_manifest_follows_the_files(spark, tmp_dir):
    """New, replaced and deleted files; an update without changes adds nothing; footers are read once; counts need no data."""
    root = tmp_dir + "/bronze"
    df = spark.createDataFrame([("1", "a"), ("2", "b")], "job_id string, title string")
    ts = dt.datetime(2024, 5, 6, 7)
    assert read_manifest(spark, root).count() == 0
    write_bronze(df, root, "run1", ts)
    update_manifest(spark, root)
    first = {r["path"]: r for r in read_manifest(spark, root).collect()}
    assert sum(r["row_count"] for r in first.values()) == 2 and {r["signature"] for r in first.values()} == {"job_id:string|title:string"}
    parts = lambda: sorted(f for f in os.listdir(f"{root}/_manifest") if f.startswith("part="))
    update_manifest(spark, root)
    assert len(parts()) == 1
    write_bronze(df, root, "run2", ts)
    folder = "batch_date=2024-05-06/batch_hour=07/run_id=run2"
    for _ in range(2):  # a replayed batch has new files and takes the place of its first try
        write_bronze(df.limit(1), root, "run2", ts)
        update_manifest(spark, root, folder, part="run2")
    now = {r["path"]: r for r in read_manifest(spark, root).collect()}
    assert {p: now[p] for p in first} == first and sum(r["row_count"] for r in now.values()) == 3
    on_disk = {os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet") and "_manifest" not in d}
    assert {p.removeprefix("file:") for p in now} == on_disk and len(parts()) == 2
    compact_manifest(spark, root)
    assert len(parts()) == 1 and {r["path"]: r for r in read_manifest(spark, root).collect()} == now
    shutil.rmtree(f"{root}/{folder}")
    update_manifest(spark, root, folder)
    assert {r["path"] for r in read_manifest(spark, root).collect()} == set(first)
    assert scan_bronze(spark, root, manifest=True).count() == scan_bronze(spark, root).count() == 2


def test_ingest_extends_the_manifest(spark, tmp_dir):
    src, root = tmp_dir + "/src", tmp_dir + "/bronze"
    os.makedirs(src)
    for n in "12":
        with open(f"{src}/m{n}.json", "w") as f:
            f.write('{"job_id": "%s", "title": "a"}\n' % n)
        ingest_stream(read_stream(spark, "json", path=src), root, tmp_dir + "/ckpt", available_now=True, manifest=True).awaitTermination()
    listed = read_manifest(spark, root)
    assert listed.agg(F.sum("row_count")).first()[0] == 2
    assert sorted(r["job_id"] for r in scan_bronze(spark, root, manifest=True).collect()) == ["1", "2"]


def test_plan_of_many_folders_collects_none(spark, tmp_dir, monkeypatch):
    """A manifest of 100,000 folders of two signatures: only the signatures and a bounded number of rows reach the driver."""
    root = tmp_dir + "/bronze"
    _file(f"{root}/a/0.parquet", job_id=["1"], n=[1])
    _file(f"{root}/a/1.parquet", job_id=["2"], n=[1.5])
    update_manifest(spark, root)
    real = read_manifest(spark, root)
    more = (real.withColumn("id", F.explode(F.sequence(F.lit(1), F.lit(50_000))))
            .withColumn("path", F.concat(F.lit(f"file:{root}/f"), F.regexp_extract("path", r"(\d).parquet", 1), F.lit("_"), "id", F.lit("/f.parquet"))).drop("id"))
    more.withColumns({"present": F.lit(True), "listed_at": F.lit(1).cast("long")}).write.parquet(f"{root}/_manifest/part=many")
    assert read_manifest(spark, root).select(F.count_distinct(F.regexp_replace("path", "/[^/]*$", ""))).first()[0] == 100_001
    rows, kind = [], type(real)
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda df: (lambda got: (rows.append(len(got)), got)[1])(collect(df)))
    df = scan_bronze(spark, root, manifest=True, max_paths=1_000)
    assert max(rows) <= 1_001
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2 and dict(df.dtypes) == {"job_id": "string", "n": "double"}


def test_opener_paths(tmp_dir):
    _file(tmp_dir + "/a%20b/x y.parquet", n=[1])
    for prefix in ("file:", "file://", ""):
        with MF._opener()(f"{prefix}{tmp_dir}/a%20b/x y.parquet") as fh:
            assert pq.read_table(fh).num_rows == 1


def test_counts_from_footers_are_pushed(spark, tmp_dir):
    """Counts of rows and values come out of the scan; the session's own settings stay as they were."""
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    _file(f"{tmp_dir}/t/1.parquet", a=[1, None, 3], **{"b.c": pa.nulls(3, pa.string())})
    _file(f"{tmp_dir}/t/2.parquet", a=pa.array([], pa.int64()), **{"b.c": pa.array([], pa.string())})
    counts = file_counts(spark, {"t": f"{tmp_dir}/t", "none": f"{tmp_dir}/none"})
    _file(f"{tmp_dir}/v/1.parquet", a=[1, None, 3, None, None], **{"b.c": pa.nulls(5, pa.string())})
    values = file_non_null_counts(spark, f"{tmp_dir}/v", ["a", "b.c"])
    for df, pushed in ((counts, "PushedAggregation: [COUNT(*)]"), (values, "PushedAggregation: [COUNT(*), COUNT(a)")):
        assert pushed in df._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, counts.collect())) == [("none", 0, False), ("t", 3, True)]
    assert sorted(map(tuple, values.collect())) == [("a", 2, 5), ("b.c", 0, 5)]
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
