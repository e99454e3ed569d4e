import datetime as dt
import decimal
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from postlake.operators.sequence import ordered_scan, ranged


def _frame(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # key 0 holds about a third of the rows; some null keys
        k = 0 if rnd.random() < 0.34 else (None if rnd.random() < 0.03 else rnd.randint(1, 40))
        v = None if rnd.random() < 0.05 else rnd.randint(0, 50)
        rows.append((i, k, rnd.randint(0, 400), v, rnd.random() < 0.7))
    return spark.createDataFrame(rows, "id long, k int, o int, v int, f boolean")


def _brute(df, keys):
    w = Window.partitionBy(*keys).orderBy(F.col("o").asc_nulls_first(), F.col("id"))
    wr = w.rowsBetween(Window.unboundedPreceding, 0)
    out = (df.withColumn("_idx", F.row_number().over(w) - 1)
             .withColumn("prev_v", F.lag("v").over(w))
             .withColumn("next_v", F.lead("v").over(w))
             .withColumn("max_v", F.max(F.col("v")).over(wr))
             .withColumn("_brk", F.max(F.when(~F.coalesce(F.col("f"), F.lit(False)), F.col("_idx"))).over(wr))
             .withColumn("run_f", F.col("_idx") - F.coalesce(F.col("_brk"), F.lit(-1)))
             .drop("_brk"))
    return out


def _check(spark, keys, parts):
    df = _frame(spark)
    got = ordered_scan(df, keys, ["o", "id"], prev=["v"], next=["v"],
                       running_max=["v"], runs=["f"], num_partitions=parts)
    exp = _brute(df, keys)
    cols = ["id", "_idx", "prev_v", "next_v", "max_v", "run_f"]
    g = sorted(got.select(*cols).collect())
    e = sorted(exp.select(*cols).collect())
    assert len(g) == len(e) == 3000
    assert g == e


def test_scan_keyed_many_ranges(spark):
    _check(spark, ["k"], 13)


def test_scan_no_key(spark):
    _check(spark, [], 11)


def test_scan_one_range(spark):
    _check(spark, ["k"], 1)


def test_scan_small_arrow_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        _check(spark, ["k"], 5)
        _check(spark, [], 3)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_range_count_follows_data_read_not_join_estimates(spark):
    from postlake.operators.sequence import MAX_RANGES, range_count
    a = spark.range(1000).withColumnRenamed("id", "k")
    b = spark.range(1000).withColumnRenamed("id", "k")
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert range_count(a.join(b, "k").join(a, "k")) == floor
    assert range_count(spark.range(10 ** 15)) == MAX_RANGES


def test_tied_rows_are_split_over_ranges(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 20 > 0, F.lit(7)).otherwise(F.col("id")).cast("long").alias("v"))
    rows, cuts = ranged(df, [], ["v"], num_partitions=16)
    sizes = [r["count"] for r in rows.groupBy("_scan_rp").count().collect()]
    assert cuts.count() == 15 and len(sizes) == 16 and max(sizes) < 3 * 20_000 / 16
    text = ordered_scan(df, [], ["v"], prev=["v"], num_partitions=16)._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in text and "Python" not in text and "Cartesian" not in text and "NestedLoop" not in text
    got = sorted((r.v, r._idx, r.prev_v) for r in ordered_scan(df, [], ["v"], prev=["v"], num_partitions=16).collect())
    values = sorted(r.v for r in df.collect())
    assert [g[0] for g in got] == values and sorted(g[1] for g in got) == list(range(20_000))
    assert sorted(g[2] for g in got if g[2] is not None) == values[:-1]


def test_values_stay_exact(spark):
    """Longs above 2**53, far dates, decimals, microseconds, nulls and NaN pass through unchanged."""
    rows = [(None if i % 3 == 0 else "k", i, None if i % 5 == 4 else 2 ** 53 + i, dt.datetime(9999, 12, 31, 23, 59, 59, 999990 + i % 10),
             decimal.Decimal("12345678901234567890.12") + i, float("nan") if i % 4 == 0 else i / 3, dt.date(9999, 12, 31), [i, None]) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, o long, v long, t timestamp_ntz, d decimal(30,2), f double, y date, a array<int>")
    cols = ["v", "t", "d", "f", "y", "a"]
    tops = ["v", "t", "y"]
    got = ordered_scan(df, ["k"], ["o"], prev=cols, next=cols, running_max=tops, num_partitions=7)
    w = Window.partitionBy("k").orderBy("o")
    want = df
    for c in cols:
        want = want.withColumn("prev_" + c, F.lag(c).over(w)).withColumn("next_" + c, F.lead(c).over(w))
    for c in tops:
        want = want.withColumn("max_" + c, F.max(c).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    names = [x + c for x in ("prev_", "next_") for c in cols] + ["max_" + c for c in tops]
    assert {c: t for c, t in got.dtypes if c in names} == {c: t for c, t in want.dtypes if c in names}
    assert sorted(map(repr, got.select("o", *names).collect())) == sorted(map(repr, want.select("o", *names).collect()))


def test_keys_with_nan_and_equal_rows(spark):
    df = spark.createDataFrame([(float("nan"), 1), (float("nan"), 2), (None, 1), (None, 1), (0.5, 3)] * 9, "k double, o int")
    got = ordered_scan(df, ["k"], ["o"], num_partitions=6).groupBy("k").agg(F.max("_idx").alias("m"), F.count_distinct("_idx").alias("n")).collect()
    assert sorted((str(r.k), r.m, r.n) for r in got) == [("0.5", 8, 9), ("None", 17, 18), ("nan", 17, 18)]


def test_empty_frame(spark):
    assert ordered_scan(spark.range(0), [], ["id"], prev=["id"], running_max=["id"]).collect() == []


def test_search_in_many_splitters(spark, monkeypatch):
    from postlake.operators import sequence
    monkeypatch.setattr(sequence, "SPELLED_OUT", 2)
    monkeypatch.setattr(sequence, "LOCAL_CUTS", 2)
    _check(spark, ["k"], 13)
    _check(spark, [], 90)


def test_torn_keys_only_are_aggregated(spark):
    """Keys that no splitter names hand nothing on; all parts of a key that lies in many ranges do."""
    df = spark.range(4000).select(F.when(F.col("id") < 3000, F.lit(0)).otherwise(F.col("id")).alias("k"), (F.col("id") * 7 % 4001).alias("o"))
    _, cuts = ranged(df, ["k"], ["o"], num_partitions=8)
    assert cuts.count() == 7 and cuts.where("_scan_key.k = 0").count() >= 5
    w = Window.partitionBy("k").orderBy("o")
    got = ordered_scan(df, ["k"], ["o"], prev=["o"], next=["o"], num_partitions=8).select("k", "o", "_idx", "prev_o", "next_o")
    want = df.select("k", "o", (F.row_number().over(w) - 1).cast("long"), F.lag("o").over(w), F.lead("o").over(w))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_nulls_last(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else i % 9) for i in range(200)], "id long, v int")
    got = sorted(ordered_scan(df, [], ["v nulls last", "id"], prev=["v"], num_partitions=6).select("_idx", "v", "prev_v").collect())
    values = sorted((r.v for r in df.collect()), key=lambda v: (v is None, v or 0))
    assert [g.v for g in got] == values and [g.prev_v for g in got] == [None, *values[:-1]]


def test_ranges_are_sorted_once(spark):
    """What ranges hand on is read from their stored ends: the table itself is neither sorted nor shuffled again."""
    df = spark.range(5000).select((F.col("id") % 50).alias("v"), "id")
    out = ordered_scan(df, [], ["v", "id"], prev=["v"], next=["id"], running_max=["id"], sums=["v"], num_partitions=6)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    rows = sorted(df.collect())
    got = sorted((r._idx, r.v, r.id, r.prev_v, r.next_id, r.max_id, r.sum_v) for r in out.collect())
    want = [(i, v, n, rows[i - 1][0] if i else None, rows[i + 1][1] if i + 1 < len(rows) else None, max(r[1] for r in rows[:i + 1]), sum(r[0] for r in rows[:i + 1]))
            for i, (v, n) in enumerate(rows)]
    assert got == want
