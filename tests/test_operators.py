import datetime as dt

import pytest
from pyspark.sql import functions as F

from postlake.operators import checks as C
from postlake.operators import marts as M
from postlake.operators.columns import cast_columns, nullcheck, search, select_star, star
from postlake.operators.relational import two_way_except, union_relations
from postlake.operators.reshape import (date_spine, deduplicate, generate_series, latest_postings,
                                        pivot, unpivot)


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def test_deduplicate_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, 10, "a"), (1, 20, "b"), (1, None, "c"), (2, None, "d"), (3, 5, None), (3, 5, "e")],
        "k int, ts int, v string")
    out = deduplicate(df, ["k"], [F.col("ts").desc_nulls_last(), F.col("v").asc_nulls_last()])
    assert rows(out) == [(1, 20, "b"), (2, None, "d"), (3, 5, "e")]


def test_dedup_plan_limits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    plan = deduplicate(df, ["k"], [F.col("ts").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_latest_postings_typed(spark):
    df = spark.createDataFrame(
        [("j1", 1, "Hạn 30/12", "2024-01-02"), ("j1", 2, None, "x"), ("j2", None, None, None)],
        "job_id string, crawled_at long, deadline string, posted_at string")
    for c in ["title", "company", "source", "url", "company_url", "logo_url", "salary", "location",
              "experience", "job_description", "job_requirement", "job_benefit", "updated_at"]:
        df = df.withColumn(c, F.lit(None).cast("string"))
    for c in ["is_urgent", "is_highlight", "is_flash", "company_verified"]:
        df = df.withColumn(c, F.lit(False))
    df = df.withColumn("tags", F.array().cast("array<string>")).withColumn("working_times", F.col("tags"))
    out = latest_postings(df)
    assert len(out.columns) == 23
    got = {r["job_id"]: (r["crawled_at"], r["deadline"], r["posted_at"]) for r in out.collect()}
    assert got == {"j1": (2, None, None), "j2": (None, None, None)}


def test_pivot_fills_else_value(spark):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "red"), ("M", "red"), ("L", "blue's")],
                               "size string, color string")
    out = pivot(df, ["size"], "color", ["red", "blue", "blue's"])
    assert rows(out) == [("L", 0, 0, 1), ("M", 1, 0, 0), ("S", 2, 1, 0)]
    slug = pivot(df, ["size"], "color", ["blue's"], quote_identifiers=False, prefix="c ")
    assert slug.columns == ["size", "c_blues"]


def test_unpivot_casts_booleans(spark):
    df = spark.createDataFrame([(1, "x", True, 2.5)], "id int, name string, flag boolean, amount double")
    out = unpivot(df, exclude=["ID"], remove=["amount"])
    assert rows(out) == [(1, "flag", "true"), (1, "name", "x")]


def test_generate_series_and_spine(spark):
    assert [r[0] for r in generate_series(spark, 3).collect()] == [1, 2, 3]
    with pytest.raises(ValueError):
        generate_series(spark, 0)
    days = [r[0] for r in date_spine(spark, "day", dt.date(2018, 1, 1), dt.date(2018, 1, 10)).collect()]
    assert days[0] == dt.date(2018, 1, 1) and days[-1] == dt.date(2018, 1, 9) and len(days) == 9
    months = date_spine(spark, "month", dt.date(2018, 1, 31), dt.date(2018, 4, 1)).collect()
    assert [r[0] for r in months] == [dt.date(2018, 1, 31), dt.date(2018, 2, 28), dt.date(2018, 3, 31)]
    assert date_spine(spark, "day", dt.date(2018, 1, 1), dt.date(2018, 1, 1)).count() == 0


def test_columns_helpers(spark):
    df = spark.createDataFrame([(1, "", "a"), (2, "b", None)], "id int, f1 string, F2 string")
    assert [c for c in select_star(df, except_=["f2"]).columns] == ["id", "f1"]
    assert select_star(df, except_=["ID"], prefix="p_").columns == ["p_f1", "p_F2"]
    assert star(df, except_=["id", "f1", "f2"]) == []
    assert rows(nullcheck(df)) == [(1, None, "a"), (2, "b", None)]
    assert rows(search(df, "F2", "A")) == [(1, "", "a")]
    assert cast_columns(df, {"id": "string", "f1": "int"}).dtypes == [("id", "string"), ("f1", "int")]


def test_union_relations(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([(2.5, "red")], "ID double, color string")
    out = union_relations([("a", a), ("b", b)])
    assert out.columns == ["_dbt_source_relation", "id", "name", "color"]
    assert rows(out) == [("a", 1, "x", None), ("b", 2, None, "red")]  # first-seen type wins
    out = union_relations([("a", a), ("b", b)], column_override={"id": "double"}, exclude=["name"],
                          source_column_name=None)
    assert rows(out) == [(1.0, None), (2.5, "red")]
    with pytest.raises(ValueError):
        union_relations([("a", a)], include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        union_relations([("a", a)], include=["nope"])


def test_checks_ranges_gaps(spark):
    df = spark.createDataFrame([("a", 0, 5), ("a", 5, 10), ("a", 12, 12), ("b", 0, 3), ("b", 2, None)],
                               "p string, lo int, hi int")
    allowed = C.mutually_exclusive_ranges(df, "lo", "hi", ["p"]).rows
    assert rows(allowed, "partition_by_col", "lower_bound") == [("a", 12), ("b", 0), ("b", 2)]
    zero_ok = C.mutually_exclusive_ranges(df, "lo", "hi", ["p"], zero_length_range_allowed=True).rows
    assert rows(zero_ok, "partition_by_col", "lower_bound") == [("b", 0), ("b", 2)]
    required = C.mutually_exclusive_ranges(df, "lo", "hi", ["p"], gaps="required", num_partitions=3).rows
    assert ("a", 0) in rows(required, "partition_by_col", "lower_bound")
    with pytest.raises(ValueError):
        C.mutually_exclusive_ranges(df, "lo", "hi", gaps="sometimes")


def test_sequential_values(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (4,), (None,)], "v int")
    assert rows(C.sequential_values(df, "v", num_partitions=3).rows) == [(2, 2), (4, 2)]
    ts = spark.createDataFrame([(dt.datetime(2024, 1, d),) for d in (1, 2, 4)], "t timestamp")
    out = C.sequential_values(ts, "t", 1, datepart="day").rows
    assert rows(out) == [(dt.datetime(2024, 1, 4), dt.datetime(2024, 1, 2))]


def test_count_comparisons(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "g string")
    b = spark.createDataFrame([("x",), ("z",)], "g string")
    eq = C.equal_rowcount(a, b, ["g"])
    assert C.summarize(eq).first()["failures"] == 1 + 1 + 1
    strict = C.equal_rowcount(a, b, ["g"], strict_reference=True)
    assert C.summarize(strict).first()["failures"] == 1
    fewer = C.fewer_rows_than(b, a)
    assert fewer.rows.first()["row_count_delta"] == 0
    same = C.fewer_rows_than(a, a)
    assert same.rows.first()["row_count_delta"] == 1


def test_summary_thresholds(spark):
    df = spark.createDataFrame([(1,), (None,), (None,)], "v int")
    s = C.summarize(C.not_null(df, "v"), warn_if=">1", error_if=">5").first()
    assert (s["failures"], s["should_warn"], s["should_error"]) == (2, True, False)


def test_group_checks(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1), ("b", 1), ("c", 1), ("c", 2)],
                               "g string, v int")
    assert rows(C.at_least_one(df, "v", ["g"]).rows) == [("a", 0)]
    assert rows(C.not_constant(df, "v", ["g"]).rows) == [("b", 1)]
    npp = C.not_null_proportion(df, "v", at_least=0.9, group_by=["g"]).rows
    assert rows(npp) == [("a", 0.0)]
    now = dt.datetime(2024, 1, 10)
    r = spark.createDataFrame([("x", dt.datetime(2024, 1, 9, 12)), ("y", dt.datetime(2024, 1, 1)), ("z", None)],
                              "g string, t timestamp")
    assert rows(C.recency(r, "t", "day", 1, group_by=["g"], now=now).rows, "g") == [("y",)]
    assert rows(C.recency(r, "t", "day", 1, ignore_time_component=True, group_by=["g"], now=now).rows, "g") == [("y",)]


def test_box_stats_and_histogram(spark):
    vals = [(1.0,), (2.0,), (3.0,), (4.0,), (100.0,), (None,)]
    df = spark.createDataFrame(vals, "v double")
    b = M.box_stats(df, [], "v").first()
    assert (b["n"], b["q1"], b["median"], b["q3"], b["max"]) == (5, 2.0, 3.0, 4.0, 100.0)
    assert (b["upper_whisker"], b["outliers"]) == (4.0, 1)
    h = M.histogram(df, "v", 4)
    assert sum(r["n"] for r in h.collect()) == 5
    assert rows(h, "bucket", "n") == [(1, 4), (4, 1)]


def test_single_value_null_is_kept(spark):
    df = spark.createDataFrame([(None,)], "v int")
    assert M.single_value(df, default=7).first()["value"] is None
    assert M.single_value(df.where("false"), default=7).first()["value"] == 7


def test_exact_quantiles_null_group_and_hot_group(spark):
    import random
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.6 else (None if rnd.random() < 0.2 else "g%d" % rnd.randint(1, 5)),
             float(rnd.randint(0, 1000))) for _ in range(2000)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: (r["q1"], r["median"], r["q3"]) for r in
           M.exact_quantiles(df, ["g"], "v", [0.25, 0.5, 0.75], ["q1", "median", "q3"]).collect()}
    exp = {r["g"]: (r["q1"], r["m"], r["q3"]) for r in df.groupBy("g").agg(
        F.percentile("v", 0.25).alias("q1"), F.percentile("v", 0.5).alias("m"),
        F.percentile("v", 0.75).alias("q3")).collect()}
    assert set(got) == set(exp) and None in got
    for k in exp:
        assert all(abs(a - b) < 1e-9 for a, b in zip(got[k], exp[k]))


def test_not_empty_string_reference_rows(spark):
    rows = [(1, "not an empty string"), (2, "also not an empty string"),
            (3, "string with trailing whitespace  "), (4, "   "), (5, ""), (6, None)]
    df = spark.createDataFrame(rows, "id int, s string")
    assert C.not_empty_string(df, "s").rows.count() == 2            # ids 4 and 5
    assert C.not_empty_string(df, "s", trim_whitespace=False).rows.count() == 1


def test_single_value_reference_cases(spark):
    df = spark.createDataFrame([(1, 4), (2, 5), (3, 6)], "id int, di int")
    assert M.single_value(df.agg(F.min("id"))).first()["value"] == 1
    assert M.single_value(df.agg(F.max("di"))).first()["value"] == 6
    empty = df.where("false").select("id")
    assert M.single_value(empty, default=123456).first()["value"] == 123456
    assert M.single_value(empty.select(F.col("id").cast("string")), default="fallback").first()["value"] == "fallback"
    got = M.single_value(empty.select(F.lit(None).cast("timestamp")), default="2022-01-01").first()["value"]
    assert got == dt.datetime(2022, 1, 1)


def test_generate_series_reference(spark):
    assert [r[0] for r in generate_series(spark, 10).collect()] == list(range(1, 11))


def test_deduplicate_order_text(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, None, "c"), (2, 5, "d")], "k int, version int, v string")
    assert rows(deduplicate(df, ["k"], ["version desc"]), "k", "v") == [(1, "b"), (2, "d")]
    assert rows(deduplicate(df, ["k"], ["version desc nulls first"]), "k", "v") == [(1, "b"), (2, "c")]
    with pytest.raises(ValueError):
        deduplicate(df, ["k"], ["version sideways"])


def test_column_values_reference_shape(spark):
    vals = ["a", "b", "c", "d", "e", "f"] + ["g"] * 5
    df = spark.createDataFrame([(v,) for v in vals], "field string")
    assert [r[0] for r in M.column_values(df, "field", max_records=1).collect()] == ["g"]
    assert [r[0] for r in M.column_values(df, "field", order_by="field desc", max_records=2).collect()] == ["g", "f"]
    assert [r[0] for r in M.column_values(df, "field", order_by="count(*) asc, value").collect()][:2] == ["a", "b"]
    assert [r[0] for r in M.column_values(None, "field", default=["x"], spark=spark).collect()] == ["x"]
    with pytest.raises(ValueError):
        M.column_values(None, "field", spark=spark)


def test_box_stats_approx_close_to_exact(spark):
    df = spark.range(1, 1001).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v"))
    ex = {r["g"]: r for r in M.box_stats(df, ["g"], "v").collect()}
    ap = {r["g"]: r for r in M.box_stats(df, ["g"], "v", approx=True).collect()}
    for g in ex:
        assert ex[g]["n"] == ap[g]["n"]
        assert abs(ex[g]["median"] - ap[g]["median"]) <= 3


def test_union_by_prefix(spark):
    from postlake.operators.relational import union_by_prefix
    spark.createDataFrame([(1,)], "a int").createOrReplaceTempView("events_20180101")
    spark.createDataFrame([(2,)], "a int").createOrReplaceTempView("events_20180102")
    spark.createDataFrame([(3,)], "a int").createOrReplaceTempView("events_skip")
    out = union_by_prefix(spark, "events_2018", source_column_name="src")
    assert rows(out) == [("events_20180101", 1), ("events_20180102", 2)]


def test_table_counts_and_describe(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    df.createOrReplaceTempView("tc_present")
    got = {r["table_name"]: (r["row_count"], r["healthy"])
           for r in M.table_counts(spark, ["tc_present", "tc_missing"]).collect()}
    assert got == {"tc_present": (2, True), "tc_missing": (0, False)}
    assert rows(M.describe(df)) == [(1, "id", "int", True), (2, "name", "string", True)]


def test_range_checks_beyond_double_precision_and_open_ended(spark):
    base = 2 ** 53
    seq = spark.createDataFrame([(base + i,) for i in range(1, 10)], "v long")
    assert C.sequential_values(seq, "v", num_partitions=1).rows.collect() == []
    assert C.sequential_values(seq.where(f"v <> {base + 4}"), "v", num_partitions=3).rows.collect() == [(base + 5, base + 3)]
    chain = spark.createDataFrame([(base + i, base + i + 1) for i in range(6)], "lo long, hi long")
    assert C.mutually_exclusive_ranges(chain, "lo", "hi", gaps="not_allowed", num_partitions=1).rows.collect() == []
    far = spark.createDataFrame([("a", dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1)), ("a", dt.datetime(2021, 1, 1), dt.datetime(9999, 12, 31)),
                                 ("b", dt.datetime(2020, 1, 1), dt.datetime(9999, 12, 31)), ("b", dt.datetime(2022, 1, 1), None)],
                                "k string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    bad = C.mutually_exclusive_ranges(far, "valid_from", "valid_to", ["k"]).rows.collect()
    assert sorted((r.partition_by_col, r.lower_bound.year) for r in bad) == [("b", 2020), ("b", 2022)]
    assert C.sequential_values(far, "valid_to", 1, "day", ["k"]).rows.count() == 1


def test_box_stats_of_a_shared_value(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 20 > 0, 7.0).otherwise(F.col("id").cast("double")).alias("v"), (F.col("id") % 2).alias("g"))
    df = df.union(spark.createDataFrame([(None, 0), (float("inf"), 1), (-0.0, 0), (0.0, 0)], "v double, g long"))
    for g, own in ((0, df.where("g = 0")), (1, df.where("g = 1"))):
        values = sorted(r.v for r in own.where("v is not null").collect())
        r = M.box_stats(df, ["g"], "v").where(F.col("g") == g).first()
        assert (r.n, r.min, r.max, r.q1, r.median, r.q3) == (len(values), values[0], values[-1], 7.0, 7.0, 7.0)
        assert r.outliers == sum(v != 7.0 for v in values) and r.lower_whisker == r.upper_whisker == 7.0
    empty = M.box_stats(df.where("v > 1e9 and v < 1e9"), [], "v").first()
    assert empty.n == 0 and empty.median is None


def test_selection_of_odd_numbers(spark):
    import math
    import random

    import numpy as np

    rnd = random.Random(11)
    inf, nan = float("inf"), float("nan")
    lists = {
        "wide": [rnd.choice([-1, 1]) * 10.0 ** rnd.uniform(-300, 300) for _ in range(3000)],
        "close": [1e15 + rnd.randint(0, 3000) / 8 for _ in range(3000)],
        "outlier": [rnd.random() for _ in range(2000)] + [1e300, -1e300],
        "tiny": [5e-324 * rnd.randint(-9, 9) for _ in range(500)],
        "odd": [nan, inf, -inf, 0.0, -0.0, 1.0, nan, None],
        "one": [3.25], "none": [nan, None], "halves": [float(i % 2) for i in range(1001)]}
    df = spark.createDataFrame([(k, v) for k, vs in lists.items() for v in vs], "g string, v double").repartition(5)
    got = {r.g: r for r in M.box_stats(df, ["g"], "v").collect()}
    assert set(got) == set(lists) - {"none"}
    for g, r in got.items():
        own = np.sort([v for v in lists[g] if v is not None and not math.isnan(v)])
        want = []
        for p in (0.25, 0.5, 0.75):
            at = (len(own) - 1) * p
            lo, hi = own[math.floor(at)], own[math.ceil(at)]
            want.append(float(lo if lo == hi else lo + (hi - lo) * (at - math.floor(at))))
        assert (r.n, r.min, r.max) == (len(own), own[0], own[-1])
        assert [r.q1, r.median, r.q3] == want, g
        alone = M.box_stats(df.where(F.col("g") == g), [], "v").first()
        assert tuple(alone) == tuple(r)[1:]


def test_selection_with_many_groups(spark, monkeypatch):
    df = spark.range(3000).select((F.col("id") % 101).alias("g"), (F.col("id") * 7919 % 3001).cast("double").alias("v"))
    want = sorted(map(tuple, M.exact_quantiles(df, ["g"], "v", [0.1, 0.5]).collect()))
    monkeypatch.setattr(M, "LOCAL_GROUPS", 50)
    monkeypatch.setattr(M, "SLICES", 4)
    assert sorted(map(tuple, M.exact_quantiles(df, ["g"], "v", [0.1, 0.5]).collect())) == want
    exact = df.groupBy("g").agg(F.percentile("v", 0.1), F.percentile("v", 0.5))
    for got, other in zip(want, sorted(map(tuple, exact.collect()))):
        assert got == pytest.approx(other)


def test_column_values_defaults_and_order(spark):
    df = spark.createDataFrame([("a", 3), ("b", 1), ("b", 9), (None, 2)], "field string, n int")
    assert M.column_values(df, "field", where="n > 99", default=["x"]).collect() == [("x",)]
    assert dict(M.column_values(df, "n", where="n > 99", default=[1]).dtypes) == {"value": "int"}
    assert M.column_values(df, "field", where="n > 99").collect() == []
    assert M.column_values(None, "field", default=[1, 2], spark=spark).collect() == [(1,), (2,)]
    assert M.column_values(None, "field", default=[], spark=spark).collect() == []
    with pytest.raises(ValueError):
        M.column_values(None, "field")
    order = lambda text: [r.value for r in M.column_values(df, "field", order_by=text).collect()]
    assert order("max(n) desc") == ["b", "a", None] and order("count(*) desc, field") == ["b", "a", None]
    assert order("coalesce(sum(n), 0) - min(n) desc, value desc") == ["b", "a", None]


def test_two_way_difference_reads_each_side_once(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "y")], "k int, v string")
    b = spark.createDataFrame([(2, "x"), (3, None), (3, None)], "k int, v string")
    out = two_way_except(a, b)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 2
    assert sorted(map(str, rows_any(out))) == sorted(map(str, [(1, None, "a_minus_b"), (3, "y", "a_minus_b"), (3, None, "b_minus_a")]))
    same = C.cardinality_equality(a, "k", b, "k").rows
    assert sorted(map(tuple, same.collect())) == [(1, 2), (3, 1), (3, 2)]


def rows_any(df):
    return [tuple(r) for r in df.collect()]


def test_suite_reads_a_relation_once(spark, tmp_dir):
    spark.range(10).selectExpr("id", "nullif(id, 3) as v", "'' as s").write.parquet(tmp_dir + "/t")
    df = spark.read.parquet(tmp_dir + "/t")
    suite = C.run_checks([C.not_null(df, "v"), C.not_null(df, "id", where="id > 4"), C.not_empty_string(df, "s"),
                          C.accepted_range(df, "id", 2, 7), (C.expression_is_true(df, "v < 5"), ">3", ">9")])
    assert suite._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    got = {r.check_name: (r.failures, r.should_warn, r.should_error) for r in suite.collect()}
    assert got == {"not_null_v": (1, True, True), "not_null_id": (0, False, False), "not_empty_string_s": (10, True, True),
                   "accepted_range_id": (4, True, True), "expression_is_true": (5, True, False)}


def test_relations_over_schemas(spark, tmp_dir):
    from postlake.operators.relational import relations_by_pattern, union_by_pattern, union_by_prefix
    for db in ("zone_a", "zone_b", "other"):
        spark.sql(f"create database {db} location '{tmp_dir}/{db}'")
        spark.range(2).write.mode("overwrite").saveAsTable(f"{db}.ev_1")
        spark.range(1).write.mode("overwrite").saveAsTable(f"{db}.evx")
    assert relations_by_pattern(spark, "EV%", exclude="%x", schema_pattern="zone%") == ["zone_a.ev_1", "zone_b.ev_1"]
    assert union_by_pattern(spark, "ev%", schema_pattern="zone%").count() == 6
    assert union_by_prefix(spark, "ev_", schema_pattern="zone%").count() == 4


def test_running_sums(spark):
    from pyspark.sql import Window
    from postlake.operators.sequence import ordered_scan
    df = spark.range(500).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("n"))
    w = Window.partitionBy("k").orderBy("o")
    want = df.withColumn("sum_n", F.coalesce(F.sum("n").over(w), F.lit(0)))
    for parts in (1, 9):
        assert rows(ordered_scan(df, ["k"], ["o"], sums=["n"], num_partitions=parts), "o", "sum_n") == rows(want, "o", "sum_n")


def test_suite_of_one_relation_is_one_scan(spark, tmp_dir):
    rows = [(i, i % 7, None if i % 5 == 0 else i % 3, "c", dt.date(2024, 1, 1 + i % 9), 0.5 * (i % 4)) for i in range(90)] + [(None, None, None, "c", None, float("nan"))] * 2
    path = tmp_dir + "/t"
    spark.createDataFrame(rows, "id int, a int, b int, c string, t date, d double").write.parquet(path)

    def suite(df):
        now = dt.datetime(2024, 1, 9)
        return [C.unique(df, "id"), C.unique(df, "a"), C.unique(df, "d"), C.accepted_values(df, "b", [0, 1]), C.not_accepted_values(df, "a", [3, 99]),
                C.unique_combination(df, ["a", "b"]), C.unique_combination(df, ["b", "a"]), C.at_least_one(df, "b", ["a"]), C.at_least_one(df, "b"),
                C.not_constant(df, "c"), C.not_constant(df, "b", ["a", "c"]), C.not_null_proportion(df, "b", 0.9, group_by=["a"]),
                C.not_null_proportion(df, "b", 0.1), C.recency(df, "t", "day", 2, group_by=["a"], now=now), C.recency(df, "t", "day", 0, now=now),
                C.not_null(df, "id"), C.accepted_range(df, "a", 1, 5), C.expression_is_true(df, "id >= 0")]

    for df in (spark.read.parquet(path), spark.read.parquet(path).where("id > 1000")):
        for number, c in enumerate(own := suite(df)):
            c.name = f"{number} {c.name}"
        fused = C.run_checks(own)
        assert fused._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
        got = {r.check_name: r.failures for r in fused.collect()}
        assert got == {c.name: c.rows.count() for c in own}
    no_groups = C.run_checks([C.not_constant(df, "c"), C.not_null(df, "id")])
    assert no_groups._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
