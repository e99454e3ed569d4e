"""Dimension/fact marts and the analytics behind the dashboards."""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Callable, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException

from postlake.functions.keys import company_key, company_name
from postlake.session import checkpoint

# Fixed value: the nine fact columns, read from the staging layer.
FACT_COLUMNS = ["job_id", "company", "salary_min", "salary_max", "deal_salary",
                "experience_min", "experience_max", "experience_not_mentioned", "crawled_at"]


def dim_company(jobs: DataFrame, company_col: str = "company") -> DataFrame:
    """Distinct ``(company_id, company_name)``; null company → id of ``unknown``, name ``Unknown``."""
    return jobs.select(company_key(company_col).alias("company_id"),
                       company_name(company_col).cast("string").alias("company_name")).distinct()


def dim_job(jobs: DataFrame) -> DataFrame:
    """The deduplicated postings as they are."""
    return jobs


def fact_job_posting(stg: DataFrame) -> DataFrame:
    """The nine fact columns from staging (repeat sightings stay), non-null ``job_id``."""
    return stg.where(F.col("job_id").isNotNull()).select(*FACT_COLUMNS)


def table_counts(spark: SparkSession, tables: dict[str, Callable[[], DataFrame]] | Sequence[str], separately: bool = False) -> DataFrame:
    """``(table_name, row_count, healthy)`` per relation; 0 rows when it cannot be read.

    ``tables`` is a list of catalog names or a mapping of name → loader. Each
    count is a partial + final aggregate; the per-table rows are unioned, and a
    relation that cannot be found or analysed counts as 0. ``separately`` counts
    each relation at once in a job of its own, so that one whose files turn out
    to be unreadable counts as 0 too and the others are not lost with it.
    """
    if not isinstance(tables, dict):
        tables = {t: (lambda t=t: spark.table(t)) for t in tables}
    if separately:
        rows = []
        for name, load in tables.items():
            try:
                rows.append((name, load().count()))
            except (PySparkException, Py4JError, OSError):
                rows.append((name, 0))
        return spark.createDataFrame(rows, "table_name string, row_count long").withColumn("healthy", F.col("row_count") > 0)
    parts = []
    for name, load in tables.items():
        try:
            df = load()
            part = df.agg(F.count(F.lit(1)).alias("row_count"))
        except (AnalysisException, FileNotFoundError, OSError):
            part = spark.range(1).select(F.lit(0).cast("long").alias("row_count"))
        parts.append(part.select(F.lit(name).alias("table_name"), "row_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("healthy", F.col("row_count") > 0)


def _footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application that answers counts over Parquet files from their footers."""
    footers = spark.newSession()
    v1 = footers.conf.get("spark.sql.sources.useV1SourceList").split(",")
    footers.conf.set("spark.sql.sources.useV1SourceList", ",".join(x for x in v1 if x.strip().lower() != "parquet"))
    footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return footers


def file_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """``table_counts`` of Parquet tables by path, from footers alone: the scan has the count pushed into it.

    A path that does not exist, or has no Parquet schema, counts as 0. The
    result belongs to a session of its own, in which aggregates are pushed
    into Parquet scans.
    """
    footers = _footer_session(spark)
    return table_counts(footers, {name: (lambda path=path: footers.read.parquet(path)) for name, path in paths.items()})


def file_non_null_counts(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """``column_name, non_null, row_count`` of a Parquet table's top-level columns that are not nested, from footers alone.

    Needs null counts in the footers, which Spark and Arrow write for every row group with rows; without them (an
    empty file of Arrow's has none) the job fails and says so, and no count is guessed.
    """
    got = _footer_session(spark).read.parquet(path).agg(F.count(F.lit(1)).alias("row_count"),
                                                        *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(columns)])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("non_null"), "row_count") for i, c in enumerate(columns)]
    return got.select(F.inline(F.array(*pairs)))


def describe(df: DataFrame) -> DataFrame:
    """``position, column_name, column_type, nullable`` of every column (schema metadata only)."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, column_type string, nullable boolean")


def job_totals(fact: DataFrame, key: str = "job_id") -> DataFrame:
    """Total postings and distinct ids (null not counted)."""
    return fact.agg(F.count(F.lit(1)).alias("total_postings"),
                    F.count_distinct(F.col(key)).alias("distinct_ids"))


def company_totals(dim: DataFrame, name_col: str = "company_name") -> DataFrame:
    """Company count and the count of empty names."""
    return dim.agg(F.count(F.lit(1)).alias("companies"),
                   F.count_if(F.col(name_col) == "").alias("empty_names"))


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram of non-null ``col`` over [min, max]: ``bucket, lo, hi, n``.

    The bounds are one global aggregate used as a scalar subquery; the
    maximum falls into the last bucket. Only non-empty buckets appear.
    """
    vals = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull())
    # one-row bounds, used as a scalar subquery (computed once, no join)
    b = vals.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
    lo, hi = b["lo"], b["hi"]
    bucket = F.when(hi == lo, F.lit(1)).otherwise(
        F.least(F.width_bucket(F.col("v"), lo, hi, F.lit(bins)), F.lit(bins)))
    counts = vals.groupBy(bucket.cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("bucket",
                         (lo + (F.col("bucket") - 1) * (hi - lo) / bins).alias("lo"),
                         (lo + F.col("bucket") * (hi - lo) / bins).alias("hi"),
                         "n")


# Slices of a value range in one pass of the selection; rows up to which its state is kept on the driver, and slices there.
SLICES = 4096
LOCAL_GROUPS = 10_000
LOCAL_SLICES = 500_000


def _numbers(df: DataFrame, group: list[str], col: str) -> DataFrame:
    """The groups and the values as doubles, without nulls and NaN."""
    vals = df.select(*group, F.col(col).cast("double").alias("_v"))
    return vals.where(F.col("_v").isNotNull() & ~F.isnan("_v"))


def _magnitude(v: Column) -> Column:
    """A whole number that never falls as ``v`` rises: sign and power of two (zero and the infinities alone)."""
    power = F.floor(F.signum(v) * (F.log2(F.abs(v)) + 1100))
    inf = float("inf")
    return F.when(v == 0, 0).when(v == inf, 9999).when(v == -inf, -9999).otherwise(power).cast("int")


def _settled(df: DataFrame, group: list[str]) -> tuple[DataFrame, bool]:
    """``df`` (a few rows for each group), run: a local table while there are few groups, else a checkpoint. And if it is local."""
    rows = df.limit(LOCAL_GROUPS + 1).collect()
    if len(rows) <= LOCAL_GROUPS:
        return df.sparkSession.createDataFrame(rows, df.schema), True
    return checkpoint(df), False


def _same_group(a: DataFrame, b: DataFrame, group: list[str], also: Column | None = None, small: bool = False) -> DataFrame:
    """Rows of ``a`` with those of ``b`` of the same group (null-safe) for which ``also`` holds; columns of both but b's group."""
    names = {g: f"_g_{g}" for g in group}
    other = b.withColumnsRenamed(names)
    cond = F.lit(True) if also is None else also
    for g in group:
        cond = cond & F.col(f"`{g}`").eqNullSafe(F.col(f"`_g_{g}`"))
    return a.join(F.broadcast(other) if small else other, cond).drop(*names.values())


def _ranks_in(slices: DataFrame, by: list[str], wanted: Column) -> DataFrame:
    """The slice that holds each wanted rank: ``by``, wanted, _rank (inside the slice), _lo, _hi.

    ``slices``: ``by``, _at, _n, _lo, _hi, and what ``wanted`` (an array of struct(name, rank)) is made of.
    """
    order = Window.partitionBy(*by or [F.lit(0)]).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    placed = slices.withColumn("_before", F.coalesce(F.sum("_n").over(order), F.lit(0)))
    inside = lambda r: (r["rank"] >= F.col("_before")) & (r["rank"] < F.col("_before") + F.col("_n"))
    return placed.withColumn("_r", F.explode(F.filter(wanted, inside))).select(
        *by, F.col("_r.name").alias("_name"), (F.col("_r.rank") - F.col("_before")).alias("_rank"), "_lo", "_hi")


class _Wanted:
    """What the selection looks for in one group: its totals, and each wanted rank with the range that holds it."""

    def __init__(self, total: int, low: float, high: float, ranks: dict[str, int]):
        self.total, self.low, self.high = total, low, high
        self.at = {name: (rank, low, high) for name, rank in ranks.items()}  # rank inside the range, the range's ends

    def narrow(self, part: tuple[float, float] | None, slices: list[tuple]) -> None:
        """Go on to the slices (place, n, lo, hi) of one range (None: of the whole group)."""
        own = sorted(slices)
        ends = list(accumulate(n for _, n, _, _ in own))
        for name, (rank, lo, hi) in self.at.items():
            if part in (None, (lo, hi)):
                k = bisect_right(ends, rank)
                self.at[name] = (rank - (ends[k - 1] if k else 0), own[k][2], own[k][3])


def _ranks(total: int, probs: Sequence[float]) -> dict[str, int]:
    """The two ranks around each probability."""
    out = {}
    for i, p in enumerate(probs):
        pos = (total - 1) * float(p)
        out |= {f"{i} lo": math.floor(pos), f"{i} hi": math.ceil(pos)}
    return out


def _select_on_driver(vals: DataFrame, group: list[str], probs: Sequence[float], rows: list) -> list[tuple]:
    """(group..., quantiles..., total, min, max) for few groups, from the first pass' ``rows``.

    The driver keeps at most LOCAL_SLICES slices at a time; a pass over the data counts them on the executors.
    """
    first: dict[tuple, list] = {}
    for r in rows:
        first.setdefault(tuple(r[:len(group)]), []).append(tuple(r[len(group):]))
    found = {}
    for key, own in first.items():
        total = sum(n for _, n, _, _ in own)
        found[key] = w = _Wanted(total, min(x[2] for x in own), max(x[3] for x in own), _ranks(total, probs))
        w.narrow(None, own)
    while ranges := sorted({(k, lo, hi) for k, w in found.items() for _, lo, hi in w.at.values() if lo < hi}, key=repr):
        v, many = F.col("_v"), max(16, min(SLICES, LOCAL_SLICES // len(ranges)))
        if group:
            parts = vals.sparkSession.createDataFrame([(*k, lo, hi, i) for i, (k, lo, hi) in enumerate(ranges)],
                                                      T.StructType([*vals.select(*group).schema.fields, *(T.StructField(n, t) for n, t in (
                                                          ("_from", T.DoubleType()), ("_to", T.DoubleType()), ("_part", T.IntegerType())))]))
            cut = _same_group(vals, parts, group, v.between(F.col("_from"), F.col("_to")), True)
            share = (v - F.col("_from")) / (F.col("_to") - F.col("_from"))
        else:  # at most two ranges for each probability: constants
            part = share = F.lit(None)
            for i, (_, lo, hi) in enumerate(ranges):
                part = F.when(v.between(lo, hi), i).otherwise(part)
                share = F.when(v.between(lo, hi), (v - lo) / (F.lit(hi) - F.lit(lo))).otherwise(share)
            cut = vals.withColumn("_part", part.cast("int")).where("_part is not null")
        at = F.least(F.floor(share * many), F.lit(many - 1)).cast("int")
        slices: dict[int, list] = {}
        for r in cut.groupBy("_part", at.alias("_at")).agg(*_STATS()).collect():
            slices.setdefault(r["_part"], []).append(tuple(r[1:]))
        for i, (key, lo, hi) in enumerate(ranges):
            found[key].narrow((lo, hi), slices[i])
    out = []
    for key, w in found.items():
        values = []
        for i, p in enumerate(probs):
            (_, lo, _), (_, hi, _), pos = w.at[f"{i} lo"], w.at[f"{i} hi"], (w.total - 1) * float(p)
            values.append(lo if lo == hi else lo + (hi - lo) * (pos - math.floor(pos)))
        out.append((*key, *values, w.total, w.low, w.high))
    return out


def _STATS() -> list[Column]:
    return [F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]


def _order_statistics(vals: DataFrame, group: list[str], probs: Sequence[float]) -> tuple[DataFrame, DataFrame, bool]:
    """(state, totals, local): the values at the two ranks around each probability, found by refining histograms.

    ``state``: group, _name ("i lo" or "i hi"), _lo = _hi = the value. The first pass counts each group's values by sign and
    power of two; every further pass cuts the ranges that still hold different values and a wanted rank into
    SLICES slices. Counts, minima and maxima are made before the shuffle, so a pass moves at most SLICES rows for each
    range and task, and no value is sorted; a range ends when its smallest and largest value are one. Slices are cut by a function that never falls
    as the value rises, so ranks add up exactly; a pass narrows a range to about 1 / SLICES, six passes any.
    """
    stats = _STATS()
    slices = vals.groupBy(*group, _magnitude(F.col("_v")).alias("_at")).agg(*stats)
    totals = Window.partitionBy(*group or [F.lit(0)])
    slices = slices.withColumns({"_total": F.sum("_n").over(totals), "_min": F.min("_lo").over(totals), "_max": F.max("_hi").over(totals)})
    wanted = []
    for i, p in enumerate(probs):
        pos = (F.col("_total") - 1) * F.lit(float(p))
        wanted += [F.struct(F.lit(f"{i} {end}").alias("name"), rank.cast("long").alias("rank")) for end, rank in (("lo", F.floor(pos)), ("hi", F.ceil(pos)))]
    sizes = [F.col(c) for c in ("_total", "_min", "_max")]
    first = _ranks_in(slices, [*group, "_total", "_min", "_max"], F.array(*wanted))
    state, local = _settled(first, group)
    sums = state.select(*[F.col(f"`{g}`") for g in group], *sizes).distinct()
    state = state.drop("_total", "_min", "_max")
    for _ in range(64):
        open_ = state.where("_lo < _hi")
        if open_.isEmpty():
            return state, sums, local
        parts = open_.select(*[F.col(f"`{g}`") for g in group], F.col("_lo").alias("_from"), F.col("_hi").alias("_to")).distinct()
        within = F.col("_v").between(F.col("_from"), F.col("_to"))
        if group:
            cut = _same_group(vals, parts, group, within, local)
        else:  # at most two ranges for each probability: constants
            ranges = F.array(*[F.struct(F.lit(r["_from"]).alias("_from"), F.lit(r["_to"]).alias("_to")) for r in parts.collect()])
            hit = F.filter(ranges, lambda r: F.col("_v").between(r["_from"], r["_to"]))
            cut = vals.withColumn("_hit", F.get(hit, F.lit(0))).where("_hit is not null").select("_v", "_hit._from", "_hit._to")
        share = (F.col("_v") - F.col("_from")) / (F.col("_to") - F.col("_from"))
        at = F.least(F.floor(share * SLICES), F.lit(SLICES - 1)).cast("int")
        slices = cut.groupBy(*group, "_from", "_to", at.alias("_at")).agg(*stats)
        ranks = open_.groupBy(*group, "_lo", "_hi").agg(F.collect_list(F.struct(F.col("_name").alias("name"), F.col("_rank").alias("rank"))).alias("_want")) \
            .withColumnsRenamed({"_lo": "_a", "_hi": "_b"})
        slices = _same_group(slices, ranks, group, (F.col("_from") == F.col("_a")) & (F.col("_to") == F.col("_b")), local)
        inner = _ranks_in(slices, [*group, "_from", "_to", "_want"], F.col("_want")).select(*state.columns)
        state, local = _settled(state.where("_lo = _hi").unionByName(inner), group)
    raise RuntimeError("the selection does not end")


def exact_quantiles(df: DataFrame, group: Sequence[str], col: str,
                    probs: Sequence[float], names: Sequence[str] | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles of ``col`` per group (nulls and NaN out).

    The values at the wanted ranks are found by a few counting passes over the
    data (see :func:`_order_statistics`): no group is gathered or sorted, however
    large, and a value that most rows share is one count.
    """
    group = list(group)
    names = list(names or [f"q{int(p * 100)}" for p in probs])
    return _quantiles(_numbers(df, group, col), group, probs, names)[0].select(*group, *names)


def _quantiles(vals: DataFrame, group: list[str], probs: Sequence[float], names: Sequence[str]) -> tuple[DataFrame, bool]:
    """The quantiles with _total, _min and _max of each group; and if it is a local table."""
    rows = vals.groupBy(*group, _magnitude(F.col("_v")).alias("_at")).agg(*_STATS()).limit(LOCAL_GROUPS + 1).collect()
    if len(rows) <= LOCAL_GROUPS:
        schema = T.StructType([*vals.select(*group).schema.fields, *(T.StructField(n, T.DoubleType()) for n in names), T.StructField("_total", T.LongType()),
                               T.StructField("_min", T.DoubleType()), T.StructField("_max", T.DoubleType())])
        found = _select_on_driver(vals, group, probs, rows)
        empty = [] if group or found else [(*[None] * len(names), 0, None, None)]
        return vals.sparkSession.createDataFrame(found + empty, schema), True
    state, sums, local = _order_statistics(vals, group, probs)
    value = lambda name: F.max(F.when(F.col("_name") == name, F.col("_lo"))).alias(f"_{name}")
    found = state.groupBy(*group).agg(*[value(f"{i} {end}") for i in range(len(probs)) for end in ("lo", "hi")])
    found = _same_group(found, sums, group) if group else found.withColumns(
        {c: sums.agg(F.first(c)).scalar() for c in ("_total", "_min", "_max")})
    out = []
    for i, (p, name) in enumerate(zip(probs, names)):
        pos = (F.col("_total") - 1) * F.lit(float(p))
        lo, hi = F.col(f"`_{i} lo`"), F.col(f"`_{i} hi`")
        out.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (pos - F.floor(pos))).alias(name))
    return found.select(*group, *out, "_total", "_min", "_max"), local


def box_stats(df: DataFrame, group: Sequence[str], col: str, approx: bool = False,
              accuracy: int = 10000) -> DataFrame:
    """Box-plot numbers per group: ``n, min, q1, median, q3, max``, whiskers and outliers (nulls and NaN out).

    Whiskers are the most extreme values within 1.5 × IQR of the quartiles.
    ``approx=True`` uses ``percentile_approx`` (bounded memory, approximate).
    """
    group = list(group)
    names = ["q1", "median", "q3"]
    vals = _numbers(df, group, col)
    if approx:
        q = vals.groupBy(*group).agg(
            F.percentile_approx("_v", [0.25, 0.5, 0.75], accuracy).alias("_q"))
        q, local = q.select(*group, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)]), False
    else:
        q, local = _quantiles(vals, group, [0.25, 0.5, 0.75], names)
        q = q.select(*group, *names)
    iqr = F.col("q3") - F.col("q1")
    lo_fence, hi_fence = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    if group:
        both = _same_group(vals, q, group, small=local)
    elif local:
        one = q.first()
        both = vals.withColumns({n: F.lit(one[n]).cast("double") for n in names})
    else:  # one row, used as a scalar subquery
        one = q.select(F.struct(*names).alias("_s")).scalar()
        both = vals.withColumns({n: one[n] for n in names})
    return both.groupBy(*group).agg(
        F.count("_v").alias("n"), F.min("_v").alias("min"), F.first("q1").alias("q1"),
        F.first("median").alias("median"), F.first("q3").alias("q3"), F.max("_v").alias("max"),
        F.min(F.when(F.col("_v") >= lo_fence, F.col("_v"))).alias("lower_whisker"),
        F.max(F.when(F.col("_v") <= hi_fence, F.col("_v"))).alias("upper_whisker"),
        F.count_if((F.col("_v") < lo_fence) | (F.col("_v") > hi_fence)).alias("outliers"))


def flag_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Number of rows where each boolean column is true, as ``<col>_count``."""
    return df.agg(*[F.count_if(F.col(c) == F.lit(True)).alias(f"{c}_count") for c in cols])


def value_counts(df: DataFrame, col: str, alias: str | None = None) -> DataFrame:
    """Rows per non-null value of ``col`` (``n``), ordered by the value."""
    name = alias or col
    return (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias(name))
              .agg(F.count(F.lit(1)).alias("n")).orderBy(name))


def experience_counts(fact: DataFrame, col: str = "experience_min") -> DataFrame:
    """Postings per minimum-experience value, nulls out, by value."""
    return value_counts(fact, col)


def top_values(df: DataFrame, col: str, k: int) -> DataFrame:
    """The ``k`` most frequent non-null values (``n`` desc, then value asc).

    Counting is a partial + final aggregate; ``orderBy(...).limit(k)`` plans
    as ``TakeOrderedAndProject``, which keeps k rows per task.
    """
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.col("n").desc(), F.col(col).asc()).limit(k))


def latest_first(df: DataFrame, k: int, ts: str = "crawled_at", tie: str = "job_id") -> DataFrame:
    """The ``k`` newest rows by ``ts`` (nulls last, ``tie`` breaks ties)."""
    return df.orderBy(F.col(ts).desc_nulls_last(), F.col(tie).asc_nulls_last()).limit(k)


def column_values(df: DataFrame | None, column: str, order_by: Sequence[Column] | str | None = None,
                  max_records: int | None = None, where: str | None = None,
                  default: Sequence | None = None, spark: SparkSession | None = None) -> DataFrame:
    """Distinct values of ``column`` as ``value`` (default order: frequency desc, then value).

    ``order_by`` is SQL text over the grouped relation, of any aggregates and
    the column (``"count(*) desc"``, ``"max(p_size), p_brand desc"``), in which
    ``value`` may stand for the column, or a list of Columns over ``value`` and
    the count ``_n``.

    ``default`` (values of the column's type) is the result when the relation
    does not exist (``df is None``; then the type is that of the values) or has
    no such rows; without one, a missing relation is an error and an empty one
    gives no rows.
    """
    if df is None:
        if default is None:
            raise ValueError("column_values: relation does not exist and no default was given")
        if not default:
            return spark.createDataFrame([], "value string")
        return spark.createDataFrame([(v,) for v in default], ["value"])
    src = df.where(where) if where else df
    kept = [F.count(F.lit(1)).alias("_n")]
    if isinstance(order_by, str):
        terms, order = _order_text(order_by, column)
        kept += [F.expr(t).alias(f"_o{i}") for i, t in enumerate(terms)]
    else:
        order = list(order_by) if order_by else [F.col("_n").desc(), F.col("value").asc_nulls_last()]
    g = src.groupBy(F.col(column).alias(column)).agg(*kept).withColumnRenamed(column, "value")
    out = g.orderBy(*order)
    if max_records is not None:
        out = out.limit(max_records)
    out = out.select("value")
    if default is not None and out.isEmpty():
        typ = df.schema[column].dataType
        return df.sparkSession.createDataFrame([(v,) for v in default], f"value {typ.simpleString()}")
    return out


def _order_text(text: str, column: str) -> tuple[list[str], list[Column]]:
    """The expressions of an ORDER BY text, and sort columns over them (named ``_o0``, ``_o1``, ...)."""
    terms, order, depth, start = [], [], 0, 0
    for i, ch in enumerate(text + ","):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            terms.append(text[start:i].strip())
            start = i + 1
    for i, t in enumerate(terms):
        words = t.split()
        down = words[-1].lower() == "desc"
        if words[-1].lower() in ("asc", "desc"):
            words = words[:-1]
        body = " ".join(words)
        terms[i] = f"`{column}`" if body.lower() == "value" else body
        order.append(F.col(f"_o{i}").desc_nulls_last() if down else F.col(f"_o{i}").asc_nulls_last())
    return terms, order


def single_value(df: DataFrame, default=None, default_type: str | None = None) -> DataFrame:
    """First column of the first row as a one-row frame ``value``; ``default`` when empty.

    The first row (``limit(1)``) is read as a scalar subquery; a null first
    value stays null, only an empty input gives ``default``.
    """
    typ = default_type or df.schema.fields[0].dataType.simpleString()
    first = df.select(F.struct(F.col(df.columns[0]).alias("v")).alias("_s")).limit(1).scalar()
    return df.sparkSession.range(1).select(
        F.when(first.isNull(), F.lit(default).cast(typ)).otherwise(first["v"]).alias("value"))
