"""Dedup, pivot/unpivot and generators."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.functions.text import slugify_name
from postlake.session import stored


_SORT_TEXT = re.compile(r"^\s*(`[^`]+`|[\w.]+)(?:\s+(asc|desc))?(?:\s+nulls\s+(first|last))?\s*$", re.I)


def _order(cols: Sequence) -> list[Column]:
    """Columns, or order text like ``"version desc"`` / ``"ts desc nulls last"``.

    Text without a null order sorts nulls last, as SQL engines usually do.
    """
    out = []
    for c in cols:
        if not isinstance(c, str):
            out.append(c)
            continue
        m = _SORT_TEXT.match(c)
        if not m:
            raise ValueError(f"cannot read the sort order {c!r}")
        col = F.col(m.group(1))
        desc = (m.group(2) or "asc").lower() == "desc"
        nulls = (m.group(3) or "last").lower()
        out.append({(False, "first"): col.asc_nulls_first(), (False, "last"): col.asc_nulls_last(),
                    (True, "first"): col.desc_nulls_first(), (True, "last"): col.desc_nulls_last()}
                   [(desc, nulls)])
    return out


def deduplicate(df: DataFrame, partition_by: Sequence[str], order_by: Sequence) -> DataFrame:
    """One row per ``partition_by`` key: the first by ``order_by``.

    ``row_number() = 1`` lets Catalyst insert a partial ``WindowGroupLimit``
    before the shuffle, so every map task forwards at most one row per key:
    a key with a third of the rows costs one row per task in the exchange.
    Rows with null columns are kept (a natural-join dedup would drop them).
    """
    w = Window.partitionBy(*partition_by).orderBy(*_order(order_by))
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") == 1).drop("_rn"))


# Fixed value: the 23 columns of the deduplicated posting layer and their types.
POSTING_LAYER_TYPES = {
    "job_id": "string", "title": "string", "company": "string", "source": "string",
    "url": "string", "company_url": "string", "logo_url": "string", "salary": "string",
    "location": "string", "experience": "string", "tags": None, "working_times": None,
    "is_urgent": "boolean", "is_highlight": "boolean", "is_flash": "boolean",
    "company_verified": "boolean", "job_description": "string", "job_requirement": "string",
    "job_benefit": "string", "updated_at": "timestamp_ntz", "posted_at": "timestamp_ntz",
    "deadline": "timestamp_ntz", "crawled_at": "bigint",
}


def latest_postings(stg: DataFrame, extra_columns: Sequence[str] = ()) -> DataFrame:
    """Newest sighting per ``job_id`` (E2), typed to the 23-column posting layer.

    Order: ``crawled_at`` descending with nulls last, then a hash of the whole
    row so that ties resolve the same way on every run. Times are zone-less
    (``timestamp_ntz``); free-text times (deadline words) become null through
    ``try_cast``. ``extra_columns`` keeps
    more columns (the parsed salary fields, for instance).
    """
    cols = []
    for name, typ in POSTING_LAYER_TYPES.items():
        c = F.col(name)
        cols.append((c if typ is None else c.try_cast(typ)).alias(name))
    typed = stg.select(*cols, *[F.col(c) for c in extra_columns])
    tie = F.xxhash64(*[F.col(c) for c in typed.columns])
    return deduplicate(typed, ["job_id"], [F.col("crawled_at").desc_nulls_last(), tie.desc()])


def merge_latest(spark: SparkSession, root: str, new: DataFrame, key: str, order_by: Sequence, buckets: int = 256) -> int:
    """Merge ``new`` rows into the table of latest rows per ``key`` below ``root``; returns the number of buckets touched.

    The table is kept in folders by a hash of the key (``_bucket=<n>``). A merge reads only the buckets that
    the new rows' keys fall into, keeps the first row per key by ``order_by`` of old and new ones, and replaces those folders
    (dynamic overwrite: the job's output takes their place when it is complete). Merging batch by batch gives what
    :func:`deduplicate` gives over all rows; merging a batch again changes nothing. ``buckets`` must
    be the same for every merge. One writer at a time.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("_bucket")
    rows = deduplicate(new, [key], order_by).withColumn("_bucket", bucket)
    rows = stored(rows, "latest-new")
    touched = sorted(r["_bucket"] for r in rows.select("_bucket").distinct().collect())  # at most ``buckets`` numbers
    if not touched:
        return 0
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        old = spark.read.schema(rows.schema).parquet(root).where(F.col("_bucket").isin(touched))
        rows = deduplicate(old.unionByName(rows), [key], order_by)
    rows.repartition("_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(root)
    return len(touched)


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    """The table of :func:`merge_latest`."""
    return spark.read.parquet(root).drop("_bucket")


_AGGS = {
    "sum": F.sum, "count": F.count, "max": F.max, "min": F.min, "avg": F.avg,
    "bool_or": F.bool_or, "bool_and": F.bool_and,
}
_DISTINCT_AGGS = {"sum": F.sum_distinct, "count": F.count_distinct}
_CMPS = {
    "=": lambda a, b: a == b, "!=": lambda a, b: a != b, "<>": lambda a, b: a != b,
    "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b, "like": lambda a, b: a.like(b),
}


def pivot_columns(column: str, values: Sequence, agg: str = "sum", cmp: str = "=",
                  prefix: str = "", suffix: str = "", then_value=1, else_value=0,
                  quote_identifiers: bool = True, distinct: bool = False,
                  alias: bool = True) -> list[Column]:
    """Conditional aggregates ``agg([distinct] case when column cmp v then T else E end)``.

    Unlike ``GroupedData.pivot``, a group without a value gets ``else_value``
    (0 by default) rather than null. Aliases are ``prefix + v + suffix``, as is
    or slugified when ``quote_identifiers`` is false.
    """
    if cmp not in _CMPS:
        raise ValueError(f"unsupported comparison {cmp!r}")
    fn = (_DISTINCT_AGGS if distinct else _AGGS).get(agg)
    if fn is None:
        raise ValueError(f"unsupported aggregate {agg!r} (distinct={distinct})")
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    out = []
    for v in values:
        e = fn(F.when(_CMPS[cmp](F.col(column), F.lit(v)), lit(then_value)).otherwise(lit(else_value)))
        if alias:
            name = f"{prefix}{v}{suffix}"
            e = e.alias(name if quote_identifiers else slugify_name(name))
        out.append(e)
    return out


def pivot(df: DataFrame, group_cols: Sequence[str], column: str, values: Sequence,
          **kwargs) -> DataFrame:
    """Group by ``group_cols`` and pivot ``column`` over ``values`` (one shuffle, partial aggregation)."""
    return df.groupBy(*group_cols).agg(*pivot_columns(column, values, **kwargs))


def unpivot(df: DataFrame, cast_to: str = "string", exclude: Sequence[str] = (),
            remove: Sequence[str] = (), field_name: str = "field_name",
            value_name: str = "value") -> DataFrame:
    """Columns to name/value rows (an ``Expand``, no shuffle).

    ``exclude`` columns are kept on every row, ``remove`` columns are dropped
    (both case-insensitive); all other columns are cast to ``cast_to`` (booleans
    through their text form ``true``/``false``).
    """
    exc = {c.lower() for c in exclude}
    rem = {c.lower() for c in remove}
    keep = [f for f in df.schema.fields if f.name.lower() in exc]
    melt = [f for f in df.schema.fields if f.name.lower() not in exc and f.name.lower() not in rem]
    if not melt:
        raise ValueError("unpivot: no columns to unpivot")
    cast = []
    for f in melt:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.BooleanType):
            c = c.cast("string")
        cast.append(c.cast(cast_to).alias(f.name))
    typed = df.select(*[F.col(f"`{f.name}`") for f in keep], *cast)
    return typed.unpivot([F.col(f"`{f.name}`") for f in keep], [F.col(f"`{f.name}`") for f in melt],
                         field_name, value_name)


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """Numbers 1..upper_bound as ``generated_number`` (distributed ``range``)."""
    if upper_bound is None or upper_bound <= 0:
        raise ValueError("generate_series: upper_bound must be a positive number")
    return spark.range(1, upper_bound + 1).select(F.col("id").alias("generated_number"))


_FIXED_STEP = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 7 * 86400}
_MONTH_STEP = {"month": 1, "quarter": 3, "year": 12}


def _as_datetime(x) -> dt.datetime:
    if isinstance(x, dt.datetime):
        return x
    if isinstance(x, dt.date):
        return dt.datetime(x.year, x.month, x.day)
    return dt.datetime.fromisoformat(str(x))


def intervals_between(start, end, datepart: str) -> int:
    """Number of ``datepart`` boundaries crossed from ``start`` to ``end``."""
    s, e = _as_datetime(start), _as_datetime(end)
    if datepart in _MONTH_STEP:
        if datepart == "month":
            return (e.year * 12 + e.month) - (s.year * 12 + s.month)
        if datepart == "quarter":
            return (e.year * 4 + (e.month - 1) // 3) - (s.year * 4 + (s.month - 1) // 3)
        return e.year - s.year
    if datepart == "week":
        sw = s.date() - dt.timedelta(days=s.weekday())
        ew = e.date() - dt.timedelta(days=e.weekday())
        return (ew - sw).days // 7
    if datepart == "day":
        return (e.date() - s.date()).days
    step = _FIXED_STEP.get(datepart)
    if step is None:
        raise ValueError(f"unsupported datepart {datepart!r}")
    epoch = dt.datetime(1970, 1, 1)
    return int((e - epoch).total_seconds() // step - (s - epoch).total_seconds() // step)


def date_spine(spark: SparkSession, datepart: str, start_date, end_date) -> DataFrame:
    """One row per ``datepart`` from ``start_date``; ``end_date`` itself is excluded.

    The period count comes from the two bounds (not from data), and the rows
    come from a distributed ``spark.range``. An empty or reversed range gives
    an empty frame.
    """
    n = intervals_between(start_date, end_date, datepart)
    start, end = _as_datetime(start_date), _as_datetime(end_date)
    name = f"date_{datepart}"
    ids = spark.range(0, max(n, 0))
    # zone-free arithmetic: timestamp_ntz literals, results independent of the session time zone
    base = F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz")
    if datepart in _MONTH_STEP:
        out = F.timestamp_add("MONTH", F.col("id").cast("int") * _MONTH_STEP[datepart], base)
    else:
        out = F.timestamp_add("SECOND", F.col("id") * _FIXED_STEP[datepart], base)
    res = ids.select(out.alias(name)).where(F.col(name) <= F.lit(end.isoformat(sep=" ")).cast("timestamp_ntz"))
    if datepart in ("day", "week", "month", "quarter", "year") and \
            start == dt.datetime(start.year, start.month, start.day):
        res = res.select(F.to_date(name).alias(name))
    return res
