"""Ordered scans (lag, lead, row index, running max, run length) that stay parallel.

``Window.partitionBy(key).orderBy(...)`` sends every row of one key to one
task, and a window with no key sends the whole table there. A key holding a
third of the table therefore becomes one task holding a third of the table.
The scan here cuts the sorted table into ranges and runs ordinary windows
inside them:

1. Every row gets a number, stored with the needed columns in the checkpoint
   folder, so that rows that tie in keys and order have places of their own.
2. A sample of the stored rows, sorted, gives the splitters of the ranges:
   rows of keys, order and number, of which a session variable keeps the
   array. A row's range is a plain expression of them, a binary search, so
   every consumer and every repeated task sees the same ranges. A hot key is
   spread over many ranges, and so are rows that tie.
3. Windows over (key, range) compute every value inside a range; the result
   is stored, so that rows are sorted once.
4. Only the keys that the splitters name can lie in several ranges (a key
   between two splitters lies in one). For those, the first and last stored
   rows of each range, which hold its sums, are carried over the key's ranges
   by a small window (all in all at most two rows for each range), and joined
   back by key and range.

The caller projects ``df`` to the columns it needs before the scan: they are
written twice and shuffled once.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.session import stored

_RP, _TIE, _KEY, _AT = "_scan_rp", "_scan_tie", "_scan_key", "_scan_at"
# Target size of one range. Beyond MAX_RANGES of them ranges grow: the array of
# splitters has an entry for each range but one.
TARGET_RANGE_BYTES = 256 * 1024 * 1024
MAX_RANGES = 1_000_000
# Sampled rows for each range; ranges up to which the search is spelled out, and up to which the splitters are a local table.
SAMPLE = 64
SPELLED_OUT = 64
LOCAL_CUTS = 10_000


def range_count(df: DataFrame) -> int:
    """Number of ranges for ``df``: size of the data it reads / 256 MiB, at least the shuffle partitions.

    The size is the sum of the leaf relations' sizes (files, checkpoints,
    local rows), not the estimate at the top of the plan: without cost-based
    statistics a join's estimate is the product of its inputs and would
    explode the range count for small page-level tables.
    """
    floor = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return max(floor, min(MAX_RANGES, -(-size // TARGET_RANGE_BYTES)))


def _place(df: DataFrame, order: Sequence[str]) -> Column:
    """A struct that sorts as the order columns, then the row number; ``"c nulls last"`` puts nulls behind all values."""
    fields = []
    for i, text in enumerate(order):
        name = text.removesuffix(" nulls last")
        if name != text:
            fields.append(F.col(name).isNull().alias(f"n{i}"))
        fields.append(F.col(name).alias(f"c{i}"))
    tie = F.col(_TIE) if _TIE in df.columns else F.lit(0).cast("long")
    return F.struct(*fields, tie.alias("tie"))


def _placed(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with its key and place as one column each."""
    return df.withColumn(_KEY, F.struct(*[F.col(k) for k in keys] or [F.lit(0).alias("all")])).withColumn(_AT, _place(df, order))


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with a stored number per row, by which rows that tie are split over ranges."""
    return stored(df.withColumn(_TIE, F.monotonically_increasing_id()), "scan-rows")


class Cuts:
    """The splitters of ``n`` ranges: at most n - 1 keys and places, each the first of a range after the first."""

    def __init__(self, table: DataFrame, n: int, rows: list | None = None):
        self.table, self.n, self.rows = table, n, rows

    def range_of(self) -> Column:
        """How many splitters are not above the row's key and place: a binary search in a constant array.

        The array is a session variable's value. For few ranges the search is spelled out as nested conditions, which
        Spark compiles; for more it is a loop over its steps.
        """
        spark, name = self.table.sparkSession, f"scan_{uuid.uuid4().hex}"
        if self.rows is None:
            one = self.table.agg(F.sort_array(F.collect_list(F.struct(_KEY, _AT))).alias("all"))
        else:
            schema = T.StructType([T.StructField("all", T.ArrayType(self.table.schema))])
            one = spark.createDataFrame([(self.rows,)], schema).select(F.sort_array("all").alias("all"))
        spark.sql(f"DECLARE VARIABLE {name} {one.schema['all'].dataType.simpleString()}")
        spark.sql(f"SET VAR {name} = (SELECT `all` FROM {{one}})", one=one)
        cuts, row = F.expr(name), F.struct(_KEY, _AT)
        if self.n <= SPELLED_OUT:
            def search(lo: int, hi: int) -> Column:
                if lo == hi:
                    return F.lit(lo)
                mid = (lo + hi) // 2
                return F.when(F.coalesce(row < F.get(cuts, F.lit(mid)), F.lit(True)), search(lo, mid)).otherwise(search(mid + 1, hi))

            return search(0, self.n - 1)
        both = F.array(F.struct(cuts.alias("cuts"), row.alias("row")))
        steps = F.array(*[F.lit(1 << k) for k in reversed(range(self.n.bit_length()))])
        return F.transform(both, lambda x: F.aggregate(steps, F.lit(0), lambda at, s: at + F.when(
            F.get(x["cuts"], at + s - 1) <= x["row"], s).otherwise(0)))[0]


def splitters(rows: DataFrame, keys: Sequence[str], order: Sequence[str], n: int | None = None) -> Cuts:
    """Splitters of ``n`` ranges (default: :func:`range_count`) from a sorted sample of ``rows``, a stored table.

    The sample has about SAMPLE rows for each range, so sorting it in one task is bounded by the number of ranges.
    """
    n = n or range_count(rows)
    total, picked = rows.count(), _placed(rows, keys, order).select(_KEY, _AT)
    if total > 2 * SAMPLE * n:
        picked = picked.sample(False, SAMPLE * n / total, 7)
    turn = F.row_number().over(Window.orderBy(_KEY, _AT)) - 1
    size = F.count(F.lit(1)).over(Window.partitionBy())
    part = lambda i: F.floor(i * n / F.col("_scan_size"))
    turns = picked.withColumn("_scan_rp", turn).withColumn("_scan_size", size)
    cuts = turns.where((F.col("_scan_rp") > 0) & (part(F.col("_scan_rp")) > part(F.col("_scan_rp") - 1))).select(_KEY, _AT)
    if n > LOCAL_CUTS:
        return Cuts(stored(cuts, "scan-splitters"), n)
    found = cuts.collect()
    return Cuts(rows.sparkSession.createDataFrame(found, cuts.schema), n, found)


def _cut(df: DataFrame, keys: Sequence[str], order: Sequence[str], num_partitions: int | None, cuts: Cuts | None) -> tuple[DataFrame, Cuts]:
    """``df`` with the scan's columns (key, place, range), and its splitters."""
    if cuts is None:
        df = numbered(df)
        cuts = splitters(df, keys, order, num_partitions or range_count(df))
    return _placed(df, keys, order).withColumn(_RP, cuts.range_of()), cuts


def ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str], num_partitions: int | None = None,
           cuts: Cuts | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, cuts): ``df`` with the scan's columns (key, place, range), and its splitters.

    Without ``cuts`` the rows are numbered and stored. With cuts, which were made from a table of the same keys and
    places, ``df`` is a stored table whose order tells rows apart.
    """
    rows, cuts = _cut(df, keys, order, num_partitions, cuts)
    return rows, cuts.table


def ordered_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 prev: Sequence[str] = (), next: Sequence[str] = (),
                 running_max: Sequence[str] = (), runs: Sequence[str] = (),
                 sums: Sequence[str] = (), num_partitions: int | None = None, cuts: Cuts | None = None) -> DataFrame:
    """Add ordered-scan columns to ``df`` without a one-task window.

    Per row, within its ``keys`` group in ascending ``order`` (column names, nulls first; ``"c nulls last"``
    puts them last; rows that tie come in any order):

    * ``_idx``: 0-based position,
    * ``prev_<c>`` / ``next_<c>``: value of ``c`` in the previous / next row,
    * ``max_<c>``: running maximum of ``c`` up to this row (nulls skipped),
    * ``run_<c>``: length of the run of true values of boolean ``c`` ending here,
    * ``sum_<c>``: running sum of whole-number ``c`` up to this row (nulls are 0).

    ``cuts``: as for :func:`ranged`, for several scans of tables with the same keys and places.
    """
    keys, prev, next_, running_max, runs, sums = (list(x) for x in (keys, prev, next, running_max, runs, sums))
    rows, cuts = _cut(df, keys, order, num_partitions, cuts)
    # rows that tie come in any order, so a range is sorted by the plain columns alone: no key, place or number is shuffled
    by = [F.col(t.removesuffix(" nulls last")).asc_nulls_last() if t.endswith(" nulls last") else F.col(t).asc_nulls_first() for t in order]
    flat = rows.select(*[F.col(f"`{c}`") for c in df.columns], _RP)
    inside = Window.partitionBy(*keys, _RP).orderBy(*by)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    value = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0))
    stop = lambda c: F.when(~F.coalesce(F.col(c), F.lit(False)), F.col("_scan_turn"))
    packed = lambda names: F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)] or [F.lit(1)])

    local = flat.select("*", F.row_number().over(inside).alias("_scan_turn"), F.lead(packed(next_)).over(inside).alias("_scan_next"),
                        *[F.lag(packed(prev)).over(inside).alias("_scan_prev")] * bool(prev),
                        *[F.max(c).over(upto).alias("max_" + c) for c in running_max],
                        *[F.sum(value(c)).over(upto).alias("sum_" + c) for c in sums])
    local = local.select("*", *[F.max(stop(c)).over(upto).alias("_stop_" + c) for c in runs])
    local = local.withColumns({"_scan_end": F.col("_scan_next").isNull(), **{"prev_" + c: F.col("_scan_prev")[f"c{i}"] for i, c in enumerate(prev)},
                               **{"next_" + c: F.col("_scan_next")[f"c{i}"] for i, c in enumerate(next_)}})
    local = stored(local.drop("_scan_next", "_scan_prev"), "scan-ranges")
    local = local.withColumn(_KEY, F.struct(*[F.col(k) for k in keys] or [F.lit(0).alias("all")]))

    # what a range hands on: only keys that a splitter names can go on in the next range
    ends = local.where((F.col("_scan_turn") == 1) | F.col("_scan_end"))
    torn = ends if not keys else ends.join(cuts.table.select(_KEY).distinct(), _KEY, "left_semi")
    handed = torn.groupBy(_KEY, _RP).agg(
        F.max("_scan_turn").alias("_n"),
        *[F.max_by(F.struct(c), "_scan_turn").alias("_last_" + c) for c in prev],
        *[F.min_by(F.struct(c), "_scan_turn").alias("_first_" + c) for c in next_],
        *[F.max("max_" + c).alias("_max_" + c) for c in running_max],
        *[F.max_by("sum_" + c, "_scan_turn").alias("_sum_" + c) for c in sums],
        *[F.max("_stop_" + c).alias("_stop_" + c) for c in runs])
    over = Window.partitionBy(_KEY).orderBy(_RP)
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    ends = F.sum("_n").over(over.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    handed = handed.withColumn("_ends", ends)
    zero = lambda c: F.coalesce(c, F.lit(0))
    carry = handed.select(
        F.col(_KEY).alias("_carry_key"), F.col(_RP).alias("_carry_rp"), zero(F.sum("_n").over(before)).alias("_carry_n"),
        *[F.lag("_last_" + c).over(over).alias("_carry_prev_" + c) for c in prev],
        *[F.lead("_first_" + c).over(over).alias("_carry_next_" + c) for c in next_],
        *[F.max("_max_" + c).over(before).alias("_carry_max_" + c) for c in running_max],
        *[zero(F.sum("_sum_" + c).over(before)).alias("_carry_sum_" + c) for c in sums],
        # rows since the last break in the ranges before
        *[(zero(F.sum("_n").over(before)) - zero(F.max(F.col("_ends") - F.col("_n") + F.col("_stop_" + c)).over(before))).alias("_carry_run_" + c)
          for c in runs])

    if cuts.n <= LOCAL_CUTS:
        carry = F.broadcast(carry)
    both = local.join(carry, (F.col(_KEY) == F.col("_carry_key")) & (F.col(_RP) == F.col("_carry_rp")), "left")
    begins = F.col("_scan_turn") == 1
    out = [F.col(f"`{c}`") for c in df.columns]
    out.append((F.col("_scan_turn") - 1 + zero(F.col("_carry_n"))).cast("long").alias("_idx"))
    for c in prev:
        out.append(F.when(begins, F.col("_carry_prev_" + c)[c]).otherwise(F.col("prev_" + c)).alias("prev_" + c))
    for c in next_:
        out.append(F.when(F.col("_scan_end"), F.col("_carry_next_" + c)[c]).otherwise(F.col("next_" + c)).alias("next_" + c))
    for c in running_max:
        out.append(F.greatest("max_" + c, "_carry_max_" + c).alias("max_" + c))
    for c in sums:
        out.append((F.col("sum_" + c) + zero(F.col("_carry_sum_" + c))).alias("sum_" + c))
    for c in runs:
        unbroken = F.col("_scan_turn") + zero(F.col("_carry_run_" + c))
        out.append(F.when(F.col("_stop_" + c).isNull(), unbroken).otherwise(F.col("_scan_turn") - F.col("_stop_" + c)).cast("long").alias("run_" + c))
    return both.select(*out)
