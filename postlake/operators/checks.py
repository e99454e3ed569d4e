"""Data checks (G0-G22). Each check returns the failing rows; zero rows = pass.

A check returns a :class:`Check`: the failing-row frame plus the expression
that turns those rows into a failure number (``count(*)`` unless the check
defines its own). :func:`summarize` reduces a check to one row of
``failures, should_warn, should_error``; :func:`run_checks` unions such rows
for a whole suite. Every check is a plan of filters, aggregates and joins —
grouped checks aggregate partially before the shuffle, all of one relation in
one scan, and the two ordered checks use the range-partitioned scan, never a
one-task window.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions.text import slugify_name
from postlake.operators.relational import anti_join, two_way_except
from postlake.operators.sequence import ordered_scan


@dataclass
class Check:
    name: str
    rows: DataFrame
    fail_calc: Column = field(default_factory=lambda: F.count(F.lit(1)))
    # the relation that a suite reads once for all its checks, and the condition of a row check's failing rows
    source: DataFrame | None = None
    bad: Column | None = None
    # checks of groups: the keys, the numbers of a group (with their values over no rows), and when a group fails
    keys: tuple[str, ...] | None = None
    numbers: dict[str, tuple[Column, object]] = field(default_factory=dict)
    fails: Callable[[Callable[[str], Column]], Column] | None = None


def _group_check(name: str, df: DataFrame, keys: Sequence[str], numbers: dict[str, tuple[Column, object]],
                 fails: Callable[[Callable[[str], Column]], Column], where: str | None, shown: Callable[[DataFrame], DataFrame] | None = None) -> Check:
    """A check of the groups of ``keys`` (none: of the table) by numbers of each group; ``shown`` projects the failing groups."""
    groups = _src(df, where).groupBy(*keys).agg(*[c.alias(n) for n, (c, _) in numbers.items()])
    bad = groups.where(fails(F.col))
    rows = shown(bad) if shown else bad
    return Check(name, rows) if where else Check(name, rows, source=df, keys=tuple(keys), numbers=numbers, fails=fails)


def _row_check(name: str, df: DataFrame, bad: Column, where: str | None, rows: DataFrame | None = None) -> Check:
    cond = F.expr(where) & bad if where else bad
    return Check(name, df.where(cond) if rows is None else rows, source=df, bad=cond)


_OPS = {"!=": operator.ne, "<>": operator.ne, "=": operator.eq, "==": operator.eq,
        ">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le}


def _threshold(expr: str):
    expr = expr.replace(" ", "")
    for op in (">=", "<=", "!=", "<>", "==", ">", "<", "="):
        if expr.startswith(op):
            return _OPS[op], float(expr[len(op):])
    raise ValueError(f"bad threshold {expr!r}")


def _summary(name: str, failures: Column, warn_if: str, error_if: str) -> list[Column]:
    (wop, wv), (eop, ev) = _threshold(warn_if), _threshold(error_if)
    return [F.lit(name).alias("check_name"), failures.alias("failures"), wop(failures, F.lit(wv)).alias("should_warn"),
            eop(failures, F.lit(ev)).alias("should_error")]


def summarize(check: Check, warn_if: str = "!=0", error_if: str = "!=0") -> DataFrame:
    """``check_name, failures, should_warn, should_error`` for one check."""
    agg = check.rows.agg(F.coalesce(check.fail_calc, F.lit(0)).cast("long").alias("failures"))
    return agg.select(*_summary(check.name, F.col("failures"), warn_if, error_if))


def run_checks(checks: Sequence[Check | tuple[Check, str, str]]) -> DataFrame:
    """One summary row per check (G22). All row and group checks of one relation share one scan.

    The scan has an aggregate over grouping sets: a set for each group key that occurs, and the empty one for
    row checks and checks of the whole table.
    """
    parts, shared = [], []
    for c in checks:
        check, warn_if, error_if = c if isinstance(c, tuple) else (c, "!=0", "!=0")
        if check.source is None:
            parts.append(summarize(check, warn_if, error_if))
            continue
        same = next((s for s in shared if s[0] is check.source or s[0].sameSemantics(check.source)), None)
        if same is None:
            shared.append(same := (check.source, []))
        same[1].append((check, warn_if, error_if))
    for source, own in shared:
        rows = F.array(*[F.struct(*_summary(c.name, F.col(f"_f{i}"), w, e)) for i, (c, w, e) in enumerate(own)])
        parts.append(_failures(source, [c for c, _, _ in own]).select(F.inline(rows)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _failures(source: DataFrame, own: list[Check]) -> DataFrame:
    """One row with the failures ``_f<i>`` of each check of a relation."""
    number = lambda i: lambda n: F.col(f"_n{i}_{n}")
    counted = [F.count_if(F.coalesce(c.bad, F.lit(False))).alias(f"_c{i}") for i, c in enumerate(own) if c.bad is not None]
    counted += [e.alias(f"_n{i}_{n}") for i, c in enumerate(own) for n, (e, _) in c.numbers.items()]
    failed = lambda c, i: F.coalesce(c.fails(number(i)), F.lit(False))
    grouped = {i: c for i, c in enumerate(own) if c.keys}
    if not grouped:
        one, whole = source.agg(*counted), {i: F.col(f"_c{i}") if c.bad is not None else failed(c, i).cast("long") for i, c in enumerate(own)}
        return one.select(*[f.alias(f"_f{i}") for i, f in whole.items()])
    columns = list(dict.fromkeys(k for c in grouped.values() for k in c.keys))
    sets = list(dict.fromkeys([tuple(sorted(c.keys)) for c in grouped.values()] + [()] * (len(grouped) < len(own))))
    mark = lambda keys: sum(1 << (len(columns) - 1 - j) for j, k in enumerate(columns) if k not in keys)
    sums = source.groupingSets([[F.col(k) for k in s] for s in sets], *[F.col(k) for k in columns]).agg(F.grouping_id().alias("_set"), *counted)
    in_set = lambda keys: F.col("_set") == mark(keys)
    # of the empty set there is one row, or none over an empty table: then the numbers are those over no rows
    whole, values = [], []
    for i, c in enumerate(own):
        if c.keys:
            whole.append(F.count_if(in_set(c.keys) & failed(c, i)).alias(f"_f{i}"))
        elif c.bad is not None:
            whole.append(F.coalesce(F.max(F.when(in_set(()), F.col(f"_c{i}"))), F.lit(0)).alias(f"_f{i}"))
        else:
            whole += [F.coalesce(F.max(F.when(in_set(()), number(i)(n))), F.lit(none)).alias(f"_n{i}_{n}") for n, (_, none) in c.numbers.items()]
        values.append(F.col(f"_f{i}") if c.keys or c.bad is not None else failed(c, i).cast("long").alias(f"_f{i}"))
    return sums.agg(*whole).select(*values)


def _src(df: DataFrame, where: str | None) -> DataFrame:
    return df.where(where) if where else df


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


# ---------------------------------------------------------------- row checks

def accepted_range(df: DataFrame, col: str, min_value=None, max_value=None,
                   inclusive: bool = True, where: str | None = None) -> Check:
    """Rows outside [min, max] (or the open bounds); bounds may be columns; null passes."""
    c = F.col(col)
    bad = F.lit(False)
    if min_value is not None:
        bad = bad | ~((c >= _lit(min_value)) if inclusive else (c > _lit(min_value)))
    if max_value is not None:
        bad = bad | ~((c <= _lit(max_value)) if inclusive else (c < _lit(max_value)))
    return _row_check(f"accepted_range_{col}", df, bad, where)


def expression_is_true(df: DataFrame, expression: str, column_name: str | None = None,
                       where: str | None = None) -> Check:
    """Rows where the expression (optionally applied to a column) is false; null passes."""
    text = f"{column_name} {expression}" if column_name else expression
    return _row_check("expression_is_true", df, ~F.expr(text), where)


def not_empty_string(df: DataFrame, col: str, trim_whitespace: bool = True,
                     where: str | None = None) -> Check:
    """Values equal to ``''`` (after trimming by default); null passes."""
    c = F.trim(F.col(col)) if trim_whitespace else F.col(col)
    vals = _src(df, where).select(c.alias(col))
    return _row_check(f"not_empty_string_{col}", df, c == "", where, vals.where(F.col(col) == ""))


def not_null(df: DataFrame, col: str, where: str | None = None) -> Check:
    return _row_check(f"not_null_{col}", df, F.col(col).isNull(), where, _src(df, where).select(col).where(F.col(col).isNull()))


def assert_equal(df: DataFrame, actual: str, expected: str) -> Check:
    """Rows where two columns differ (a null comparison passes)."""
    return _row_check("assert_equal", df, F.col(actual) != F.col(expected), None)


# ------------------------------------------------------------ value checks

def not_accepted_values(df: DataFrame, col: str, values: Sequence, where: str | None = None) -> Check:
    """Distinct values that are in the forbidden list, as ``value_field``."""
    return _group_check(f"not_accepted_values_{col}", df, [col], {"n_records": (F.count(F.lit(1)), 0)}, lambda n: F.col(col).isin(list(values)),
                        where, lambda g: g.select(F.col(col).alias("value_field")))


def accepted_values(df: DataFrame, col: str, values: Sequence, where: str | None = None) -> Check:
    """Values outside the list with their row count (``value_field, n_records``); null passes."""
    return _group_check(f"accepted_values_{col}", df, [col], {"n_records": (F.count(F.lit(1)), 0)}, lambda n: ~F.col(col).isin(list(values)),
                        where, lambda g: g.select(F.col(col).alias("value_field"), "n_records"))


def unique(df: DataFrame, col: str, where: str | None = None) -> Check:
    """Non-null values seen more than once (``unique_field, n_records``)."""
    return _group_check(f"unique_{col}", df, [col], {"n_records": (F.count(F.lit(1)), 0)}, lambda n: F.col(col).isNotNull() & (n("n_records") > 1),
                        where, lambda g: g.select(F.col(col).alias("unique_field"), "n_records"))


def unique_combination(df: DataFrame, cols: Sequence[str], where: str | None = None) -> Check:
    """Combinations of ``cols`` that occur more than once."""
    return _group_check("unique_combination_of_columns", df, cols, {"_n": (F.count(F.lit(1)), 0)}, lambda n: n("_n") > 1, where, lambda g: g.select(*cols))


# ----------------------------------------------------------- group checks

def at_least_one(df: DataFrame, col: str, group_by: Sequence[str] = (), where: str | None = None) -> Check:
    """Groups (or the table) without a single non-null value of ``col``."""
    return _group_check(f"at_least_one_{col}", df, group_by, {"n_present": (F.count(F.col(col)), 0)}, lambda n: n("n_present") == 0, where)


def not_constant(df: DataFrame, col: str, group_by: Sequence[str] = (), where: str | None = None) -> Check:
    """Groups whose non-null values are all one value (``n_values`` = 1); an empty group passes."""
    return _group_check(f"not_constant_{col}", df, group_by, {"_lo": (F.min(col), None), "_hi": (F.max(col), None)}, lambda n: n("_lo") == n("_hi"),
                        where, lambda g: g.select(*group_by, F.lit(1).cast("long").alias("n_values")))


def not_null_proportion(df: DataFrame, col: str, at_least: float, at_most: float = 1.0,
                        group_by: Sequence[str] = (), where: str | None = None) -> Check:
    """Groups whose share of non-null ``col`` lies outside [at_least, at_most]."""
    share = (F.count(F.col(col)) / F.nullif(F.count(F.lit(1)), F.lit(0))).cast("double")
    return _group_check(f"not_null_proportion_{col}", df, group_by, {"not_null_proportion": (share, None)},
                        lambda n: (n("not_null_proportion") < at_least) | (n("not_null_proportion") > at_most), where)


_UNITS = {"second", "minute", "hour", "day", "week", "month", "quarter", "year"}


def _add_interval(ts: Column, datepart: str, n) -> Column:
    if datepart not in _UNITS:
        raise ValueError(f"unsupported datepart {datepart!r}")
    return F.timestamp_add(datepart.upper(), _lit(n), ts)


def recency(df: DataFrame, field: str, datepart: str, interval: int,
            ignore_time_component: bool = False, group_by: Sequence[str] = (),
            now=None, where: str | None = None) -> Check:
    """Groups whose newest ``field`` is older than ``now - interval datepart``.

    An empty or all-null group has a null maximum and passes. ``now``
    defaults to the current timestamp; pass a fixed value for repeatable runs.
    """
    typ = dict(df.dtypes).get(field, "timestamp")
    zone_less = typ in ("timestamp_ntz", "date")
    if now is None:
        now_c = F.localtimestamp() if zone_less else F.current_timestamp()
    else:
        now_c = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz" if zone_less else "timestamp")
    threshold = _add_interval(now_c, datepart, -interval)
    mx = F.max(F.col(field))
    if ignore_time_component:
        threshold, mx = F.to_date(threshold), F.to_date(mx)
    elif typ == "date":
        mx = mx.cast("timestamp_ntz")
    return _group_check(f"recency_{field}", df, group_by, {"most_recent": (mx, None)}, lambda n: n("most_recent") < threshold, where,
                        lambda g: g.select(*group_by, "most_recent", threshold.alias("threshold")))


# --------------------------------------------------------- compare checks

def _count_join(a: DataFrame, b: DataFrame, group_by: Sequence[str], na: str, nb: str) -> DataFrame:
    if not group_by:
        # two table counts: scalar subqueries on a one-row frame, no join
        return a.sparkSession.range(1).select(a.agg(F.count(F.lit(1))).scalar().alias(na),
                                              b.agg(F.count(F.lit(1))).scalar().alias(nb))
    ga = a.groupBy(*group_by).agg(F.count(F.lit(1)).alias(na))
    gb = b.groupBy(*group_by).agg(F.count(F.lit(1)).alias(nb))
    x, y = ga.alias("a"), gb.alias("b")
    cond = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in group_by]
    cols = []
    for c in group_by:
        cols += [F.col(f"a.{c}").alias(f"{c}_a"), F.col(f"b.{c}").alias(f"{c}_b")]
    return x.join(y, cond, "full_outer").select(*cols, F.col(na), F.col(nb))


def equal_rowcount(a: DataFrame, b: DataFrame, group_by: Sequence[str] = (),
                   strict_reference: bool = False) -> Check:
    """Row-count difference per group; failure number = sum of differences.

    A group present on one side only counts the other side as 0 (it fails);
    ``strict_reference=True`` keeps the older behaviour where such a group has
    a null difference and passes.
    """
    j = _count_join(a, b, group_by, "count_a", "count_b")
    if strict_reference:
        diff = F.abs(F.col("count_a") - F.col("count_b"))
    else:
        diff = F.abs(F.coalesce(F.col("count_a"), F.lit(0)) - F.coalesce(F.col("count_b"), F.lit(0)))
    rows = j.withColumn("diff_count", diff)
    return Check("equal_rowcount", rows, F.sum(F.coalesce(F.col("diff_count"), F.lit(0))))


def fewer_rows_than(a: DataFrame, b: DataFrame, group_by: Sequence[str] = (),
                    strict_reference: bool = False) -> Check:
    """Per group: the excess when ``a`` has more rows, 1 when equal, else 0."""
    j = _count_join(a, b, group_by, "count_our_model", "count_comparison_model")
    ca, cb = F.col("count_our_model"), F.col("count_comparison_model")
    if not strict_reference:
        ca, cb = F.coalesce(ca, F.lit(0)), F.coalesce(cb, F.lit(0))
    delta = F.when(ca > cb, ca - cb).when(ca == cb, F.lit(1)).otherwise(F.lit(0))
    rows = j.withColumn("row_count_delta", delta)
    return Check("fewer_rows_than", rows, F.sum(F.coalesce(F.col("row_count_delta"), F.lit(0))))


def equality(a: DataFrame, b: DataFrame, compare_columns: Sequence[str] | None = None) -> Check:
    """Distinct rows in one side only, labelled ``a_minus_b`` / ``b_minus_a``.

    Failure number: the row count plus the absolute imbalance of the labels.
    Duplicate counts are not compared (use :func:`equal_rowcount` as well).
    """
    cols = list(compare_columns) if compare_columns else a.columns
    rows = two_way_except(a.select(*cols), b.select(*cols))
    calc = F.count(F.lit(1)) + F.coalesce(F.abs(
        F.sum(F.when(F.col("which_diff") == "a_minus_b", 1).otherwise(0))
        - F.sum(F.when(F.col("which_diff") == "b_minus_a", 1).otherwise(0))), F.lit(0))
    return Check("equality", rows, calc)


def cardinality_equality(a: DataFrame, col: str, b: DataFrame, field: str) -> Check:
    """Value → row-count pairs present on one side only (both directions)."""
    side = lambda df, c, n: df.select(F.col(c).alias(col), F.lit(n).alias("_side"))
    both = side(a, col, 0).union(side(b, field, 1)).groupBy(col).agg(
        F.count_if(F.col("_side") == 0).alias("_a"), F.count_if(F.col("_side") == 1).alias("_b"))
    # a value without rows on a side has no pair there
    pairs = both.where("_a <> _b").select(col, F.explode(F.filter(F.array("_a", "_b"), lambda n: n > 0)).alias("num_rows"))
    return Check(f"cardinality_equality_{col}", pairs)


def relationships_where(df: DataFrame, col: str, to: DataFrame, field: str,
                        from_condition: str = "1=1", to_condition: str = "1=1") -> Check:
    """Non-null child keys without a parent, both sides filtered (``id, right_id``)."""
    left = df.where(from_condition).where(F.col(col).isNotNull()).select(F.col(col).alias("id"))
    right = to.where(to_condition).where(F.col(field).isNotNull()).select(F.col(field).alias("right_id"))
    miss = anti_join(left, right, ["id"], ["right_id"])
    return Check(f"relationships_where_{col}",
                 miss.select("id", F.lit(None).cast(right.schema["right_id"].dataType).alias("right_id")))


def columns_match(df: DataFrame, expected: Sequence[str]) -> Check:
    """Column names in the table but not expected, or expected but absent (case-folded)."""
    spark = df.sparkSession
    have = spark.createDataFrame([(c.lower(),) for c in df.columns], "actual_column string")
    want = spark.createDataFrame([(c.lower(),) for c in expected], "expected_column string")
    j = have.join(want, have["actual_column"] == want["expected_column"], "full_outer")
    return Check("columns_match", j.where(F.col("actual_column").isNull() | F.col("expected_column").isNull()))


# --------------------------------------------------------- ordered checks

def sequential_values(df: DataFrame, col: str, interval=1, datepart: str | None = None,
                      group_by: Sequence[str] = (), where: str | None = None,
                      num_partitions: int | None = None) -> Check:
    """Rows whose value is not the previous value (in value order) plus ``interval``.

    The first row of each group has no previous value and passes. The
    previous value comes from the range-partitioned scan, so neither an
    ungrouped check nor a hot group lands in a single task.
    """
    group_by = list(group_by)
    prev_name = "previous_" + slugify_name(col)
    src = _src(df, where).select(*group_by, col)
    scanned = ordered_scan(src, group_by, [f"{col} nulls last"], prev=[col],
                           num_partitions=num_partitions)
    prev = F.col("prev_" + col)
    if datepart:
        ts = "timestamp" if dict(src.dtypes)[col] == "timestamp" else "timestamp_ntz"
        ok = F.col(col).cast(ts) == _add_interval(prev.cast(ts), datepart, interval)
    else:
        ok = F.col(col) == prev + _lit(interval)
    rows = scanned.where(~ok).select(*group_by, col, prev.alias(prev_name))
    return Check(f"sequential_values_{col}", rows)


_GAPS = {"not_allowed": ("=", "equal_to"), "allowed": ("<=", "less_than_or_equal_to"),
         "required": ("<", "less_than")}


def mutually_exclusive_ranges(df: DataFrame, lower: str, upper: str,
                              partition_by: Sequence[str] = (), gaps: str = "allowed",
                              zero_length_range_allowed: bool = False,
                              num_partitions: int | None = None) -> Check:
    """Ranges that are empty/reversed or run into the next range of their partition.

    Order is ``lower, upper`` (nulls last). ``gaps`` = ``allowed`` /
    ``not_allowed`` / ``required`` compares ``upper`` with the next ``lower``
    by ``<=`` / ``=`` / ``<``; a null bound fails. The last range of a
    partition needs no successor.
    """
    if gaps not in _GAPS:
        raise ValueError(f"no rule for gaps={gaps!r}; known are {', '.join(sorted(_GAPS))}")
    gap_op, gap_words = _GAPS[gaps]
    z_op, z_words = ("<=", "less_than_or_equal_to") if zero_length_range_allowed else ("<", "less_than")
    partition_by = list(partition_by)
    src = df.select(*partition_by, F.col(lower).alias("lower_bound"),
                    F.col(upper).alias("upper_bound"), F.lit(1).alias("_one"))
    scanned = ordered_scan(src, partition_by,
                           ["lower_bound nulls last", "upper_bound nulls last"],
                           next=["lower_bound", "_one"], num_partitions=num_partitions)
    lo, up, nxt = F.col("lower_bound"), F.col("upper_bound"), F.col("next_lower_bound")
    is_last = F.col("next__one").isNull()
    c1 = F.coalesce(_OPS[z_op](lo, up), F.lit(False))
    c2 = F.coalesce(_OPS[gap_op](up, nxt), is_last, F.lit(False))
    part_cols = ([F.col(partition_by[0]).alias("partition_by_col")] if len(partition_by) == 1
                 else [F.col(c) for c in partition_by])
    rows = scanned.select(*part_cols, lo, up, nxt.alias("next_lower_bound"),
                          is_last.alias("is_last_record"),
                          c1.alias(f"lower_bound_{z_words}_upper_bound"),
                          c2.alias(f"upper_bound_{gap_words}_next_lower_bound"))
    return Check("mutually_exclusive_ranges",
                 rows.where(~(F.col(f"lower_bound_{z_words}_upper_bound")
                              & F.col(f"upper_bound_{gap_words}_next_lower_bound"))))
