"""Salary and experience text → typed columns (C1, C2), as native expressions.

Everything here is a ``Column`` expression: the parse runs as Catalyst
expressions on the executors, with no Python in the hot path. The lower-cased
text and the number matches are bound once per row (see ``let``) instead of
being recomputed in every branch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions._util import as_col, contains_any, let

# The word lists and patterns of the record contract's parsers
# (all word tests are substring tests on the lower-cased text).
SALARY_DEAL_WORDS = ["thỏa thuận", "negotiable", "deal", "login", "cạnh tranh"]
SALARY_MIN_WORDS = ["từ", "trên", "min", ">", "+"]
SALARY_MAX_WORDS = ["đến", "tới", "dưới", "max", "<"]
SALARY_MILLION_WORD = "triệu"
SALARY_USD_MARKS = ["$", "usd"]
SALARY_NUMBER = r"(\d+(?:\.\d+)?)"
DEFAULT_USD_RATE = 25000.0

EXPERIENCE_NONE_WORDS = ["không yêu cầu", "chưa có", "không đề cập", "any"]
EXPERIENCE_MIN_WORDS = ["trên", "từ", "min", ">", "+"]
EXPERIENCE_MAX_WORDS = ["dưới", "tới", "đến", "max", "<"]
EXPERIENCE_NUMBER = r"(\d+)"


def _salary_flags(raw: Column, low: Column, s: Column, nums: Column, usd_rate: float) -> dict[str, Column]:
    """The values the salary rule branches on, each computed once."""
    n = F.size(nums)
    mult = (F.when(s.contains(SALARY_MILLION_WORD), F.lit(1_000_000.0))
             .when(contains_any(s, SALARY_USD_MARKS), F.lit(float(usd_rate)))
             .otherwise(F.lit(1.0)))
    return {
        "n": n,
        "first": F.try_element_at(nums, F.lit(1)).cast("double") * mult,
        "second": F.try_element_at(nums, F.lit(2)).cast("double") * mult,
        "deal": raw.isNull() | (raw == "") | contains_any(low, SALARY_DEAL_WORDS) | (n == 0),
        "min_word": contains_any(s, SALARY_MIN_WORDS),
        "max_word": contains_any(s, SALARY_MAX_WORDS),
    }


def _salary_rule(f: dict[str, Column]) -> list[Column]:
    n, first, second, deal = f["n"], f["first"], f["second"], f["deal"]
    smin = (F.when(deal, None).when(n >= 2, first).when(f["min_word"], first)
             .when(f["max_word"], None).otherwise(first))
    smax = (F.when(deal, None).when(n >= 2, second).when(f["min_word"], None)
             .when(f["max_word"], first).otherwise(first))
    return [smin.cast("double").alias("salary_min"), smax.cast("double").alias("salary_max"),
            F.coalesce(deal, F.lit(True)).alias("deal_salary")]


def _experience_flags(raw: Column, s: Column, nums: Column) -> dict[str, Column]:
    n = F.size(nums)
    return {
        "n": n,
        "first": F.try_element_at(nums, F.lit(1)).try_cast("int"),
        "second": F.try_element_at(nums, F.lit(2)).try_cast("int"),
        "none": raw.isNull() | (raw == "") | contains_any(s, EXPERIENCE_NONE_WORDS) | (n == 0),
        "min_word": contains_any(s, EXPERIENCE_MIN_WORDS),
        "max_word": contains_any(s, EXPERIENCE_MAX_WORDS),
    }


def _experience_rule(f: dict[str, Column]) -> list[Column]:
    n, first, second, none = f["n"], f["first"], f["second"], f["none"]
    emin = (F.when(none, None).when(n >= 2, first).when(f["min_word"], first)
             .when(f["max_word"], None).otherwise(first))
    emax = (F.when(none, None).when(n >= 2, second).when(f["min_word"], None)
             .when(f["max_word"], first).otherwise(first))
    return [emin.cast("int").alias("experience_min"), emax.cast("int").alias("experience_max"),
            F.coalesce(none, F.lit(True)).alias("experience_not_mentioned")]


def _staged(df: DataFrame, prefix: str, flags: dict[str, Column]) -> tuple[DataFrame, dict[str, Column]]:
    """Add each flag as a column (kept apart by Catalyst, so computed once per row)."""
    for k, v in flags.items():
        df = df.withColumn(f"{prefix}{k}", v)
    return df, {k: F.col(f"{prefix}{k}") for k in flags}


def parse_salary(col, usd_rate: float = DEFAULT_USD_RATE) -> Column:
    """Salary text → ``struct<salary_min double, salary_max double, deal_salary boolean>``.

    Empty or null text, a negotiable word, or text without digits is a deal
    (both bounds null). Commas become dots before numbers are taken, so a
    thousands separator reads as a decimal point (``1,000 USD`` → 1.0 × rate).
    Numbers are scaled by a million for ``triệu``, else by ``usd_rate`` for
    ``$``/``usd``. Two or more numbers give min and max; one number gives min
    only after a "from" word, max only after an "up to" word, else both.
    For whole tables :func:`with_salary` is faster (staged columns).
    """
    raw = as_col(col)

    def with_low(low):
        s = F.replace(low, F.lit(","), F.lit("."))
        return let(F.regexp_extract_all(s, F.lit(SALARY_NUMBER), 1),
                   lambda nums: F.struct(*_salary_rule(_salary_flags(raw, low, s, nums, usd_rate))))

    return let(F.lower(raw), with_low)


def parse_experience(col) -> Column:
    """Experience text → ``struct<experience_min int, experience_max int, experience_not_mentioned boolean>``.

    Null/empty text, a "not required" word, or text without digits is "not
    mentioned". Integers are ``\\d+`` runs (a run too long for an int is
    null); the one/two-number rule is the same as for salaries.
    For whole tables :func:`with_experience` is faster (staged columns).
    """
    raw = as_col(col)
    return let(F.lower(raw), lambda s: let(F.regexp_extract_all(s, F.lit(EXPERIENCE_NUMBER), 1),
                                           lambda nums: F.struct(*_experience_rule(
                                               _experience_flags(raw, s, nums)))))


def with_salary(df: DataFrame, col: str, usd_rate: float = DEFAULT_USD_RATE) -> DataFrame:
    """Add ``salary_min, salary_max, deal_salary`` parsed from ``col`` (rules of :func:`parse_salary`).

    The lower-cased text, the number matches and the branch flags are real
    intermediate columns: Catalyst keeps such non-cheap producers in their own
    projection, so each is computed once per row, and the final rule is small
    enough to stay in whole-stage generated code.
    """
    staged = (df.withColumn("_sal_low", F.lower(F.col(col)))
                .withColumn("_sal_s", F.replace(F.col("_sal_low"), F.lit(","), F.lit(".")))
                .withColumn("_sal_nums", F.regexp_extract_all(F.col("_sal_s"), F.lit(SALARY_NUMBER), 1)))
    staged, flags = _staged(staged, "_sal_", _salary_flags(
        F.col(col), F.col("_sal_low"), F.col("_sal_s"), F.col("_sal_nums"), usd_rate))
    keep = [F.col(f"`{c}`") for c in df.columns if c not in ("salary_min", "salary_max", "deal_salary")]
    return staged.select(*keep, *_salary_rule(flags))


def with_experience(df: DataFrame, col: str) -> DataFrame:
    """Add ``experience_min, experience_max, experience_not_mentioned`` parsed from ``col``."""
    staged = (df.withColumn("_exp_s", F.lower(F.col(col)))
                .withColumn("_exp_nums", F.regexp_extract_all(F.col("_exp_s"), F.lit(EXPERIENCE_NUMBER), 1)))
    staged, flags = _staged(staged, "_exp_", _experience_flags(F.col(col), F.col("_exp_s"), F.col("_exp_nums")))
    drop = ("experience_min", "experience_max", "experience_not_mentioned")
    keep = [F.col(f"`{c}`") for c in df.columns if c not in drop]
    return staged.select(*keep, *_experience_rule(flags))
