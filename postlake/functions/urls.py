"""URL expressions (C3, C5, C6, C12-C14) written with native string functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions._util import as_col

# Prefixes stripped by the host/path helpers and the path marker
# after which a posting URL carries the company slug.
HOST_STRIP_PREFIXES = ["android-app://", "http://", "https://"]
PATH_STRIP_PREFIXES = ["http://", "https://"]
COMPANY_SLUG_MARKER = "/detail-jobs/"


def clean_url(col) -> Column:
    """Cut at the first ``?``, then at the first ``#``, then strip every trailing ``/``.

    Null or empty input gives ``''``.
    """
    u = F.coalesce(as_col(col), F.lit(""))
    cut = F.split_part(F.split_part(u, F.lit("?"), F.lit(1)), F.lit("#"), F.lit(1))
    return F.rtrim(cut, F.lit("/"))


def absolute_url(col, base_url) -> Column:
    """Prefix a root-relative link (``/...``) with ``base_url`` (text or column); other values pass."""
    c = as_col(col)
    base = base_url if isinstance(base_url, Column) else F.lit(base_url)
    return F.when(c.startswith("/"), F.concat(base, c)).otherwise(c)


def _company_parts(comp: Column, u: Column) -> Column:
    """Parts of a posting URL's slug where the company is to be filled from it, else null."""
    tail = F.rtrim(F.element_at(F.split(u, COMPANY_SLUG_MARKER), -1), F.lit("/"))
    return F.when((comp.isNull() | (comp == "")) & u.isNotNull() & (u != "") & u.contains(COMPANY_SLUG_MARKER), F.split(tail, "-"))


def _company_of_parts(comp: Column, parts: Column) -> Column:
    return F.when(F.size(parts) > 1, F.initcap(F.array_join(F.slice(parts, 1, F.size(parts) - 1), " "))).otherwise(comp)


def company_from_url(company, url) -> Column:
    """Fill an empty company from a posting URL's slug.

    When the company is null or empty and the URL contains ``/detail-jobs/``:
    take the text after the last marker, strip trailing ``/``, split on ``-``,
    drop the last part (the job number), join with spaces and title-case. With
    one part only, or no marker, the company is left as it was.
    For whole tables :func:`with_company` is faster (staged columns).
    """
    comp = as_col(company)
    return _company_of_parts(comp, _company_parts(comp, as_col(url)))


def with_company(df: DataFrame, company: str, url: str) -> DataFrame:
    """Fill ``company`` from ``url`` (rules of :func:`company_from_url`); the slug's parts are a column, so a URL is cut once and generated code stays small."""
    staged = df.withColumn("_slug", _company_parts(F.col(company), F.col(url)))
    return staged.withColumn(company, _company_of_parts(F.col(company), F.col("_slug"))).drop("_slug")


def url_host(col) -> Column:
    """Host of a URL: drop the scheme prefixes, cut at the first ``/`` then ``?``."""
    u = as_col(col)
    for p in HOST_STRIP_PREFIXES:
        u = F.replace(u, F.lit(p), F.lit(""))
    return F.split_part(F.split_part(u, F.lit("/"), F.lit(1)), F.lit("?"), F.lit(1)).cast("string")


def url_path(col) -> Column:
    """Path of a URL: the text after the first ``/`` up to ``?``, no leading slash.

    A bare host (no ``/`` and no ``?``) yields the host itself; a host followed
    directly by ``?`` yields ``''``; fragments are kept.
    """
    u = as_col(col)
    for p in PATH_STRIP_PREFIXES:
        u = F.replace(u, F.lit(p), F.lit(""))
    # with a slash, what follows the first one; else, before a "?", nothing; else the whole text
    return F.regexp_replace(F.regexp_replace(u, r"(?s)^[^/]*/|^[^/?]*(?=\?)", ""), r"(?s)\?.*$", "")


def url_parameter(col, name: str) -> Column:
    """Value of ``name=`` up to the next ``&``; empty → null.

    This is a substring match, so ``source`` also matches ``utm_source=``.
    """
    u = as_col(col)
    v = F.split_part(F.split_part(u, F.lit(name + "="), F.lit(2)), F.lit("&"), F.lit(1))
    return F.nullif(v, F.lit(""))
