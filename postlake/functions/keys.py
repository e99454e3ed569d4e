"""Key and hash expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlake.functions._util import as_col
from postlake.functions.urls import clean_url

# Placeholder for a null field inside a surrogate key, the company
# key prefix and the company fallbacks (id side and name side differ in case).
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
COMPANY_KEY_PREFIX = "company_"
COMPANY_ID_FALLBACK = "unknown"
COMPANY_NAME_FALLBACK = "Unknown"
NUMERIC_TAIL_MARKERS = ["/detail-jobs/", "/viec-lam/"]


def surrogate_key(cols: Sequence, nulls_as_empty: bool = False) -> Column:
    """md5 of the fields cast to string, null → placeholder, joined by ``-``."""
    token = "" if nulls_as_empty else SURROGATE_NULL_TOKEN
    parts = [F.coalesce(as_col(c).cast("string"), F.lit(token)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def company_key(company) -> Column:
    """``md5('company_' || coalesce(company, 'unknown'))``."""
    return F.md5(F.concat(F.lit(COMPANY_KEY_PREFIX),
                          F.coalesce(as_col(company), F.lit(COMPANY_ID_FALLBACK))))


def company_name(company) -> Column:
    return F.coalesce(as_col(company), F.lit(COMPANY_NAME_FALLBACK))


def without_id(job_id, url) -> Column:
    """Whether :func:`posting_id` takes its fallback: neither a URL nor an id."""
    return (F.coalesce(as_col(url), F.lit("")) == "") & (F.coalesce(as_col(job_id), F.lit("")) == "")


def posting_id(job_id, url, fallback=None) -> Column:
    """Stable posting id.

    * a non-empty URL → sha256 hex of the cleaned URL;
    * else a URL-shaped id (``http...``) → cleaned, then reduced to its numeric
      tail when it has a posting-path marker and the part after the last ``-``
      is all digits;
    * else the given id; an empty id falls back to ``fallback`` (for example a
      hash of source and content, so reruns produce the same id).
    """
    jid, u = as_col(job_id), as_col(url)
    has_url = u.isNotNull() & (u != "")
    has_id = jid.isNotNull() & (jid != "")
    cleaned_id = clean_url(jid)
    tail = F.element_at(F.split(cleaned_id, "-"), -1)
    marked = cleaned_id.contains(NUMERIC_TAIL_MARKERS[0]) | cleaned_id.contains(NUMERIC_TAIL_MARKERS[1])
    from_id = F.when(jid.startswith("http"),
                     F.when(marked & tail.rlike("^[0-9]+$"), tail).otherwise(cleaned_id)
                     ).otherwise(jid)
    fb = F.lit(None).cast("string") if fallback is None else as_col(fallback)
    return (F.when(has_url, F.sha2(clean_url(u), 256))
             .when(has_id, from_id)
             .otherwise(fb))
