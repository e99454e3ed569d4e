"""Identifier text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlake.functions._util import as_col


def slugify(col) -> Column:
    """Lower-case; runs of space/dash → ``_``; drop all but ``[a-z0-9_]``; ``_`` before a leading digit."""
    s = F.lower(as_col(col))
    s = F.regexp_replace(s, "[ -]+", "_")
    s = F.regexp_replace(s, "[^a-z0-9_]+", "")
    return F.regexp_replace(s, "^([0-9])", "_$1")


def slugify_name(name: str) -> str:
    """The same rule for a Python string (used to name generated columns)."""
    s = name.lower()
    s = re.sub("[ -]+", "_", s)
    s = re.sub("[^a-z0-9_]+", "", s)
    return re.sub("^([0-9])", r"_\1", s)
