"""The posting record contract (A3): schema, defaults and required strings."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The 29 fields of the posting record, in order, with their wire
# type and explicit default ("required" marks a non-nullable string). Floats of
# the wire format are widened to double here: 32-bit floats lose currency
# precision above 2^24.
POSTING_FIELDS: list[tuple[str, str, Any]] = [
    ("job_id", "required", None),
    ("title", "required", None),
    ("company", "required", None),
    ("url", "string", None),
    ("company_url", "string", None),
    ("logo_url", "string", None),
    ("salary", "string", None),
    ("location", "string", None),
    ("experience", "string", None),
    ("tags", "array<string>", []),
    ("updated_at", "string", None),
    ("posted_at", "string", None),
    ("is_urgent", "boolean", False),
    ("is_highlight", "boolean", False),
    ("is_flash", "boolean", False),
    ("company_verified", "boolean", False),
    ("job_description", "string", None),
    ("job_requirement", "string", None),
    ("job_benefit", "string", None),
    ("deadline", "string", None),
    ("working_times", "array<string>", []),
    ("salary_min", "double", None),
    ("salary_max", "double", None),
    ("deal_salary", "boolean", False),
    ("experience_min", "int", None),
    ("experience_max", "int", None),
    ("experience_not_mentioned", "boolean", False),
    ("crawled_at", "bigint", 0),
    ("source", "required", "unknown"),
]

_AVRO = {"string": "string", "boolean": "boolean", "long": "bigint", "int": "int",
         "float": "double", "double": "double", "bytes": "binary"}


@dataclass
class Contract:
    """Field order, Spark types, defaults and the strings that may not stay null."""
    fields: list[tuple[str, str]]
    defaults: dict[str, Any] = field(default_factory=dict)
    required_strings: set[str] = field(default_factory=set)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, T._parse_datatype_string(t), n not in self.required_strings)
                             for n, t in self.fields])

    @property
    def names(self) -> list[str]:
        return [n for n, _ in self.fields]

    def type_of(self, name: str) -> str:
        return dict(self.fields)[name]


def posting_contract() -> Contract:
    fields, defaults, required = [], {}, set()
    for name, typ, default in POSTING_FIELDS:
        if typ == "required":
            required.add(name)
            typ = "string"
        fields.append((name, typ))
        defaults[name] = _schema_default(typ, default)
    return Contract(fields, defaults, required)


def _schema_default(typ: str, explicit):
    """Explicit default wins, else array → [], boolean → false, long → 0, other → null."""
    if explicit is not None:
        return explicit
    if typ.startswith("array"):
        return []
    if typ == "boolean":
        return False
    if typ == "bigint":
        return 0
    return None


def load_contract(avsc: str | dict) -> Contract:
    """Read an Avro record schema (path, JSON text or dict) into a :class:`Contract`."""
    if isinstance(avsc, str):
        text = avsc if avsc.lstrip().startswith("{") else open(avsc, encoding="utf-8").read()
        avsc = json.loads(text)
    fields, defaults, required = [], {}, set()
    for f in avsc.get("fields", []):
        t = f["type"]
        if isinstance(t, list):
            inner = [x for x in t if x != "null"][0]
        else:
            inner = t
        if isinstance(inner, dict) and inner.get("type") == "array":
            typ = f"array<{_AVRO.get(inner['items'], 'string')}>"
        else:
            typ = _AVRO.get(inner, "string")
        if t == "string":
            required.add(f["name"])
        fields.append((f["name"], typ))
        defaults[f["name"]] = _schema_default(typ, f.get("default"))
    return Contract(fields, defaults, required)


def default_literal(value, typ: str) -> Column:
    if isinstance(value, list):
        return F.array(*[F.lit(v) for v in value]).cast(typ) if value else F.array().cast(typ)
    return F.lit(value).cast(typ)


def apply_contract(df: DataFrame, contract: Contract | None = None, keep_extra: bool = False,
                   passthrough: Sequence[str] = (), stamps: Sequence[str] = ()) -> DataFrame:
    """Project ``df`` onto the contract: cast, fill defaults, force required strings.

    Missing fields get their default; present nulls are filled with the
    default; required strings that are still null become ``''``. Values that
    do not cast become null (``try_cast``) and then take the default.
    ``passthrough`` columns are kept as strings, ``stamps`` as they are.
    """
    contract = contract or posting_contract()
    have = {c.lower(): c for c in df.columns}
    cols = []
    for name, typ in contract.fields:
        default = contract.defaults.get(name)
        if name.lower() in have:
            c = F.col(f"`{have[name.lower()]}`").try_cast(typ)
            if default is not None:
                c = F.coalesce(c, default_literal(default, typ))
        else:
            c = default_literal(default, typ)
        if name in contract.required_strings:
            c = F.coalesce(c, F.lit(""))
        cols.append(c.alias(name))
    if keep_extra:
        names = {n.lower() for n in contract.names}
        cols += [F.col(f"`{c}`") for c in df.columns if c.lower() not in names]
    cols += [F.col(f"`{c}`").cast("string").alias(c) for c in passthrough]
    cols += [F.col(f"`{c}`") for c in stamps]
    return df.select(*cols)


def contract_types(df: DataFrame, contract: Contract | None = None) -> DataFrame:
    """Give the contract's fields their types and nothing else: no default is filled.

    Fields come first, in contract order; a missing field is null, a value
    that does not cast is null, other columns of ``df`` follow unchanged.
    """
    contract = contract or posting_contract()
    have = {c.lower(): c for c in df.columns}
    cols = [(F.col(f"`{have[n.lower()]}`").try_cast(t) if n.lower() in have else F.lit(None).cast(t)).alias(n)
            for n, t in contract.fields]
    names = {n.lower() for n in contract.names}
    return df.select(*cols, *[F.col(f"`{c}`") for c in df.columns if c.lower() not in names])
