"""The medallion job (I4): staging → intermediate → marts → checks.

Relations are ordinary DataFrame functions with the relations they read. ``select``
names relations or layers; each is run after all that it reads (its upstream closure),
each once, and nothing else is run. Every relation is registered under the name the
next one and the dashboards read. With ``out_root`` (a shared folder), staging, the
deduplicated layer and ``dim_company`` are written there as tables, which also cuts the
lineage; otherwise, and for the other relations, they are views.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from postlake.operators import checks as C
from postlake.operators.marts import dim_company, dim_job, fact_job_posting
from postlake.operators.reshape import latest_postings
from postlake.sources.bronze import scan_bronze
from postlake.sources.catalog import materialize
from postlake.sources.contract import posting_contract

LAYERS = ("staging", "intermediate", "marts", "checks")
# Accepted sources of the staging check suite.
ACCEPTED_SOURCES = ["topcv", "topdev"]


@dataclass(frozen=True)
class Relation:
    """A relation: its layer, the relations it reads, how it is made of them, and whether it is written as a table."""

    layer: str
    reads: tuple[str, ...]
    make: Callable[..., DataFrame]
    table: bool = False


def _named(check: C.Check, test: str, relation: str, column: str) -> C.Check:
    check.name = f"{test}_{relation}_{column}"
    return check


def pipeline_checks(stg: DataFrame, dim_job_df: DataFrame, dim_company_df: DataFrame) -> DataFrame:
    """The declared checks of the pipeline, one summary row each (G22), named test_relation_column."""
    return C.run_checks([
        _named(C.not_null(stg, "job_id"), "not_null", "stg_jobs", "job_id"),
        _named(C.not_null(stg, "source"), "not_null", "stg_jobs", "source"),
        _named(C.accepted_values(stg, "source", ACCEPTED_SOURCES), "accepted_values", "stg_jobs", "source"),
        _named(C.not_null(stg, "crawled_at"), "not_null", "stg_jobs", "crawled_at"),
        _named(C.unique(dim_job_df, "job_id"), "unique", "dim_job", "job_id"),
        _named(C.not_null(dim_job_df, "job_id"), "not_null", "dim_job", "job_id"),
        _named(C.unique(dim_company_df, "company_id"), "unique", "dim_company", "company_id"),
        _named(C.not_null(dim_company_df, "company_id"), "not_null", "dim_company", "company_id"),
    ])


RELATIONS: dict[str, Relation] = {
    "stg_jobs": Relation("staging", (), lambda bronze: bronze, table=True),
    "int_jobs_dedup": Relation("intermediate", ("stg_jobs",), latest_postings, table=True),
    "dim_company": Relation("marts", ("int_jobs_dedup",), dim_company, table=True),
    "dim_job": Relation("marts", ("int_jobs_dedup",), dim_job),
    "fact_job_posting": Relation("marts", ("stg_jobs",), fact_job_posting),
    "checks": Relation("checks", ("stg_jobs", "dim_job", "dim_company"), pipeline_checks),
}


def run_order(select: Sequence[str], relations: dict[str, Relation] | None = None) -> list[str]:
    """The relations that ``select`` (names or layers) needs, each after all that it reads."""
    relations = RELATIONS if relations is None else relations
    layers = {r.layer for r in relations.values()}
    unknown = [s for s in select if s not in relations and s not in layers]
    if unknown:
        raise ValueError(f"unknown relations or layers {sorted(unknown)}")
    out: list[str] = []

    def add(name: str, below: tuple[str, ...]) -> None:
        if name in below:
            raise ValueError(f"relations read each other: {' -> '.join((*below, name))}")
        if name not in relations:
            raise ValueError(f"{below[-1]} reads {name}, which is not declared")
        for source in relations[name].reads:
            add(source, (*below, name))
        if name not in out:
            out.append(name)

    for name, relation in relations.items():
        if name in select or relation.layer in select:
            add(name, ())
    return out


def run_medallion(spark: SparkSession, bronze: str | DataFrame, out_root: str | None = None,
                  select: Sequence[str] = LAYERS) -> dict[str, DataFrame]:
    """Run the selected relations and all that they read, in order; returns the relations by name.

    ``bronze`` is a bronze folder or an already typed staging frame. Staging
    gives the contract's fields their types and fills nothing, so that the
    not-null checks see what is missing. ``checks`` is the check summary.
    """
    out: dict[str, DataFrame] = {}
    for name in run_order(select):
        relation = RELATIONS[name]
        if not relation.reads:
            df = scan_bronze(spark, bronze, posting_contract()) if isinstance(bronze, str) else bronze
        else:
            df = relation.make(*[out[r] for r in relation.reads])
        if name == "checks":
            out[name] = df
        elif relation.table and out_root:
            out[name] = materialize(df, name, "table", f"{out_root.rstrip('/')}/{name}")
        else:
            out[name] = materialize(df, name, "view")
    return out
