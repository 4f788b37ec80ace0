"""The query catalogue: SURVEY §2 names -> functions of a Lakehouse.

Each entry is ``fn(lh: Lakehouse) -> DataFrame`` with the reference's
parameter values as defaults.  ``spark_queries()`` adapts them to the
``(spark, sf_dir)`` contract of ``__spark_entry__``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leafstat.plans.lakehouse import Lakehouse, QueryLakehouse
from leafstat.sources import paths

REGISTRY: dict[str, Callable[[Lakehouse], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


# SURVEY §2 rows whose work is one of the registered queries above, under
# the row's own name (the same function, so a user can call either name).
SURVEY_ALIASES = {
    "half_life": "report_half_life",              # J5: rolling x peak theta join (W2)
    "adoption": "new_page_adoption",              # J6: facts x first_seen x report average (W9)
    "enumeration_join": "enrich_blank_identity",  # J8: blank identity from the enumeration (F8)
    "enrich_from_catalog": "page_views_daily",    # J9: ordinal / total pages from the catalog (A1)
    "owner_underused_counts": "owner_accountability",  # A25: per-owner counts (J7)
    "run_metrics": "run_metrics_json",            # K6: run metrics document
}


def _load() -> None:
    from leafstat.plans import registry_defs  # noqa: F401
    for alias, name in SURVEY_ALIASES.items():
        REGISTRY.setdefault(alias, REGISTRY[name])


_LAKEHOUSES: dict[tuple, Lakehouse] = {}


def lakehouse_for(spark: SparkSession, sf_dir: str) -> Lakehouse:
    """One Lakehouse per (application, input folder as it is now): the anchor date
    and the checkpointed page catalog are computed once and shared by every
    query, until the names, sizes or times of the input files change."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), paths.state(spark, sf_dir))
    lh = _LAKEHOUSES.get(key)
    if lh is None:
        lh = _LAKEHOUSES[key] = Lakehouse.from_star(spark, sf_dir)
    return lh


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def adapt(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(QueryLakehouse(lakehouse_for(spark, sf_dir)))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run

    return {name: adapt(fn) for name, fn in REGISTRY.items()}


def lakehouse_queries() -> dict[str, Callable[[Lakehouse], DataFrame]]:
    _load()
    return dict(REGISTRY)
