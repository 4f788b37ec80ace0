"""A collection run with its accounting (K1, K2-K4, K5).

A run lands the four feeds of its window in bronze, upserts the facts and
replaces the catalog in silver from what was landed, derives the unused pages,
and appends one row to the ``runs`` table.

Row counts are observed while the feeds are written, so counting reads
nothing again.  A feed that cannot be read or written is noted and the others
go on; its silver table stays as it was.  Errors that the source itself
reports count as well.  ``ok`` means that there was none.

    <root>/bronze/<feed>/dt=<run date>/     landed feeds
    <root>/<silver table>/                  silver
    <root>/runs/                            one row a run
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from leafstat import schemas as sch
from leafstat.operators import ops
from leafstat.operators import silver as sv
from leafstat.plans.lakehouse import Lakehouse
from leafstat.sources import files, paths
from leafstat.streaming.upsert import DuplicateKeyError, upsert

FACTS = ("page_views", "report_views", "user_views")
RUN_FEEDS = ("page_views", "page_catalog", "report_views", "user_views")
RUNS = "runs"
_FAILURES = (PySparkException, Py4JError, DuplicateKeyError, ValueError, OSError)


class Run:
    """What one run has met so far."""

    def __init__(self) -> None:
        self.errors: list[dict] = []
        self.rows: dict[str, int] = {}

    def attempt(self, scope: str, step):
        """The step's result, or None with the failure noted."""
        try:
            return step()
        except _FAILURES as e:
            self.errors.append({"scope": scope, "error": type(e).__name__})
            return None


def observed(df: DataFrame, write) -> int:
    """Rows that ``write`` wrote, counted by the job that writes them."""
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return int(seen.get.get("rows") or 0)


def _first(df: DataFrame, order: list[str], n: int) -> list[dict]:
    """The first ``n`` rows in display order, for a list in the run's row."""
    return [r.asDict() for r in df.orderBy(*order).limit(n).collect()]


def _land(lh: Lakehouse, root: str, feed: str, run_date: _dt.date, since: _dt.date, until: _dt.date) -> int:
    table = getattr(lh, feed)
    rows = sv.window_filter(table, since, until) if feed in FACTS else table
    return observed(rows, lambda df: files.write_bronze(df, paths.under(root, "bronze"), feed, run_date))


def _keep(spark: SparkSession, root: str, feed: str, run_date: _dt.date) -> None:
    landed = files.read_bronze(spark, paths.under(root, "bronze"), feed, sch.SILVER[feed], run_date).drop("dt")
    if feed in FACTS:
        upsert(landed, root, feed)
    else:
        files.write_table(landed, root, feed)


def collect(lh: Lakehouse, root: str, run_date: _dt.date | None = None, days: int = 90,
            dataset_prefix: str = ops.USAGE_DATASET_PREFIX, sample: int = 10) -> DataFrame:
    """One run over the window of ``days`` that ends at the anchor date; returns its row of ``runs``."""
    spark, run = lh.spark, Run()
    started, run_id = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None), uuid.uuid4().hex
    since, until = lh.window(days)
    run_date = run_date or until

    for feed in RUN_FEEDS:
        rows = run.attempt(feed, lambda feed=feed: _land(lh, root, feed, run_date, since, until))
        if rows is not None:
            run.rows[feed] = rows
            run.attempt(f"{feed} to silver", lambda feed=feed: _keep(spark, root, feed, run_date))

    unused = run.attempt("unused_pages", lambda: _unused(spark, root, since, until, sample)) or (0, 0, [])
    scope = {n: run.attempt(n, lambda n=n: lh.side(n).count()) or 0 for n in ("workspaces", "reports")}
    datasets = run.attempt("datasets", lambda: ops.usage_dataset_per_workspace(lh.side("datasets"), dataset_prefix).count()) or 0
    skipped, names = run.attempt("bootstrap", lambda: _not_bootstrapped(lh, dataset_prefix)) or (0, [])
    bare, bare_rows = run.attempt("reports_without_catalog", lambda: _without_catalog(lh, spark, root)) or (0, [])
    reported, some = run.attempt("collection_errors", lambda: _reported(lh)) or (0, [])

    errors = [*run.errors, *some][:sch.RUN_LIST]
    n_errors = len(run.errors) + reported
    rows = {f: run.rows.get(f, 0) for f in RUN_FEEDS}
    ended = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    row = (run_id, sch.SILVER_SCHEMA_VERSION, run_date, started, ended, since, until, scope["workspaces"], scope["reports"],
           datasets, rows["page_views"], rows["page_catalog"], rows["report_views"], rows["user_views"], unused[0], unused[1],
           _json(unused[2]), rows["page_views"], skipped, _json(names), _json(bare_rows), bare, _json(errors), n_errors,
           n_errors == 0, root, paths.under(root, "bronze"))
    spark.createDataFrame([row], sch.RUNS).coalesce(1).write.mode("append").parquet(paths.under(root, RUNS))
    return runs(spark, root).where(F.col("run_id") == run_id)


def _json(value: list) -> str:
    return json.dumps(value, separators=(",", ":"), ensure_ascii=False)


def _unused(spark: SparkSession, root: str, since: _dt.date, until: _dt.date, sample: int) -> tuple[int, int, list[dict]]:
    """J1 on what silver holds now: replaced whole, then its count, reports and first rows."""
    catalog, views = (files.read_table(spark, root, t) for t in ("page_catalog", "page_views"))
    rows = observed(sv.unused_pages(catalog, views, since, until, order=False),
                    lambda df: files.write_table(df, root, "unused_pages"))
    kept = files.read_table(spark, root, "unused_pages")
    first = _first(kept, ["workspace_name", "report_name", "page_ordinal", "page_id", "page_name"], sample)
    shown = [{k: r[k] for k in ("workspace_name", "report_name", "page_name", "page_ordinal")} for r in first]
    return rows, kept.select(*sch.REPORT_KEY).distinct().count(), shown


def _not_bootstrapped(lh: Lakehouse, prefix: str) -> tuple[int, list[str]]:
    missing = ops.not_bootstrapped_workspaces(lh.side("workspaces"), lh.side("reports"), lh.side("datasets"), prefix)
    total = missing.agg(F.coalesce(F.sum("reports_skipped"), F.lit(0)).cast("long")).first()[0]
    return total, [r["workspace_name"] for r in _first(missing, ["workspace_name"], sch.RUN_LIST)]


def _without_catalog(lh: Lakehouse, spark: SparkSession, root: str) -> tuple[int, list[dict]]:
    """Reports of the enumeration that no catalog page belongs to."""
    have = files.read_table(spark, root, "page_catalog").select(*sch.REPORT_KEY).distinct()
    bare = lh.side("reports").select(*sch.REPORT_KEY).distinct().join(have, sch.REPORT_KEY, "left_anti")
    return bare.count(), _first(bare, sch.REPORT_KEY, sch.RUN_LIST)


def _reported(lh: Lakehouse) -> tuple[int, list[dict]]:
    found = lh.side("collection_errors").select("scope", "error")
    return found.count(), _first(found, ["scope", "error"], sch.RUN_LIST)


def runs(spark: SparkSession, root: str) -> DataFrame:
    """The run log: one row a run."""
    return spark.read.schema(sch.RUNS).parquet(paths.under(root, RUNS))
