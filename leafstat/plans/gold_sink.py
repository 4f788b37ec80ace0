"""The stored gold layer (M1-M5) and its upkeep.

``build`` writes all marts from silver.  ``refresh`` follows a change of some
silver days, by an upsert or an erasure: of the two day-grained marts it
rewrites those days alone (redo log, ``sources.days``); the marts without a day
are windows and dimensions, one row a page or report at most, and are replaced
whole as versions (``sources.versions``).

    <root>/kpi_page_usage_daily/view_date=.../    M1
    <root>/fact_page_views/date=.../              M5
    <root>/kpi_underused_pages/                   M2, and so on
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafstat import schemas as sch
from leafstat.operators import silver as sv
from leafstat.plans import gold
from leafstat.plans.lakehouse import Lakehouse
from leafstat.session import write_tasks
from leafstat.sources import days, paths, versions

# Mart -> (its day column, its builder from page views).
DAILY = {"kpi_page_usage_daily": ("view_date", gold.kpi_page_usage_daily),
         "fact_page_views": ("date", gold.fact_page_views)}


def _whole(lh: Lakehouse) -> dict[str, DataFrame]:
    """The marts without a day column."""
    pv, window = lh.page_views, sv.window_filter(lh.page_views, *lh.window(90))
    return {"kpi_underused_pages": gold.kpi_underused_pages(window),
            "kpi_long_report_engagement": gold.kpi_long_report_engagement(window, lh.page_catalog),
            "dim_workspace": gold.dim_workspace(pv), "dim_report": gold.dim_report(pv),
            "dim_page": gold.dim_page(pv, lh.page_catalog), "dim_date": gold.dim_date(pv)}


MARTS = (*DAILY, "kpi_underused_pages", "kpi_long_report_engagement", "dim_workspace", "dim_report", "dim_page", "dim_date")


def _replace(df: DataFrame, root: str, mart: str, part: str | None = None) -> None:
    table = paths.under(root, mart)
    version, folder = versions.new_version(table)
    if part:
        df.repartitionByRange(write_tasks(df.sparkSession), F.col(part), *sch.PAGE_KEY).write.partitionBy(part).parquet(folder)
    else:
        df.write.parquet(folder)
    versions.commit(df.sparkSession, table, version)


def build(lh: Lakehouse, root: str) -> None:
    """All marts from silver."""
    for mart, (part, of) in DAILY.items():
        _replace(of(lh.page_views), root, mart, part)
    for mart, df in _whole(lh).items():
        _replace(df, root, mart)


def refresh(lh: Lakehouse, root: str, touched: list[_dt.date]) -> None:
    """Bring gold up to silver after a change of the days ``touched``.

    Repeating it changes nothing, so a refresh that died is run again.
    """
    spark = lh.spark
    for mart, (part, of) in DAILY.items():
        table = versions.current(spark, paths.under(root, mart))
        days.recover(spark, table)
        rows = of(lh.page_views.filter(F.col("view_date").isin(touched)))
        days.replace_days(rows, table, part, [part, *sch.PAGE_KEY], touched)
    for mart, df in _whole(lh).items():
        _replace(df, root, mart)


def read(spark: SparkSession, root: str, mart: str) -> DataFrame:
    return spark.read.parquet(versions.current(spark, paths.under(root, mart)))
