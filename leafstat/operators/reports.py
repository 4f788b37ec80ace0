"""Report-level queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafstat import schemas as sch
from leafstat.functions.scalars import safe_div
from leafstat.operators.common import latest, with_latest
from leafstat.operators import pages as pg


def pages_per_session(pv: DataFrame, rv: DataFrame) -> DataFrame:
    """Page views per report session.

    T3: each side is summed per (report, day) *before* the join, so a
    session is counted once, not once per page row; the join keeps only
    days present on both sides, as the cookbook's join does.
    """
    p = pv.groupBy(*sch.REPORT_KEY, "view_date").agg(
        F.sum("view_count").alias("pviews"))
    r = rv.groupBy(*sch.REPORT_KEY, "view_date").agg(
        F.sum("view_count").alias("sessions"), F.sum("avg_session_seconds").alias("_ss"),
        F.count(F.lit(1)).alias("_n"))
    j = p.join(r, [*sch.REPORT_KEY, "view_date"])
    names = with_latest(pv, sch.REPORT_KEY, ["workspace_name", "report_name"])
    g = j.groupBy(*sch.REPORT_KEY).agg(
        F.sum("pviews").alias("total_page_views"), F.sum("sessions").alias("total_report_sessions"),
        (F.sum("_ss") / F.sum("_n")).alias("avg_session_seconds"))
    g = g.filter(F.col("total_report_sessions") > 0).join(names, sch.REPORT_KEY)
    return (g.select("workspace_id", "report_id", "workspace_name", "report_name", "total_page_views",
                     "total_report_sessions",
                     F.round(safe_div("total_page_views", "total_report_sessions"), 2).alias("pages_per_session"),
                     "avg_session_seconds")
            .orderBy("pages_per_session", "workspace_id", "report_id"))


def daily_trend(pv: DataFrame) -> DataFrame:
    """Total views per date (only dates present in the data)."""
    return pv.groupBy("view_date").agg(F.sum("view_count").alias("views")).orderBy("view_date")


def views_by_capacity(pv: DataFrame) -> DataFrame:
    """Views per capacity."""
    return pv.groupBy("capacity_name").agg(F.sum("view_count").alias("total_views"))


def report_level_kpis(pv: DataFrame, rv: DataFrame) -> DataFrame:
    """Report views, pages per session (ratio of totals), mean session seconds."""
    spark = pv.sparkSession
    tv = pv.select(F.sum("view_count")).scalar()
    rvs = rv.select(F.sum("view_count")).scalar()
    return pg._one_row(spark, report_views=rvs, pages_per_session=safe_div(tv, rvs),
                       avg_session_seconds=rv.select(F.avg("avg_session_seconds")).scalar())


def trend_page_vs_report(pv: DataFrame, rv: DataFrame) -> DataFrame:
    """Per date, page views beside report views (full outer join on date)."""
    a = pv.groupBy("view_date").agg(F.sum("view_count").alias("page_views"))
    b = rv.groupBy("view_date").agg(F.sum("view_count").alias("report_views"))
    return a.join(b, "view_date", "full").orderBy("view_date")


def report_matrix(pv: DataFrame, rv: DataFrame, unused: DataFrame) -> DataFrame:
    """Per report views, pages/session, mean session, top page share and
    unused pages with a band (red >= 5, yellow 1-4, '' otherwise)."""
    per_page = with_latest(pv, sch.PAGE_KEY, ["workspace_name", "report_name"], at="_d", v=("sum", "view_count"))
    pages = per_page.groupBy(*sch.REPORT_KEY).agg(latest("workspace_name", "_d"), latest("report_name", "_d"),
                                                  F.sum("v").alias("views"), F.max("v").alias("_top"))
    sess = rv.groupBy(*sch.REPORT_KEY).agg(F.sum("view_count").alias("report_views"),
                                           F.avg("avg_session_seconds").alias("avg_session_seconds"))
    un = unused.groupBy(*sch.REPORT_KEY).agg(F.count_distinct("page_id").alias("unused_pages"))
    j = pages.join(sess, sch.REPORT_KEY, "left").join(un, sch.REPORT_KEY, "left")
    u = F.coalesce("unused_pages", F.lit(0)).cast("bigint")
    return j.select(
        "workspace_id", "report_id", "workspace_name", "report_name", "views",
        safe_div("views", "report_views").alias("pages_per_session"), "avg_session_seconds",
        safe_div("_top", "views").alias("top_page_share"), u.alias("unused_pages"),
        F.when(u >= 5, "red").when(u >= 1, "yellow").otherwise("").alias("unused_band"))


def dashboard_meta(pv: DataFrame, catalog: DataFrame, underused_threshold: int = 100,
                   totals: DataFrame | None = None, missing: DataFrame | None = None) -> DataFrame:
    """One row - date range, days, totals, under-used and unused counts
    (the dashboard's zero-view rule, J2).  Three aggregates, one
    scalar subquery each; days and workspaces are counted on one row for each pair of them."""
    spark = pv.sparkSession
    facts = pg._scalars(pv.groupBy("view_date", "workspace_id").agg(F.sum("view_count").alias("view_count")).agg(
        F.min("view_date").alias("date_from"), F.max("view_date").alias("date_to"),
        F.count_distinct("view_date").alias("days"), F.count_distinct("workspace_id").alias("total_workspaces"),
        F.sum("view_count").alias("total_views")))
    low = (F.col("views") > 0) & (F.col("views") < underused_threshold)
    rs = pg._scalars(pg.report_pages(pv, totals, _low=F.count(F.when(low, 1))).agg(
        F.count(F.lit(1)).alias("total_reports"),
        F.coalesce(F.sum("_low"), F.lit(0)).cast("bigint").alias("underused_count"),
        F.sum("report_total_pages").cast("bigint").alias("total_pages_defined"),
        F.sum("pages_with_views").alias("total_pages_with_views"),
        F.sum("pages_never_viewed").alias("total_pages_never_viewed")))
    miss = pg._scalars((missing if missing is not None else pg.missing_page_ordinals(pv, catalog)).agg(
        F.count(F.lit(1)).alias("unused_count"),
        F.count_distinct(*sch.REPORT_KEY).alias("unused_reports_count")))
    return pg._one_row(
        spark,
        date_from=facts["date_from"], date_to=facts["date_to"], days=facts["days"],
        total_workspaces=facts["total_workspaces"],
        total_reports=rs["total_reports"], total_pages_defined=rs["total_pages_defined"],
        total_pages_with_views=rs["total_pages_with_views"],
        total_pages_never_viewed=rs["total_pages_never_viewed"],
        total_views=facts["total_views"],
        underused_threshold=F.lit(underused_threshold),
        underused_count=rs["underused_count"],
        unused_count=miss["unused_count"], unused_reports_count=miss["unused_reports_count"],
    )
