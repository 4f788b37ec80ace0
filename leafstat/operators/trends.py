"""Trend and window queries."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafstat import schemas as sch
from leafstat.functions.prefix import running_totals
from leafstat.functions.scalars import safe_div
from leafstat.operators.common import with_latest
from leafstat.operators.silver import dedup_catalog


def report_day_series(pv: DataFrame, as_of: _dt.date) -> DataFrame:
    """Report-day view sums on a dense calendar from each report's first view
    to as_of (days without views are 0).  One row per report and day, so a
    report's partition is bounded by the calendar, not by its traffic."""
    daily = pv.filter(F.col("view_date") <= F.lit(as_of)).groupBy(*sch.REPORT_KEY, "view_date").agg(
        F.sum("view_count").alias("views"))
    first = daily.groupBy(*sch.REPORT_KEY).agg(F.min("view_date").alias("_first"))
    spine = first.select(*sch.REPORT_KEY, F.explode(F.sequence("_first", F.lit(as_of))).alias("view_date"))
    return (spine.join(daily, [*sch.REPORT_KEY, "view_date"], "left")
            .withColumn("views", F.coalesce("views", F.lit(0)).cast("bigint")))


def rolling_7d_views(pv: DataFrame, as_of: _dt.date) -> DataFrame:
    """7-day rolling views per report (ROWS 6 PRECEDING on the dense calendar)."""
    s = report_day_series(pv, as_of)
    w = Window.partitionBy(*sch.REPORT_KEY).orderBy("view_date").rowsBetween(-6, 0)
    return s.withColumn("rolling_7d", F.sum("views").over(w))


def report_half_life(pv: DataFrame, as_of: _dt.date) -> DataFrame:
    """W2 (T4 ruling): days from the peak of the 7-day rolling views (ties ->
    earliest) to the first later day below half the peak; reports that never
    fall below half are omitted."""
    r = rolling_7d_views(pv, as_of)
    peak = r.groupBy(*sch.REPORT_KEY).agg(
        F.min_by(F.struct(F.col("rolling_7d").alias("peak_rolling_7d"), F.col("view_date").alias("peak_date")),
                 F.struct(-F.col("rolling_7d"), F.col("view_date"))).alias("_p"))
    peak = peak.select(*sch.REPORT_KEY, "_p.peak_rolling_7d", "_p.peak_date")
    post = (r.join(peak, sch.REPORT_KEY)
            .filter((F.col("view_date") > F.col("peak_date"))
                    & (F.col("rolling_7d") < F.col("peak_rolling_7d") / F.lit(2.0))))
    half = post.groupBy(*sch.REPORT_KEY, "peak_date", "peak_rolling_7d").agg(
        F.min("view_date").alias("half_date"))
    names = with_latest(pv, sch.REPORT_KEY, ["report_name"])
    return (half.join(names, sch.REPORT_KEY)
            .select("workspace_id", "report_id", "report_name", "peak_date", "half_date",
                    F.datediff("half_date", "peak_date").alias("half_life_days"), "peak_rolling_7d")
            .orderBy("half_life_days", "workspace_id", "report_id"))


def capacity_long_tail(pv: DataFrame, share: float = 0.80) -> DataFrame:
    """Per capacity, the number of top reports (by views) that explain
    ``share`` of its traffic.  Rank and running total are computed with the
    distributed running total, so a capacity with many reports is split."""
    rep = pv.groupBy("capacity_name", *sch.REPORT_KEY).agg(F.sum("view_count").alias("report_views"))
    ranked = running_totals(
        rep, ["capacity_name"], [F.col("report_views").desc(), F.col("workspace_id"), F.col("report_id")],
        {"rank": None, "running_total": "report_views"}, {"capacity_total": "running_total"})
    reach = F.when(F.col("running_total") / F.col("capacity_total").cast("double") >= share, F.col("rank"))
    return (ranked.groupBy("capacity_name").agg(F.min(reach).cast("int").alias("reports_for_80pct"))
            .orderBy("reports_for_80pct", "capacity_name"))


def trailing_views(pv: DataFrame, as_of: _dt.date) -> DataFrame:
    """Views in the last 7 and last 30 days ending at as_of (closed)."""
    lo30, lo7 = as_of - _dt.timedelta(days=29), as_of - _dt.timedelta(days=6)
    f = pv.filter(F.col("view_date").between(F.lit(lo30), F.lit(as_of)))
    return f.agg(
        F.coalesce(F.sum(F.when(F.col("view_date") >= F.lit(lo7), F.col("view_count"))), F.lit(0))
        .cast("bigint").alias("views_last_7d"),
        F.coalesce(F.sum("view_count"), F.lit(0)).cast("bigint").alias("views_last_30d"))


def wow_change(pv: DataFrame, as_of: _dt.date) -> DataFrame:
    """(last 7 d - previous 7 d) / previous 7 d; NULL when the previous week is 0."""
    lo14, lo7 = as_of - _dt.timedelta(days=13), as_of - _dt.timedelta(days=6)
    f = pv.filter(F.col("view_date").between(F.lit(lo14), F.lit(as_of)))
    g = f.agg(
        F.coalesce(F.sum(F.when(F.col("view_date") >= F.lit(lo7), F.col("view_count"))), F.lit(0))
        .cast("bigint").alias("views_last_7d"),
        F.coalesce(F.sum(F.when(F.col("view_date") < F.lit(lo7), F.col("view_count"))), F.lit(0))
        .cast("bigint").alias("views_prev_7d"))
    return g.withColumn("wow_change", safe_div(F.col("views_last_7d") - F.col("views_prev_7d"),
                                               F.col("views_prev_7d")))


def new_page_adoption(pv: DataFrame, as_of: _dt.date, new_days: int = 60) -> DataFrame:
    """W9 (T7, T19): for pages first viewed in the last ``new_days`` days, days
    from the first view to the first page-day reaching half the report's mean
    page-day views; NULL = never.  A new page has no day before the window, so only
    the window's page-days meet the new pages."""
    f = pv.filter(F.col("view_date") <= F.lit(as_of))
    pd_ = f.groupBy(*sch.PAGE_KEY, "view_date").agg(F.sum("view_count").alias("daily_views"))
    first = with_latest(f, sch.PAGE_KEY, ["page_name"], first_view=("min", "view_date"))
    avg = pd_.groupBy(*sch.REPORT_KEY).agg(F.avg("daily_views").alias("report_page_avg"))
    lo = as_of - _dt.timedelta(days=new_days - 1)
    new = first.filter(F.col("first_view") >= F.lit(lo))
    j = pd_.filter(F.col("view_date") >= F.lit(lo)).join(new, sch.PAGE_KEY).join(avg, sch.REPORT_KEY)
    reach = F.when(F.col("daily_views") >= F.col("report_page_avg") / 2,
                   F.datediff("view_date", "first_view"))
    return (j.groupBy(*sch.PAGE_KEY, "page_name", "first_view").agg(F.min(reach).alias("days_to_half_avg"))
            .orderBy(F.col("days_to_half_avg").asc_nulls_last(), *sch.PAGE_KEY))


def idle_alert(pv: DataFrame, catalog: DataFrame, as_of: _dt.date, days: int = 30) -> DataFrame:
    """Catalog pages with no views for >= ``days`` consecutive days up to
    as_of (never viewed included, idle_days NULL)."""
    last = (pv.filter(F.col("view_date") <= F.lit(as_of)).groupBy(*sch.PAGE_KEY)
            .agg(F.max("view_date").alias("last_view_date")))
    cat = dedup_catalog(catalog.select(*sch.PAGE_CATALOG.fieldNames()))
    j = cat.join(last, sch.PAGE_KEY, "left").withColumn(
        "idle_days", F.datediff(F.lit(as_of), F.col("last_view_date")))
    return (j.filter(F.col("idle_days").isNull() | (F.col("idle_days") >= days))
            .select(*sch.PAGE_KEY, "workspace_name", "report_name", "page_name", "last_view_date", "idle_days"))


def idle_reports(pv: DataFrame, reports: DataFrame, as_of: _dt.date, days: int = 30) -> DataFrame:
    """W12 (report form): reports with no views for >= ``days`` days up to as_of."""
    last = (pv.filter(F.col("view_date") <= F.lit(as_of)).groupBy(*sch.REPORT_KEY)
            .agg(F.max("view_date").alias("last_view_date")))
    j = reports.select(*sch.REPORT_KEY, "report_name").join(last, sch.REPORT_KEY, "left").withColumn(
        "idle_days", F.datediff(F.lit(as_of), F.col("last_view_date")))
    return j.filter(F.col("idle_days").isNull() | (F.col("idle_days") >= days))
