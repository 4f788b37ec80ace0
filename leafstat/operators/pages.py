"""Page-level queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafstat import schemas as sch
from leafstat.functions.prefix import running_total
from leafstat.functions.scalars import safe_div
from leafstat.operators.common import REPORT_ATTRS, explode_range, latest, page_totals, report_attrs, with_latest
from leafstat.operators.silver import dedup_catalog

# Dashboard histogram buckets (closed ranges, the last one open) and labels.
BUCKETS = [(0, 0), (1, 10), (11, 50), (51, 200), (201, 1000), (1001, 5000), (5001, None)]
BUCKET_LABELS = ["0 (never)", "1–10", "11–50", "51–200", "201–1k", "1k–5k", "5k+"]


def _one_row(spark: SparkSession, **cols) -> DataFrame:
    """A single-row result made of scalar subqueries (no join of 1-row frames)."""
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()])


def _scalars(agg: DataFrame) -> dict:
    """One scalar subquery for a 1-row aggregate; its columns as fields.
    Several fields of one aggregate then cost one job, not one each."""
    s = agg.select(F.struct(*agg.columns).alias("s")).scalar()
    return {c: s.getField(c) for c in agg.columns}


def missing_page_ordinals(pv: DataFrame, catalog: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Ordinals 1..report_total_pages of each viewed report with no viewed page;
    name from the catalog else '(page N)', id 'report::pNNN' (zero based)."""
    rep = report_attrs(pv, totals).withColumn("_one", F.lit(1))
    seen = pv.select(*sch.REPORT_KEY, "page_ordinal").distinct()
    allp = explode_range(rep, "_one", "report_total_pages", "page_ordinal", keys=sch.REPORT_KEY)
    allp = allp.withColumn("page_ordinal", F.col("page_ordinal").cast("int"))
    miss = allp.join(seen, [*sch.REPORT_KEY, "page_ordinal"], "left_anti")
    names = (dedup_catalog(catalog.select(*sch.PAGE_CATALOG.fieldNames()))
             .groupBy(*sch.REPORT_KEY, "page_ordinal")
             .agg(F.min("page_name").alias("_cat_name")))
    miss = miss.join(names, [*sch.REPORT_KEY, "page_ordinal"], "left")
    return miss.select(
        "workspace_id", "workspace_name", "capacity_name", "report_id", "report_name",
        F.format_string("%s::p%03d", F.col("report_id"), F.col("page_ordinal") - 1).alias("page_id"),
        F.coalesce("_cat_name", F.format_string("(page %d)", F.col("page_ordinal"))).alias("page_name"),
        "page_ordinal")


def page_detail(pv: DataFrame, catalog: DataFrame, totals: DataFrame | None = None,
                missing: DataFrame | None = None) -> DataFrame:
    """Per page views, peak users, weighted dwell (1 dp), first/last seen;
    zero-view pages (J2) included with 0 and NULL dates.  ``totals`` /
    ``missing``: page_totals(pv) / missing_page_ordinals(pv, catalog) when the
    caller already has them."""
    t = totals if totals is not None else page_totals(pv)
    viewed = t.select(
        "workspace_id", "report_id", "page_id", "page_name", "page_ordinal", "views", "users_peak",
        F.round(F.coalesce(safe_div("dwell_weighted_sum", "views"), F.lit(0.0)), 1).alias("avg_dwell_seconds"),
        "first_seen", "last_seen")
    zero = (missing if missing is not None else missing_page_ordinals(pv, catalog)).select(
        "workspace_id", "report_id", "page_id", "page_name", "page_ordinal",
        F.lit(0).cast("bigint").alias("views"), F.lit(0).cast("bigint").alias("users_peak"),
        F.lit(0.0).alias("avg_dwell_seconds"),
        F.lit(None).cast("date").alias("first_seen"), F.lit(None).cast("date").alias("last_seen"))
    return viewed.unionByName(zero)


def page_coverage_rate(pv: DataFrame, catalog: DataFrame) -> DataFrame:
    """Defined vs viewed pages per report; pct rounded to 1 dp."""
    cat = dedup_catalog(catalog.select(*sch.PAGE_CATALOG.fieldNames()))
    defined = with_latest(cat, sch.REPORT_KEY, ["workspace_name", "report_name"], order="catalog_pulled_at",
                          pages_defined=("count", "page_id"))
    viewed = pv.groupBy(*sch.REPORT_KEY).agg(F.count_distinct("page_id").alias("pages_viewed"))
    j = defined.join(viewed, sch.REPORT_KEY, "left")
    pv_ = F.coalesce("pages_viewed", F.lit(0)).cast("bigint")
    return (j.select("workspace_id", "report_id", "workspace_name", "report_name", "pages_defined",
                     pv_.alias("pages_viewed"),
                     F.round(F.try_divide(F.lit(100.0).cast("double") * pv_, F.col("pages_defined").cast("double")), 1)
                     .alias("coverage_pct"))
            .orderBy(F.col("coverage_pct").asc(), F.col("pages_defined").desc(), "workspace_id", "report_id"))


def workspace_summary(pv: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """A5: reports, pages, views per workspace; views desc.
    Two-level: page totals first, so the distinct counts run on small data."""
    per_page = totals if totals is not None else with_latest(
        pv, sch.PAGE_KEY, ["workspace_name"], at="last_seen", views=("sum", "view_count"))
    return (per_page.groupBy("workspace_id").agg(
                latest("workspace_name", "last_seen"),
                F.count_distinct("report_id").alias("report_count"),
                F.count(F.lit(1)).alias("page_count"),
                F.sum("views").alias("total_views"))
            .orderBy(F.col("total_views").desc(), "workspace_id"))


def report_pages(pv: DataFrame, totals: DataFrame | None = None, **more: Column) -> DataFrame:
    """Per report, in one pass over the facts: latest attributes (the latest of its pages'
    latest ones), page counts, views, peak; ``more``: further aggregates of its pages' rows."""
    per_page = totals if totals is not None else with_latest(
        pv, sch.PAGE_KEY, [*REPORT_ATTRS, "page_ordinal"], at="last_seen",
        views=("sum", "view_count"), users_peak=("max", "unique_users"))
    out = per_page.groupBy(*sch.REPORT_KEY).agg(
        *[latest(a, "last_seen") for a in REPORT_ATTRS], *[c.alias(n) for n, c in more.items()],
        F.count(F.when(F.col("views") > 0, 1)).alias("pages_with_views"),
        F.count_distinct("page_ordinal").alias("_ords"),
        F.sum("views").alias("total_views"),
        F.max("users_peak").alias("active_users_peak"))
    never = (F.col("report_total_pages") - F.col("_ords")).cast("bigint")
    return out.withColumn("pages_never_viewed", never).drop("_ords")


def report_summary(pv: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Per report totals; pages_never_viewed = total pages - viewed ordinals."""
    out = report_pages(pv, totals)
    return (out.select("workspace_id", "workspace_name", "capacity_name", "report_id", "report_name",
                       F.col("report_total_pages").alias("total_pages"), "pages_with_views", "pages_never_viewed",
                       "total_views", "active_users_peak")
            .orderBy(F.col("total_views").desc(), "workspace_id", "report_id"))


def persona_breakdown(pv: DataFrame) -> DataFrame:
    """Views by top_persona per report, desc."""
    return (pv.groupBy(*sch.REPORT_KEY, F.col("top_persona").alias("persona"))
            .agg(F.sum("view_count").alias("views"))
            .orderBy("workspace_id", "report_id", F.col("views").desc(), "persona"))


def views_distribution(pv: DataFrame, catalog: DataFrame, totals: DataFrame | None = None,
                       missing: DataFrame | None = None) -> DataFrame:
    """A10: pages per views bucket, zero-view pages (J2) included, empty buckets kept."""
    spark = pv.sparkSession
    t = totals if totals is not None else page_totals(pv)
    m = missing if missing is not None else missing_page_ordinals(pv, catalog)
    views = t.select("views").unionByName(m.select(F.lit(0).cast("bigint").alias("views")))
    b = F.lit(None).cast("int")
    for i, (lo, hi) in reversed(list(enumerate(BUCKETS))):
        inside = F.col("views") >= lo if hi is None else F.col("views").between(lo, hi)
        b = F.when(inside, F.lit(i)).otherwise(b)
    counts = views.groupBy(b.alias("bucket_order")).agg(F.count(F.lit(1)).alias("pages"))
    label = F.element_at(F.array(*[F.lit(x) for x in BUCKET_LABELS]), F.col("id").cast("int") + 1)
    dim = spark.range(len(BUCKETS)).select(F.col("id").cast("int").alias("bucket_order"), label.alias("bucket"))
    return (F.broadcast(dim).join(counts, "bucket_order", "left")
            .select("bucket_order", "bucket", F.coalesce("pages", F.lit(0)).cast("bigint").alias("pages"))
            .orderBy("bucket_order"))


def underused_top10(pv: DataFrame, max_views: int = 10, k: int = 10) -> DataFrame:
    """Pages with total views <= 10 (ids, names carried), fewest first, 10 rows."""
    t = page_totals(pv).filter(F.col("views") <= max_views)
    return (t.select("workspace_id", "report_id", "page_id", "workspace_name", "report_name", "page_name",
                     F.col("views").alias("total_views"), "user_days",
                     F.col("avg_dwell_unweighted").alias("avg_dwell"))
            .orderBy("total_views", "report_name", "page_name", "workspace_id", "report_id", "page_id")
            .limit(k))


def underused_dashboard(pv: DataFrame, threshold: int = 100, cap: int = 200,
                        totals: DataFrame | None = None) -> DataFrame:
    """Viewed pages with 0 < views < threshold, ascending, first ``cap``."""
    t = (totals if totals is not None else page_totals(pv)).filter((F.col("views") > 0) & (F.col("views") < threshold))
    return (t.select("workspace_id", "report_id", "page_id", "workspace_name", "report_name",
                     "page_name", "views")
            .orderBy("views", "workspace_id", "report_id", "page_id").limit(cap))


def underused_pages_count(pv: DataFrame, max_views: int = 10) -> DataFrame:
    """Number of (report, page) with 0 < views <= 10."""
    t = pv.groupBy(*sch.PAGE_KEY).agg(F.sum("view_count").alias("v"))
    return t.agg(F.count(F.when((F.col("v") > 0) & (F.col("v") <= max_views), 1))
                 .alias("underused_pages"))


def headline_kpis(pv: DataFrame, catalog: DataFrame) -> DataFrame:
    """Total views, distinct pages viewed/defined (composite keys),
    distinct reports/workspaces, unweighted mean dwell."""
    spark = pv.sparkSession
    # one row a page first; everything is counted on those
    per_page = pv.groupBy(*sch.PAGE_KEY).agg(F.sum("view_count").alias("_v"), F.sum("avg_dwell_seconds").alias("_d"),
                                             F.count("avg_dwell_seconds").alias("_n"))
    pages = _scalars(per_page.agg(
        F.sum("_v").alias("total_views"),
        F.try_divide(F.sum("_d"), F.sum("_n")).alias("avg_dwell_unweighted"),
        F.count(F.lit(1)).alias("pages_viewed"),
        F.count_distinct(*sch.REPORT_KEY).alias("reports"),
        F.count_distinct("workspace_id").alias("workspaces")))
    return _one_row(
        spark,
        total_views=pages["total_views"],
        pages_viewed=pages["pages_viewed"],
        pages_defined=catalog.select(*sch.PAGE_KEY).distinct().select(F.count(F.lit(1))).scalar(),
        reports=pages["reports"],
        workspaces=pages["workspaces"],
        avg_dwell_unweighted=pages["avg_dwell_unweighted"],
    )


def unused_kpis(unused: DataFrame, catalog: DataFrame) -> DataFrame:
    """Unused count, share of defined pages, reports with unused pages."""
    spark = unused.sparkSession
    u = unused.select(*sch.PAGE_KEY).distinct()
    n_unused = u.select(F.count(F.lit(1))).scalar()
    n_def = catalog.select(*sch.PAGE_KEY).distinct().select(F.count(F.lit(1))).scalar()
    return _one_row(spark, unused_pages=n_unused, pct_pages_unused=safe_div(n_unused, n_def),
                    reports_with_unused=u.select(*sch.REPORT_KEY).distinct().select(F.count(F.lit(1))).scalar())


def viewed_keys_except(catalog: DataFrame, pv: DataFrame) -> DataFrame:
    """Key-set difference catalog − viewed (the legacy EXCEPT form of J1)."""
    return catalog.select(*sch.PAGE_KEY).subtract(pv.select(*sch.PAGE_KEY))


def reports_with_unused(unused: DataFrame) -> DataFrame:
    """Unused pages per report."""
    per_page = with_latest(unused, sch.PAGE_KEY, ["workspace_name", "report_name"], "catalog_pulled_at", at="_d")
    return (per_page.groupBy(*sch.REPORT_KEY)
            .agg(latest("workspace_name", "_d"), latest("report_name", "_d"), F.count("page_id").alias("unused_pages"))
            .orderBy(F.col("unused_pages").desc(), "workspace_id", "report_id"))


def top_page_share(pv: DataFrame) -> DataFrame:
    """Max page views / report views per report."""
    per_page = pv.groupBy(*sch.PAGE_KEY).agg(F.sum("view_count").alias("v"))
    r = per_page.groupBy(*sch.REPORT_KEY).agg(F.max("v").alias("top_page_views"),
                                              F.sum("v").alias("report_views"))
    return r.withColumn("top_page_share", safe_div("top_page_views", "report_views"))


def avg_views_per_page(pv: DataFrame) -> DataFrame:
    """round(total views / max(total pages, 1)), half up."""
    s = report_summary(pv)
    return s.select("workspace_id", "report_id", "total_views", "total_pages",
                    F.round(F.col("total_views") / F.greatest(F.col("total_pages"), F.lit(1)).cast("double"))
                    .cast("bigint").alias("avg_views_per_page"))


def page_daily_trend(pv: DataFrame) -> DataFrame:
    """Per page, views per date."""
    return pv.groupBy(*sch.PAGE_KEY, "view_date").agg(F.sum("view_count").alias("views"))


def top_pages(pv: DataFrame, k: int = 25, totals: DataFrame | None = None) -> DataFrame:
    """O1: the k most viewed pages (ties broken by key)."""
    t = (totals if totals is not None else page_totals(pv)).filter(F.col("views") > 0)
    return (t.select("workspace_id", "report_id", "page_id", "workspace_name", "report_name", "page_name", "views")
            .orderBy(F.col("views").desc(), "workspace_id", "report_id", "page_id").limit(k))


def unused_sample(unused: DataFrame, k: int = 10) -> DataFrame:
    """O2: first k unused pages in display order."""
    return (unused.select("workspace_id", "report_id", "page_id", "workspace_name", "report_name",
                          "page_name", "page_ordinal")
            .orderBy("workspace_name", "report_name", "page_ordinal", "workspace_id", "report_id", "page_id")
            .limit(k))


def longest_report(pv: DataFrame) -> DataFrame:
    """O3: default drill-down = the report with the most pages."""
    return (report_attrs(pv).select("workspace_id", "report_id", "report_name", "report_total_pages")
            .orderBy(F.col("report_total_pages").desc(), "workspace_id", "report_id").limit(1))


def report_picker(pv: DataFrame) -> DataFrame:
    """Reports grouped by workspace, names in byte order."""
    return (report_attrs(pv).select("workspace_name", "report_name", "workspace_id", "report_id")
            .orderBy("workspace_name", "report_name", "workspace_id", "report_id"))


def page_name_search(catalog: DataFrame, text: str = "") -> DataFrame:
    """case-insensitive literal substring match; empty text = all pages."""
    cat = catalog.select(*sch.PAGE_CATALOG.fieldNames())
    if text:
        cat = cat.filter(F.contains(F.lower("page_name"), F.lower(F.lit(text))))
    return cat


def page_funnel(pv: DataFrame) -> DataFrame:
    """Page views / the report's max page views, per ordinal (all reports).
    The per-report max is an aggregate joined back, not a window, so a
    report with many pages is not one task."""
    per_page = with_latest(pv, sch.PAGE_KEY, ["report_name", "page_name", "page_ordinal"],
                           page_views=("sum", "view_count"))
    mx = per_page.groupBy(*sch.REPORT_KEY).agg(F.max("page_views").alias("_max"))
    return (per_page.join(mx, sch.REPORT_KEY)
            .withColumn("pct_of_max", F.col("page_views") / F.col("_max").cast("double"))
            .drop("_max")
            .orderBy("workspace_id", "report_id", "page_ordinal", "page_id"))


def pct_of_first_page(pv: DataFrame) -> DataFrame:
    """Page views / views of ordinal 1 of the same report (same window both sides, T12)."""
    per_page = with_latest(pv, sch.PAGE_KEY, ["page_ordinal"], views=("sum", "view_count"))
    first = per_page.groupBy(*sch.REPORT_KEY).agg(
        F.sum(F.when(F.col("page_ordinal") == 1, F.col("views"))).alias("first_page_views"))
    return (per_page.join(first, sch.REPORT_KEY)
            .withColumn("pct_of_first_page", safe_div("views", "first_page_views")))


def cumulative_views_by_ordinal(pv: DataFrame) -> DataFrame:
    """Running views up to each ordinal of a report (distributed running total)."""
    per_ord = pv.groupBy(*sch.REPORT_KEY, "page_ordinal").agg(F.sum("view_count").alias("views"))
    return running_total(per_ord, sch.REPORT_KEY, ["page_ordinal"], "views", out="cumulative_views")


def page_bar_share(pv: DataFrame, catalog: DataFrame) -> DataFrame:
    """Bar width = max(1, 100 * views / max(views in report, 1)), zero pages included.
    They belong to viewed reports and never are the maximum, so it is that of the viewed pages."""
    d = page_detail(pv, catalog).select("workspace_id", "report_id", "page_id", "page_name",
                                        "page_ordinal", "views")
    mx = (pv.groupBy(*sch.PAGE_KEY).agg(F.sum("view_count").alias("_v"))
          .groupBy(*sch.REPORT_KEY).agg(F.greatest(F.max("_v"), F.lit(1)).alias("_max")))
    return (d.join(mx, sch.REPORT_KEY)
            .withColumn("bar_pct", F.greatest(F.lit(1.0), (F.col("views") / F.col("_max").cast("double")) * 100))
            .drop("_max")
            .orderBy("workspace_id", "report_id", F.col("views").desc(), "page_id"))
