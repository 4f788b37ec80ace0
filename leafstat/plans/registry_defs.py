"""Registration of every catalogue query (import side effect)."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafstat.operators import silver as sv
from leafstat.plans.catalogue import register
from leafstat.plans.lakehouse import Lakehouse


# -- silver ---------------------------------------------------------------
@register("page_views_daily")
def _pv(lh: Lakehouse):
    return lh.page_views


@register("report_views_daily")
def _rv(lh: Lakehouse):
    return lh.report_views


@register("user_views_daily")
def _uv(lh: Lakehouse):
    return lh.user_views


@register("page_catalog")
def _pc(lh: Lakehouse):
    return lh.page_catalog


@register("unused_pages")
def _up(lh: Lakehouse):
    return lh.unused_pages.orderBy("workspace_name", "report_name", "page_ordinal", "page_id")


# -- helpers ---------------------------------------------------------------
def pvw(lh: Lakehouse, days: int = 90):
    lo, hi = lh.window(days)
    return sv.window_filter(lh.page_views, lo, hi)


def rvw(lh: Lakehouse, days: int = 90):
    lo, hi = lh.window(days)
    return sv.window_filter(lh.report_views, lo, hi)


def uvw(lh: Lakehouse, days: int = 90):
    lo, hi = lh.window(days)
    return sv.window_filter(lh.user_views, lo, hi)


def unused(lh: Lakehouse):
    return lh.unused_pages      # as stored, or derived where it is not


# -- pages and reports ------------------------------------------------------
from leafstat.operators import pages as pg  # noqa: E402
from leafstat.operators import reports as rp  # noqa: E402

register("missing_page_ordinals")(lambda lh: pg.missing_page_ordinals(pvw(lh), lh.page_catalog))
register("page_detail")(lambda lh: pg.page_detail(pvw(lh), lh.page_catalog))
register("page_coverage_rate")(lambda lh: pg.page_coverage_rate(pvw(lh), lh.page_catalog))
register("workspace_summary")(lambda lh: pg.workspace_summary(pvw(lh)))
register("report_summary")(lambda lh: pg.report_summary(pvw(lh)))
register("persona_breakdown")(lambda lh: pg.persona_breakdown(pvw(lh)))
register("views_distribution")(lambda lh: pg.views_distribution(pvw(lh), lh.page_catalog))
register("underused_top10")(lambda lh: pg.underused_top10(pvw(lh)))
register("underused_dashboard")(lambda lh: pg.underused_dashboard(pvw(lh)))
register("underused_pages_count")(lambda lh: pg.underused_pages_count(pvw(lh)))
register("headline_kpis")(lambda lh: pg.headline_kpis(pvw(lh), lh.page_catalog))
register("unused_kpis")(lambda lh: pg.unused_kpis(unused(lh), lh.page_catalog))
register("viewed_keys_except")(lambda lh: pg.viewed_keys_except(lh.page_catalog, pvw(lh)))
register("reports_with_unused")(lambda lh: pg.reports_with_unused(unused(lh)))
register("top_page_share")(lambda lh: pg.top_page_share(pvw(lh)))
register("avg_views_per_page")(lambda lh: pg.avg_views_per_page(pvw(lh)))
register("page_daily_trend")(lambda lh: pg.page_daily_trend(pvw(lh)))
register("top_pages")(lambda lh: pg.top_pages(pvw(lh)))
register("unused_sample")(lambda lh: pg.unused_sample(unused(lh)))
register("longest_report")(lambda lh: pg.longest_report(pvw(lh)))
register("report_picker")(lambda lh: pg.report_picker(pvw(lh)))
register("page_name_search")(lambda lh: pg.page_name_search(lh.page_catalog, "blue"))
register("page_funnel")(lambda lh: pg.page_funnel(pvw(lh, 30)))
register("pct_of_first_page")(lambda lh: pg.pct_of_first_page(pvw(lh)))
register("cumulative_views_by_ordinal")(lambda lh: pg.cumulative_views_by_ordinal(pvw(lh)))
register("page_bar_share")(lambda lh: pg.page_bar_share(pvw(lh), lh.page_catalog))
register("pages_per_session")(lambda lh: rp.pages_per_session(pvw(lh, 30), rvw(lh, 30)))
register("daily_trend")(lambda lh: rp.daily_trend(pvw(lh)))
register("views_by_capacity")(lambda lh: rp.views_by_capacity(pvw(lh)))
register("report_level_kpis")(lambda lh: rp.report_level_kpis(pvw(lh), rvw(lh)))
register("trend_page_vs_report")(lambda lh: rp.trend_page_vs_report(pvw(lh), rvw(lh)))
register("report_matrix")(lambda lh: rp.report_matrix(pvw(lh), rvw(lh), unused(lh)))
register("dashboard_meta")(lambda lh: rp.dashboard_meta(pvw(lh), lh.page_catalog))


# -- trends, users, governance, ops -----------------------------------------
import datetime as _dt  # noqa: E402

from leafstat.operators import governance as gv  # noqa: E402
from leafstat.operators import ops  # noqa: E402
from leafstat.operators import trends as tr  # noqa: E402
from leafstat.operators import users as us  # noqa: E402

KNOWN_UPN = "Customer#000000001@example.com"   # parameter of forget_user
OWNER_UPN = "nation_0@example.com"             # parameter of workspace_owner_rls

register("rolling_7d_views")(lambda lh: tr.rolling_7d_views(lh.page_views, lh.as_of))
register("report_half_life")(lambda lh: tr.report_half_life(lh.page_views, lh.as_of))
register("capacity_long_tail")(lambda lh: tr.capacity_long_tail(pvw(lh, 30)))
register("trailing_views")(lambda lh: tr.trailing_views(lh.page_views, lh.as_of))
register("wow_change")(lambda lh: tr.wow_change(lh.page_views, lh.as_of))
register("new_page_adoption")(
    lambda lh: tr.new_page_adoption(lh.page_views, lh.first_date + _dt.timedelta(days=89)))
register("idle_alert")(lambda lh: tr.idle_alert(lh.page_views, lh.page_catalog, lh.as_of))
register("idle_reports")(lambda lh: tr.idle_reports(lh.page_views, lh.reports, lh.as_of))
register("power_users_per_report")(lambda lh: us.power_users_per_report(uvw(lh)))
register("power_users_count")(lambda lh: us.power_users_count(uvw(lh)))
register("user_kpis")(lambda lh: us.user_kpis(uvw(lh)))
register("top_users")(lambda lh: us.top_users(uvw(lh)))
register("multi_page_user_share")(
    lambda lh: us.multi_page_user_share(sv.window_filter(lh.events, *lh.window(90))))
register("owner_accountability")(
    lambda lh: us.owner_accountability(pvw(lh), lh.side("workspace_owners"), unused(lh)))
register("resolve_known_users")(lambda lh: us.resolve_known_users(uvw(lh), lh.side("people")))
register("persona_enrichment")(lambda lh: us.persona_enrichment(lh.events, lh.side("people")))
register("workspace_owner_rls")(
    lambda lh: us.workspace_owner_rls(pvw(lh), lh.side("workspace_owners"), OWNER_UPN))
register("strip_identifying_names")(lambda lh: us.strip_identifying_names(uvw(lh)))
register("retain_silver")(lambda lh: gv.retain_silver(lh.page_views, lh.as_of, 90))
register("forget_user")(lambda lh: gv.forget_user(lh.user_views, KNOWN_UPN))
register("pii_guard")(lambda lh: gv.pii_guard(lh.user_views))
register("grain_check")(lambda lh: gv.grain_check(lh.silver()))
register("report_views_rollup")(lambda lh: sv.report_views_rollup(lh.page_views))
register("rollup_consistency")(
    lambda lh: gv.rollup_consistency(sv.report_views_rollup(lh.page_views), lh.page_views))
register("stale_catalog")(lambda lh: gv.stale_catalog(lh.page_catalog, lh.as_of))
register("rows_drop_alert")(lambda lh: ops.rows_drop_alert(lh.side("runs_from_volume")))
register("dau_drop_alert")(lambda lh: ops.dau_drop_alert(lh.user_views))
register("run_severity")(lambda lh: ops.run_severity(lh.side("runs_from_events")))
register("run_scope_drop")(lambda lh: ops.run_scope_drop(lh.side("runs_scope")))
register("workspace_capacity")(lambda lh: ops.workspace_capacity(lh.workspaces))
register("active_workspaces")(lambda lh: ops.active_workspaces(lh.workspaces))
register("standard_reports")(lambda lh: ops.standard_reports(lh.reports))
register("usage_dataset_per_workspace")(
    lambda lh: ops.usage_dataset_per_workspace(lh.side("datasets"), "NATION_2"))
register("not_bootstrapped_workspaces")(
    lambda lh: ops.not_bootstrapped_workspaces(lh.workspaces, lh.reports, lh.side("datasets"), "NATION_5"))


UNIT_MEMBER = "nation_6@example.com"           # parameter of business_unit_rls: in two units


register("business_unit_rls")(lambda lh: us.business_unit_rls(
    pvw(lh), lh.side("workspace_units"), lh.side("unit_members"), UNIT_MEMBER))


# -- storage, payloads, gold -------------------------------------------------
import uuid  # noqa: E402

from functools import reduce  # noqa: E402

from pyspark.sql import DataFrame  # noqa: E402

from leafstat import schemas as sch  # noqa: E402
from leafstat.plans import gold, gold_sink  # noqa: E402
from leafstat.plans.collect import collect  # noqa: E402
from leafstat.session import scratch_dir  # noqa: E402
from leafstat.sources import files as io  # noqa: E402
from leafstat.sources import payload as pl  # noqa: E402
from leafstat.functions.scalars import page_key  # noqa: E402
from leafstat.streaming.upsert import upsert  # noqa: E402


RENAMED = "ws-1"           # the workspace that bronze_snapshot_diff renames


def _scratch(lh: Lakehouse, tag: str) -> str:
    return scratch_dir(lh.spark, f"q-{tag}-{uuid.uuid4().hex[:12]}")


@register("run_summary")
def _summary(lh: Lakehouse):
    """K5: one collection run into a new folder, and its row of the run log."""
    return ops.run_summary(collect(lh, _scratch(lh, "run"), dataset_prefix="NATION_5"))


register("run_metrics_json")(lambda lh: ops.run_metrics_json(_summary(lh)))
register("run_metrics_gauges")(lambda lh: ops.run_metrics_gauges(_summary(lh)))


def _silver_stored(lh: Lakehouse, *tables: str) -> str:
    """K2: whole silver tables as Parquet, each written once for the steps of a query that
    read it back; the unused pages are made from the stored catalog and facts."""
    root = lh.stored.setdefault("silver", _scratch(lh, "silver"))
    facts, source = [t for t in tables if t in sch.PARTITION_COL and f"silver/{t}" not in lh.stored], lh
    if len(facts) > 1 and lh.feeds.has("raw_page_events"):
        source = lh.on_landed_events(_scratch(lh, "events"))
    for table in tables:
        if f"silver/{table}" in lh.stored:
            continue
        if table == "unused_pages":
            _silver_stored(lh, "page_catalog", "page_views")
            views, catalog = (io.read_table(lh.spark, root, t) for t in ("page_views", "page_catalog"))
            rows = sv.unused_pages(catalog, views, *lh.window(90), order=False)
        else:
            rows = getattr(source, table)
        lh.stored[f"silver/{table}"] = io.write_table(rows, root, table)
    return root


def _stored(lh: Lakehouse, table: str) -> DataFrame:
    """A silver table read back, for a query that uses its rows several times."""
    return io.read_table(lh.spark, _silver_stored(lh, table), table)


def _round_trip(name: str, table: str, mode: str):
    """K2 -> S2 (version check) -> S1/S8 (typed read), for one whole silver table."""
    @register(name)
    def run(lh: Lakehouse):
        if mode == "parquet":
            return io.load_table(lh.spark, mode, _silver_stored(lh, table), table)
        root = _scratch(lh, mode)
        io.write_silver_csv(getattr(lh, table), f"{root}/{table}", sch.SILVER[table])
        return io.load_table(lh.spark, mode, root, table)


for _mode in ("csv", "parquet"):
    _round_trip(f"silver_{_mode}_roundtrip", "page_views", _mode)
    for _table in ("page_catalog", "report_views", "user_views", "unused_pages"):
        _round_trip(f"silver_{_mode}_roundtrip_{_table}", _table, _mode)


def _upserted(lh: Lakehouse, table: str, value_col: str):
    """K3 on the whole fact table: base = all days but the last 30 with stale (doubled)
    values, batch = the last 60 days with the true values -> updates, inserts, untouched."""
    lo, hi = lh.window(90)
    mid_lo, mid_hi = lo + _dt.timedelta(days=30), lo + _dt.timedelta(days=59)
    root = _scratch(lh, "upsert")
    df = _stored(lh, table)
    stale = df.filter(F.col("view_date") <= F.lit(mid_hi)).withColumn(value_col, F.col(value_col) * 2)
    io.write_table(stale, root, table)
    upsert(df.filter(F.col("view_date").between(F.lit(mid_lo), F.lit(hi))), root, table, stream="query", epoch=0)
    upsert(stale, root, table, stream="query", epoch=0)     # a replayed epoch changes nothing
    return io.read_table(lh.spark, root, table)


register("upsert_page_views")(lambda lh: _upserted(lh, "page_views", "view_count"))
register("upsert_report_views")(lambda lh: _upserted(lh, "report_views", "view_count"))
register("upsert_user_views")(lambda lh: _upserted(lh, "user_views", "view_count"))


@register("forget_user_stored")
def _forget_stored(lh: Lakehouse):
    """G3 on storage: the stored user-day table after erasing one person
    (only the days holding their hash are rewritten)."""
    root = _scratch(lh, "g3")
    io.write_table(lh.user_views, root, "user_views")
    gv.forget_user_in_table(lh.spark, root, KNOWN_UPN)
    return io.read_table(lh.spark, root, "user_views")


@register("replace_page_catalog")
def _replace_catalog(lh: Lakehouse):
    """K4: whole-table replace - an earlier, different snapshot leaves nothing behind."""
    root = _scratch(lh, "k4")
    io.write_table(unused(lh), root, "page_catalog")
    io.write_table(lh.page_catalog, root, "page_catalog")
    return io.read_table(lh.spark, root, "page_catalog")


@register("replace_unused_pages")
def _replace_unused(lh: Lakehouse):
    root = _scratch(lh, "k4u")
    io.write_table(lh.page_catalog, root, "unused_pages")
    io.write_table(unused(lh), root, "unused_pages")
    return io.read_table(lh.spark, root, "unused_pages")


def _bronze(name: str, feed: str):
    @register(name)
    def run(lh: Lakehouse):
        """K1: two daily runs, each of the whole feed up to its day; the second run is
        written twice to show that its day partition is replaced, not appended."""
        root, rows, hi = _scratch(lh, "bronze"), _stored(lh, feed), lh.as_of
        for day in (hi - _dt.timedelta(days=1), hi, hi):
            landed = sv.window_filter(rows, None, day) if "view_date" in rows.columns else rows
            io.write_bronze(landed, root, feed, day)
        return io.read_bronze(lh.spark, root, feed, sch.SILVER[feed])


_bronze("write_bronze", "page_views")
for _feed in ("page_catalog", "report_views", "user_views"):
    _bronze(f"write_bronze_{_feed}", _feed)


@register("retain_bronze")
def _retain_bronze(lh: Lakehouse):
    """G1: every day landed as the bronze partition of its run, the partitions older
    than the cut-off dropped, the rest read back."""
    root = _scratch(lh, "g1")
    io.write_bronze_days(lh.page_views, root, "page_views", "view_date")
    gv.retain_bronze(lh.spark, f"{root}/page_views", lh.as_of, 90)
    return io.read_bronze(lh.spark, root, "page_views", sch.PAGE_VIEWS)


@register("bronze_snapshot_diff")
def _j11(lh: Lakehouse):
    """J11 on landed bronze: the runs of the last two days, all four feeds, compared by
    partition; between the runs one workspace was renamed."""
    root, hi = _scratch(lh, "j11"), lh.as_of
    before = hi - _dt.timedelta(days=1)
    renamed = F.when(F.col("workspace_id") == RENAMED, F.concat("workspace_name", F.lit(" (new)"))).otherwise(F.col("workspace_name"))
    parts = []
    for feed in ("page_views", "page_catalog", "report_views", "user_views"):
        rows = getattr(lh, feed)
        for day in (before, hi):
            landed = sv.window_filter(rows, day, day) if "view_date" in rows.columns else rows
            io.write_bronze(landed.withColumn("workspace_name", renamed) if day == hi else landed, root, feed, day)
        a, b = (io.read_bronze(lh.spark, root, feed, sch.SILVER[feed], day) for day in (before, hi))
        parts.append(ops.bronze_snapshot_diff(a, b).select(F.lit(feed).alias("feed"), "*"))
    return reduce(DataFrame.unionByName, parts)


@register("export_unused_by_workspace")
def _k8(lh: Lakehouse):
    root = _scratch(lh, "k8")
    io.export_unused_by_workspace(unused(lh), f"{root}/unused")
    schema = "workspace_id string, report_id string, report_name string, page_id string, page_name string, " \
             "page_ordinal int, catalog_pulled_at timestamp_ntz, workspace_name string"
    return lh.spark.read.schema(schema).option("header", True).option("escape", '"').csv(f"{root}/unused")


@register("table_row_counts")
def _k9(lh: Lakehouse):
    return io.table_row_counts(lh.spark, _silver_stored(lh, *sch.SILVER), (*sch.SILVER, "no_such_table"))


@register("read_catalog_sidecar")
def _s7(lh: Lakehouse):
    root = _scratch(lh, "s7")
    io.write_silver_csv(lh.catalog_full, f"{root}/reports_catalog", sch.CATALOG_SIDECAR)
    return io.read_catalog_sidecar(lh.spark, f"{root}/reports_catalog")


def _landed_docs(lh: Lakehouse, docs) -> DataFrame:
    root = _scratch(lh, "s4")
    docs.select("value").write.mode("overwrite").option("compression", "gzip").text(f"{root}/landed")
    return pl.landed_documents(lh.spark, f"{root}/landed")


def _user_days(lh: Lakehouse) -> DataFrame:
    """User-days as the API returns them, users still named; landed, as the documents use them twice."""
    days = lh.events.groupBy("report_id", "view_date", "user_upn").agg(
        F.sum("views").alias("view_count"), F.count_distinct("page_id").alias("distinct_pages_viewed"))
    path = f"{_scratch(lh, 's4')}/user_days"
    days.write.parquet(path)
    return lh.spark.read.schema(days.schema).parquet(path)


@register("flatten_usage_payload")
def _s4(lh: Lakehouse):
    """S4, page target: page-day rows landed as API result documents, then flattened back."""
    return pl.flatten_page_payload(_landed_docs(lh, pl.page_payload_docs(_stored(lh, "page_views"))))


@register("flatten_report_payload")
def _s4_report(lh: Lakehouse):
    """S4, report target."""
    return pl.flatten_report_payload(_landed_docs(lh, pl.report_payload_docs(_stored(lh, "report_views"))))


@register("flatten_user_payload")
def _s4_user(lh: Lakehouse):
    """S4, user target: named users in the documents, hashes in the rows."""
    return pl.flatten_user_payload(_landed_docs(lh, pl.user_payload_docs(_user_days(lh))))


@register("corrupt_payloads")
def _s4_corrupt(lh: Lakehouse):
    """Documents that are none (dataset names, landed among the report target's
    documents) are counted, and the rows of the others are kept."""
    docs = pl.report_payload_docs(_stored(lh, "report_views")).select("value").unionByName(
        lh.side("datasets").select(F.col("dataset_name").alias("value")))
    landed = _landed_docs(lh, docs)
    rows = pl.flatten_report_payload(landed).agg(F.count(F.lit(1)).alias("rows"))
    bad = pl.corrupt_documents(landed).agg(F.coalesce(F.sum("corrupt"), F.lit(0)).alias("corrupt"))
    return bad.select("corrupt", rows.scalar().alias("rows"))


@register("catalog_from_pages_payload")
def _s5(lh: Lakehouse):
    root = _scratch(lh, "s5")
    pl.roster_docs(lh.page_catalog).write.mode("overwrite").parquet(f"{root}/roster")
    docs = lh.spark.read.parquet(f"{root}/roster")
    return pl.catalog_from_roster(docs, _dt.datetime.combine(lh.as_of, _dt.time()))


@register("catalog_with_overlay")
def _s6(lh: Lakehouse):
    """catalog = pages seen in the window's facts ∪ overlay pages (from
    landed overlay documents) not already seen."""
    root = _scratch(lh, "s6")
    pl.overlay_docs(unused(lh)).write.mode("overwrite").text(f"{root}/overlay")
    ov = pl.parse_overlay(lh.spark.read.text(f"{root}/overlay"))
    # The overlay names no workspace: a report id in several takes the smallest.
    rdim = (lh.page_catalog.groupBy("report_id")
            .agg(F.min(F.struct("workspace_id", "workspace_name", "report_name")).alias("r")).select("report_id", "r.*"))
    pulled = F.lit(_dt.datetime.combine(lh.as_of, _dt.time())).cast("timestamp_ntz")
    overlay = ov.join(rdim, "report_id").withColumn("catalog_pulled_at", pulled)
    seen = pvw(lh).select(*sch.PAGE_KEY, "workspace_name", "report_name", "page_name", "page_ordinal",
                          pulled.alias("catalog_pulled_at"))
    return sv.catalog_with_overlay(seen, overlay)


register("kpi_page_usage_daily")(lambda lh: gold.kpi_page_usage_daily(lh.page_views))
register("kpi_underused_pages")(lambda lh: gold.kpi_underused_pages(pvw(lh)))
register("kpi_long_report_engagement")(lambda lh: gold.kpi_long_report_engagement(pvw(lh), lh.page_catalog))
register("dim_workspace")(lambda lh: gold.dim_workspace(lh.page_views))
register("dim_report")(lambda lh: gold.dim_report(lh.page_views))
register("dim_page")(lambda lh: gold.dim_page(lh.page_views, lh.page_catalog))
register("dim_date")(lambda lh: gold.dim_date(lh.page_views))
register("fact_page_views")(lambda lh: gold.fact_page_views(lh.page_views))
register("dashboard_payload")(lambda lh: gold.dashboard_payload(pvw(lh), lh.page_catalog))
register("is_unused_flag")(lambda lh: sv.is_unused_flag(lh.page_catalog, unused(lh)))
register("page_key")(lambda lh: lh.page_catalog.select(*sch.PAGE_KEY, page_key().alias("page_key")))


def _refreshed(lh: Lakehouse) -> str:
    """Gold built on silver whose last 60 days are stale (doubled), then refreshed for
    the days that an upsert of the true values touched; done once for all its marts."""
    if "refreshed" in lh.gold:
        return lh.gold["refreshed"]
    root = _scratch(lh, "gold")
    lo, hi = lh.as_of - _dt.timedelta(days=59), lh.as_of
    late = F.col("view_date").between(F.lit(lo), F.lit(hi))
    views = _stored(lh, "page_views")
    io.write_table(views.withColumn("view_count", F.when(late, F.col("view_count") * 2).otherwise(F.col("view_count"))),
                   root, "page_views")
    io.write_table(_stored(lh, "page_catalog"), root, "page_catalog")
    gold_sink.build(Lakehouse.from_path(lh.spark, root), f"{root}/gold")
    batch = views.filter(late)
    upsert(batch, root, "page_views")
    touched = [r[0] for r in batch.select("view_date").distinct().collect()]     # a row a day of 60
    gold_sink.refresh(Lakehouse.from_path(lh.spark, root), f"{root}/gold", touched)
    lh.gold["refreshed"] = f"{root}/gold"
    return lh.gold["refreshed"]


for _name, _mart in (("gold_page_usage_refreshed", "kpi_page_usage_daily"), ("gold_fact_refreshed", "fact_page_views"),
                     ("gold_dim_page_refreshed", "dim_page")):
    register(_name)(lambda lh, mart=_mart: gold_sink.read(lh.spark, _refreshed(lh), mart))


# -- anchor and window ------------------------------------------------------
from leafstat.functions import dates as dts  # noqa: E402

register("as_of_max_date")(lambda lh: dts.as_of_frame(lh.page_views))
register("date_window")(lambda lh: dts.date_window_frame(lh.page_views, 90))


# -- filters and unions ------------------------------------------------------
REPORT_ID = "Brand#1"  # parameter of report_filter


@register("report_filter")
def _f6(lh: Lakehouse):
    """one report's page-day rows (pushed to the scan as a literal filter)."""
    return pvw(lh).filter(F.col("report_id") == F.lit(REPORT_ID))


@register("enrich_blank_identity")
def _f8(lh: Lakehouse):
    """F8 + J8: page-day rows as the live API returns them (bare ids, blank
    names and capacity) enriched from the workspace/report enumeration."""
    bare = pvw(lh).select(*[F.lit("").alias(c) if c in ("workspace_name", "capacity_name", "report_name")
                            else F.col(c) for c in sch.PAGE_VIEWS.fieldNames()])
    return sv.enrich_blank_identity(bare, lh.workspaces, lh.reports.withColumn(
        "report_name", F.concat(F.lit("Report "), F.col("report_id"))))


@register("catalog_union")
def _u2(lh: Lakehouse):
    """Catalog and unused pages in one table with a source flag."""
    cols = sch.PAGE_CATALOG.fieldNames()
    return (lh.page_catalog.select(*cols, F.lit("page_catalog").alias("source"))
            .unionByName(unused(lh).select(*cols, F.lit("unused_pages").alias("source"))))
