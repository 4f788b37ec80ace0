"""Silver builders."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafstat import schemas as sch
from leafstat.functions.scalars import blank, hash_user_key, norm_user, safe_div

SALTS = 16                 # tasks that share the users of one page-day, at most


def conform(df: DataFrame, schema) -> DataFrame:
    """S3: select the declared columns in order, cast to the declared types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def window_filter(df: DataFrame, since: _dt.date | None, until: _dt.date | None,
                  col: str = "view_date") -> DataFrame:
    if since is not None:
        df = df.filter(F.col(col) >= F.lit(since))
    if until is not None:
        df = df.filter(F.col(col) <= F.lit(until))
    return df


def dedup_catalog(catalog: DataFrame) -> DataFrame:
    """One row per page key - the latest pull wins (ties: larger name/ordinal).

    Implemented as an aggregation (map-side combine, no per-key sort of the
    whole group) rather than a row_number window.
    """
    keep = [c for c in catalog.columns if c not in sch.PAGE_KEY]
    pick = F.max_by(F.struct(*keep), F.struct("catalog_pulled_at", "page_name", "page_ordinal"))
    return (catalog.groupBy(*sch.PAGE_KEY).agg(pick.alias("_r"))
            .select(*sch.PAGE_KEY, *[F.col(f"_r.{c}").alias(c) for c in keep])
            .select(*catalog.columns))


def report_dim(workspaces: DataFrame, reports: DataFrame, catalog: DataFrame | None = None) -> DataFrame:
    """Report -> workspace/capacity names (+ report_total_pages from the catalog)."""
    rd = reports.select("workspace_id", "report_id", "report_name").join(
        workspaces.select("workspace_id", "workspace_name", F.coalesce("capacity_name", F.lit(""))
                          .alias("capacity_name")), "workspace_id", "left")
    if catalog is not None:
        totals = catalog.groupBy(*sch.REPORT_KEY).agg(F.count(F.lit(1)).cast("int").alias("report_total_pages"))
        rd = rd.join(totals, sch.REPORT_KEY, "left")
    return rd


def page_views_daily(events: DataFrame, catalog: DataFrame, rdim: DataFrame,
                     since=None, until=None) -> DataFrame:
    """A1: raw events -> page-day facts (sum views, distinct users, mean dwell, top persona).

    One pass over the events, per (page-day, user, persona): views, dwell sum
    and event count.  Of a user's rows in a page-day the one with the smallest
    persona stands for the user, so that a user whose events carry several
    personas counts once; the rows then sum up per persona and per page-day,
    in one chain, so the raw joins run once.

    Two shuffles do all of it.  The first deals a page-day's users over SALTS
    tasks (rows without a user by their values), so that a busy page-day is no
    single task's; steps per user and per salt need no other.  The second
    brings the salts' sums, at most SALTS a persona and page-day, to the page,
    where the catalog's row is met as well.
    top_persona = the persona with most views, ties -> larger name.
    Names are attached after aggregation from the (deduplicated) catalog and
    the report dimension; J9: ordinal and report_total_pages come from the
    catalog (0 when the page is not in it).
    """
    keys = [*sch.PAGE_KEY, "view_date"]
    persona = F.coalesce("persona", F.lit(""))
    ev = window_filter(events, since, until).select(
        *keys, norm_user("user_upn").alias("_u"), persona.alias("persona"), "views", "dwell_seconds")
    dealt = F.when(F.col("_u").isNotNull(), F.xxhash64("_u")).otherwise(F.xxhash64("persona", "views", "dwell_seconds"))
    ev = ev.withColumn("_s", F.pmod(dealt, F.lit(SALTS)).cast("int")).repartition(*keys, "_s")
    per = ev.groupBy(*keys, "_s", "_u", "persona").agg(
        F.sum("views").alias("_v"),
        F.sum("dwell_seconds").alias("_d"),
        F.count("dwell_seconds").alias("_n"))
    # The window holds one user's personas of one page-day.
    w = Window.partitionBy(*keys, "_s", "_u", F.when(F.col("_u").isNull(), F.col("persona"))).orderBy("persona")
    stands = F.col("_u").isNotNull() & (F.row_number().over(w) == 1)
    sums = lambda: [F.sum(c).alias(c) for c in ("_v", "_d", "_n", "_one")]
    salted = per.withColumn("_one", stands.cast("long")).groupBy(*keys, "_s", "persona").agg(*sums())
    personas = salted.repartition(*sch.PAGE_KEY).groupBy(*keys, "persona").agg(*sums())
    base = personas.groupBy(*keys).agg(
        F.sum("_v").alias("view_count"),
        F.sum("_one").alias("unique_users"),
        safe_div(F.sum("_d"), F.sum("_n")).alias("avg_dwell_seconds"),
        F.max_by("persona", F.struct("_v", "persona")).alias("top_persona"))
    cat = catalog.select(*sch.PAGE_KEY, "page_name", "page_ordinal")
    out = (base.join(cat, sch.PAGE_KEY, "left")
           .join(rdim, sch.REPORT_KEY, "left"))
    out = out.select(
        "workspace_id", F.coalesce("workspace_name", F.lit("")).alias("workspace_name"),
        F.coalesce("capacity_name", F.lit("")).alias("capacity_name"),
        "report_id", F.coalesce("report_name", F.lit("")).alias("report_name"),
        F.coalesce("report_total_pages", F.lit(0)).alias("report_total_pages"),
        "page_id", F.coalesce("page_name", F.lit("")).alias("page_name"),
        F.coalesce("page_ordinal", F.lit(0)).alias("page_ordinal"),
        "view_date", "view_count", "unique_users", "avg_dwell_seconds",
        F.coalesce("top_persona", F.lit("")).alias("top_persona"),
    )
    return conform(out, sch.PAGE_VIEWS)


def report_views_daily(visits: DataFrame, rdim: DataFrame, since=None, until=None) -> DataFrame:
    """A2: raw visits -> report-day facts (visits, distinct users, mean session seconds)."""
    v = window_filter(visits, since, until)
    agg = v.groupBy(*sch.REPORT_KEY, "view_date").agg(
        F.sum("visits").alias("view_count"),
        F.count_distinct(norm_user("user_upn")).alias("unique_users"),
        F.avg("session_seconds").alias("avg_session_seconds"),
    )
    out = agg.join(rdim, sch.REPORT_KEY, "left").select(
        "workspace_id", F.coalesce("workspace_name", F.lit("")).alias("workspace_name"),
        F.coalesce("capacity_name", F.lit("")).alias("capacity_name"),
        "report_id", F.coalesce("report_name", F.lit("")).alias("report_name"),
        "view_date", "view_count", "unique_users", "avg_session_seconds")
    return conform(out, sch.REPORT_VIEWS)


def user_views_daily(events: DataFrame, rdim: DataFrame, since=None, until=None) -> DataFrame:
    """A3: raw events -> pseudonymised user-day facts.

    Groups on the normalised UPN (so two spellings of one user merge) and
    hashes once per output row, not once per event.  Distinct pages are
    counted on page ids (the documented rule).
    """
    ev = window_filter(events, since, until).withColumn("_u", norm_user("user_upn"))
    agg = ev.groupBy(*sch.REPORT_KEY, "_u", "view_date").agg(
        F.sum("views").alias("view_count"),
        F.count_distinct("page_id").alias("distinct_pages_viewed"))
    out = agg.join(rdim, sch.REPORT_KEY, "left").select(
        "workspace_id", F.coalesce("workspace_name", F.lit("")).alias("workspace_name"),
        "report_id", F.coalesce("report_name", F.lit("")).alias("report_name"),
        hash_user_key("_u").alias("user_id_hash"), "view_date", "view_count",
        "distinct_pages_viewed")
    return conform(out, sch.USER_VIEWS)


def report_views_rollup(page_views: DataFrame) -> DataFrame:
    """A4: report-day facts rolled up from page facts when no visit feed exists.

    unique_users = max over pages (a lower bound); dwell = view-weighted mean,
    0.0 when the day has no views.
    """
    g = page_views.groupBy(*sch.REPORT_KEY, "view_date").agg(
        F.max_by(F.struct("workspace_name", "capacity_name", "report_name"),
                 F.struct("workspace_name", "capacity_name", "report_name")).alias("_n"),
        F.sum("view_count").alias("view_count"),
        F.max("unique_users").alias("unique_users"),
        F.sum(F.col("view_count") * F.col("avg_dwell_seconds")).alias("_dw"),
    )
    out = g.select(
        "workspace_id", F.col("_n.workspace_name").alias("workspace_name"),
        F.col("_n.capacity_name").alias("capacity_name"), "report_id",
        F.col("_n.report_name").alias("report_name"), "view_date", "view_count", "unique_users",
        F.coalesce(safe_div("_dw", "view_count"), F.lit(0.0)).alias("avg_session_seconds"))
    return conform(out, sch.REPORT_VIEWS)


def unused_pages(catalog: DataFrame, page_views: DataFrame, since=None, until=None,
                 order: bool = True) -> DataFrame:
    """Catalog pages with no page-view row in the window (left anti join).

    The view side is reduced to distinct keys after date pruning; the
    catalog is de-duplicated on its key first (T11).
    """
    seen = window_filter(page_views, since, until).select(*sch.PAGE_KEY).distinct()
    cat = dedup_catalog(catalog.select(*sch.PAGE_CATALOG.fieldNames()))
    out = conform(cat.join(seen, sch.PAGE_KEY, "left_anti"), sch.UNUSED_PAGES)
    if order:
        out = out.orderBy("workspace_name", "report_name", "page_ordinal", "page_id")
    return out


def is_unused_flag(catalog: DataFrame, unused: DataFrame) -> DataFrame:
    """catalog with an is_unused 0/1 column (one denormalised page dim)."""
    flag = unused.select(*sch.PAGE_KEY).distinct().withColumn("_u", F.lit(1))
    return (dedup_catalog(catalog.select(*sch.PAGE_CATALOG.fieldNames()))
            .join(flag, sch.PAGE_KEY, "left")
            .withColumn("is_unused", F.coalesce("_u", F.lit(0)).cast("int")).drop("_u"))


def enrich_blank_identity(rows: DataFrame, workspaces: DataFrame, reports: DataFrame) -> DataFrame:
    """F8 + J8: fill blank workspace/report identity from the enumeration.

    Rows whose workspace_id, workspace_name and report_name are all set pass
    through unchanged (a blank capacity then stays blank).
    """
    ctx = (reports.groupBy("report_id", F.col("workspace_id").alias("_ws_id"))
           .agg(F.max("report_name").alias("_rep_name"))
           .join(workspaces.groupBy(F.col("workspace_id").alias("_ws_id"))
                 .agg(F.max("workspace_name").alias("_ws_name"), F.max("capacity_name").alias("_cap")), "_ws_id", "left"))
    # A report id may be in several workspaces: the row's own workspace decides, and
    # without one the smallest, so a row never becomes two.
    ctx = ctx.withColumn("_first", F.min("_ws_id").over(Window.partitionBy("report_id")))
    lookup = (ctx.select("report_id", F.col("_ws_id").alias("_own"), "_ws_id", "_rep_name", "_ws_name", "_cap")
              .unionByName(ctx.where(F.col("_ws_id") == F.col("_first"))
                           .select("report_id", F.lit("").alias("_own"), "_ws_id", "_rep_name", "_ws_name", "_cap")))
    own = F.when(blank("workspace_id"), F.lit("")).otherwise(F.col("workspace_id"))
    j = rows.withColumn("_own", own).join(lookup, ["report_id", "_own"], "left").withColumn(
        "_complete", ~blank("workspace_id") & ~blank("workspace_name") & ~blank("report_name"))

    def fill(c, ctx_col):
        return F.when(F.col("_complete"), F.col(c)).otherwise(
            F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(ctx_col), F.lit("")))

    out = j
    for c, k in (("workspace_id", "_ws_id"), ("workspace_name", "_ws_name"),
                 ("report_name", "_rep_name"), ("capacity_name", "_cap")):
        if c in rows.columns:
            out = out.withColumn(c, fill(c, k))
    return out.select(*rows.columns)


def catalog_with_overlay(seen_pages: DataFrame, overlay: DataFrame) -> DataFrame:
    """catalog = distinct pages seen in facts ∪ overlay pages not already seen."""
    seen = dedup_catalog(seen_pages.select(*sch.PAGE_CATALOG.fieldNames()))
    extra = overlay.select(*sch.PAGE_CATALOG.fieldNames()).join(
        seen.select(*sch.PAGE_KEY), sch.PAGE_KEY, "left_anti")
    return seen.unionByName(dedup_catalog(extra))


def grain_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("F", "DataFrame", "sch")]
