"""User and owner queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafstat import schemas as sch
from leafstat.functions.scalars import hash_user, norm_user
from leafstat.operators.common import with_latest


def power_users_per_report(uv: DataFrame, min_views: int = 50, k: int = 50) -> DataFrame:
    """Per (workspace, report, user hash): views, page-days (T9), active days;
    >= 50 views; top 50 by views (ties by key).  Numbers first; names join the users left."""
    keys = [*sch.REPORT_KEY, "user_id_hash"]
    g = uv.groupBy(*keys).agg(
        F.sum("view_count").alias("lifetime_page_views"),
        F.sum("distinct_pages_viewed").alias("page_days"),
        F.count_distinct("view_date").alias("active_days"))
    names = with_latest(uv, keys, ["workspace_name", "report_name"])
    return (g.filter(F.col("lifetime_page_views") >= min_views).join(names, keys)
            .select(*keys, "workspace_name", "report_name", "lifetime_page_views", "page_days", "active_days")
            .orderBy(F.col("lifetime_page_views").desc(), "workspace_id", "report_id", "user_id_hash")
            .limit(k))


def power_users_count(uv: DataFrame, more_than: int = 50) -> DataFrame:
    """Number of users with more than 50 views in the context."""
    g = uv.groupBy("user_id_hash").agg(F.sum("view_count").alias("v"))
    return g.agg(F.count(F.when(F.col("v") > more_than, 1)).alias("power_users"))


def user_kpis(uv: DataFrame) -> DataFrame:
    """Distinct users and the mean over users of their summed daily distinct pages."""
    g = uv.groupBy("user_id_hash").agg(F.sum("distinct_pages_viewed").alias("p"))
    return g.agg(F.count(F.lit(1)).alias("unique_users"), F.avg("p").alias("avg_pages_per_user"))


def top_users(uv: DataFrame, k: int = 25) -> DataFrame:
    """Top 25 user hashes by views."""
    return (uv.groupBy("user_id_hash").agg(F.sum("view_count").alias("views"))
            .orderBy(F.col("views").desc(), "user_id_hash").limit(k))


def multi_page_user_share(events: DataFrame) -> DataFrame:
    """Share of users who touched more than one page (true distinct, raw events)."""
    per_user = (events.select(norm_user("user_upn").alias("_u"), *sch.PAGE_KEY).distinct()
                .groupBy("_u").agg(F.count(F.lit(1)).alias("pages")))
    return per_user.agg(F.avg(F.when(F.col("pages") > 1, 1.0).otherwise(0.0)).alias("multi_page_user_share"))


def owner_accountability(pv: DataFrame, owners: DataFrame, unused: DataFrame | None = None,
                         max_views: int = 10) -> DataFrame:
    """J7 + A25 (T8, T18): per owner, under-used pages (<= 10 views), reports and
    views in owned workspaces, plus never-viewed pages from J1.

    Pages are summed per workspace first; only that small per-workspace
    table meets the owners, so several owners per workspace cost nothing.
    """
    pages = pv.groupBy(*sch.PAGE_KEY).agg(F.sum("view_count").alias("total_views"))
    per_ws = pages.groupBy("workspace_id").agg(
        F.count(F.when(F.col("total_views") <= max_views, 1)).alias("underused_pages"),
        F.count_distinct("report_id").alias("reports_owned"),
        F.sum("total_views").alias("total_views_owned"))
    if unused is not None:
        un = unused.select(*sch.PAGE_KEY).distinct().groupBy("workspace_id").agg(
            F.count(F.lit(1)).alias("unused_pages"))
        per_ws = per_ws.join(un, "workspace_id", "left")
    j = owners.select("workspace_id", "owner_upn", "owner_name").join(per_ws, "workspace_id")
    aggs = [F.sum("underused_pages").alias("underused_pages"), F.sum("reports_owned").alias("reports_owned"),
            F.sum("total_views_owned").alias("total_views_owned")]
    if unused is not None:
        aggs.append(F.coalesce(F.sum("unused_pages"), F.lit(0)).cast("bigint").alias("unused_pages"))
    return (j.groupBy("owner_upn", "owner_name").agg(*aggs)
            .orderBy(F.col("underused_pages").desc(), "owner_upn", "owner_name"))


def resolve_known_users(uv: DataFrame, people: DataFrame) -> DataFrame:
    """Hash known UPNs and join to user facts (for a governed model only)."""
    known = (people.select(hash_user("upn").alias("user_id_hash"), "display_name").filter(F.col("user_id_hash") != "")
             .groupBy("user_id_hash").agg(F.max("display_name").alias("display_name")))   # spellings of one UPN
    views = uv.groupBy("user_id_hash").agg(F.sum("view_count").alias("views"))
    return views.join(known, "user_id_hash")


def persona_enrichment(events: DataFrame, people: DataFrame) -> DataFrame:
    """Top persona per page-day from a people/department lookup:
    events -> department of the user, then the department with most views
    (ties -> larger name)."""
    ppl = people.groupBy(norm_user("upn").alias("_u")).agg(F.max("department").alias("persona"))  # one row a user
    ev = events.select(*sch.PAGE_KEY, "view_date", "views", norm_user("user_upn").alias("_u"))
    j = ev.join(ppl, "_u", "left").withColumn("persona", F.coalesce("persona", F.lit("")))
    per = j.groupBy(*sch.PAGE_KEY, "view_date", "persona").agg(F.sum("views").alias("_v"))
    return per.groupBy(*sch.PAGE_KEY, "view_date").agg(
        F.max_by("persona", F.struct("_v", "persona")).alias("top_persona"))


def workspace_owner_rls(df: DataFrame, owners: DataFrame, upn: str) -> DataFrame:
    """rows of the workspaces owned by ``upn`` (left semi join)."""
    mine = owners.filter(F.lower("owner_upn") == F.lit(upn.strip().lower())).select("workspace_id")
    return df.join(mine, "workspace_id", "left_semi")


def business_unit_rls(df: DataFrame, units: DataFrame, members: DataFrame, upn: str | None = None) -> DataFrame:
    """F10 by business unit: rows of the workspaces whose unit has the caller among
    its members.  Without ``upn`` the caller is the session's user, resolved
    when the query runs, so a view made of the result filters for its reader.
    Several units, or several ways into one, give a row once (left semi joins)."""
    caller = F.lower(F.current_user()) if upn is None else F.lit(upn.strip().lower())
    mine = members.filter(F.lower(F.trim("member_upn")) == caller).select("business_unit")
    return df.join(units.join(mine, "business_unit", "left_semi").select("workspace_id"), "workspace_id", "left_semi")


def secured_view(df: DataFrame, units: DataFrame, members: DataFrame, name: str) -> None:
    """A temporary view in which every reader sees the rows of their own business units."""
    business_unit_rls(df, units, members).createOrReplaceTempView(name)


def strip_identifying_names(df: DataFrame, cols=("workspace_name", "report_name")) -> DataFrame:
    """drop name columns that may carry personal identifiers before sharing."""
    return df.drop(*[c for c in cols if c in df.columns])


