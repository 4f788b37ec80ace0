"""Run operations: enumeration filters, run summaries and alerts
(SURVEY F3-F5, J10, J11, J13, K5, K6, W11, W13-W15).

The run logs (one row per run / per day) are small by construction - their
size grows with the calendar, not with the data - so ordered windows over
the whole log are fine here; no window in this module runs over facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafstat import schemas as sch
from leafstat.functions.scalars import safe_div

# Enumeration filters.
ACTIVE_TYPE, ACTIVE_STATE = "Workspace", "Active"
STANDARD_REPORT_TYPE = "PowerBIReport"
USAGE_DATASET_PREFIX = "Usage Metrics Report"


def active_workspaces(ws: DataFrame) -> DataFrame:
    """type = Workspace and state = Active."""
    return ws.filter((F.col("type") == ACTIVE_TYPE) & (F.col("state") == ACTIVE_STATE))


def standard_reports(reports: DataFrame) -> DataFrame:
    """standard reports only (drops paginated reports etc.)."""
    return reports.filter(F.col("report_type") == STANDARD_REPORT_TYPE)


def usage_dataset_per_workspace(datasets: DataFrame, prefix: str = USAGE_DATASET_PREFIX) -> DataFrame:
    """per workspace, the first dataset (by listing position) whose name starts with the prefix."""
    m = datasets.filter(F.col("dataset_name").startswith(prefix))
    return m.groupBy("workspace_id").agg(
        F.min_by(F.struct("dataset_id", "dataset_name"), F.struct("position", "dataset_id")).alias("_d"),
    ).select("workspace_id", "_d.dataset_id", "_d.dataset_name")


def not_bootstrapped_workspaces(workspaces: DataFrame, reports: DataFrame, datasets: DataFrame,
                                prefix: str = USAGE_DATASET_PREFIX) -> DataFrame:
    """Workspaces that have reports but no usage dataset (names de-duplicated),
    with the number of reports skipped for that reason."""
    have = usage_dataset_per_workspace(datasets, prefix).select("workspace_id")
    rep = reports.groupBy("workspace_id").agg(F.count(F.lit(1)).alias("reports_skipped"))
    miss = workspaces.join(have, "workspace_id", "left_anti").join(rep, "workspace_id")
    return miss.groupBy("workspace_name").agg(F.sum("reports_skipped").alias("reports_skipped"))


def workspace_capacity(workspaces: DataFrame, capacities: DataFrame | None = None) -> DataFrame:
    """Workspace -> capacity name, '' when none."""
    if capacities is None:
        return workspaces.select("workspace_id", "workspace_name",
                                 F.coalesce("capacity_name", F.lit("")).alias("capacity_name"))
    return (workspaces.select("workspace_id", "workspace_name").join(capacities, "workspace_id", "left")
            .select("workspace_id", "workspace_name", F.coalesce("capacity_name", F.lit("")).alias("capacity_name")))


def bronze_snapshot_diff(day_a: DataFrame, day_b: DataFrame) -> DataFrame:
    """Reports in one day's snapshot and not the other; a workspace whose
    id stayed but whose name changed is 'renamed', not missing."""
    a = day_a.select(*sch.REPORT_KEY, F.col("workspace_name").alias("name_before")).distinct()
    b = day_b.select(*sch.REPORT_KEY, F.col("workspace_name").alias("name_after")).distinct()
    j = a.join(b, sch.REPORT_KEY, "full")
    status = (F.when(F.col("name_after").isNull(), "missing")
              .when(F.col("name_before").isNull(), "new")
              .when(F.col("name_before") != F.col("name_after"), "renamed")
              .otherwise("same"))
    return j.withColumn("status", status)


def _median_of(arr: Column) -> Column:
    s = F.array_sort(arr)
    n = F.size(s)
    mid = F.element_at(s, (F.floor(n / 2) + 1).cast("int")).cast("double")
    lower = F.element_at(s, F.floor(n / 2).cast("int")).cast("double")
    return F.when(n == 0, F.lit(None).cast("double")).when(n % 2 == 1, mid).otherwise((lower + mid) / 2)


def drop_alert(runs: DataFrame, value: str, order: str = "run_date", lookback: int = 28,
               ratio: float = 0.5) -> DataFrame:
    """Value vs the median of the previous ``lookback`` runs; ratio and
    flag for every run (flag when value < ratio x median)."""
    w = Window.orderBy(order).rowsBetween(-lookback, -1)
    med = _median_of(F.collect_list(F.col(value)).over(w))
    out = runs.withColumn("median_prev", med)
    return out.select(order, value, "median_prev",
                      safe_div(value, "median_prev").alias("ratio"),
                      F.coalesce(F.col(value) < F.col("median_prev") * ratio, F.lit(False)).alias("flag"))


def rows_drop_alert(runs_volume: DataFrame) -> DataFrame:
    """Run rows below half the median of the previous 28 runs."""
    return drop_alert(runs_volume, "rows")


def dau_drop_alert(user_views: DataFrame) -> DataFrame:
    """Daily active users (distinct hashes per day) against W11's rule."""
    dau = user_views.groupBy(F.col("view_date").alias("run_date")).agg(
        F.count_distinct("user_id_hash").alias("dau"))
    return drop_alert(dau, "dau")


def run_severity(runs: DataFrame, fail_pct: int = 22, sev2_pct: int = 25, sev2_streak: int = 2,
                 sev1_streak: int = 4, stale_hours: int = 36) -> DataFrame:
    """SEV-3 one failure; SEV-2 two consecutive failures or errors > 25 %
    of reports; SEV-1 >= 4 consecutive failures or data older than 36 h.

    Gaps and islands: the running count of good runs numbers the islands;
    consecutive failures = failures so far inside the island.  Staleness =
    hours since the last good run ended.
    """
    failed = F.col("errors") * 100 > F.col("reports") * fail_pct
    r = runs.withColumn("failed", failed)
    upto = Window.orderBy("run_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    r = r.withColumn("_island", F.sum(F.when(F.col("failed"), 0).otherwise(1)).over(upto))
    isl = Window.partitionBy("_island").orderBy("run_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    r = r.withColumn("consecutive_failures", F.sum(F.col("failed").cast("int")).over(isl))
    r = r.withColumn("_last_ok", F.max(F.when(~F.col("failed"), F.col("ended_at"))).over(upto))
    micros = (lambda c: F.unix_micros(F.col(c).cast("timestamp")))
    hours = (micros("ended_at") - micros("_last_ok")) / F.lit(3.6e9)
    r = r.withColumn("hours_since_ok", hours)
    stale = F.coalesce(F.col("hours_since_ok") > stale_hours, F.lit(False))
    sev = (F.when((F.col("consecutive_failures") >= sev1_streak) | stale, "SEV-1")
           .when((F.col("consecutive_failures") >= sev2_streak)
                 | (F.col("errors") * 100 > F.col("reports") * sev2_pct), "SEV-2")
           .when(F.col("failed"), "SEV-3").otherwise(""))
    return r.select("run_date", "reports", "errors", "failed", "consecutive_failures",
                    "hours_since_ok", sev.alias("severity"))


def run_scope_drop(runs: DataFrame, cols: tuple[str, ...] = ("reports", "workspaces")) -> DataFrame:
    """A run whose scope (reports or workspaces, as far as the log has them) is
    smaller than the previous run's."""
    cols = tuple(c for c in cols if c in runs.columns)
    w = Window.orderBy("run_date")
    prev = {c: F.lag(c).over(w) for c in cols}
    smaller = F.lit(False)
    for c in cols:
        smaller = smaller | F.coalesce(F.col(c) < prev[c], F.lit(False))
    return runs.select("run_date", *cols, *[p.alias(f"prev_{c}") for c, p in prev.items()], smaller.alias("scope_dropped"))


#: What a run's row says of its results, without its times and places.
SUMMARY = [c for c in sch.RUNS.fieldNames() if c not in ("run_id", "run_date", "started_at", "ended_at", "silver_path", "bronze_path")]


def run_summary(runs: DataFrame) -> DataFrame:
    """K5: the summary records of collection runs (``plans.collect`` appends them)."""
    return runs.select(*SUMMARY)


def run_metrics_json(summary: DataFrame, metric: str = "leafstat.run") -> DataFrame:
    """K6: the summary as one JSON line (ok = no errors)."""
    return summary.select(F.to_json(F.struct(
        F.lit(metric).alias("metric"), "schema_version", "workspaces", "reports", "datasets", "rows",
        F.col("n_errors").alias("errors"), "ok")).alias("line"))


def run_metrics_gauges(summary: DataFrame, prefix: str = "leafstat_run") -> DataFrame:
    """K6: six gauge lines labelled with the schema version."""
    g = summary.select("schema_version", F.expr(
        "stack(6, 'workspaces', workspaces, 'reports', reports, 'datasets', datasets, 'rows', rows, "
        "'errors', n_errors, 'ok', CAST(ok AS BIGINT)) AS (gauge, value)"))
    return g.select(F.format_string(f"{prefix}_%s{{schema_version=\"%s\"}} %d",
                                    "gauge", "schema_version", "value").alias("line"))
