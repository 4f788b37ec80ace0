"""Distributed running totals, trends and alerts on hand-made data."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from leafstat import schemas as sch
from leafstat.functions.prefix import ordinal, running_totals
from leafstat.operators import ops, trends as tr

D = dt.date


def test_running_total_matches_window_on_skewed_groups(spark):
    # one hot group with most rows, several small ones, split over 7 partitions
    rows = [("hot", i, i % 13) for i in range(3000)] + [(f"g{k}", i, 1) for k in range(20) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, o int, v int")
    got = running_totals(df, ["g"], ["o"], {"rn": None, "rs": "v"}, {"tot": "rs"}, num_partitions=7)
    w = Window.partitionBy("g").orderBy("o")
    exp = df.select("g", "o", F.row_number().over(w).alias("rn"), F.sum("v").over(w).alias("rs"),
                    F.sum("v").over(Window.partitionBy("g")).alias("tot"))
    a = sorted(tuple(r) for r in got.select("g", "o", "rn", "rs", "tot").collect())
    b = sorted(tuple(r) for r in exp.collect())
    assert a == b


def test_ordinal_descending_order(spark):
    df = spark.createDataFrame([("a", 5), ("a", 9), ("a", 1), ("b", 2)], "g string, x int")
    got = {(r["g"], r["x"]): r["rk"] for r in ordinal(df, ["g"], [F.col("x").desc()], "rk", num_partitions=3).collect()}
    assert got == {("a", 9): 1, ("a", 5): 2, ("a", 1): 3, ("b", 2): 1}


def _pv(spark, rows):
    full = [("w", "W", "C", r, "R " + r, 2, p, "P" + p, o, d, v, 1, 10.0, "") for (r, p, o, d, v) in rows]
    return spark.createDataFrame(full, sch.PAGE_VIEWS)


def test_half_life_dense_calendar_and_tie(spark):
    d0 = D(2024, 1, 1)
    # two equal 7-day peaks; earliest wins; gap days count as zero
    rows = [("r1", "p", 1, d0, 10), ("r1", "p", 1, d0 + dt.timedelta(days=20), 10)]
    out = tr.report_half_life(_pv(spark, rows), d0 + dt.timedelta(days=40)).collect()
    assert len(out) == 1
    r = out[0]
    assert r["peak_date"] == d0 and r["peak_rolling_7d"] == 10
    assert r["half_date"] == d0 + dt.timedelta(days=7) and r["half_life_days"] == 7


def test_half_life_never_below_half_is_omitted(spark):
    d0 = D(2024, 1, 1)
    rows = [("r1", "p", 1, d0 + dt.timedelta(days=i), 5) for i in range(10)]
    assert tr.report_half_life(_pv(spark, rows), d0 + dt.timedelta(days=9)).count() == 0


def test_wow_zero_previous_week_is_null(spark):
    a = D(2024, 1, 31)
    out = tr.wow_change(_pv(spark, [("r", "p", 1, a, 4)]), a).first()
    assert out["views_last_7d"] == 4 and out["views_prev_7d"] == 0 and out["wow_change"] is None
    t = tr.trailing_views(_pv(spark, [("r", "p", 1, a - dt.timedelta(days=6), 1),
                                      ("r", "p", 1, a - dt.timedelta(days=7), 2),
                                      ("r", "p", 1, a - dt.timedelta(days=29), 4),
                                      ("r", "p", 1, a - dt.timedelta(days=30), 8)]), a).first()
    assert (t["views_last_7d"], t["views_last_30d"]) == (1, 7)


def test_capacity_long_tail(spark):
    d = D(2024, 1, 1)
    rows = [("r1", "p", 1, d, 50), ("r2", "p", 1, d, 30), ("r3", "p", 1, d, 20)]
    out = tr.capacity_long_tail(_pv(spark, rows)).first()
    assert out["reports_for_80pct"] == 2


def test_drop_alert_exact_half_is_not_flagged(spark):
    runs = spark.createDataFrame([(D(2024, 1, i + 1), v) for i, v in enumerate([10, 10, 10, 5, 4])],
                                 "run_date date, rows bigint")
    out = {r["run_date"].day: r for r in ops.rows_drop_alert(runs).collect()}
    assert out[1]["median_prev"] is None and out[1]["flag"] is False
    assert out[4]["median_prev"] == 10.0 and out[4]["flag"] is False   # exactly 50 %
    assert out[5]["median_prev"] == 10.0 and out[5]["flag"] is True     # median of 10,10,10,5 = 10


def test_run_severity_streaks_and_staleness(spark):
    base = dt.datetime(2024, 1, 1, 6, 0, 0)
    fails = [False, True, False, True, True, False, True, True, True, True, False]
    rows = []
    for i, f in enumerate(fails):
        rows.append((D(2024, 1, 1) + dt.timedelta(days=i), 100, 30 if f else 0, base + dt.timedelta(hours=12 * i)))
    runs = spark.createDataFrame(rows, "run_date date, reports bigint, errors bigint, ended_at timestamp")
    out = [r["severity"] for r in ops.run_severity(runs).orderBy("run_date").collect()]
    # errors 30 % > 25 % makes every failure at least SEV-2; 4 in a row -> SEV-1; 48 h since ok -> SEV-1
    assert out[0] == "" and out[1] == "SEV-2" and out[2] == ""
    assert out[3] == "SEV-2" and out[4] == "SEV-2"
    assert out[6] == "SEV-2" and out[7] == "SEV-2" and out[8] == "SEV-2" and out[9] == "SEV-1"
    one = spark.createDataFrame([(D(2024, 1, 1), 100, 23, base)], "run_date date, reports bigint, errors bigint, "
                                                                  "ended_at timestamp")
    assert ops.run_severity(one).first()["severity"] == "SEV-3"
    stale = spark.createDataFrame([(D(2024, 1, 1), 100, 0, base), (D(2024, 1, 2), 100, 23, base + dt.timedelta(hours=36)),
                                   (D(2024, 1, 3), 100, 23, base + dt.timedelta(hours=37))],
                                  "run_date date, reports bigint, errors bigint, ended_at timestamp")
    s = [r["severity"] for r in ops.run_severity(stale).orderBy("run_date").collect()]
    assert s == ["", "SEV-3", "SEV-1"]


def test_scope_drop_and_snapshot_diff(spark):
    runs = spark.createDataFrame([(D(2024, 1, 1), 5), (D(2024, 1, 2), 4), (D(2024, 1, 3), 4)], "run_date date, reports bigint")
    assert [r["scope_dropped"] for r in ops.run_scope_drop(runs).orderBy("run_date").collect()] == [False, True, False]
    a = spark.createDataFrame([("w1", "Old", "r1"), ("w1", "Old", "r2"), ("w2", "X", "r3")],
                              "workspace_id string, workspace_name string, report_id string")
    b = spark.createDataFrame([("w1", "New", "r1"), ("w2", "X", "r3"), ("w2", "X", "r4")],
                              "workspace_id string, workspace_name string, report_id string")
    st = {r["report_id"]: r["status"] for r in ops.bronze_snapshot_diff(a, b).collect()}
    assert st == {"r1": "renamed", "r2": "missing", "r3": "same", "r4": "new"}


def test_enumeration_filters(spark):
    ds = spark.createDataFrame([("w1", "d2", "Usage Metrics Report v2", 2), ("w1", "d1", "Usage Metrics Report", 1),
                                ("w2", "d3", "Sales", 1)], "workspace_id string, dataset_id string, "
                                                             "dataset_name string, position int")
    got = {r["workspace_id"]: r["dataset_id"] for r in ops.usage_dataset_per_workspace(ds).collect()}
    assert got == {"w1": "d1"}
    ws = spark.createDataFrame([("w1", "A", ""), ("w2", "B", ""), ("w3", "B", "")], sch.WORKSPACES)
    rep = spark.createDataFrame([("w2", "r1", "x", "PowerBIReport"), ("w2", "r2", "y", "PaginatedReport"),
                                 ("w3", "r3", "z", "PowerBIReport")], sch.REPORTS)
    nb = {r["workspace_name"]: r["reports_skipped"] for r in ops.not_bootstrapped_workspaces(ws, rep, ds).collect()}
    assert nb == {"B": 3}   # w1 has a dataset, w2+w3 share a name, w-without-reports absent
    assert ops.standard_reports(rep).count() == 2
