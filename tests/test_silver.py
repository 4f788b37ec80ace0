"""Silver builders and the T-rulings on hand-made DataFrames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from leafstat import schemas as sch
from leafstat.functions.dates import as_of_date, window_bounds
from leafstat.operators import silver as sv

D = dt.date
AS_OF = D(2024, 3, 31)


def events(spark, rows):
    return spark.createDataFrame(rows, sch.RAW_PAGE_EVENTS)


def catalog(spark, rows):
    return spark.createDataFrame(rows, sch.PAGE_CATALOG)


def rdim(spark):
    return spark.createDataFrame([("w1", "WS", "Cap", "r1", "Rep", 3), ("w1", "WS", "Cap", "r2", "Rep2", 1)],
                                 "workspace_id string, workspace_name string, capacity_name string, "
                                 "report_id string, report_name string, report_total_pages int")


def test_page_views_daily_aggregates(spark):
    ev = events(spark, [
        ("w1", "r1", "p1", AS_OF, "Ann@x.com", 3, 10.0, "Sales", "v1"),
        ("w1", "r1", "p1", AS_OF, " ann@x.com", 2, 20.0, "Sales", "v2"),   # same user, other spelling
        ("w1", "r1", "p1", AS_OF, "bob@x.com", 5, 30.0, "Ops", "v3"),
        ("w1", "r1", "p2", AS_OF, "bob@x.com", 4, 40.0, "B", "v3"),
        ("w1", "r1", "p2", AS_OF, "cy@x.com", 4, 40.0, "A", "v4"),        # tie on views -> larger name
    ])
    cat = catalog(spark, [("w1", "WS", "r1", "Rep", "p1", "Home", 1, None), ("w1", "WS", "r1", "Rep", "p2", "Two", 2, None)])
    pv = sv.page_views_daily(ev, cat, rdim(spark)).orderBy("page_id").collect()
    assert pv[0]["view_count"] == 10 and pv[0]["unique_users"] == 2
    assert pv[0]["avg_dwell_seconds"] == 20.0
    assert pv[0]["top_persona"] == "Sales"  # Sales 3+2 = Ops 5 -> tie -> larger name
    assert pv[1]["top_persona"] == "B"
    assert pv[0]["page_ordinal"] == 1 and pv[0]["report_total_pages"] == 3 and pv[0]["capacity_name"] == "Cap"


def test_user_views_merge_spellings_and_count_page_ids(spark):
    ev = events(spark, [
        ("w1", "r1", "p1", AS_OF, "Ann@x.com", 1, 1.0, "S", "v1"),
        ("w1", "r1", "p2", AS_OF, "ann@x.com ", 1, 1.0, "S", "v1"),
        ("w1", "r1", "p2", AS_OF, "ann@x.com", 1, 1.0, "S", "v1"),
        ("w1", "r1", "p3", AS_OF, None, 1, 1.0, "S", "v9"),
    ])
    uv = sv.user_views_daily(ev, rdim(spark)).orderBy("user_id_hash").collect()
    assert len(uv) == 2
    assert uv[0]["user_id_hash"] == "" and uv[0]["view_count"] == 1
    assert uv[1]["view_count"] == 3 and uv[1]["distinct_pages_viewed"] == 2
    assert sv.grain_duplicates(sv.user_views_daily(ev, rdim(spark)), sch.KEYS["user_views"]).count() == 0


def test_report_views_rollup_zero_views(spark):
    pv = spark.createDataFrame([
        ("w1", "WS", "C", "r1", "R", 2, "p1", "P1", 1, AS_OF, 0, 3, 12.0, ""),
        ("w1", "WS", "C", "r1", "R", 2, "p2", "P2", 2, AS_OF, 0, 5, 8.0, ""),
        ("w1", "WS", "C", "r2", "R", 2, "p1", "P1", 1, AS_OF, 2, 1, 10.0, ""),
        ("w1", "WS", "C", "r2", "R", 2, "p2", "P2", 2, AS_OF, 6, 4, 30.0, ""),
    ], sch.PAGE_VIEWS)
    r = {x["report_id"]: x for x in sv.report_views_rollup(pv).collect()}
    assert r["r1"]["avg_session_seconds"] == 0.0 and r["r1"]["unique_users"] == 5
    assert r["r2"]["view_count"] == 8 and r["r2"]["avg_session_seconds"] == pytest.approx((20 + 180) / 8)


def test_unused_pages_window_and_catalog_cases(spark):
    lo, hi = window_bounds(AS_OF, 90)
    assert lo == AS_OF - dt.timedelta(days=89)
    cat = catalog(spark, [
        ("w1", "WS", "r1", "Rep", "p1", "Home", 1, dt.datetime(2024, 1, 1)),
        ("w1", "WS", "r1", "Rep", "p1", "Home (new)", 1, dt.datetime(2024, 2, 1)),   # duplicate key
        ("w1", "WS", "r1", "Rep", "p2", "Old", 2, dt.datetime(2024, 2, 1)),          # viewed only before lo
        ("w1", "WS", "r1", "Rep", "p3", "Edge", 3, dt.datetime(2024, 2, 1)),         # viewed on lo exactly
        ("w1", "WS", "r3", "Quiet", "q1", "Q", 1, dt.datetime(2024, 2, 1)),          # report with no views
    ])
    pv = spark.createDataFrame([
        ("w1", "WS", "C", "r1", "Rep", 3, "p1", "Home", 1, hi, 1, 1, 1.0, ""),
        ("w1", "WS", "C", "r1", "Rep", 3, "p2", "Old", 2, lo - dt.timedelta(days=1), 1, 1, 1.0, ""),
        ("w1", "WS", "C", "r1", "Rep", 3, "p3", "Edge", 3, lo, 1, 1, 1.0, ""),
        ("w1", "WS", "C", "r9", "NoCat", 1, "z", "Z", 1, hi, 1, 1, 1.0, ""),          # report without catalog
    ], sch.PAGE_VIEWS)
    un = sv.unused_pages(cat, pv, lo, hi).collect()
    assert [(r["report_id"], r["page_id"]) for r in un] == [("r3", "q1"), ("r1", "p2")] or \
        sorted((r["report_id"], r["page_id"]) for r in un) == [("r1", "p2"), ("r3", "q1")]
    # the de-duplicated catalog keeps the latest pull
    d = {r["page_id"]: r["page_name"] for r in sv.dedup_catalog(cat).collect()}
    assert d["p1"] == "Home (new)"
    # U1 / J1 set equality
    from leafstat.operators.pages import viewed_keys_except
    ex = {tuple(r) for r in viewed_keys_except(cat, sv.window_filter(pv, lo, hi)).collect()}
    assert ex == {(r["workspace_id"], r["report_id"], r["page_id"]) for r in un}


def test_as_of_skips_malformed_and_defaults_today(spark):
    df = spark.createDataFrame([("2024-01-02",), ("garbage",), ("2024-03-04T10:00:00",)], "view_date string")
    assert as_of_date(df) == D(2024, 3, 4)
    empty = spark.createDataFrame([], "view_date date")
    assert as_of_date(empty) == dt.datetime.now(dt.timezone.utc).date()


def test_enrich_blank_identity(spark):
    rows = spark.createDataFrame([("", "", "", "r1", ""), ("w9", "Keep", "", "r1", "Keep R")],
                                 "workspace_id string, workspace_name string, capacity_name string, "
                                 "report_id string, report_name string")
    ws = spark.createDataFrame([("w1", "WS", "Cap")], sch.WORKSPACES)
    rep = spark.createDataFrame([("w1", "r1", "Rep", "PowerBIReport")], sch.REPORTS)
    out = sv.enrich_blank_identity(rows, ws, rep).orderBy("workspace_id").collect()
    assert tuple(out[0]) == ("w1", "WS", "Cap", "r1", "Rep")
    assert tuple(out[1]) == ("w9", "Keep", "", "r1", "Keep R")  # complete row untouched, blank capacity stays


def test_catalog_with_overlay(spark):
    seen = catalog(spark, [("w1", "WS", "r1", "R", "p1", "A", 1, None)])
    ov = catalog(spark, [("w1", "WS", "r1", "R", "p1", "dup", 1, None), ("w1", "WS", "r1", "R", "p9", "Z", 9, None)])
    out = sorted((r["page_id"], r["page_name"]) for r in sv.catalog_with_overlay(seen, ov).collect())
    assert out == [("p1", "A"), ("p9", "Z")]
    assert F is not None
