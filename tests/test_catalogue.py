"""Every registered query against its DuckDB oracle on sf0.001 (the driver's
check at a smaller scale), plus the flagship entry and page-level rulings."""

import datetime as dt
import os

import duckdb
import pytest

import __spark_entry__ as E
from leafstat import schemas as sch
from tools.check_oracle import TABLES, rows_of
from tests.conftest import SF001


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.columns == sch.UNUSED_PAGES.fieldNames()
    rows = df.collect()
    assert len(rows) == 65                                   # FIXTURES: 65 unused pages at sf0.001
    assert len({(r["workspace_id"], r["report_id"]) for r in rows}) == 24
    key = [(r["workspace_name"], r["report_name"], r["page_ordinal"]) for r in rows]
    assert key == sorted(key)


def test_every_catalogue_query_has_an_oracle():
    """Queries outside the catalogue may have none; they are tested with their operators."""
    from leafstat.plans.catalogue import spark_queries
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert set(spark_queries()) <= set(sql), set(spark_queries()) - set(sql)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    st = E.queries()[name](spark, SF001).toArrow()
    dt_ = duck.execute(E.oracle_sql()[name]).to_arrow_table()
    sc, sr = rows_of(st)
    dc, dr = rows_of(dt_)
    assert sc == dc
    assert {f.name: str(f.type) for f in st.schema} == {f.name: str(f.type) for f in dt_.schema}
    assert sr == dr


def test_fixture_numbers_sf0001(spark):
    q = E.queries()
    assert q["underused_pages_count"](spark, SF001).first()[0] == 23
    dist = {r["bucket"]: r["pages"] for r in q["views_distribution"](spark, SF001).collect()}
    assert (dist["1–10"], dist["11–50"], dist["51–200"], dist["201–1k"]) == (23, 79, 33, 0)
    assert q["power_users_count"](spark, SF001).first()[0] == 43
    assert q["power_users_per_report"](spark, SF001).count() == 11
    assert q["idle_alert"](spark, SF001).count() == 138
    hl = q["report_half_life"](spark, SF001).collect()
    assert len(hl) == 25 and min(r["half_life_days"] for r in hl) == 1 and max(r["half_life_days"] for r in hl) == 7
    ad = q["new_page_adoption"](spark, SF001).collect()
    assert len(ad) == 64 and sum(r["days_to_half_avg"] is not None for r in ad) == 55
    t = q["trailing_views"](spark, SF001).first()
    w = q["wow_change"](spark, SF001).first()
    assert t["views_last_7d"] == 473 and w["views_prev_7d"] == 534
    assert q["rows_drop_alert"](spark, SF001).filter("flag").count() == 244
    sev = q["run_severity"](spark, SF001).collect()
    assert sum(r["failed"] for r in sev) == 11
    assert q["page_views_daily"](spark, SF001).count() == 5967


def test_missing_ordinals_format(spark):
    pv = spark.createDataFrame([("w", "W", "C", "r", "R", 4, "x", "X", 2, dt.date(2024, 1, 1), 3, 1, 1.0, "")],
                               sch.PAGE_VIEWS)
    cat = spark.createDataFrame([("w", "W", "r", "R", "c3", "Third", 3, None)], sch.PAGE_CATALOG)
    from leafstat.operators.pages import missing_page_ordinals, views_distribution
    m = sorted((r["page_ordinal"], r["page_id"], r["page_name"]) for r in missing_page_ordinals(pv, cat).collect())
    assert m == [(1, "r::p000", "(page 1)"), (3, "r::p002", "Third"), (4, "r::p003", "(page 4)")]
    d = [r["pages"] for r in views_distribution(pv, cat).collect()]
    assert d == [3, 1, 0, 0, 0, 0, 0]


def test_bucket_edges(spark):
    from leafstat.operators.pages import views_distribution
    edges = [0, 1, 10, 11, 50, 51, 200, 201, 1000, 1001, 5000, 5001]
    rows = [("w", "W", "C", "r", "R", len(edges), f"p{i}", "P", i + 1, dt.date(2024, 1, 1), v, 1, 1.0, "")
            for i, v in enumerate(edges) if v > 0]
    pv = spark.createDataFrame(rows, sch.PAGE_VIEWS)
    cat = spark.createDataFrame([], sch.PAGE_CATALOG)
    d = [r["pages"] for r in views_distribution(pv, cat).collect()]
    assert d == [1, 2, 2, 2, 2, 2, 1]


def test_pages_per_session_counts_sessions_once(spark):
    from leafstat.operators.reports import pages_per_session
    d = dt.date(2024, 1, 1)
    pv = spark.createDataFrame([("w", "W", "C", "r", "R", 3, f"p{i}", "P", i, d, 2, 1, 1.0, "") for i in range(1, 4)],
                               sch.PAGE_VIEWS)
    rv = spark.createDataFrame([("w", "W", "C", "r", "R", d, 3, 2, 60.0)], sch.REPORT_VIEWS)
    r = pages_per_session(pv, rv).first()
    assert r["total_page_views"] == 6 and r["total_report_sessions"] == 3 and r["pages_per_session"] == 2.0
