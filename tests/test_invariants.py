"""Invariants of the reference's test strategy on real silver (sf0.001):
identical rebuilds, J1 as a set difference, the A4 roll-up rule, grain and
hash guards, O2 ordering, and the governance deletes (G2, G3)."""

import datetime as dt
import os

from pyspark.sql import functions as F

from leafstat import schemas as sch
from leafstat.functions.scalars import hash_user
from leafstat.operators import governance as gv
from leafstat.operators import pages as pg
from leafstat.operators import silver as sv
from leafstat.plans.lakehouse import Lakehouse
from leafstat.sources import files as io

SF001 = "/root/testdata/sf0.001"
D = dt.date


def _same_rows(a, b):
    return a.count() == b.count() and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_silver_rebuild_is_identical(spark):
    a, b = Lakehouse.from_star(spark, SF001), Lakehouse.from_star(spark, SF001)
    for name in sch.SILVER:
        assert _same_rows(getattr(a, name), getattr(b, name)), name


def test_unused_is_catalog_minus_window_views(spark):
    lh = Lakehouse.from_star(spark, SF001)
    lo, hi = lh.window(90)
    seen = sv.window_filter(lh.page_views, lo, hi).select(*sch.PAGE_KEY).distinct()
    expect = lh.page_catalog.select(*sch.PAGE_KEY).distinct().exceptAll(seen)
    got = lh.unused_pages.select(*sch.PAGE_KEY)
    assert _same_rows(got, expect)
    assert got.join(seen, sch.PAGE_KEY, "left_semi").isEmpty()


def test_rollup_never_below_busiest_page_and_guards(spark):
    lh = Lakehouse.from_star(spark, SF001)
    assert gv.rollup_consistency(sv.report_views_rollup(lh.page_views), lh.page_views).isEmpty()
    assert all(r["duplicate_keys"] == 0 for r in gv.grain_check(lh.silver()).collect())
    g = gv.pii_guard(lh.user_views).first()
    assert g["violations"] == 0 and g["rows_checked"] == lh.user_views.count()


def test_pii_guard_flags_raw_upns(spark):
    rows = [("w", "W", "r", "R", h, D(2024, 1, 1), 1, 1)
            for h in ("0123456789abcdef", "", "ann@example.com", "0123456789ABCDEF", "0123")]
    g = gv.pii_guard(spark.createDataFrame(rows, sch.USER_VIEWS)).first()
    assert (g["violations"], g["rows_checked"]) == (3, 5)


def test_unused_sample_is_first_ten_in_display_order(spark):
    lh = Lakehouse.from_star(spark, SF001)
    all_rows = lh.unused_pages.collect()
    sample = pg.unused_sample(lh.unused_pages).collect()
    order = sorted(all_rows, key=lambda r: (r["workspace_name"], r["report_name"], r["page_ordinal"],
                                            r["workspace_id"], r["report_id"], r["page_id"]))
    assert [r["page_id"] for r in sample] == [r["page_id"] for r in order[:10]]


def test_retain_silver_keeps_91_days(spark):
    rows = [("w", "W", "C", "r", "R", 1, "p", "P", 1, D(2024, 6, 30) - dt.timedelta(days=i), 1, 1, 1.0, "")
            for i in range(120)]
    pv = spark.createDataFrame(rows, sch.PAGE_VIEWS)
    kept = gv.retain_silver(pv, D(2024, 6, 30), 90)
    assert kept.count() == 91
    assert kept.agg(F.min("view_date")).first()[0] == D(2024, 6, 30) - dt.timedelta(days=90)


def test_forget_user_in_table_rewrites_only_touched_days(spark, tmpdir_path):
    ann, bob = "Ann@Example.com", "bob@example.com"
    h = {u: spark.range(1).select(hash_user(F.lit(u))).first()[0] for u in (ann, bob)}
    rows = [("w", "W", "r", "R", h[ann], D(2024, 1, 1), 3, 1),      # Ann alone on day 1
            ("w", "W", "r", "R", h[ann], D(2024, 1, 2), 1, 1),
            ("w", "W", "r", "R", h[bob], D(2024, 1, 2), 2, 1),
            ("w", "W", "r", "R", h[bob], D(2024, 1, 3), 5, 2)]
    io.write_table(spark.createDataFrame(rows, sch.USER_VIEWS), tmpdir_path, "user_views")
    day3 = os.path.join(tmpdir_path, "user_views", "view_date=2024-01-03")
    before = sorted(os.listdir(day3))
    assert gv.forget_user_in_table(spark, tmpdir_path, "  ann@example.com ") == 2
    back = io.read_table(spark, tmpdir_path, "user_views").orderBy("view_date").collect()
    assert [(r["user_id_hash"], r["view_date"]) for r in back] == [(h[bob], D(2024, 1, 2)),
                                                                    (h[bob], D(2024, 1, 3))]
    assert not os.path.exists(os.path.join(tmpdir_path, "user_views", "view_date=2024-01-01"))
    assert sorted(os.listdir(day3)) == before                     # untouched day not rewritten
    assert gv.forget_user_in_table(spark, tmpdir_path, ann) == 0  # idempotent


def test_shuffle_sizing_only_raises(spark):
    from leafstat.session import size_shuffles
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        assert size_shuffles(spark, 10 << 20) == base and spark.conf.get(key, None) is None
        assert size_shuffles(spark, 1 << 40) == 8192 and spark.conf.get(key) == "8192"
        assert size_shuffles(spark, 100 << 40) == 819_200
    finally:
        spark.conf.unset(key)


def test_raw_fact_scans_read_only_needed_columns(spark):
    lh = Lakehouse.from_star(spark, SF001)
    plan = lh.page_views._jdf.queryExecution().executedPlan().toString()
    scans = [ln for ln in plan.split("\n") if "FileScan parquet" in ln]
    li = [s for s in scans if "lineitem.parquet" in s]
    assert li, plan
    for s in li:
        schema = s[s.index("ReadSchema: struct<") + len("ReadSchema: struct<"):].split(">")[0]
        cols = {c.split(":")[0] for c in schema.split(",")}
        assert cols <= {"l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate"}, cols


def test_shared_totals_give_the_same_sections(spark):
    from leafstat.operators.common import page_totals
    from leafstat.operators import reports as rp
    lh = Lakehouse.from_star(spark, SF001)
    pv, cat = lh.page_views, lh.page_catalog
    t, m = page_totals(pv), pg.missing_page_ordinals(pv, cat)
    assert _same_rows(pg.page_detail(pv, cat), pg.page_detail(pv, cat, totals=t, missing=m))
    assert _same_rows(pg.views_distribution(pv, cat), pg.views_distribution(pv, cat, totals=t, missing=m))
    assert _same_rows(pg.top_pages(pv), pg.top_pages(pv, totals=t))
    assert _same_rows(pg.missing_page_ordinals(pv, cat), pg.missing_page_ordinals(pv, cat, totals=t))
    assert _same_rows(pg.report_summary(pv), pg.report_summary(pv, totals=t))
    assert _same_rows(pg.workspace_summary(pv), pg.workspace_summary(pv, totals=t))
    assert _same_rows(pg.underused_dashboard(pv), pg.underused_dashboard(pv, totals=t))
    assert _same_rows(rp.dashboard_meta(pv, cat), rp.dashboard_meta(pv, cat, totals=t, missing=m))
