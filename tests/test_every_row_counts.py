"""Inputs that the star data lacks: rows must be neither lost nor counted twice."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from leafstat import schemas as sch
from leafstat.functions.prefix import running_total
from leafstat.functions.scalars import hash_user
from leafstat.operators import governance as gv
from leafstat.operators import pages as pg
from leafstat.operators import silver as sv
from leafstat.operators import users as us
from leafstat.sources import files as io

DAY = dt.date(2024, 3, 31)


def views(spark, rows):
    """(workspace, report, page, ordinal, views) of one day."""
    return spark.createDataFrame([(w, w, "C", r, "R", 3, p, p, o, DAY, v, 1, 1.0, "") for w, r, p, o, v in rows], sch.PAGE_VIEWS)


def test_last_bucket_is_open(spark):
    pv = views(spark, [("w", "r", "p", 1, 2 * 10 ** 9)])
    cat = spark.createDataFrame([], sch.PAGE_CATALOG)
    got = {r.bucket_order: r.pages for r in pg.views_distribution(pv, cat).collect()}
    assert got[6] == 1 and got[0] == 2


def test_null_groups_keep_their_rows(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "g string, o int")
    got = sorted((r.g or "", r.n) for r in running_total(df, ["g"], ["o"], None, "n").collect())
    assert got == [("", 1), ("", 2), ("a", 1)]


def test_erasure_spares_rows_without_a_hash(spark):
    h = spark.range(1).select(hash_user(F.lit("a@x"))).first()[0]
    uv = spark.createDataFrame([("w", "W", "r", "R", x, DAY, 1, 1) for x in (h, None, "")], sch.USER_VIEWS)
    assert gv.forget_user(uv, "a@x").count() == 2
    with pytest.raises(ValueError):
        gv.forget_user(uv, "  ")


def test_bronze_run_without_rows_empties_its_day(spark, tmpdir_path):
    pv = views(spark, [("w", "r", "p", 1, 5)])
    io.write_bronze(pv, tmpdir_path, "page_views", DAY - dt.timedelta(days=1))
    io.write_bronze(pv, tmpdir_path, "page_views", DAY)
    io.write_bronze(pv.where("false"), tmpdir_path, "page_views", DAY)
    assert [r.dt for r in spark.read.parquet(f"{tmpdir_path}/page_views").collect()] == [DAY - dt.timedelta(days=1)]


def test_user_with_two_personas_counts_once(spark):
    ev = spark.createDataFrame([("w", "r", "p", DAY, "a@x", 1, 1.0, "A", "v"), ("w", "r", "p", DAY, "A@x ", 2, 1.0, "B", "v"),
                                ("w", "r", "p", DAY, "a@x", 4, None, None, "v")], sch.RAW_PAGE_EVENTS)
    cat = spark.createDataFrame([("w", "W", "r", "R", "p", "P", 1, None)], sch.PAGE_CATALOG)
    rdim = spark.createDataFrame([("w", "W", "C", "r", "R", 1)], "workspace_id string, workspace_name string, "
                                 "capacity_name string, report_id string, report_name string, report_total_pages int")
    r = sv.page_views_daily(ev, cat, rdim).first()
    assert (r.unique_users, r.view_count, r.top_persona) == (1, 7, "")


def test_spellings_of_one_person(spark):
    people = spark.createDataFrame([("a@x", "Ann", "D1"), (" A@X", "Anne", "D2")], "upn string, display_name string, department string")
    ev = spark.createDataFrame([("w", "r", "p", DAY, "a@x", 3, 1.0, None, "v")], sch.RAW_PAGE_EVENTS)
    assert [r.top_persona for r in us.persona_enrichment(ev, people).collect()] == ["D2"]
    h = spark.range(1).select(hash_user(F.lit("a@x"))).first()[0]
    uv = spark.createDataFrame([("w", "W", "r", "R", h, DAY, 3, 1)], sch.USER_VIEWS)
    assert [(r.views, r.display_name) for r in us.resolve_known_users(uv, people).collect()] == [(3, "Anne")]


def test_report_id_in_two_workspaces(spark):
    pv = views(spark, [("w1", "r", "p", 1, 5), ("w2", "r", "p", 1, 5)])
    cat = spark.createDataFrame([(w, w, "r", "R", "q", f"name of {w}", 2, None) for w in ("w1", "w2")], sch.PAGE_CATALOG)
    got = {(r.workspace_id, r.page_name) for r in pg.missing_page_ordinals(pv, cat).where("page_ordinal = 2").collect()}
    assert got == {("w1", "name of w1"), ("w2", "name of w2")}
    ws = spark.createDataFrame([("w1", "One", "C1"), ("w2", "Two", "C2")], sch.WORKSPACES)
    rep = spark.createDataFrame([("w1", "r", "R1", ""), ("w2", "r", "R2", "")], sch.REPORTS)
    bare = spark.createDataFrame([("w2", "", "", "r", ""), ("", "", "", "r", "")],
                                 "workspace_id string, workspace_name string, capacity_name string, report_id string, report_name string")
    got = sorted(tuple(r) for r in sv.enrich_blank_identity(bare, ws, rep).collect())
    assert got == [("w1", "One", "C1", "r", "R1"), ("w2", "Two", "C2", "r", "R2")]


def test_csv_by_header_with_offsets(spark, tmpdir_path):
    names = sch.PAGE_CATALOG.fieldNames()
    row = dict(zip(names, ["w", "W", "r", "R", "p", "P, \"x\"", "1", ""]))
    lines = [f"{io.PREAMBLE}{sch.SILVER_SCHEMA_VERSION}", ",".join([*names[::-1], "added"])]
    for at in ("2024-03-31T01:30:00+02:00", "2024-03-31T01:30:00Z", "2024-03-31T01:30:00", ""):
        row["catalog_pulled_at"] = at
        lines.append(",".join('"' + row[n].replace('"', '""') + '"' for n in names[::-1]) + ",new")
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(f"{tmpdir_path}/page_catalog")
    got = io.load_table(spark, "csv", tmpdir_path, "page_catalog").collect()
    assert [r.catalog_pulled_at for r in got] == [dt.datetime(2024, 3, 30, 23, 30), dt.datetime(2024, 3, 31, 1, 30),
                                                  dt.datetime(2024, 3, 31, 1, 30), None]
    assert {(r.workspace_id, r.page_name, r.page_ordinal) for r in got} == {("w", 'P, "x"', 1)}


def test_wrong_version_is_refused(spark, tmpdir_path):
    path = io.write_table(views(spark, [("w", "r", "p", 1, 5)]), tmpdir_path, "page_views")
    assert io.load_table(spark, "parquet", tmpdir_path, "page_views").count() == 1
    io.write_schema_version(spark, path, "9.9.9")
    with pytest.raises(io.SchemaVersionError):
        io.load_table(spark, "parquet", tmpdir_path, "page_views")
