"""Files, schema versions, payloads, upserts and the streaming sink."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from leafstat import schemas as sch
from leafstat.sources import files as io
from leafstat.sources import payload as pl
from leafstat.streaming.upsert import DuplicateKeyError, stream_landed_silver, upsert

D = dt.date


def _uv(spark, rows):
    return spark.createDataFrame(rows, sch.USER_VIEWS)


def test_csv_roundtrip_hazards(spark, tmpdir_path):
    rows = [("w1", 'Name, with "quotes"', "r1", "multi\nline", "0012345678901234", D(2024, 1, 1), 1, 1),
            ("w1", "", "r1", "R", "12345678901234e1", D(2024, 1, 2), 2, 1)]
    df = _uv(spark, rows)
    path = os.path.join(tmpdir_path, "user_views")
    io.write_silver_csv(df, path, sch.USER_VIEWS)
    assert io.csv_schema_versions(spark, path) == [sch.SILVER_SCHEMA_VERSION]
    back = io.read_silver_csv(spark, path, sch.USER_VIEWS).orderBy("view_date").collect()
    assert [tuple(r) for r in back] == [tuple(r) for r in df.orderBy("view_date").collect()]
    assert back[0]["user_id_hash"] == "0012345678901234" and back[1]["workspace_name"] == ""


def test_comment_only_file_and_versions(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "empty")
    os.makedirs(p)
    with open(os.path.join(p, "part-0.csv"), "w") as f:
        f.write("# silver_schema_version=1.2.0\n")
    df = io.read_silver_csv(spark, p, sch.PAGE_VIEWS)
    assert df.count() == 0 and df.columns == sch.PAGE_VIEWS.fieldNames()
    assert io.assert_schema_version(["1.2.0"]) == "1.2.0"
    with pytest.raises(io.SchemaVersionError):
        io.assert_schema_version(["1.1.0"])
    with pytest.raises(io.SchemaVersionError):
        io.assert_schema_version([])
    assert io.assert_schema_version(["1.3.0"], minor_ok=True) == "1.3.0"
    with pytest.raises(io.SchemaVersionError):
        io.assert_schema_version(["2.0.0"], minor_ok=True)


def test_load_table_modes(spark, tmpdir_path):
    df = _uv(spark, [("w", "W", "r", "R", "a" * 16, D(2024, 1, 1), 1, 1)])
    io.write_table(df, tmpdir_path, "user_views")
    assert io.load_table(spark, "parquet", tmpdir_path, "user_views").count() == 1
    assert io.table_schema_versions(spark, f"{tmpdir_path}/user_views") == [sch.SILVER_SCHEMA_VERSION]
    with pytest.raises(ValueError):
        io.load_table(spark, "ftp", tmpdir_path, "user_views")
    counts = {r["table_name"]: r["row_count"] for r in io.table_row_counts(spark, tmpdir_path).collect()}
    assert counts == {"user_views": 1}   # missing tables are skipped


def test_empty_table_keeps_schema(spark, tmpdir_path):
    empty = spark.createDataFrame([], sch.PAGE_VIEWS)
    io.write_table(empty, tmpdir_path, "page_views")
    back = io.read_table(spark, tmpdir_path, "page_views")
    assert back.count() == 0 and back.schema == sch.PAGE_VIEWS


def test_upsert_semantics(spark, tmpdir_path):
    base = _uv(spark, [("w", "W", "r", "R", "h1", D(2024, 1, 1), 5, 1),
                       ("w", "W", "r", "R", "h1", D(2024, 1, 2), 6, 1),
                       ("w", "W", "r", "R", "h2", D(2024, 1, 2), 7, 1)])
    io.write_table(base, tmpdir_path, "user_views")
    batch = _uv(spark, [("w", "W", "r", "R", "h1", D(2024, 1, 2), 60, 2),     # late correction
                        ("w", "W", "r", "R", "h3", D(2024, 1, 3), 1, 1)])    # new day
    assert upsert(batch, tmpdir_path, "user_views") == 2
    first = sorted(tuple(r) for r in io.read_table(spark, tmpdir_path, "user_views").collect())
    upsert(batch, tmpdir_path, "user_views")                                 # twice == once
    again = sorted(tuple(r) for r in io.read_table(spark, tmpdir_path, "user_views").collect())
    assert first == again
    got = {(r[4], r[5].day): r[6] for r in again}
    assert got == {("h1", 1): 5, ("h1", 2): 60, ("h2", 2): 7, ("h3", 3): 1}
    dup = _uv(spark, [("w", "W", "r", "R", "h1", D(2024, 1, 2), 1, 1), ("w", "W", "r", "R", "h1", D(2024, 1, 2), 2, 1)])
    with pytest.raises(DuplicateKeyError):
        upsert(dup, tmpdir_path, "user_views")


def test_streaming_foreach_batch_upsert(spark, tmpdir_path):
    landing, root, ck = (os.path.join(tmpdir_path, x) for x in ("landing", "silver", "ck"))
    _uv(spark, [("w", "W", "r", "R", "h1", D(2024, 1, 1), 1, 1)]).write.parquet(f"{landing}/run1")
    import time
    time.sleep(1.1)
    _uv(spark, [("w", "W", "r", "R", "h1", D(2024, 1, 1), 9, 1),
                ("w", "W", "r", "R", "h2", D(2024, 1, 2), 2, 1)]).write.parquet(f"{landing}/run2")
    q = stream_landed_silver(spark, f"{landing}/*", root, "user_views", ck)
    q.awaitTermination(120)
    got = {(r["user_id_hash"], r["view_date"].day): r["view_count"]
           for r in io.read_table(spark, root, "user_views").collect()}
    assert got == {("h1", 1): 9, ("h2", 2): 2}


def test_bronze_day_replace_and_retention(spark, tmpdir_path):
    from leafstat.operators.governance import retain_bronze
    df = spark.createDataFrame([("w", "r", 1)], "workspace_id string, report_id string, x int")
    for d in (D(2024, 1, 1), D(2024, 3, 1), D(2024, 3, 1)):
        io.write_bronze(df, tmpdir_path, "feed", d)
    back = spark.read.parquet(f"{tmpdir_path}/feed")
    assert back.count() == 2
    dropped = retain_bronze(spark, f"{tmpdir_path}/feed", D(2024, 4, 5), 90)
    assert len(dropped) == 1 and dropped[0].endswith("dt=2024-01-01")
    assert spark.read.parquet(f"{tmpdir_path}/feed").count() == 1


def test_payload_flatten_edge_cases(spark):
    docs = spark.createDataFrame([
        ('{"results":[{"tables":[{"rows":[{"\'Report page views\'[Report Id]":"r1","[Report page name]":"Home",'
         '"[Date]":"2024-01-05T00:00:00","[Views]":3,"[UniqueUsers]":null,"[AvgDwellSeconds]":1.5}]}]}]}',),
        ('{"results":[{"tables":[{"rows":[{"[Report Id]":"r2"}]}]}]}',),
        ('{"results":[{"tables":[{"rows":[]}]}]}',),
        ("not json",),
    ], "value string")
    rows = sorted(tuple(r) for r in pl.flatten_page_payload(docs).collect())
    assert rows[0] == ("r1", "Home", "Home", D(2024, 1, 5), 3, 0, 1.5)
    assert rows[1][0] == "r2" and rows[1][3] is None and rows[1][4] == 0 and rows[1][6] == 0.0
    assert len(rows) == 2


def test_roster_and_overlay(spark):
    docs = spark.createDataFrame([("w", "W", "r", "R",
                                   '{"value":[{"name":"s1","displayName":"Home","order":0},'
                                   '{"name":"s2","displayName":null}]}')],
                                 "workspace_id string, workspace_name string, report_id string, "
                                 "report_name string, value string")
    cat = pl.catalog_from_roster(docs, dt.datetime(2024, 1, 1)).orderBy("page_id").collect()
    assert [(r["page_id"], r["page_name"], r["page_ordinal"]) for r in cat] == [("s1", "Home", 0), ("s2", "", 0)]
    ov = spark.createDataFrame([('{"_comment":"x","r1":[{"page_id":"a","page_name":"A","page_ordinal":3}]}',),
                                ("{broken",)], "value string")
    assert [tuple(r) for r in pl.parse_overlay(ov).collect()] == [("r1", "a", "A", 3)]
    assert F is not None


def test_window_filters_prune_stored_partitions(spark, tmpdir_path):
    from leafstat.plans.catalogue import lakehouse_queries
    from leafstat.plans.lakehouse import Lakehouse
    rows = [("w", "W", "C", "r1", "R", 1, "p", "P", 1, D(2024, 1, 1) + dt.timedelta(days=i), 1, 1, 1.0, "")
            for i in range(200)]
    io.write_table(spark.createDataFrame(rows, sch.PAGE_VIEWS), tmpdir_path, "page_views")
    lh = Lakehouse.from_path(spark, tmpdir_path)
    assert lh.as_of == D(2024, 1, 1) + dt.timedelta(days=199)
    df = lakehouse_queries()["report_filter"](lh)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.split("\n") if "FileScan" in line][0]
    assert "PartitionFilters: [isnotnull(view_date" in scan and ">= 2024-04-20" in scan
    assert "EqualTo(report_id,Brand#1)" in scan
    assert df.count() == 0 and lakehouse_queries()["daily_trend"](lh).count() == 90
