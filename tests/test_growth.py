"""Steps whose shuffles, writes and task memory must not outgrow the input."""

import datetime as dt
import re

from pyspark.sql import functions as F

from leafstat.operators import silver as sv
from leafstat.plans import registry_defs as rd
from leafstat.plans.catalogue import spark_queries
from leafstat.plans.lakehouse import FACT_BYTES_PER_REDUCER, Lakehouse
from leafstat.session import REDUCER_BYTES, size_shuffles
from leafstat.sources import paths
from leafstat.sources import payload as pl

SF001 = "/root/testdata/sf0.001"


def _events(spark):
    """Two page-days: users in two spellings and with two personas, and many rows without a user."""
    day = dt.date(2024, 1, 1)
    rows = [("w", "r", "p", day, u, v, 10.0 * v, p, "x") for u, v, p in (
        ("ann", 3, "B"), (" ANN ", 2, "A"), ("bob", 4, "A"), (None, 1, "C"), ("", 2, None))]
    rows += [("w", "r", "q", day, None, i, None, "D", "x") for i in range(100)]
    return spark.createDataFrame(rows, "workspace_id string, report_id string, page_id string, view_date date, user_upn string, "
                                       "views long, dwell_seconds double, persona string, visit_id string")


def test_page_days_need_two_shuffles(spark):
    catalog = spark.createDataFrame([("w", "r", "p", "P", 1)], "workspace_id string, report_id string, page_id string, "
                                                               "page_name string, page_ordinal int")
    rdim = spark.createDataFrame([("w", "r", "R", "W", "C", 9)], "workspace_id string, report_id string, report_name string, "
                                                                 "workspace_name string, capacity_name string, report_total_pages int")
    pv = sv.page_views_daily(_events(spark), F.broadcast(catalog), F.broadcast(rdim))
    plan = pv._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    got = {r.page_id: (r.view_count, r.unique_users, r.avg_dwell_seconds, r.top_persona) for r in pv.collect()}
    assert got == {"p": (12, 2, 24.0, "A"), "q": (4950, 0, None, "D")}


def test_reducers_follow_the_facts(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    Lakehouse.from_star(spark, SF001)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == str(REDUCER_BYTES)
    try:
        assert size_shuffles(spark, 1 << 30, FACT_BYTES_PER_REDUCER) == 256
    finally:
        spark.conf.unset(key)


def test_a_stored_table_is_written_alone_and_once(spark, monkeypatch):
    lh, written = Lakehouse.from_star(spark, SF001), []
    write = rd.io.write_table
    monkeypatch.setattr(rd.io, "write_table", lambda df, root, table: written.append(table) or write(df, root, table))
    root = rd._silver_stored(lh, "page_catalog")
    assert written == paths.names(spark, root) == ["page_catalog"]
    rd._silver_stored(lh, "unused_pages", "page_catalog")
    assert written == ["page_catalog", "page_views", "unused_pages"]
    kept = rd._stored(lh, "unused_pages")
    assert kept.count() == lh.unused_pages.count() and kept.exceptAll(lh.unused_pages).isEmpty()


def test_landed_documents_are_compressed_and_whole(spark):
    lh = Lakehouse.from_star(spark, SF001)
    rows = spark.range(1200).select(F.lit("r").alias("report_id"), F.lit(dt.date(2024, 1, 1)).alias("view_date"),
                                    F.concat(F.lit("u"), "id").alias("user_upn"), F.col("id").alias("view_count"),
                                    F.lit(1).cast("long").alias("distinct_pages_viewed"))
    landed = rd._landed_docs(lh, pl.user_payload_docs(rows))
    assert landed.where("file LIKE '%.gz'").count() == landed.count() >= 2
    got = pl.flatten_user_payload(landed)
    assert got.agg(F.count("*"), F.sum("view_count"), F.count_distinct("user_id_hash")).first()[:] == (1200, 719_400, 1200)


def _written(monkeypatch):
    written, write = [], rd.io.write_table
    monkeypatch.setattr(rd.io, "write_table", lambda df, root, table: written.append(table) or write(df, root, table))
    return written


def test_a_query_stores_its_tables_whatever_ran_before(spark, monkeypatch):
    written, query = _written(monkeypatch), spark_queries()["silver_parquet_roundtrip_page_catalog"]
    assert query(spark, SF001).count() == query(spark, SF001).count() == 200
    assert written == ["page_catalog"] * 2


def test_facts_are_not_shuffled_by_report(spark):
    lh = Lakehouse.from_star(spark, SF001)
    for rows in (lh.page_views, lh.user_views):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        by_report = [line for line in plan.split("\n") if re.search(r"hashpartitioning\(workspace_id#\d+, report_id#\d+, \d+\)", line)]
        assert not by_report, by_report


def test_row_counts_join_the_events_once(spark, monkeypatch):
    written, landed = _written(monkeypatch), []
    land = Lakehouse.on_landed_events
    monkeypatch.setattr(Lakehouse, "on_landed_events", lambda lh, path: landed.append(path) or land(lh, path))
    got = {r.table_name: r.row_count for r in spark_queries()["table_row_counts"](spark, SF001).collect()}
    assert got == {"page_views": 5967, "page_catalog": 200, "report_views": got["report_views"],
                   "user_views": got["user_views"], "unused_pages": 65}
    lh = Lakehouse.from_star(spark, SF001)
    assert (got["report_views"], got["user_views"]) == (lh.report_views.count(), lh.user_views.count())
    assert len(landed) == 1 and sorted(written) == sorted(got)
    assert paths.exists(spark, landed[0])
