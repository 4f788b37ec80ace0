"""Run accounting, commit protocol, redo log, sources with few feeds, stored
silver, landed responses, gold upkeep and catalog tables."""

import datetime as dt
import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from leafstat import schemas as sch
from leafstat.functions.scalars import hash_user
from leafstat.operators import governance as gv
from leafstat.operators import ops
from leafstat.operators import users as us
from leafstat.plans import gold, gold_sink
from leafstat.plans.catalogue import SURVEY_ALIASES, lakehouse_queries
from leafstat.plans.collect import collect, observed, runs
from leafstat.plans.lakehouse import Lakehouse
from leafstat.sources import days, files as io, paths, payload as pl, versions
from leafstat.sources.telemetry import FEEDS, Feeds, MissingColumns
from leafstat.streaming.upsert import foreach_batch_upsert, upsert
from tests.conftest import SF001
from tools.check_oracle import TABLES, rows_of

D = dt.date
LAST = D(2024, 3, 31)


def catalog_rows(n, report="r", prefix="p"):
    return [("w", "W", report, "R", f"{prefix}{i}", f"Page {i}", i, None) for i in range(n)]


def user_rows(day_values):
    return [("w", "W", "r", "R", h, d, v, 1) for h, d, v in day_values]


def facts(spark, values):
    return spark.createDataFrame([("w", "W", "C", "r", "R", 2, p, p, 1, d, v, 1, 1.0, "") for p, d, v in values], sch.PAGE_VIEWS)


class EventsOnly:
    """A source of page events and nothing else."""

    def __init__(self, spark):
        self.spark = spark

    def raw_page_events(self):
        rows = [("w", "r", f"p{i % 3}", LAST - dt.timedelta(days=i % 50), f"u{i % 4}@x", 1 + i % 3, 1.0, "A", str(i)) for i in range(60)]
        return self.spark.createDataFrame(rows, sch.RAW_PAGE_EVENTS)


class Small(EventsOnly):
    """Enumerations, a catalog without one of the reports, and no dataset."""

    def workspaces(self):
        return self.spark.createDataFrame([("Workspace", "Active", "w", "W", "C")], FEEDS["workspaces"])

    def reports(self):
        return self.spark.createDataFrame([("w", "r", "R", "x"), ("w", "bare", "B", "x")], FEEDS["reports"])

    def catalog(self, pulled):
        rows = [("w", "W", "r", "R", f"p{i}", f"P{i}", i + 1, pulled, 5) for i in range(5)]
        return self.spark.createDataFrame(rows, FEEDS["catalog"])


class Failing(Small):
    def catalog(self, pulled):
        return super().catalog(pulled).withColumn("page_name", F.raise_error(F.lit("gone")).cast("string"))


# -- K4: commits -------------------------------------------------------------
def test_a_write_that_dies_leaves_the_old_table(spark, tmpdir_path):
    old = spark.createDataFrame(catalog_rows(3), sch.PAGE_CATALOG)
    table = io.write_table(old, tmpdir_path, "page_catalog")
    dies = spark.createDataFrame(catalog_rows(50), sch.PAGE_CATALOG).repartition(8).withColumn(
        "page_name", F.when(F.col("page_id") == "p49", F.raise_error(F.lit("x")).cast("string")).otherwise(F.col("page_name")))
    reader = io.read_table(spark, tmpdir_path, "page_catalog")
    with pytest.raises(Exception):
        io.write_table(dies, tmpdir_path, "page_catalog")
    assert io.read_table(spark, tmpdir_path, "page_catalog").count() == 3 and len(versions.commits(spark, table)) == 1
    assert len(versions.uncommitted(spark, table)) == 1
    # A replace may read what it replaces, and a reader that began before it goes on.
    io.write_table(io.read_table(spark, tmpdir_path, "page_catalog").limit(2), tmpdir_path, "page_catalog")
    assert io.read_table(spark, tmpdir_path, "page_catalog").count() == 2 and reader.count() == 3
    io.write_table(old, tmpdir_path, "page_catalog")
    assert [n for n, _ in versions.commits(spark, table)] == [2, 3]
    assert io.table_schema_versions(spark, table) == [sch.SILVER_SCHEMA_VERSION]
    assert spark.read.schema(sch.PAGE_CATALOG).parquet(table).count() == 0      # never a mixture


# -- K3: one evaluation, redo log, epochs -------------------------------------
def test_upsert_evaluates_its_batch_once(spark, tmpdir_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    rows = user_rows([("h1", D(2024, 1, 1), 5), ("h2", D(2024, 1, 2), 6)])
    batch = spark.createDataFrame(rows, sch.USER_VIEWS).mapInPandas(count, sch.USER_VIEWS)
    assert upsert(batch, tmpdir_path, "user_views") == 2 and seen.value == 2


def test_upsert_file_count_follows_days(spark, tmpdir_path):
    rows = user_rows([(f"h{i}", D(2024, 1, 1 + i % 3), i) for i in range(300)])
    upsert(spark.createDataFrame(rows, sch.USER_VIEWS).repartition(40), tmpdir_path, "user_views")
    files = [f for f in paths.files_below(spark, f"{tmpdir_path}/user_views") if f.endswith(".parquet")]
    assert len(files) <= 3 + int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_replayed_epochs_change_nothing(spark, tmpdir_path):
    sink = foreach_batch_upsert(tmpdir_path, "user_views", stream="s")
    at = lambda v: spark.createDataFrame(user_rows([("h", D(2024, 1, 1), v)]), sch.USER_VIEWS)
    held = lambda: [r.view_count for r in io.read_table(spark, tmpdir_path, "user_views").collect()]
    sink(at(1), 0)
    sink(at(2), 1)
    sink(at(9), 0)
    sink(at(9), 1)
    assert held() == [2] and days.applied_epoch(spark, f"{tmpdir_path}/user_views", "s") == 1
    foreach_batch_upsert(tmpdir_path, "user_views", stream="other")(at(3), 0)
    assert held() == [3]


def test_a_swap_that_dies_is_finished_by_the_next_change(spark, tmpdir_path, monkeypatch):
    table = f"{tmpdir_path}/user_views"
    base = user_rows([("h", D(2024, 1, d), 1) for d in (1, 2, 3)])
    upsert(spark.createDataFrame(base, sch.USER_VIEWS), tmpdir_path, "user_views")
    real, left = paths.move, [1]

    def dies(s, source, target):
        if "/_stage/" in source:
            if not left:
                raise OSError("killed")
            left.pop()
        real(s, source, target)

    monkeypatch.setattr(paths, "move", dies)
    change = user_rows([("h", D(2024, 1, d), 7) for d in (1, 2, 3)])
    with pytest.raises(OSError):
        upsert(spark.createDataFrame(change, sch.USER_VIEWS), tmpdir_path, "user_views", stream="s", epoch=4)
    monkeypatch.setattr(paths, "move", real)
    assert upsert(spark.createDataFrame(change, sch.USER_VIEWS), tmpdir_path, "user_views", stream="s", epoch=4) == 0
    assert sorted(r.view_count for r in io.read_table(spark, tmpdir_path, "user_views").collect()) == [7, 7, 7]
    assert days.recover(spark, table) == 0


def test_rows_without_a_day_are_refused(spark, tmpdir_path):
    with pytest.raises(ValueError):
        upsert(spark.createDataFrame(user_rows([("h", None, 1)]), sch.USER_VIEWS), tmpdir_path, "user_views")
    assert upsert(spark.createDataFrame([], sch.USER_VIEWS), tmpdir_path, "user_views") == 0


# -- sources with few feeds ---------------------------------------------------
def test_feeds_are_whole_or_empty(spark):
    feeds = Feeds(spark, EventsOnly(spark))
    assert feeds.has("raw_page_events") and not feeds.has("catalog")
    for name in FEEDS:
        got = feeds.get(name)
        assert set(FEEDS[name].fieldNames()) <= set(got.columns)
        assert name == "raw_page_events" or got.isEmpty()
    with pytest.raises(KeyError):
        feeds.has("no_such_feed")

    class Wrong:
        def people(self):
            return spark.createDataFrame([("u",)], "upn string")

    with pytest.raises(MissingColumns):
        Feeds(spark, Wrong()).get("people")


def test_visits_that_are_missing_are_rolled_up(spark):
    lh = Lakehouse(spark, EventsOnly(spark))
    assert lh.as_of == LAST
    got = {r.view_date: r.view_count for r in lh.report_views.collect()}
    want = {r.view_date: r.v for r in lh.page_views.groupBy("view_date").agg(F.sum("view_count").alias("v")).collect()}
    assert got == want and lh.unused_pages.isEmpty() and lh.user_views.count() > 0


# Storage queries write thousands of day folders here; the operators under them have tests of their own.
STORES = ("silver_", "upsert_", "write_bronze", "gold_", "retain_bronze", "table_row_counts", "forget_user_stored", "run_metrics")
ANSWERS = [n for n in sorted(lakehouse_queries()) if not n.startswith(STORES) and n not in SURVEY_ALIASES]


@pytest.fixture(scope="module")
def events_only(spark):
    lh = Lakehouse(spark, EventsOnly(spark))
    for name in sch.SILVER:
        lh._tables[name] = getattr(lh, name).persist()
    return lh


@pytest.mark.parametrize("name", ANSWERS)
def test_every_query_answers_on_events_alone(spark, events_only, name):
    lakehouse_queries()[name](events_only).collect()


def test_an_empty_source_answers(spark):
    lh = Lakehouse(spark, None)
    for name in ("page_views_daily", "unused_pages", "report_matrix", "headline_kpis", "daily_trend", "user_kpis"):
        lakehouse_queries()[name](lh).collect()


# -- answering from stored silver ---------------------------------------------
@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    return Lakehouse.from_star(spark, SF001).store(str(tmp_path_factory.mktemp("stored")))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF001}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


RAW = {"multi_page_user_share", "persona_enrichment", "flatten_user_payload"}      # ask for users that silver no longer names


@pytest.mark.parametrize("name", [n for n in ANSWERS if n not in RAW])
def test_stored_silver_answers_like_the_source(spark, stored, duck, name):
    df = lakehouse_queries()[name](stored)
    assert "lineitem" not in df._jdf.queryExecution().toString()
    st, want = df.toArrow(), duck.execute(E.oracle_sql()[name]).to_arrow_table()
    assert rows_of(st) == rows_of(want)


def test_raw_join_runs_once(spark):
    plan = Lakehouse.from_star(spark, SF001).page_views._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("lineitem.parquet") == 1


# -- runs ----------------------------------------------------------------------
def test_run_accounting_follows_the_data(spark, tmpdir_path):
    row = collect(Lakehouse(spark, Small(spark)), tmpdir_path).first()
    assert (row.page_view_rows, row.page_catalog_rows, row.workspaces, row.reports, row.datasets) == (
        io.read_table(spark, tmpdir_path, "page_views").count(), 5, 1, 2, 0)
    assert row.unused_pages == 2 and [p["page_name"] for p in json.loads(row.unused_pages_sample)] == ["P3", "P4"]
    assert json.loads(row.reports_without_catalog) == [{"workspace_id": "w", "report_id": "bare"}]
    assert json.loads(row.workspaces_not_bootstrapped) == ["W"] and row.reports_skipped_no_bootstrap == 2
    assert row.ok and row.n_errors == 0 and row.started_at <= row.ended_at
    again = collect(Lakehouse(spark, Small(spark)), tmpdir_path).first()
    assert again.page_view_rows == row.page_view_rows and runs(spark, tmpdir_path).count() == 2
    assert io.read_table(spark, tmpdir_path, "page_views").count() == row.page_view_rows     # upserted, not added


def test_a_failing_feed_is_noted_and_the_others_go_on(spark, tmpdir_path):
    collect(Lakehouse(spark, Small(spark)), tmpdir_path)
    row = collect(Lakehouse(spark, Failing(spark)), tmpdir_path).first()
    assert not row.ok and row.n_errors >= 1 and "page_catalog" in [e["scope"] for e in json.loads(row.errors)]
    assert row.user_view_rows > 0 and row.page_catalog_rows == 0
    assert io.read_table(spark, tmpdir_path, "page_catalog").count() == 5                    # as the last good run left it
    line = json.loads(ops.run_metrics_json(ops.run_summary(runs(spark, tmpdir_path)).where("NOT ok")).first().line)
    assert line["ok"] is False and line["errors"] == row.n_errors
    gauges = [r.line for r in ops.run_metrics_gauges(ops.run_summary(runs(spark, tmpdir_path)).where("NOT ok")).collect()]
    assert f'leafstat_run_ok{{schema_version="{sch.SILVER_SCHEMA_VERSION}"}} 0' in gauges and len(gauges) == 6


def test_errors_that_the_source_reports_count(spark, tmpdir_path):
    class Reporting(Small):
        def collection_errors(self):
            return spark.range(150).select(F.format_string("report %03d", "id").alias("scope"), F.lit("denied").alias("error"))

    row = collect(Lakehouse(spark, Reporting(spark)), tmpdir_path).first()
    assert row.n_errors == 150 and not row.ok and len(json.loads(row.errors)) == sch.RUN_LIST


def test_rows_are_observed_where_they_are_written(spark, tmpdir_path):
    assert observed(spark.range(7), lambda df: df.write.parquet(f"{tmpdir_path}/a")) == 7
    assert observed(spark.range(0), lambda df: df.write.parquet(f"{tmpdir_path}/b")) == 0


def test_scope_drop_by_either_count(spark):
    log = spark.createDataFrame([(D(2024, 1, 1), 5, 3), (D(2024, 1, 2), 5, 2), (D(2024, 1, 3), 6, 2), (D(2024, 1, 4), 1, 9)],
                                "run_date date, reports long, workspaces long")
    assert [r.scope_dropped for r in ops.run_scope_drop(log).orderBy("run_date").collect()] == [False, True, False, True]


# -- landed responses -----------------------------------------------------------
def test_landed_responses_one_a_file(spark, tmpdir_path):
    good = {"results": [{"tables": [{"rows": [{"[Report Id]": "r1", "'Report views'[Date]": "2024-01-05T00:00:00", "[Views]": 3,
                                               "[UniqueUsers]": 2, "[AvgSessionSeconds]": 1.5}]}]}]}
    user = {"results": [{"tables": [{"rows": [{"[Report Id]": "r1", "[User]": " Ann@X ", "[Date]": "2024-01-05", "[Views]": 3}]}]}]}
    texts = {"a.json": json.dumps(good, indent=2), "b.json": '{"results": [{"tab', "c.json": '{"error": "denied"}',
             "d.json": json.dumps(user, indent=1)}
    for name, text in texts.items():
        with open(f"{tmpdir_path}/{name}", "w") as f:
            f.write(text)
    docs = pl.landed_documents(spark, tmpdir_path, whole_files=True)
    assert {r.file.rsplit("/", 1)[1]: (r.documents, r.corrupt) for r in pl.corrupt_documents(docs).collect()} == {
        "a.json": (1, 0), "b.json": (1, 1), "c.json": (1, 1), "d.json": (1, 0)}
    assert tuple(pl.flatten_report_payload(docs.where("file LIKE '%a.json'")).first()) == ("r1", D(2024, 1, 5), 3, 2, 1.5)
    h = spark.range(1).select(hash_user(F.lit("ann@x"))).first()[0]
    assert tuple(pl.flatten_user_payload(docs.where("file LIKE '%d.json'")).first()) == ("r1", h, D(2024, 1, 5), 3, 0)


def test_documents_stay_bounded(spark, monkeypatch):
    monkeypatch.setattr(pl, "DOC_ROWS", 20)
    pv = facts(spark, [(f"p{i}", D(2024, 1, 1), i) for i in range(1000)]).withColumn("page_ordinal", F.lit(0))
    sizes = [len(json.loads(r.value)["results"][0]["tables"][0]["rows"]) for r in pl.page_payload_docs(pv).collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 60


# -- gold ------------------------------------------------------------------------
def test_gold_refresh_equals_a_rebuild(spark, tmpdir_path):
    io.write_table(facts(spark, [("a", D(2024, 1, d), d) for d in range(1, 20)]), tmpdir_path, "page_views")
    io.write_table(spark.createDataFrame([*catalog_rows(2, prefix="never"), *catalog_rows(1, prefix="a")], sch.PAGE_CATALOG),
                   tmpdir_path, "page_catalog")
    root = f"{tmpdir_path}/gold"
    gold_sink.build(Lakehouse.from_path(spark, tmpdir_path), root)
    kept = os.path.getmtime(f"{versions.current(spark, root + '/fact_page_views')}/date=2024-01-02")
    touched = [D(2024, 1, 5), D(2024, 1, 25)]
    upsert(facts(spark, [("a", touched[0], 50), ("b", touched[0], 1), ("b", touched[1], 2)]), tmpdir_path, "page_views")
    days.replace_days(io.read_table(spark, tmpdir_path, "page_views").where("false"),
                      versions.current(spark, f"{tmpdir_path}/page_views"), "view_date", sch.KEYS["page_views"], [D(2024, 1, 7)])
    lh = Lakehouse.from_path(spark, tmpdir_path)
    gold_sink.refresh(lh, root, [*touched, D(2024, 1, 7)])
    gold_sink.build(lh, f"{tmpdir_path}/fresh")
    for mart in gold_sink.MARTS:
        a, b = (sorted(map(str, gold_sink.read(spark, r, mart).select(*sorted(gold_sink.read(spark, r, mart).columns)).collect()))
                for r in (root, f"{tmpdir_path}/fresh"))
        assert a == b, mart
    assert os.path.getmtime(f"{versions.current(spark, root + '/fact_page_views')}/date=2024-01-02") == kept
    assert {r.page_id for r in gold_sink.read(spark, root, "dim_page").collect()} == {"a", "a0", "b", "never0", "never1"}
    assert gold.dim_page(lh.page_views.where("false"), lh.page_catalog).count() == 3


# -- governance, bronze, catalog tables --------------------------------------------
def test_business_units(spark):
    pv = facts(spark, [("a", LAST, 1)]).unionByName(facts(spark, [("b", LAST, 1)]).withColumn("workspace_id", F.lit("w2")))
    units = spark.createDataFrame([("w", "U1"), ("w", "U2"), ("w2", "U3")], FEEDS["workspace_units"])
    members = spark.createDataFrame([("U1", " Ann@x"), ("U2", "ann@X "), ("U3", "bob@x"), (None, "eve@x")], FEEDS["unit_members"])
    seen = lambda upn: [r.workspace_id for r in us.business_unit_rls(pv, units, members, upn).collect()]
    assert (seen("ANN@x "), seen("bob@x"), seen("eve@x"), seen("nobody")) == (["w"], ["w2"], [], [])
    me = spark.range(1).select(F.current_user()).first()[0]
    us.secured_view(pv, units, members.unionByName(spark.createDataFrame([("U3", me.upper())], FEEDS["unit_members"])), "mine")
    assert [r.workspace_id for r in spark.table("mine").collect()] == ["w2"]


def test_bronze_by_partition(spark, tmpdir_path):
    a, b = D(2024, 1, 1), D(2024, 1, 2)
    rows = spark.createDataFrame(catalog_rows(2), sch.PAGE_CATALOG)
    io.write_bronze(rows, tmpdir_path, "page_catalog", a)
    io.write_bronze(rows.withColumn("workspace_name", F.lit("New")), tmpdir_path, "page_catalog", b)
    day = lambda d: io.read_bronze(spark, tmpdir_path, "page_catalog", sch.PAGE_CATALOG, d)
    assert [(r.status, r.name_after) for r in ops.bronze_snapshot_diff(day(a), day(b)).collect()] == [("renamed", "New")]
    assert day(D(2024, 1, 3)).isEmpty() and {r.dt for r in day(b).collect()} == {b}
    assert "dt=2024-01-01" not in "".join(day(b).inputFiles())
    io.write_bronze_days(facts(spark, [("a", a, 1), ("a", b, 2)]), tmpdir_path, "page_views", "view_date")
    assert sorted(r.dt for r in io.read_bronze(spark, tmpdir_path, "page_views", sch.PAGE_VIEWS).collect()) == [a, b]


def test_catalog_tables(spark):
    spark.sql("DROP TABLE IF EXISTS bronze_pv")
    spark.sql("DROP TABLE IF EXISTS silver_uv")
    pv = facts(spark, [("a", LAST, 1), ("b", LAST, 2)])
    for d in (D(2023, 1, 1), D(2024, 3, 1), D(2024, 3, 2), D(2024, 3, 2)):
        gv.write_bronze_table(pv, "bronze_pv", d)
    assert spark.table("bronze_pv").groupBy("dt").count().collect() and spark.table("bronze_pv").count() == 6
    gv.write_bronze_table(pv.where("false"), "bronze_pv", D(2024, 3, 2))
    assert gv.retain_bronze_table(spark, "bronze_pv", LAST) == ["2023-01-01"]
    assert [r.dt for r in spark.table("bronze_pv").select("dt").distinct().collect()] == ["2024-03-01"]
    assert gv.retain_bronze_table(spark, "bronze_pv", LAST) == []
    uv = spark.createDataFrame(user_rows([("h", LAST, 1)]), sch.USER_VIEWS)
    io.write_catalog_table(uv, "silver_uv", "user_views")
    assert io.load_table(spark, "table", "silver_uv", "user_views").collect() == uv.collect()
    spark.sql(f"ALTER TABLE silver_uv SET TBLPROPERTIES ('{io.VERSION_PROPERTY}' = '9.0.0')")
    with pytest.raises(io.SchemaVersionError):
        io.load_table(spark, "table", "silver_uv", "user_views")
    spark.sql("DROP TABLE bronze_pv")
    spark.sql("DROP TABLE silver_uv")


def test_csv_export_stays_in_the_jvm(spark, tmpdir_path):
    rows = spark.createDataFrame(catalog_rows(40), sch.PAGE_CATALOG).repartition(5)
    io.write_silver_csv(rows, f"{tmpdir_path}/page_catalog", sch.PAGE_CATALOG)
    parts = [f for f in paths.files_below(spark, f"{tmpdir_path}/page_catalog")]
    for part in parts:
        first, second = paths.read_text(spark, part).split("\n")[:2]
        assert first == f"{io.PREAMBLE}{sch.SILVER_SCHEMA_VERSION}" and second == ",".join(sch.PAGE_CATALOG.fieldNames())
    assert len(parts) == 6
    assert sorted(map(str, io.load_table(spark, "csv", tmpdir_path, "page_catalog").collect())) == sorted(map(str, rows.collect()))


def test_unused_export_in_display_order(spark, tmpdir_path):
    rows = spark.createDataFrame([("w%d" % (i % 2), "W%d" % (i % 2), "r", "R", f"p{i}", f"P{i}", 50 - i, None) for i in range(50)], sch.PAGE_CATALOG)
    io.export_unused_by_workspace(rows.repartition(16), tmpdir_path + "/out")
    for w in ("W0", "W1"):
        files = [f for f in paths.files_below(spark, f"{tmpdir_path}/out/workspace_name={w}")]
        ordinals = [int(line.split(",")[5]) for f in files for line in paths.read_text(spark, f).split("\n")[1:] if line]
        assert len(files) <= 4 and ordinals == sorted(ordinals) and len(ordinals) == 25
