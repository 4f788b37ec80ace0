"""Latest attributes beside totals: brute force, odd rows, and hashed facts in the plan."""

import datetime as dt
import random

from pyspark.sql import functions as F

from leafstat import schemas as sch
from leafstat.operators import common as cm
from leafstat.operators import pages as pg
from leafstat.operators import reports as rp

D = dt.date
SCHEMA = "k string, name string, size int, day date, n bigint, x double"


def _brute(rows):
    def newest(group, at):
        # nulls are smallest, in the date and in the value
        best = max(group, key=lambda r: (r[3] is not None, r[3] or D.min, r[at] is not None, r[at] if r[at] is not None else 0))
        return best[at]

    out = {}
    for k in {r[0] for r in rows}:
        g = [r for r in rows if r[0] == k]
        days = [r[3] for r in g if r[3] is not None]
        xs = [r[5] for r in g if r[5] is not None]
        out[k] = (newest(g, 1), newest(g, 2), sum(r[4] for r in g), len(xs), max(xs, default=None),
                  max(days, default=None))
    return out


def test_latest_values_equal_brute_force(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice(["one", "two", "", None]), rnd.choice([1, 2, None]),
             rnd.choice([D(2024, 1, 1), D(2024, 1, 2), None]), rnd.randrange(9), rnd.choice([0.5, 2.0, None]))
            for _ in range(400)]
    rows += [("hot", "x", 1, D(2024, 1, 1), 1, None)] * 50 + [("undated", None, None, None, 3, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = cm.with_latest(df, ["k"], ["name", "size"], "day", at="last", n=("sum", "n"), xs=("count", "x"),
                         top=("max", "x")).collect()
    assert {r.k: (r["name"], r["size"], r.n, r.xs, r.top, r["last"]) for r in got} == _brute(rows)
    assert len(got) == len({r[0] for r in rows})


def test_latest_values_of_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert cm.with_latest(df, ["k"], ["name"], "day", n=("sum", "n")).collect() == []


def _pv(spark, rows):
    return spark.createDataFrame(
        [("w", w, "c", "r", rn, 3, p, pn, o, d, v, u, s, "") for w, rn, p, pn, o, d, v, u, s in rows], sch.PAGE_VIEWS)


def test_report_takes_the_names_of_its_latest_page(spark):
    pv = _pv(spark, [("Old", "Zed", "p1", "A", 1, D(2024, 1, 1), 5, 1, 2.0),
                     ("New", "Alpha", "p2", "B", 2, D(2024, 1, 3), 2, 1, 4.0),
                     ("Mid", "Beta", "p1", "A2", 1, D(2024, 1, 2), 1, 2, 6.0)])
    r = pg.report_summary(pv).collect()
    assert [(x.workspace_name, x.report_name, x.pages_with_views, x.total_views, x.active_users_peak) for x in r] \
        == [("New", "Alpha", 2, 8, 2)]
    t = {x.page_id: x for x in cm.page_totals(pv).collect()}
    assert (t["p1"].page_name, t["p1"].workspace_name, t["p1"].views, t["p1"].avg_dwell_unweighted) == ("A2", "Mid", 6, 4.0)
    assert pg.workspace_summary(pv).first().workspace_name == "New"
    m = rp.report_matrix(pv, spark.createDataFrame([], sch.REPORT_VIEWS), spark.createDataFrame([], sch.UNUSED_PAGES)).first()
    assert (m.report_name, m.views, m.top_page_share) == ("Alpha", 8, 0.75)


def test_facts_are_aggregated_by_hash(spark, tmpdir_path):
    """The aggregate right above the scan is hashed; what is sorted comes after a shuffle."""
    path = f"{tmpdir_path}/facts"
    _pv(spark, [("W", "R", "p", "P", 1, D(2024, 1, 1), 1, 1, 1.0)]).write.parquet(path)
    pv = spark.read.parquet(path)
    cat = spark.createDataFrame([], sch.PAGE_CATALOG)
    for df in (cm.page_totals(pv), cm.report_attrs(pv), pg.report_summary(pv), pg.workspace_summary(pv),
               pg.page_funnel(pv), pg.pct_of_first_page(pv), pg.page_bar_share(pv, cat)):
        lines = df._jdf.queryExecution().sparkPlan().toString().splitlines()
        scans = [i for i, line in enumerate(lines) if "FileScan parquet" in line and path in line]
        assert scans
        for i in scans:
            above = next(line for line in reversed(lines[:i]) if "Aggregate" in line)
            assert "HashAggregate" in above, above
