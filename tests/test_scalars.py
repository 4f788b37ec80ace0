"""X1 hash, X2 date cut, X4 safe divide, F9 page key, F7 search."""

import hashlib

from pyspark.sql import functions as F

from leafstat.functions.scalars import date_cut, hash_user, page_key, safe_div


def py_hash(upn):
    if not upn:
        return ""
    return hashlib.sha256(upn.strip().lower().encode("utf-8")).hexdigest()[:16]


def test_hash_matches_python_rule(spark):
    cases = ["Ann@Example.com", "  ann@example.com ", "\tann@example.com\n", "", None, "   ",
             "\u3000ann@example.com\xa0", "\x1cann@example.com\u2029",
             "BOB@x.org", "bob@x.org"]
    df = spark.createDataFrame([(c,) for c in cases], "u string")
    got = [r[0] for r in df.select(hash_user("u")).collect()]
    assert got == [py_hash(c) for c in cases]
    # two spellings of one user share a hash; whitespace-only hashes '' (not blank)
    assert got[0] == got[1] == got[2]
    assert got[3] == "" and got[4] == ""
    assert got[5] == hashlib.sha256(b"").hexdigest()[:16]
    assert got[6] == got[7] == got[0]


def test_hash_shape(spark):
    df = spark.createDataFrame([("x@y.z",)], "u string")
    h = df.select(hash_user("u")).first()[0]
    assert len(h) == 16 and all(c in "0123456789abcdef" for c in h)


def test_date_cut_and_safe_div(spark):
    df = spark.createDataFrame([("2024-03-05T10:11:12Z", 4, 0), ("bad", 1, 2), (None, 3, None)],
                               "ts string, a int, b int")
    rows = df.select(date_cut("ts").alias("d"), safe_div("a", "b").alias("q")).collect()
    assert str(rows[0]["d"]) == "2024-03-05" and rows[0]["q"] is None
    assert rows[1]["d"] is None and rows[1]["q"] == 0.5
    assert rows[2]["q"] is None


def test_page_key(spark):
    df = spark.createDataFrame([("w", "r", "p")], "workspace_id string, report_id string, page_id string")
    assert df.select(page_key()).first()[0] == "w|r|p"


def test_page_name_search_is_literal(spark):
    from leafstat.operators.pages import page_name_search
    from leafstat import schemas as sch
    rows = [("w", "W", "r", "R", "1", "Sales 100%", 1, None), ("w", "W", "r", "R", "2", "sales_x", 2, None),
            ("w", "W", "r", "R", "3", "Other", 3, None)]
    cat = spark.createDataFrame(rows, sch.PAGE_CATALOG)
    assert page_name_search(cat, "SALES").count() == 2
    assert page_name_search(cat, "100%").count() == 1
    assert page_name_search(cat, "_").count() == 1
    assert page_name_search(cat, "").count() == 3
    assert F is not None
