"""Landed API payloads -> typed rows.

Documents are read by ``landed_documents``, one a line or one a file, or taken
from a string column, parsed JVM-side with ``from_json`` (PERMISSIVE: a
malformed document becomes NULL and yields no rows) and exploded.
``corrupt_documents`` counts those by file, so a run can report them.  Key lookups try the qualified column name first, then the bare
one, as the API returns either form.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafstat import schemas as sch

# Column keys of the usage query result.
PAGE_KEYS = {
    "report_id": ["'Report page views'[Report Id]", "[Report Id]"],
    "page_name": ["'Report page views'[Report page name]", "[Report page name]"],
    "view_date": ["'Report page views'[Date]", "[Date]"],
    "view_count": ["[Views]"],
    "unique_users": ["[UniqueUsers]"],
    "avg_dwell_seconds": ["[AvgDwellSeconds]"],
}
REPORT_KEYS = {
    "report_id": ["'Report views'[Report Id]", "[Report Id]"],
    "view_date": ["'Report views'[Date]", "[Date]"],
    "view_count": ["[Views]"],
    "unique_users": ["[UniqueUsers]"],
    "avg_session_seconds": ["[AvgSessionSeconds]"],
}
USER_KEYS = {
    "report_id": ["'Report page views'[Report Id]", "[Report Id]"],
    "user": ["'Report page views'[User]", "[User]"],
    "view_date": ["'Report page views'[Date]", "[Date]"],
    "view_count": ["[Views]"],
    "distinct_pages_viewed": ["[DistinctPagesViewed]"],
}

RESULT_SCHEMA = "struct<results: array<struct<tables: array<struct<rows: array<map<string,string>>>>>>>"
ROSTER_SCHEMA = "struct<value: array<struct<name: string, displayName: string, order: string>>>"
OVERLAY_ITEM_SCHEMA = "array<struct<page_id: string, page_name: string, page_ordinal: string>>"


def landed_documents(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """(value, file): the documents below ``path``, one a line, or one a file
    where responses are stored as they came (pretty-printed over many lines)."""
    docs = spark.read.text(path, wholetext=whole_files)
    return docs.select("value", F.col("_metadata.file_path").alias("file"))


def corrupt_documents(docs: DataFrame, col: str = "value", schema: str = RESULT_SCHEMA, key: str = "results") -> DataFrame:
    """Per file: documents, and how many of them are no document of the expected
    shape (not JSON, cut short, or without its top-level key).  Blank lines are none."""
    bad = F.from_json(F.col(col), schema).getField(key).isNull()
    return (docs.where(F.trim(F.col(col)) != "").groupBy("file")
            .agg(F.count(F.lit(1)).alias("documents"), F.count(F.when(bad, 1)).alias("corrupt")))


def _first_key(m: Column, keys: list[str]) -> Column:
    return F.coalesce(*[m.getItem(k) for k in keys])


def _rows(docs: DataFrame, col: str = "value") -> DataFrame:
    parsed = docs.select(F.from_json(F.col(col), RESULT_SCHEMA).alias("j"))
    rows = F.element_at(F.element_at("j.results", 1).getField("tables"), 1).getField("rows")
    return parsed.select(F.explode(F.coalesce(rows, F.array().cast("array<map<string,string>>"))).alias("r"))


def _num(c: Column, typ: str, default) -> Column:
    return F.coalesce(c.try_cast("double").try_cast(typ) if typ != "double" else c.try_cast("double"),
                      F.lit(default).cast(typ))


def _day(c: Column) -> Column:
    return F.try_to_date(F.substring(F.coalesce(c, F.lit("")), 1, 10), "yyyy-MM-dd")


def flatten_page_payload(docs: DataFrame, col: str = "value") -> DataFrame:
    """S4 (page target): rows of ``results[0].tables[0].rows`` -> page-day rows.
    Live rows carry the page *name* as page_id (T1) and blank identity."""
    r = F.col("r")
    g = (lambda k: _first_key(r, PAGE_KEYS[k]))
    name = F.coalesce(g("page_name"), F.lit(""))
    return _rows(docs, col).select(
        F.coalesce(g("report_id"), F.lit("")).alias("report_id"),
        name.alias("page_id"), name.alias("page_name"),
        _day(g("view_date")).alias("view_date"),
        _num(g("view_count"), "bigint", 0).alias("view_count"),
        _num(g("unique_users"), "bigint", 0).alias("unique_users"),
        _num(g("avg_dwell_seconds"), "double", 0.0).alias("avg_dwell_seconds"))


def flatten_report_payload(docs: DataFrame, col: str = "value") -> DataFrame:
    """S4 (report target)."""
    r = F.col("r")
    g = (lambda k: _first_key(r, REPORT_KEYS[k]))
    return _rows(docs, col).select(
        F.coalesce(g("report_id"), F.lit("")).alias("report_id"), _day(g("view_date")).alias("view_date"),
        _num(g("view_count"), "bigint", 0).alias("view_count"),
        _num(g("unique_users"), "bigint", 0).alias("unique_users"),
        _num(g("avg_session_seconds"), "double", 0.0).alias("avg_session_seconds"))


def flatten_user_payload(docs: DataFrame, col: str = "value") -> DataFrame:
    """S4 (user target): the UPN is hashed as soon as it is read."""
    from leafstat.functions.scalars import hash_user
    r = F.col("r")
    g = (lambda k: _first_key(r, USER_KEYS[k]))
    return _rows(docs, col).select(
        F.coalesce(g("report_id"), F.lit("")).alias("report_id"), hash_user(g("user")).alias("user_id_hash"),
        _day(g("view_date")).alias("view_date"),
        _num(g("view_count"), "bigint", 0).alias("view_count"),
        _num(g("distinct_pages_viewed"), "bigint", 0).alias("distinct_pages_viewed"))


def catalog_from_roster(docs: DataFrame, pulled_at: _dt.datetime, col: str = "value") -> DataFrame:
    """Page roster documents (one per report, with workspace/report context
    columns alongside) -> catalog rows stamped with the pull time."""
    ctx = [c for c in ("workspace_id", "workspace_name", "report_id", "report_name") if c in docs.columns]
    p = docs.select(*ctx, F.explode(F.coalesce(F.from_json(F.col(col), ROSTER_SCHEMA).getField("value"),
                                                F.array().cast("array<struct<name:string,displayName:string,"
                                                               "order:string>>"))).alias("p"))
    out = p.select(*ctx,
                   F.coalesce(F.col("p.name"), F.lit("")).alias("page_id"),
                   F.coalesce(F.col("p.displayName"), F.lit("")).alias("page_name"),
                   _num(F.col("p.order"), "int", 0).alias("page_ordinal"),
                   F.lit(pulled_at).cast("timestamp_ntz").alias("catalog_pulled_at"))
    return out.select(*sch.PAGE_CATALOG.fieldNames())


def parse_overlay(docs: DataFrame, col: str = "value") -> DataFrame:
    """S6 overlay: ``{report_id: [{page_id, page_name, page_ordinal}], "_comment": "..."}``
    -> (report_id, page_id, page_name, page_ordinal).  The ``_comment`` key and
    malformed documents contribute nothing."""
    m = F.coalesce(F.from_json(F.col(col), "map<string,string>"), F.create_map().cast("map<string,string>"))
    e = docs.select(F.explode(m).alias("report_id", "items")).filter(~F.col("report_id").startswith("_"))
    items = F.coalesce(F.from_json("items", OVERLAY_ITEM_SCHEMA),
                       F.array().cast(OVERLAY_ITEM_SCHEMA))
    x = e.select("report_id", F.explode(items).alias("i"))
    return x.select("report_id", F.coalesce(F.col("i.page_id"), F.lit("")).alias("page_id"),
                    F.coalesce(F.col("i.page_name"), F.lit("")).alias("page_name"),
                    _num(F.col("i.page_ordinal"), "int", 0).alias("page_ordinal"))


# -- serialisers used to land fixtures from the silver tables ---------------
DOC_ROWS = 500             # rows of a document, about


def _blocked(rows: DataFrame, keys: list[str], by: Column) -> DataFrame:
    """``rows`` with ``_b``: blocks of about DOC_ROWS rows of a key.  A key's rows are
    dealt by the hash of ``by``, over as many blocks as its count asks for, so no
    document grows with its report."""
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / DOC_ROWS).cast("int").alias("_blocks"))
    return rows.join(sizes, keys).withColumn("_b", F.pmod(F.xxhash64(by), F.col("_blocks")).cast("int")).drop("_blocks")


def _midnight(day: str) -> Column:
    """A date as the API writes it: an ISO time stamp at midnight."""
    return F.date_format(day, "yyyy-MM-dd'T'00:00:00")


def _result_docs(rows: DataFrame, by: Column, fields: dict[str, Column]) -> DataFrame:
    """Rows re-serialised into the API result shape, a document for each (report, day, block)."""
    keys = ["report_id", "view_date"]
    pairs = [x for k, v in fields.items() for x in (F.lit(k), v.cast("string"))]
    # Dealt while they are typed columns: the maps, with their long keys, are made where they are gathered.
    g = (_blocked(rows, keys, by).repartition(*keys, "_b")
         .groupBy(*keys, "_b").agg(F.collect_list(F.create_map(*pairs)).alias("rows")))
    doc = F.struct(F.array(F.struct(F.array(F.struct(F.col("rows").alias("rows"))).alias("tables"))).alias("results"))
    return g.select("report_id", "view_date", F.to_json(doc).alias("value"))


def page_payload_docs(pv: DataFrame) -> DataFrame:
    """Page-day rows as result documents of the page target."""
    return _result_docs(pv, F.col("page_id"), {
        PAGE_KEYS["report_id"][0]: F.col("report_id"), PAGE_KEYS["page_name"][0]: F.col("page_name"),
        PAGE_KEYS["view_date"][0]: _midnight("view_date"), "[Views]": F.col("view_count"),
        "[UniqueUsers]": F.col("unique_users"), "[AvgDwellSeconds]": F.col("avg_dwell_seconds")})


def report_payload_docs(rv: DataFrame) -> DataFrame:
    """Report-day rows as result documents of the report target."""
    return _result_docs(rv, F.col("workspace_id"), {
        REPORT_KEYS["report_id"][0]: F.col("report_id"), REPORT_KEYS["view_date"][0]: _midnight("view_date"),
        "[Views]": F.col("view_count"), "[UniqueUsers]": F.col("unique_users"),
        "[AvgSessionSeconds]": F.col("avg_session_seconds")})


def user_payload_docs(user_days: DataFrame) -> DataFrame:
    """(report_id, view_date, user_upn, view_count, distinct_pages_viewed) as result
    documents of the user target, in which users are still named."""
    return _result_docs(user_days, F.col("user_upn"), {
        USER_KEYS["report_id"][0]: F.col("report_id"), USER_KEYS["user"][0]: F.col("user_upn"),
        USER_KEYS["view_date"][0]: _midnight("view_date"), "[Views]": F.col("view_count"),
        "[DistinctPagesViewed]": F.col("distinct_pages_viewed")})


def roster_docs(catalog: DataFrame) -> DataFrame:
    """Catalog re-serialised as roster documents of about DOC_ROWS pages
    (one report's roster never becomes one giant row)."""
    keys = ["workspace_id", "workspace_name", "report_id", "report_name"]
    item = F.struct(F.col("page_id").alias("name"), F.col("page_name").alias("displayName"),
                    F.col("page_ordinal").alias("order"))
    g = _blocked(catalog, keys, F.col("page_id")).groupBy(*keys, "_b").agg(F.collect_list(item).alias("value"))
    return g.select(*keys, F.to_json(F.struct("value")).alias("value"))


def overlay_docs(pages: DataFrame, comment: str = "pages that exist but were never viewed") -> DataFrame:
    """Overlay documents (with a ``_comment`` key) of about DOC_ROWS pages of one
    report, so no document grows with a report's size."""
    item = F.struct("page_id", "page_name", "page_ordinal")
    g = _blocked(pages, ["report_id"], F.col("page_id")).groupBy("report_id", "_b").agg(F.collect_list(item).alias("items"))
    # '["c"]' minus the brackets -> '"c"', then the map's members
    head = F.concat(F.lit('{"_comment":'), F.regexp_extract(F.to_json(F.array(F.lit(comment))), r"^\[(.*)\]$", 1))
    return g.select(F.concat(head, F.lit(","), F.expr("substring(to_json(map(report_id, items)), 2)"))
                    .alias("value"))
