"""Star source: the supplied TPC-H-style tables read as usage telemetry.

One ``lineitem`` row is one raw page-view event.  ``orders`` gives the visit
and the user, ``customer`` the user's name and persona, ``part`` the page,
``p_brand`` the report and ``region`` the workspace (see FIXTURES.md §2).

The source implements the TelemetrySource contract: every feed is a
DataFrame with a fixed schema (``leafstat.schemas``).
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafstat.functions.prefix import ordinal

# Fixed values of the mapping.
WORKSPACE_PREFIX = "ws-"
CAPACITY_PREFIX = "Capacity-P"
REPORT_NAME_PREFIX = "Report "
UPN_DOMAIN = "@example.com"
UNIT_PREFIX = "BU-"
N_WORKSPACES = 5


class StarSource:
    """Telemetry feeds derived from the supplied parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def fact_table(self, name: str, *cols: str) -> DataFrame:
        """A fact-size input, pruned to ``cols``; the ``spark.sql.files.*``
        settings alone decide its splits."""
        return self.table(name).select(*cols)

    def fact_bytes(self) -> int:
        """Size of the fact inputs (lineitem, orders) from file metadata."""
        from leafstat.session import path_bytes
        return path_bytes(self.spark, *[f"{self.sf_dir}/{t}.parquet" for t in ("lineitem", "orders")])

    # -- dimensions ------------------------------------------------------
    @staticmethod
    def _ws_no(brand_col):
        return F.pmod(F.regexp_extract(brand_col, r"#(\d+)", 1).cast("int"), F.lit(N_WORKSPACES))

    def workspaces(self) -> DataFrame:
        """Workspace enumeration (F3 applied: all are active workspaces)."""
        r = self.table("region")
        return r.select(
            F.lit("Workspace").alias("type"), F.lit("Active").alias("state"),
            F.concat(F.lit(WORKSPACE_PREFIX), F.col("r_regionkey").cast("string")).alias("workspace_id"),
            F.col("r_name").alias("workspace_name"),
            F.concat(F.lit(CAPACITY_PREFIX), (1 + F.pmod(F.col("r_regionkey"), F.lit(2))).cast("string"))
            .alias("capacity_name"),
        )

    def _page_keys(self) -> DataFrame:
        """part -> (p_partkey, workspace_id, report_id, page_id): no window, one pass."""
        p = self.table("part").select("p_partkey", "p_brand")
        return p.select(
            "p_partkey",
            F.concat(F.lit(WORKSPACE_PREFIX), self._ws_no(F.col("p_brand")).cast("string")).alias("workspace_id"),
            F.col("p_brand").alias("report_id"),
            F.col("p_partkey").cast("string").alias("page_id"),
        )

    def reports(self) -> DataFrame:
        """Report enumeration: one row per brand (F4: all are standard reports)."""
        p = self.table("part").select("p_brand").distinct()
        return p.select(
            F.concat(F.lit(WORKSPACE_PREFIX), self._ws_no(F.col("p_brand")).cast("string")).alias("workspace_id"),
            F.col("p_brand").alias("report_id"),
            F.concat(F.lit(REPORT_NAME_PREFIX), F.col("p_brand")).alias("report_name"),
            F.lit("PowerBIReport").alias("report_type"),
        )

    def first_date(self) -> _dt.date:
        li = self.table("lineitem").select(F.col("l_shipdate").cast("date").alias("d"))
        return li.select(F.min("d")).first()[0]

    def datasets(self) -> DataFrame:
        """Dataset listing: one dataset per nation, in workspace 'ws-'||n_regionkey,
        named after the nation, listed in n_nationkey order."""
        n = self.table("nation")
        return n.select(
            F.concat(F.lit(WORKSPACE_PREFIX), F.col("n_regionkey").cast("string")).alias("workspace_id"),
            F.concat(F.lit("ds-"), F.col("n_nationkey").cast("string")).alias("dataset_id"),
            F.col("n_name").alias("dataset_name"),
            F.col("n_nationkey").alias("position"))

    def as_of(self) -> _dt.date:
        from leafstat.functions.dates import as_of_date
        li = self.table("lineitem").select(F.col("l_shipdate").cast("date").alias("view_date"))
        return as_of_date(li)

    def catalog(self, pulled_at=None) -> DataFrame:
        """Page roster: every part, ordinal = row number by partkey inside its
        brand (distributed, see ``prefix.ordinal``), report_total_pages = the
        brand's part count, pulled at as_of midnight."""
        if pulled_at is None:
            pulled_at = _dt.datetime.combine(self.as_of(), _dt.time())
        p = self.table("part").select("p_partkey", "p_brand", "p_name")
        p = ordinal(p, ["p_brand"], ["p_partkey"], out="page_ordinal", group_total="report_total_pages")
        ws = self.workspaces()      # Spark broadcasts it where its size allows that
        return (p.withColumn("workspace_id",
                             F.concat(F.lit(WORKSPACE_PREFIX), self._ws_no(F.col("p_brand")).cast("string")))
                .join(ws, "workspace_id", "left")
                .select(
                    "workspace_id", "workspace_name",
                    F.col("p_brand").alias("report_id"),
                    F.concat(F.lit(REPORT_NAME_PREFIX), F.col("p_brand")).alias("report_name"),
                    F.col("p_partkey").cast("string").alias("page_id"),
                    F.col("p_name").alias("page_name"),
                    "page_ordinal",
                    F.lit(pulled_at).cast("timestamp_ntz").alias("catalog_pulled_at"),
                    "report_total_pages",
                ))

    # -- facts -----------------------------------------------------------
    def raw_page_events(self) -> DataFrame:
        """Raw 'Report page views' rows: one per lineitem.

        Join order keeps the biggest input moving once: orders⋈customer
        (both keyed by custkey) first, then lineitem⋈that on orderkey, then
        the page keys on partkey.  AQE turns any side that proves small at
        run time into a broadcast and splits skewed partitions.
        """
        li = self.fact_table("lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
        o = self.fact_table("orders", "o_orderkey", "o_custkey")
        c = self.table("customer").select("c_custkey", "c_name", "c_mktsegment")
        ou = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_name", "c_mktsegment")
        ev = li.join(ou, li.l_orderkey == ou.o_orderkey).join(
            self._page_keys(), F.col("l_partkey") == F.col("p_partkey"))
        return ev.select(
            "workspace_id", "report_id", "page_id",
            F.col("l_shipdate").cast("date").alias("view_date"),
            F.concat(F.col("c_name"), F.lit(UPN_DOMAIN)).alias("user_upn"),
            F.col("l_quantity").cast("bigint").alias("views"),
            (F.col("l_linenumber") * 10).cast("double").alias("dwell_seconds"),
            F.col("c_mktsegment").alias("persona"),
            F.col("l_orderkey").cast("string").alias("visit_id"),
        )

    def report_visits(self, events: DataFrame | None = None) -> DataFrame:
        """Raw 'Report views': one row per (report, visit, day); visits = 1,
        session_seconds = summed dwell of the visit's page views."""
        ev = events if events is not None else self.raw_page_events()
        return (ev.groupBy("workspace_id", "report_id", "visit_id", "view_date", "user_upn")
                .agg(F.sum("dwell_seconds").alias("session_seconds"))
                .withColumn("visits", F.lit(1).cast("bigint")))

    # -- side tables -----------------------------------------------------
    def workspace_owners(self) -> DataFrame:
        """Owners: nations with n_nationkey < 7 own workspace 'ws-'||n_regionkey."""
        n = self.table("nation").filter(F.col("n_nationkey") < 7)
        return n.select(
            F.concat(F.lit(WORKSPACE_PREFIX), F.col("n_regionkey").cast("string")).alias("workspace_id"),
            F.concat(F.lower("n_name"), F.lit(UPN_DOMAIN)).alias("owner_upn"),
            F.col("n_name").alias("owner_name"),
        )

    def people(self) -> DataFrame:
        """Governed people lookup: UPN -> display name (and department)."""
        c = self.table("customer").select("c_name", "c_mktsegment")
        return c.select(F.concat(F.col("c_name"), F.lit(UPN_DOMAIN)).alias("upn"),
                        F.col("c_name").alias("display_name"),
                        F.col("c_mktsegment").alias("department"))

    def workspace_units(self) -> DataFrame:
        """Business unit of a workspace: 'BU-' || regionkey modulo 3."""
        r = self.table("region")
        return r.select(F.concat(F.lit(WORKSPACE_PREFIX), F.col("r_regionkey").cast("string")).alias("workspace_id"),
                        F.concat(F.lit(UNIT_PREFIX), F.pmod("r_regionkey", F.lit(3)).cast("string")).alias("business_unit"))

    def unit_members(self) -> DataFrame:
        """Members of the units: every nation is in the one of its region, and the
        owners (n_nationkey < 7) are in 'BU-' || nationkey modulo 2 as well."""
        n = self.table("nation")
        upn = F.concat(F.lower("n_name"), F.lit(UPN_DOMAIN)).alias("member_upn")
        by_region = n.select(F.concat(F.lit(UNIT_PREFIX), F.pmod("n_regionkey", F.lit(3)).cast("string")).alias("business_unit"), upn)
        owners = n.filter(F.col("n_nationkey") < 7).select(
            F.concat(F.lit(UNIT_PREFIX), F.pmod("n_nationkey", F.lit(2)).cast("string")).alias("business_unit"), upn)
        return by_region.unionByName(owners)

    def collection_errors(self) -> DataFrame:
        """Failures that the collection met: the ``error`` events of the last day of ``events``."""
        e = self.table("events").select("event_id", "ts", "event_type")
        last = e.select(F.max(F.to_date("ts"))).scalar()
        return e.filter((F.col("event_type") == "error") & (F.to_date("ts") == last)).select(
            F.concat(F.lit("event "), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("scope"),
            F.col("event_type").alias("error"))

    def runs_scope(self) -> DataFrame:
        """Run log (scope): per day of ``events`` its events as reports, its users as workspaces."""
        e = self.table("events").select("ts", "user_id")
        return e.groupBy(F.to_date("ts").alias("run_date")).agg(
            F.count(F.lit(1)).alias("reports"), F.count_distinct("user_id").alias("workspaces"))

    def runs_from_events(self) -> DataFrame:
        """Run log (quality): one run per day of ``events``."""
        e = self.table("events").select("ts", "event_type")
        return (e.groupBy(F.to_date("ts").alias("run_date"))
                .agg(F.count(F.lit(1)).alias("reports"),
                     F.count(F.when(F.col("event_type") == "error", 1)).alias("errors"),
                     F.max("ts").alias("ended_at")))

    def runs_from_volume(self) -> DataFrame:
        """Run log (row volume): one run per view_date, rows = raw events that day."""
        li = self.table("lineitem").select(F.col("l_shipdate").cast("date").alias("run_date"))
        return li.groupBy("run_date").agg(F.count(F.lit(1)).alias("rows"))
