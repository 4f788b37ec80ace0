"""Governance operators."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafstat import schemas as sch
from leafstat.functions.scalars import hash_user

HASH_PATTERN = r"^([0-9a-f]{16})?$"


def retain_silver(facts: DataFrame, as_of: _dt.date, days: int = 90, col: str = "view_date") -> DataFrame:
    """Keep facts with view_date >= as_of - days (day as_of-90 is kept: 91 days)."""
    return facts.filter(F.col(col) >= F.lit(as_of - _dt.timedelta(days=days)))


def forget_user(user_views: DataFrame, upn: str) -> DataFrame:
    """The user-day facts without one person's rows (hash of the UPN via X1);
    rows without a hash stay."""
    return user_views.filter(~F.col("user_id_hash").eqNullSafe(F.lit(_hash_of(user_views.sparkSession, upn))))


def _hash_of(spark: SparkSession, upn: str) -> str:
    """The stored hash of one person; a blank UPN names nobody, and its hash
    would be that of every blank user, so it is refused."""
    h = spark.range(1).select(hash_user(F.lit(upn)).alias("h")).first()["h"]
    if not h or not upn.strip():
        raise ValueError("erasure needs a non-blank UPN")
    return h


def forget_user_in_table(spark: SparkSession, root: str, upn: str, table: str = "user_views") -> int:
    """G3 on storage: rewrite only the day partitions that hold the person's
    hash, without their rows (by the redo log of ``sources.days``); returns the
    number of rewritten days.  Gold tables are rebuilt from silver afterwards."""
    from leafstat.sources import days as dy
    from leafstat.sources import versions
    from leafstat.sources.files import path_exists, read_table, write_schema_version
    path = versions.current(spark, f"{root.rstrip('/')}/{table}")
    if not path_exists(spark, path):
        return 0
    dy.recover(spark, path)
    part = sch.PARTITION_COL[table]
    h = _hash_of(spark, upn)
    t = read_table(spark, root, table)
    # One value per day, bounded by the calendar.
    days = [r[0] for r in t.filter(F.col("user_id_hash") == F.lit(h)).select(part).distinct().collect()]
    if not days:
        return 0
    kept = t.filter(F.col(part).isin(days) & ~F.col("user_id_hash").eqNullSafe(F.lit(h)))
    # A day that held only this person's rows is emptied.
    dy.replace_days(kept, path, part, sch.KEYS[table], days)
    write_schema_version(spark, path)
    return len(days)


def pii_guard(user_views: DataFrame) -> DataFrame:
    """Hashes that are not 16 lowercase hex chars (blank allowed), or contain '@'."""
    bad = ~F.col("user_id_hash").rlike(HASH_PATTERN) | F.col("user_id_hash").contains("@")
    return user_views.agg(F.count(F.when(bad, 1)).alias("violations"),
                          F.count(F.lit(1)).alias("rows_checked"))


def grain_check(tables: dict[str, DataFrame]) -> DataFrame:
    """Number of duplicated keys per silver table (0 = grain holds)."""
    parts = []
    for name, df in tables.items():
        keys = sch.KEYS[name]
        d = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
             .agg(F.count(F.lit(1)).alias("duplicate_keys")))
        parts.append(d.select(F.lit(name).alias("table_name"), "duplicate_keys"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rollup_consistency(report_views: DataFrame, page_views: DataFrame) -> DataFrame:
    """G5 (second rule): report-days whose views are below the busiest page that
    day - must be empty when report_views is the A4 roll-up."""
    mx = page_views.groupBy(*sch.REPORT_KEY, "view_date").agg(F.max("view_count").alias("max_page_views"))
    return (report_views.select(*sch.REPORT_KEY, "view_date", "view_count").join(mx, [*sch.REPORT_KEY, "view_date"])
            .filter(F.col("view_count") < F.col("max_page_views")))


def stale_catalog(catalog: DataFrame, run_date: _dt.date, max_age_days: int = 0) -> DataFrame:
    """Per report, the latest catalog pull and its age in days at the run date."""
    g = catalog.groupBy(*sch.REPORT_KEY).agg(F.max("catalog_pulled_at").alias("last_pulled_at"))
    age = F.datediff(F.lit(run_date), F.to_date("last_pulled_at"))
    return g.select(*sch.REPORT_KEY, "last_pulled_at", age.alias("days_since_pull"),
                    (age > max_age_days).alias("is_stale"))


def bronze_partitions_to_drop(spark: SparkSession, root: str, today: _dt.date, days: int = 90) -> list[str]:
    """G1: ``dt=`` partition folders of a bronze feed older than today - days."""
    cutoff = (today - _dt.timedelta(days=days)).isoformat()
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        return []
    out = []
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("dt=") and name[3:] < cutoff:
            out.append(st.getPath().toString())
    return sorted(out)


def retain_bronze(spark: SparkSession, root: str, today: _dt.date, days: int = 90) -> list[str]:
    """G1: delete the ``dt=`` partitions older than the cut-off; returns what was dropped."""
    dropped = bronze_partitions_to_drop(spark, root, today, days)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in dropped:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        hp.getFileSystem(conf).delete(hp, True)
    return dropped


def retain_bronze_table(spark: SparkSession, name: str, today: _dt.date, days: int = 90, part: str = "dt") -> list[str]:
    """G1 on a catalog table: drop the day partitions older than the cut-off.
    Only partition metadata and whole folders change, no row is read."""
    cutoff = (today - _dt.timedelta(days=days)).isoformat()
    have = [r[0].split("/")[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    old = sorted({d for d in have if d < cutoff})
    if old:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS " + ", ".join(f"PARTITION ({part} = '{d}')" for d in old))
    return old


def write_bronze_table(df: DataFrame, name: str, run_date: _dt.date, part: str = "dt") -> None:
    """K1 on a catalog table: the run's day partition is replaced, other days stay.
    An empty run clears its day, which overwriting by rows alone would not."""
    spark = df.sparkSession
    rows = df.withColumn(part, F.lit(run_date.isoformat()))
    if not spark.catalog.tableExists(name):
        rows.write.format("parquet").partitionBy(part).saveAsTable(name)
        return
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({part} = '{run_date.isoformat()}')")
    rows.select(*spark.table(name).columns).write.mode("append").insertInto(name)
