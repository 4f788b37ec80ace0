"""Silver/bronze file I/O.

Parquet is the storage format (facts partitioned by ``view_date``, see ``days``;
tables without days are committed as versions, see ``versions``); the
CSV form with a ``# silver_schema_version=`` preamble is kept as an export
and an import path.  Every reader takes an explicit schema - CSV type
inference would turn all-digit hashes into numbers.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafstat import schemas as sch
from leafstat.session import write_tasks
from leafstat.sources import days, paths, versions

# Fixed value: the preamble line that carries the schema version.
PREAMBLE = "# silver_schema_version="
VERSION_PROPERTY = "silver_schema_version"
VERSION_DIR = "_schema_version"  # sidecar of a Parquet table; '_' keeps readers away
_ROW_OF_TASK = (1 << 33) - 1     # monotonically_increasing_id keeps a task's row number in these bits
_SEMVER = re.compile(r"^(\d+)\.(\d+)\.(\d+)$")


class SchemaVersionError(RuntimeError):
    pass


def _join(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _blank_strings(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Spark's CSV reader turns '' into NULL; the silver contract uses ''."""
    return df.select(*[F.coalesce(F.col(f.name), F.lit("")).alias(f.name)
                       if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in schema.fields])


# -- CSV --------------------------------------------------------------------
def read_silver_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed read of a silver CSV: preamble skipped, header row, UTF-8,
    RFC-4180 doubled quotes, quoted newlines.

    Columns are found by their header names: their order does not matter, an
    added one is left out, a missing one is an error.  A malformed value fails
    the job that reads it."""
    df = (spark.read.option("header", True).option("comment", "#")
          .option("escape", '"').option("quote", '"').option("multiLine", True)
          .option("encoding", "UTF-8").option("mode", "FAILFAST").csv(path))
    if not df.columns:                      # nothing beside the preamble
        return spark.createDataFrame([], schema)
    missing = [n for n in schema.fieldNames() if n not in df.columns]
    if missing:
        raise SchemaVersionError(f"{path} lacks the columns {missing}")
    return _blank_strings(df.select(*[_typed(f) for f in schema.fields]), schema)


def _typed(f: T.StructField):
    """A CSV column as its declared type.  X8: a timestamp may carry an offset
    or ``Z``; it is kept as the UTC wall-clock time."""
    c = F.nullif(F.col(f.name), F.lit(""))
    if isinstance(f.dataType, T.TimestampNTZType):
        zoned = c.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
        utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.when(zoned, c).cast("timestamp").cast("timestamp_ntz"))
        return F.when(zoned, utc).otherwise(F.when(~zoned, c).cast("timestamp_ntz")).alias(f.name)
    return c.cast(f.dataType).alias(f.name)


def write_silver_csv(df: DataFrame, path: str, schema: T.StructType | None = None,
                     version: str = sch.SILVER_SCHEMA_VERSION) -> None:
    """K2 (CSV export): every part file starts with the version preamble and a
    header row.  Lines are rendered with ``to_csv``; a task's first line carries
    the two fixed lines before it, so no row leaves the JVM."""
    schema = schema or df.schema
    cols = [f.name for f in schema.fields]
    opts = {"escape": '"', "quote": '"', "dateFormat": "yyyy-MM-dd",
            "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss", "nullValue": ""}
    head = F.lit(f"{PREAMBLE}{version}\n{','.join(cols)}")
    first = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_OF_TASK)) == 0
    line = F.to_csv(F.struct(*[F.col(c) for c in cols]), opts)
    lines = df.select(F.when(first, F.concat(head, F.lit("\n"), line)).otherwise(line).alias("value"))
    # A part with the two lines alone makes the export of an empty table readable.
    lines.unionByName(df.sparkSession.range(1, numPartitions=1).select(head.alias("value"))).write.mode("overwrite").text(path)


def csv_schema_versions(spark: SparkSession, path: str) -> list[str]:
    """S2 helper: the distinct versions found in the preamble lines.  The
    preamble is a file's first line, so only the start of each file is read."""
    heads = (paths.read_text(spark, f, 256).split("\n", 1)[0].rstrip("\r") for f in paths.files_below(spark, path))
    return sorted({h[len(PREAMBLE):].split(maxsplit=1)[0] for h in heads if h.startswith(PREAMBLE) and h[len(PREAMBLE):].strip()})


# -- Parquet ----------------------------------------------------------------
def write_schema_version(spark: SparkSession, table_path: str, version: str = sch.SILVER_SCHEMA_VERSION) -> None:
    spark.range(1).select(F.lit(version).alias("value")).coalesce(1).write.mode("overwrite").text(
        _join(versions.current(spark, table_path), VERSION_DIR))


def table_schema_versions(spark: SparkSession, table_path: str) -> list[str]:
    sidecar = _join(versions.current(spark, table_path), VERSION_DIR)
    if not path_exists(spark, sidecar):     # an unversioned table
        return []
    return sorted(r[0] for r in spark.read.text(sidecar).distinct().collect())


def assert_schema_version(found: list[str], expected: str = sch.SILVER_SCHEMA_VERSION,
                          minor_ok: bool = False) -> str:
    """Fail unless the found version equals the expected one (or, with
    ``minor_ok``, is a newer MINOR/PATCH of the same MAJOR)."""
    if len(found) != 1:
        raise SchemaVersionError(f"expected one schema version {expected}, found {found or 'none'}")
    v = found[0]
    if v == expected:
        return v
    if minor_ok:
        a, b = _SEMVER.match(v), _SEMVER.match(expected)
        if a and b and a.group(1) == b.group(1) and tuple(map(int, a.groups())) >= tuple(map(int, b.groups())):
            return v
    raise SchemaVersionError(f"schema version {v} != expected {expected}")


def write_table(df: DataFrame, root: str, table: str) -> str:
    """K2/K4: write one silver table whole, as Parquet with its fixed schema.  An empty
    DataFrame still yields a readable table.

    A table without days goes to a new version folder that is committed at the
    end.  Facts are partitioned by day; where the table exists, its days are
    exchanged by the redo log (``days``), those without rows here emptied.
    Either way ``df`` may read the table that it replaces, and a write that
    fails leaves the old rows.
    """
    spark, schema, path = df.sparkSession, sch.SILVER[table], _join(root, table)
    out = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    part = sch.PARTITION_COL.get(table)
    if not part:
        version, folder = versions.new_version(path)
        out.write.parquet(folder)
        write_schema_version(spark, folder)
        versions.commit(spark, path, version)
        return path
    days.recover(spark, path)
    there = [n.split("=", 1)[1] for n in paths.names(spark, path) if n.startswith(f"{part}=")]
    keys = [k for k in sch.KEYS[table] if k != part]
    if there:
        days.replace_days(out, path, part, keys, there)
    else:
        # Range-partition on (day, key): each task holds a contiguous run of
        # days, so files per day stay few, and a very large day is still
        # split over several tasks by the key columns.
        (out.repartitionByRange(write_tasks(spark), F.col(part), *[F.col(k) for k in keys])
         .write.mode("append").partitionBy(part).parquet(path))
    write_schema_version(spark, path)
    return path


def write_silver(tables: dict[str, DataFrame], root: str) -> dict[str, str]:
    """K2: all five conformed tables (K4 semantics for catalog/unused: whole replace)."""
    return {name: write_table(df, root, name) for name, df in tables.items()}


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    schema = sch.SILVER[table]
    df = spark.read.schema(schema).parquet(versions.current(spark, _join(root, table)))
    return df.select(*schema.fieldNames())


def load_table(spark: SparkSession, mode: str, location: str, table: str, minor_ok: bool = False) -> DataFrame:
    """The same five tables from a catalog table, a Parquet folder or a CSV export.
    S2: a stored version other than the expected one is refused."""
    schema = sch.SILVER[table]
    if mode == "table":
        assert_schema_version(catalog_schema_versions(spark, location), minor_ok=minor_ok)
        return spark.table(location).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    if mode == "parquet":
        assert_schema_version(table_schema_versions(spark, _join(location, table)), minor_ok=minor_ok)
        return read_table(spark, location, table)
    if mode == "csv":
        assert_schema_version(csv_schema_versions(spark, _join(location, table)), minor_ok=minor_ok)
        return read_silver_csv(spark, _join(location, table), schema)
    raise ValueError(f"unknown load mode {mode!r} (expected 'table', 'parquet' or 'csv')")


def write_catalog_table(df: DataFrame, name: str, table: str, version: str = sch.SILVER_SCHEMA_VERSION) -> None:
    """K2 to a table of the session's catalog, facts partitioned by day; the
    schema version is a table property."""
    spark, part = df.sparkSession, sch.PARTITION_COL.get(table)
    w = df.select(*[F.col(f.name).cast(f.dataType) for f in sch.SILVER[table].fields]).write.mode("overwrite").format("parquet")
    (w.partitionBy(part) if part else w).saveAsTable(name)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{VERSION_PROPERTY}' = '{version}')")


def catalog_schema_versions(spark: SparkSession, name: str) -> list[str]:
    """S2 helper: the version in a catalog table's properties."""
    return [r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect() if r["key"] == VERSION_PROPERTY]


def read_catalog_sidecar(spark: SparkSession, path: str) -> DataFrame:
    """Catalog CSV with report_total_pages."""
    return read_silver_csv(spark, path, sch.CATALOG_SIDECAR)


# -- bronze -------------------------------------------------------------------
def write_bronze(df: DataFrame, root: str, feed: str, run_date) -> str:
    """K1: replace only the ``dt=<run_date>`` partition of a feed; other days stay.
    The day's folder itself is overwritten, so a run without rows empties it.
    Rows are clustered by (workspace, report) inside the day's files."""
    path = _join(root, feed)
    (df.sortWithinPartitions("workspace_id", "report_id")
     .write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/dt={run_date}"))
    return path


def write_bronze_days(df: DataFrame, root: str, feed: str, day_col: str) -> str:
    """K1 for a backfill: every day's rows replace the ``dt=<day>`` partition of
    their run in one job; days without rows here stay.  Rows are clustered by
    (day, workspace, report), so a day is written by few tasks."""
    path = _join(root, feed)
    (df.withColumn("dt", F.date_format(day_col, "yyyy-MM-dd"))
     .repartitionByRange(write_tasks(df.sparkSession), "dt", "workspace_id", "report_id").sortWithinPartitions("dt", "workspace_id", "report_id")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(path))
    return path


def read_bronze(spark: SparkSession, root: str, feed: str, schema: T.StructType, run_date=None) -> DataFrame:
    """A landed feed with its ``dt``; with ``run_date`` that partition alone is listed
    and read, and a run that never landed has no rows."""
    path = _join(root, feed)
    typed = T.StructType([*schema.fields, T.StructField("dt", T.DateType())])
    if run_date is not None:
        day = f"{path}/dt={run_date}"
        if not path_exists(spark, day):
            return spark.createDataFrame([], typed)
        return spark.read.schema(typed).option("basePath", path).parquet(day)
    return spark.read.schema(typed).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], typed)


def export_unused_by_workspace(unused: DataFrame, path: str) -> None:
    """K8: one CSV folder per workspace for owner mail-outs, in display order.
    Rows are range-partitioned in that order: a task writes the few workspaces
    of its range, and a workspace with many pages is written by several tasks."""
    order = ["workspace_name", "report_name", "page_ordinal", "page_id"]
    (unused.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").option("header", True).option("escape", '"')
     .partitionBy("workspace_name").csv(path))


def path_exists(spark: SparkSession, path: str) -> bool:
    return paths.exists(spark, path)


def table_row_counts(spark: SparkSession, root: str, tables=tuple(sch.SILVER)) -> DataFrame:
    """K9: row count per silver table; missing tables are skipped."""
    parts = [read_table(spark, root, t).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(t).alias("table_name"), "row_count")
             for t in tables if path_exists(spark, _join(root, t))]
    if not parts:
        return spark.createDataFrame([], "table_name string, row_count bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
