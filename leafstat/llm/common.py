"""Helpers shared by the corpus operators: landed tables and global row numbers."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafstat.session import scratch_dir

# White space of the word rule: the space and the code points 9 to 13.
WORD_GAP = "[\\x20\\x09-\\x0D]+"
_ROW_BITS = 33          # monotonically_increasing_id keeps the row in its low 33 bits
ROWS_PER_RANGE = 2_000_000
SALTS = 32                 # tasks that share the rows of one large group, at most


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package where they would not find it:
    neither on PYTHONPATH nor in the working folder."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or any(os.path.realpath(p or ".") == os.path.realpath(root) for p in known):
        return
    _SHIPPED.add(app)
    to = os.path.join(tempfile.mkdtemp(prefix="leafstat-ship-"), "leafstat")
    spark.sparkContext.addPyFile(shutil.make_archive(to, "zip", root, "leafstat"))


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text, in order; no element is empty."""
    return F.array_remove(F.split(text, WORD_GAP), "")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one that ``spark.checkpoint.dir`` names."""
    return scratch_dir(spark, f"llm-{name}-{uuid.uuid4().hex}")


_LANDED: list[str] = []    # folders that ``landed`` wrote and nobody removed yet


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    The lineage ends there, so a lost executor costs only its own tasks, and
    every reader sees the same rows, also those that depend on the partition.
    The folder stays until ``release`` removes it.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    _LANDED.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def landed_so_far() -> int:
    """A mark for ``release``: what is landed from here on."""
    return len(_LANDED)


def release(spark: SparkSession, since: int = 0, keep: int = 0) -> int:
    """Remove the folders landed after the mark ``since``, but for the last
    ``keep`` of them; returns how many.  For callers that have written the
    results made from them: a DataFrame that still reads them ends here.
    """
    gone = _LANDED[since:len(_LANDED) - keep]
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in gone:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)
    del _LANDED[since:len(_LANDED) - keep]
    return len(gone)


def salt(col: Column, salts: int = SALTS) -> Column:
    """One of ``salts`` numbers by the hash of ``col``."""
    return F.pmod(F.xxhash64(col), F.lit(salts)).cast("int")


def with_group_value(rows: DataFrame, keys: list[str], by: str, value: Column, merge, out: str) -> DataFrame:
    """``rows`` with ``out``: an aggregate of their group, without one task for a large group.

    ``value`` aggregates the rows of a group that share a salt of column
    ``by``, ``merge`` those salts' values.  The join back is by group and
    salt, so a group of any size is met by up to SALTS tasks.
    """
    salted = rows.withColumn("_salt", salt(F.col(by)))
    part = salted.groupBy(*keys, "_salt").agg(value.alias("_v"))
    whole = part.groupBy(*keys).agg(merge("_v").alias(out))
    return salted.join(part.drop("_v").join(whole, keys), [*keys, "_salt"]).drop("_salt")


def size_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Rows in an Arrow batch, where the session names none: texts are long,
    and a Python worker holds one batch at a time."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, str(rows))


def marked_trusted(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with ``_trusted``: whether the row's id is one of ``trusted``, all of which count.

    The ids grow with the labels, so they are not broadcast: rows and ids meet
    by one shuffle, and a task holds the ids of its share.
    """
    ids = trusted.select(F.col(id_col).cast("long").alias("_t_id")).where("_t_id IS NOT NULL").distinct()
    return (docs.join(ids.hint("shuffle_hash"), F.col(id_col).cast("long") == F.col("_t_id"), "left")
            .withColumn("_trusted", F.col("_t_id").isNotNull()).drop("_t_id"))


def range_partitions(spark: SparkSession, rows: int) -> int:
    """Partitions for a range sort of ``rows`` thin rows: they grow with the rows."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_RANGE))


def numbered(df: DataFrame, order: list[Column], out: str, name: str, rows: int | None = None) -> DataFrame:
    """Add the global row number (LONG, from 0) of ``df`` in ``order``.

    ``df`` is a thin, landed table.  Its rows are range-partitioned, so no
    key or task gets a group whole; the row's place inside its range is
    frozen by landing, and the row counts of the ranges (one row per
    partition, hence the broadcast) give the offsets.  Rows that tie in
    ``order`` must be interchangeable or told apart by its last columns.
    """
    spark = df.sparkSession
    rows = df.count() if rows is None else rows
    ranged = (df.repartitionByRange(range_partitions(spark, rows), *order).sortWithinPartitions(*order)
              .withColumn("_nr_mid", F.monotonically_increasing_id()))
    ranged = landed(ranged, name)
    ranged = (ranged.withColumn("_nr_part", F.shiftright("_nr_mid", _ROW_BITS))
              .withColumn("_nr_row", F.col("_nr_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))))
    counts = sorted((r[0], r[1]) for r in ranged.groupBy("_nr_part").count().collect())
    starts, before = [], 0
    for part, count in counts:
        starts.append((part, before))
        before += count
    offsets = spark.createDataFrame(starts, "_nr_part long, _nr_before long")
    return (ranged.join(F.broadcast(offsets), "_nr_part")
            .withColumn(out, F.col("_nr_row") + F.col("_nr_before"))
            .drop("_nr_mid", "_nr_part", "_nr_row", "_nr_before"))
