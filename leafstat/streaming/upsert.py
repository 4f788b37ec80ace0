"""K3: MERGE semantics on Parquet tables partitioned by day.

matched key -> the incoming row replaces it; unmatched -> inserted; every
other row is untouched.  Without a MERGE-capable table format this is:
land the batch (it is evaluated once), read only the ``view_date`` partitions
it touches, drop the rows it replaces (left anti join on the key), add it, and
exchange just those partitions by a redo log (``sources.days``): a failed job
leaves the table as it was or is finished by the next change.

Late upstream corrections are handled by re-pulling a window and upserting
it; no watermark semantics are claimed.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafstat import schemas as sch
from leafstat.session import scratch_dir
from leafstat.sources import days, paths, versions
from leafstat.sources.files import path_exists, read_table, write_schema_version


class DuplicateKeyError(ValueError):
    pass


def landed_batch(batch: DataFrame, table: str) -> tuple[DataFrame, str]:
    """The batch with the table's columns, written once to the shared folder, and its path."""
    spark = batch.sparkSession
    path = scratch_dir(spark, f"batch-{uuid.uuid4().hex}")
    rows = batch.select(*[F.col(f.name).cast(f.dataType) for f in sch.SILVER[table].fields])
    rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(sch.SILVER[table]).parquet(path), path


def upsert(batch: DataFrame, root: str, table: str, check_duplicates: bool = True, stream: str | None = None,
           epoch: int = -1) -> int:
    """Upsert ``batch`` into the Parquet table ``root/table``; returns the number
    of touched partitions.

    With ``stream`` and ``epoch`` the table remembers the last epoch it holds,
    so a replayed one changes nothing and returns 0.  A batch row without a
    day has no partition and is refused.
    """
    spark = batch.sparkSession
    keys, part = sch.KEYS[table], sch.PARTITION_COL[table]
    path = versions.current(spark, f"{root.rstrip('/')}/{table}")
    days.recover(spark, path)
    if stream is not None and epoch <= days.applied_epoch(spark, path, stream):
        return 0
    b, landed = landed_batch(batch, table)
    try:
        # The touched days: one row a day in the batch, small by construction.
        touched = [r[0] for r in b.select(part).distinct().collect()]
        if None in touched:
            raise ValueError(f"batch for {table} has rows without {part}")
        if check_duplicates and touched and not b.groupBy(*keys).count().filter(F.col("count") > 1).isEmpty():
            raise DuplicateKeyError(f"batch for {table} has duplicate keys on {keys}")
        if not touched:
            return 0
        merged = b
        if path_exists(spark, path):
            old = read_table(spark, root, table).filter(F.col(part).isin(touched))
            # Keys are compared null-safe, so an upsert applied twice is the same as once.
            same = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys]
            new = b.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
            merged = old.join(new, same, "left_anti").unionByName(b)
        days.replace_days(merged, path, part, keys, touched, stream, epoch)
        write_schema_version(spark, path)
        return len(touched)
    finally:
        paths.delete(spark, landed)


def latest_per_key(batch: DataFrame, table: str, order_cols: list[str]) -> DataFrame:
    """Keep one row per key: the one with the greatest ``order_cols`` (e.g. the
    most recently landed file when one micro-batch holds several runs)."""
    cols = sch.SILVER[table].fieldNames()
    keys = sch.KEYS[table]
    rest = [c for c in cols if c not in keys]
    pick = F.max_by(F.struct(*rest), F.struct(*order_cols)).alias("_r")
    return batch.groupBy(*keys).agg(pick).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def foreach_batch_upsert(root: str, table: str, order_cols: list[str] | None = None, stream: str | None = None):
    """A ``foreachBatch`` sink: ``stream.writeStream.foreachBatch(foreach_batch_upsert(root, t))``.
    With ``order_cols`` a batch holding several versions of a key keeps the
    latest; without, duplicate keys in a batch are an error.  With ``stream``,
    a name that stays with the query's checkpoint, a replayed epoch is skipped."""
    def sink(batch_df: DataFrame, epoch_id: int) -> None:
        b = latest_per_key(batch_df, table, order_cols) if order_cols else batch_df
        upsert(b, root, table, stream=stream, epoch=epoch_id)
    return sink


def stream_landed_silver(spark, landing: str, root: str, table: str, checkpoint: str, available_now=True):
    """Stream landed silver files (one folder per run) into the table with upserts;
    when a micro-batch picks up several runs, the most recently landed file wins."""
    reader = (spark.readStream.schema(sch.SILVER[table]).parquet(landing)
              .select("*", F.col("_metadata.file_modification_time").alias("_landed_at"),
                      F.col("_metadata.file_path").alias("_landed_file")))
    sink = foreach_batch_upsert(root, table, ["_landed_at", "_landed_file"],
                                hashlib.sha256(checkpoint.encode()).hexdigest()[:16])
    w = (reader.writeStream.foreachBatch(sink)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()
