"""Day partitions replaced by a redo log.

A change of some days is staged whole first: the new content of every touched
day, written once by one Spark job.  Then a small plan of the swap is made
durable, and only then are the day folders exchanged, one rename a day.  A
change that dies before its plan left nothing; one that dies after it is
finished by ``recover``, which every later change of the table runs first.
Each step can be repeated.  Between the plan and the last rename a reader may
see old and new days side by side, but no day half written.

    <table>/_stage/<id>/<day>=.../...     the new content
    <table>/_plans/<id>.json              days to exchange, days to empty, epoch
    <table>/_epochs/<stream>.<epoch>      last change applied for a stream
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafstat.session import write_tasks
from leafstat.sources import paths

STAGE, PLANS, EPOCHS = "_stage", "_plans", "_epochs"


def _epoch_names(spark: SparkSession, table: str, stream: str) -> list[str]:
    return [n for n in paths.names(spark, paths.under(table, EPOCHS)) if n.rsplit(".", 1)[0] == stream]


def applied_epoch(spark: SparkSession, table: str, stream: str) -> int:
    """The last epoch of a stream that the table holds; -1 before the first."""
    return max((int(n.rsplit(".", 1)[1]) for n in _epoch_names(spark, table, stream)), default=-1)


def _note_epoch(spark: SparkSession, table: str, stream: str, epoch: int) -> None:
    before = _epoch_names(spark, table, stream)
    name = f"{stream}.{epoch:020d}"
    if name not in before:
        paths.mark(spark, paths.under(table, EPOCHS, name))
    for old in before:
        if old != name:
            paths.delete(spark, paths.under(table, EPOCHS, old))


def _apply(spark: SparkSession, table: str, change: str) -> None:
    plan = json.loads(paths.read_text(spark, paths.under(table, PLANS, f"{change}.json"), 1 << 26))
    for day in plan["days"]:
        staged, live = paths.under(table, STAGE, change, day), paths.under(table, day)
        if paths.exists(spark, staged):                     # else it was exchanged before
            paths.delete(spark, live)
            paths.move(spark, staged, live)
    for day in plan["emptied"]:
        paths.delete(spark, paths.under(table, day))
    if plan["stream"] is not None:
        _note_epoch(spark, table, plan["stream"], plan["epoch"])
    paths.delete(spark, paths.under(table, PLANS, f"{change}.json"))
    paths.delete(spark, paths.under(table, STAGE, change))


def recover(spark: SparkSession, table: str) -> int:
    """Finish the changes of a table whose plan was made; returns how many."""
    left = [n[:-5] for n in paths.names(spark, paths.under(table, PLANS)) if n.endswith(".json")]
    for change in left:
        _apply(spark, table, change)
    return len(left)


def replace_days(rows: DataFrame, table: str, part: str, keys: list[str], touched: list, stream: str | None = None,
                 epoch: int = -1) -> None:
    """Replace the days ``touched`` of the partitioned Parquet folder ``table``
    by ``rows``, which may read them: a touched day without rows is emptied.

    Rows are clustered by (day, key), so a day's files follow its size, not
    the number of tasks, and a large day is still written by several tasks.
    """
    spark = rows.sparkSession
    change = uuid.uuid4().hex
    stage = paths.under(table, STAGE, change)
    (rows.repartitionByRange(write_tasks(spark), F.col(part), *[F.col(k) for k in keys if k != part])
     .write.mode("overwrite").partitionBy(part).parquet(stage))
    there = [n for n in paths.names(spark, stage) if n.startswith(f"{part}=")]
    emptied = sorted({f"{part}={d}" for d in touched} - set(there))
    paths.write_text(spark, paths.under(table, PLANS, f"{change}.json"),
                     json.dumps({"days": there, "emptied": emptied, "stream": stream, "epoch": epoch}))
    _apply(spark, table, change)
