"""Running totals inside groups without putting a whole group in one task.

A plain ``sum().over(Window.partitionBy(g).orderBy(o))`` sends every row of a
group to one task; a report holding a third of all pages would then run on a
single core.  Here the rows are range-partitioned on (group, order), so a hot
group is cut into contiguous chunks that land in different partitions.  Each
chunk computes a local running total; the chunk sums (one row per chunk, at
most partitions + groups rows) are prefix-summed per group and joined back as
an offset.  Row number = running total of 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_totals(df: DataFrame, group_cols: list[str], order_cols: list, values: dict,
                   group_totals: dict | None = None, num_partitions: int | None = None) -> DataFrame:
    """Add one running-sum column per ``values`` entry ({out: column or None=1})
    within ``group_cols`` ordered by ``order_cols`` (unique inside a group),
    and ``group_totals`` ({out: source out name}) = the group's full sums.

    Rows whose group keys are NULL form a group of their own.
    """
    spark = df.sparkSession
    order = [F.col(o) if isinstance(o, str) else o for o in order_cols]
    names = list(values)
    t = df
    for i, (out, v) in enumerate(values.items()):
        if v is None:
            v = F.lit(1).cast("long")
        elif isinstance(v, str):
            v = F.col(v)
        t = t.withColumn(f"_rt_v{i}", v)
    # Without a count AQE starts from its initial partition number, which
    # ``session.size_shuffles`` raises with the input, and merges neighbouring
    # ranges up to its advisory size: the chunks follow the bytes that arrive.
    # The partition id is then frozen with a reliable checkpoint (written to
    # the shared spark.checkpoint.dir): both branches below read the same
    # assignment even if a branch is recomputed after an executor loss, and
    # range bounds sampled from a shuffled input cannot differ between them.
    # ``get_spark`` has Spark remove the checkpoint's files when the result
    # is no longer referenced.
    by = [*[F.col(g) for g in group_cols], *order]
    ranged = t.repartitionByRange(num_partitions, *by) if num_partitions else t.repartitionByRange(*by)
    t = ranged.withColumn("_rt_pid", F.spark_partition_id())
    from leafstat.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    t = t.checkpoint(eager=True)
    local_w = (Window.partitionBy("_rt_pid", *group_cols).orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    for i in range(len(names)):
        t = t.withColumn(f"_rt_l{i}", F.sum(f"_rt_v{i}").over(local_w))
    chunks = t.groupBy("_rt_pid", *group_cols).agg(
        *[F.sum(f"_rt_v{i}").alias(f"_rt_c{i}") for i in range(len(names))])
    before = (Window.partitionBy(*group_cols).orderBy("_rt_pid")
              .rowsBetween(Window.unboundedPreceding, -1))
    whole = Window.partitionBy(*group_cols)
    for i in range(len(names)):
        chunks = chunks.withColumn(f"_rt_o{i}", F.coalesce(F.sum(f"_rt_c{i}").over(before), F.lit(0)))
    for out, src in (group_totals or {}).items():
        chunks = chunks.withColumn(out, F.sum(f"_rt_c{names.index(src)}").over(whole))
    chunks = chunks.drop(*[f"_rt_c{i}" for i in range(len(names))])
    chunks = chunks.select(*[F.col(c).alias(f"_rt_g{i}") if c in group_cols else F.col(c)
                             for i, c in enumerate(chunks.columns)])
    keys = [F.col(c).eqNullSafe(F.col(f"_rt_g{i}")) for i, c in enumerate(["_rt_pid", *group_cols]) if i]
    chunks = chunks.withColumnRenamed("_rt_pid", "_rt_cpid")
    on = F.col("_rt_pid") == F.col("_rt_cpid")
    for k in keys:
        on = on & k
    res = t.join(chunks, on).drop("_rt_cpid", *[f"_rt_g{i}" for i in range(1, len(group_cols) + 1)])
    for i, out in enumerate(names):
        res = res.withColumn(out, F.col(f"_rt_l{i}") + F.col(f"_rt_o{i}"))
    drop = ["_rt_pid"] + [f"_rt_{k}{i}" for i in range(len(names)) for k in ("v", "l", "o")]
    return res.drop(*drop)


def running_total(df: DataFrame, group_cols: list[str], order_cols: list, value=None,
                  out: str = "running_total", group_total: str | None = None,
                  num_partitions: int | None = None) -> DataFrame:
    """Single running sum (default: of 1, i.e. a row number)."""
    return running_totals(df, group_cols, order_cols, {out: value},
                          {group_total: out} if group_total else None, num_partitions)


def ordinal(df: DataFrame, group_cols: list[str], order_cols: list, out: str = "ordinal",
            group_total: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """Distributed ROW_NUMBER() (INT) within each group."""
    res = running_total(df, group_cols, order_cols, None, out, group_total, num_partitions)
    res = res.withColumn(out, F.col(out).cast("int"))
    if group_total:
        res = res.withColumn(group_total, F.col(group_total).cast("int"))
    return res
