"""Shared building blocks for the query operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafstat import schemas as sch


def latest(name: str, order: str = "view_date") -> Column:
    """The name on the latest row, ties broken by the name itself."""
    return F.max_by(F.col(name), F.struct(F.col(order), F.col(name))).alias(name)


_MERGED = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
_FIRST = {**_MERGED, "count": F.count}


def with_latest(df: DataFrame, keys: list[str], attrs: list[str], order: str = "view_date", at: str | None = None,
                **totals: tuple[str, Column | str]) -> DataFrame:
    """Per key the latest value of each of ``attrs`` (T13) and the ``totals``, given as
    out=(sum | count | min | max, column); ``at`` names the last ``order`` seen.

    The rows are aggregated on key and attributes together, so their buffers are
    numbers and dates and Spark hashes them; the values are picked from what is left,
    a row for each value a key ever had.
    """
    per = df.groupBy(*keys, *attrs).agg(F.max(order).alias("_at"),
                                        *[_FIRST[f](c).alias(out) for out, (f, c) in totals.items()])
    return per.groupBy(*keys).agg(*[latest(a, "_at") for a in attrs],
                                  *[_MERGED[f](out).alias(out) for out, (f, _) in totals.items()],
                                  *([F.max("_at").alias(at)] if at else []))


def page_totals(pv: DataFrame) -> DataFrame:
    """Per page (composite key, T8): views, peak users, dwell parts, first/last seen."""
    t = with_latest(
        pv, sch.PAGE_KEY,
        ["workspace_name", "report_name", "capacity_name", "page_name", "page_ordinal", "report_total_pages"],
        views=("sum", "view_count"), users_peak=("max", "unique_users"), user_days=("sum", "unique_users"),
        dwell_weighted_sum=("sum", F.col("view_count") * F.col("avg_dwell_seconds")),
        _dwell=("sum", "avg_dwell_seconds"), _dwells=("count", "avg_dwell_seconds"),
        first_seen=("min", "view_date"), last_seen=("max", "view_date"))
    return t.withColumn("avg_dwell_unweighted", F.try_divide("_dwell", "_dwells")).drop("_dwell", "_dwells")


REPORT_ATTRS = ["workspace_name", "report_name", "capacity_name", "report_total_pages"]


def report_attrs(pv: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Per report (ids): latest names, capacity and total pages from the facts, or from
    page_totals(pv) when the caller has them: the latest of the pages' latest ones."""
    if totals is None:
        return with_latest(pv, sch.REPORT_KEY, REPORT_ATTRS)
    return totals.groupBy(*sch.REPORT_KEY).agg(*[latest(a, "last_seen") for a in REPORT_ATTRS])


def explode_range(df: DataFrame, lo: str, hi: str, out: str, keys: list[str] | None = None,
                  chunk: int = 65536) -> DataFrame:
    """One row per integer in [lo, hi] for every input row.

    A single ``explode(sequence(lo, hi))`` makes one task generate the whole
    range of a big row; here ranges are first cut into chunks, the chunks
    are spread over the cluster, and each chunk is expanded where it lands.
    """
    c = df.withColumn("_xr_k", F.explode(F.sequence(
        F.lit(0).cast("bigint"),
        F.floor((F.col(hi).cast("bigint") - F.col(lo).cast("bigint")) / F.lit(chunk)).cast("bigint"))))
    c = c.filter(F.col(hi) >= F.col(lo)).repartition("_xr_k", *(keys or [lo, hi]))
    start = F.col(lo).cast("bigint") + F.col("_xr_k") * F.lit(chunk)
    end = F.least(start + F.lit(chunk - 1), F.col(hi).cast("bigint"))
    return c.withColumn(out, F.explode(F.sequence(start, end))).drop("_xr_k")
