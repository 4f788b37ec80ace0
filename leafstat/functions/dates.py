"""Date windows."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_DAYS = 90


def as_of_date(df: DataFrame, col: str = "view_date", as_of=None) -> _dt.date:
    """the anchor date = max(view_date) of the data (malformed skipped),
    or today (UTC) when there is none.  Returned as a driver-side scalar so
    that window filters are literals: they reach the Parquet scan as pushed
    filters / partition pruning instead of a join against a 1-row table.
    """
    if as_of is not None:
        return as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of)[:10])
    c = F.col(col)
    typ = dict(df.dtypes).get(col)
    if typ != "date":
        c = F.try_to_date(F.substring(c.cast("string"), 1, 10), "yyyy-MM-dd")
    row = df.select(F.max(c).alias("m")).first()
    if row is None or row["m"] is None:
        return _dt.datetime.now(_dt.timezone.utc).date()
    return row["m"]


def window_bounds(as_of: _dt.date, days: int = DEFAULT_DAYS) -> tuple[_dt.date, _dt.date]:
    """the closed interval [as_of-(days-1), as_of]."""
    return as_of - _dt.timedelta(days=days - 1), as_of


def in_window(col: str, as_of: _dt.date, days: int = DEFAULT_DAYS) -> Column:
    lo, hi = window_bounds(as_of, days)
    return F.col(col).between(F.lit(lo), F.lit(hi))


def as_of_frame(df: DataFrame, col: str = "view_date") -> DataFrame:
    """F2 as a one-row frame: ``as_of`` = max(col), today (UTC) when there is no row."""
    return df.agg(F.coalesce(F.max(col), F.current_date()).alias("as_of"))


def date_window_frame(df: DataFrame, days: int = DEFAULT_DAYS, col: str = "view_date") -> DataFrame:
    """F1 on F2 as a one-row frame: the closed window [as_of-(days-1), as_of]."""
    return as_of_frame(df, col).select(
        F.date_sub("as_of", days - 1).alias("window_start"), F.col("as_of").alias("window_end"),
        F.lit(days).alias("window_days"))
