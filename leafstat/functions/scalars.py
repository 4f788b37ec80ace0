"""Scalar column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes (str.isspace), derived from
# Python's own definition; Spark's trim(str, chars) strips this set from both
# ends without a regex.
_PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x110000)) if ch.isspace())


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def blank(c) -> Column:
    """NULL-safe blank test: NULL or ''."""
    return F.coalesce(_c(c), F.lit("")) == ""


def norm_user(upn) -> Column:
    """Grouping key of a user: lower(strip(upn)); NULL for a blank UPN.

    Two spellings of one user ("Ann@X.com ", "ann@x.com") share the key, so
    grouping on it before hashing keeps the user-day grain unique.
    """
    u = _c(upn)
    return F.when(blank(u), F.lit(None).cast("string")).otherwise(
        F.lower(F.trim(u, F.lit(_PY_WHITESPACE))))


def hash_user_key(key) -> Column:
    """X1 on an already normalised key: '' for NULL, else 16 hex of SHA-256."""
    k = _c(key)
    return F.when(k.isNull(), F.lit("")).otherwise(F.substring(F.sha2(k, 256), 1, 16))


def hash_user(upn) -> Column:
    """X1 hash_user: blank/NULL -> ''; else first 16 hex of sha256(lower(strip(upn)))."""
    return hash_user_key(norm_user(upn))


def safe_div(num, den) -> Column:
    """NULLIF/DIVIDE semantics - NULL on a zero or NULL denominator, DOUBLE result."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def date_cut(ts) -> Column:
    """First 10 characters of an ISO timestamp string, as DATE (NULL if malformed)."""
    return F.try_to_date(F.substring(_c(ts).cast("string"), 1, 10), "yyyy-MM-dd")


def page_key(ws="workspace_id", rep="report_id", page="page_id") -> Column:
    """the composite 'workspace|report|page' key used by the BI model."""
    return F.concat_ws("|", _c(ws), _c(rep), _c(page))
