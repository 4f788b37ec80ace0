"""Column-level helpers (all JVM-side built-ins, no Python UDFs)."""

from leafstat.functions.scalars import (  # noqa: F401
    date_cut, hash_user, hash_user_key, norm_user, page_key, safe_div, blank,
)
from leafstat.functions.dates import as_of_date, in_window, window_bounds  # noqa: F401
from leafstat.functions.prefix import running_total  # noqa: F401
