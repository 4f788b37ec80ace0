"""Benchmark: silver build from the raw tables + the query catalogue over it.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line: {"metric", "value" (total sec), "unit", "queries", "sf", ...}.

Step 1 ("silver_build") derives the five silver tables from lineitem /
orders / customer / part / region and persists them (memory, spilling to
disk) - the pipeline's collect step.  Step 2 runs every analytics query of
the catalogue over that silver set, forcing full evaluation with the
``noop`` sink.  Queries whose point is writing files (round trips, upserts,
bronze) are timed separately under "storage" because on a laptop disk they
measure small-file commit overhead, not the engine.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark import StorageLevel  # noqa: E402

from leafstat.plans.catalogue import SURVEY_ALIASES, lakehouse_queries  # noqa: E402
from leafstat.plans.lakehouse import Lakehouse  # noqa: E402
from leafstat.session import get_spark  # noqa: E402

# Queries whose point is writing files.
STORAGE = ("silver_", "upsert_", "replace_", "write_bronze", "flatten_", "gold_", "run_summary", "run_metrics", "forget_user_stored",
           "retain_bronze", "bronze_snapshot_diff", "export_unused_by_workspace", "table_row_counts", "read_catalog_sidecar",
           "corrupt_payloads", "catalog_from_pages_payload", "catalog_with_overlay")


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    with_storage = os.environ.get("BENCH_STORAGE", "0") == "1"
    spark = get_spark(f"local[{cpus}]", cpus * 2, extra={"spark.driver.memory": "16g"})
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    t0 = time.time()
    base = Lakehouse.from_star(spark, sf_dir)
    base.land_events()
    silver = {}
    for name in ("page_catalog", "page_views", "report_views", "user_views", "unused_pages"):
        silver[name] = getattr(base, name).persist(StorageLevel.MEMORY_AND_DISK)
        base._tables[name] = silver[name]   # later tables build on the persisted ones
        silver[name].count()
    base.events.unpersist()
    build = time.time() - t0

    lh = Lakehouse(spark, source=base.source, tables=silver, as_of=base.as_of)
    times: dict[str, float] = {"silver_build": round(build, 3)}
    storage: dict[str, float] = {}
    for name, fn in lakehouse_queries().items():
        if (name.startswith(STORAGE) and not with_storage) or name in SURVEY_ALIASES:
            continue
        t = time.time()
        run(fn(lh))
        (storage if name.startswith(STORAGE) else times)[name] = round(time.time() - t, 3)
    total = round(sum(times.values()), 3)
    out = {"metric": "catalogue_total", "value": total, "unit": "sec", "queries": times, "sf": sf,
           "cpus": cpus, "n_queries": len(times) - 1, "spark": spark.version}
    if storage:
        out["storage"] = storage
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
