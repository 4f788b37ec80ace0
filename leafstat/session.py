"""SparkSession construction and session-level settings."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every leafstat job relies on.  AQE re-plans joins (runtime
# broadcast of small sides, skew-join splitting) and coalesces shuffle
# partitions; the session time zone is pinned so dates never shift.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "leafstat", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with leafstat's settings.

    On a cluster ``master`` stays ``None`` and the launcher decides; tests
    and the bench pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in conf.items():
        if not k.startswith(("spark.ui", "spark.driver", "spark.executor", "spark.cleaner")):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on an existing session
                pass
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names it; only a local session (tests) that names none gets a
    private scratch folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="leafstat-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def path_bytes(spark: SparkSession, *paths: str) -> int:
    """Total size of files under ``paths`` from file-system metadata (no scan)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        if fs.exists(hp):
            total += fs.getContentSummary(hp).getLength()
    return total


# Bytes of compressed fact input per initial reducer; AQE then merges
# reducers below spark.sql.adaptive.advisoryPartitionSizeInBytes.
BYTES_PER_REDUCER = 128 << 20
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def size_shuffles(spark: SparkSession, input_bytes: int, per_reducer: int = BYTES_PER_REDUCER) -> int:
    """Size the initial shuffle partition count from the fact input.

    ``spark.sql.shuffle.partitions`` is a fixed number; on 100 TB of input
    each reducer would get far too much data to sort or hash in memory.  AQE
    starts from ``initialPartitionNum`` and coalesces what turns out small, so
    it is raised (never lowered) to one reducer per ``per_reducer`` input
    bytes.  A value the launcher set explicitly is kept.
    """
    if spark.sparkContext.getConf().contains(_INITIAL):
        return int(spark.sparkContext.getConf().get(_INITIAL))
    base = int(spark.conf.get(_INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    n = max(base, -(-input_bytes // per_reducer))
    if n > base:
        spark.conf.set(_INITIAL, str(n))
    return n


# Compressed shuffle bytes that AQE gives one reducer: sorted and hashed by several
# steps of one stage, rows take some twenty times that in memory.
REDUCER_BYTES = 16 << 20
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def size_reducers(spark: SparkSession, reducer_bytes: int = REDUCER_BYTES) -> None:
    """Let AQE merge reducers up to ``reducer_bytes`` only, so that a task's memory
    does not grow with the input.  A value the launcher set explicitly is kept."""
    if not spark.sparkContext.getConf().contains(_ADVISORY):
        spark.conf.set(_ADVISORY, str(reducer_bytes))


def write_tasks(spark: SparkSession) -> int:
    """Tasks for a range-partitioned write: the initial shuffle partitions, which
    ``size_shuffles`` raises with the input.  A fixed number keeps AQE from
    merging a small table's thousands of day files into one task."""
    return int(spark.conf.get(_INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint directory for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else f"{base.rstrip('/')}/{name}"
