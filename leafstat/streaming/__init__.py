"""Incremental maintenance: keyed upserts usable from batch jobs and from
Structured Streaming ``foreachBatch``."""

from leafstat.streaming.upsert import DuplicateKeyError, foreach_batch_upsert, upsert  # noqa: F401
