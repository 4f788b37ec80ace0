"""Sharding: a Feistel permutation with cycle walking over global row numbers.

The documents are numbered in ascending doc_id order.  A keyed Feistel
network permutes the numbers of the smallest even-bit domain that holds them
all; a number that leaves the range walks on along its cycle until it falls
inside, so the result is a permutation of the row numbers.  Place p goes to
shard p mod S, slot p div S: the shards' row counts differ by one at most,
the slots have no gaps, and shard and slot follow from the row number, the
row count and the seed alone (``place_of``), as the row from shard and slot
(``row_of``).

Defined cases: documents without an id are numbered first; equal ids follow
each other by size, checksum and hash of the text; a null text has no bytes;
repeated rows take a slot each; an empty table has no slot; extra columns are
not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafstat.llm.common import landed, numbered

ROUNDS = 6
SEED = 11
RECORD_BYTES = 16          # of a record beside its text
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _round(half: np.ndarray, seed: int, r: int, mask: np.uint64) -> np.ndarray:
    key = np.uint64((seed * ROUNDS + r + 1) * int(_M[0]) % (1 << 64))
    x = (half + key) * _M[1]
    x = (x ^ (x >> np.uint64(29))) * _M[2]
    return (x ^ (x >> np.uint64(32))) & mask


def _network(x: np.ndarray, bits: int, seed: int, back: bool) -> np.ndarray:
    mask, shift = np.uint64((1 << bits) - 1), np.uint64(bits)
    left, right = x >> shift, x & mask
    for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
        if back:
            left, right = right ^ _round(left, seed, r, mask), left
        else:
            left, right = right, left ^ _round(right, seed, r, mask)
    return left << shift | right


def permuted(rows: np.ndarray, n: int, seed: int = SEED, back: bool = False) -> np.ndarray:
    """Permute row numbers below ``n``; ``back`` inverts."""
    bits = max(1, -(-max(n - 1, 1).bit_length() // 2))
    x = _network(rows.astype(np.uint64), bits, seed, back)
    outside = np.flatnonzero(x >= n)
    while len(outside):
        x[outside] = _network(x[outside], bits, seed, back)
        outside = outside[x[outside] >= n]
    return x.astype(np.int64)


def place_of(rows: np.ndarray, n: int, shards: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of row numbers."""
    p = permuted(rows, n, seed)
    return p % shards, p // shards


def row_of(shard: np.ndarray, slot: np.ndarray, n: int, shards: int, seed: int = SEED) -> np.ndarray:
    """The row numbers that lie at the given shards and slots."""
    return permuted(slot * shards + shard, n, seed, back=True)


def sharded(docs: DataFrame, shards: int, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, row, shard and slot of every document.

    Only thin rows are sorted; the texts stay where they are.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    thin = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       (F.octet_length(text) + RECORD_BYTES).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("_hash"))
    thin = landed(thin, "shard-rows")
    n = thin.count()
    order = [F.col("doc_id").asc_nulls_first(), F.col("size"), F.col("text_crc32"), F.col("_hash")]
    rows = numbered(thin, order, "row", "shard-order", n).drop("_hash")

    def run(batches):
        for batch in batches:
            shard, slot = place_of(batch.column("row").to_numpy(), n, shards, seed)
            yield pa.record_batch([*batch.columns, pa.array(shard.astype(np.int32)), pa.array(slot)],
                                  names=[*batch.schema.names, "shard", "slot"])

    rows = rows.select("doc_id", "size", "text_crc32", "row")
    return rows.mapInArrow(run, "doc_id long, size long, text_crc32 long, row long, shard int, slot long")
