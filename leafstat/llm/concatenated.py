"""Importance resampling towards a target distribution, by concatenated batches.

A batch's texts are joined with a separator sentinel that no word can hold.
One pass of a regular expression finds the words of the whole batch;
searchsorted over the documents' offsets tells whose word each is, so a run of
words that crosses from one document into the next is masked before numpy
counts.  Features are the runs of one and two words; a feature's bucket is the
CRC-32 of its bytes modulo BUCKETS.

Bucket counts of all documents and of all target texts give each bucket an
integer gain (thousandths of the log ratio of the two multinomials).  A
document's weight is the floored mean gain of its features, its score that
weight plus Gumbel noise drawn from its id, and the documents of enough words
with the highest scores are drawn.

Defined cases: a null or empty text has no features and weight 0; rows of equal
id have equal noise, and tie by their feature count, weight and text hash; a
null id draws its noise as an empty one and comes last of equal scores; empty
documents or targets count nothing, so gains stay finite; extra columns are
not looked at.
"""

from __future__ import annotations

import hashlib
import math
import re
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafstat.llm.common import landed, numbered, size_batches
from leafstat.llm.tokens import batches_of

BUCKETS = 10_000
SEED, PERCENT, MIN_WORDS = 7, 25, 20
SENTINEL = b"\x00"
# A word: digits, lower-case letters, and every byte of the characters beyond ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_SPANS = 1 << 17           # words whose bytes are held as objects at once


def features(texts: list[bytes | None], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and document of every feature of a batch, and each document's word count."""
    lowered = [(t or b"").lower() for t in texts]                       # for bytes: A-Z only
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
    offsets = np.cumsum(sizes + len(SENTINEL)) - sizes - len(SENTINEL)
    run = SENTINEL.join(lowered)
    spans = np.fromiter(chain.from_iterable(m.span() for m in _WORD.finditer(run)), np.int64).reshape(-1, 2)
    of = np.searchsorted(offsets, spans[:, 0], "right") - 1
    one = np.zeros(len(spans), np.int64)
    two = np.zeros(len(spans), np.int64)                                # two[i]: words i - 1 and i
    before = 0
    for i in range(0, len(spans), _SPANS):
        words = [run[a:b] for a, b in spans[i:i + _SPANS].tolist()]
        alone = list(map(crc32, words))
        spaced = [crc32(b" ", c) for c in [before, *alone[:-1]]]
        one[i:i + len(words)] = alone
        two[i:i + len(words)] = list(map(crc32, words, spaced))
        before = alone[-1]
    within = np.flatnonzero(of[1:] == of[:-1]) + 1                      # not across a sentinel
    return (np.concatenate([one, two[within]]) % buckets, np.concatenate([of, of[within]]),
            np.bincount(of, minlength=len(texts)))


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket; the driver gets one row for each bucket."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            column = batch.column(0).to_pylist()
            for i, j in batches_of(column):
                total += np.bincount(features(column[i:j], buckets)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    size_batches(texts.sparkSession)
    rows = texts.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's log ratio of target to raw frequency, one added to every count, in thousandths."""
    s_all, t_all = float(raw.sum() + len(raw)), float(target.sum() + len(raw))
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
                     for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def gumbel(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise of an id, in thousandths."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, n_words, n_features, weight, score) of every row; h is the text's hash."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)             # one number for each bucket

    def run(batches):
        table = shared.value.astype(np.float64)                         # whole numbers, sums below 2^53 exact
        for batch in batches:
            column = batch.column(2).to_pylist()
            for i, j in batches_of(column):
                bucket, of, words = features(column[i:j], len(table))
                n = np.bincount(of, minlength=j - i)
                total = np.bincount(of, table[bucket], j - i).astype(np.int64)
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                ids = batch.column(0).slice(i, j - i)
                noise = np.array([gumbel(d, seed) for d in ids.to_pylist()], np.int64)
                yield pa.record_batch([ids, batch.column(1).slice(i, j - i), pa.array(words.astype(np.int64)),
                                       pa.array(n.astype(np.int64)), pa.array(weight), pa.array(weight + noise)],
                                      names=["doc_id", "h", "n_words", "n_features", "weight", "score"])

    size_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("h"),
                       F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, h long, n_words long, n_features long, weight long, score long")


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
              buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, h, n_words, n_features, weight, score and
    ``rank``: its place among the drawn ones, null where it is not drawn.

    Rows of enough words come first in one global order by score, so the
    place there is the rank; the order is a range sort of thin rows.
    """
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_col, buckets))
    thin = landed(scored(docs, gain, seed, id_col, text_col), "scores")
    enough = F.col("n_words") >= min_words
    total, able = thin.agg(F.count("*"), F.count(F.when(enough, 1))).first()
    order = [enough.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight"),
             F.col("h")]
    placed = numbered(thin, order, "_place", "score-order", total)
    drawn = enough & (F.col("_place") < F.lit(percent * able // 100))
    return placed.withColumn("rank", F.when(drawn, F.col("_place") + 1)).drop("_place")


def drawn(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that are drawn, whole; rows of equal id and text stay together."""
    found = resampled(docs, target, id_col=id_col, text_col=text_col, **how).where("rank IS NOT NULL")
    found = found.select(F.col("doc_id").alias("_d"), F.col("h").alias("_h")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    same = (F.col(f"_row.`{id_col}`").cast("long").eqNullSafe(F.col("_d"))
            & (F.xxhash64(F.coalesce(F.col(f"_row.`{text_col}`"), F.lit(""))) == F.col("_h")))
    return rows.join(found, same, "left_semi").select("_row.*")
