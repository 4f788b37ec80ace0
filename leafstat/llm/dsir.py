"""Quality classifier: importance resampling with hashed n-gram models.

Two multinomials over hashed unigrams and bigrams are counted, one over the
trusted target texts and one over all raw texts.  A document's importance
weight is the sum of the log ratios of its n-grams; Gumbel noise is added and
the k largest keys are drawn, which samples k documents without replacement
in proportion to their weights.

Tokens are the runs of word characters and the runs of other marks, in lower
case.  The raw counts cover every document whole.  Both models' counts of a
bucket start at EVIDENCE (the raw one scaled to the target's size), so n-grams
too rare to judge by do not count against documents that no label covers.

Defined cases: a null or empty text has weight 0; a null doc_id is a
document of its own noise; rows that are equal have equal keys, and rows that
tie with the k-th key are all drawn, so a repeated row shares one verdict.
Without target texts every weight is 0 and every document is kept; an empty
table gives no row; extra columns stay, under any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafstat.llm.common import landed, marked_trusted, size_batches

BUCKETS = 1 << 16          # hashed n-gram buckets of either model
EVIDENCE = 16              # occurrences of a bucket before which its ratio stays near one
SEED = 20
FIXED = 1 << 20            # weights are summed as integers of 2**-20: exact in any order
BLOCK_CHARS = 1 << 20      # characters worked on at once
CACHED_WORDS = 150_000     # words whose hashes a worker remembers
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


class _Hashes(dict):
    """Word -> the 64-bit hashes of its tokens, as bytes; forgets when full."""

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        tokens = _TOKEN.findall(word.lower())
        got = self[word] = b"".join(xxhash.xxh64_digest(t)[::-1] for t in tokens)
        return got


_HASHES = _Hashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 over unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def _pieces(text: str) -> Iterator[str]:
    """A text in slices of BLOCK_CHARS or a little more, cut at white space."""
    at = 0
    while len(text) - at > BLOCK_CHARS:
        gap = re.compile(r"\s").search(text, at + BLOCK_CHARS)
        if not gap:
            break
        yield text[at:gap.start()]
        at = gap.start()
    yield text[at:]


def buckets_of(text: str | None) -> Iterator[np.ndarray]:
    """Bucket numbers of the unigrams and bigrams of a text, slice by slice."""
    last = np.empty(0, np.uint64)
    for piece in _pieces(text or ""):
        tokens = np.frombuffer(b"".join(map(_HASHES.__getitem__, piece.split())), np.uint64)
        if not len(tokens):
            continue
        run = np.concatenate([last, tokens])
        pairs = mixed(run[:-1] * _M1 + run[1:])
        last = tokens[-1:]
        yield (np.concatenate([tokens, pairs]) % np.uint64(BUCKETS)).astype(np.int64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target, seen = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64), False
    for batch in batches:
        for text, trusted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for found in buckets_of(text):
                np.add.at(raw, found, 1)
                if trusted:
                    np.add.at(target, found, 1)
                seen = True
    if seen:
        at = np.flatnonzero(raw)
        yield pa.record_batch([pa.array(at), pa.array(raw[at]), pa.array(target[at])],
                              names=["bucket", "raw", "target"])


@dataclass(frozen=True)
class Model:
    """Log ratios of the buckets, in units of 1 / FIXED."""

    ratio: np.ndarray

    def weight(self, text: str | None) -> int:
        return int(sum(int(self.ratio[found].sum()) for found in buckets_of(text)))


def fit(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Count both models over all of ``docs``; ``trusted`` holds the target's ids.

    The raw model counts every document, the target every document of
    ``trusted``.  The shuffle of counts carries at most BUCKETS rows from each
    task, and BUCKETS rows reach the driver.
    """
    size_batches(docs.sparkSession)
    marked = marked_trusted(docs, trusted, id_col)
    sums = (marked.select(F.col(text_col).alias("text"), "_trusted").mapInArrow(_counts, "bucket long, raw long, target long")
            .groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect())
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for bucket, in_raw, in_target in sums:
        raw[bucket], target[bucket] = in_raw, in_target
    if not target.sum():
        return Model(np.zeros(BUCKETS, np.int64))
    due = raw * (target.sum() / raw.sum())
    return Model(np.rint(np.log((target + EVIDENCE) / (due + EVIDENCE)) * FIXED).astype(np.int64))


def gumbel(doc_id: int | None, text: str | None, seed: int = SEED) -> float:
    """Standard Gumbel noise that only the row and the seed decide."""
    h = xxhash.xxh64_intdigest(f"{seed}\x00{doc_id}\x00{text or ''}")
    return float(-np.log(-np.log(((h >> 11) + 0.5) / (1 << 53))))


def _key(model: Model, doc_id: int | None, text: str | None, seed: int) -> tuple[float, float]:
    weight = model.weight(text) / FIXED
    return weight, weight + gumbel(doc_id, text, seed)


def scores(docs: DataFrame, model: Model, seed: int = SEED, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Per row: its id, importance ``weight`` and sampling ``key``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)      # BUCKETS numbers

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            found = [_key(shared.value, *row, seed) for row in zip(ids, batch.column(1).to_pylist())]
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array([w for w, _ in found], pa.float64()),
                                   pa.array([k for _, k in found], pa.float64())], names=["doc_id", "weight", "key"])

    size_batches(docs.sparkSession)
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, weight double, key double"))


def kth_largest(scored: DataFrame, k: int, col: str = "key", bins: int = 4096) -> float:
    """The exact k-th largest value of a landed column, found by narrowing a histogram.

    Each pass sends at most ``bins`` counts to the driver; the passes end when
    the interval holds one value.
    """
    low, high, above = *scored.agg(F.min(col), F.max(col)).first(), 0
    while low < high:
        width = (high - low) / bins
        place = F.least(F.floor((F.col(col) - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("long")
        inside = scored.where(F.col(col).between(low, high))
        counts = {r[0]: r[1:] for r in inside.groupBy(place.alias("bin"))
                  .agg(F.count("*"), F.min(col), F.max(col)).collect()}
        for b in sorted(counts, reverse=True):
            count, least, most = counts[b]
            if above + count >= k:
                low, high = least, most
                break
            above += count
    return low


@dataclass(frozen=True)
class Sampler:
    """A fitted model with the key of the last document drawn."""

    model: Model
    seed: int
    cut: float
    drawn: int


def keep_share(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", sigmas: float = 2.0) -> float:
    """Share of documents to draw: the trusted share of the labelled ones, plus
    ``sigmas`` standard errors so that few labels do not cost clean documents."""
    n, good = (labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull())
               .join(docs.select(id_col).distinct(), id_col, "left_semi")
               .agg(F.count("*"), F.sum((F.col("quality") == 1).cast("long"))).first())
    if not n or not good:
        return 1.0
    share = good / n
    return min(1.0, share + sigmas * (share * (1 - share) / n) ** 0.5)


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = SEED
             ) -> tuple[Sampler, DataFrame]:
    """Fit on ``docs`` with the labelled target, draw ``k`` (default: the share
    of ``keep_share``); returns the sampler and every row with ``kept``."""
    model = fit(docs, labels.where("quality = 1"))
    scored = landed(scores(docs, model, seed), "dsir")
    n = scored.count()
    if k is None:
        k = int(np.ceil(keep_share(docs, labels) * n))
    k = min(k, n)
    cut = float("-inf") if k >= n else float("inf") if k <= 0 else kth_largest(scored, k)
    return Sampler(model, seed, cut, k), scored.withColumn("kept", F.col("key") >= F.lit(cut))


def drawn(docs: DataFrame, sampler: Sampler, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the sampler draws, with all their columns.

    A row's key depends on the row alone, so it is computed again instead of
    shuffling the texts to a join.
    """
    shared = docs.sparkSession.sparkContext.broadcast(sampler)

    def run(batches):
        for batch in batches:
            it = shared.value
            rows = zip(batch.column(batch.schema.get_field_index(id_col)).to_pylist(),
                       batch.column(batch.schema.get_field_index(text_col)).to_pylist())
            yield batch.filter(pa.array([_key(it.model, *row, it.seed)[1] >= it.cut for row in rows], pa.bool_()))

    size_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
