"""SimHash near-dedup: fingerprints linked through covering locality-sensitive hashing.

A text's fingerprint has 64 bits: bit i is set if it is set in more than half
of the 64-bit hashes of its shingles (runs of three words, repeats included).
Texts are linked where their fingerprints differ in at most RADIUS bits.

Covering masks make the search exact.  Every bit position gets a non-zero
vector of RADIUS + 1 bits, in turn; table v (a non-zero vector as well) keeps
the positions whose vector has an odd product with v.  RADIUS positions span
at most RADIUS dimensions, so some v is orthogonal to all of them: two
fingerprints that differ in RADIUS bits or fewer agree on all that table v
keeps.  There are 2^(RADIUS + 1) - 1 = 7 tables, each of 36 or 37 positions.

Only distinct fingerprints are dealt to tables.  A bucket of more than
CROWDED of them is dealt again, by covering masks of the positions that its
table leaves out; what remains open then are 12 positions at most, so such a
bucket holds at most 4096 distinct fingerprints, however large the input.
A bucket yields a spanning forest of its links, never its pairs.

Defined cases: null and empty texts, and texts without words, have fingerprint
zero, which links like any other; a text of one or two words is one shingle;
repeated rows are linked as equal texts; a null doc_id is never named as a
component while it holds another id, and an id-less component is named null;
an empty table gives no row; extra columns are not looked at.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafstat.llm.common import landed, size_batches, with_group_value
from leafstat.llm.linked import components
from leafstat.llm.tokens import batches_of

BITS, RADIUS, SHINGLE, SEED = 64, 2, 3, 42
CROWDED = 256              # distinct fingerprints of a bucket that are compared at once
_HASHES = 1 << 16          # hashes whose bits are counted at once


def covering_masks(positions: list[int], radius: int = RADIUS) -> list[int]:
    """Masks over ``positions``, one for each table: sets of at most ``radius``
    positions are left out whole by at least one of them."""
    vectors = (1 << radius + 1) - 1
    dealt = [(p, 1 + i % vectors) for i, p in enumerate(positions)]
    return [sum(1 << p for p, vector in dealt if (vector & v).bit_count() & 1) for v in range(1, vectors + 1)]


def open_positions(mask: int) -> list[int]:
    return [p for p in range(BITS) if not mask >> p & 1]


TABLES = covering_masks(list(range(BITS)))
FINER = [[mask | finer for finer in covering_masks(open_positions(mask))] for mask in TABLES]


def shingle_hashes(text: bytes | None) -> np.ndarray:
    """XXH64 of every run of three words, joined by spaces."""
    words = (text or b"").lower().split()              # for bytes: A-Z, and the white space of the word rule
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    n = max(1, len(words) - SHINGLE + 1)
    starts, ends = (ends - sizes)[:n].tolist(), ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[i:j], SEED) for i, j in zip(starts, ends)], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """The majority bits of 64-bit hashes (none: zero)."""
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), _HASHES):
        octets = hashes[i:i + _HASHES].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, bits): a hash of every row's whole text, and its fingerprint as a signed 64-bit integer."""
    def run(batches):
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for i, j in batches_of(texts):
                found = np.array([fingerprint(shingle_hashes(t)) for t in texts[i:j]], np.uint64)
                yield pa.record_batch([*(batch.column(c).slice(i, j - i) for c in (0, 1)), pa.array(found.view(np.int64))],
                                      names=["doc_id", "h", "bits"])

    size_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("h"),
                       F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, h long, bits long")


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> BITS - 1 else mask


def _keys(masks: list[int], table: int = 0) -> Column:
    """One (table, key) struct for each mask: what the mask keeps of ``bits``."""
    return F.array(*[F.struct(F.lit(table + i).alias("table"), F.col("bits").bitwiseAND(F.lit(_signed(m))).alias("key"))
                     for i, m in enumerate(masks)])


def _forest(bits: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between distinct fingerprints."""
    part, edges = np.arange(len(bits)), []
    for i in range(len(bits) - 1):
        near = np.flatnonzero(np.bitwise_count(bits[i + 1:] ^ bits[i]) <= radius) + i + 1
        parts, at = np.unique(part[near], return_index=True)
        new = parts != part[i]
        if new.any():
            edges += [(i, int(j)) for j in near[at[new]]]
            part[np.isin(part, parts[new])] = part[i]
    return edges


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) between the fingerprints in ``bits``, distinct: every two
    within the radius are joined by a path of them."""
    def run(batches):
        for batch in batches:
            members = batch.column(0)
            ends, flat = members.offsets.to_numpy(), members.values.to_numpy().view(np.uint64)
            a, b = [], []
            for i, j in zip(ends[:-1].tolist(), ends[1:].tolist()):
                group = flat[i:j]
                for x, y in _forest(group, radius):
                    a.append(group[x])
                    b.append(group[y])
            yield pa.record_batch([pa.array(np.array(x, np.uint64).view(np.int64)) for x in (a, b)], names=["a", "b"])

    dealt = distinct.select("bits", F.explode(_keys(TABLES)).alias("k")).select("bits", "k.*")
    sized = landed(with_group_value(dealt, ["table", "key"], "bits", F.count("*"), F.sum, "size").where("size > 1"), "buckets")
    crowded = sized.where(F.col("size") > CROWDED)
    finer = reduce(DataFrame.unionByName, [
        crowded.where(F.col("table") == v).select("bits", F.explode(_keys(masks, len(TABLES) * (v + 1))).alias("k"))
        for v, masks in enumerate(FINER)])
    every = sized.where(F.col("size") <= CROWDED).select("table", "key", "bits").unionByName(finer.select("k.*", "bits"))
    buckets = every.groupBy("table", "key").agg(F.collect_list("bits").alias("members")).where(F.size("members") > 1)
    return buckets.select("members").mapInArrow(run, "a long, b long").distinct()


def linked(docs: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, h (the text's hash), ``fingerprint`` (16 hexadecimal
    digits), ``component_id`` (smallest doc_id that links reach) and ``n_equal`` (rows of
    its fingerprint)."""
    if radius > RADIUS:
        raise ValueError(f"the tables cover {RADIUS} differing bits")
    prints = landed(fingerprints(docs, id_col, text_col), "fingerprints")
    groups = landed(prints.groupBy("bits").agg(F.min("doc_id").alias("first"), F.count("*").alias("n_equal")), "distinct")
    roots = components(links(groups.select("bits"), radius)).withColumnRenamed("node", "bits")
    rooted = groups.join(roots, "bits", "left").withColumn("root", F.coalesce("root", "bits"))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return (prints.join(rooted.join(named, "root").select("bits", "component_id", "n_equal"), "bits")
            .select("doc_id", "h", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id", "n_equal"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay when each component keeps the rows of its
    smallest doc_id, one of equal rows; rows of an id-less component all stay."""
    found = linked(docs, id_col=id_col, text_col=text_col)
    gone = found.where("component_id IS NOT NULL AND (doc_id IS NULL OR doc_id <> component_id)").select(
        F.col("doc_id").alias("_gone"), F.col("h").alias("_h")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    same = (F.col(f"_row.`{id_col}`").cast("long").eqNullSafe(F.col("_gone"))
            & (F.xxhash64(F.coalesce(F.col(f"_row.`{text_col}`"), F.lit(""))) == F.col("_h")))
    return rows.join(gone, same, "left_anti").distinct().select("_row.*")
