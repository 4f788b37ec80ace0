"""N-gram Jaccard join: MinHash LSH forest with exact verification.

A text is the set of its five-word shingles (a text of one to four words is
one shingle).  Texts with equal sets form a class; classes are linked where
the Jaccard similarity of their sets is 0.8 or more.

Each class has TREES x DEPTH MinHash values.  A tree is the trie of its DEPTH
values; two classes meet in a tree where their prefixes match.  Matching starts
with whole signatures, the deepest level of the tries, and shortens the
prefixes.  Pairs that meet for the first time at a depth are verified on their
whole sets.  After each depth the recall is measured: a link of similarity s is
met at depth d with a known chance, so the links found, by similarity, tell how
many there are.  When the share found reaches the target, matching stops; else
it goes on with the longest prefixes that promise it.  Data whose links are
close copies need only whole signatures; links near the threshold take it down
to LEAST_DEPTH.

No pair is a row.  A prefix with many classes is cut into blocks by class, and
each pair of blocks is a task's work (``_groups``), so no group is ever
gathered whole.  A pair that meets in several trees of a level belongs to the
first of them, and one that met by longer prefixes is not met again; a first pass over the prefixes alone keeps the classes that have such
pairs, and the sets travel only for these.  A task returns the number of links
of each class and a spanning forest of its links, so its output grows with the
classes, not with the pairs.  Components of the links are those of ``linked``.

Defined cases: null and empty texts have no shingle and form one class; a
repeated row is a copy; a null doc_id comes last when a class or component is
named by its smallest doc_id; an empty table gives no row; extra columns stay,
under any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafstat.llm.common import landed, numbered, size_batches
from leafstat.llm.linked import components
from leafstat.llm.tokens import batches_of, spread

SHINGLE = 5
THRESHOLD = 0.8
TREES, DEPTH, LEAST_DEPTH = 16, 8, 5
TARGET = 0.999             # measured share of the links at which matching stops
BINS = 20                  # similarities from the threshold to 1 that links are counted by
BLOCK_CLASSES = 1024       # classes of one prefix in a block, about
BLOCK_SHINGLES = 1 << 20   # and shingles
FEW = 8                    # partners that are intersected one by one
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_RANDOM = np.random.default_rng(5)
_FACTORS = _RANDOM.integers(0, 1 << 63, TREES * DEPTH, np.uint64) << np.uint64(1) | np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 1 << 63, TREES * DEPTH, np.uint64)


def recall(depth: int, similarity: float = THRESHOLD, trees: int = TREES) -> float:
    """Chance that two sets of the given similarity share a prefix in some tree."""
    return 1 - (1 - similarity ** depth) ** trees


_MIDDLES = THRESHOLD + (np.arange(BINS) + .5) * (1 - THRESHOLD) / BINS


def predicted(found: np.ndarray, depth: int, shorter: int) -> float:
    """Share of all links that prefixes of ``shorter`` values find, judged by the
    links found at ``depth`` (by similarity bin): of similarity s, their number
    over the chance of finding one is how many there are.

    One link at the threshold counts as well, so that nothing found is no proof."""
    there = np.append(found / [recall(depth, s) for s in _MIDDLES], 1 / recall(depth))
    return float(there @ [recall(shorter, s) for s in (*_MIDDLES, THRESHOLD)] / there.sum())


def next_depth(found: np.ndarray, depth: int, target: float) -> int | None:
    """The longest prefixes that promise the target recall, LEAST_DEPTH where none
    do; None where those of ``depth`` have reached it."""
    if predicted(found, depth, depth) >= target or depth == LEAST_DEPTH:
        return None
    return next((d for d in range(depth - 1, LEAST_DEPTH, -1) if predicted(found, depth, d) >= target), LEAST_DEPTH)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M[1]
    x = (x ^ (x >> np.uint64(27))) * _M[2]
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    words = pc.ascii_split_whitespace(pa.array([t or "" for t in texts], pa.large_string()))
    coded = words.flatten().dictionary_encode()
    known = np.fromiter((xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    empty = pc.equal(coded.dictionary, "").to_numpy(zero_copy_only=False)
    order, offsets = coded.indices.to_numpy(), words.offsets.to_numpy()
    there = ~empty[order] if len(order) else np.zeros(0, bool)
    flat = known[order[there]] if len(order) else np.zeros(0, np.uint64)
    ends = np.concatenate([[0], np.cumsum(there)])[offsets]
    runs = flat.copy()
    with np.errstate(over="ignore"):
        for k in range(1, SHINGLE):                     # runs[i] covers words i to i + k
            covered = max(len(flat) - k, 0)
            runs[:covered] = runs[:covered] * _M[0] + flat[k:]
        runs = _mixed(runs)
    out = []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        if b - a >= SHINGLE:
            out.append(np.unique(runs[a:b - SHINGLE + 1]))
        elif b > a:
            out.append(np.asarray([xxhash.xxh64_intdigest(flat[a:b].tobytes())], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def prefixes(shingles: np.ndarray) -> np.ndarray:
    """For each depth from LEAST_DEPTH to DEPTH, and each tree, a hash of the first
    ``depth`` MinHash values (signed 64-bit)."""
    least = np.full(TREES * DEPTH, np.iinfo(np.uint64).max, np.uint64)
    out = []
    with np.errstate(over="ignore"):
        for i in range(0, len(shingles), 2048):
            part = shingles[i:i + 2048, None] * _FACTORS + _SHIFTS
            np.minimum(least, (part >> np.uint64(24)).min(0), out=least)
        tree = least.reshape(TREES, DEPTH)
        key = np.arange(TREES, dtype=np.uint64) * _M[0]
        for j in range(DEPTH):
            key = _mixed(key * _M[0] + tree[:, j])
            if j + 1 >= LEAST_DEPTH:
                out.append(key)
    return np.concatenate(out).view(np.int64)


LEVELS = DEPTH - LEAST_DEPTH + 1


def at_depth(keys: Column, depth: int) -> Column:
    """The trees' prefixes of a depth, out of ``prefixes``."""
    return F.slice(keys, (depth - LEAST_DEPTH) * TREES + 1, TREES)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text hash, the set's 128-bit fingerprint and size, and its prefixes."""
    def run(batches):
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for i, j in batches_of(texts):
                sets = shingle_sets(texts[i:j])
                prints = np.frombuffer(b"".join(xxhash.xxh128_digest(s.tobytes()) for s in sets), "<i8").reshape(-1, 2)
                keys = np.concatenate([prefixes(s) if len(s) else np.zeros(TREES * LEVELS, np.int64) for s in sets])
                yield pa.record_batch(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(prints[:, 0].copy()),
                     pa.array(prints[:, 1].copy()), pa.array([len(s) for s in sets], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(np.arange(0, len(keys) + 1, TREES * LEVELS, dtype=np.int32)), pa.array(keys))],
                    names=["doc_id", "h", "f1", "f2", "n", "keys"])

    size_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("h"),
                       F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, h long, f1 long, f2 long, n long, keys array<long>")


def classes_of(signed: DataFrame) -> DataFrame:
    """One row for each distinct set: cid (numbered by smallest doc_id), its
    first document (doc_id, h), copies, n and keys."""
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    grouped = (signed.groupBy("f1", "f2")
               .agg(F.min(first).alias("_first"), F.count("*").alias("copies"), F.min("n").alias("n"),
                    F.first("keys").alias("keys"))
               .select("f1", "f2", F.col("_first.doc_id").alias("doc_id"), F.col("_first.h").alias("h"), "copies", "n", "keys"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("h"), F.col("f1"), F.col("f2")]
    return landed(numbered(landed(grouped, "classes"), order, "cid", "class-order"), "classes-numbered")


def _groups(classes: DataFrame, depth: int) -> DataFrame:
    """(key, tree, pair, block, cid): the classes of each prefix of a depth that
    several have, once for each pair of blocks that theirs is in."""
    members = classes.where("n > 0").select("cid", "n", F.posexplode(at_depth(F.col("keys"), depth)).alias("tree", "key"))
    shared = (members.groupBy("tree", "key").agg(F.count("*").alias("_c"), F.sum("n").alias("_s")).where("_c > 1")
              .select("tree", "key", F.greatest(F.ceil(F.col("_c") / BLOCK_CLASSES), F.ceil(F.col("_s") / BLOCK_SHINGLES))
                      .cast("int").alias("_blocks")))
    rows = members.join(shared, ["tree", "key"])
    rows = rows.withColumn("block", F.pmod(F.xxhash64("cid"), F.col("_blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    return (rows.select("key", "tree", "cid", "block", other.alias("_o"))
            .withColumn("pair", F.concat_ws("-", F.least("block", "_o"), F.greatest("block", "_o"))).drop("_o"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each (key, tree, pair), which lie together, as one batch."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        names = list(zip(*(batch.column(c).to_pylist() for c in ("key", "tree", "pair"))))
        start = 0
        for i, name in enumerate(names):
            if name != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, start, last = [], i, name
        if start < len(names):
            held.append(batch.slice(start))
    if held:
        yield held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _partners(i: int, keys: np.ndarray, deeper: np.ndarray, tree: int, sizes: np.ndarray, blocks: np.ndarray,
              inner: bool) -> np.ndarray:
    """Rows after ``i`` that meet it by these prefixes first, in this tree first, in the other
    block (or the same), and are not too large or small to be similar."""
    later = slice(i + 1, None)
    ok = np.minimum(sizes[later], sizes[i]) >= THRESHOLD * np.maximum(sizes[later], sizes[i])
    if not inner:
        ok &= blocks[later] != blocks[i]
    if tree:
        ok &= ~(keys[later, :tree] == keys[i, :tree]).any(1)
    if deeper.shape[1]:
        ok &= ~(deeper[later] == deeper[i]).any(1)
    return np.flatnonzero(ok) + i + 1


def _columns(run: pa.RecordBatch):
    """tree, whether the blocks are one, prefixes, the longer ones before, sizes, blocks and numbers of a group."""
    pair, n = run.column("pair")[0].as_py().split("-"), run.num_rows
    keys = run.column("keys").flatten().to_numpy().reshape(n, -1)
    return (run.column("tree")[0].as_py(), pair[0] == pair[1], keys[:, :TREES], keys[:, TREES:], run.column("n").to_numpy(),
            run.column("block").to_numpy(), run.column("cid").to_numpy())


def _needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that have a partner."""
    for run in _runs(batches):
        tree, inner, keys, deeper, sizes, blocks, _ = _columns(run)
        has = np.zeros(len(sizes), bool)
        for i in range(len(sizes) - 1):
            found = _partners(i, keys, deeper, tree, sizes, blocks, inner)
            if len(found):
                has[i] = True
                has[found] = True
        if has.any():
            yield run.filter(pa.array(has))


class _Overlap:
    """Sizes of the intersections of a group's sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.post = None

    def with_all(self, i: int) -> np.ndarray:
        if self.post is None:
            sizes = np.fromiter(map(len, self.sets), np.int64, len(self.sets))
            _, where = np.unique(np.concatenate(self.sets), return_inverse=True)
            self.post = np.repeat(np.arange(len(sizes)), sizes)[np.argsort(where, kind="stable")]
            self.lengths = np.bincount(where)
            self.ids = np.split(where, np.cumsum(sizes)[:-1])
        return np.bincount(spread(self.post, self.lengths, self.ids[i])[0], minlength=len(self.sets))

    def of(self, i: int, partners: np.ndarray) -> np.ndarray:
        if len(partners) > FEW:
            return self.with_all(i)[partners]
        return np.asarray([len(np.intersect1d(self.sets[i], self.sets[j], assume_unique=True)) for j in partners.tolist()])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each class in a group (a, null, count), a spanning forest of them
    (a, b, 0), and for each task their number by similarity (null, bin, count)."""
    total = np.zeros(BINS, np.int64)
    rows = lambda a, b, n: pa.record_batch([pa.array(x, pa.int64()) for x in (a, b, n)], names=["a", "b", "links"])
    for run in _runs(batches):
        run = run.filter(pa.array(np.concatenate([[True], np.diff(run.column("cid").to_numpy()) != 0])))
        tree, inner, keys, deeper, sizes, blocks, cids = _columns(run)
        overlap = _Overlap([np.frombuffer(x, np.uint64) for x in run.column("shingles").to_pylist()])
        links, part, edges = np.zeros(len(sizes), np.int64), np.arange(len(sizes)), []
        for i in range(len(sizes) - 1):
            found = _partners(i, keys, deeper, tree, sizes, blocks, inner)
            if not len(found):
                continue
            common = overlap.of(i, found)
            alike = common / (sizes[i] + sizes[found] - common)
            close = alike >= THRESHOLD - 1e-9
            linked = found[close]
            total += np.bincount(np.clip((alike[close] - THRESHOLD) * (BINS / (1 - THRESHOLD)), 0, BINS - 1).astype(np.int64),
                                 minlength=BINS)
            links[i] += len(linked)
            links[linked] += 1
            parts, at = np.unique(part[linked], return_index=True)
            new = parts != part[i]
            if new.any():
                edges += [(cids[i], cids[linked[j]]) for j in at[new].tolist()]
                part[np.isin(part, parts[new])] = part[i]
        some = np.flatnonzero(links)
        if len(some):
            yield rows(np.concatenate([cids[some], [x for x, _ in edges]]).astype(np.int64),
                       [None] * len(some) + [int(y) for _, y in edges],
                       np.concatenate([links[some], np.zeros(len(edges), np.int64)]))
    at = np.flatnonzero(total)
    yield rows([None] * len(at), at, total[at])


def _shingled(rows: DataFrame) -> DataFrame:
    """(cid, shingles) of (cid, text)."""
    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for i, j in batches_of(texts):
                yield pa.record_batch([batch.column(0).slice(i, j - i), pa.array([s.tobytes() for s in shingle_sets(texts[i:j])])],
                                      names=["cid", "shingles"])

    return rows.mapInArrow(run, "cid long, shingles binary")


def links(docs: DataFrame, classes: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          target: float = TARGET) -> DataFrame:
    """Landed rows of ``_verified`` over the prefixes, from whole signatures on until the target recall."""
    by = ["key", "tree", "pair"]
    together = lambda d: d.repartition(*by).sortWithinPartitions(*by, "cid")
    text = F.coalesce(F.col(text_col), F.lit(""))
    all_rows = docs.select(F.col(id_col).cast("long").alias("_id"), text.alias("text"), F.xxhash64(text).alias("_x"))
    found, counts, depth, met = None, np.zeros(BINS, np.int64), DEPTH, None
    while depth is not None:
        kept = F.concat(*[at_depth(F.col("keys"), d) for d in (depth, met) if d])
        thin = _groups(classes, depth).join(classes.select("cid", "n", kept.alias("keys")), "cid")
        thin = thin.select(*by, "block", "cid", "n", "keys")
        needed = landed(together(thin).mapInArrow(_needed, thin.schema), "candidates")
        wanted = needed.select("cid").distinct().join(
            classes.select("cid", F.col("doc_id").alias("_d"), F.col("h").alias("_h")), "cid")
        rows = all_rows.join(wanted, F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_x") == F.col("_h"))).select("cid", "text")
        full = needed.join(_shingled(rows), "cid")
        level = landed(together(full).mapInArrow(_verified, "a long, b long, links long"), "links")
        for r in level.where("a IS NULL").groupBy("b").agg(F.sum("links").alias("n")).collect():     # a row a bin
            counts[r.b] += r.n
        level = level.where("a IS NOT NULL")
        found = level if found is None else found.unionByName(level)
        depth, met = next_depth(counts, depth, target), depth
    return found


def _resolved(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The signatures, and every class with its component's first class (root)."""
    signed = landed(signatures(docs, id_col, text_col), "signatures")
    classes = classes_of(signed)
    found = links(docs, classes, id_col, text_col)
    roots = components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "cid")
    counts = found.groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("n_links"))
    every = (classes.select("f1", "f2", "cid", "doc_id", "h", (F.col("copies") - 1).alias("n_copies"))
             .join(counts, "cid", "left").join(roots, "cid", "left")
             .withColumn("n_links", F.coalesce("n_links", F.lit(0)).cast("long"))
             .withColumn("root", F.coalesce("root", "cid")))
    return signed, every


def joined(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, ``class_id`` (smallest doc_id of its
    component), ``n_links`` (other classes that its class is linked to),
    ``copy_of`` (first document of its class) and ``n_copies`` (others in it)."""
    signed, classes = _resolved(docs, id_col, text_col)
    named = classes.where("root = cid").select("root", F.col("doc_id").alias("class_id"))
    classes = (classes.join(named, "root")
               .select("f1", "f2", "class_id", "n_links", F.col("doc_id").alias("copy_of"), "n_copies"))
    return (signed.select("doc_id", "f1", "f2").join(classes, ["f1", "f2"])
            .select("doc_id", "class_id", "n_links", "copy_of", "n_copies"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay when each component keeps its first document.

    A repeated row (equal id and text) is a copy, so one row of it stays.
    """
    _, classes = _resolved(docs, id_col, text_col)
    key = lambda i, h: F.struct(i.isNull().alias("none"), F.coalesce(i, F.lit(0)).alias("id"), h.alias("h"))
    first = classes.where("root = cid").select(key(F.col("doc_id"), F.col("h")).alias("_key"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    text = F.coalesce(F.col(f"_row.`{text_col}`"), F.lit(""))
    rows = rows.withColumn("_key", key(F.col(f"_row.`{id_col}`").cast("long"), F.xxhash64(text)))
    return rows.join(first, "_key", "left_semi").dropDuplicates(["_key"]).select("_row.*")
