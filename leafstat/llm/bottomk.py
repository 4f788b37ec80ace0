"""Document fingerprints: bottom-k sketches of shingle hashes.

A text's shingles are its runs of five words; a text of one to four words is
one shingle, an empty text has none.  The sketch is the ascending array of
the k smallest distinct 64-bit shingle hashes.  Two sketches give an estimate
of the resemblance and containment of their texts, one sketch that of its
distinct shingles, and the sketch of a union is the bottom k of the sketches'
union, so sketches of parts merge without the texts.

Everything is built from DataFrame functions.

Defined cases: a null text counts as empty; two empty sketches resemble each
other fully, an empty and another one not at all; documents with equal ids
follow each other by the hash of their text, those without an id come first;
of repeated rows each is followed by the next, so all but the last by an equal
one; a single document follows itself; an empty table gives no row; extra
columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafstat.llm.common import landed, numbered, words_of

K = 128
SHINGLE = 5
BLOCK_ROWS = 64            # documents in a block, about
FAN = 256                  # blocks in a run of them
MOST_BLOCKS = FAN * FAN    # blocks, at most: beyond, they grow


def sketched(docs: DataFrame, text: Column, out: str, k: int = K) -> DataFrame:
    """``docs`` with ``out``, the sketch of ``text`` (array<long>)."""
    shingles = F.transform("_ones", lambda h, i: F.xxhash64(h, *[F.get("_ones", i + j) for j in range(1, SHINGLE)]))
    whole = F.slice(shingles, 1, F.greatest(F.size("_ones") - (SHINGLE - 1), F.least(F.size("_ones"), F.lit(1))))
    return (docs.withColumn("_ones", F.transform(words_of(text), lambda w: F.xxhash64(w)))
            .withColumn("_all", whole)
            .withColumn(out, F.slice(F.sort_array(F.array_distinct("_all")), 1, k)).drop("_ones", "_all"))


def encoded(sketch: Column) -> Column:
    """A sketch as a string: 16 hexadecimal digits for each hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def merged_sketch(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two sketched sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity: the share of the union's sketch that both hold."""
    union = merged_sketch(a, b, k)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_count(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    share = (F.element_at(sketch, -1).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b holds too (an empty a: 1)."""
    j = resemblance(a, b, k)
    shared = (distinct_count(a, k) + distinct_count(b, k)) * j / (1 + j)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_count(a, k)))


def merged(sketches: DataFrame, key: str, sketch: str, k: int = K) -> DataFrame:
    """One sketch for each ``key``: that of the union of its rows' sketches.

    Equal hashes meet by (key, hash); the rank filter keeps the k smallest of
    each task before its shuffle, so a key with a third of all rows sends k
    hashes from each task and never gathers its rows.
    """
    hashes = sketches.select(key, F.explode(sketch).alias("_h")).distinct()
    least = Window.partitionBy(key).orderBy("_h")
    kept = hashes.withColumn("_r", F.row_number().over(least)).where(F.col("_r") <= k)
    some = kept.groupBy(key).agg(F.sort_array(F.collect_list("_h")).alias(sketch))
    return (sketches.select(key).distinct().join(some, key, "left")
            .withColumn(sketch, F.coalesce(sketch, F.array().cast("array<long>"))))


def _key(doc_id: Column, h: Column) -> Column:
    """The order of documents: by id, those without one first, then by the hash of the text."""
    return F.struct(doc_id.isNotNull().alias("named"), F.coalesce(doc_id, F.lit(0)).alias("doc_id"), h.alias("h"))


def _bounds(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """The first keys of the blocks after the first, in runs of FAN, as one array value.

    Thin rows (id, text hash) are numbered in global order, and every so many
    rows a block begins; there are at most MOST_BLOCKS, so the array has a
    bound whatever the table's size.
    """
    thin = landed(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                              F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("h")), "keys")
    n = thin.count()
    rows = max(BLOCK_ROWS, -(-n // MOST_BLOCKS))
    order = [F.col("doc_id").asc_nulls_first(), F.col("h")]
    firsts = (numbered(thin, order, "_r", "key-order", n).where((F.col("_r") > 0) & (F.pmod("_r", F.lit(rows)) == 0))
              .select((F.col("_r") / rows - 1).cast("long").alias("_i"), _key(F.col("doc_id"), F.col("h")).alias("_k")))
    runs = firsts.groupBy(F.floor(F.col("_i") / FAN).alias("_g")).agg(F.sort_array(F.collect_list(F.struct("_i", "_k"))).alias("_s"))
    every = landed(runs.select("_g", F.col("_s._k").alias("_keys")), "block-keys")
    return every.agg(F.sort_array(F.collect_list(F.struct("_g", "_keys"))).alias("bounds")).scalar()


def _blocked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, h, text, block): blocks of documents that follow each other, about
    BLOCK_ROWS each (more where MOST_BLOCKS would not do).

    A row finds its block by its key in two steps, run and place, so the texts
    need no join for it.  Ids may lie anywhere, and many documents may share
    one; only rows of equal id and text cannot be told apart.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("h"), "text").withColumn("_bounds", _bounds(docs, id_col, text_col))
    bounds = F.col("_bounds")
    least = lambda run, k: F.get(run["_keys"], F.lit(0)) <= k

    def place(k: Column) -> Column:
        run = F.size(F.filter(bounds, lambda x: least(x, k)))
        return F.transform(F.array(run), lambda g: F.when(g == 0, 0).otherwise(
            (g - 1) * FAN + F.size(F.filter(F.get(bounds, g - 1)["_keys"], lambda y: y <= k))))[0]

    # As elements of arrays the key and the run are computed once a row, not once a comparison.
    block = F.transform(F.array(_key(F.col("doc_id"), F.col("h"))), place)[0]
    return rows.select("doc_id", "h", "text", block.cast("long").alias("block"))


def with_next(docs: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with its sketch and the text and sketch of the next one by id.

    The texts are shuffled once, by block of consecutive ids.  Inside a block
    the next document is a lead(); the last document of a block takes the
    first of the next block, which is found by numbering the blocks (a thin
    table) and joined for one row of each block.
    """
    rows = _blocked(docs, id_col, text_col)
    blocks = landed(rows.select("block").distinct(), "blocks")
    n = blocks.count()
    placed = numbered(blocks, [F.col("block")], "_place", "block-order", n)
    after = placed.select(F.col("block").alias("_next"), F.pmod(F.col("_place") - 1, F.lit(max(n, 1))).alias("_place"))
    order = Window.partitionBy("block").orderBy(F.col("doc_id").asc_nulls_first(), "h", "text")
    dealt = rows.repartition(F.col("block"))
    every = sketched(dealt, F.col("text"), "sketch", k)
    inner = (every.withColumn("next_text", F.lead("text").over(order)).withColumn("next_sketch", F.lead("sketch").over(order))
             .where("next_text IS NOT NULL"))
    last = dealt.withColumn("_l", F.lead(F.lit(1)).over(order)).where("_l IS NULL").drop("_l")
    first = dealt.withColumn("_f", F.row_number().over(order)).where("_f = 1").drop("_f")
    links = placed.join(after, "_place").select("block", "_next")
    first = sketched(first, F.col("text"), "next_sketch", k).select(
        F.col("block").alias("_next"), F.col("text").alias("next_text"), "next_sketch")
    edge = sketched(last, F.col("text"), "sketch", k).join(links, "block").join(first, "_next")
    columns = ["doc_id", "text", "sketch", "next_text", "next_sketch"]
    return inner.select(columns).unionByName(edge.select(columns))


def edited_text(text: Column, following: Column) -> Column:
    """``text`` with its last quarter (rounded down) replaced by as many code
    points of the start of ``following``, or all of them."""
    cut = F.floor(F.char_length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - cut), F.substring(following, F.lit(1), cut))


def compared(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likeness."""
    d = with_next(docs, k).withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    d = sketched(d.drop("next_text"), F.col("edited"), "edited_sketch", k)
    return d.select("doc_id", F.char_length("text").cast("long").alias("n_chars"),
                    F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                    encoded(F.col("sketch")).alias("fingerprint"), encoded(F.col("edited_sketch")).alias("edited_fingerprint"),
                    resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
                    resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
                    distinct_count(F.col("sketch"), k).alias("n_shingles"),
                    containment(F.col("sketch"), F.col("edited_sketch"), k).alias("contained_in_edited"))
