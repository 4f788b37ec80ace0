"""Quality rules: hashed n-gram log-likelihood ratio with a fixed threshold.

Base rules count words, marks, repeated lines and repeated 8-word windows of
the whole text.  The verdict of the method is the log-likelihood ratio of the
text's hashed unigrams and bigrams between two multinomials, that of trusted
target documents and that of the raw corpus, divided by the number of
n-grams.  A document stays if no base rule fails and the mean ratio reaches
the threshold; nothing is sampled, so equal texts have equal verdicts.  Both
counts of a bucket start at EVIDENCE, so that n-grams too rare to judge by do
not count against the documents that no label covers.

Everything is built from DataFrame functions.  The raw counts cover every
document whole; the counts of the hash buckets are combined before the
shuffle, so a frequent word is one row of each task.

Defined cases: a null or empty text has no words, so it fails the base rule
on short texts; without trusted documents every ratio is 0 and the base rules
alone decide.  Windows are compared by 64-bit hashes of their words.  Null ids
stay null, repeated rows share a verdict, an empty table gives no row, and extra
columns stay, under any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafstat.llm.common import marked_trusted, text_or_empty, words_of

BUCKETS = 1 << 16
EVIDENCE = 16              # occurrences of a bucket before which its ratio stays near one
THRESHOLD = -0.1           # least mean log ratio of a document that stays
WINDOW = 8                 # words in a window of the repetition rule
MIN_WORDS = 20
MAX_REPEATED = 30          # per cent of the words in repeated windows
SYMBOLS = "[#*$%&|<>]"
MARKS = "([!-/:-@\\[-`{-~]+)"      # runs of ASCII punctuation are tokens of their own


def hashed(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with ``_grams``: bucket numbers of the text's unigrams and bigrams.

    Tokens are the words in lower case, with runs of punctuation split off.
    """
    place = lambda h: h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")
    ones = F.transform(words_of(F.regexp_replace(F.lower(text), MARKS, " $1 ")), lambda t: F.xxhash64(t))
    # A token is paired with the one before it; the first one stands for itself.
    pairs = F.transform("_ones", lambda h, i: place(F.xxhash64(F.get("_ones", i - 1), h)))
    return (docs.withColumn("_ones", ones)
            .withColumn("_grams", F.concat(F.transform("_ones", place), pairs)).drop("_ones"))


def model(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row: ``ratio``, the log ratio of every bucket, in bucket order."""
    marked = marked_trusted(docs, trusted, id_col).select(F.col(text_col).alias("_text"), "_trusted")
    # The outer form spares the size filter that Spark would evaluate the n-grams for once more.
    grams = hashed(marked, text_or_empty("_text")).select("_trusted", F.explode_outer("_grams").alias("bucket"))
    found = grams.where("bucket IS NOT NULL").groupBy("bucket").agg(F.count("*").alias("raw"),
                                        F.sum(F.col("_trusted").cast("long")).alias("target"))
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    full = every.join(found, "bucket", "left").na.fill(0, ["raw", "target"])
    listed = full.agg(F.sort_array(F.collect_list(F.struct("bucket", "raw", "target"))).alias("b"),
                      F.sum("raw").alias("n_raw"), F.sum("target").alias("n_target"))
    # Of a bucket's raw occurrences, the target would have its share; a rare bucket tells little.
    due = lambda x: F.col("n_target") * x["raw"] / F.greatest(F.col("n_raw"), F.lit(1))
    return listed.select(F.transform("b", lambda x: F.when(
        F.col("n_target") > 0, F.log((x["target"] + EVIDENCE) / (due(x) + EVIDENCE))).otherwise(F.lit(0.0))).alias("ratio"))


def _windows(at: tuple[int, ...]) -> Column:
    """Hash of the words at the given places of every WINDOW-word window of ``_hashes``."""
    found = F.transform("_hashes", lambda h, i: F.xxhash64(h, *[F.get("_hashes", i + k) for k in at]))
    return F.slice(found, 1, F.greatest(F.size("_hashes") - (WINDOW - 1), F.lit(0)))


def _several(a: Column) -> Column:
    return F.size(F.array_distinct(a)) < F.size(a)


def base_counts(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with the five base counts of the contract (LONG).

    Equal windows agree in any four of their words, so a text in which no
    such four repeat has no repeated window; only the others are looked at
    with whole windows.  Those are sorted by (hash, place): neighbours with
    equal hashes are repeated windows, and each adds the words after the end
    of the repeated window before it.
    """
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    d = (docs.withColumn("_words", words_of(text)).withColumn("_lines", lines)
         .withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
         .withColumn("_some", _windows((2, 5, 7))))
    d = d.withColumn("_again", _several(F.col("_some")))
    placed = F.sort_array(F.transform(_windows(tuple(range(1, WINDOW))), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    near = lambda j: F.get("_placed", j)["h"]
    twice = F.transform("_placed", lambda x, j: F.when((x["h"] == near(j + 1)) | (x["h"] == near(j - 1)), x["i"]))
    d = (d.withColumn("_placed", F.when(F.col("_again"), placed))
         .withColumn("_starts", F.when(F.col("_again"), F.sort_array(F.array_compact(twice)))))
    covered = F.transform("_starts", lambda s, j: F.when(j == 0, F.lit(WINDOW)).otherwise(
        F.least(F.lit(WINDOW), s - F.get("_starts", j - 1))))
    total = F.aggregate(covered, F.lit(0), lambda a, x: a + x)
    return (d.withColumn("n_words", F.size("_words").cast("long"))
            .withColumn("word_chars", F.char_length(F.array_join("_words", "")).cast("long"))
            .withColumn("n_symbols", F.regexp_count(text, F.lit(SYMBOLS)).cast("long"))
            .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
            .withColumn("n_repeat_words", F.when(F.col("_again"), total).otherwise(0).cast("long"))
            .drop("_words", "_lines", "_hashes", "_some", "_again", "_placed", "_starts"))


def judged(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with the base counts, ``base_failed``, ``mean_llr`` and ``kept``.

    The columns of ``docs`` stay in a struct named ``row``, beside one named
    ``rules``.  To filter by the verdict, use ``kept``.
    """
    ratio = model(docs, trusted, id_col, text_col).scalar()       # one row of BUCKETS numbers
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))
    d = base_counts(hashed(row, text), text).withColumn("_ratio", ratio)
    total = F.aggregate(F.col("_grams"), F.lit(0.0), lambda a, g: a + F.col("_ratio")[g])
    d = (d.withColumn("mean_llr", F.when(F.size("_grams") > 0, total / F.size("_grams")).otherwise(F.lit(0.0)))
         .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                     | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")))
         .withColumn("kept", ~F.col("base_failed") & (F.col("mean_llr") >= F.lit(threshold))))
    return d.select("row", F.struct("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                    "base_failed", "mean_llr", "kept").alias("rules"))


def kept(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    The verdict empties the row through a generator: a plain filter on it
    would be pushed below the steps that it is computed in, each written out
    as often as the next one uses it.
    """
    d = judged(docs, trusted, threshold, id_col, text_col)
    return (d.select(F.explode_outer(F.when(F.col("rules.kept"), F.array("row"))).alias("row"))
            .where("row IS NOT NULL").select("row.*"))
