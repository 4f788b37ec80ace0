"""Importance resampling and n-gram rules against brute force."""

import collections
import math
import re
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from leafstat.llm import dsir, llr_rules
from leafstat.llm.common import marked_trusted

from small_tables import prose, table

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def grams(text):
    hashes = [xxhash.xxh64_intdigest(t) for w in (text or "").split() for t in re.findall(r"\w+|[^\w\s]+", w.lower())]
    m1, m2, m3, all_bits = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, (1 << 64) - 1
    out = [h % dsir.BUCKETS for h in hashes]
    for a, b in zip(hashes, hashes[1:]):
        x = (a * m1 + b) & all_bits
        x = (x ^ x >> 30) * m2 & all_bits
        x = (x ^ x >> 27) * m3 & all_bits
        out.append((x ^ x >> 31) % dsir.BUCKETS)
    return out


def test_weights_and_draw_equal_brute_force(spark, odd, odd_rows, labels):
    _, got = dsir.resample(odd, labels, k=6)
    trusted = {5, 7, 11}
    raw, target = collections.Counter(), collections.Counter()
    for i, t in odd_rows:
        raw.update(grams(t))
        if i in trusted:
            target.update(grams(t))
    share = sum(target.values()) / sum(raw.values())
    ratio = {b: math.log((target[b] + dsir.EVIDENCE) / (n * share + dsir.EVIDENCE)) for b, n in raw.items()}
    want = sorted((i is not None, i or 0, sum(ratio[b] for b in grams(t)) + dsir.gumbel(i, t)) for i, t in odd_rows)
    found = sorted((r.doc_id is not None, r.doc_id or 0, r.key) for r in got.collect())
    assert [x[:2] for x in found] == [x[:2] for x in want]
    assert [x[2] for x in found] == pytest.approx([x[2] for x in want], rel=1e-4, abs=1e-4)
    cut = sorted((x[2] for x in found), reverse=True)[5]
    rows = got.collect()
    assert all(r.kept == (r.key >= cut) for r in rows) and sum(r.kept for r in rows) >= 6


def test_slices_count_like_the_whole_text(monkeypatch):
    text = prose(4, 900)
    whole = sorted(np.concatenate(list(dsir.buckets_of(text))).tolist())
    monkeypatch.setattr(dsir, "BLOCK_CHARS", 100)
    assert sorted(np.concatenate(list(dsir.buckets_of(text))).tolist()) == whole == sorted(grams(text))


def test_kth_largest_is_exact(spark):
    values = [float((i * 7919) % 1000) / 7 for i in range(1000)] + [3.5] * 50
    df = spark.createDataFrame([(v,) for v in values], "key double")
    for k in (1, 2, 500, 980, len(values)):
        assert dsir.kth_largest(df, k, bins=7) == sorted(values, reverse=True)[k - 1]


def test_draw_keeps_columns_and_agrees(spark, odd, labels):
    sampler, scored = dsir.resample(odd, labels, k=7)
    kept = dsir.drawn(odd, sampler)
    assert kept.columns == odd.columns
    count = lambda rows: collections.Counter(r.doc_id for r in rows)
    assert count(kept.collect()) == count(scored.where("kept").collect())


def test_without_target_or_rows(spark, odd, empty, labels):
    assert dsir.resample(odd, labels.where("false"))[1].where("NOT kept").count() == 0
    sampler, scored = dsir.resample(empty, labels)
    assert scored.count() == 0 and dsir.drawn(empty, sampler).count() == 0


def test_clean_documents_stay_and_junk_goes(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = labels.where("doc_id % 2 = 0")               # fitted on one half, judged on the other
    # With few labels the sampler draws two standard errors more than the trusted share.
    for most, rows in ((0.35, dsir.resample(docs, held)[1]), (0.2, llr_rules.judged(docs, held.where("quality = 1")).select(
            "row.doc_id", (F.col("rules.kept") | (F.col("rules.n_words") < 20)).alias("kept")))):
        judged = rows.join(labels.where("doc_id % 2 = 1"), "doc_id").groupBy("quality").agg(
            F.avg(F.col("kept").cast("int")).alias("share"))
        share = {r.quality: r.share for r in judged.collect()}
        assert share[1] > 0.97 and share[0] < most


def base(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = collections.Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(covered))


@pytest.mark.parametrize("which", ["odd", "table"])
def test_base_counts_equal_brute_force(spark, odd, labels, which):
    docs = odd if which == "odd" else spark.read.parquet(f"{SF}/documents.parquet")
    got = llr_rules.judged(docs, labels.where("quality = 1")).select("row.doc_id", "row.text", "rules.*").collect()
    assert len(got) == docs.count()
    for r in got:
        want = base(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert r.kept == (not r.base_failed and r.mean_llr >= llr_rules.THRESHOLD)


def rule_grams(text):
    """Buckets of unigrams and bigrams, hashed as chains of XXH64 from seed 42."""
    tokens = [t for t in re.split(r"[\x20\x09-\x0D]+", re.sub(r"([!-/:-@\[-`{-~]+)", r" \1 ", (text or "").lower())) if t]
    ones = [xxhash.xxh64_intdigest(t.encode(), 42) for t in tokens]
    pairs = []
    for i, h in enumerate(ones):
        seed = xxhash.xxh64_intdigest(struct.pack("<Q", ones[i - 1]), 42) if i else 42
        pairs.append(xxhash.xxh64_intdigest(struct.pack("<Q", h), seed))
    return [h % llr_rules.BUCKETS for h in ones + pairs]


@pytest.mark.parametrize("which", ["odd", "table"])
def test_log_ratios_equal_brute_force(spark, odd, labels, which):
    if which == "odd":
        docs, trusted = odd, labels.where("quality = 1")
    else:
        docs, trusted = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
        trusted = trusted.where("quality = 1")
    ids = {r.doc_id for r in trusted.collect()} - {None}
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    raw, target = collections.Counter(), collections.Counter()
    for i, t in rows:
        raw.update(rule_grams(t))
        if i in ids:
            target.update(rule_grams(t))
    share, e = sum(target.values()) / sum(raw.values()), llr_rules.EVIDENCE
    ratio = {b: math.log((target[b] + e) / (share * n + e)) for b, n in raw.items()}
    want = {}
    for i, t in rows:
        g = rule_grams(t)
        want.setdefault(i, []).append(sum(ratio[b] for b in g) / len(g) if g else 0.0)
    found = {}
    for r in llr_rules.judged(docs, trusted).select("row.doc_id", "rules.*").collect():
        found.setdefault(r.doc_id, []).append(r.mean_llr)
        assert r.kept == (not r.base_failed and r.mean_llr >= llr_rules.THRESHOLD)
    assert found.keys() == want.keys()
    for i in want:
        assert sorted(found[i]) == pytest.approx(sorted(want[i]), abs=1e-9)


def test_repeated_windows_overlap(spark):
    run = "a b c d e f g h i"
    texts = [run + " x " + run, (run + " ") * 3, "w " * 30, "a b c d e f g x a b c d e f g y", "the of " * 9]
    got = llr_rules.base_counts(table(spark, list(enumerate(texts))), F.col("text")).orderBy("doc_id").collect()
    assert [r.n_repeat_words for r in got] == [base(t)[4] for t in texts]


def test_rules_keep_columns(spark, odd, empty, labels):
    trusted = labels.where("quality = 1")
    kept = llr_rules.kept(odd, trusted)
    assert kept.columns == odd.columns
    want = [r for r in llr_rules.judged(odd, trusted).select("row.doc_id", "rules.kept").collect() if r.kept]
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted(r.doc_id or 0 for r in want)
    assert llr_rules.kept(empty, trusted).count() == 0
    without = llr_rules.judged(odd, trusted.where("false")).select("rules.mean_llr").collect()
    assert {r.mean_llr for r in without} == {0.0}


def test_every_trusted_document_counts(spark):
    docs = spark.range(60_200).select(F.col("id").alias("doc_id"), F.lit("one two").alias("text"))
    trusted = docs.where("doc_id % 200 <> 7").select("doc_id")
    trusted = trusted.unionByName(trusted.limit(50)).unionByName(trusted.limit(1).select(F.lit(None).cast("long").alias("doc_id")))
    got = marked_trusted(docs, trusted).groupBy("_trusted").count().collect()
    assert {r[0]: r[1] for r in got} == {True: 59_899, False: 301}
