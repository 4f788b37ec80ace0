"""Concatenated-batch resampling against a plain computation text by text."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from small_tables import table

from leafstat.llm import concatenated


def plain_features(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return [zlib.crc32(f.encode()) % 10_000 for f in [*words, *map(" ".join, zip(words, words[1:]))]], len(words)


def plain(docs, target):
    raw, aim = Counter(), Counter()
    for _, t in docs:
        raw.update(plain_features(t)[0])
    for t in target:
        aim.update(plain_features(t)[0])
    s_all, t_all = sum(raw.values()), sum(aim.values())
    gain = [math.floor(1000 * math.log((aim[b] + 1) * (s_all + 10_000) / ((raw[b] + 1) * (t_all + 10_000)))) for b in range(10_000)]
    rows = []
    for i, t in docs:
        f, words = plain_features(t)
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        rows.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + .5) / 4294967296))), words))
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0], r[1], r[2]))
    return rows, able[:25 * len(able) // 100], len(able)


def held(found, docs, target):
    rows, drawn, _ = plain(docs, target)
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score, r.n_words) for r in found), key=repr) == sorted(rows, key=repr)
    ranked = sorted((r for r in found if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.doc_id, r.score) for r in ranked] == [(r[0], r[3]) for r in drawn]


def test_odd_rows(spark, odd, odd_rows, empty):
    target = [(1, "the of and to"), (2, None), (3, "É漢字 one TWO")]
    held(concatenated.resampled(odd, table(spark, target)).collect(), odd_rows, [t for _, t in target])
    held(concatenated.resampled(odd, empty).collect(), odd_rows, [])
    assert concatenated.resampled(empty, odd).count() == 0
    drawn = concatenated.drawn(odd, table(spark, target))
    assert drawn.columns == odd.columns
    want = {r[0] for r in plain(odd_rows, [t for _, t in target])[1]}
    assert {r.doc_id for r in drawn.collect()} == want


def test_no_feature_crosses_a_document(monkeypatch):
    monkeypatch.setattr(concatenated, "_SPANS", 3)
    texts = ["a b", None, "", "C\x00d e", "\x00", "x", "É f g h i j k l", "漢 é"]
    bucket, of, words = concatenated.features([t.encode() if t is not None else None for t in texts])
    for i, t in enumerate(texts):
        want, n = plain_features(t)
        assert Counter(bucket[of == i].tolist()) == Counter(want) and words[i] == n


def test_gains_of_nothing():
    assert concatenated.gains(np.zeros(5, np.int64), np.zeros(5, np.int64)).tolist() == [0] * 5


def test_table(spark):
    import __spark_entry__ as E
    at = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{at}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{at}/benchmark.parquet").collect()]
    held(E.queries()["op13_concatenated_resampling"](spark, at).collect(), docs, target)
