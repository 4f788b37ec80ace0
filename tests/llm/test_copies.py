"""LSH forest, bottom-k fingerprints and licence digests against brute force."""

import collections
import hashlib
import random
import re
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from leafstat.llm import bottomk, licenses, lsh_forest
from leafstat.llm.linked import components

from small_tables import prose, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(text or "")
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) or frozenset({tuple(w)} if w else ())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def near_copies():
    r = random.Random(3)
    rows = [(i, prose(100 + i, r.randint(1, 90))) for i in range(60)]
    base = prose(7, 120).split()
    for i in range(60, 130):                              # near copies of one text, some of them chained
        words = list(base)
        for _ in range(r.randint(0, 4)):
            words[r.randrange(len(words))] = f"edit{i}"
        rows.append((i, " ".join(words)))
    return rows + [(200 + i, rows[60 + i % 3][1]) for i in range(40)]


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    classes = collections.defaultdict(list)
    for i, s in sets:
        classes[s].append(i)
    keys = list(classes)
    parent = list(range(len(keys)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = collections.Counter()
    for x in range(len(keys)):
        for y in range(x):
            if keys[x] and keys[y] and jaccard(keys[x], keys[y]) >= 0.8:
                links[x] += 1
                links[y] += 1
                parent[find(x)] = find(y)
    none_last = lambda i: (i is None, i or 0)
    members = collections.defaultdict(list)
    for x, k in enumerate(keys):
        members[find(x)] += classes[k]
    return {(i, s): (min(members[find(x)], key=none_last), links[x], min(classes[s], key=none_last), len(classes[s]) - 1)
            for x, s in enumerate(keys) for i in classes[s]}


@pytest.mark.parametrize("block", [1024, 5])
def test_join_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(lsh_forest, "BLOCK_CLASSES", block)
    rows = near_copies()
    texts, want = dict(rows), brute(rows)
    got = lsh_forest.joined(table(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.class_id, r.n_links, r.copy_of, r.n_copies) == want[r.doc_id, shingles(texts[r.doc_id])]


def test_odd_rows_join(spark, odd, odd_rows, empty):
    want = collections.Counter((i, *v) for (i, _), v in ((k, brute(odd_rows)[k]) for k in (
        (i, shingles(t)) for i, t in odd_rows)))
    got = collections.Counter((r.doc_id, r.class_id, r.n_links, r.copy_of, r.n_copies)
                              for r in lsh_forest.joined(odd).collect())
    assert got == want
    assert lsh_forest.joined(empty).count() == 0


def test_representatives(spark, odd, odd_rows, empty):
    kept = lsh_forest.representatives(odd)
    assert kept.columns == odd.columns
    found = [r.doc_id for r in kept.collect()]
    assert sorted(found, key=str) == sorted({v[0] for v in brute(odd_rows).values()}, key=str)
    rows = near_copies()
    want = {v[0] for v in brute(rows).values()}
    assert {r.doc_id for r in lsh_forest.representatives(table(spark, rows)).collect()} == want
    assert lsh_forest.representatives(empty).count() == 0


def test_matching_stops_at_the_measured_recall():
    close, far, none = (np.zeros(lsh_forest.BINS) for _ in range(3))
    close[-1] = far[0] = 10_000
    after = lambda found, d=lsh_forest.DEPTH, t=lsh_forest.TARGET: lsh_forest.next_depth(found, d, t)
    assert after(close) is None and after(far) == lsh_forest.LEAST_DEPTH and after(far, lsh_forest.LEAST_DEPTH) is None
    assert after(none) == lsh_forest.LEAST_DEPTH                    # nothing found proves nothing
    assert [after(far, t=t) for t in (0.9, 0.97, 0.99)] == [None, 7, 6]
    shares = [lsh_forest.predicted(far, lsh_forest.DEPTH, d) for d in range(lsh_forest.DEPTH, lsh_forest.LEAST_DEPTH - 1, -1)]
    assert shares == sorted(shares) and shares[-1] > 0.998


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (90, 95)], "a long, b long")
    found = {r.node: r.root for r in components(edges).collect()}
    assert found == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}


def test_fingerprints_equal_brute_force(spark, odd, odd_rows, empty):
    got = bottomk.compared(odd).collect()
    assert len(got) == len(odd_rows)
    prints = collections.defaultdict(set)
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    order = sorted((i for i, _ in odd_rows if i is not None))
    texts = {i: t or "" for i, t in odd_rows if i is not None}
    for i, nxt in zip(order, order[1:]):
        t, n = texts[i], texts[nxt]
        cut = len(t) // 4
        edited = t[:len(t) - cut] + n[:cut]
        r = next(x for x in by[i] if x.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest())
        assert r.n_chars == len(t)
        assert abs(r.near_edited - jaccard(shingles(t), shingles(edited))) < 0.2
        assert abs(r.near_next - jaccard(shingles(t), shingles(n))) < 0.2
        assert abs(r.n_shingles - len(shingles(t))) <= 0.4 * len(shingles(t))
        prints[t].add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    assert bottomk.compared(empty).count() == 0


def plain_sketch(text):
    """The k smallest shingle hashes, each a chain of XXH64 over the hashes of its words."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    words = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in WORD.findall(text or "")]
    runs = [words[i:i + 5] for i in range(max(1, len(words) - 4))] if words else []
    found = set()
    for run in runs:
        seed = 42
        for w in run:
            seed = xxhash.xxh64_intdigest(struct.pack("<q", w), seed)
        found.add(signed(seed))
    return "".join(f"{h % (1 << 64):016x}" for h in sorted(found)[:bottomk.K])


def test_fingerprints_are_the_bottom_k(spark, odd, odd_rows):
    want = sorted(plain_sketch(t) for _, t in odd_rows)
    assert sorted(r.fingerprint for r in bottomk.compared(odd).collect()) == want


def test_blocks_stay_small_wherever_the_ids_lie(spark, monkeypatch):
    rows = [(i, f"t{i}") for i in range(2000)] + [(10 ** 13, "far")] + [(None, f"n{i}") for i in range(900)] + [(5, f"five{i}") for i in range(900)]
    df = table(spark, rows)
    sizes = [r["count"] for r in bottomk._blocked(df, "doc_id", "text").groupBy("block").count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= bottomk.BLOCK_ROWS
    monkeypatch.setattr(bottomk, "MOST_BLOCKS", 10)
    monkeypatch.setattr(bottomk, "FAN", 4)
    blocked = bottomk._blocked(df, "doc_id", "text")
    assert blocked.select("block").distinct().count() == 10
    bounds = blocked.groupBy("block").agg(F.min(bottomk._key(F.col("doc_id"), F.col("h"))).alias("a"),
                                          F.max(bottomk._key(F.col("doc_id"), F.col("h"))).alias("z")).orderBy("block").collect()
    assert all(tuple(x.z) < tuple(y.a) for x, y in zip(bounds, bounds[1:]))


def test_null_ids_come_first_and_repeated_rows_follow_each_other(spark):
    rows = [(2, "b " * 40), (None, "first " * 40), (1, "a " * 40), (1, "a " * 40)]
    got = [(r.doc_id, r.edited_sha256) for r in bottomk.compared(table(spark, rows)).collect()]
    edit = lambda t, n: hashlib.sha256((t[:len(t) - len(t) // 4] + n[:len(t) // 4]).encode()).hexdigest()
    a, b, first = "a " * 40, "b " * 40, "first " * 40
    assert sorted(got, key=str) == sorted([(None, edit(first, a)), (1, edit(a, a)), (1, edit(a, b)), (2, edit(b, first))], key=str)


def test_last_document_is_followed_by_the_first(spark):
    rows = [(i * 10 ** 15, prose(i, 30)) for i in range(-3, 5)]
    got = {r.doc_id: r for r in bottomk.compared(table(spark, rows)).collect()}
    for (i, t), (_, n) in zip(rows, rows[1:] + rows[:1]):
        edited = t[:len(t) - len(t) // 4] + n[:len(t) // 4]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    one = bottomk.compared(table(spark, [(3, "a b c d e f")])).first()
    assert one.near_next == 1.0


def test_sketches_merge(spark):
    parts = [prose(i, 400) for i in range(6)]
    df = table(spark, list(enumerate(parts)) + [(9, None)]).withColumn("g", (F.col("doc_id") % 2).cast("long"))
    sketches = bottomk.sketched(df, F.coalesce("text", F.lit("")), "s").select("g", "s")
    merged = {r.g: r.s for r in bottomk.merged(sketches, "g", "s").collect()}
    for g in (0, 1):
        union = sorted({h for r in sketches.where(F.col("g") == g).collect() for h in r.s})
        assert merged[g] == union[:bottomk.K]
    n = len(set().union(*(shingles(p) for p in parts[::2])))
    got = spark.createDataFrame([(merged[0],)], "s array<long>").select(bottomk.distinct_count(F.col("s"))).first()[0]
    assert abs(got - n) < 0.4 * n


def test_estimates_of_small_sets(spark):
    df = spark.createDataFrame([([1, 2, 3], [2, 3, 4]), ([], []), ([], [1])], "a array<long>, b array<long>")
    got = df.select(bottomk.resemblance(F.col("a"), F.col("b")).alias("r"),
                    bottomk.containment(F.col("a"), F.col("b")).alias("c")).collect()
    assert [r.r for r in got] == [0.5, 1.0, 0.0] and got[0].c == pytest.approx(2 / 3) and got[1].c == 1.0


def test_licences(spark, odd, odd_rows, empty):
    mit = licenses.KNOWN[0][1]
    variants = ["Copyright (c) 2020 A. Person\nAll rights reserved.\n\n" + mit, mit.upper(),
                mit.replace(", ", " ,\n * ").replace("sublicense", "sub-license"), "© 2019 B\n" + mit.replace('"', "”"),
                mit + " more", "Copyright notices are text.", None, "***"]
    rows = list(enumerate(variants)) + [(20, "x y\nLICENCED under the Apache Licence, version 2.0\nReleased under the MIT license"),
                                        (21, "Licensed under the Apache License, Version 2.0.")]
    got = {r.doc_id: r for r in licenses.scanned(table(spark, rows), licenses.known_texts(spark)).collect()}
    assert [got[i].license_id for i in range(8)] == ["MIT"] * 4 + [None] * 4
    assert got[6].canonical_sha256 == got[7].canonical_sha256 == hashlib.sha256(b"").hexdigest()
    assert (got[20].license_id, got[20].line_licenses) == (None, "Apache-2.0,MIT")
    assert (got[21].license_id, got[21].line_licenses) == ("Apache-2.0", "Apache-2.0")
    again = licenses.scanned(odd, licenses.known_texts(spark))
    assert sorted(r.doc_id or 0 for r in again.collect()) == sorted(i or 0 for i, _ in odd_rows)
    assert licenses.scanned(empty, licenses.known_texts(spark)).count() == 0


def test_titled_licences_and_long_texts(spark):
    rows = [(i, f"{title}\n\nCopyright (c) 2021 Someone\n\n{text}") for i, (text, title) in enumerate(
        (text, title) for name, text in licenses.KNOWN if len(text) > 500 for title in licenses.TITLES[name])]
    got = {r.license_id for r in licenses.scanned(table(spark, rows), licenses.known_texts(spark)).collect()}
    assert got == {"MIT", "ISC", "0BSD"}
    known = {r.digest: r.license_id for r in licenses.digests(licenses.known_texts(spark)).collect()}
    assert licenses.DIGESTS.items() <= known.items()


def test_licence_folder(spark, tmpdir_path):
    text = prose(1, 50)
    with open(f"{tmpdir_path}/Own-1.0", "w") as file:
        file.write("(c) 1999 someone\n" + text.upper())
    known = licenses.known_texts(spark, tmpdir_path)
    assert licenses.scanned(table(spark, [(1, text)]), known).first().license_id == "Own-1.0"
