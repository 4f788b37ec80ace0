"""SimHash links against every pair, and the guarantee of the masks."""

import itertools
import random

import numpy as np
import xxhash
from small_tables import prose, table

from leafstat.llm import covering
from leafstat.llm.linked import components


def plain_print(text):
    words = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in text or "")
    for gap in "\t\n\v\f\r":
        words = words.replace(gap, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def brute_roots(prints):
    root = {p: p for p in prints}
    for a, b in itertools.combinations(prints, 2):
        if (a ^ b).bit_count() <= 2 and root[a] != root[b]:
            gone, kept = root[b], root[a]
            root = {p: kept if r == gone else r for p, r in root.items()}
    return root


def test_masks_leave_out_every_small_set():
    for masks, positions in [(covering.TABLES, range(64)), *[
            ([m & ~t for m in finer], covering.open_positions(t)) for t, finer in zip(covering.TABLES, covering.FINER)]]:
        for pair in itertools.combinations(positions, 2):
            assert any(not (m >> pair[0] & 1 or m >> pair[1] & 1) for m in masks)
    assert all(len(covering.open_positions(m)) <= 12 for finer in covering.FINER for m in finer)


def test_linked_against_every_pair(spark, odd, odd_rows):
    found = covering.linked(odd).collect()
    prints = {(i, t): plain_print(t) for i, t in odd_rows}
    assert sorted(r.fingerprint for r in found) == sorted(f"{plain_print(t):016x}" for _, t in odd_rows)
    root = brute_roots(set(prints.values()))
    first = {}
    for (i, _), p in prints.items():
        if i is not None:
            first[root[p]] = min(first.get(root[p], i), i)
    want = sorted(((i, f"{plain_print(t):016x}", first.get(root[plain_print(t)])) for i, t in odd_rows), key=repr)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in found), key=repr) == want


def test_crowded_buckets_lose_no_link(spark, monkeypatch):
    """Many fingerprints that share all that a table keeps, so buckets are dealt again."""
    monkeypatch.setattr(covering, "CROWDED", 8)
    r = random.Random(4)
    base = r.getrandbits(64)
    prints = {base}
    while len(prints) < 300:
        near = base
        for p in r.sample(range(64), r.choice([1, 2, 3, 4, 6])):
            near ^= 1 << p
        prints.add(near)
    prints |= {r.getrandbits(64) for _ in range(200)}
    values = np.array(sorted(prints), np.uint64).view(np.int64).tolist()
    edges = covering.links(spark.createDataFrame([(v,) for v in values], "bits long"))
    found = {r.node % 2 ** 64: r.root % 2 ** 64 for r in components(edges).collect()}
    want = brute_roots(prints)
    groups = lambda d: sorted(sorted(p for p in prints if d.get(p, p) == g) for g in {d.get(p, p) for p in prints})
    assert groups(found) == groups(want)


def test_components_of_a_chain_a_star_and_repeats(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7), (5000, 5001), (5001, 5000)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)}, 5000: 5000, 5001: 5000}
    assert found == want


def test_deduplicated_and_empty(spark, empty):
    rows = [(3, prose(1, 50)), (1, prose(1, 50)), (1, prose(1, 50)), (2, prose(2, 50)), (None, prose(9, 30)), (None, prose(2, 50))]
    kept = covering.deduplicated(table(spark, rows))
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == [(False, 1), (False, 2), (True, None)]
    assert covering.linked(empty).count() == 0 and covering.deduplicated(empty).count() == 0


def test_table(spark):
    import __spark_entry__ as E
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: plain_print(r.text) for r in rows}
    root = brute_roots(set(prints.values()))
    first = {}
    for i, p in prints.items():
        first[root[p]] = min(first.get(root[p], i), i)
    found = E.queries()["op12_covering_simhash"](spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == {
        i: (f"{p:016x}", first[root[p]]) for i, p in prints.items()}
