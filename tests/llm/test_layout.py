"""Sharding, token-id files and packing against brute force."""

import collections
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from leafstat.llm import packing, shard, tokens, vbyte

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, text, end):
    return np.asarray([*library.encode(text or "", add_special_tokens=False).ids, end], "<u4")


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_feistel_is_a_permutation(n):
    rows = np.arange(n)
    places = shard.permuted(rows, n)
    assert sorted(places.tolist()) == rows.tolist()
    assert (shard.permuted(places, n, back=True) == rows).all()
    at, slot = shard.place_of(rows, n, 7)
    assert (shard.row_of(at, slot, n, 7) == rows).all()
    if n > 100:
        assert (places != rows).mean() > 0.9 and (shard.permuted(rows, n, seed=5) != places).mean() > 0.9


def test_shards(spark, odd, odd_rows, empty):
    got = shard.sharded(odd, 4).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r["size"], r.text_crc32) for r in got) == sorted(
        (i is not None, i or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in odd_rows)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert [r.doc_id for r in sorted(got, key=lambda r: r.row)] == sorted(
        (i for i, _ in odd_rows), key=lambda i: (i is not None, i or 0))
    assert shard.sharded(empty, 4).count() == 0


def test_numbering_is_reproducible(spark, odd):
    key = lambda r: (r.doc_id is not None, r.doc_id or 0, r["size"], r.shard, r.slot)
    a, b = (sorted(map(key, shard.sharded(d, 4).collect())) for d in (odd, odd.repartition(7)))
    assert a == b


def test_byte_code():
    r = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 1000):
        ranks = (r.integers(0, 1 << 32, n, np.uint64) >> r.integers(0, 32, n, np.uint64)).astype("<u4")
        control, data = vbyte.packed(ranks)
        assert len(control) == -(-n // 4) and (vbyte.unpacked(control, data, n) == ranks).all()
    assert len(vbyte.packed(np.asarray([255, 256, 65536, 1 << 24]))[1]) == 1 + 2 + 3 + 4


def test_encoder_equals_the_library(library, odd_rows):
    texts = [t for _, t in odd_rows] + ["It's a TEST_42, naïve don't!", "a<|startoftext|>b", "İ Σίσυφος ﬁ", "\x85\xa0x"]
    found = tokens.Encoder(PATH).encode(texts)
    assert found == [ids(library, t, 0)[:-1].tobytes() for t in texts]
    assert list(tokens.batches_of([])) == [] and list(tokens.batches_of(["ab", None, "c"], 2)) == [(0, 1), (1, 3)]


def test_id_files(spark, odd, odd_rows, empty, library, monkeypatch):
    monkeypatch.setattr(vbyte, "BLOCK_IDS", 50)
    got = sorted(vbyte.written_and_read(odd, PATH, 2).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in odd_rows), key=lambda i: (i is not None, i or 0))
    want, at = collections.Counter(), 0
    for i, t in odd_rows:
        x = ids(library, t, 2)
        want[i, len(x), zlib.crc32(x.tobytes())] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert vbyte.written_and_read(empty, PATH, 2).count() == 0


def placed(counts, plan):
    capacity = len(counts) - 1
    lengths = np.repeat(np.arange(capacity + 1)[::-1], counts[::-1])
    seq, off = plan.places(np.arange(len(lengths)))
    free = collections.defaultdict(list)
    for s, o, n in zip(seq.tolist(), off.tolist(), lengths.tolist()):
        free[s].append((o, n))
    for parts in free.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    assert len(free) == plan.sequences
    return plan.sequences


@pytest.mark.parametrize("n,low,high", [(0, 1, 2), (1, 1, 4097), (40, 1, 4097), (4000, 1, 4097), (3000, 1300, 2100), (500, 1, 3),
                                        (300, 4096, 4097), (900, 700, 701)])
def test_plans_are_packings(n, low, high):
    counts = np.bincount(np.random.default_rng(n).integers(low, high, n), minlength=4097)
    tokens_ = int((counts * np.arange(4097)).sum())
    used = placed(counts, packing.planned(counts))
    ordered, rooms = np.repeat(np.arange(4097), counts)[::-1], []
    for length in ordered.tolist():                       # best fit, one by one
        fits = [r for r in rooms if r >= length]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else 4096) - length)
    assert -(-tokens_ // 4096) <= used <= max(1.04 * len(rooms), len(rooms) + 2)


def test_packed_documents(spark, odd, odd_rows, empty, library):
    got = packing.packed_documents(odd, PATH, 1).collect()
    want = collections.Counter()
    for i, t in odd_rows:
        x = ids(library, t, 1)
        for p in range(0, len(x), 4096):
            want[i, p // 4096, p, len(x[p:p + 4096]), zlib.crc32(x[p:p + 4096].tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    rooms = collections.defaultdict(list)
    for r in got:
        rooms[r.sequence_id].append((r.offset, r.length))
    for parts in rooms.values():
        assert [o for o, _ in sorted(parts)] == np.cumsum([0, *[n for _, n in sorted(parts)]])[:-1].tolist()
        assert sum(n for _, n in parts) <= 4096
    assert packing.packed_documents(empty, PATH, 1).count() == 0
