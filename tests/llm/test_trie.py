"""The prefix trie against one built in plain Python, and its parentheses against a stack."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from leafstat.llm import prefix_trie
from leafstat.llm.parentheses import Parentheses

SCHEMA = "conv_id long, turn long, role string, text string, depth string, conv string, _salt string, members int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def made(spark, rows):
    return spark.createDataFrame([(*r, "d", "c", "s", 1) for r in rows], SCHEMA)


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + v[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, path in convs.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[c] for c in children[p]) or 1
        here = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        saved[p] = here + sum(saved[c] for c in children[p])
    out = []
    for p, who in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in who if len(convs[c]) == len(p)))
        out.append((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), len(children[p]), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def random_rows(seed, convs=60):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(3 * convs), convs):
        n = r.choice([1, 1, 2, 3, 5, 9, 14])
        copy = r.random() < .4
        rows += [(c, t, "user" if t % 2 else "", ("same %d é" % (t % 3)) if copy else "w%d" % r.randint(0, 2)) for t in range(n)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard", [3, 20_000])
def test_rebuilt_trie_against_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(prefix_trie, "SHARD_PATHS", shard)
    monkeypatch.setattr(prefix_trie, "ENDS_AT_ONCE", 4)
    rows = random_rows(shard)
    assert rows_of(prefix_trie.rebuilt_trie(made(spark, rows))) == brute(rebuilt(rows))


def test_plain_trie_with_copies_prefixes_and_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SHARD_PATHS", 4)
    rows = [(c, t, "u", f"t{t}") for c in range(30) for t in range(1 + c % 3)]          # copies, and prefixes of others
    rows += [(100 + c, t, "u", "t0" if t == 0 else f"{c}-{t}") for c in range(20) for t in range(4)]   # a hot first turn
    rows += [(500 + c, t, "a", f"long {t}") for c in range(2) for t in range(300)]
    convs = defaultdict(list)
    for c, _, r, t in rows:
        convs[c].append((r, t))
    assert rows_of(prefix_trie.plain_trie(made(spark, rows))) == brute(convs)


def test_odd_conversations(spark):
    rows = [(None, 0, "u", "lost"), (1, None, None, None), (1, 0, "u", "x"), (6, 3, "u", ""), (6, 3, "u", ""),
            (10, 0, "u", "y" * 100_000), (11, 0, "u", "z"), (-4, 0, "u", "neg"), (-5, 0, "u", "base")]
    found = rows_of(prefix_trie.rebuilt_trie(made(spark, rows)))
    assert found == brute(rebuilt(rows))
    assert sum(r[3] for r in found if r[1] == 0) == 6
    assert prefix_trie.rebuilt_trie(made(spark, rows).limit(0)).count() == 0


def test_table(spark):
    import __spark_entry__ as E
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(E.queries()["op11_prefix_trie"](spark, "/root/testdata/sf0.001")) == brute(rebuilt(rows))


@pytest.mark.parametrize("seed", range(6))
def test_parentheses(seed):
    r = random.Random(seed)
    walk, depth = [], 0
    for _ in range(r.choice([1, 40, 3000])):
        if depth == 0 or r.random() < .52:
            walk.append(True)
            depth += 1
        else:
            walk.append(False)
            depth -= 1
    walk = [True, *walk, *[False] * (depth + 1)]
    stack, partner = [], {}
    for i, opens in enumerate(walk):
        stack.append(i) if opens else partner.__setitem__(stack.pop(), i)
    p = Parentheses(np.array(walk))
    at = p.select()
    assert at.tolist() == sorted(partner)
    assert p.findclose(at).tolist() == [partner[i] for i in at.tolist()]
    assert p.rank(np.array([len(walk)])).tolist() == [sum(walk)]
    assert p.pair_rank(np.array([len(walk)])).tolist() == [sum(partner[i] == i + 1 for i in partner)]
