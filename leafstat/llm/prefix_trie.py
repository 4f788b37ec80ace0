"""Conversation prefix trie: balanced parentheses per shard, shared spines merged.

Conversations are sequences of turns (role, text).  Each distinct sequence of
first d turns is a node; what its members share is stored or computed once.

1. Every turn gets its place by one global order; a conversation of any length
   is spread over the tasks.  A node is named by running sums of its turns'
   hashes, so a turn's row knows its node and its parent, and no text travels.
2. Conversations that are equal count as one path.  Turns that only one path
   has need no trie: such a tail is a chain.  A path is its shared nodes and
   the first node of its tail.
3. Paths are put in one global order and cut into shards of SHARD_PATHS, each
   led by the path before it.  A shard's trie is a row of balanced parentheses
   (``Parentheses``): findclose delimits a node's subtree, rank turns it into a
   range of nodes, the rank of leaf pairs counts its leaves, and differences of
   cumulative arrays give its members and the sizes that its savings follow from.
4. Nodes on a shard's first or last path may go on in the shards beside it.  All
   their figures are sums in which a node counts in the shard where it starts,
   so the spines merge by adding up.

The savings of a node, the sum over its subtree of (members - 1) times the
bytes of the node's turn, equal the bytes of its members' turns from its depth
on, less those of the distinct nodes below it; both are such sums.

Defined cases: a null role or text is empty; null turns come first; equal turns
of a conversation follow each other by role and text hash, and each row is a
turn; rows without a conv_id belong to no conversation; conversations without
turns are members of the root alone; without any conversation there is no node;
extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafstat.functions.prefix import running_totals
from leafstat.llm.common import SALTS, landed, numbered, range_partitions, salt, with_group_value
from leafstat.llm.parentheses import Parentheses

SHARD_PATHS = 20_000       # distinct paths in a shard
ENDS_AT_ONCE = 4096        # conversation ids in a piece of an end list
_LANES = 4                 # running sums of 31-bit hashes that name a node
_LANE = (1 << 31) - 1
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """Thin rows (conv, place, h1, h2, size): place from 0, hashes of role and text, bytes of the text."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    thin = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), F.xxhash64(role, text).alias("h1"),
        F.xxhash64(text, role, F.lit(1)).alias("h2"), F.octet_length(text).cast("long").alias("size"))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("h1"), F.col("h2")]
    rows = numbered(landed(thin, "turns"), order, "_n", "turn-order")
    firsts = rows.groupBy("conv").agg(F.min("_n").alias("_first"))
    return rows.join(firsts, "conv").select("conv", (F.col("_n") - F.col("_first")).alias("place"), "h1", "h2", "size")


def rebuilt(rows: DataFrame, every: int = 5, modulus: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on a shared start: h = crc32(conv) % modulus turns of
    conversation conv - conv % every (all if fewer), then their own after the first h.

    Returns (conv, depth, h1, h2, size, length), depth from 1, and the conversations (conv, length).
    """
    held = rows.groupBy("conv").agg(F.count("*").alias("n"))
    base = F.col("conv") - F.pmod("conv", F.lit(every))
    starts = held.select(F.col("conv").alias("_base"), F.col("n").alias("_base_n"))
    convs = (held.withColumn("_base", base).join(starts, "_base", "left")
             .withColumn("h", F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(modulus)))
             .withColumn("begun", F.least("h", F.coalesce("_base_n", F.lit(0))))
             .select("conv", "_base", "h", "begun", (F.col("begun") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")))
    convs = landed(convs, "conversations")
    own = (rows.join(convs, "conv").where("place >= h")
           .select("conv", (F.col("begun") + F.col("place") - F.col("h") + 1).alias("depth"), "h1", "h2", "size", "length"))
    lent = rows.where((F.col("place") < modulus - 1) & (F.pmod("conv", F.lit(every)) == 0)).withColumnRenamed("conv", "_base")
    lent = (lent.join(convs, "_base").where("place < h")
            .select("conv", (F.col("place") + 1).alias("depth"), "h1", "h2", "size", "length"))
    return own.unionByName(lent), convs.select("conv", "length")


def _name(lanes: list[Column]) -> list[Column]:
    return [F.xxhash64(*lanes), F.xxhash64(F.lit(1), *lanes)]


def placed(rows: DataFrame) -> DataFrame:
    """Each turn with its node (n1, n2), parent node (q1, q2; the root: 0, 0) and
    ``before``, the bytes of the turns before it."""
    lanes = [f"_l{i}" for i in range(_LANES)]
    hashed = rows
    for i, lane in enumerate(lanes):
        hashed = hashed.withColumn(lane, F.xxhash64(F.lit(i), "depth", "h1", "h2").bitwiseAND(F.lit(_LANE)))
    hashed = landed(hashed.drop("h1", "h2"), "rebuilt")
    sums = {f"_s{i}": lane for i, lane in enumerate(lanes)}
    parts = range_partitions(rows.sparkSession, hashed.count())
    run = running_totals(hashed, ["conv"], ["depth"], {**sums, "_bytes": "size"}, num_partitions=parts)
    n1, n2 = _name([F.col(s) for s in sums])
    p1, p2 = _name([F.col(s) - F.col(lane) for s, lane in sums.items()])
    top = F.col("depth") == 1
    return landed(run.select("conv", "depth", "length", "size", (F.col("_bytes") - F.col("size")).alias("before"),
                             n1.alias("n1"), n2.alias("n2"), F.when(top, F.lit(0)).otherwise(p1).alias("q1"),
                             F.when(top, F.lit(0)).otherwise(p2).alias("q2")), "nodes-by-turn")


def ends_of(ends: DataFrame) -> DataFrame:
    """(n1, n2, ends_sha256): SHA-256 of the decimal conv ids that end at a node, ascending, comma-joined.

    Ids are range-sorted by (node, id), so a node where a third of all
    conversations end is joined up by many tasks; what meets in one task then
    is a stream of long pieces that goes through one hash.
    """
    def pieces(batches):
        last, first, held = None, None, []
        for batch in batches:
            out = []
            for n1, n2, conv in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (n1, n2) != last or len(held) == ENDS_AT_ONCE:
                    if held:
                        out.append((*last, first, ",".join(held)))
                    last, first, held = (n1, n2), conv, []
                held.append(str(conv))
            if out:
                yield pa.record_batch([list(c) for c in zip(*out)], names=["n1", "n2", "first", "ids"])
        if held:
            yield pa.record_batch([[x] for x in (*last, first, ",".join(held))], names=["n1", "n2", "first", "ids"])

    def digests(batches):
        last, sha = None, None
        for batch in batches:
            out = []
            for n1, n2, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if (n1, n2) == last:
                    sha.update(b",")
                else:
                    if last:
                        out.append((*last, sha.hexdigest()))
                    last, sha = (n1, n2), hashlib.sha256()
                sha.update(ids.encode())
            if out:
                yield pa.record_batch([list(c) for c in zip(*out)], names=["n1", "n2", "ends_sha256"])
        if last:
            yield pa.record_batch([[x] for x in (*last, sha.hexdigest())], names=["n1", "n2", "ends_sha256"])

    parts = range_partitions(ends.sparkSession, 0)
    joined = (ends.select("n1", "n2", "conv").repartitionByRange(parts, "n1", "n2", "conv").sortWithinPartitions("n1", "n2", "conv")
              .mapInArrow(pieces, "n1 long, n2 long, first long, ids string"))
    return (joined.repartition("n1", "n2").sortWithinPartitions("n1", "n2", "first")
            .mapInArrow(digests, "n1 long, n2 long, ends_sha256 string"))


def _paths(steps: DataFrame, ends: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row for each distinct path, and the turns of the paths that have a node alone.

    A path: conv (its smallest member), members, total (bytes of its turns),
    length, key (names of its shared nodes in turn), sizes, and the tail's
    first node (t1, t2, t_size).
    """
    distinct = ends.groupBy("n1", "n2").agg(F.min("conv").alias("conv"), F.count("*").alias("members"),
                                            F.max("total").alias("total"), F.max("length").alias("length"))
    distinct = landed(distinct.drop("n1", "n2"), "distinct-paths")
    rows = steps.drop("length").join(distinct, "conv")
    rows = landed(with_group_value(rows, ["n1", "n2"], "conv", F.count("*"), F.sum, "paths"), "path-turns")
    node = F.struct("depth", "n1", "n2", "size")
    found = rows.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.when(F.col("paths") > 1, node))).alias("_shared"),
        F.min(F.when(F.col("paths") == 1, node)).alias("_tail"))
    paths = distinct.join(found, "conv", "left").withColumn("_shared", F.coalesce("_shared", F.array().cast(
        "array<struct<depth:long,n1:long,n2:long,size:long>>")))
    key = F.flatten(F.transform("_shared", lambda x: F.array(x.n1, x.n2)))
    paths = paths.select("conv", "members", "total", "length", key.alias("key"), F.col("_shared.size").alias("sizes"),
                         F.col("_tail.n1").alias("t1"), F.col("_tail.n2").alias("t2"), F.col("_tail.size").alias("t_size"))
    return landed(paths, "paths"), rows.where("paths = 1")


_NODE = ("n1 long, n2 long, q1 long, q2 long, depth long, before long, conv long, members long, summed long, distinct long, "
         "children long, leaves long, spine boolean, parent_spine boolean, parent_conv long")


def _least(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Least value of each range [lo, hi), by a table of the least of 1, 2, 4, ... values."""
    table = [values]
    while 2 << len(table) - 1 <= len(values):
        half = 1 << len(table) - 1
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    level = np.frexp(hi - lo)[1] - 1
    out = np.empty(len(lo), np.int64)
    for k in np.unique(level):
        at = level == k
        out[at] = np.minimum(table[k][lo[at]], table[k][hi[at] - (1 << int(k))])
    return out


def shard_nodes(rows: list[dict]) -> pa.RecordBatch:
    """The nodes of a shard's trie, from its paths in order; the first may be
    the path before the shard (``guard``), whose nodes count elsewhere."""
    names, sizes, parents, depths, befores, olds = [(0, 0)], [0], [-1], [0], [0], [False]
    tails, own, members, summed, convs = [False], [0], [0], [0], [np.iinfo(np.int64).max]
    more = [0]                                              # children beyond the trie: the rest of a tail
    walk, stack, last = [True], [0], []

    def enter(name, size, old, tail):
        up = stack[-1]
        names.append(name), sizes.append(size), parents.append(up), depths.append(len(stack))
        befores.append(befores[up] + sizes[up]), olds.append(old), tails.append(tail)
        own.append(0 if old else size), members.append(0), summed.append(0), convs.append(np.iinfo(np.int64).max)
        more.append(0), walk.append(True), stack.append(len(names) - 1)

    guard = rows[0] if rows[0]["guard"] else None
    before_key = guard["key"] if guard else None
    olds[0] = guard is not None
    for r in rows[1 if guard else 0:]:
        path = list(zip(r["key"][::2], r["key"][1::2]))
        same = 0
        while same < min(len(path), len(last)) and path[same] == last[same]:
            same += 1
        while len(stack) > same + 1:
            stack.pop()
            walk.append(False)
        known = 0                                           # nodes of the first path that the guard has entered
        if before_key is not None:
            while known < len(path) and r["key"][2 * known:2 * known + 2] == before_key[2 * known:2 * known + 2]:
                known += 1
            before_key = None
        for d in range(same, len(path)):
            enter(path[d], r["sizes"][d], d < known, False)
        last = path
        if r["t1"] is not None:
            enter((r["t1"], r["t2"]), r["t_size"], False, True)
            own[-1] = r["total"] - befores[-1]              # of the whole tail
            more[-1] = int(r["length"] > depths[-1])
        end = len(names) - 1 if r["t1"] is not None else stack[-1]
        members[end], summed[end], convs[end] = r["members"], r["members"] * r["total"], r["conv"]
        if r["t1"] is not None:
            stack.pop()
            walk.append(False)
    open_at_end = list(stack)
    walk += [False] * len(stack)

    trie = Parentheses(np.array(walk))
    at = trie.select()
    close = trie.findclose(at)
    lo, hi = trie.rank(at), trie.rank(close)
    of = lambda values: (lambda total: total[hi] - total[lo])(np.concatenate([[0], np.cumsum(np.array(values, np.int64))]))
    up, old, tail = np.array(parents), np.array(olds), np.array(tails)
    leaves = trie.pair_rank(close + 1) - trie.pair_rank(at)
    if not tail[-1]:                                        # the last path's node goes on in the next shard
        leaves -= (lo <= len(names) - 1) & (hi == len(names))
    spine = old.copy()
    spine[open_at_end] = True
    least = _least(np.array(convs, np.int64), lo, hi)
    children = np.bincount(up[1:][~old[1:]], minlength=len(names)) + np.array(more)
    named = np.array(names, np.int64)
    over = np.maximum(up, 0)
    return pa.record_batch(
        [pa.array(x) for x in (
            named[:, 0], named[:, 1], named[over, 0], named[over, 1], np.array(depths, np.int64), np.array(befores, np.int64), least,
            of(members), of(summed), of(own), children.astype(np.int64), leaves.astype(np.int64), spine, spine[over], least[over])],
        names=[c.split()[0] for c in _NODE.split(", ")])


def _sharded(paths: DataFrame) -> DataFrame:
    """The nodes of every shard's trie."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != shard and held:
                    yield shard_nodes(held)
                    held = []
                shard = row["shard"]
                held.append(row)
        if held:
            yield shard_nodes(held)

    # A path that ends at a shared node comes before those that go on there, so only a shard's last
    # path can leave a node without its children.
    ordered = numbered(paths, [F.col("key"), F.col("t1").isNotNull(), F.col("conv")], "_n", "path-order")
    ordered = ordered.withColumn("shard", F.floor(F.col("_n") / SHARD_PATHS)).withColumn("guard", F.lit(False))
    guards = (ordered.where((F.col("_n") + 1) % SHARD_PATHS == 0).withColumn("shard", F.col("shard") + 1)
              .withColumn("guard", F.lit(True)))
    rows = paths.count()
    every = ordered.unionByName(guards.where((F.col("_n") + 1) < rows))
    return every.repartition("shard").sortWithinPartitions("shard", "_n").drop("_n").mapInArrow(run, _NODE)


def _merged(nodes: DataFrame) -> DataFrame:
    """Nodes of all shards, those on the spines merged, each with its parent's smallest member."""
    key = ["n1", "n2"]
    add = [F.sum(c).alias(c) for c in ("members", "summed", "distinct", "children", "leaves")]
    spines = landed(nodes.where("spine").groupBy(*key).agg(
        *add, F.min("conv").alias("conv"), *[F.max(c).alias(c) for c in ("q1", "q2", "depth", "before")]), "spines")
    columns = [*key, "q1", "q2", "depth", "before", "conv", "members", "summed", "distinct", "children", "leaves"]
    inner = nodes.where("NOT spine")
    # A spine node may have a third of all nodes below it, so its row meets them once for each salt.
    named = spines.select(F.col("n1").alias("q1"), F.col("n2").alias("q2"), F.col("conv").alias("parent_conv"),
                          F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    below = inner.where("parent_spine").select(*columns).unionByName(spines.select(*columns).where("depth > 0"))
    below = below.withColumn("_salt", salt(F.col("n1"))).join(named, ["q1", "q2", "_salt"]).drop("_salt")
    root = spines.where("depth = 0").select(*columns, F.lit(None).cast("long").alias("parent_conv"))
    return (inner.where("NOT parent_spine").select(*columns, "parent_conv")
            .unionByName(below.select(*columns, "parent_conv")).unionByName(root))


def trie(steps: DataFrame, convs: DataFrame) -> DataFrame:
    """All nodes of the conversations ``convs`` (conv, length) whose turns are
    ``steps`` (of ``placed``): n1, n2, conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    root = F.lit(0).cast("long")
    ends = (steps.where("depth = length").select("n1", "n2", "conv", "length", (F.col("before") + F.col("size")).alias("total"))
            .unionByName(convs.where("length = 0").select(root.alias("n1"), root.alias("n2"), "conv", F.col("length").cast("long"),
                                                          root.alias("total"))))
    ends = landed(ends, "ends")
    paths, alone = _paths(steps, ends)
    nodes = _merged(landed(_sharded(paths), "shard-nodes"))
    shared = nodes.select(
        "n1", "n2", F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"),
        F.col("members").alias("n_convs"), F.col("children").alias("n_children"),
        F.greatest("leaves", F.lit(1)).alias("n_leaves"),
        (F.col("summed") - F.col("members") * F.col("before") - F.col("distinct")).alias("saved_tokens"))
    tails = alone.join(paths.where("t1 IS NOT NULL").select(F.col("t1").alias("n1"), F.col("t2").alias("n2")), ["n1", "n2"], "left_anti")
    tails = tails.select(
        "n1", "n2", F.col("conv").alias("conv_id"), "depth", F.col("conv").alias("parent_conv_id"), F.col("members").alias("n_convs"),
        (F.col("depth") < F.col("length")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("members") - 1) * (F.col("total") - F.col("before"))).alias("saved_tokens"))
    return (shared.unionByName(tails).join(ends_of(ends), ["n1", "n2"], "left")
            .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))))


def rebuilt_trie(conversations: DataFrame, every: int = 5, modulus: int = 9) -> DataFrame:
    """``trie`` of the conversations rebuilt by ``rebuilt``."""
    rows, convs = rebuilt(landed(turns(conversations), "turn-places"), every, modulus)
    return trie(placed(rows), convs)


def plain_trie(conversations: DataFrame) -> DataFrame:
    """``trie`` of the conversations as they are."""
    rows = landed(turns(conversations), "turn-places")
    convs = landed(rows.groupBy("conv").agg(F.count("*").alias("length")), "conversations")
    steps = rows.join(convs, "conv").select("conv", (F.col("place") + 1).alias("depth"), "h1", "h2", "size", "length")
    return trie(placed(steps), convs)
