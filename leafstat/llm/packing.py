"""Best-fit packing by linear grouping.

Documents are tokenised and cut into pieces of at most CAPACITY tokens; the
pieces are packed into sequences of that many tokens.

The plan depends on the histogram of the pieces' lengths alone, so it has the
same size at any scale (CAPACITY counts).  Large lengths, sorted, are split
into groups of equal cardinality and rounded up to the largest of their
group; configurations of these few sizes are optimised by column generation
(linear programme, patterns from a knapsack), and their whole multiples are
used.  The actual pieces then take the places of the rounded ones, and the
pieces left over, the small ones among them, go by best fit, largest first,
into the room that is left, or into new sequences.

The pieces are numbered in descending order of length by a range sort of thin
rows, and each finds its sequence and offset from its number and the plan.

Defined cases: a null text counts as empty and is a piece with the end id
alone; equal rows are packed each; a null id stays null and is packed like any;
an empty table has no sequence; extra columns are not looked at.
"""

from __future__ import annotations

import bisect
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafstat.llm.common import landed, numbered, size_batches
from leafstat.llm.tokens import batches_of, encoder

CAPACITY = 4096
LARGE = 8                  # lengths over CAPACITY / LARGE are large
GROUPS = (12, 16, 24, 64)  # numbers of groups that are tried; the fewest sequences win
ROUNDS = 1000              # of column generation at most


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's pieces."""
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, j in batches_of(texts):
                rows = [(doc, p // (4 * capacity), p // 4, len(cut := run_ids[p:p + 4 * capacity]) // 4, zlib.crc32(cut))
                        for doc, run_ids in zip(ids[i:j], (x + end for x in encoder(tokenizer).encode(texts[i:j])))
                        for p in range(0, len(run_ids), 4 * capacity)]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES)

    size_batches(docs.sparkSession)
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long"))


_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]
_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]


@dataclass
class Plan:
    """Where the pieces lie, by their number in descending order of length.

    Of the numbers from ``first`` on, ``per`` share a sequence, ``length``
    tokens apart; ``at`` is how many of a sequence's own were before.
    """

    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    per: np.ndarray
    at: np.ndarray
    length: np.ndarray
    sequences: int

    def places(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces with the given numbers."""
        s = np.searchsorted(self.first, rows, "right") - 1
        k = rows - self.first[s] + self.at[s]
        return self.sequence[s] + k // self.per[s], self.offset[s] + k % self.per[s] * self.length[s]


def _knapsack(sizes: np.ndarray, values: np.ndarray, capacity: int) -> np.ndarray:
    """Copies of each size that are worth most within the capacity."""
    best, picks = np.zeros(capacity + 1), []
    for _ in range(capacity // int(sizes.min())):                  # one more piece each time
        more, pick = best.copy(), np.full(capacity + 1, -1)
        for g, (size, value) in enumerate(zip(sizes.tolist(), values.tolist())):
            gain = best[:capacity + 1 - size] + value
            better = np.flatnonzero(gain > more[size:] + 1e-12)
            more[size + better], pick[size + better] = gain[better], g
        if not (pick >= 0).any():
            break
        best = more
        picks.append(pick)
    copies, c = np.zeros(len(sizes)), capacity
    for pick in reversed(picks):
        if pick[c] >= 0:
            copies[pick[c]] += 1
            c -= int(sizes[pick[c]])
    return copies


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns of the sizes with whole multiplicities that use no more than the demand."""
    basis = np.diag((capacity // sizes).astype(float))
    for _ in range(ROUNDS):
        worth = np.linalg.solve(basis.T, np.ones(len(sizes)))
        new = _knapsack(sizes, worth, capacity)
        if worth @ new <= 1 + 1e-6:
            break
        use, direction = np.linalg.solve(basis, demand.astype(float)), np.linalg.solve(basis, new)
        ratio = np.where(direction > 1e-9, use / np.where(direction > 1e-9, direction, 1), np.inf)
        basis[:, ratio.argmin()] = new
    use = np.floor(np.linalg.solve(basis, demand.astype(float)) + 1e-6).astype(np.int64)
    return [(basis[:, j].astype(np.int64), int(use[j])) for j in np.argsort(-use) if use[j] > 0]


class _Packing:
    """A plan in the making: rows are numbers of pieces in descending order of length."""

    def __init__(self, counts: np.ndarray):
        self.capacity = len(counts) - 1
        self.lengths = np.flatnonzero(counts)[::-1]
        self.ends = np.cumsum(counts[self.lengths])                # one past each length's last row
        self.segments: list[tuple[int, ...]] = []
        self.sequences = 0
        self.room: dict[int, list[tuple[int, int]]] = {}           # free tokens -> runs of (first sequence, count)
        self.sizes: list[int] = []                                 # keys of room, ascending

    def free(self, room: int, first: int, count: int) -> None:
        if count and room:
            if room not in self.room:
                self.room[room] = []
                bisect.insort(self.sizes, room)
            self.room[room].append((first, count))

    def configure(self, firsts: list[int], patterns: list[tuple[np.ndarray, int]]) -> list[int]:
        """Give the rows of each rounded size, from ``firsts`` on, to the patterns'
        places; returns the next free row of each size."""
        nxt = list(firsts)
        for copies, times in patterns:
            starts = []
            for g, many in enumerate(copies.tolist()):
                for _ in range(many):
                    starts.append(nxt[g])
                    nxt[g] += times
            # Along the pattern's sequences, its places hold pieces of constant length between these cuts.
            cuts = {0, times}
            for s in starts:
                i, j = np.searchsorted(self.ends, [s, s + times], "right")
                cuts.update(int(e) - s for e in self.ends[i:j] if e < s + times)
            cuts = sorted(cuts)
            for a, b in zip(cuts, cuts[1:]):
                offset = 0
                for s in starts:
                    length = int(self.lengths[np.searchsorted(self.ends, s + a, "right")])
                    self.segments.append((s + a, self.sequences + a, offset, 1, 0, length))
                    offset += length
                self.free(self.capacity - offset, self.sequences + a, b - a)
            self.sequences += times
        return nxt

    def best_fit(self, length: int, row: int, count: int) -> None:
        """Place ``count`` pieces, each where it leaves the least room."""
        while count:
            i = bisect.bisect_left(self.sizes, length)
            if i == len(self.sizes):
                new = -(-count // (self.capacity // length))
                self.free(self.capacity, self.sequences, new)
                self.sequences += new
                continue
            room = self.sizes[i]
            runs = self.room[room]
            first, many = runs.pop()
            if not runs:
                del self.room[room], self.sizes[i]
            per = room // length
            used = min(many, -(-count // per))
            placed = min(count, used * per)
            self.segments.append((row, first, self.capacity - room, per, 0, length))
            whole = placed // per
            self.free(room - per * length, first, whole)
            if whole < used:
                self.free(room - placed % per * length, first + whole, 1)
            self.free(room, first + used, many - used)
            row, count = row + placed, count - placed

    def plan(self) -> Plan:
        s = np.asarray(sorted(self.segments), np.int64).reshape(-1, 6)
        return Plan(s[:, 0], s[:, 1], s[:, 2], np.maximum(s[:, 3], 1), s[:, 4], s[:, 5], self.sequences)


def _planned(counts: np.ndarray, groups: int) -> Plan:
    capacity = len(counts) - 1
    p = _Packing(counts)
    whole, least = int(counts[capacity]), capacity // LARGE + 1
    p.best_fit(capacity, 0, whole)
    large = int(counts[least:capacity].sum())
    size = large // groups
    kinds: list[list[int]] = []                                    # rounded size, first row, one past the last
    for row in range(whole, whole + groups * size, size or 1):
        rounded = int(p.lengths[np.searchsorted(p.ends, row, "right")])
        if kinds and kinds[-1][0] == rounded:
            kinds[-1][2] += size
        else:
            kinds.append([rounded, row, row + size])
    left = []
    if kinds:
        sizes, firsts, stops = (list(x) for x in zip(*kinds))
        demand = np.asarray(stops) - np.asarray(firsts)
        left = list(zip(p.configure(firsts, configurations(np.asarray(sizes), demand, capacity)), stops))
    left.append((whole + groups * size, int(counts.sum())))
    for a, b in left:                                              # in ascending row, so in descending length
        while a < b:
            i = np.searchsorted(p.ends, a, "right")
            stop = min(b, int(p.ends[i]))
            p.best_fit(int(p.lengths[i]), a, stop - a)
            a = stop
    return p.plan()


def planned(counts: np.ndarray, groups: tuple[int, ...] = GROUPS) -> Plan:
    """The plan with the fewest sequences; ``counts[l]`` pieces have length l."""
    return min((_planned(counts, g) for g in groups), key=lambda p: p.sequences)


def packed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Every row of ``cut`` (landed pieces) with its sequence_id and offset."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in cut.groupBy("length").count().collect():      # at most a row for each length
        counts[length] = n
    order = [F.col("length").desc(), F.col("doc_id").asc_nulls_first(), F.col("piece"), F.col("ids_crc32"), F.col("start")]
    rows = numbered(cut, order, "_row", "pack-order", int(counts.sum()))
    shared = cut.sparkSession.sparkContext.broadcast(planned(counts))

    def run(batches):
        for batch in batches:
            sequence, offset = shared.value.places(batch.column(len(_NAMES)).to_numpy())
            yield pa.record_batch([*batch.columns[:len(_NAMES)], pa.array(sequence), pa.array(offset)],
                                  names=[*_NAMES, "sequence_id", "offset"])

    return rows.select(*_NAMES, "_row").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def packed_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack all documents."""
    return packed(landed(pieces(docs, tokenizer, end_id, capacity), "pieces"), capacity)
