"""BPE by a tokenization automaton.

The merges are compiled into a deterministic automaton over tokens.  It starts
as one state with an arc for every byte.  Each merge (u, v) adds a gadget:
wherever an arc u leads to a state with an arc v, an arc uv goes round both to
the state behind v, and the arc u is led to a copy of its state without the
arc v.  All arcs with one label lead to one state at any time, so a gadget
adds one state; a state is kept as its difference from the one it was copied
from (the removed label and when), and an arc's presence is decided by the
label's left parts: a token can follow if none of them had been removed before
it was put together.  What the automaton accepts are exactly the texts'
encodings, so the encoding of a word is its only path.

Words are encoded in tables: a trie of the labels gives the arcs that match at
a place, and a transition table, filled as states and labels are met, whether
a state has the arc and where it leads.  Reading from left to right, the
encoding of each prefix ends in the only label whose state of origin has it as
an arc.  Decoding emits the labels of the ids.

Texts are split first, as byte-level tokenizers do, and special tokens are cut
out before.  Words repeat, so a worker keeps the ids of those that it has met.

Defined cases: a null text counts as empty and has no ids; bytes that do not
form UTF-8 after decoding become the replacement character; a null id stays
null and repeated rows are coded each; an empty table gives no row; extra
columns are not looked at.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafstat.llm.common import size_batches
from leafstat.llm.tokens import batches_of

CACHED_WORDS = 600_000     # words whose ids a worker remembers
# Fixed value: the pattern that splits text before the merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same for texts in a plain alphabet, where the standard library's classes suffice.
_PLAIN = re.compile("[\t\n\r -~À-ÖØ-öø-ÿ]*")
_PLAIN_PATTERN = re.compile("'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\\sA-Za-z0-9À-ÖØ-öø-ÿ]+|\\s+(?!\\S)|\\s+")
_SPLIT = regex.compile(PATTERN)


def byte_alphabet() -> dict[str, int]:
    """The visible character that stands for each byte in vocabulary files, and its byte."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Automaton:
    """States, arcs and labels compiled from a vocabulary and its merges."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        alphabet = byte_alphabet()
        size = max(vocabulary.values()) + 1
        self.labels = [b""] * size
        for token, i in vocabulary.items():
            self.labels[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        self.left, self.made = [-1] * size, [-1] * size       # the left part of a label, and when it was put together
        self.state = [0] * size                               # where the arcs with a label lead
        self.base, self.gone, self.when = [0], [-1], [-1]     # a state: copied from, the arc removed, when
        self.arcs = {vocabulary[c] for c in alphabet if c in vocabulary}
        self.table: dict[int, int] = {}                       # (state, label) -> state or -1
        self._removed: dict[int, dict[int, int]] = {0: {}}
        for time, (u, v) in enumerate(merges):
            self._gadget(vocabulary[u], vocabulary[v], vocabulary[u + v], time)
        self.trie: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]
        for i in sorted(self.arcs):
            node = 0
            for byte in self.labels[i]:
                step = self.trie[node].get(byte)
                if step is None:
                    step = self.trie[node][byte] = len(self.trie)
                    self.trie.append({})
                    self.ends.append(-1)
                node = step
            self.ends[node] = i

    def _gadget(self, u: int, v: int, w: int, time: int) -> None:
        if u not in self.arcs or v not in self.arcs or not self.has(self.state[u], v):
            return                                            # no arc v behind an arc u: nothing to go round
        if w not in self.arcs:
            self.left[w], self.made[w] = u, time
            self.arcs.add(w)
        self.state[w] = self.state[v]
        self.base.append(self.state[u])
        self.gone.append(v)
        self.when.append(time)
        self.state[u] = len(self.base) - 1

    def removed(self, state: int) -> dict[int, int]:
        """Labels that the state lost, and when."""
        found = {}
        while state:
            found.setdefault(self.gone[state], self.when[state])
            state = self.base[state]
        return found

    def has(self, state: int, label: int) -> bool:
        """Whether the state has the arc: no left part of the label was gone
        when the next larger part was put together."""
        lost = self._removed.get(state)
        if lost is None:
            if len(self._removed) > 4096:
                self._removed = {0: {}}
            lost = self._removed[state] = self.removed(state)
        until = 1 << 60
        while label >= 0:
            if lost.get(label, 1 << 61) <= until:
                return False
            label, until = self.left[label], self.made[label]
        return True

    def step(self, state: int, label: int) -> int:
        """Where the arc leads, or -1; kept in the transition table."""
        key = state << 20 | label
        to = self.table.get(key)
        if to is None:
            if len(self.table) > 1_000_000:
                self.table.clear()
            to = self.table[key] = self.state[label] if self.has(state, label) else -1
        return to

    def encode(self, word: bytes) -> list[int]:
        """The labels of the word's path."""
        n = len(word)
        came: list[int] = [0] * (n + 1)       # last label of each prefix's path
        at = [-1] * (n + 1)                   # its state; -1: not reached
        at[0] = 0
        trie, ends, table = self.trie, self.ends, self.table
        for i in range(n):
            state, node = at[i], 0
            if state < 0:
                raise ValueError("a byte without an arc")
            high = state << 20
            for j in range(i, n):
                node = trie[node].get(word[j])
                if node is None:
                    break
                label = ends[node]
                if label >= 0:
                    to = table.get(high | label)
                    if to is None:
                        to = self.step(state, label)
                    if to >= 0:
                        came[j + 1], at[j + 1] = label, to
        path, i = [], n
        while i:
            path.append(came[i])
            i -= len(self.labels[came[i]])
        return path[::-1]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.labels[i] for i in ids])


class Codec:
    """Texts to ids and back by the automaton of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.automaton = Automaton(spec["model"]["vocab"], merges)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = self.automaton.labels
        for content, i in self.special.items():
            self.labels.extend([b""] * (i + 1 - len(self.labels)))
            self.labels[i] = content.encode()
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.words: dict[str, bytes] = {}

    def _ids(self, text: str) -> bytes:
        words = _PLAIN_PATTERN.findall(text) if _PLAIN.fullmatch(text) else _SPLIT.findall(text)
        if len(self.words) > CACHED_WORDS:
            self.words = {}
        known = self.words
        for word in set(words).difference(known):
            known[word] = np.asarray(self.automaton.encode(word.encode()), "<u4").tobytes()
        return b"".join([known[w] for w in words])

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        text = text or ""
        if not self.special or not self.cut.search(text):
            return self._ids(text)
        return b"".join(np.asarray([self.special[x]], "<u4").tobytes() if x in self.special else self._ids(x)
                        for x in self.cut.split(text) if x)

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the decoded text."""
        raw = b"".join([self.labels[i] for i in np.frombuffer(ids, "<u4").tolist()])
        try:
            raw.decode()
        except UnicodeDecodeError:
            return raw.decode(errors="replace").encode()
        return raw


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """The worker's codec for a tokenizer file."""
    return Codec(path)


def coded(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): whole texts encoded to 32-bit integers, and decoded from these."""
    def run(batches):
        it = codec(tokenizer)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for i, j in batches_of(texts):
                ids = [it.encode(text) for text in texts[i:j]]
                yield pa.record_batch([batch.column(0).slice(i, j - i), pa.array(ids, pa.binary()),
                                       pa.array([it.decode(x) for x in ids], pa.binary())],
                                      names=["doc_id", "ids", "decoded"])

    size_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary, decoded binary")
