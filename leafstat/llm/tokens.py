"""Token ids of whole texts by a public tokenizer of the ``word_bpe`` kind.

The tokenizer lower-cases a text and splits it at white space and between
letters, digits and other marks; each piece is encoded alone and ends in a
token that closes a word.  Natural text repeats its words, so a block of texts
is split and dictionary-encoded by Arrow, the library encodes the pieces that
the worker has not met, and numpy puts the texts' ids together.  Texts with
characters outside a plain alphabet, or with something that may be a special
token, are encoded whole.  Either way the ids are those that the library gives
for the text.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHED_PIECES = 300_000    # pieces whose ids a worker remembers
# Lower-casing, composition and the splitting classes of these characters depend on nothing around them.
_PLAIN = re.compile("[\t\n\r -~À-ÖØ-öø-ÿ]*")
_PIECES = "('s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-z0-9ß-öø-ÿ]+)"


def spread(values: np.ndarray, lengths: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``values`` holds runs of the given lengths; the runs in ``order``, and their lengths."""
    starts = np.cumsum(lengths) - lengths
    out = lengths[order]
    shift = starts[order] - (np.cumsum(out) - out)
    return values[np.arange(out.sum()) + np.repeat(shift, out)], out


def sums(lengths: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``lengths`` between neighbouring offsets."""
    return np.diff(np.concatenate([[0], np.cumsum(lengths)])[offsets])


class Encoder:
    """Whole texts -> ids; holds the library's tokenizer and the ids of known pieces."""

    def __init__(self, path: str, cached: int = CACHED_PIECES):
        from tokenizers import Tokenizer

        self.cached = cached
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.vocabulary = self.library.get_vocab_size()
        ends = [i for t, i in self.library.get_vocab(with_added_tokens=False).items() if t.endswith("</w>")]
        self.closes = np.zeros(self.vocabulary, bool)
        self.closes[ends] = True
        self.pieces: dict[str, bytes] = {"": b""}

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, pieces: list[str]) -> None:
        """Have the library encode new pieces, set apart by spaces."""
        for at in range(0, len(pieces), 500):
            some = pieces[at:at + 500]
            ids = np.asarray(self.library.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            ends = (4 * np.flatnonzero(self.closes[ids]) + 4).tolist()
            if len(ends) == len(some):
                run = ids.tobytes()
                self.pieces.update((p, run[i:j]) for p, i, j in zip(some, [0, *ends], ends))
            else:
                self.pieces.update((p, self._whole(p)) for p in some)

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain texts, one after another, and the number of each text's ids."""
        words = pc.utf8_split_whitespace(pa.array(texts, pa.large_string()))
        coded = words.flatten().dictionary_encode()
        lower = pc.utf8_lower(coded.dictionary)
        mixed = pc.invert(pc.utf8_is_alpha(lower))              # a word of letters alone is one piece
        split = pc.utf8_split_whitespace(pc.replace_with_mask(
            lower, mixed, pc.replace_substring_regex(lower.filter(mixed), _PIECES, "\\1 ")))
        parts = split.flatten().dictionary_encode()
        pieces = parts.dictionary.to_pylist()
        if len(self.pieces) > self.cached:    # the pieces of this block stand for the frequent ones
            self.pieces = {p: self.pieces[p] for p in {"", *pieces} if p in self.pieces}
        self._learn([p for p in pieces if p not in self.pieces])
        found = [self.pieces[p] for p in pieces]
        ids = np.frombuffer(b"".join(found), "<u4")
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids, lengths = spread(ids, lengths, parts.indices.to_numpy())              # by piece of a word
        lengths = sums(lengths, split.offsets.to_numpy())                          # by word
        ids, lengths = spread(ids, lengths, coded.indices.to_numpy())              # by word of a text
        return ids, sums(lengths, words.offsets.to_numpy())

    def encode_run(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts (null: none), one after another, and the number of each text's ids."""
        plain = [t is None or bool(_PLAIN.fullmatch(t)) and "<|" not in t for t in texts]
        ids, counts = self._plain([t or "" if simple else "" for t, simple in zip(texts, plain)])
        others = [i for i, simple in enumerate(plain) if not simple]
        if others:
            whole = {i: np.frombuffer(self._whole(texts[i]), "<u4") for i in others}
            ends = np.cumsum(counts).tolist()
            parts, at = [], 0
            for i in others:                                    # a plain text's ids lie before or after, never within
                parts += [ids[at:ends[i]], whole[i]]
                at = ends[i]
            ids = np.concatenate([*parts, ids[at:]])
            counts[others] = [len(whole[i]) for i in others]
        return ids, counts

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text (null: none) as little-endian unsigned 32-bit integers."""
        ids, counts = self.encode_run(texts)
        run, ends = ids.astype("<u4", copy=False).tobytes(), (4 * np.cumsum(counts)).tolist()
        return [run[i:j] for i, j in zip([0, *ends], ends)]


@lru_cache(maxsize=2)
def encoder(path: str, cached: int = CACHED_PIECES) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    return Encoder(path, cached)


def gathered(batches, column: int, most_chars: int, most_rows: int = 1 << 16):
    """Record batches joined until the texts of a column have about ``most_chars``
    characters: a longer run of texts repeats more of its words."""
    held, size, rows = [], 0, 0
    for batch in batches:
        held.append(batch)
        size += batch.column(column).nbytes
        rows += batch.num_rows
        if size >= most_chars or rows >= most_rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size, rows = [], 0, 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def batches_of(texts: list, most_chars: int = 2 << 20):
    """Slices of a list of texts of about ``most_chars`` characters each, as (from, to)."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= most_chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
