"""Token-id files: frequency-ranked ids in a byte-aligned code with separate control bytes.

Ids are replaced by their rank in the corpus, most frequent first, and a
rank takes one to four bytes.  Two bits for each rank tell its length; four of
them make a control byte, and control and data bytes lie apart.  The decoder
looks the control bytes up in a table of byte masks and lets numpy place the
data bytes.

A folder holds ``ranks.u32`` (the id of every rank) and one file for each
range of document ids, in ascending order of doc_id.  A file is a run of
blocks: four little-endian unsigned 64-bit integers (documents, ids, control
bytes, data bytes), then the documents' ids, their null flags and their counts
of ids, then the control and the data bytes.

Defined cases: a null text counts as empty, so it holds the end id alone;
documents without an id come first; equal ids follow each other by their
token ids; an empty table makes no file.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafstat.llm.common import landed, shared_folder, size_batches
from leafstat.llm.store import create, one_file_a_task, opened, rows_of, task_file
from leafstat.llm.tokens import batches_of, encoder, gathered

BLOCK_IDS = 1 << 20        # ids in a block, or one document's where it has more
RANGE_BYTES = 64 << 20     # of ids in a file, about
GATHERED = 8 << 20        # characters that a worker encodes at once, or one text's where it has more
CACHED = 600_000           # pieces whose ids a worker remembers
_HEADER = np.dtype("<u8")
# Rows: control bytes; columns: whether byte j of rank i is there (4 ranks of 4 bytes).
_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
_MASKS = np.arange(4)[None, None, :] < _LENGTHS[:, :, None]


def packed(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit ranks."""
    ranks = ranks.astype("<u4")
    more = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    present = np.arange(4)[None, :] <= more[:, None]
    data = ranks.view(np.uint8).reshape(-1, 4)[present]
    lanes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    lanes[:len(ranks)] = more
    control = (lanes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    return control.tobytes(), data.tobytes()


def unpacked(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` ranks of control and data bytes."""
    mask = _MASKS[np.frombuffer(control, np.uint8)].reshape(-1, 4)[:n]
    out = np.zeros((n, 4), np.uint8)
    out[mask] = np.frombuffer(data, np.uint8)
    return out.reshape(-1).view("<u4")


def id_type(tokenizer: str, end_id: int) -> str:
    """The narrowest integers that hold the tokenizer's ids on their way to the files."""
    return "<u2" if max(encoder(tokenizer).vocabulary - 1, end_id) < 1 << 16 else "<u4"


def encoded(docs: DataFrame, tokenizer: str, end_id: int, kind: str, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(doc_id, ids, id, n): the token ids of whole texts and the end id, as integers of
    ``kind``; and for each task, in rows without ``ids``, how often it met each id.

    A run of texts is encoded at once and its ids lie in one array: the end ids
    are set into it, it is cast once, and the rows are slices of its bytes.
    """
    wide = np.dtype(kind).itemsize

    def rows(ids, found, token, n):
        return pa.record_batch([ids, found, token, n], schema=_ENCODED)

    def run(batches):
        coder = encoder(tokenizer, CACHED)
        total = np.zeros(max(coder.vocabulary, end_id + 1), np.int64)
        for table in gathered(batches, 1, GATHERED):
            names, texts = table.column(0).combine_chunks(), table.column(1).to_pylist()
            for i, j in batches_of(texts, GATHERED):
                ids, counts = coder.encode_run(texts[i:j])
                ends = np.cumsum(counts + 1)
                run_ids = np.empty(len(ids) + len(counts), kind)
                inner = np.ones(len(run_ids), bool)
                inner[ends - 1] = False
                run_ids[inner] = ids
                run_ids[ends - 1] = end_id
                total += np.bincount(run_ids, minlength=len(total))
                offsets = np.concatenate([[0], ends * wide]).astype(np.int64)
                found = pa.Array.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(offsets), pa.py_buffer(run_ids)])
                none = pa.nulls(j - i, pa.int64())
                yield rows(names.slice(i, j - i), found.cast(pa.binary()), none, none)
        at = np.flatnonzero(total)
        yield rows(pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.binary()), pa.array(at), pa.array(total[at]))

    size_batches(docs.sparkSession)
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, ids binary, id long, n long"))


_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("id", pa.int64()), ("n", pa.int64())])


def ranked(landed_ids: DataFrame) -> tuple[np.ndarray, int]:
    """Ids of the vocabulary that occur, most frequent first (ties: smaller id), and the
    number of all ids.  The driver gets a row for each id of the vocabulary."""
    counts = landed_ids.where("ids IS NULL").groupBy("id").agg(F.sum("n").alias("n")).collect()
    order = sorted(counts, key=lambda r: (-r.n, r.id))
    return np.asarray([r.id for r in order], "<u4"), sum(r.n for r in order)


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Encode ``docs`` and write the files below ``folder``; returns the manifest.

    The texts are encoded where they lie.  The ids are landed, so that they
    are made once for the range bounds and the files; their counts come along.
    """
    spark = docs.sparkSession
    kind = id_type(tokenizer, end_id)
    wide = np.dtype(kind).itemsize
    ids = landed(encoded(docs, tokenizer, end_id, kind), "token-ids")
    by_rank, total = ranked(ids)
    with create(f"{folder}/ranks.u32") as out:
        out.write(by_rank.tobytes())
    rank_of = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, "<u4")
    rank_of[by_rank] = np.arange(len(by_rank), dtype="<u4")
    shared = spark.sparkContext.broadcast(rank_of)                # the vocabulary's size

    def block(rows: list[tuple[int | None, bytes]]) -> bytes:
        counts = np.asarray([len(x) // wide for _, x in rows], "<u8")
        control, data = packed(shared.value[np.frombuffer(b"".join(x for _, x in rows), kind)])
        head = np.asarray([len(rows), counts.sum(), len(control), len(data)], _HEADER)
        names = np.asarray([d or 0 for d, _ in rows], "<i8")
        nulls = np.asarray([d is None for d, _ in rows], np.uint8)
        return b"".join([head.tobytes(), names.tobytes(), nulls.tobytes(), counts.tobytes(), control, data])

    def run(batches):
        path, out, held, size, n_ids, n_docs = task_file(folder, ".ids"), None, [], 0, 0, 0
        for batch in batches:
            for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.append(row)
                size += len(row[1]) // wide
                if size >= BLOCK_IDS:
                    out = out or create(path)
                    out.write(block(held))
                    n_ids, n_docs, held, size = n_ids + size, n_docs + len(held), [], 0
        if held:
            out = out or create(path)
            out.write(block(held))
            n_ids, n_docs = n_ids + size, n_docs + len(held)
        if out:
            out.close()
            part = int(path.rsplit("/", 1)[1].split("-")[1])
            yield pa.record_batch([[part], [path], [n_docs], [n_ids]], names=["part", "path", "n_docs", "n_ids"])

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total * wide // RANGE_BYTES))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("ids"), F.col("ids")]
    dealt = ids.where("ids IS NOT NULL").repartitionByRange(parts, *order[:2]).sortWithinPartitions(*order).select("doc_id", "ids")
    return landed(dealt.mapInArrow(run, "part long, path string, n_docs long, n_ids long"), "id-files")


def blocks_of(path: str, by_rank: np.ndarray):
    """The blocks of a file: (document ids, counts, token ids)."""
    with opened(path) as file:
        while head := file.read(32):
            docs, n, controls, size = (int(x) for x in np.frombuffer(head, _HEADER))
            names = np.frombuffer(file.read(8 * docs), "<i8").tolist()
            nulls = np.frombuffer(file.read(docs), np.uint8)
            counts = np.frombuffer(file.read(8 * docs), "<u8").astype(np.int64)
            ranks = unpacked(file.read(controls), file.read(size), n)
            yield [None if x else d for d, x in zip(names, nulls)], counts, by_rank[ranks]


def ranks_in(folder: str) -> np.ndarray:
    with opened(f"{folder}/ranks.u32") as file:
        return np.frombuffer(file.read(), "<u4")


def read(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Per document from the files: doc_id, start, n_tokens, ids_crc32, and the file."""
    files = sorted((r.part, r.n_ids) for r in manifest.select("part", "n_ids").collect())   # a row for each range
    before = np.concatenate([[0], np.cumsum([n for _, n in files])]).tolist()
    starts = dict(zip((p for p, _ in files), before))

    def run(batches):
        by_rank = ranks_in(folder)
        for batch in batches:
            for row in rows_of(batch):
                start = starts[row["part"]]
                for docs, counts, ids in blocks_of(row["path"], by_rank):
                    ends = np.cumsum(counts)
                    raw, stop = ids.astype("<u4").tobytes(), (4 * ends).tolist()
                    crc = [zlib.crc32(raw[i:j]) for i, j in zip([0, *stop], stop)]
                    yield pa.record_batch(
                        [pa.array(docs, pa.int64()), pa.array(start + ends - counts), pa.array(counts),
                         pa.array(crc, pa.int64()), pa.array([row["path"].rsplit("/", 1)[1]] * len(docs))],
                        names=["doc_id", "start", "n_tokens", "ids_crc32", "file"])
                    start += int(counts.sum())

    return (one_file_a_task(manifest.select("part", "path"), len(files))
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, file string"))


def written_and_read(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Write the corpus's ids to a new shared folder and read them back."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "ids")
    return read(spark, folder, write(docs, folder, tokenizer, end_id))
