"""Legacy archive converter: ARC files to WARC files.

An ARC file is a version block and records, each a header line and as many
bytes as its last field declares.  The first line of the version block names
the version and its second line the fields of the header lines: version 1 has
the URL, IP address, date, type and length; version 2 puts the result code,
checksum, location, offset and file name before the length.  The converter
walks the file's bytes by header lines and declared lengths alone, whether the
file is plain, one gzip member, or a member for each record, and synthesises
for every record an equivalent WARC record: identifier (a name-based UUID of
the archive's own name and the record's number, so a rerun gives the same), ISO
timestamp, type, IP address, content type, block and payload digests, and a
warcinfo record for the version block.  An HTTP response is a ``response``, or
a ``revisit`` where another record has the same payload: that keeps the HTTP
headers, refers to the response that holds the payload and names its digest.
Anything else (``dns:``, ``ftp:``) is a ``resource`` of the declared type.

All WARC records, and those of the ARC files that ``write_arc`` makes, are gzip
members of their own, so that a file can be read from any record's offset.  The
payloads are never shuffled: each task writes the archives of its rows, the
files are indexed (number, digest and length of every payload), the copies are
found among these thin rows, and each file is converted on its own.  Files are
closed at ROLL_BYTES, so a task holds one record and the thin rows of one file
at a time.  Page ids live in the thin rows, not in the archives.

Defined cases: a null payload is empty; a null URL is ``http://none.invalid/`` with
the id; white space in a URL is escaped; a null id stays null; equal rows are
records each; of copies with equal ids the one that lies last stands; a record
shorter than it declares, a line that is no header, and an unknown version are
errors; bytes of a header that are no UTF-8 are kept; no page makes no file;
extra columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafstat.llm.common import landed, shared_folder, size_batches
from leafstat.llm.store import create, one_file_a_task, opened, rows_of, task_file

ROLL_BYTES = 8 << 20       # compressed bytes after which an archive is closed
LEAST_COPY = 1000          # bytes of a payload that a revisit may stand for
GZIP_LEVEL = 3
CHUNK = 1 << 18
LONGEST_LINE = 1 << 20     # bytes within which a header line ends
# The header fields of the two ARC versions.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_EPOCH = datetime(2020, 1, 1, tzinfo=UTC)
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")          # the URL name space


class Members:
    """Writes gzip members to a file; ``at`` is the next member's offset."""

    def __init__(self, path: str):
        self.path, self.at, self.out = path, 0, create(path)

    def add(self, *parts: bytes) -> None:
        packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
        member = b"".join([*(packer.compress(p) for p in parts), packer.flush()])
        self.out.write(member)
        self.at += len(member)

    def close(self) -> None:
        self.out.close()


class Content:
    """The bytes of a plain or gzip file, whatever its members, as one stream."""

    def __init__(self, file, path: str):
        self.file, self.path = file, path
        self.raw = file.read(CHUNK)
        self.packed = self.raw[:2] == b"\x1f\x8b"
        self.unpacker = None
        self.read_to = 0                    # file offset of ``raw``
        self.held, self.at = b"", 0         # bytes ready, and the next one of them
        self.given = self.made = 0          # bytes given and made ready since the start
        self.members: list[tuple[int, int]] = []        # (content offset, file offset) of member starts

    def _more(self) -> bool:
        """Make more bytes ready; false at the end."""
        self.raw = self.raw or self.file.read(CHUNK)
        if not self.raw:
            if self.unpacker is not None:
                raise ValueError(f"{self.path}: the member at {self.members[-1][1]} ends early")
            return False
        if self.packed:
            if self.unpacker is None:
                self.unpacker = zlib.decompressobj(31)
                self.members.append((self.made, self.read_to))
            out = self.unpacker.decompress(self.raw)
            rest = self.unpacker.unused_data if self.unpacker.eof else b""
            if self.unpacker.eof:
                self.unpacker = None
        else:
            out, rest = self.raw, b""
        self.read_to += len(self.raw) - len(rest)
        self.raw = rest
        self.held, self.at = self.held[self.at:] + out, 0
        self.made += len(out)
        return True

    def place(self) -> int:
        """File offset of the member that the next byte lies in (plain files: of the byte)."""
        if not self.packed:
            return self.given
        while len(self.members) > 1 and self.members[1][0] <= self.given:
            self.members.pop(0)
        return self.members[0][1] if self.members else 0

    def take(self, n: int) -> bytes:
        """The next ``n`` bytes, or as many as there are."""
        parts, have = [], 0
        while True:
            part = self.held[self.at:self.at + n - have]
            parts.append(part)
            have += len(part)
            self.at += len(part)
            if have == n or not self._more():
                break
        self.given += have
        return parts[0] if len(parts) == 1 else b"".join(parts)

    def line(self) -> bytes:
        """The next line with its end; empty at the end of the file."""
        while (end := self.held.find(b"\n", self.at)) < 0:
            if len(self.held) - self.at > LONGEST_LINE:
                raise ValueError(f"{self.path}: no header line at {self.place()}")
            if not self._more():
                break
        return self.take(end + 1 - self.at if end >= 0 else len(self.held) - self.at)

    def header(self) -> tuple[int, bytes]:
        """The place of the next line that is not empty, and the line without its end."""
        while True:
            while self.at == len(self.held) and self._more():
                pass
            at, found = self.place(), self.line()
            if found.strip(b"\r\n") or not found:
                return at, found.rstrip(b"\r\n")


def _text(raw: bytes) -> str:
    return raw.decode("utf-8", "surrogateescape")


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogateescape")


# ---- ARC

def _http(payload: bytes) -> bytes:
    lines = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    return "\r\n".join([*lines, "", ""]).encode()


def arc_version_block(version: int, name: str) -> bytes:
    body = f"{version} 0 leafstat\n{FIELDS[version]}\n".encode()
    head = f"filedesc://{name} 0.0.0.0 {_EPOCH:%Y%m%d%H%M%S} text/plain"
    more = " 200 - - 0 " + name if version == 2 else ""
    return f"{head}{more} {len(body)}\n".encode() + body + b"\n"


def arc_header(version: int, url: str, when: datetime, offset: int, name: str, digest: str, length: int) -> bytes:
    head = f"{url} 0.0.0.0 {when:%Y%m%d%H%M%S} text/html"
    more = f" 200 {digest} - {offset} {name}" if version == 2 else ""
    return f"{head}{more} {length}\n".encode()


def write_arc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
              payload_col: str = "html", roll: int = ROLL_BYTES) -> DataFrame:
    """Write an ARC record for every row; files take versions 1 and 2 in turn,
    beginning with either by the task's number.  Returns the records: path,
    number in the file, page_id."""
    def run(batches):
        out, records, files, part = None, [], 0, TaskContext.get().partitionId()
        done = lambda: pa.record_batch([
            pa.array([out.path] * len(records)), pa.array(range(1, len(records) + 1), pa.int64()), pa.array(records, pa.int64())],
            names=["path", "n", "page_id"])
        for batch in batches:
            for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    out, records, files = Members(task_file(folder, ".arc.gz")), [], files + 1
                    version, name = 1 + (part + files) % 2, f"part-{part:06d}-{files:06d}.arc.gz"
                    out.add(arc_version_block(version, name))
                payload = (html or "").encode()
                http = _http(payload)
                place = re.sub(r"\s", "%20", url or f"http://none.invalid/{page_id}")
                when = _EPOCH + timedelta(seconds=(page_id or 0) % (1 << 28))
                digest = zlib.crc32(payload)
                out.add(arc_header(version, place, when, out.at, name, f"{digest:08x}", len(http) + len(payload)),
                        http, payload, b"\n")
                records.append(page_id)
                if out.at >= roll:
                    out.close()
                    yield done()
                    out = None
        if out:
            out.close()
            yield done()

    size_batches(pages.sparkSession)
    rows = pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(payload_col).cast("string"))
    return landed(rows.mapInArrow(run, "path string, n long, page_id long"), "arc-files")


def arc_records(path: str) -> Iterator[tuple[int, int, dict, bytes]]:
    """(number, offset, header fields, block) of an ARC file's records, the version block first.

    The fields come from the version block, the end of a block from the length
    that its header line declares.  The offset is that of the record, or of the
    gzip member that it begins in.
    """
    fields: list[str] = []
    number = 0
    with opened(path) as file:
        content = Content(file, path)
        while (header := content.header())[1]:
            at, line = header
            first = line.startswith(b"filedesc://")
            values = _text(line).rsplit(" ", len(fields) - 1) if fields and not first else _text(line).split(" ")
            if not (fields or first) or not values[-1].isdigit() or (not first and len(values) != len(fields)):
                raise ValueError(f"{path}: no header line at {at}: {line[:80]!r}")
            block = content.take(int(values[-1]))
            if len(block) < int(values[-1]):
                raise ValueError(f"{path}: the record at {at} is shorter than it declares")
            if first:
                version, fields = int(block.split(b" ", 1)[0]), _text(block.split(b"\n")[1]).strip().split(" ")
                if " ".join(fields) != FIELDS.get(version):
                    raise ValueError(f"{path}: unknown fields of version {version}")
                name = values[0][len("filedesc://"):]
                yield number, at, {"version": version, "name": name, "Archive-date": values[2]}, block
            else:
                yield number, at, {**dict(zip(fields, values)), "name": name}, block
            number += 1


def _payload(block: bytes) -> tuple[bytes, bytes]:
    """HTTP headers with their empty line, and the payload; a block that is no HTTP message is payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    end = re.search(rb"\r?\n\r?\n", block)
    return (block[:end.end()], block[end.end():]) if end else (block, b"")


# ---- conversion

def record_id(name: str, number: int) -> str:
    """A WARC identifier that the archive's own name and the record's number decide."""
    return f"urn:uuid:{uuid.uuid5(_SPACE, f'arc:{name}#{number}'.encode('utf-8', 'replace').decode())}"


def _labelled(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def warc_record(headers: dict[str, str], block: bytes) -> tuple[bytes, bytes, bytes]:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers.items()), f"Content-Length: {len(block)}", "", ""]
    return _bytes("\r\n".join(lines)), block, b"\r\n\r\n"


def _iso(stamp: str) -> str:
    """An ARC date, of 14 digits or fewer, as a WARC date."""
    return datetime.strptime((stamp + "00000101000000"[len(stamp):])[:14], "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")


def arc_index(manifest: DataFrame, files: int) -> DataFrame:
    """Number, digest and length of every payload in the ARC files ``path``, as they are read."""
    def run(batches):
        for batch in batches:
            for row in rows_of(batch):
                found = []
                for number, _, header, block in arc_records(row["path"]):
                    if "version" not in header:
                        http, payload = _payload(block)
                        found.append((row["path"], number, bool(http), header["Archive-date"], hashlib.sha1(payload).hexdigest(),
                                      len(payload), record_id(header["name"], number)))
                if found:
                    yield pa.record_batch([list(c) for c in zip(*found)], names=_INDEX.replace(",", "").split()[::2])

    return one_file_a_task(manifest.select("path"), files).mapInArrow(run, _INDEX)


_INDEX = "path string, n long, http boolean, stamp string, digest string, bytes long, record string"


def copies(index: DataFrame, least: int = LEAST_COPY) -> DataFrame:
    """The responses that another one stands for: (path, n, to), ``to`` the
    identifier of the response with the largest ``page_id`` (where the index
    has that column; the latest otherwise) and their payload."""
    ranked = index if "page_id" in index.columns else index.withColumn("page_id", F.lit(None).cast("long"))
    long_ones = ranked.where(F.col("http") & (F.col("bytes") >= least))
    rank = F.struct(F.col("page_id").isNotNull(), "page_id", "stamp", "path", "n", "record")
    stands = (long_ones.groupBy(F.col("digest").alias("_d"), F.col("bytes").alias("_b"))
              .agg(F.max(rank).alias("_first"), F.count("*").alias("_n")).where("_n > 1"))
    return (long_ones.join(stands, (F.col("digest") == F.col("_d")) & (F.col("bytes") == F.col("_b")))
            .where(F.col("record") != F.col("_first.record"))
            .select("path", "n", F.col("_first.record").alias("to")))


def _converted(header: dict, number: int, block: bytes, refers_to: str | None) -> tuple[bytes, bytes, bytes]:
    """The WARC record of an ARC record, as the parts of a gzip member."""
    base = {"WARC-Record-ID": f"<{record_id(header['name'], number)}>", "WARC-Date": _iso(header["Archive-date"])}
    if "version" in header:
        info = _bytes(f"conformsTo: ARC/{header['version']}\r\nsource: {header['name']}\r\n")
        return warc_record({"WARC-Type": "warcinfo", **base, "WARC-Filename": header["name"], "WARC-Block-Digest": _labelled(info),
                            "Content-Type": "application/warc-fields"}, info)
    http, payload = _payload(block)
    base |= {"WARC-Target-URI": header["URL"], "WARC-Block-Digest": _labelled(block), "WARC-Payload-Digest": _labelled(payload)}
    if header["IP-address"] not in ("0.0.0.0", "-"):
        base["WARC-IP-Address"] = header["IP-address"]
    if not http:
        return warc_record({"WARC-Type": "resource", **base, "Content-Type": header["Content-type"]}, block)
    base["Content-Type"] = "application/http; msgtype=response"
    if refers_to is None:
        return warc_record({"WARC-Type": "response", **base}, block)
    base |= {"WARC-Block-Digest": _labelled(http), "WARC-Refers-To": f"<{refers_to}>",
             "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
    return warc_record({"WARC-Type": "revisit", **base}, http)


def convert(manifest: DataFrame, revisits: DataFrame, folder: str, files: int) -> DataFrame:
    """Convert each ARC file to a WARC file; returns the manifest of the latter.

    A file's revisits (bounded by its records) travel to it as one row.
    """
    listed = revisits.groupBy("path").agg(F.collect_list(F.struct("n", "to")).alias("revisits"))
    work = manifest.select("path").join(listed, "path", "left")

    def run(batches):
        for batch in batches:
            for row in rows_of(batch):
                to = {x["n"]: x["to"] for x in row["revisits"] or ()}
                out, n = Members(task_file(folder, ".warc.gz")), 0
                for number, _, header, block in arc_records(row["path"]):
                    out.add(*_converted(header, number, block, to.get(number)))
                    n += "version" not in header
                out.close()
                yield pa.record_batch([[out.path], [n]], names=["path", "records"])

    return landed(one_file_a_task(work, files).mapInArrow(run, "path string, records long"), "warc-files")


def converted(spark: SparkSession, paths: list[str], folder: str) -> DataFrame:
    """Convert ARC files from anywhere; returns the manifest of the WARC files."""
    manifest = spark.createDataFrame([(p,) for p in paths], "path string")
    return convert(manifest, copies(landed(arc_index(manifest, len(paths)), "arc-index")), folder, max(1, len(paths)))


def warc_records(path: str) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of a WARC file's records, by their declared lengths."""
    with opened(path) as file:
        content = Content(file, path)
        while (first := content.header())[1]:
            at, headers = first[0], {}
            if not first[1].startswith(b"WARC/"):
                raise ValueError(f"{path}: no WARC record at {at}")
            while line := content.line().rstrip(b"\r\n"):
                key, value = _text(line).split(": ", 1)
                headers[key] = value
            length = int(headers["Content-Length"])
            block = content.take(length)
            if len(block) < length:
                raise ValueError(f"{path}: the record at {at} is shorter than it declares")
            yield at, headers, block


def read_warc(manifest: DataFrame, files: int) -> DataFrame:
    """A row for every record but warcinfo in the WARC files.

    The payload's digest and length are those of the block; a revisit states
    the digest, and the length is that of the record it refers to.
    """
    def run(batches):
        for batch in batches:
            for row in rows_of(batch):
                found = []
                for at, h, block in warc_records(row["path"]):
                    if h["WARC-Type"] == "warcinfo":
                        continue
                    size, digest = None, base64.b32decode(h["WARC-Payload-Digest"][5:]).hex()
                    if h["WARC-Type"] != "revisit":
                        payload = _payload(block)[1]
                        size = len(payload)
                        if hashlib.sha1(payload).hexdigest() != digest:
                            raise ValueError(f"{row['path']}: wrong payload digest at {at}")
                    found.append((h["WARC-Record-ID"][1:-1], size, digest, h["WARC-Type"], h.get("WARC-Refers-To", "")[1:-1] or None,
                                  _bytes(h["WARC-Target-URI"]).decode("utf-8", "replace"), h["WARC-Date"], h.get("WARC-IP-Address")))
                if found:
                    names = [x.split()[0] for x in _READ.split(", ")]
                    types = [pa.int64() if x.endswith("long") else pa.string() for x in _READ.split(", ")]
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*found), types)], names=names)

    return one_file_a_task(manifest.select("path"), files).mapInArrow(run, _READ)


_READ = ("record_id string, bytes long, payload_digest string, record_type string, refers_to_id string, "
         "target_uri string, warc_date string, ip_address string")


def archived(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` as ARC, convert to WARC, read the WARC files back.

    ``refers_to`` is the page of the record that a revisit's identifier names.
    """
    folder = folder or shared_folder(pages.sparkSession, "archives")
    written = write_arc(pages, f"{folder}/arc")
    arcs = written.select("path").distinct()
    files = arcs.count()
    index = landed(arc_index(arcs, files).join(written, ["path", "n"], "left"), "arc-index")
    warcs = convert(arcs, copies(index), f"{folder}/warc", files)
    records = landed(read_warc(warcs, files).join(index.select(F.col("record").alias("record_id"), "page_id"), "record_id"),
                     "warc-records")
    named = (records.select("refers_to_id").where("refers_to_id IS NOT NULL").distinct()
             .join(records.select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"),
                                  F.col("bytes").alias("_bytes")), "refers_to_id"))
    return (records.join(named, "refers_to_id", "left")
            .withColumn("payload_bytes", F.coalesce("bytes", "_bytes")).drop("bytes", "_bytes"))
