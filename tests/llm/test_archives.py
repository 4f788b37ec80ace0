"""ARC to WARC: an exact round trip."""

import base64
import gzip
import hashlib

import pytest

from leafstat.llm import warc


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, path string, at long")


def rows():
    big, other = "<p>ü</p>" * 200, "z" * 1000
    return [(i, u, h, "p", i) for i, u, h in [
        (1, "http://a/", big), (2, "http://b c/", big), (2, "http://b c/", big), (9, None, other), (3, "u", other),
        (4, "u", "x" * 999), (5, "u", "x" * 999), (6, "u", None), (7, None, ""), (None, None, other), (8, "u", "\r\n\r\n" * 9)]]


def test_round_trip(spark):
    got = warc.archived(pages(spark, rows())).collect()
    assert sorted((r.page_id or 0, r.payload_digest) for r in got) == sorted(
        (i or 0, hashlib.sha1((h or "").encode()).hexdigest()) for i, _, h, *_ in rows())
    kinds = {}
    for r in got:
        kinds.setdefault(r.page_id, []).append((r.record_type, r.refers_to))
    assert kinds[1] == [("revisit", 2)] and sorted(kinds[2], key=str) == [("response", None), ("revisit", 2)]
    assert kinds[9] == [("response", None)] and kinds[3] == [("revisit", 9)] and kinds[None] == [("revisit", 9)]
    assert all(kinds[i] == [("response", None)] for i in (4, 5, 6, 7, 8))
    assert len({r.record_id for r in got}) == len(got)


def test_small_files_and_both_versions(spark, tmpdir_path):
    written = warc.write_arc(pages(spark, rows()).repartition(1), f"{tmpdir_path}/arc", roll=1)
    paths = [r.path for r in written.collect()]
    assert len(set(paths)) == len(rows())
    versions = set()
    for path in paths:
        first, *others = warc.arc_records(path)
        versions.add(first[2]["version"])
        for number, at, header, block in others:
            assert header["Content-type"] == "text/html" and int(header["Archive-length"]) == len(block) and number == 1
            if "Offset" in header:
                assert int(header["Offset"]) == at
    assert versions == {1, 2}
    made = warc.convert(written.select("path"), warc.copies(warc.arc_index(written, 3)), f"{tmpdir_path}/warc", 3).collect()
    for path in (r.path for r in made):
        records = list(warc.warc_records(path))
        assert records[0][1]["WARC-Type"] == "warcinfo"
        for _, h, block in records:
            assert h["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
            assert h["WARC-Date"].endswith("Z") and h["WARC-Record-ID"].startswith("<urn:uuid:")


def test_a_rerun_gives_the_same_identifiers(spark):
    table = pages(spark, rows()).repartition(1)
    assert {r.record_id for r in warc.archived(table).collect()} == {r.record_id for r in warc.archived(table).collect()}


HTTP = b"HTTP/1.0 200 OK\r\nX: y\r\n\r\n"


def foreign(version, name):
    """An archive that this module did not write: a blank in a URL, a DNS record, blocks that hold line ends and
    header-like lines, a header that is no UTF-8, one empty block, and no line end after the last one."""
    more = b" 200 - - 0 x" if version == 2 else b""
    body = f"{version} 0 Crawler\n{warc.FIELDS[version]}\n<meta/>\n".encode()
    blocks = [(b"http://a/x y", b"10.1.2.3", b"20010203040506", b"text/html", HTTP + b"\n\nhttp://f 1.1.1.1 20010101000000 text/html 3\n" * 50),
              (b"dns:a.example", b"10.0.0.1", b"20010203", b"text/dns", b"20010203\na.example. 1 IN A 10.0.0.1\n"),
              (b"http://\xe9/", b"0.0.0.0", b"20010203040507", b"text/html", HTTP + b"z" * 300_000),
              (b"http://e/", b"-", b"20010203040508", b"text/html", b"")]
    head = b"filedesc://%s 0.0.0.0 20010203040506 text/plain%s %d\n" % (name, more, len(body))
    parts = [head + body + b"\n"]
    parts += [b"%s %s %s %s%s %d\n" % (url, ip, when, kind, more, len(b)) + b + b"\n" for url, ip, when, kind, b in blocks]
    return [*parts[:-1], parts[-1][:-1]], [b for *_, b in blocks]


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("shape", ["plain", "one member", "a member a record"])
def test_archives_from_elsewhere(spark, tmpdir_path, version, shape):
    parts, blocks = foreign(version, b"old-%d.arc" % version)
    path = f"{tmpdir_path}/x.arc"
    with open(path, "wb") as file:
        if shape == "plain":
            file.write(b"".join(parts))
        else:
            for part in parts if shape == "a member a record" else [b"".join(parts)]:
                file.write(gzip.compress(part))
    found = list(warc.arc_records(path))
    assert [b for *_, b in found[1:]] == blocks and [n for n, *_ in found] == [0, 1, 2, 3, 4]
    assert found[0][2]["name"] == f"old-{version}.arc" and found[1][2]["URL"] == "http://a/x y"
    manifest = warc.converted(spark, [path], f"{tmpdir_path}/warc")
    records = [r for m in manifest.collect() for r in warc.warc_records(m.path)]
    assert [h["WARC-Type"] for _, h, _ in records] == ["warcinfo", "response", "resource", "response", "resource"]
    assert [b for _, _, b in records[1:]] == blocks
    assert records[1][1]["WARC-IP-Address"] == "10.1.2.3" and "WARC-IP-Address" not in records[3][1]
    assert records[2][1]["Content-Type"] == "text/dns" and records[2][1]["WARC-Date"] == "2001-02-03T00:00:00Z"
    back = {r.target_uri: r for r in warc.read_warc(manifest, 1).collect()}
    assert back["dns:a.example"].record_type == "resource" and back["http://a/x y"].ip_address == "10.1.2.3"
    assert back["http://a/x y"].payload_digest == hashlib.sha1(blocks[0][len(HTTP):]).hexdigest()


def test_copies_across_archives(spark, tmpdir_path):
    paths = []
    for version in (1, 2):
        paths.append(f"{tmpdir_path}/{version}.arc")
        with open(paths[-1], "wb") as file:
            file.write(b"".join(foreign(version, b"n%d" % version)[0]))
    manifest = warc.converted(spark, paths, f"{tmpdir_path}/warc")
    back = warc.read_warc(manifest, 2).collect()
    revisits = [r for r in back if r.record_type == "revisit"]
    assert len(back) == 8 and len(revisits) == 2           # the two long payloads, once each
    assert {r.refers_to_id for r in revisits} <= {r.record_id for r in back if r.record_type == "response"}


def test_damaged_files_are_errors(tmpdir_path):
    path = f"{tmpdir_path}/x.arc.gz"
    out = warc.Members(path)
    out.add(warc.arc_version_block(1, "x"))
    out.add(b"http://a 0.0.0.0 20200101000000 text/html 99\nshort\n")
    out.close()
    with pytest.raises(ValueError, match="shorter"):
        list(warc.arc_records(path))
    with open(path, "r+b") as file:
        file.truncate(20)
    with pytest.raises(ValueError, match="ends early"):
        list(warc.arc_records(path))
    with open(path, "wb") as file:
        file.write(warc.arc_version_block(1, "x") + b"http://a 0.0.0.0 20200101000000 text/html 2\nab and more\n")
    with pytest.raises(ValueError, match="no header line"):
        list(warc.arc_records(path))


def test_no_pages(spark):
    assert warc.archived(pages(spark, []).limit(0)).count() == 0
