import gzip
import hashlib

import pytest

from lakeloom.llm import warc
from lakeloom.llm.warc import (
    arc_record, arc_to_warc, convert_arc, inflate, parse_arc, parse_warc, split_http, version_block, warc_date, warc_record,
)


def plain(rows):
    out = []
    for key, _, html in rows:
        body = (html or "").encode()
        same = [k for k, _, h in rows if (h or "").encode() == body and k is not None]
        top = max(same, default=None)
        again = len(body) >= 1000 and key != top
        out.append((key, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 3000)
    rows = [(i, f"http://h/{i % 7} x\n", ("p" * 999 + "é") * (i % 3) + "\r\n\r\nWARC/1.1\r\n" * (i % 2)) for i in range(60)]
    rows += [(100, None, None), (101, "", ""), (102, "http://a b c", "x" * 999), (103, "u", "x" * 999)]
    rows += [(104, "u", "y" * 5000), (104, "u", "y" * 5000), (7, "v", "y" * 5000), (None, "n", "y" * 5000)]
    rows += [(200, "long", "z" * 3_000_000), (201, "nul", "\x00\n" * 700), (202, "filedesc://x", "p")]
    pages = spark.createDataFrame([(*r, "c", 1) for r in rows], "page_id long, url string, html string, id string, page int")
    assert sorted((tuple(r) for r in arc_to_warc(pages).collect()), key=str) == plain(rows)


def test_empty(spark):
    assert arc_to_warc(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


@pytest.mark.parametrize("version", [1, 2])
def test_arc_round_trip(version):
    contents = [b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nbody\nx", b"", b"\n\n", b"plain"]
    data = b"".join(
        r + b"\n" for r in [version_block(version, "a.arc", "20010203040506")]
        + [arc_record(version, f"http://x/{n} with space", "20010203040506", c, "a.arc") for n, c in enumerate(contents)]
    )
    for raw in (data, gzip.compress(data), gzip.compress(data[:40]) + gzip.compress(data[40:])):
        found = list(parse_arc(inflate(raw)))
        assert [c for _, c in found[1:]] == contents
        assert [h["url"] for h, _ in found] == ["filedesc://a.arc"] + [f"http://x/{n} with space" for n in range(4)]
        assert {h["date"] for h, _ in found} == {"20010203040506"}
    with pytest.raises(ValueError):
        list(parse_arc(data[:-4]))
    with pytest.raises(ValueError):
        list(parse_arc(version_block(version, "a.arc", "2001") + b"\nno header line\n"))


def test_warc_records():
    record = warc_record("response", {"WARC-Record-ID": "<urn:x>", "WARC-Target-URI": None}, b"HTTP/1.1 200 OK\r\n\r\n\r\n\r\n")
    (fields, block), (again, _) = parse_warc((record + b"\r\n\r\n") * 2)
    assert fields == again and fields["warc-type"] == "response" and "warc-target-uri" not in fields
    assert split_http(block)[2] == b"\r\n\r\n"
    assert warc_date("20010203040506") == "2001-02-03T04:05:06Z" and warc_date("2001") == "2001-01-01T00:00:00Z"
    assert warc_date("-") == "1970-01-01T00:00:00Z"


def test_foreign_archive(spark, tmp_path):
    """Records of other kinds, and a version that is not known."""
    name = "b.arc"
    records = [version_block(1, name, "1999"), arc_record(1, "dns:x", "19990101", b"x A 1.2.3.4", name, "text/dns")]
    (tmp_path / name).write_bytes(b"".join(r + b"\n" for r in records))
    out = convert_arc(spark, str(tmp_path))
    found = []
    for row in spark.read.format("binaryFile").load(out).collect():
        found += [(f["warc-type"], f.get("warc-target-uri"), f["content-type"], b) for f, b in parse_warc(inflate(row.content))]
    assert sorted(found)[0] == ("resource", "dns:x", "text/dns", b"x A 1.2.3.4") and sorted(found)[1][0] == "warcinfo"
    with pytest.raises(ValueError):
        list(parse_arc(version_block(1, name, "1999").replace(b"\n1 0", b"\n7 0")))
