"""Legacy ARC archives: written from pages, converted to WARC, and read back."""

from __future__ import annotations

import base64
import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.arrow import map_batches, utf8
from lakeloom.session import materialize, scratch_path

# Bytes of the records of one archive, about: an archive is read by one task.
ARCHIVE_BYTES = 16 << 20
# Records of a WARC archive, as a task of a join may write many.
ARCHIVE_RECORDS = 4096
# Payloads that are at least so long and occur again are written once.
SHARED_BYTES = 1000
ID_HEADER = "X-Page-Id"
NO_DATE = "19700101000000"

# Fixed values of the two versions of the format: the fields after the address, and the version block's third line.
ARC_FIELDS = {
    1: ("ip", "date", "mime", "length"),
    2: ("ip", "date", "mime", "status", "checksum", "location", "offset", "filename", "length"),
}
ARC_DEFINITION = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def arc_record(version: int, url: str, date: str, content: bytes, name: str, mime: str = "text/html") -> bytes:
    """One record: the header line of the version, and the content whose length it declares."""
    url = url.replace("\r", "%0D").replace("\n", "%0A")
    middle = {1: f"0.0.0.0 {date} {mime}", 2: f"0.0.0.0 {date} {mime} 200 - - 0 {name}"}[version]
    return f"{url} {middle} {len(content)}\n".encode() + content


def version_block(version: int, name: str, date: str) -> bytes:
    return arc_record(
        version, f"filedesc://{name}", date, f"{version} 0 lakeloom\n{ARC_DEFINITION[version]}\n".encode(), name,
        "text/plain",
    )


def inflate(raw: bytes) -> bytes:
    """The bytes of a file of any number of gzip members, or the file itself if it is none."""
    out = []
    while raw[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(raw) + member.flush())
        raw = member.unused_data
    return b"".join(out) + raw


def parse_arc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and content of each record, by declared lengths.

    The first record is the version block, whose second line names the version that all header lines follow.  Fields
    are taken from the right, so that an address with spaces stays whole.  A declared length that reaches beyond the
    archive is an error, as is a line that lacks fields.
    """
    at, version = 0, None
    while True:
        while data[at : at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= len(data):
            return
        end = data.find(b"\n", at)
        line = data[at : end if end >= 0 else len(data)].rstrip(b"\r").decode("utf-8", "replace")
        if version is None:
            length = int(line.rsplit(" ", 1)[1])
            version = int(data[end + 1 : end + 1 + length].split(None, 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown archive version {version}")
        fields = line.rsplit(" ", len(ARC_FIELDS[version]))
        if len(fields) != len(ARC_FIELDS[version]) + 1:
            raise ValueError(f"not a header line of version {version}: {line[:200]}")
        head = dict(zip(("url", *ARC_FIELDS[version]), fields))
        length = int(head["length"])
        if end + 1 + length > len(data):
            raise ValueError(f"record reaches over the archive's end: {line[:200]}")
        yield head, data[end + 1 : end + 1 + length]
        at = end + 1 + length


def split_http(content: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """Head with its blank line, header fields in lower case, and payload of an HTTP response."""
    end = content.find(b"\r\n\r\n")
    if not content.startswith(b"HTTP/") or end < 0:
        return b"", {}, content
    lines = content[:end].decode("utf-8", "replace").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    return content[: end + 4], fields, content[end + 4 :]


def warc_date(date: str) -> str:
    """14 digits, or fewer of them, as a WARC timestamp."""
    date = (date + "00000101000000"[len(date) :])[:14] if date.isdigit() else NO_DATE
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"


def record_id(head: dict[str, str], content: bytes) -> str:
    """The same identifier for the same record on every run."""
    digest = hashlib.sha1(f"{head['url']} {head['date']} ".encode() + content).digest()
    return f"urn:uuid:{uuid.UUID(bytes=digest[:16], version=5)}"


def digest_text(raw: bytes) -> str:
    return "sha1:" + base64.b32encode(raw).decode()


def warc_record(kind: str, fields: dict[str, str | None], block: bytes) -> bytes:
    """A record without the two line ends that follow it."""
    fields = {"WARC-Type": kind, **fields, "Content-Length": str(len(block))}
    lines = [f"{name}: {value}" for name, value in fields.items() if value is not None]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, in lower case, and block of each record, by declared lengths."""
    at = 0
    while data.startswith(b"WARC/", at):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        length = int(fields["content-length"])
        yield fields, data[end + 4 : end + 4 + length]
        at = end + 4 + length + 4
    if data[at:].strip():
        raise ValueError(f"no record at byte {at}")


def _written(spark: SparkSession, records: DataFrame, label: str, line_end: str, most: int = 0) -> str:
    """Records as gzip archives, one or, if there are over ``most``, more per partition.

    Bytes pass through the text writer as they are.
    """
    path = scratch_path(spark, label)
    values = records.select(F.col("value").cast("string").alias("value"))
    values.write.options(lineSep=line_end, compression="gzip", maxRecordsPerFile=most).text(path)
    return path


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


def write_arc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> str:
    """Write pages as HTTP responses into ARC archives of both versions; the folder is the result.

    A NULL page is empty, a NULL address too; a NULL id is left out of the HTTP header.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.coalesce(F.col(f"`{url_col}`"), F.lit("")).alias("url"),
        F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"),
    )
    size = rows.agg(F.sum(F.octet_length("html").cast("long") + 300)).first()[0] or 0
    # Dealt one after the other, so that pages of one id or address do not meet in one archive.
    rows = rows.repartition(math.ceil(size / ARCHIVE_BYTES) or 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part = TaskContext.get().partitionId()
        version, name = part % 2 + 1, f"pages-{part:05d}.arc"
        first = True
        for batch in batches:
            values = [version_block(version, name, NO_DATE)] if first and batch.num_rows else []
            first = first and not values
            for key, url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2))):
                head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                head += "" if key is None else f"{ID_HEADER}: {key}\r\n"
                content = f"{head}Content-Length: {len(html)}\r\n\r\n".encode() + html
                values.append(arc_record(version, url, NO_DATE, content, name))
            yield {"value": values}

    return _written(spark, map_batches(rows, run, "value binary"), "arc", "\n")


def convert_arc(spark: SparkSession, path: str, shared_bytes: int = SHARED_BYTES) -> str:
    """Convert the ARC archives in a folder to WARC archives; the folder of these is the result.

    Version blocks become ``warcinfo`` records, HTTP responses ``response`` and anything else ``resource``.  Of
    responses with equal payloads of at least ``shared_bytes``, those of the largest ID_HEADER stay (no id orders
    first); the others become ``revisit`` records, which hold the HTTP head and refer to the response.

    Digests are gathered first and carry no payload.  Then every record is joined with the decision on it; a group of
    equal payloads is only ever reduced to its largest id and looked up, whatever its size.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                for head, content in parse_arc(inflate(raw)):
                    top, fields, payload = split_http(content)
                    yield head, content, top, fields, payload

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        names = ("record", "page", "url", "date", "one", "two", "size")
        rows = []
        for head, content, top, fields, payload in read(batches):
            if top and len(payload) >= shared_bytes:
                page = fields.get(ID_HEADER.lower())
                hashes = hashlib.sha1(payload).digest(), hashlib.sha256(payload).digest()
                rows.append(
                    (record_id(head, content), None if page is None else int(page), head["url"],
                     warc_date(head["date"]), *hashes, len(payload))
                )
            if len(rows) == 10_000:
                yield dict(zip(names, map(list, zip(*rows))))
                rows = []
        if rows:
            yield dict(zip(names, map(list, zip(*rows))))

    schema = "record string, page long, url string, date string, one binary, two binary, size long"
    found = materialize(map_batches(_archives(spark, path), digests, schema), "digests")
    same = ["one", "two", "size"]
    largest = F.max(F.struct("page", "record", "url", "date")).alias("r")
    firsts = found.groupBy(*same).agg(F.count("*").alias("n"), largest)
    firsts = materialize(firsts.where("n > 1").drop("n"), "firsts")
    others = found.join(firsts, same).where(~F.col("page").eqNullSafe(F.col("r.page")))
    refers = others.select(
        "record", F.col("r.record").alias("to"), F.col("r.url").alias("to_url"), F.col("r.date").alias("to_date")
    )
    refers = materialize(refers.distinct(), "refers")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        out: dict = {"record": [], "kind": [], "url": [], "date": [], "mime": [], "digest": [], "top": [], "body": []}
        size = 0
        for head, content, top, _, payload in read(batches):
            desc = not top and head["url"].startswith("filedesc://")
            out["record"].append(record_id(head, content))
            out["kind"].append("warcinfo" if desc else "response" if top else "resource")
            out["url"].append(None if desc else head["url"])
            out["date"].append(warc_date(head["date"]))
            out["mime"].append("application/http; msgtype=response" if top else head["mime"])
            out["digest"].append(digest_text(hashlib.sha1(payload).digest()))
            out["top"].append(top)
            out["body"].append(payload)
            size += len(content)
            if size > 4 << 20:
                yield out
                out, size = {name: [] for name in out}, 0
        yield out

    schema = "record string, kind string, url string, date string, mime string, digest string, top binary, body binary"
    whole = map_batches(_archives(spark, path), records, schema)
    decided = whole.join(refers, "record", "left")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            values = []
            for r in batch.to_pylist():
                fields = {
                    "WARC-Record-ID": f"<{r['record']}>",
                    "WARC-Date": r["date"],
                    "WARC-Target-URI": r["url"],
                    "WARC-Payload-Digest": None if r["kind"] == "warcinfo" else r["digest"],
                    "Content-Type": r["mime"],
                }
                kind, block = r["kind"], r["top"] + r["body"]
                if r["to"] is not None:
                    kind, block = "revisit", r["top"]
                    fields |= {
                        "WARC-Profile": REVISIT_PROFILE,
                        "WARC-Refers-To": f"<{r['to']}>",
                        "WARC-Refers-To-Target-URI": r["to_url"],
                        "WARC-Refers-To-Date": r["to_date"],
                    }
                values.append(warc_record(kind, fields, block))
            yield {"value": values}

    return _written(spark, map_batches(decided, write, "value binary"), "warc", "\r\n\r\n", ARCHIVE_RECORDS)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the responses in WARC archives: record, page_id, payload_bytes, payload_digest, record_type, refers.

    A revisit's payload length is that of its HTTP head; the digest is the declared one as lower-case hex, and a
    response whose payload has another digest is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        names = ("record", "page_id", "payload_bytes", "payload_digest", "record_type", "refers")
        for batch in batches:
            rows = []
            for raw in batch.column(0).to_pylist():
                for fields, block in parse_warc(inflate(raw)):
                    kind = fields["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    _, http, payload = split_http(block)
                    digest = base64.b32decode(fields["warc-payload-digest"].partition(":")[2])
                    if kind == "response" and hashlib.sha1(payload).digest() != digest:
                        raise ValueError(f"payload of {fields['warc-record-id']} has another digest")
                    page = http.get(ID_HEADER.lower())
                    size = len(payload) if kind == "response" else int(http["content-length"])
                    rows.append(
                        (fields["warc-record-id"], None if page is None else int(page), size, digest.hex(), kind,
                         fields.get("warc-refers-to"))
                    )
            if rows:
                yield dict(zip(names, map(list, zip(*rows))))

    schema = (
        "record string, page_id long, payload_bytes long, payload_digest string, record_type string, refers string"
    )
    return materialize(map_batches(_archives(spark, path), run, schema), "records")


def arc_to_warc(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Pages go into ARC archives of both versions, these are converted, and the WARC archives are read back;
    ``refers_to`` is the id of the response that a revisit refers to.  NULL pages are empty.  Rows that repeat an id
    have a record each; if theirs is the largest id of equal payloads, all of them are responses.  Other columns are
    ignored; an empty table gives no rows.
    """
    spark = pages.sparkSession
    records = read_warc(spark, convert_arc(spark, write_arc(pages, id_col, url_col, html_col)))
    wanted = records.where("refers is not null").select("refers").distinct()
    targets = records.where("record_type = 'response'").select("record", F.col("page_id").alias("refers_to"))
    targets = materialize(targets.join(wanted, F.col("record") == F.col("refers")).drop("refers").distinct(), "targets")
    found = records.drop("record").join(targets, F.col("refers") == F.col("record"), "left")
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
