"""ARC to WARC: parse the older crawl-archive format and write equivalent WARC records.

An ARC file starts with a version block that names the fields of its record
lines; version 1 has five, version 2 has ten. A record is one such line, then
as many bytes as the line's last field declares, then a line feed. The converter
reads records by those declared lengths alone (a payload may hold anything),
and makes up what WARC asks for and ARC lacks: record ids, ISO dates, record
types and digests.

Archives are written with Spark's text writer, the separator between rows being
the format's own record separator, so they go to any file system that Spark
writes to and a lost task's half-written file is never committed. They are read
whole per file (``binaryFile``) and unpacked as a stream inside the task, so
an archive may be as large as a partition, which is what the writers make.

Nulls and odd rows: a null url is written as ``-``, a null html as an empty
payload, a null page id is left out of the record. Blanks and control
characters in a url are percent-encoded, for both formats are line-based. Rows
that are equal in all columns are the same record stored twice. Extra columns
are ignored. An empty table gives archives with no records.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The record-line fields of the two ARC versions.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
ARC_DATE, ARC_IP = "20240101000000", "192.0.2.1"
PIECE = 1 << 20
BATCH_BYTES = 4 << 20

RECORD_SCHEMA = (
    "arc_version int, uri string, ip string, date string, mime string, status int, "
    "http_header string, payload binary, source_id long"
)
READ_SCHEMA = (
    "record_type string, record_id string, uri string, date string, refers_to_id string, "
    "header_digest string, payload_digest string, payload_bytes long, source_id long"
)


def _line_safe(url: str | None) -> str:
    if not url:
        return "-"
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def _arc_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    part = TaskContext.get().partitionId()
    version = 1 + part % 2
    about = f"{version} 0 archive\n{ARC_FIELDS[version]}\n"
    extra = " text/plain 200 - - 0 -" if version == 2 else " text/plain"
    yield pd.DataFrame({"value": [f"filedesc://part-{part}.arc 0.0.0.0 {ARC_DATE}{extra} {len(about)}\n{about}".encode()]})
    at = 0
    for pdf in batches:
        rows = []
        for page_id, url, html in zip(pdf["page_id"], pdf["url"], pdf["html"]):
            body = b"" if html is None else html.encode()
            known = f"X-Page-Id: {int(page_id)}\r\n" if not pd.isna(page_id) else ""
            http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{known}Content-Length: {len(body)}\r\n\r\n"
            block = http.encode() + body
            fields = f" text/html 200 - - {at} part-{part}.arc" if version == 2 else " text/html"
            row = f"{_line_safe(url)} {ARC_IP} {ARC_DATE}{fields} {len(block)}\n".encode() + block
            at += len(row) + 1
            rows.append(row)
        yield pd.DataFrame({"value": rows})


def write_arc(pages: DataFrame, path: str) -> None:
    """Pages (page_id, url, html) as gzipped ARC files, one a partition; odd partitions are version 2."""
    rows = pages.select("page_id", "url", "html").mapInPandas(_arc_rows, "value binary")
    _write(rows.select(F.col("value").cast("string")), path, "\n")


def _write(rows: DataFrame, path: str, separator: str) -> None:
    rows.write.option("lineSep", separator).option("compression", "gzip").option(
        "zlib.compress.level", "BEST_SPEED").text(path)


class _Stream:
    """Lines and counted bytes of a packed archive, unpacked a piece at a time."""

    def __init__(self, content: bytes):
        self.content, self.at, self.held = content, 0, bytearray()
        self.unpack = zlib.decompressobj(31) if content[:2] == b"\x1f\x8b" else None

    def _more(self) -> bool:
        if self.unpack is None:
            piece = self.content[self.at:self.at + PIECE]
            self.at += len(piece)
            self.held += piece
            return bool(piece)
        while True:
            piece = self.unpack.unconsumed_tail or self.unpack.unused_data
            if self.unpack.eof:  # the next of several packed members
                if not piece:
                    piece = self.content[self.at:self.at + PIECE]
                    self.at += len(piece)
                if not piece:
                    return False
                self.unpack = zlib.decompressobj(31)
            elif not piece:
                piece = self.content[self.at:self.at + PIECE]
                self.at += len(piece)
                if not piece:
                    return False
            got = self.unpack.decompress(piece, PIECE)
            if got:
                self.held += got
                return True

    def line(self) -> bytes | None:
        looked = 0
        while (end := self.held.find(b"\n", looked)) < 0:
            looked = len(self.held)
            if not self._more():
                out = bytes(self.held)
                self.held.clear()
                return out or None
        out = bytes(self.held[:end])
        del self.held[:end + 1]
        return out

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self._more():
                raise ValueError(f"archive ends {n - len(self.held)} bytes short of a declared length")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out


def _http(block: bytes) -> tuple[bytes, bytes, int | None]:
    """Header (with its blank line), body and status of an HTTP response; no header if it is none."""
    if not block.startswith(b"HTTP/"):
        return b"", block, None
    ends = [(i, n) for s, n in ((b"\r\n\r\n", 4), (b"\n\n", 2)) if (i := block.find(s)) >= 0]
    if not ends:
        return block, b"", None
    at, n = min(ends)
    words = block[:at].split(b"\n", 1)[0].split()
    status = int(words[1]) if len(words) > 1 and words[1].isdigit() else None
    return block[:at + n], block[at + n:], status


def _field(header: bytes, name: bytes) -> str | None:
    for line in header.split(b"\n"):
        key, colon, value = line.partition(b":")
        if colon and key.strip().lower() == name:
            return value.strip().decode("utf-8", "replace")
    return None


def _whole(value: str | None) -> int | None:
    return int(value) if value is not None and value.lstrip("-").isdigit() else None


def arc_records(content: bytes) -> Iterator[tuple]:
    """The records of one ARC file, as RECORD_SCHEMA; version blocks set how the lines after them are split."""
    s, version = _Stream(content), 1
    while (line := s.line()) is not None:
        if not line.strip():
            continue
        text = line.decode("utf-8", "replace").rstrip("\r")
        if text.startswith("filedesc:"):
            block = s.take(int(text.rsplit(" ", 1)[1]))
            version = int(block.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown ARC version {version}")
            continue
        n = len(ARC_FIELDS[version].split())
        f = text.rsplit(" ", n - 1)
        if len(f) != n:
            raise ValueError(f"an ARC version {version} line has {n} fields: {text[:200]}")
        block = s.take(int(f[-1]))
        header, payload, status = _http(block)
        status = int(f[4]) if version == 2 and f[4].isdigit() else status
        yield (version, None if f[0] == "-" else f[0], f[1], f[2], f[3], status,
               header.decode("latin-1"), payload, _whole(_field(header, b"x-page-id")))


def _parsed(parse, columns: list[str], weigh: int | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for content in pdf["content"]:
                rows, size = [], 0
                for r in parse(bytes(content)):
                    rows.append(r)
                    size += 200 + (len(r[weigh]) if weigh is not None else 0)
                    if size >= BATCH_BYTES:
                        yield _typed(rows, columns)
                        rows, size = [], 0
                if rows:
                    yield _typed(rows, columns)
    return run


def _typed(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    pdf = pd.DataFrame(rows, columns=columns, dtype=object)
    for c in ("status", "arc_version", "source_id", "payload_bytes"):
        if c in pdf:
            pdf[c] = pdf[c].astype("Int64")
    return pdf


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(",")]


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(path).where(~F.col("path").endswith("_SUCCESS")).select("content")
    return files.mapInPandas(_parsed(arc_records, _names(RECORD_SCHEMA), 7), RECORD_SCHEMA)


def sha1_base32(payload: Column) -> Column:
    """The digest as WARC writes it: 160 bits, five a letter."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id() -> Column:
    h = F.md5(F.concat_ws("\n", F.coalesce("uri", F.lit("-")), "date", F.coalesce(F.col("source_id").cast("string"), F.lit("-")), "digest"))
    cut = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), cut(1, 8), F.lit("-"), cut(9, 4), F.lit("-8"), cut(14, 3), F.lit("-a"), cut(18, 3), F.lit("-"), cut(21, 12), F.lit(">"))


def with_revisits(records: DataFrame, min_payload_bytes: int = 0) -> DataFrame:
    """ARC records with digest, record_id, record_type and, of a revisit, the id, uri and date of what it repeats.

    Of records with equal payloads of ``min_payload_bytes`` or more, that with
    the largest source_id is the response and the others revisit it. If no
    source_id is known in a group, all its records are responses. What is no
    HTTP response becomes a resource, and is never a revisit.

    Groups are only ever aggregated (partially, before the shuffle); their
    decision goes back by a join that adaptive execution splits when one payload
    has a large share of the records.
    """
    r = records.withColumn("digest", sha1_base32(F.col("payload")))
    r = r.withColumn("record_id", _record_id())
    repeats = (F.octet_length("payload") >= min_payload_bytes) & (F.length("http_header") > 0)
    first = (
        r.where(repeats & F.col("source_id").isNotNull())
        .groupBy("digest")
        .agg(F.max(F.struct("source_id", "record_id", "uri", "date")).alias("kept"))
    )
    j = r.join(first, "digest", "left")
    revisit = repeats & (F.col("source_id").isNull() | (F.col("source_id") < F.col("kept.source_id"))) & F.col("kept").isNotNull()
    return j.withColumn("record_type", F.when(revisit, "revisit").when(F.length("http_header") > 0, "response").otherwise("resource"))


def _iso(date: Column) -> Column:
    cut = lambda a, n: F.substring(date, a, n)
    return F.concat(cut(1, 4), F.lit("-"), cut(5, 2), F.lit("-"), cut(7, 2), F.lit("T"), cut(9, 2), F.lit(":"), cut(11, 2), F.lit(":"), cut(13, 2), F.lit("Z"))


def write_warc(records: DataFrame, path: str) -> None:
    """Records of ``with_revisits`` as gzipped WARC 1.0 files, one a partition."""
    revisit = F.col("record_type") == "revisit"
    http = F.encode("http_header", "ISO-8859-1")
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))
    header = F.concat(
        F.lit("WARC/1.0\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", _iso(F.col("date"))),
        line("WARC-Target-URI", F.col("uri")),
        line("WARC-IP-Address", F.col("ip")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), sha1_base32(F.col("block")))),
        line("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"))),
        line("WARC-Refers-To", F.when(revisit, F.col("kept.record_id"))),
        line("WARC-Refers-To-Target-URI", F.when(revisit, F.col("kept.uri"))),
        line("WARC-Refers-To-Date", F.when(revisit, _iso(F.col("kept.date")))),
        line("Content-Type", F.when(F.length("http_header") > 0, F.lit("application/http; msgtype=response")).otherwise(F.col("mime"))),
        line("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"),
    )
    rows = records.withColumn("block", block).select(F.concat(header.cast("binary"), "block").cast("string").alias("value"))
    _write(rows, path, "\r\n\r\n")


def warc_records(content: bytes) -> Iterator[tuple]:
    """The records of one WARC file, as READ_SCHEMA: digest and length are taken from the payload that was read.

    A revisit has no payload: its digest is the header's and its length the
    one that its kept HTTP header declares.
    """
    s = _Stream(content)
    while (line := s.line()) is not None:
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record here: {line[:80]!r}")
        lines = []
        while (line := s.line()) is not None and line.strip():
            lines.append(line)
        header = b"\n".join(lines)
        block = s.take(int(_field(header, b"content-length") or 0))
        kind, digest = _field(header, b"warc-type"), _field(header, b"warc-payload-digest")
        digest = digest.removeprefix("sha1:") if digest else None
        http, payload, _ = _http(block)
        if kind == "revisit":
            found, size = digest, _whole(_field(http, b"content-length"))
        else:
            found, size = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
        yield (kind, _field(header, b"warc-record-id"), _field(header, b"warc-target-uri"), _field(header, b"warc-date"),
               _field(header, b"warc-refers-to"), digest, found, size, _whole(_field(http, b"x-page-id")))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(path).where(~F.col("path").endswith("_SUCCESS")).select("content")
    return files.mapInPandas(_parsed(warc_records, _names(READ_SCHEMA), None), READ_SCHEMA)


def convert(spark: SparkSession, arc_path: str, warc_path: str, min_payload_bytes: int = 0) -> None:
    """All ARC files under ``arc_path`` as WARC files under ``warc_path``."""
    write_warc(with_revisits(read_arc(spark, arc_path), min_payload_bytes), warc_path)
