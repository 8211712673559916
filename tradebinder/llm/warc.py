"""Legacy web archives (ARC) and their conversion to WARC.

An ARC file starts with a version block whose second line names the version and whose third
names the header fields; each record is a header line, as many bytes as its last field
declares, and a line feed.  Version 1 headers have five fields, version 2 headers ten.  The
converter trusts the declared lengths only, never a search for the next header.

Files are written with Spark's text writer, so they reach any store Spark reaches: the record
separators of both formats (LF, CR LF CR LF) are the writer's line separator.  They are
compressed as a whole, one file per task, sized by the bytes to write.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradebinder.llm.common import scratch_path, stored
from tradebinder.operators.lookup import spread_join

# Fixed values of the two formats.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
RESPONSE_TYPE = "application/http; msgtype=response"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FILE_BYTES = 16 << 20
NO_ADDRESS = "0.0.0.0"


class ArchiveError(ValueError):
    """An archive that breaks its own format."""


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ------------------------------------------------------------------ ARC, written

def version_block(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 tradebinder\n{' '.join(ARC_FIELDS[version])}\n".encode()
    extra = " 200 - - 0 " + name if version == 2 else ""
    return f"filedesc://{name} {NO_ADDRESS} {date} text/plain{extra} {len(body)}\n".encode() + body


def arc_record(version: int, url: str, date: str, body: bytes, name: str, offset: int) -> bytes:
    """Header line and content; blanks in the address are percent-encoded, none is a dash."""
    url = "".join("%20" if c.isspace() else c for c in url or "-") or "-"
    extra = f" 200 - - {offset} {name}" if version == 2 else ""
    return f"{url} {NO_ADDRESS} {date} text/html{extra} {len(body)}\n".encode() + body


def http_response(page_id: int | None, payload: bytes) -> bytes:
    own = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {len(payload)}\r\n\r\n"
    return head.encode() + payload


def _to_arc(date: str):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId()
        version, name, offset = 1 + task % 2, f"pages-{task:06d}.arc", 0
        for batch in batches:
            out = []
            if not offset and len(batch):
                out.append(version_block(version, name, date))
                offset = len(out[0]) + 1
            for page_id, url, html in zip(batch["page_id"], batch["url"], batch["html"], strict=True):
                body = http_response(None if pd.isna(page_id) else int(page_id), html or b"")
                out.append(arc_record(version, url, date, body, name, offset))
                offset += len(out[-1]) + 1
            yield pd.DataFrame({"value": out})

    return write


def file_count(pages: DataFrame, column: str, file_bytes: int = FILE_BYTES) -> int:
    total = pages.agg(F.sum(F.octet_length(F.col(column).cast("binary")) + 400)).first()[0] or 0
    return max(1, -(-int(total) // file_bytes))


def write_arc(pages: DataFrame, path: str, files: int, date: str = "20240101000000") -> None:
    """Write pages (page_id, url, html) as ARC files of versions 1 and 2 by turns."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("binary"))
    spread = rows.withColumn("_spread", F.xxhash64("page_id", "url", "html")).repartition(files, "_spread")
    lines = spread.sortWithinPartitions("page_id", "_spread").drop("_spread").mapInPandas(_to_arc(date), "value binary")
    lines.select(F.col("value").cast("string")).write.option("lineSep", "\n").option("compression", "gzip").text(path)


# --------------------------------------------------------------------- ARC, read

@dataclass
class ArcRecord:
    url: str
    address: str
    date: str
    content_type: str
    content: bytes
    page_id: int | None
    http_head: bytes
    payload: bytes


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """HTTP head (with its blank line) and body; no head if it is no HTTP message."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    end = content.find(b"\r\n\r\n")
    return (content, b"") if end < 0 else (content[: end + 4], content[end + 4 :])


def head_value(head: bytes, name: str) -> str | None:
    wanted = name.lower().encode() + b":"
    for line in head.split(b"\r\n"):
        if line.lower().startswith(wanted):
            return line[len(wanted) :].strip().decode()
    return None


def read_arc(data: bytes) -> Iterator[ArcRecord]:
    """The records of an ARC file, without its version block.  Empty data has none."""
    at, version = 0, 0
    while at < len(data):
        if data[at : at + 1] == b"\n":
            at += 1
            continue
        end = data.find(b"\n", at)
        if end < 0:
            raise ArchiveError("header line without end")
        fields = data[at:end].decode("utf-8", "replace").split(" ")
        try:
            length = int(fields[-1])
        except ValueError:
            raise ArchiveError(f"no length in {fields}") from None
        content = data[end + 1 : end + 1 + length]
        if length < 0 or len(content) != length:
            raise ArchiveError("record shorter than declared")
        at = end + 1 + length
        if not version:
            if not fields[0].startswith("filedesc://"):
                raise ArchiveError("no version block")
            version = int(content.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ArchiveError(f"version {version}")
            continue
        if len(fields) != len(ARC_FIELDS[version]):
            raise ArchiveError(f"{len(fields)} header fields in version {version}")
        named = dict(zip(ARC_FIELDS[version], fields, strict=True))
        head, payload = split_http(content)
        page = head_value(head, "X-Page-Id")
        yield ArcRecord(
            named["URL"], named["IP-address"], named["Archive-date"], named["Content-type"], content,
            None if page is None else int(page), head, payload,
        )


def warc_date(date: str) -> str:
    """Fourteen digits as a timestamp; missing digits are the earliest possible."""
    if not date.isdigit() or not 4 <= len(date) <= 14:
        raise ArchiveError(f"date {date}")
    d = date + "00000101000000"[len(date) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(file: str, index: int, digest: str) -> str:
    """The same record gets the same identifier on every run."""
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{file}#{index}#{digest}')}"


# ------------------------------------------------------------------ WARC, written

def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """Without the two line ends that close a record: the writer adds them."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block


def warcinfo(name: str, date: str) -> bytes:
    fields = [
        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{record_id(name, 0, 'warcinfo')}>"),
        ("WARC-Date", warc_date(date)), ("WARC-Filename", name), ("Content-Type", "application/warc-fields"),
    ]
    return warc_record(fields, b"software: tradebinder\r\nformat: WARC File Format 1.1\r\n")


def convert_record(record: ArcRecord, file: str, index: int, revisit: dict | None) -> bytes:
    digest = payload_digest(record.payload)
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{record_id(file, index, digest)}>"),
        ("WARC-Date", warc_date(record.date)),
        ("WARC-Target-URI", record.url),
        ("WARC-IP-Address", record.address),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", RESPONSE_TYPE if record.http_head else record.content_type),
    ]
    if not revisit:
        return warc_record(fields, record.content)
    fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{record_id(revisit['file'], revisit['idx'], digest)}>")]
    if revisit["page_id"] is not None:
        fields.append(("X-Refers-To-Page-Id", str(revisit["page_id"])))
    return warc_record(fields, record.http_head)


def _base(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def _index_arc(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            rows = [
                (_base(path), n, r.page_id, payload_digest(r.payload), len(r.payload))
                for n, r in enumerate(read_arc(gzip.decompress(content) if content else b""))
            ]
            out = pd.DataFrame(rows, columns=["file", "idx", "page_id", "digest", "payload_bytes"])
            yield out.astype({"page_id": "Int64"})


def _to_warc(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    started = False
    for batch in batches:
        for path, content, revisits in zip(batch["path"], batch["content"], batch["revisits"], strict=True):
            by_index = {} if revisits is None else {r["at"]: r for r in revisits}
            out = []
            for n, record in enumerate(read_arc(gzip.decompress(content) if content else b"")):
                if not started:
                    started = True
                    out.append(warcinfo(_base(path).replace(".txt", ".warc"), record.date))
                out.append(convert_record(record, _base(path), n, by_index.get(n)))
            yield pd.DataFrame({"value": out})


def convert_arc(spark: SparkSession, arc_path: str, warc_path: str, files: int, least_bytes: int = 0) -> None:
    """Convert every ARC file below ``arc_path``; repeated payloads become revisit records.

    Of records with equal payloads of at least ``least_bytes`` the one with the smallest page
    id (then file and position; no id counts as largest) is the response the others refer to.
    """
    arcs = spark.read.format("binaryFile").load(arc_path).select("path", "content")
    index = stored(arcs.mapInPandas(_index_arc, "file string, idx long, page_id long, digest string, payload_bytes long"))
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "file", "idx")
    first = index.where(F.col("payload_bytes") >= least_bytes).groupBy("digest", "payload_bytes")
    first = first.agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = spread_join(index, first, ["digest", "payload_bytes"], "inner", ["file", "idx"])
    again = again.where((F.col("file") != F.col("first.file")) | (F.col("idx") != F.col("first.idx")))
    target = F.struct(F.col("idx").alias("at"), "first.page_id", "first.file", "first.idx")
    revisits = again.groupBy("file").agg(F.collect_list(target).alias("revisits"))
    keyed = arcs.withColumn("file", F.element_at(F.split("path", "/"), -1)).repartition(files, "file")
    both = keyed.join(revisits.repartition(files, "file"), "file", "left").select("path", "content", "revisits")
    lines = both.mapInPandas(_to_warc, "value binary").select(F.col("value").cast("string"))
    lines.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(warc_path)


# --------------------------------------------------------------------- WARC, read

def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/1.", at):
            raise ArchiveError("no WARC record")
        lines = data[at:end].decode("utf-8").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        length = int(fields["content-length"])
        block = data[end + 4 : end + 4 + length]
        at = end + 4 + length
        if len(block) != length or data[at : at + 4] != b"\r\n\r\n":
            raise ArchiveError("record shorter than declared")
        at += 4
        yield fields, block


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def _index_warc(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["page_id", "url", "warc_date", "record_id", "record_type", "payload_bytes", "payload_digest", "refers_to"]
    for batch in batches:
        for content in batch["content"]:
            rows = []
            for fields, block in read_warc(gzip.decompress(content) if content else b""):
                if fields["warc-type"] not in ("response", "revisit"):
                    continue
                head, payload = split_http(block)
                length = _number(head_value(head, "Content-Length"))
                rows.append((
                    _number(head_value(head, "X-Page-Id")), fields["warc-target-uri"], fields["warc-date"],
                    fields["warc-record-id"].strip("<>"), fields["warc-type"],
                    len(payload) if length is None else length,
                    fields["warc-payload-digest"].removeprefix("sha1:"), _number(fields.get("x-refers-to-page-id")),
                ))
            out = pd.DataFrame(rows, columns=columns)
            yield out.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per response or revisit record below ``path``."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(
        _index_warc,
        "page_id long, url string, warc_date string, record_id string, record_type string, "
        "payload_bytes long, payload_digest string, refers_to long",
    )


def pages_through_archives(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write pages (page_id, url, html) as ARC files, convert them, read the WARC files.

    Null html is an empty payload, a null url is written as a dash, blanks in a url are
    percent-encoded; a null page_id stays null and counts as the largest; repeated rows are
    records of their own, of which one is the response; an empty table gives no rows; other
    columns are ignored.
    """
    spark = pages.sparkSession
    files = file_count(pages, "html")
    arc, warc = scratch_path(spark), scratch_path(spark)
    write_arc(pages, arc, files)
    convert_arc(spark, arc, warc, files, least_bytes)
    return read_archives(spark, warc)
