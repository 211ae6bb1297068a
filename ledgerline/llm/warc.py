"""Legacy archive converter: ARC volumes of either version become WARC records.

An ARC volume opens with a version block, whose first line tells the version and whose second names the
header's fields: five in version 1, ten in version 2. Each record is a header line, as many bytes as its
last field declares, and a line feed. The converter synthesises what WARC asks for and ARC lacks:
identifiers (from the volume's name and the record's offset, so that a task that runs again gives the
same), timestamps in ISO form, record types, and SHA-1 digests of block and payload. Of records with
equal payloads one is a response, and the others are revisits that refer to it and carry no payload.

Payloads are shuffled once, and only those of responses; by their unique identifier, so that no payload's
copies meet. Archives hold a gzip member for each record and are cut by bytes. Spark's text writer writes them,
so any file system that Spark knows will do, and task commits keep files whole.

Defined results: a null html is an empty payload; a very long one is a record of its own archive, which must stay under 2 GB; a null url is ``unknown:-``; a null page_id is the least
and comes back null; rows that repeat a page_id are records of their own, one of which is the response;
empty volumes and tables give no records; a damaged header or a length beyond the volume's end gives one
row with ``problem`` and ends that volume; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .support import as_bytes, new_path, small_batches, written

#: Fixed values of the formats.
FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length", 2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
VOLUME_BYTES = 4 << 20
#: Bytes after which an archive is closed; with its last record, it must stay under the 2 GB of one row.
FILE_BYTES = 32 << 20
_EMPTY_MEMBER = zlib.compressobj(1, zlib.DEFLATED, 31).flush()
PAGE_HEADER = "X-Page-Id"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---------------------------------------------------------------------------------------------
# ARC


def arc_header(version: int, uri: str, ip: str, date: str, mime: str, length: int, offset: int = 0, name: str = "-", code: str = "200") -> bytes:
    middle = "" if version == 1 else f"{code} - - {offset} {name} "
    return f"{uri} {ip} {date} {mime} {middle}{length}\n".encode()


class ArcVolume:
    """Builds one volume in memory."""

    def __init__(self, name: str, version: int, date: str) -> None:
        self.name, self.version, self.date, self.parts, self.size = name, version, date, [], 0
        about = f"{version} 0 Archive\n{FIELDS[version]}\n".encode()
        self._add(f"filedesc://{name}", "0.0.0.0", "text/plain", about)

    def _add(self, uri: str, ip: str, mime: str, block: bytes) -> None:
        part = arc_header(self.version, uri, ip, self.date, mime, len(block), self.size, self.name) + block + b"\n"
        self.parts.append(part)
        self.size += len(part)

    def add_page(self, page_id: int | None, url: str | None, html: bytes) -> None:
        """An HTTP response whose headers carry the page's number."""
        uri = urllib.parse.quote(url or "unknown:-", safe="!#$%&'()*+,/:;=?@[]~") or "unknown:-"
        mark = "" if page_id is None else f"{PAGE_HEADER}: {page_id}\r\n"
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{mark}Content-Length: {len(html)}\r\n\r\n"
        self._add(uri, "0.0.0.0", "text/html", head.encode() + html)

    def content(self) -> bytes:
        return b"".join(self.parts)


def arc_volumes(pages: DataFrame, date: str = "20010203040506", volume_bytes: int = VOLUME_BYTES) -> DataFrame:
    """name, content: ARC volumes with a record per page; versions 1 and 2 take turns."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count, volume = TaskContext.get().partitionId(), 0, None
        close = lambda v: pa.RecordBatch.from_arrays([pa.array([v.name]), pa.array([v.content()], pa.binary())], ["name", "content"])
        for batch in small_batches(batches):
            for page_id, url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), as_bytes(batch.column(2)), strict=True):
                if volume is None:
                    seed = hashlib.sha1(f"{page_id} {url}".encode() + (html or b"")).hexdigest()[:16]
                    volume = ArcVolume(f"legacy-{part:06d}-{count:06d}-{seed}.arc", 1 + (part + count) % 2, date)
                volume.add_page(page_id, url, html or b"")
                if volume.size >= volume_bytes:
                    yield close(volume)
                    count, volume = count + 1, None
        if volume is not None:
            yield close(volume)

    columns = [F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")]
    return pages.select(*columns).mapInArrow(fill, "name string, content binary")


def parse_arc(content: bytes) -> Iterator[dict]:
    """version, offset, uri, ip, date, mime, code, block of each record (problem, where the volume ends early)."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    at, version, size = 0, 0, len(content)
    while at < size:
        if content[at : at + 1] in b"\r\n":  # blank lines between records
            at += 1
            continue
        end = content.find(b"\n", at)
        line = content[at : end if end >= 0 else size].rstrip(b"\r")
        if not version:
            fields = 1 if line.count(b" ") == 4 else 2
            body = content[end + 1 : end + 200]
            version = {b"1": 1, b"2": 2}.get(body[:1], fields)
        parts = line.rsplit(b" ", 4 if version == 1 else 9)
        if end < 0 or len(parts) != (5 if version == 1 else 10) or not parts[-1].isdigit() or end + 1 + int(parts[-1]) > size:
            yield {"offset": at, "problem": f"no whole record at byte {at}"}
            return
        length = int(parts[-1])
        uri, ip, date, mime = (x.decode("utf-8", "replace") for x in parts[:4])
        code = parts[4].decode("utf-8", "replace") if version == 2 else None
        yield {"version": version, "offset": at, "uri": uri, "ip": ip, "date": date, "mime": mime, "code": code, "block": content[end + 1 : end + 1 + length], "problem": None}
        at = end + 1 + length


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """name, content of ARC files (compressed or not); a file must fit into a row."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("name"), "content")


# ---------------------------------------------------------------------------------------------
# Conversion


def timestamp(date: str) -> str:
    """ISO form of an ARC date of 4 to 14 digits; what is missing counts as its least value."""
    digits = re.sub(r"\D", "", date)[:14]
    whole = digits + "00000101000000"[len(digits) :] if len(digits) >= 4 else "19700101000000"
    return f"{whole[:4]}-{whole[4:6]}-{whole[6:8]}T{whole[8:10]}:{whole[10:12]}:{whole[12:14]}Z"


def identifier(volume: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{volume}#{offset}')}>"


def record_type(uri: str, block: bytes) -> str:
    if uri.startswith("filedesc:"):
        return "warcinfo"
    return "response" if block.startswith(b"HTTP/") else "resource"


def split_block(block: bytes) -> tuple[bytes, bytes]:
    """HTTP head (with the blank line) and payload; a block that is no HTTP message is all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    found = re.search(rb"\r?\n\r?\n", block)
    return (block[: found.end()], block[found.end() :]) if found else (block, b"")


def page_number(head: bytes) -> int | None:
    found = re.search(rb"(?im)^" + PAGE_HEADER.encode() + rb":[ \t]*(-?\d+)", head)
    return int(found[1]) if found else None


META = "record_id string, kind string, uri string, ip string, date string, mime string, head binary, page_id long, payload_bytes long, payload_digest string, block_digest string, problem string"


def arc_records(volumes: DataFrame, payload: bool) -> DataFrame:
    """One row per record, with what WARC needs; with its payload, compressed for the way through a shuffle, if asked for."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress if payload else None
        for batch in small_batches(batches, 1):  # a volume at a time is copied out of its batch
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = []
                for r in parse_arc(content):
                    row = {"record_id": identifier(name, r["offset"]), "problem": r["problem"]}
                    if not r["problem"]:
                        head, body = split_block(r["block"])
                        row |= {"kind": record_type(r["uri"], r["block"]), "uri": r["uri"], "ip": r["ip"], "date": timestamp(r["date"]), "mime": r["mime"], "head": head, "page_id": page_number(head), "payload_bytes": len(body), "payload_digest": digest(body), "block_digest": digest(r["block"]), "payload": pack(body) if pack else None}
                    rows.append(row)
                yield pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in shape], schema=shape)

    text, number, raw = pa.string(), pa.int64(), pa.binary()
    kinds = [text] * 6 + [raw, number, number, text, text, text]
    shape = pa.schema([(x.split()[0], kind) for x, kind in zip(META.split(", "), kinds, strict=True)] + ([("payload", raw)] if payload else []))
    return volumes.select("name", "content").mapInArrow(parse, META + (", payload binary" if payload else ""))


def warc_record(r: dict) -> bytes:
    """A record without the CRLF CRLF that ends it."""
    revisit = r["refers_to"] is not None
    block = (r["head"] or b"") + (b"" if revisit else r["payload"] or b"")
    kind = "revisit" if revisit else r["kind"]
    content = {"warcinfo": "application/warc-fields", "response": "application/http; msgtype=response", "revisit": "application/http; msgtype=response"}.get(kind, r["mime"] or "application/octet-stream")
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {r['record_id']}", f"WARC-Date: {r['date']}"]
    if kind != "warcinfo":
        lines += [f"WARC-Target-URI: {r['uri']}", f"WARC-IP-Address: {r['ip']}", f"WARC-Payload-Digest: sha1:{r['payload_digest']}"]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {r['refers_to']}", f"WARC-Refers-To-Target-URI: {r['refers_uri']}", f"WARC-Refers-To-Date: {r['refers_date']}"]
    lines += [f"WARC-Block-Digest: sha1:{digest(block)}", f"Content-Type: {content}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def convert(volumes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """WARC records (column value, one each) of ARC volumes (name, content), and the problems met (record_id, problem)."""
    meta = written(arc_records(volumes, payload=False), "arc")
    whole = meta.where("problem is null")
    responses = whole.where("kind = 'response'")
    # of equal payloads, the largest page_id answers
    top = responses.groupBy("payload_digest", "payload_bytes").agg(F.max(F.struct("page_id", "record_id", "uri", "date")).alias("top"))
    other = F.col("top.record_id") != F.col("record_id")
    told = responses.join(top, ["payload_digest", "payload_bytes"]).select(*whole.columns, *(F.when(other, F.col(f"top.{c}")).alias(a) for c, a in (("record_id", "refers_to"), ("uri", "refers_uri"), ("date", "refers_date"))))
    none = [F.lit(None).cast("string").alias(c) for c in ("refers_to", "refers_uri", "refers_date")]
    told = written(told.unionByName(whole.where("kind <> 'response'").select("*", *none)), "told")
    bodies = arc_records(volumes, payload=True).where("problem is null").select("record_id", "payload")
    first = told.where("refers_to is null").join(bodies, "record_id")
    again = told.where("refers_to is not null").withColumn("payload", F.lit(None).cast("binary"))

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in small_batches(batches, 64):
            rows = ({**r, "payload": unpack(r["payload"]) if r["payload"] is not None else None} for r in batch.to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([warc_record(r) for r in rows], pa.binary())], ["value"])

    columns = ["record_id", "kind", "uri", "ip", "date", "mime", "head", "payload_digest", "refers_to", "refers_uri", "refers_date", "payload"]
    records = first.select(columns).unionByName(again.select(columns)).mapInArrow(formatted, "value binary")
    return records, meta.where("problem is not null").select("record_id", "problem")


def _bundled(file_bytes: int, compress: bool):
    """From records, the contents of archives: each is closed once it holds ``file_bytes``."""

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in small_batches(batches, 64):
            for record in batch.column(0).to_pylist():
                member = record + b"\r\n\r\n"
                if compress:
                    deflate = zlib.compressobj(1, zlib.DEFLATED, 31)
                    member = deflate.compress(member) + deflate.flush()
                held.append(member)
                size += len(member)
                if size >= file_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])

    return bundle


def write_warc(records: DataFrame, path: str, file_bytes: int = FILE_BYTES, compress: bool = True) -> None:
    """Archives of about ``file_bytes``, with a gzip member for each record. Bytes pass through the text writer unchanged.

    What the writer puts at the end of each file is an empty gzip member, or else another line end between records.
    """
    contents = records.select("value").mapInArrow(_bundled(file_bytes, compress), "value binary")
    end = _EMPTY_MEMBER if compress else b"\r\n"
    writer = contents.select(F.col("value").cast("string")).write.option("encoding", "ISO-8859-1").option("lineSep", end.decode("latin-1"))
    writer.option("maxRecordsPerFile", 1).text(path)


# ---------------------------------------------------------------------------------------------
# Reading


def _members(content: bytes) -> Iterator[bytes]:
    view, at = memoryview(content), 0
    while at < len(view):
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            piece = view[at : at + (1 << 16)]
            if not len(piece):
                raise ValueError("a compressed record is cut off")
            parts.append(inflate.decompress(piece))
            at += len(piece) - len(inflate.unused_data)
        yield b"".join(parts)


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record, by declared lengths; of a compressed archive, one gzip member is unpacked at a time."""
    if content[:2] == b"\x1f\x8b":
        for member in _members(content):
            yield from parse_warc(member)
        return
    at = 0
    while (at := content.find(b"WARC/1.", at)) >= 0:
        end = content.index(b"\r\n\r\n", at)
        lines = content[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines)}
        start, length = end + 4, int(headers["content-length"])
        block = content[start : start + length]
        if len(block) < length:
            raise ValueError(f"record at byte {at} is cut off")
        yield headers, block
        at = start + length


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """record_id, record_type, uri, date, page_id, payload_bytes, payload_digest, refers_to_id (and payload: null in revisits).

    A revisit's payload_bytes and digest are those of the full payload, which its headers tell.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def closed(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(shape)], schema=shape)

        for batch in small_batches(batches, 1):  # an archive at a time is copied out of its batch
            for content in batch.column(0).to_pylist():
                rows, size = [], 0
                for headers, block in parse_warc(content):
                    head, body = split_block(block)
                    kind, said = headers["warc-type"], headers.get("warc-payload-digest", "").removeprefix("sha1:")
                    length = re.search(rb"(?im)^content-length:[ \t]*(\d+)", head)
                    revisit = kind == "revisit"
                    if said and not revisit and said != digest(body):
                        raise ValueError(f"digest of {headers['warc-record-id']} differs")
                    rows.append((headers["warc-record-id"], kind, headers.get("warc-target-uri"), headers["warc-date"], page_number(head), int(length[1]) if revisit and length else len(body), said if revisit else digest(body), headers.get("warc-refers-to"), body if payload and not revisit else None))
                    size += len(body) if payload else 0
                    if size >= VOLUME_BYTES:  # an archive may unpack to many times its bytes
                        yield closed(rows)
                        rows, size = [], 0
                yield closed(rows)

    text, number = pa.string(), pa.int64()
    names = ["record_id", "record_type", "uri", "date", "page_id", "payload_bytes", "payload_digest", "refers_to_id"]
    kinds = [text, text, text, text, number, number, text, text]
    shape = pa.schema([*zip(names, kinds, strict=True), *([("payload", pa.binary())] if payload else [])])
    out = ", ".join(f"{n} {'long' if k == number else 'string'}" for n, k in zip(names, kinds, strict=True)) + (", payload binary" if payload else "")
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parse, out)


def page_records(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Pages to ARC volumes, to WARC archives in ``path``, and back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    records, _ = convert(written(arc_volumes(pages), "volumes"))
    write_warc(records, path)
    back = written(read_warc(spark, path, payload=False).where("record_type in ('response', 'revisit')"), "back")
    answers = back.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    first = back.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long"))
    again = back.where("record_type = 'revisit'").join(answers, "refers_to_id")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return first.select(columns).unionByName(again.select(columns))
