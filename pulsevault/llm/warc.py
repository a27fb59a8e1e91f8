"""Legacy archive converter: ARC files to WARC records, written as archives and read back.

An ARC file is a version block, which says which header line its records have (version 1: 5 fields, version 2: 10 fields),
then records, each a header line that declares the content's length, the content and a line end. The converter walks the
declared lengths, splits the HTTP head off, and synthesises what a WARC record needs: identifier, ISO timestamp, type and
SHA-1 digests. Records of equal payloads of at least `least` bytes become one response, that with the largest key, and
revisits that refer to it.

Payloads cross the network once, on the unique record key and not on their digest, so a payload that a third of all pages
share is no hot task. Archives are gzip files of bounded numbers of records, written by Spark's writer into the shared
folder (record bytes pass as they are) and read back by their declared lengths.

Rows: null html is an empty payload; a null url gives a record without target; a null page_id gives a record with an
identifier made from its content, which is never the largest key; rows that share the largest page_id are all responses; an
empty table gives an empty result; other columns are ignored. Texts of any length below 2 GB are one record. A damaged record
raises an error; with strict=False it is a row of which only `problem` is filled, and what can't be trusted after it is left
out."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import itertools
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_rows, new_path

#: Fields of a record's header line by ARC version (fixed by the format).
FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
_KEY = b"X-Record-Key: "
_END = b"\r\n\r\n"
RECORD = "key long, url string, ip string, stamp string, mime string, head binary, payload binary, digest string, size long, problem string"
_ARROW = pa.schema([("key", pa.int64()), ("url", pa.string()), ("ip", pa.string()), ("stamp", pa.string()), ("mime", pa.string()), ("head", pa.binary()), ("payload", pa.binary()), ("digest", pa.string()), ("size", pa.int64()), ("problem", pa.string())])
_KEPT = _ARROW.names[:-1]


def arc_bytes(records: list[tuple[str, str, str, str, bytes]], version: int = 1, name: str = "pages.arc") -> bytes:
    """An ARC file of records (url, ip, 14-digit date, content type, content)."""
    lines = f"{version} 0 pulsevault\n{' '.join(FIELDS[version])}\n\n".encode()
    tail = "" if version == 1 else f" 200 - - 0 {name}"
    out = [f"filedesc://{name} 0.0.0.0 20240101000000 text/plain{tail} {len(lines)}\n".encode(), lines]
    for url, ip, date, mime, content in records:
        tail = "" if version == 1 else f" 200 {hashlib.md5(content, usedforsecurity=False).hexdigest()} - 0 {name}"
        out += [f"{url} {ip} {date} {mime}{tail} {len(content)}\n".encode(), content, b"\n"]
    return b"".join(out)


def parse_arc(data: bytes) -> Iterator[dict]:
    """Records of an ARC file as {field: text, "content": bytes}. A header line whose fields or length don't fit ends the
    walk with ValueError: lengths after it can't be trusted."""
    view, at, fields = memoryview(data), 0, FIELDS[1]
    while at < len(data):
        if data[at] == 10:  # blank lines between records
            at += 1
            continue
        stop = data.find(b"\n", at)
        if stop < 0:
            raise ValueError(f"no header line at byte {at}")
        line = data[at:stop].decode("utf-8", "replace").rstrip("\r")
        first = at == 0 and line.startswith("filedesc:")
        parts = line.split(" ") if first else line.rsplit(" ", len(fields) - 1)
        if not parts[-1].isdigit() or not first and len(parts) != len(fields):
            raise ValueError(f"bad header line at byte {at}")
        size, at = int(parts[-1]), stop + 1
        if at + size > len(data):
            raise ValueError(f"record at byte {at} is cut off")
        content, at = bytes(view[at : at + size]), at + size
        if first:
            fields = FIELDS[int(content.split(b" ", 1)[0])]
        else:
            yield dict(zip(fields, parts, strict=True)) | {"content": content}


def _record(r: dict) -> tuple:
    """The columns of RECORD of an ARC record."""
    head, mark, payload = r["content"].partition(_END) if r["content"].startswith(b"HTTP/") else (b"", b"", r["content"])
    head += mark
    key = head[head.index(_KEY) + len(_KEY) :].split(b"\r\n", 1)[0] if _KEY in head else b""
    url = None if r["URL"] == "-" else r["URL"]
    return int(key) if key else None, url, r["IP-address"], r["Archive-date"], r["Content-type"], head, payload, hashlib.sha1(payload, usedforsecurity=False).hexdigest(), len(payload), None


def _or_problem(rows: Iterator[tuple], width: int, strict: bool) -> Iterator[tuple]:
    """The rows up to an error, which is raised, or else is a last row of which only the last column is filled."""
    try:
        yield from rows
    except (ValueError, KeyError, OSError, EOFError, zlib.error) as e:
        if strict:
            raise
        yield (*[None] * (width - 1), str(e))


def converted(archives: DataFrame, strict: bool = True) -> DataFrame:
    """RECORD rows of ARC files given as a binary column `content`."""

    def run(batches):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                rows = list(_or_problem(map(_record, parse_arc(data or b"")), len(_ARROW), strict))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), _ARROW)] if rows else [pa.array([], f.type) for f in _ARROW], schema=_ARROW)

    return archives.select("content").mapInArrow(run, RECORD)


def read_arc(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """RECORD rows of the ARC files under path (gzip or plain), a task per file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    unzip = F.udf(lambda b: gzip.decompress(b) if b[:2] == b"\x1f\x8b" else b, "binary")
    return converted(files.select(unzip("content").alias("content")), strict)


def pages_as_arc(pages: DataFrame, version: int | None = None) -> DataFrame:
    """ARC files of a few hundred pages each, as a binary column: the legacy form of (page_id, url, html). Without a version
    the files of a task are of version 1 and 2 by turns."""

    def make():
        turn = itertools.cycle([version] if version else [1, 2])

        def work(batch: pa.RecordBatch) -> dict:
            records = []
            for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key = b"" if page_id is None else _KEY + str(page_id).encode() + b"\r\n"
                head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + key + b"\r\n"
                records.append((re.sub(r"\s", "%20", url or "-") or "-", "0.0.0.0", "20240101000000", "text/html", head + (html or "").encode("utf-8", "replace")))
            return {"content": [arc_bytes(records, next(turn))]}

        return work

    return map_rows(pages.select(F.col("page_id").cast("long"), "url", "html"), make, "content binary", pa.schema([("content", pa.binary())]))


def record_id(key: int | None, digest: str, url: str | None = None, stamp: str | None = None) -> str:
    """A version-8 UUID that holds the record's key and the first bits of its digest; without a key a name-based UUID."""
    if key is None:
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {stamp} {digest}')}>"
    k = key & (2**64 - 1)
    value = int(digest[:12], 16) << 80 | 8 << 76 | (k >> 62) << 64 | 2 << 62 | k & (2**62 - 1)
    return f"<urn:uuid:{uuid.UUID(int=value)}>"


def key_of(identifier: str) -> int | None:
    """The key that record_id() put in."""
    try:
        u = uuid.UUID(identifier.strip("<>").removeprefix("urn:uuid:"))
    except ValueError:  # another kind of identifier
        return None
    if u.version != 8:
        return None
    k = (u.int >> 64 & 3) << 62 | u.int & (2**62 - 1)
    return k - 2**64 if k >= 2**63 else k


def _base32(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def warc_record(r: dict) -> bytes:
    """The bytes of a WARC record up to and without its last line feed, which Spark's writer adds."""
    revisit = r["refers"] is not None
    block = r["head"] + (b"" if revisit else r["payload"])
    date = re.sub(r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)$", r"\1-\2-\3T\4:\5:\6Z", r["stamp"] or "")
    lines = [
        "WARC/1.0", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(r['key'], r['digest'], r['url'], r['stamp'])}", f"WARC-Date: {date}",
        f"WARC-IP-Address: {r['ip']}", f"WARC-Payload-Digest: {_base32(r['digest'])}", f"WARC-Block-Digest: {_base32(hashlib.sha1(block, usedforsecurity=False).hexdigest())}", f"X-Payload-Length: {r['size']}",
        "Content-Type: application/http; msgtype=response" if r["head"] else f"Content-Type: {r['mime']}", f"Content-Length: {len(block)}",
    ]
    if r["url"] is not None:
        lines.insert(3, f"WARC-Target-URI: {r['url']}")
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(r['refers'], r['digest'])}"]
    return "\r\n".join(lines).encode() + _END + block + b"\r\n\r"


def parse_warc(stream: io.BufferedIOBase) -> Iterator[tuple[dict, bytes]]:
    """(headers, block) of the records of a WARC stream, by their declared lengths."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        if len(block) < int(headers["content-length"]):
            raise ValueError("record is cut off")
        yield headers, block


def with_revisits(records: DataFrame, least: int = 1000) -> DataFrame:
    """Adds `refers`: of records with equal payloads of at least `least` bytes, the largest key for all but its own record."""
    groups = records.where(F.col("size") >= least).select("key", "digest", "size")
    best = groups.groupBy("digest", "size").agg(F.max("key").alias("best"), F.count("*").alias("n")).where("n > 1 and best is not null").drop("n")
    revisits = groups.join(best, ["digest", "size"]).where("key is null or key < best").select(F.col("key").alias("_k"), F.col("digest").alias("_d"), F.col("best").alias("refers")).distinct()
    return records.join(revisits, F.col("key").eqNullSafe(F.col("_k")) & (F.col("digest") == F.col("_d")), "left").drop("_k", "_d")


def write_warc(records: DataFrame, path: str, records_per_file: int = 4000) -> None:
    """WARC archives (gzip) of RECORD rows with `refers`."""

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            return {"record": [warc_record(r) for r in batch.to_pylist()]}

        return work

    out = map_rows(records.where("problem is null").select(*_KEPT, "refers"), make, "record binary", pa.schema([("record", pa.binary())]))
    out.select(F.col("record").cast("string").alias("value")).write.option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


WARC_RECORD = "record_key long, record_type string, target_uri string, warc_date string, payload_digest string, payload_bytes long, refers_to long, payload binary, problem string"


def _warc_row(h: dict, block: bytes) -> tuple:
    """The columns of WARC_RECORD of a record."""
    kind, payload = h["warc-type"], None
    if kind != "revisit":
        payload = block.partition(_END)[2] if kind == "response" and h.get("content-type", "").startswith("application/http") else block
    said = h.get("warc-payload-digest", "")
    digest = base64.b32decode(said[5:]).hex() if re.fullmatch("sha1:[A-Z2-7]{32}", said) else None
    if payload is not None:
        found = hashlib.sha1(payload, usedforsecurity=False).hexdigest()
        if kind == "response" and digest not in (None, found):
            raise ValueError(f"payload of {h['warc-record-id']} differs from its digest")
        digest = found
    refers = h.get("warc-refers-to")
    return key_of(h["warc-record-id"]), kind, h.get("warc-target-uri"), h.get("warc-date"), digest, int(h.get("x-payload-length", len(payload or b""))), key_of(refers) if refers else None, payload, None


def read_warc(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """WARC_RECORD rows of the archives under path, those of other writers too: without an own key record_key is null. The
    payload of a response is checked against its digest; that of a revisit is null."""
    arrow = pa.schema([("record_key", pa.int64()), ("record_type", pa.string()), ("target_uri", pa.string()), ("warc_date", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("problem", pa.string())])

    def records(stream) -> Iterator[tuple]:
        for h, block in parse_warc(stream):
            yield from _or_problem(map(_warc_row, [h], [block]), len(arrow), strict)

    def run(batches):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                stream = gzip.GzipFile(fileobj=io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
                rows, held = [], 0
                for row in itertools.chain(_or_problem(records(io.BufferedReader(stream)), len(arrow), strict), [None]):
                    if row is not None:
                        rows.append(row)
                        held += len(row[7] or b"")
                    if rows and (row is None or held > 4_000_000):
                        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)
                        rows, held = [], 0

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, WARC_RECORD)


def archive_pages(pages: DataFrame, least: int = 1000, version: int | None = None) -> DataFrame:
    """pages -> ARC -> WARC archives in the shared folder -> WARC_RECORD rows read from them."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_warc(with_revisits(converted(pages_as_arc(pages, version)), least), path)
    return read_warc(spark, path).drop("problem")
