"""Legacy ARC archives to WARC.

``write_arc`` writes records as ARC files (version 1 or 2), ``read_arc`` parses
them by the field line of each file's version block and the declared lengths,
``to_warc`` synthesises WARC record ids, timestamps, types and digests, marks
repeated payloads as revisits, and writes WARC 1.0 files; ``read_warc`` parses
those.  Files are written by Spark's text writer (its committer keeps them whole
when an executor is lost), gzip-compressed, one or more a partition.

A file is read as one row, so a file must fit a task (Spark's limit is 2 GB;
archives are about 100 MB by custom); its records are parsed from the stream one
after another.

Cases: a null payload is empty; a null URL is written as ``-`` and blanks in URLs
are escaped; a null id comes back null and loses ties against any id; among equal
payloads the largest id is the response, and among equal ids the record with the
greatest record id (a name-based UUID of file, URL, date, offset, digest and id); payloads of any bytes and length survive; an empty table gives an empty
archive.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.llm.common import saved

# Fixed values of the formats.
ARC_FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length", 2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
#: Archives are written once and read once here, so their compression is a light one.
GZIP_LEVEL = "TWO"
ARC_SUFFIX, WARC_SUFFIX = "\n", "\r\n\r\n"
ARC_SCHEMA = "arc_file string, offset long, version int, url string, ip string, archive_date string, content_type string, http binary, payload binary, payload_digest string, page_id string, record_id string"
INDEX_SCHEMA = "record_id string, payload_digest string, page_id string, payload_bytes long"
WARC_SCHEMA = "record_id string, record_type string, target_uri string, warc_date string, payload_digest string, refers_to_id string, http binary, payload binary, page_id long, payload_bytes long"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _escaped(url) -> str:
    url = url if isinstance(url, str) and url else "-"
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def arc_record(version: int, url: str, ip: str, date: str, kind: str, block: bytes) -> bytes:
    fields = [_escaped(url), ip, date, kind]
    if version == 2:
        fields += ["200", hashlib.md5(block).hexdigest(), "-", "0", "-"]
    return " ".join([*fields, str(len(block))]).encode("utf-8", "surrogatepass") + b"\n" + block


def version_block(version: int, name: str = "pages.arc") -> bytes:
    body = f"{version} 0 hourglass\n{ARC_FIELDS[version]}\n".encode()
    head = [f"filedesc://{name}", "0.0.0.0", "20000101000000", "text/plain"] + (["200", "-", "-", "0", name] if version == 2 else [])
    return " ".join([*head, str(len(body))]).encode() + b"\n" + body


def write_text(records: DataFrame, path: str, suffix: str) -> None:
    """Write the bytes of column ``record``, each followed by ``suffix``."""
    out = records.select(F.col("record").cast("string")).write.option("lineSep", suffix)
    out.option("compression", "gzip").option("zlib.compress.level", GZIP_LEVEL).text(path)


def write_arc(rows: DataFrame, path: str, version: int = 1, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> None:
    """Write a record per row: an HTTP response whose body is the text in UTF-8."""

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        head = [version_block(version)]
        for pdf in batches:
            out = head
            head = []
            for i, url, text in zip(pdf["id"], pdf["url"], pdf["body"], strict=True):
                body = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
                name = "" if pd.isna(i) else f"X-Page-Id: {int(i)}\r\n"
                http = f"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{name}Content-Length: {len(body)}\r\n\r\n".encode()
                out.append(arc_record(version, url, "0.0.0.0", "20000101000000", "text/html", http + body))
            yield pd.DataFrame({"record": out})

    src = rows.select(F.col(id_col).cast("long").cast("string").alias("id"), F.col(url_col).alias("url"), F.col(body_col).alias("body"))
    write_text(src.mapInPandas(records, "record binary"), path, ARC_SUFFIX)


def arc_records(stream) -> Iterator[tuple]:
    """(offset, version, url, ip, date, type, block) of an open ARC file; the version
    block tells which fields its header lines hold."""
    fields, version, offset = None, 0, 0
    while line := stream.readline():
        at, offset = offset, offset + len(line)
        if not line.strip():
            continue
        parts = line.rstrip(b"\r\n").decode("utf-8", "surrogatepass").split(" ")
        block = stream.read(int(parts[-1]))
        offset += len(block)
        if len(block) < int(parts[-1]):
            raise ValueError(f"ARC record at {at} is cut short")
        if parts[0].startswith("filedesc://"):
            lines = block.decode().split("\n")
            version, fields = int(lines[0].split(" ")[0]), lines[1].split(" ")
        elif fields is None:
            raise ValueError("ARC file without a version block")
        else:
            if len(parts) != len(fields):
                raise ValueError(f"ARC record at {at} has {len(parts)} fields; version {version} has {len(fields)}")
            f = dict(zip(fields, parts, strict=True))
            yield at, version, f["URL"], f["IP-address"], f["Archive-date"], f["Content-type"], block


def _split_http(block: bytes) -> tuple[bytes, bytes]:
    head, sep, body = block.partition(b"\r\n\r\n")
    return (head + sep, body) if sep and head.startswith(b"HTTP/") else (b"", block)


def _parsed(files: DataFrame, parse, columns: list[str], schema: str) -> DataFrame:
    def run(batches):
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                stream = gzip.open(io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
                part, held = [], 0
                for row in parse(path, stream):
                    part.append(row)
                    held += sum(len(x) for x in row if isinstance(x, bytes))
                    if held > 4 << 20:
                        yield pd.DataFrame(part, columns=columns)
                        part, held = [], 0
                if part:
                    yield pd.DataFrame(part, columns=columns)

    return files.select("path", "content").mapInPandas(run, schema)


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def read_arc(spark: SparkSession, *paths: str) -> DataFrame:
    """A row per record of the archives under the paths, with the digest of its payload, the
    page id its HTTP header names, and the id that it has as a WARC record."""

    def parse(path, stream):
        for at, version, url, ip, date, kind, block in arc_records(stream):
            http, payload = _split_http(block)
            digest, page = sha1_base32(payload), _header(http, "X-Page-Id")
            yield path, at, version, url, ip, date, kind, http, payload, digest, page, warc_id(path, url, date, at, digest, page)

    return _parsed(spark.read.format("binaryFile").load(list(paths)), parse, _names(ARC_SCHEMA), ARC_SCHEMA)


def _header(http: bytes, name: str) -> str | None:
    for line in http.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        if key.strip().lower() == name.lower().encode():
            return value.strip().decode()
    return None


def warc_id(file: str, url: str, date: str, offset: int, digest: str, page) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{file} {url} {date} {offset} {digest} {page}')}>"


def warc_record(headers: dict, block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers.items() if v is not None)
    return f"WARC/1.0\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode("utf-8", "surrogatepass") + block


def arc_index(spark: SparkSession, *paths: str) -> DataFrame:
    """record_id, payload_digest, page_id, payload_bytes of the archives' records; payloads stay in the parsing task."""

    def parse(path, stream):
        for at, _, url, _, date, _, block in arc_records(stream):
            http, payload = _split_http(block)
            digest, page = sha1_base32(payload), _header(http, "X-Page-Id")
            yield warc_id(path, url, date, at, digest, page), digest, page, len(payload)

    return _parsed(spark.read.format("binaryFile").load(list(paths)), parse, _names(INDEX_SCHEMA), INDEX_SCHEMA)


def decisions(index: DataFrame, min_bytes: int = 0) -> DataFrame:
    """record_id, refers_to_id of the records of ``index`` that revisit another one.

    Digests are counted before the shuffle, and the rows of repeated payloads meet their
    response by salted keys."""
    page = F.col("page_id").cast("long").alias("page")
    keys = saved(index.select("record_id", F.col("payload_digest").alias("digest"), page, F.col("payload_bytes").alias("n")).filter(F.col("n") >= min_bytes))
    first = keys.groupBy("digest", "n").agg(F.count("*").alias("c"), F.max(F.struct(F.coalesce(F.col("page"), F.lit(-(1 << 62))).alias("p"), "record_id")).alias("r")).filter("c > 1")
    first = first.select("digest", "n", F.col("r.record_id").alias("refers_to_id"), F.explode(F.sequence(F.lit(0), F.lit(15))).alias("salt"))
    rows = keys.select("record_id", "digest", "n", F.pmod(F.xxhash64("record_id"), F.lit(16)).cast("int").alias("salt"))
    return rows.join(first, ["digest", "n", "salt"]).filter("record_id <> refers_to_id").select("record_id", "refers_to_id")


def to_warc(records: DataFrame, path: str, min_bytes: int = 0, index: DataFrame | None = None) -> None:
    """Write ARC records as WARC records: a response each, or a revisit that keeps
    the HTTP header but not the payload.  ``index``: ``arc_index`` of the same archives, which
    spares a pass that moves payloads."""
    if index is None:
        index = records.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    judged = records.join(decisions(index, min_bytes), "record_id", "left")

    def convert(batches):
        info = [warc_record({"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'warcinfo')}>", "WARC-Date": "2000-01-01T00:00:00Z", "Content-Type": "application/warc-fields"}, b"software: hourglass\r\n")]
        for pdf in batches:
            out, info = info, []
            for r in pdf.itertuples():
                d, revisit = r.archive_date, isinstance(r.refers_to_id, str)
                block = r.http if revisit else r.http + r.payload
                out.append(
                    warc_record(
                        {
                            "WARC-Type": "revisit" if revisit else "response" if r.http else "resource",
                            "WARC-Record-ID": r.record_id,
                            "WARC-Date": f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z",
                            "WARC-Target-URI": r.url,
                            "WARC-IP-Address": r.ip,
                            "WARC-Payload-Digest": f"sha1:{r.payload_digest}",
                            "WARC-Block-Digest": f"sha1:{sha1_base32(block)}",
                            "Payload-Length": len(r.payload),
                            "WARC-Refers-To": r.refers_to_id if revisit else None,
                            "WARC-Profile": "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest" if revisit else None,
                            "Content-Type": "application/http; msgtype=response" if r.http else r.content_type,
                        },
                        block,
                    )
                )
            yield pd.DataFrame({"record": out})

    write_text(judged.mapInPandas(convert, "record binary"), path, WARC_SUFFIX)


def warc_records(stream) -> Iterator[tuple[dict, bytes]]:
    """(headers by lower-case name, block) of an open WARC file."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            key, _, value = line.decode("utf-8", "surrogatepass").partition(":")
            headers[key.strip().lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        if len(block) < int(headers["content-length"]):
            raise ValueError("WARC record is cut short")
        yield headers, block


def read_warc(spark: SparkSession, *paths: str) -> DataFrame:
    """A row per response, resource or revisit record.  A response's length and
    digest are taken from its payload anew and must equal the header; a revisit's
    come from the headers it keeps."""

    def parse(path, stream):
        for h, block in warc_records(stream):
            if h["warc-type"] == "warcinfo":
                continue
            http, payload = _split_http(block)
            digest, revisit = h["warc-payload-digest"].removeprefix("sha1:"), h["warc-type"] == "revisit"
            if not revisit and sha1_base32(payload) != digest:
                raise ValueError(f"payload of {h['warc-record-id']} does not match its digest")
            page = _header(http, "X-Page-Id")
            n = int(h["payload-length"]) if revisit else len(payload)
            yield h["warc-record-id"], h["warc-type"], h.get("warc-target-uri"), h["warc-date"], digest, h.get("warc-refers-to"), http, payload, page, n

    text = WARC_SCHEMA.replace("page_id long", "page_id string")
    out = _parsed(spark.read.format("binaryFile").load(list(paths)), parse, _names(text), text)
    return out.withColumn("page_id", F.col("page_id").cast("long"))
