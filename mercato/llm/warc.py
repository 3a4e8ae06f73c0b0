"""WARC archives with payload dedup and a two-level capture index.

Write: every page becomes one gzip member of a WARC file in the shared folder. Among equal payloads of at least
``min_bytes`` the smallest page id is the response record; the others are revisit records that name it. Groups are
found on the SHA-1 of the payload, pre-aggregated before the shuffle.

Index, first level: captures sorted by reversed-host URL key, in gzip blocks of ``BLOCK_LINES`` lines; each index file
ends in its own sparse block directory (first key, offset, length). Second level: the first key of each index file.
A lookup bisects the file list, then that file's directory, and range-reads only the blocks that can hold the key.
The range sort is on (key, file, offset), so one URL captured very often is spread over many files.

Files are named after a random id and only the files named in rows of finished tasks are ever read, so lost or
repeated tasks do no harm.

Edge cases: NULL html is an empty payload; a NULL url is stored without a target and indexed under the key ``-``;
a NULL page id never beats another id, and pages without ids that share a payload are all responses; repeated
(id, payload) rows are records of the same kind; an empty table writes no file. Only the three named columns are read.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote, urlsplit

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import shared_folder, stage

BLOCK_LINES = 3000
MIN_BYTES = 0
CAPTURES = "key string, page_id string, url string, file string, offset long, length long"
BLOCKS = "first_key string, index_file string, offset long, length long, n_lines long"
RECORDS = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string"


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a shared folder: local paths, file:, hdfs:, s3: and other known schemes."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def url_key(url: str | None) -> str:
    """Sortable key with the host reversed: ``http://Blog.Example.com/a?b`` gives ``com,example,blog)/a?b``."""
    if not url:
        return "-"
    try:
        parts = urlsplit(url.strip())
        host = parts.hostname or ""
        port = f":{parts.port}" if parts.port and parts.port not in (80, 443) else ""
    except ValueError:
        return quote(url, safe="/?&=%:,;+@!~*'()$#[]")
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(host.split("."))) + port + ")" + quote(path, safe="/?&=%:,;+@!~*'()$[]")


def base32_sha1(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _record_id(page_id: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def make_record(page_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC/1.1 record. A revisit has the HTTP head, whose Content-Length is the full payload's, and no body."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {_record_id(page_id, digest)}", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response",
            f"Content-Length: {len(block)}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {quote(page_id, safe=' -_.')}")
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="/?&=%:,;+@!~*'()$#[]"))
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"X-Refers-To-Page-Id: {quote(refers_to, safe=' -_.')}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and the payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[:int(warc["Content-Length"])]
    http_head, _, payload = block.partition(b"\r\n\r\n")
    return warc, dict(x.split(": ", 1) for x in http_head.decode().split("\r\n")[1:]), payload


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write the records; returns the captures (``CAPTURES``), staged."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), html.alias("html"),
                        F.sha1(html.cast("binary")).alias("sha1"))
    groups = (rows.where(F.octet_length("html") >= min_bytes).groupBy("sha1")
              .agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
              .where("copies > 1 AND first_id IS NOT NULL").drop("copies"))
    refers = F.when(~F.col("id").eqNullSafe(F.col("first_id")), F.col("first_id").cast("string"))
    todo = rows.join(groups, "sha1", "left").select(F.col("id").cast("string").alias("page_id"), "url", "html",
                                                    "sha1", refers.alias("refers_to"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = open_folder(folder)
        system.create_dir(base, recursive=True)
        name, at, out = f"{uuid.uuid4().hex}.warc.gz", 0, None
        try:
            for b in batches:
                found = []
                for r in b.itertuples(index=False):
                    digest = base32_sha1(r.sha1)
                    page_id, refers_to, url = (None if pd.isna(x) else x for x in (r.page_id, r.refers_to, r.url))
                    member = gzip.compress(make_record(page_id, url, r.html.encode(), digest, refers_to), 6, mtime=0)
                    out = out or system.open_output_stream(f"{base}/{name}", compression=None)
                    out.write(member)
                    found.append((url_key(url), page_id, url, name, at, len(member)))
                    at += len(member)
                yield pd.DataFrame(found, columns=[x.split()[0] for x in CAPTURES.split(", ")])
        finally:
            if out:
                out.close()

    return stage(todo.mapInPandas(write, CAPTURES), "captures")


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write the sorted, block-compressed index; returns one row per block (``BLOCKS``), staged."""
    order = ["key", "file", "offset"]

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = open_folder(folder)
        system.create_dir(base, recursive=True)
        name, at, out, lines, directory = f"{uuid.uuid4().hex}.cdx", 0, None, [], []

        def flush() -> None:
            nonlocal at, out, lines
            out = out or system.open_output_stream(f"{base}/{name}", compression=None)
            block = gzip.compress("\n".join(x for _, x in lines).encode(), 6, mtime=0)
            out.write(block)
            directory.append((lines[0][0], name, at, len(block), len(lines)))
            at, lines = at + len(block), []

        for b in batches:
            for r in b.itertuples(index=False):
                page_id, url = (None if pd.isna(x) else x for x in (r.page_id, r.url))
                body = json.dumps({"page": page_id, "url": url, "file": r.file, "offset": r.offset, "length": r.length})
                lines.append((r.key, f"{r.key} {body}"))
                if len(lines) == block_lines:
                    flush()
        if lines:
            flush()
        if out:
            footer = gzip.compress(json.dumps([[k, o, n] for k, _, o, n, _ in directory]).encode(), mtime=0)
            out.write(footer + struct.pack("<Q", len(footer)))
            out.close()
        yield pd.DataFrame(directory, columns=[x.split()[0] for x in BLOCKS.split(", ")])

    return stage(captures.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(write, BLOCKS), "blocks")


def read_blocks(blocks: DataFrame, folder: str) -> DataFrame:
    """All captures that the index blocks hold."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = open_folder(folder)
        for b in batches:
            for r in b.itertuples(index=False):
                with system.open_input_file(f"{base}/{r.index_file}") as f:
                    yield _captures(_block(f, r.offset, r.length))
    return blocks.mapInPandas(read, CAPTURES)


def _block(f, offset: int, length: int) -> list[str]:
    f.seek(offset)
    return gzip.decompress(f.read(length)).decode().split("\n")


def _captures(lines: list[str]) -> pd.DataFrame:
    found = []
    for key, _, body in (x.partition(" ") for x in lines):
        x = json.loads(body)
        found.append((key, x["page"], x["url"], x["file"], x["offset"], x["length"]))
    return pd.DataFrame(found, columns=[x.split()[0] for x in CAPTURES.split(", ")])


def read_records(captures: DataFrame, folder: str) -> DataFrame:
    """The records at the captures (``RECORDS``), in file order so that each file is read forward.

    Size and digest of a response are taken from the payload read back; those of a revisit from its headers.
    """
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = open_folder(folder)
        name, f = None, None
        for b in batches:
            found = []
            for r in b.itertuples(index=False):
                if r.file != name:
                    name, f = r.file, system.open_input_file(f"{base}/{r.file}")
                f.seek(r.offset)
                warc, http, payload = parse_record(gzip.decompress(f.read(r.length)))
                if warc["WARC-Type"] == "response":
                    size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                else:
                    size, digest = int(http["Content-Length"]), warc["WARC-Payload-Digest"][5:]
                refers_to = warc.get("X-Refers-To-Page-Id")
                found.append((r.page_id, size, digest, warc["WARC-Type"], refers_to and unquote(refers_to)))
            yield pd.DataFrame(found, columns=[x.split()[0] for x in RECORDS.split(", ")])

    order = ["file", "offset"]
    return captures.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(read, RECORDS)


def lookup(blocks: DataFrame, folder: str, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """The captures of each distinct url asked for. The driver gets one key per index file."""
    top = sorted(map(tuple, blocks.groupBy("index_file").agg(F.min("first_key").alias("k")).select("k", "index_file")
                     .collect()))
    keys = [k for k, _ in top]

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = open_folder(folder)
        directories: dict[str, list] = {}
        for b in batches:
            for key in map(url_key, b["url"]):
                for i in range(max(0, bisect.bisect_left(keys, key) - 1), bisect.bisect_right(keys, key)):
                    name = top[i][1]
                    with system.open_input_file(f"{base}/{name}") as f:
                        if name not in directories:
                            f.seek(f.size() - 8)
                            size = struct.unpack("<Q", f.read(8))[0]
                            f.seek(f.size() - 8 - size)
                            directories = {name: json.loads(gzip.decompress(f.read(size)))}
                        own = directories[name]
                        first = [x[0] for x in own]
                        for _, offset, length in own[max(0, bisect.bisect_left(first, key) - 1):
                                                     bisect.bisect_right(first, key)]:
                            hit = [x for x in _block(f, offset, length) if x.startswith(key + " ")]
                            if hit:
                                yield _captures(hit)

    return urls.select(F.col(url_col).alias("url")).distinct().mapInPandas(find, CAPTURES)


def archive_pages(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", min_bytes: int = MIN_BYTES) -> tuple[str, DataFrame]:
    """Write archives and index to a new shared folder; returns the folder and the index blocks."""
    folder = shared_folder(spark, "warc")
    return folder, write_index(write_archives(pages, folder, id_col, url_col, html_col, min_bytes), folder)
