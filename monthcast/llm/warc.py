"""WARC (operator 2): a deterministic sharded writer, and a reader.

Writer: records are dealt into ranges of their id (cut points from a
deterministic sample), sorted within each, and appended as gzip members of
their own to ``shard-<range>-<roll>.warc.gz``, rolled once a file reaches
``roll_bytes`` of compressed size. Headers and digests are regenerated from the
payload; dates, member headers and record ids depend on the rows alone, so the
same rows give the same bytes. Files are committed by rename; the manifest (a
Parquet table written last, atomically, by Spark) names each file with its
record count, size and SHA-256.

Of records with equal payloads (same SHA-1 and size) of ``min_dedup`` bytes at
least, that with the largest id is a response and the others are revisits of
it; smaller ones are all responses. Repeated rows of the largest id are all
responses. Null html is an empty payload; a null id is written with an empty
id header, is sorted first and read back as null, and is the response only
where no row of the group has an id. An empty table gives an empty manifest.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_key_back, range_bounds, range_index, written
from .files import committed, open_root

MANIFEST = "file string, records long, bytes long, sha256 string, first_id long, last_id long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_rows(pages: DataFrame, id_col: str, html_col: str, url_col: str) -> DataFrame:
    """(page_id, url, html bytes, payload_digest, payload_bytes)."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("html"), F.sha1(payload).alias("payload_digest"),
                        F.octet_length(payload).cast("long").alias("payload_bytes"))


def revisits(rows: DataFrame, min_dedup: int) -> DataFrame:
    """(page_id, payload_digest, refers_to) of the records that revisit
    another, from ids and digests alone."""
    keys = rows.where(F.col("payload_bytes") >= min_dedup).select("page_id", "payload_digest", "payload_bytes")
    groups = per_key_back(keys, ["payload_digest", "payload_bytes"],
                          {"top": F.max("page_id"), "n": F.count("*")}, {"top": F.max("top"), "n": F.sum("n")},
                          where=F.col("n") > 1, how="inner")
    older = groups.where(F.coalesce(F.col("page_id") < F.col("top"), F.col("top").isNotNull()))
    return older.groupBy("page_id", "payload_digest").agg(F.max("top").alias("refers_to"))


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def record_bytes(page_id: int | None, url: str | None, html: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record. The block of a revisit is the HTTP header alone,
    which still tells the payload's length."""
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n\r\n").encode()
    named = "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {' '.join((url or '').split())}", f"X-Page-Id: {'' if page_id is None else page_id}",
            f"WARC-Payload-Digest: {named}"]
    if refers_to is None:
        block += html
    else:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(refers_to, digest)}",
                 f"X-Refers-To-Page-Id: {refers_to}"]
    head += ["WARC-Block-Digest: sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode(),
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_warc(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               shard_bytes: int = 256 << 20, min_shards: int = 64, roll_bytes: int = 1 << 30, min_dedup: int = 1000) -> DataFrame:
    """Write the archives under ``root`` and return the manifest.

    Shards hold about ``shard_bytes`` of payload, but there are at least
    ``min_shards`` ranges so that small tables spread over the cluster too.
    """
    total = pages.agg(F.sum(F.octet_length(html_col))).first()[0] or 0
    bounds = range_bounds(pages, id_col, max(min_shards, total // shard_bytes + 1))
    rows = payload_rows(pages, id_col, html_col, url_col)
    # a mark stands before the records it makes revisits, so payloads are dealt once and joined to nothing
    marks = revisits(rows, min_dedup).withColumns({"mark": F.lit(0), "url": F.lit(None).cast("string"),
                                                   "html": F.lit(None).cast("binary")})
    both = rows.withColumns({"mark": F.lit(1), "refers_to": F.lit(None).cast("long")}).drop("payload_bytes").unionByName(marks)
    dealt = (both.withColumn("shard", range_index(F.col("page_id"), bounds))
             .select("shard", "page_id", "url", "html", "payload_digest", "mark", "refers_to")
             .repartition(len(bounds) + 1, "shard")
             .sortWithinPartitions("shard", "page_id", "payload_digest", "mark", "url"))

    def records(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict]]:
        mark = None
        for b in it:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                key = (r["page_id"], r["payload_digest"])
                if r["mark"] == 0:
                    mark = (key, r["refers_to"])
                else:
                    r["refers_to"] = mark[1] if mark and mark[0] == key else None
                    yield r["shard"], r

    def write(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = records(it)
        waiting = next(rows, None)
        while waiting is not None:
            shard, roll = waiting[0], 0
            while waiting is not None and waiting[0] == shard:
                name, digest, size, n = f"shard-{shard:06d}-{roll:05d}.warc.gz", hashlib.sha256(), 0, 0
                first = waiting[1]["page_id"]
                with committed(root, name) as out:
                    while waiting is not None and waiting[0] == shard and size < roll_bytes:
                        r = waiting[1]
                        member = gzip.compress(record_bytes(r["page_id"], r["url"], r["html"], r["payload_digest"],
                                                            r["refers_to"]), 6, mtime=0)
                        out.write(member)
                        digest.update(member)
                        size, n, last = size + len(member), n + 1, r["page_id"]
                        waiting = next(rows, None)
                roll += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], t) for x, t in ((name, pa.string()), (n, pa.int64()), (size, pa.int64()),
                                                   (digest.hexdigest(), pa.string()), (first, pa.int64()), (last, pa.int64()))],
                    names=["file", "records", "bytes", "sha256", "first_id", "last_id"])

    return written(dealt.mapInArrow(write, MANIFEST), "warc-manifest")


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a gzip-member archive, reading a
    block of compressed bytes at a time."""
    inflate, plain = zlib.decompressobj(31), bytearray()
    data = stream.read(1 << 20)
    while data:
        plain += inflate.decompress(data)
        if not inflate.eof:
            data = stream.read(1 << 20)
            continue
        head, _, rest = bytes(plain).partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        size = int(headers["Content-Length"])
        if len(rest) != size + 4:
            raise ValueError("a record's length doesn't match its header")
        yield headers, rest[:size]
        data, plain = inflate.unused_data or stream.read(1 << 20), bytearray()
        inflate = zlib.decompressobj(31)
    if plain:
        raise ValueError("an archive ends within a record")


def read_warc(manifest: DataFrame, root: str) -> DataFrame:
    """The records of the files that the manifest names, digests verified."""

    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = open_root(root)
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for name in (x for b in it for x in b.column(0).to_pylist()):
            rows: list[tuple] = []
            with fs.open_input_stream(f"{folder}/{name}", compression=None) as stream:
                for h, block in read_records(stream):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(http.rpartition(b"Content-Length: ")[2])
                    digest = base64.b32decode(h["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    if "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode() != h["WARC-Block-Digest"]:
                        raise ValueError(f"{name}: a block's digest doesn't match its header")
                    if h["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                        raise ValueError(f"{name}: a payload's digest doesn't match its header")
                    number = [int(h[k]) if h.get(k) else None for k in ("X-Page-Id", "X-Refers-To-Page-Id")]
                    rows.append((number[0], size, digest, h["WARC-Type"], number[1]))
                    if len(rows) >= 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    files = manifest.select("file")
    return files.repartition(max(1, files.count()), "file").mapInArrow(read, RECORDS)
