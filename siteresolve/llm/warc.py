"""WARC archives with a two-level capture index.

Writing: a record per page row, one gzip member each, in files of the shared folder. Pages with
equal payloads of at least ``least`` bytes are one response (smallest id) and revisits of it. Which
is which is decided on narrow rows (id, digest, length); the list of revisits, without payloads, is
then broadcast if its counted rows are few, else joined by id and digest. A record's block is an
HTTP response whose body is the payload; a revisit's is the HTTP header alone.

Index: one line per record - reversed-host URL key, page id, file, offset, length - sorted over all
files. Each range of the sorted keys is an index file of compressed blocks of ``BLOCK_LINES`` lines,
and at its end the file's sparse directory: each block's first and last key, offset and length. The
durable directory table has the same rows for all files.

Reading: ``lookup`` finds the captures of URLs. A key is searched among the index files' first and last keys,
then, in a task that goes through one file's keys in order, in that file's directory and in the
block it points at, by binary search each time. What is found is dealt by archive file and place, and
records that lie together are read in one range. ``warc_round_trip`` looks up every page's URL.

Null html is an empty payload, a null URL has the empty key, rows with equal ids are separate
records (those with the smallest id of a group are all responses; rows repeated whole have one record
id). Null ids are never the smallest of a group with others. Files have random names and count only
when listed in the durable tables, so repeated tasks do no harm.
"""

from __future__ import annotations

import bisect
import datetime
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, new_dir, open_fs, partitions, size_checked

BLOCK_LINES = 1024
FILE_BYTES = 256 << 20
PORTION = 1 << 14
RANGE_BYTES = 4 << 20
LEAST = 100


def url_key(url: Column) -> Column:
    """Reversed-host key: ``http://m.a.com:80/x?y#z`` is ``com,a,m)/x?y``; lower-cased host, no scheme, port, user or fragment."""
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://", ""), "#.*$", "")
    host = F.lower(F.regexp_replace(F.regexp_replace(F.regexp_extract(bare, "^[^/?]*", 0), "^.*@", ""), ":[0-9]*$", ""))
    rest = F.regexp_replace(bare, "^[^/?]*", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(rest == "", "/").otherwise(rest))


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>"


def _record(kind: str, page_id, url: str, payload: bytes, digest: str, first, date: str) -> bytes:
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", _record_id(page_id, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", re.sub(r"[\x00-\x20]", "", url or "") or "urn:none"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("X-Page-ID", "" if page_id is None else str(page_id)),
        ("X-Payload-Bytes", str(len(payload))),
    ]
    if kind == "revisit":
        fields += [("WARC-Refers-To", _record_id(first, digest)), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Refers-To-Page", str(first))]
    else:
        block += payload
    fields.append(("Content-Length", str(len(block))))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one compressed record; raises if length or digest don't hold."""
    raw = zlib.decompress(data, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]
    if fields["WARC-Type"] == "response" and fields["WARC-Payload-Digest"] != "sha256:" + hashlib.sha256(payload).hexdigest():
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload's digest does not hold")
    return fields, payload


def with_revisits(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, url, html, digest, first: the id of the response that a revisit refers to, else null."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.sha2(html.cast("binary"), 256).alias("digest"))
    narrow = durable(rows.filter(F.octet_length("html") >= least).select("page_id", "digest"), "page-digests")
    repeated = narrow.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("k")).filter("k > 1 and first is not null").select("digest", "first")
    listed = durable(narrow.join(durable(repeated, "repeated"), "digest").filter("page_id is null or page_id <> first").distinct(), "revisits")
    told = size_checked(listed.select(F.coalesce("page_id", F.lit(0)).alias("page_0"), F.col("page_id").isNull().alias("page_no"), "digest", "first"), 96)
    keyed = rows.withColumn("page_0", F.coalesce("page_id", F.lit(0))).withColumn("page_no", F.col("page_id").isNull())
    return keyed.join(told, ["page_0", "page_no", "digest"], "left").select("page_id", "url", "html", "digest", "first")


def write_archive(pages: DataFrame, out_dir: str, least: int = LEAST, level: int = 3) -> DataFrame:
    """Write WARC and index files under ``out_dir``; return the durable block directory: first_key, last_key, index, offset, length, n."""
    date = datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def warcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(out_dir)
        fs.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                places = []
                for page_id, url, html, digest, first in zip(*(c.to_pylist() for c in batch.columns[:5])):
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                    data = packer.compress(_record("response" if first is None else "revisit", page_id, url, html.encode(), digest, first, date)) + packer.flush()
                    out.write(data)
                    places.append((name, at, len(data)))
                    at += len(data)
                files, offsets, lengths = zip(*places) if places else ((), (), ())
                yield pa.RecordBatch.from_arrays([batch.column(5), batch.column(0), pa.array(files, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())], ["key", "page_id", "file", "at", "length"])
        finally:
            if out is not None:
                out.close()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(out_dir)
        out, name, at, lines = None, f"{uuid.uuid4().hex}.cdx.z", 0, []

        def block() -> dict:
            nonlocal at
            data = zlib.compress("\n".join(json.dumps(x) for x in lines).encode(), 6)
            out.write(data)
            row = {"first_key": lines[0][0], "last_key": lines[-1][0], "index": name, "offset": at, "length": len(data), "n": len(lines)}
            at += len(data)
            lines.clear()
            return row

        kind = pa.schema([("first_key", pa.string()), ("last_key", pa.string()), ("index", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("n", pa.int64())])
        rows = []
        try:
            for batch in batches:
                out = out or fs.open_output_stream(f"{root}/{name}", compression=None)
                for line in zip(*(c.to_pylist() for c in batch.columns)):
                    lines.append(line)
                    if len(lines) >= BLOCK_LINES:
                        rows.append(block())
            if lines:
                rows.append(block())
            if rows:
                data = zlib.compress(json.dumps([[r["first_key"], r["last_key"], r["offset"], r["length"]] for r in rows]).encode(), 6)
                out.write(data + struct.pack("<Q", len(data)))
        finally:
            if out is not None:
                out.close()
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=kind)

    captures = with_revisits(pages, least).withColumn("key", url_key(F.col("url"))).mapInArrow(warcs, "key string, page_id long, file string, at long, length long")
    lines = durable(captures, "captures")
    ordered = lines.repartitionByRange(partitions(pages.sparkSession), "key", "page_id").sortWithinPartitions("key", "page_id", "file", "at")
    return durable(ordered.mapInArrow(blocks, "first_key string, last_key string, index string, offset long, length long, n long"), "directory")


def _capture(fields: dict[str, str]) -> dict:
    def number(name: str):
        x = fields.get(name)
        return int(x) if x else None

    return {
        "page_id": number("X-Page-ID"),
        "payload_bytes": int(fields["X-Payload-Bytes"]),
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha256:"),
        "record_type": fields["WARC-Type"],
        "refers_to": number("X-Refers-To-Page"),
    }


_CAPTURE = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
_CAPTURE_ARROW = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


class Index:
    """One index file: its sparse directory, and the block read last."""

    def __init__(self, fs, path: str):
        self.file = fs.open_input_file(path)
        end = self.file.size() - 8
        size = struct.unpack("<Q", self.file.read_at(8, end))[0]
        self.blocks = json.loads(zlib.decompress(self.file.read_at(size, end - size)))
        self.lasts = [last for _, last, _, _ in self.blocks]
        self.at, self.lines, self.keys = -1, [], []

    def block(self, k: int) -> None:
        if k != self.at:
            raw = zlib.decompress(self.file.read_at(self.blocks[k][3], self.blocks[k][2]))
            self.at, self.lines = k, [json.loads(x) for x in raw.decode().split("\n")]
            self.keys = [x[0] for x in self.lines]

    def find(self, key: str) -> Iterator[list]:
        """The lines of a key, a block at a time."""
        k = bisect.bisect_left(self.lasts, key)
        while k < len(self.blocks) and self.blocks[k][0] <= key:
            self.block(k)
            yield from self.lines[bisect.bisect_left(self.keys, key) : bisect.bisect_right(self.keys, key)]
            k += 1


def located(directory: DataFrame, out_dir: str, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """key, file, at, length of the captures of each distinct key of ``urls``.

    The first and last keys of the index files (at most one file per shuffle partition) are the only thing that goes to all tasks.
    """
    n = partitions(directory.sparkSession)
    files = sorted((r["a"], r["b"], r["index"]) for r in directory.groupBy("index").agg(F.min("first_key").alias("a"), F.max("last_key").alias("b")).collect())
    firsts, lasts = [a for a, _, _ in files], [b for _, b, _ in files]

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = []
            for key in batch.column(0).to_pylist():
                # a key may run over from one file into the next ones
                for k in range(bisect.bisect_left(lasts, key), bisect.bisect_right(firsts, key)):
                    pairs.append((key, files[k][2]))
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string())], ["key", "index"])

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(out_dir)
        index, name = None, None

        def made(out: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*out)) or [(), (), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64(), pa.int64()))], ["key", "file", "at", "length"])

        # a URL may have any number of captures: they leave in portions, whatever key they are of
        for batch in batches:
            out: list[tuple] = []
            for key, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if wanted != name:
                    index, name = Index(fs, f"{root}/{wanted}"), wanted
                for line in index.find(key):
                    out.append((key, *line[2:]))
                    if len(out) >= PORTION:
                        yield made(out)
                        out = []
            yield made(out)

    keys = urls.select(url_key(F.col(url_col)).alias("key")).distinct()
    pairs = keys.mapInArrow(routed, "key string, index string")
    return pairs.repartition(n, "index").sortWithinPartitions("index", "key").mapInArrow(searched, "key string, file string, at long, length long")


def lookup(directory: DataFrame, out_dir: str, urls: DataFrame, url_col: str = "url", payloads: bool = True) -> DataFrame:
    """Captures of each URL of ``urls``: its key, the capture's columns and the stored payload (empty for revisits; null without ``payloads``)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(out_dir)
        file, name = None, None
        for batch in batches:
            wanted = list(zip(*(c.to_pylist() for c in batch.columns[:4])))
            k = 0
            while k < len(wanted):
                # records that lie one after the other, up to RANGE_BYTES, are one read
                end = k + 1
                while end < len(wanted) and wanted[end][1] == wanted[k][1] and wanted[end][2] == wanted[end - 1][2] + wanted[end - 1][3] and wanted[end][2] - wanted[k][2] < RANGE_BYTES:
                    end += 1
                if wanted[k][1] != name:
                    name = wanted[k][1]
                    file = fs.open_input_file(f"{root}/{name}")
                begin = wanted[k][2]
                data = file.read_at(wanted[end - 1][2] + wanted[end - 1][3] - begin, begin)
                rows = []
                for key, _, at, length in wanted[k:end]:
                    fields, payload = parsed(data[at - begin : at - begin + length])
                    rows.append({"key": key, **_capture(fields), "payload": payload if payloads else None})
                yield pa.RecordBatch.from_pylist(rows, schema=_CAPTURE_ARROW)
                k = end

    n = partitions(directory.sparkSession)
    places = located(directory, out_dir, urls, url_col).withColumn("range", F.floor(F.col("at") / RANGE_BYTES))
    return places.repartition(n, "file", "range").sortWithinPartitions("file", "at").select("key", "file", "at", "length").mapInArrow(read, f"key string, {_CAPTURE}, payload binary")


def warc_round_trip(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Write the archive of ``pages`` to the shared folder, then look up every page's URL and read its captures back."""
    out_dir = new_dir(pages.sparkSession, "warc")
    return lookup(write_archive(pages, out_dir, least), out_dir, pages, payloads=False).drop("key", "payload")


ORACLE = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM p
"""
