"""WARC archives with a two-level capture index: sorted key blocks, a sparse directory, binary search, range reads."""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import ship_package, stage_table, work_path

#: Captures in an index block at least; blocks grow beyond it so that the directory keeps its bound.
BLOCK_RECORDS = 512
#: Directory entries at most, besides one for each index task. The directory is what a lookup broadcasts.
DIRECTORY = 65_536
#: An archive file is closed beyond so many bytes.
FILE_BYTES = 1 << 30
#: Neighbouring records are read in one request of at most so many bytes.
READ_BYTES = 8 << 20
#: A lookup's blocks are read by at most so many ranges of block numbers.
RANGES = 64
_DATE = "2000-01-01T00:00:00Z"


def surt(url: Column) -> Column:
    """Sort-friendly key: the host's labels reversed, then path and query, e.g. com,example,www)/a?b."""
    pattern = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([\s\S]*)$"
    url = F.coalesce(url, F.lit(""))
    host = F.lower(F.regexp_extract(url, pattern, 1))
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.regexp_extract(url, pattern, 2))


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None) -> bytes:
    """One gzip member with a WARC/1.1 response, or a revisit with the full payload's headers only."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {_DATE}",
        "WARC-Target-URI: " + json.dumps(url)[1:-1],
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is None:
        block += payload
    else:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def parse(member: bytes) -> dict[str, object]:
    """A gzip member's record; checks lengths and, for responses, the payload against its digest."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record's length does not match its header")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError("a payload does not match its digest")
    name = lambda s: int(s) if (s := s.removeprefix("<urn:page:").rstrip(">")) else None
    return {"page_id": name(fields["WARC-Record-ID"]), "url": json.loads(f'"{fields["WARC-Target-URI"]}"'), "kind": kind, "size": size, "digest": digest, "refers_to": name(fields["WARC-Refers-To"]) if kind == "revisit" else None, "payload": payload if kind == "response" else None}


CAPTURES = "key string, key_id long, file string, start long, bytes long"


def _write_batches(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    """Each attempt of a task writes files of its own; only the files named in the rows of the attempt that counts are read."""
    fs, folder = _open(root)
    fs.create_dir(folder, recursive=True)
    out, name, at = None, "", 0
    try:
        for b in batches:
            cols: list[list] = [[] for _ in range(5)]
            for key, key_id, page_id, url, html, refers_to in zip(*(b.column(c).to_pylist() for c in ("key", "key_id", "page_id", "url", "html", "refers_to")), strict=True):
                if out is None or at > FILE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{folder}/{name}", compression=None)
                data = record(page_id, url or "", (html or "").encode(), refers_to)
                out.write(data)
                for c, v in zip(cols, (key, key_id, name, at, len(data)), strict=True):
                    c.append(v)
                at += len(data)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["key", "key_id", "file", "start", "bytes"])
    finally:
        if out is not None:
            out.close()


def _pack_block(rows: list[tuple]) -> tuple:
    first, last = rows[0], rows[-1]
    return first[0], first[1], last[0], last[1], len(rows), zlib.compress("\n".join(json.dumps(r) for r in rows).encode(), 6)


def _block_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    names = ["first_key", "first_id", "last_key", "last_id", "n", "data"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*map(_pack_block, [rows]), strict=True), kinds, strict=True)], names)

    rows: list[tuple] = []
    for b in batches:
        rows += zip(*(b.column(c).to_pylist() for c in ("key", "key_id", "file", "start", "bytes")), strict=True)
        while len(rows) >= size:
            yield batch(rows[:size])
            rows = rows[size:]
    if rows:
        yield batch(rows)


class Archive:
    """An archive's root, its index blocks (a table) and its directory (first keys, bounded)."""

    def __init__(self, root: str, blocks: DataFrame) -> None:
        self.root, self.blocks = root, blocks


def write_archive(pages: DataFrame) -> Archive:
    """Write a record per page and the index, in the shared folder.

    Of pages with equal payloads the one with the largest page_id is a response, the others revisit it; a row that
    repeats that page_id with the same payload is a response too, and so is a page where no page_id is known. The
    join that finds it is on the payload's digest and may be split where one is hot.
    """
    spark = pages.sparkSession
    ship_package(spark)
    root = work_path(spark, "warc")
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")).withColumn("digest", F.sha2("html", 256))
    owners = rows.groupBy("digest").agg(F.max("page_id").alias("owner"))
    refers = F.when(F.col("owner").isNull() | F.col("page_id").eqNullSafe(F.col("owner")), F.lit(None)).otherwise(F.col("owner"))
    typed = rows.join(owners, "digest").select(surt(F.col("url")).alias("key"), F.coalesce("page_id", F.lit(-(1 << 63))).alias("key_id"), "page_id", "url", "html", refers.cast("bigint").alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _write_batches(batches, root)

    captures = stage_table(typed.mapInArrow(run, CAPTURES), "captures")
    n = captures.count()
    size = max(BLOCK_RECORDS, -(-n // DIRECTORY))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _block_batches(batches, size)

    ordered = captures.repartitionByRange(max(1, min(2000, -(-n // (16 * size)))), "key", "key_id", "file", "start").sortWithinPartitions("key", "key_id", "file", "start")
    blocks = ordered.mapInArrow(pack, "first_key string, first_id long, last_key string, last_id long, n long, data binary")
    return Archive(root, stage_table(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks"))


def _find_batches(batches: Iterator[pa.RecordBatch], directory: list[tuple[str, int, str, int, int]]) -> Iterator[pa.RecordBatch]:
    firsts = [(d[0], d[1]) for d in directory]
    for b in batches:
        keys, ids, blocks = [], [], []
        for key, key_id in zip(b.column("key").to_pylist(), b.column("key_id").to_pylist(), strict=True):
            # the last block that begins at or before the key, and earlier ones that may still hold equal keys
            k = bisect_right(firsts, (key, key_id)) - 1
            while k >= 0 and (directory[k][2], directory[k][3]) >= (key, key_id):
                keys.append(key)
                ids.append(key_id)
                blocks.append(directory[k][4])
                k -= 1
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(ids, pa.int64()), pa.array(blocks, pa.int64())], ["key", "key_id", "block"])


def _search(keys: pa.Table, blocks: pa.Table) -> pa.Table:
    out: list[tuple] = []
    for data in blocks.column("data").to_pylist():
        rows = [json.loads(x) for x in zlib.decompress(data).decode().split("\n")]
        order = [(r[0], r[1]) for r in rows]
        for key in zip(keys.column("key").to_pylist(), keys.column("key_id").to_pylist(), strict=True):
            k = bisect_left(order, key)
            while k < len(order) and order[k] == key:
                out.append((rows[k][2], rows[k][3], rows[k][4]))
                k += 1
    cols = list(zip(*out, strict=True)) or [[], [], []]
    return pa.table({"file": pa.array(cols[0], pa.string()), "start": pa.array(cols[1], pa.int64()), "bytes": pa.array(cols[2], pa.int64())})


def _block_ranges(blocks: list[int], most: int = RANGES) -> list[tuple[int, int]]:
    """Block numbers as at most so many inclusive ranges; the nearest are joined first."""
    blocks = sorted(blocks)
    gaps = sorted(range(1, len(blocks)), key=lambda i: blocks[i] - blocks[i - 1], reverse=True)
    cuts = sorted(i for i in gaps[: most - 1] if blocks[i] - blocks[i - 1] > 1)
    return [(blocks[i], blocks[j - 1]) for i, j in zip([0, *cuts], [*cuts, len(blocks)], strict=True)] if blocks else []


def lookup(archive: Archive, keys: DataFrame) -> DataFrame:
    """Distinct (key, key_id) -> (file, start, bytes) of the captures with these keys.

    The directory says which blocks can hold a key; only those are read (a filter on ranges of their numbers reaches the
    scan, as the blocks' files are in order) and only those are shuffled.
    """
    spark = keys.sparkSession
    top = archive.blocks.select("first_key", "first_id", "last_key", "last_id", "block").orderBy("first_key", "first_id", "last_key", "last_id").collect()
    shared = spark.sparkContext.broadcast([tuple(r) for r in top])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _find_batches(batches, shared.value)

    sought = stage_table(keys.select("key", "key_id").distinct().mapInArrow(run, "key string, key_id long, block long"), "sought")
    hit = sought.select("block").distinct()
    # at most as many as the directory has entries
    ranges = _block_ranges([r["block"] for r in hit.collect()])
    within = reduce(lambda a, b: a | b, [F.col("block").between(lo, hi) for lo, hi in ranges], F.lit(False))
    wanted = archive.blocks.where(within).select("block", "data").join(hit, "block", "left_semi")
    return sought.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(_search, "file string, start long, bytes long")


RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"


def _read_batches(batches: Iterator[pa.RecordBatch], root: str, keep: bool) -> Iterator[pa.RecordBatch]:
    """Records in the order of their places; no more than READ_BYTES of payloads (or one record) are held at once."""
    fs, folder = _open(root)
    cols = [("page_id", pa.int64()), ("url", pa.string()), ("kind", pa.string()), ("size", pa.int64()), ("digest", pa.string()), ("refers_to", pa.int64()), *([("payload", pa.binary())] * keep)]
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", *(["payload"] * keep)]

    def batch(got: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([g[c] for g in got], t) for c, t in cols], names)

    for b in batches:
        wanted = sorted(zip(b.column("file").to_pylist(), b.column("start").to_pylist(), b.column("bytes").to_pylist(), strict=True))
        got: list[dict] = []
        held = 0
        k = 0
        while k < len(wanted):
            name, first, _ = wanted[k]
            with fs.open_input_file(f"{folder}/{name}") as f:
                while k < len(wanted) and wanted[k][0] == name:
                    first, to, end = wanted[k][1], k, wanted[k][1]
                    while to < len(wanted) and wanted[to][0] == name and wanted[to][1] <= end + 4096 and wanted[to][1] + wanted[to][2] - first <= max(READ_BYTES, wanted[k][2]):
                        end = max(end, wanted[to][1] + wanted[to][2])
                        to += 1
                    data = f.read_at(end - first, first)
                    for _, s, n in wanted[k:to]:
                        one = parse(data[s - first : s - first + n])
                        if not keep:
                            del one["payload"]
                        elif one["payload"] is not None:
                            held += len(one["payload"])
                        got.append(one)
                        if held > READ_BYTES:
                            yield batch(got)
                            got, held = [], 0
                    k = to
        yield batch(got)


def read_records(archive: Archive, located: DataFrame, keep_payload: bool = False) -> DataFrame:
    """Range reads of located records, dealt so that each task reads forward through few files."""

    root = archive.root

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _read_batches(batches, root, keep_payload)

    return located.repartitionByRange("file", "start").sortWithinPartitions("file", "start").mapInArrow(run, RECORDS + (", payload binary" if keep_payload else ""))


def page_keys(pages: DataFrame) -> DataFrame:
    return pages.select(surt(F.col("url").cast("string")).alias("key"), F.coalesce(F.col("page_id").cast("bigint"), F.lit(-(1 << 63))).alias("key_id"))


def op1_warc(pages: DataFrame) -> DataFrame:
    """Write the archive, look every page up through the index, and return what the records read back say.

    Null html is an empty payload, a null url an empty one; extra columns are ignored; an empty table gives no rows.
    """
    archive = write_archive(pages)
    back = read_records(archive, lookup(archive, page_keys(pages)))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS owner FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 8), lambda i: array_to_string(list_transform(range(0, 4), lambda j:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(h, CAST(5 * i + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * j AS BIGINT)) & 31 AS BIGINT) + 1, 1)), '')), '') AS payload_digest,
  CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = owner THEN NULL ELSE owner END AS refers_to
FROM d
"""


def open_archive(spark: SparkSession, root: str, blocks_path: str) -> Archive:
    """An archive written before."""
    return Archive(root, spark.read.parquet(blocks_path))
