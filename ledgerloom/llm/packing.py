"""Packing documents into fixed-length training sequences by the sum-of-squares rule."""

from __future__ import annotations

import base64
import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import ship_package, stage_table

LENGTH = 1024
#: Appended to each document.
END_ID = 2
#: Pieces that one packing task takes; each task leaves a few sequences that are not full.
PIECES_PER_TASK = 1 << 17

_LETTERS = "A-Za-zÀ-ÖØ-öø-ſ"
#: The vocabulary's splitter for texts of only these characters, whose classes are beyond doubt.
_PLAIN = re.compile(rf"[\t-\r\x20-~{_LETTERS}¡£§©«®°·»¿×÷‘’“”–—…€]*")
_PIECE = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s0-9{_LETTERS}]+|\s+(?!\S)|\s+")


class Encoder(dict):
    """Ids of byte_bpe_50k as little-endian uint32 bytes.

    A text is first cut at the vocabulary's added tokens, each of which is one id. Plain parts are split as the
    vocabulary's own splitter does, and the ids of each piece are remembered (in two generations of bounded size);
    other parts are encoded whole.
    """

    def __init__(self, ranks_path: str | None = None, remember: int = 120_000) -> None:
        import public_tokenizers
        import tiktoken

        super().__init__()
        path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        encoding = tiktoken.Encoding("bytes50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._whole, self._single = encoding.encode_ordinary, encoding._encode_single_piece
        self._old: dict[str, bytes] = {}
        self._most = remember
        with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
            added = json.load(f)["added_tokens"]
        if odd := [a["content"] for a in added if a["single_word"] or a["lstrip"] or a["rstrip"]]:
            raise ValueError(f"added tokens that take more than their own text: {odd}")
        self._added = {a["content"]: array("I", [a["id"]]).tobytes() for a in added}
        self._cut = re.compile("(" + "|".join(re.escape(a) for a in self._added) + ")") if added else None

    def __missing__(self, piece: str) -> bytes:
        got = self._old.get(piece)
        if got is None:
            got = array("I", self._single(piece)).tobytes()
        if len(piece) <= 32:
            self[piece] = got
        return got

    def __call__(self, text: str) -> bytes:
        if self._cut and self._cut.search(text):
            return b"".join(self._added.get(part) or self._ordinary(part) for part in self._cut.split(text))
        return self._ordinary(text)

    def _ordinary(self, text: str) -> bytes:
        if not _PLAIN.fullmatch(text):
            return np.array(self._whole(text), "<u4").tobytes()
        out = b"".join(map(self.__getitem__, _PIECE.findall(text)))
        if len(self) > self._most:
            self._old = dict(self)
            self.clear()
        return out


_ENCODERS: dict[str | None, Encoder] = {}


def _encoder(path: str | None) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cut(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: only the first may be shorter."""
    first = n % length or min(n, length)
    return [(0, first)] + [(s, length) for s in range(first, n, length)]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, row_key long"


def _piece_batches(batches: Iterator[pa.RecordBatch], path: str | None) -> Iterator[pa.RecordBatch]:
    encode, end = _encoder(path), np.array([END_ID], "<u4").tobytes()
    for b in batches:
        cols: list[list] = [[] for _ in range(6)]
        for doc, text, key in zip(b.column("doc_id").to_pylist(), b.column("text"), b.column("row_key").to_pylist(), strict=True):
            ids = encode(text.as_py() or "") + end
            for k, (start, n) in enumerate(cut(len(ids) // 4)):
                for c, v in zip(cols, (doc, k, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)]), key), strict=True):
                    c.append(v)
        kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32", "row_key"])


def sum_of_squares(sizes: list[int], length: int = LENGTH) -> list[tuple[int, int]]:
    """(bin, offset) for each size in turn: it goes where the sum of squared counts of open bins per gap gets smallest.

    Placing size s into an open bin of gap g changes that sum by 2 * (N[g - s] - N[g]) + 2 (a bin that becomes full is
    no longer counted: 1 - 2 * N[g]); on ties the smallest gap wins. A new bin is opened only where none fits: with
    sizes from large to small, as pack() gives them, that needs fewer bins than also weighing a new one.
    """
    counts = np.zeros(length + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(length + 1)]
    used: list[int] = []
    out = []
    for s in sizes:
        gap = -1
        if s < length:
            there = counts[s:length]
            cost = 2 * (counts[: length - s] - there) + 2
            cost[0] = 1 - 2 * there[0]
            cost[there == 0] = 1 << 60
            k = int(cost.argmin())
            if there[k]:
                gap = s + k
        if gap < 0:
            b, at = len(used), 0
            used.append(s)
        else:
            b = open_bins[gap].pop()
            counts[gap] -= 1
            at = used[b]
            used[b] += s
        left = length - used[b]
        if left:
            open_bins[left].append(b)
            counts[left] += 1
        out.append((b, at))
    return out


def _pack_group(table: pa.Table) -> pa.Table:
    table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("row_key", "ascending")])
    placed = np.array(sum_of_squares(table.column("length").to_pylist()), np.int64).reshape(-1, 2)
    group = np.array(table.column("bucket").to_numpy(), np.int64)
    return table.select(["doc_id", "piece", "start", "length", "ids_crc32"]).append_column("sequence_id", pa.array((group << 32) + placed[:, 0])).append_column("offset", pa.array(placed[:, 1]))


def pack(docs: DataFrame, pieces_per_task: int = PIECES_PER_TASK, ranks_path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and END_ID; one longer than LENGTH is cut into pieces, the first of which may be shorter.
    Full pieces are a sequence of their own; the others are dealt by hash to tasks of about pieces_per_task pieces
    (their number grows with the input, their size does not) and packed there from large to small. Null texts are
    empty (one piece of END_ID), repeated rows are packed like any other, an empty table gives no rows. The pieces are
    staged in the shared folder, so ids are made once; no text is shuffled.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _piece_batches(batches, ranks_path)

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.monotonically_increasing_id().alias("row_key"))
    pieces = stage_table(rows.mapInArrow(run, PIECES), "pieces")
    full = pieces.where(F.col("length") == LENGTH)
    # the sign bit keeps these apart from the packed sequences; row_key and piece name a piece even where rows repeat
    alone = full.select("doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.where(F.col("length") < LENGTH)
    tasks = max(1, -(-rest.count() // pieces_per_task))
    dealt = rest.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "row_key"), F.lit(tasks)))
    packed = dealt.groupBy("bucket").applyInArrow(_pack_group, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return alone.unionAll(packed)


def op6_packing(docs: DataFrame) -> DataFrame:
    """The contract's columns are those of pack()."""
    return pack(docs)
