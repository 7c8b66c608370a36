"""SimHash near-duplicates: exact linking of fingerprints within a Hamming radius through one-wildcard segments."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import connected_components
from ledgerloom.session import ship_package, stage_table

#: Lower-cases A-Z only.
ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SHINGLE = 4
SEED = 42
RADIUS = 4
#: (first bit, bits): RADIUS differing bits over three segments leave one with at most one.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Buckets with more fingerprints are compared in tiles of this many.
TILE = 1024
PROBE = 16
PER_TASK = 50_000
#: Index entries of a fingerprint, and those that Spark may broadcast. It sizes an explode by its input, which says 67 times too
#: little, so a larger index is kept off the driver by a hint.
ENTRIES = sum(bits + 1 for _, bits in SEGMENTS)
MOST_BROADCAST = 65_536


def fingerprint(text: str | None, width: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of the shingles' XXH64; a bit is set if it is set in over half the hashes."""
    words = (text or "").encode().translate(ASCII_LOWER).split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n < width:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = np.concatenate((np.zeros(1, np.int64), ends[:-1]))[: n - width + 1].tolist()
    stops = (ends[width - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    votes, total = np.zeros(64, np.int64), len(starts)
    for i in range(0, total, 65536):
        part = np.array([digest(joined[a:b], seed) for a, b in zip(starts[i : i + 65536], stops[i : i + 65536], strict=True)], ">u8")
        votes += np.unpackbits(part.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > total).view(">u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps = np.array([fingerprint(t.as_py()) for t in b.column("text")], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_key"), pa.array(fps, pa.int64())], ["doc_id", "text_key", "fp"])


def text_key(text: F.Column) -> F.Column:
    """64 bits that tell the texts of one doc_id apart; a null text has its own."""
    return F.xxhash64(text.isNull(), text)


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, fp bigint), one row per input row."""
    ship_package(docs.sparkSession)
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("bigint"), text_key(text).alias("text_key"), text.alias("text")).mapInArrow(_fingerprints, "doc_id long, text_key long, fp long")


def _segment(k: int) -> F.Column:
    first, bits = SEGMENTS[k]
    return F.shiftright(F.col("fp"), first).bitwiseAND(F.lit((1 << bits) - 1))


def _variants(fps: DataFrame) -> DataFrame:
    """One row per index entry (fp, key, side): key holds slot * 2**22 + the segment's other bits, in 30 bits.

    A slot names the segment and its wildcard bit (slot % 64 = 0: none); side is the wildcard bit's value.
    """
    entries = []
    for k, (_, bits) in enumerate(SEGMENTS):
        seg = _segment(k)
        entries.append(F.struct((seg + F.lit((k * 64) << 22)).cast("int").alias("key"), F.lit(0).cast("byte").alias("side")))
        for j in range(bits):
            rest = seg.bitwiseAND(F.lit(((1 << bits) - 1) ^ (1 << j)))
            entries.append(F.struct((rest + F.lit((k * 64 + 1 + j) << 22)).cast("int").alias("key"), F.shiftright(seg, j).bitwiseAND(F.lit(1)).cast("byte").alias("side")))
    return fps.select("fp", F.explode(F.array(*entries)).alias("e")).select("fp", "e.key", "e.side")


def _forest(nodes: np.ndarray, sides: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the link graph among nodes (sides: only links across the two sides)."""
    root = np.arange(len(nodes))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for i in range(len(nodes) - 1):
        near = np.bitwise_count(nodes[i + 1 :] ^ nodes[i]) <= radius
        if sides is not None:
            near &= sides[i + 1 :] != sides[i]
        for j in np.flatnonzero(near) + i + 1:
            a, b = find(i), find(int(j))
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((int(nodes[i].view(np.int64)), int(nodes[j].view(np.int64))))
    return out


def _tile_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        u, v = [], []
        for key, fps, sides in zip(b.column("key").to_pylist(), b.column("fps"), b.column("sides"), strict=True):
            nodes = fps.values.to_numpy(zero_copy_only=False).view(np.uint64)
            for x, y in _forest(nodes, sides.values.to_numpy(zero_copy_only=False) if (key >> 22) % 64 else None, RADIUS):
                u.append(x)
                v.append(y)
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def fingerprint_links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Distinct fingerprints (fp) -> edges (u, v) whose components are those of all pairs within the radius.

    An equality join on the key meets the two values of a wildcard bit, or equal segments, so a pair meets once in
    each segment that differs by at most one bit; the join itself keeps it only in the first such segment and only if
    the whole fingerprints are near. Hot keys (found on one fingerprint in PROBE; either way is exact, so a wrong
    guess costs time only) go another way: members are dealt to blocks of about TILE, and each pair of blocks yields a
    spanning forest of its links, at most as many rows as members, so near copies by the thousand never become all
    their pairs.
    """
    if radius != RADIUS:
        raise ValueError("the segments are made for a radius of 4")
    # each fingerprint becomes 67 index rows, so small inputs per task
    n = fps.count()
    fps = fps.repartition(max(1, -(-n // PER_TASK)), "fp")
    variants = _variants(fps)
    plain = (F.shiftright("key", 22) % 64) == 0
    probe = _variants(fps.where(F.pmod(F.xxhash64("fp"), F.lit(PROBE)) == 0))
    hot = stage_table(probe.groupBy("key").agg((F.count("*") * PROBE).alias("n")).where(F.col("n") > TILE), "hot")
    any_hot = not hot.isEmpty()
    small = variants.join(hot.select("key"), "key", "left_anti") if any_hot else variants
    a = small.where("side = 0").select("key", F.col("fp").alias("u"))
    b = small.where(plain | (F.col("side") == 1)).select("key", F.col("fp").alias("v"))
    if n * ENTRIES > MOST_BROADCAST:
        b = b.hint("merge")
    x = F.col("u").bitwiseXOR(F.col("v"))
    earlier = F.lit(False)
    first = F.lit(False)
    for k, (lo, bits) in enumerate(SEGMENTS):
        here = F.bit_count(F.shiftright(x, lo).bitwiseAND(F.lit((1 << bits) - 1))) <= 1
        first = first | ((F.shiftright(a["key"], 28) == k) & ~earlier)
        earlier = earlier | here
    order = ((F.shiftright(a["key"], 22) % 64) != 0) | (F.col("u") < F.col("v"))
    joined = a.join(b, (a["key"] == b["key"]) & order & first & (F.bit_count(x) <= radius)).select("u", "v")
    if not any_hot:
        return joined
    blocks = F.ceil(F.col("n") / TILE).cast("int")
    block = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    tiles = (
        variants.join(hot, "key")
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("fp", "key", "side", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
        .groupBy("key", "i", "j")
        .agg(F.collect_list("fp").alias("fps"), F.collect_list("side").alias("sides"))
        .select("key", "fps", "sides")
    )
    ship_package(fps.sparkSession)
    return joined.unionAll(tiles.mapInArrow(_tile_links, "u long, v long"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id, text_key, root): component_id is the smallest doc_id reachable over links of at most
    RADIUS bits, root the component's own name, which also tells components without an id or with the same id apart.

    Null texts count as empty; a text without words has fingerprint zero and links like any other. Repeated rows
    keep their own result rows; a null doc_id takes part but is never a component's id unless all its ids are null.
    Other columns are ignored. Texts are read once: fingerprints are staged in the shared folder.
    """
    rows = stage_table(with_fingerprints(docs), "fingerprints")
    classes = stage_table(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "classes")
    comps = connected_components(fingerprint_links(classes.select("fp")))
    roots = classes.join(comps, classes["fp"] == comps["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    roots = stage_table(roots, "roots")
    lows = roots.groupBy("root").agg(F.min("low").alias("component_id"))
    named = roots.join(lows, "root").select("fp", "component_id", "root")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id", "text_key", "root")


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that stay: one of each component.

    It is the row with the smallest doc_id (null only where all are), of several texts with that id one; of rows that
    repeat both id and text one stays, any where their other columns differ. Rows are named by doc_id wherever all
    rows of an id go, and by doc_id and text_key where an id is null or has other rows that stay. What goes is stored
    before it is joined: it is far less than what stays, so Spark, which knows its size, can mostly spare the texts a
    shuffle. Null and empty texts have the same fingerprint, so one of all of them stays.
    """
    found = stage_table(near_duplicates(docs).select("doc_id", "text_key", "root"), "found")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")).alias("k")
    stay = found.groupBy("root").agg(first).select(F.col("k.doc_id").alias("id"), F.col("k.text_key").alias("key"), F.lit(True).alias("stays"))
    rows = found.groupBy("doc_id", "text_key").agg(F.count("*").alias("n"))
    judged = rows.join(stay, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key")), "left")
    judged = stage_table(judged.select("doc_id", "text_key", "n", F.coalesce("stays", F.lit(False)).alias("stays")), "judged")
    ids = judged.where("doc_id is not null").groupBy("doc_id").agg(F.max("stays").alias("any"))
    ids = stage_table(ids.where("not any").select("doc_id"), "dropped")
    some = stage_table(judged.where("not stays").join(ids, "doc_id", "left_anti").select("doc_id", "text_key"), "dropped-texts")
    repeats = stage_table(judged.where("stays and n > 1").select("doc_id", "text_key"), "repeats")

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key(F.col("text").cast("string")).alias("text_key"), row)

    def same(left: DataFrame, right: DataFrame) -> F.Column:
        return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_key"] == right["text_key"])

    kept = keyed.join(ids, "doc_id", "left_anti")
    if not some.isEmpty():
        kept = kept.join(some, same(kept, some), "left_anti")
    if not repeats.isEmpty():
        once = kept.join(repeats, same(kept, repeats), "left_semi").dropDuplicates(["doc_id", "text_key"])
        kept = kept.join(repeats, same(kept, repeats), "left_anti").unionAll(once)
    return kept.select("row.*")


def op4_simhash(docs: DataFrame) -> DataFrame:
    """The digest columns: doc_id, fingerprint (16 hex digits), component_id."""
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
