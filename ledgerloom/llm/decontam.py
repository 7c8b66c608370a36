"""Benchmark decontamination by winnowing: equal fingerprints of documents and items are joined, then extended word by word."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import ship_package, stage_table

#: Words in a window that counts as contamination.
WINDOW = 13
#: Words in a fingerprinted k-gram; a window of 13 words holds 9 of them, so any shared one shares their minimum.
KGRAM = 5
#: A document is contaminated if at least one word in so many is hit.
SHARE = 20
#: Rows that a task hands on at once where one text makes many.
_CHUNK = 20_000

_R = 0x9E3779B97F4A7C15 | 1
_R_INV = pow(_R, -1, 1 << 64)
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POW, _POW_INV = _powers(_R, _STEP + 1), _powers(_R_INV, _STEP + 1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased UTF-8 bytes -> starts, ends and 64-bit hashes of its words, without a Python loop over words."""
    edge = np.diff(np.concatenate(([0], _WORD[data].view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    hashes = np.zeros(len(starts), np.uint64)
    at = 0
    while at < len(starts):  # in stretches, as powers are tabled for _STEP bytes
        first = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, first + _STEP, "right")))
        if to == at + 1 and ends[at] - first > _STEP:  # one huge word
            hashes[at] = np.frombuffer(hashlib.sha256(data[first : ends[at]].tobytes()).digest()[:8], np.uint64)[0]
        else:
            part = data[first : ends[to - 1]].astype(np.uint64) + np.uint64(1)
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(part * _POW[: len(part)], dtype=np.uint64)))
            a, b = starts[at:to] - first, ends[at:to] - first
            hashes[at:to] = _mix((sums[b] - sums[a]) * _POW_INV[a] + (b - a).astype(np.uint64))
        at = to
    return starts, ends, hashes


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(_R) + words[j : j + n]
    return _mix(out)


def winnow(h: np.ndarray, w: int) -> np.ndarray:
    """The minimum of each window of w consecutive hashes."""
    if len(h) < w:
        return np.zeros(0, np.uint64)
    out = h[: len(h) - w + 1].copy()
    for j in range(1, w):
        np.minimum(out, h[j : len(h) - w + 1 + j], out=out)
    return out


def window_prints(words: np.ndarray, n: int) -> np.ndarray:
    """The fingerprint of each window of n words: the least hash of its k-grams, mixed with n. Equal windows have equal
    ones, wherever they stand, and neighbouring windows mostly share theirs."""
    k = min(KGRAM, n)
    return _mix(winnow(gram_hashes(words, k), n - k + 1) ^ np.uint64(n * 0x9E3779B97F4A7C15 & (1 << 64) - 1))


def _words(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data = _LOWER[np.frombuffer((text or "").encode(), np.uint8)]
    return data, *word_hashes(data)


def _keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray, n: int) -> Iterator[str]:
    """The windows' words, joined by a space."""
    words: dict[int, bytes] = {}
    for i in at.tolist():
        for k in range(i, i + n):
            if k not in words:
                words[k] = data[starts[k] : ends[k]].tobytes()
        yield b" ".join(words[k] for k in range(i, i + n)).decode()
        words = {k: w for k, w in words.items() if k > i} if len(words) > 1000 else words


def _window_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items -> (item_id, n, print, window), each window of an item once."""
    names, kinds = ["item_id", "n", "print", "window"], [pa.string(), pa.int32(), pa.int64(), pa.string()]
    rows: list[tuple] = []
    for b in batches:
        for item, text in zip(b.column("item_id").to_pylist(), b.column("text"), strict=True):
            data, starts, ends, h = _words(text.as_py())
            n = min(WINDOW, len(h))
            if not n:
                continue
            prints = window_prints(h, n).view(np.int64).tolist()
            for p, key in zip(prints, _keys(data, starts, ends, np.arange(len(prints)), n), strict=True):
                rows.append((item, n, p, key))
                if len(rows) >= _CHUNK:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                    rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def benchmark_windows(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """windows (n, print, window, class) and members (class, item_id, size), both stored; nothing of them is on the driver.

    windows has each distinct window of the benchmark once; n is WINDOW, or the number of words of an item that has
    fewer. Windows that the same items hold are of one class, so a passage of many items (a prompt's opening) names
    them once, not once a window. Classes are told apart by the number of items and two 64-bit sums of their hashes.
    """
    texts = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    held = stage_table(texts.mapInArrow(_window_batches, "item_id string, n int, print long, window string").distinct(), "item-windows")
    sums = [F.sum(F.xxhash64(F.lit(k), F.col("item_id").isNull(), "item_id").cast("decimal(20,0)")).alias(f"s{k}") for k in (1, 2)]
    signed = held.groupBy("n", "print", "window").agg(F.count("*").alias("size"), *sums)
    first = signed.groupBy("size", "s1", "s2").agg(F.min("window").alias("first_window"))
    classes = stage_table(first.withColumn("class", F.monotonically_increasing_id()), "classes")
    windows = stage_table(signed.join(classes, ["size", "s1", "s2"]).select("n", "print", "window", "class"), "windows")
    members = held.join(classes, F.col("window") == F.col("first_window")).select("class", "item_id", "size")
    return windows, stage_table(members, "members")


def _print_batches(batches: Iterator[pa.RecordBatch], sizes: list[int]) -> Iterator[pa.RecordBatch]:
    """Adds n_words and the distinct fingerprints of each text's windows, for each number of words that items call for."""
    for b in (whole.slice(a, 1000) for whole in batches for a in range(0, whole.num_rows, 1000)):
        n_words, prints, upto = [], [], [0]
        for t in b.column("text"):
            _, _, _, h = _words(t.as_py())
            found = np.unique(np.concatenate([window_prints(h, n) for n in sizes])) if sizes and len(h) else np.zeros(0, np.uint64)
            n_words.append(len(h))
            prints.append(found.view(np.int64))
            upto.append(upto[-1] + len(found))
        flat = pa.array(np.concatenate(prints) if prints else [], pa.int64())
        yield b.append_column("n_words", pa.array(n_words, pa.int64())).append_column("prints", pa.ListArray.from_arrays(pa.array(upto, pa.int32()), flat))


def _place_batches(batches: Iterator[pa.RecordBatch], sizes: list[int]) -> Iterator[pa.RecordBatch]:
    """Texts with the fingerprints they share -> (row_key, n, window, places) of their windows with such a fingerprint."""
    names, kinds = ["row_key", "n", "window", "places"], [pa.int64(), pa.int32(), pa.string(), pa.list_(pa.int32())]
    for b in batches:
        for row, text, shared in zip(b.column("row_key").to_pylist(), b.column("text"), b.column("shared"), strict=True):
            data, starts, ends, h = _words(text.as_py())
            known = np.array(shared.values.to_numpy(zero_copy_only=False), np.int64)
            for n in sizes:
                at = np.flatnonzero(np.isin(window_prints(h, n).view(np.int64), known))
                places: dict[str, list[int]] = {}
                for i, key in zip(at.tolist(), _keys(data, starts, ends, at, n), strict=True):
                    places.setdefault(key, []).append(i)
                found = list(places.items())
                for a in range(0, len(found), _CHUNK):
                    part = found[a : a + _CHUNK]
                    cols = [[row] * len(part), [n] * len(part), [k for k, _ in part], [v for _, v in part]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)


def _span_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows found per row -> the union of their words as flat [start, end) pairs."""
    for b in batches:
        spans = []
        for found in b.column("found"):
            starts = np.concatenate([np.array(x["places"].values.to_numpy(zero_copy_only=False), np.int64) for x in found])
            ends = starts + np.concatenate([np.full(len(x["places"]), x["n"].as_py(), np.int64) for x in found])
            order = np.argsort(starts, kind="stable")
            starts, ends = starts[order], np.maximum.accumulate(ends[order])
            new = np.concatenate(([True], starts[1:] > ends[:-1]))
            last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(starts) - 1]))
            spans.append(np.stack([starts[new], ends[last]], 1).ravel().tolist())
        yield pa.RecordBatch.from_arrays([b.column("row_key"), pa.array(spans, pa.list_(pa.int64())), b.column("classes")], ["row_key", "hit_spans", "classes"])


def _marked(docs: DataFrame, carry: list[str], sizes: list[int]) -> DataFrame:
    """docs stored once as (row_key, text, c0, c1 and so on for the carried columns, n_words, prints)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _print_batches(batches, sizes)

    rows = docs.select(F.monotonically_increasing_id().alias("row_key"), F.col("text").cast("string"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)])
    return stage_table(rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("prints", T.ArrayType(T.LongType()))])), "prints")


def _hits(marked: DataFrame, windows: DataFrame, sizes: list[int]) -> DataFrame:
    """(row_key, hit_spans, classes) of the rows that hold a window of the benchmark; classes are sorted.

    Fingerprints are joined on equality, each of a row with at most one of the benchmark. Only rows that share one are
    read again; their windows with a shared fingerprint are joined on their words with the benchmark's distinct
    windows. What a join takes is stored first, so that Spark knows its size and broadcasts it only where it is small.
    """

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _place_batches(batches, sizes)

    known = stage_table(windows.select("print").distinct(), "benchmark-prints")
    met = marked.select("row_key", F.explode("prints").alias("print")).join(known, "print").groupBy("row_key").agg(F.collect_list("print").alias("shared"))
    shared = stage_table(met, "shared")
    places = marked.select("row_key", "text").join(shared, "row_key").mapInArrow(place, "row_key long, n int, window string, places array<int>")
    found = places.join(windows.select("window", "class"), "window")
    each = found.groupBy("row_key").agg(F.collect_list(F.struct("n", "places")).alias("found"), F.array_sort(F.collect_set("class")).alias("classes"))
    return stage_table(each.mapInArrow(_span_batches, "row_key long, hit_spans array<long>, classes array<long>"), "hits")


def _item_sets(hits: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """named (classes, set_id) for the sets of classes that occur, and sets (set_id, items), items sorted, null last.

    Items are gathered once for each different set, never once a row. Before that a class goes whose items the set's
    largest class holds anyway, so that rows with the same opening and a question each mostly share a set.
    """
    combos = stage_table(hits.groupBy("classes").agg(F.min("row_key").alias("combo")), "combos")
    each = combos.select("combo", F.explode("classes").alias("class")).join(members.select("class", "size").distinct(), "class")
    largest = each.groupBy("combo").agg(F.max(F.struct("size", "class")).getField("class").alias("base"))
    paired = stage_table(each.join(largest, "combo"), "paired")
    pairs = paired.where("class <> base").select("class", "base", "size").distinct()
    base_items = members.select(F.col("class").alias("base"), F.col("item_id").alias("base_item"))
    asked = pairs.join(members.select("class", "item_id"), "class").alias("asked")
    shared = asked.join(base_items.alias("b"), (F.col("asked.base") == F.col("b.base")) & F.col("item_id").eqNullSafe(F.col("base_item")))
    inside = shared.groupBy("class", "asked.base", "size").agg(F.count("*").alias("n")).where("n = size").select("class", "base")
    fewer = paired.join(stage_table(inside, "inside"), ["class", "base"], "left_anti")
    fewer = stage_table(fewer.groupBy("combo").agg(F.array_sort(F.collect_list("class")).alias("fewer")), "fewer")
    kept = stage_table(fewer.groupBy("fewer").agg(F.min("combo").alias("set_id")), "sets")
    ids = kept.select("set_id", F.explode("fewer").alias("class")).join(members, "class").select("set_id", "item_id").distinct()
    items = ids.groupBy("set_id").agg(F.array_sort(F.collect_list("item_id")).alias("items"), F.max(F.col("item_id").isNull()).alias("unnamed"))
    sets = items.select("set_id", F.when(F.col("unnamed"), F.concat("items", F.array(F.lit(None).cast("string")))).otherwise(F.col("items")).alias("items"))
    return combos.join(fewer, "combo").join(kept, "fewer").select("classes", "set_id"), sets


def _measure(spans: F.Column) -> F.Column:
    """Length of disjoint [start, end) spans given as one flat array: ends count up, starts down."""
    signed = F.transform(spans, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    return F.aggregate(signed, F.lit(0).cast("long"), lambda a, x: a + x)


def _sizes(windows: DataFrame) -> list[int]:
    """Numbers of words of the benchmark's windows, WINDOW of them at most."""
    return sorted(r["n"] for r in windows.select("n").distinct().collect())


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, hit_spans, items), one row per row of docs: the hit word spans as disjoint, flat [start, end)
    pairs, and the ids of the items that occur.

    Documents are stored once with a key per row, their fingerprints beside them; hits are found by equality joins
    whatever the size of either side (see _hits). Words, windows and the rule for short items are those of the module's
    constants. Null texts have no words, items without words never occur, and items with a null id are matched like
    any other and stand as one null among the items. Each row has its own hits, also where doc_id is null or repeated.
    Other columns are ignored. An empty benchmark gives no hits, an empty table no rows.
    """
    rows, hits, named, sets = _contamination(docs, benchmark)
    found = hits.join(stage_table(named, "named"), "classes").join(sets, "set_id").select("row_key", "hit_spans", "items")
    none = F.coalesce("hit_spans", F.array().cast("array<long>")), F.coalesce("items", F.array().cast("array<string>"))
    return rows.join(found, "row_key", "left").select("doc_id", "n_words", none[0].alias("hit_spans"), none[1].alias("items"))


def _contamination(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """rows (row_key, doc_id, n_words), one for each row of docs, their hits, and named and sets as in _item_sets()."""
    ship_package(docs.sparkSession)
    windows, members = benchmark_windows(benchmark)
    sizes = _sizes(windows)
    marked = _marked(docs.select(F.col("doc_id").cast("bigint"), "text"), ["doc_id"], sizes)
    hits = _hits(marked, windows, sizes)
    return marked.select("row_key", F.col("c0").alias("doc_id"), "n_words"), hits, *_item_sets(hits, members)


def _contaminated(n_words: F.Column, n_hit: F.Column) -> F.Column:
    return (n_hit > 0) & (SHARE * n_hit >= n_words)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that are not contaminated, each judged by itself as in contamination()."""
    ship_package(docs.sparkSession)
    windows, _ = benchmark_windows(benchmark)
    sizes, carry = _sizes(windows), [c for c in docs.columns if c != "text"]
    marked = _marked(docs, carry, sizes)
    judged = marked.select("row_key", "n_words").join(_hits(marked, windows, sizes), "row_key")
    bad = stage_table(judged.where(_contaminated(F.col("n_words"), _measure(F.col("hit_spans")))).select("row_key"), "contaminated")
    kept = marked.join(bad, "row_key", "left_anti")
    return kept.select(*[F.col("text" if c == "text" else f"c{carry.index(c)}").alias(c) for c in docs.columns])


def op7_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's columns, for all documents against the whole benchmark; ids that are null are left out of the digest.

    Ids are joined and hashed once for each set of items, so rows carry a digest and never the ids."""
    rows, hits, named, sets = _contamination(docs, benchmark)
    digests = sets.select("set_id", F.size("items").cast("long").alias("n"), F.sha2(F.array_join("items", ","), 256).alias("digest"))
    digests = stage_table(named.join(digests, "set_id").select("classes", "n", "digest"), "digests")
    found = hits.join(digests, "classes").select("row_key", _measure(F.col("hit_spans")).alias("hit"), "n", "digest")
    none = F.lit(0).cast("long")
    return rows.join(found, "row_key", "left").withColumn("n_hit", F.coalesce("hit", none)).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.coalesce("n", none).alias("n_items"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        _contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"),
    )


OP7_SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bl AS (SELECT item_id, w, least(13, len(w)) AS n FROM bw WHERE len(w) > 0),
bg AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM bl)),
sizes AS (SELECT DISTINCT n FROM bl),
dg AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)),
m AS (SELECT doc_id, item_id, dg.n, i FROM dg JOIN bg ON dg.n = bg.n AND dg.g = bg.g),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY 1),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""
