"""Fill-in-the-middle against slicing by code points, and the external shuffle against its laws."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import fim, sharding
from ledgerloom.session import work_path

DOCS = "doc_id long, text string, shard string, slot long, bucket long"
WIDE = "ümlaut 日本 \U0001f600 a" * 20000


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=200), st.integers(0, 2**32), st.integers(0, 2**32))
def test_parts_are_slices(text, a, b):
    text = text.encode("utf-8", "ignore").decode()
    n, before, inside, *parts = fim._cut(text, a, b)
    i, j = sorted((a % (len(text) + 1), b % (len(text) + 1)))
    assert (n, before, inside, *parts) == (len(text), i, j - i, text[:i], text[i:j], text[j:])


@pytest.mark.parametrize("text", ["", "a", "é", "a" * 70000, "é" * 70000, WIDE, "日" * 30000 + "b" * 200000 + "ü" * 5, ("a" * 9 + "é") * 20000, "\U0001f600" * 3 + "x" * 65536])
def test_every_container_selects(text):
    data = text.encode()
    places = fim.BoundarySet(data)
    want = [0]
    for c in text:
        want.append(want[-1] + len(c.encode()))
    assert len(places) == len(want)
    for k in {0, len(text), *random.Random(1).choices(range(len(want)), k=300)}:
        assert places.select(k) == want[k]
    with pytest.raises(IndexError):
        places.select(len(want))


def test_all_three_forms_occur():
    kinds = {c[0] for t in ["a" * 70000, "é" * 30000, ("a" * 9 + "é") * 20000, "é" * 1000] for c in fim.BoundarySet(t.encode()).containers}
    assert kinds == {"run", "array", "bitmap"}


def brute_fim(doc, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc, n, "plain", None, None, text
    if h4 % 100 < 20:
        return doc, n, "spm", i, j - i, f"<S>{text[j:]}<P>{text[:i]}<M>{text[i:j]}"
    return doc, n, "psm", i, j - i, f"<P>{text[:i]}<S>{text[j:]}<M>{text[i:j]}"


def test_fim_against_slicing(spark):
    texts = [None, "", "x", "<P", "<P>x", "a <S> b", "<M>", "<S<P<M", "S>M>P>" * 9, WIDE, "line\nline\r\n\ttab" * 30]
    rows = [(i if i % 9 else None, texts[i % len(texts)], "s", 1, 2) for i in range(150)] + [(7, "twice", "s", 1, 2)] * 2
    docs = spark.createDataFrame(rows, DOCS)
    out = fim.fill_in_middle(docs)
    assert Counter(map(tuple, out.collect())) == Counter(brute_fim(r[0], r[1]) for r in rows)
    again = out.select("doc_id", "n", fim.restored().alias("text"))
    assert Counter((r["doc_id"], r["text"]) for r in again.collect()) == Counter((r[0], r[1] or "") for r in rows)
    assert fim.op12_fim(spark.createDataFrame([], DOCS)).count() == 0
    assert {r["form"] for r in fim.fill_in_middle(docs, keep=0).collect()} == {"plain"}


def test_permutations_are_uniform():
    assert [list(sharding.fisher_yates(n, [1, 2])) for n in (0, 1)] == [[], [0]]
    seen = Counter(tuple(sharding.fisher_yates(4, [s, 5])) for s in range(4800))
    assert len(seen) == 24 and max(seen.values()) < 2 * min(seen.values())


@pytest.mark.parametrize(("rows", "shards", "bucket_bytes"), [(0, 5, 100), (3, 5, 100), (503, 7, 2000), (503, 1, 1 << 20)])
def test_shards_hold_every_row_once(spark, rows, shards, bucket_bytes):
    texts = [None, "", "ü" * 50, "same text", "x" * 5000]
    data = [(None if i % 3 == 0 else i % 40, texts[i % 5], "own", i, 9) for i in range(rows)]
    docs = spark.createDataFrame(data, DOCS).repartition(3)
    path = work_path(spark, "test-shards")
    got = sharding.write_shards(docs, path, shards, bucket_bytes=bucket_bytes).collect()
    assert Counter(tuple(r["record"]) for r in got) == Counter(data)
    assert all(r["size"] == len((r["record"]["text"] or "").encode()) + 16 for r in got)
    counts = Counter(r["shard"] for r in got)
    sizes = [counts[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes, reverse=True)
    for s in range(shards):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sizes[s]))
    if rows > 100 and shards > 1:  # neighbours of the input part
        order = [r["record"]["slot"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
        assert sum(b == a + 1 for a, b in zip(order, order[1:], strict=False)) < 20


def test_sharding_digest_columns(spark):
    docs = spark.createDataFrame([(i, "t" * i, "s", 1, 2) for i in range(90)] + [(None, None, None, None, None)], DOCS)
    got = sharding.op13_sharding(docs)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = got.collect()
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in rows} == {(i, i + 16, zlib.crc32(b"t" * i)) for i in range(90)} | {(None, 16, 0)}
    first = got.orderBy("shard", "slot").select("doc_id").collect()
    assert first == sharding.op13_sharding(docs).orderBy("shard", "slot").select("doc_id").collect()
    assert got.where(F.col("law") != "rows").count() == 0
