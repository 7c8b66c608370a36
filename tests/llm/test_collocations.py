"""Collocation mining against counting by hand, in shards so small that pieces are cut across them."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm import collocations

DOCS = "doc_id long, text string, lang string, n long, phrase string"


def brute_counts(rows, longest=5):
    f = Counter()
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            for k in range(1, longest + 1):
                f.update((lang if lang is not None else "und", *words[i : i + k]) for i in range(len(words) - k + 1))
    return f


def brute(rows, least):
    f, totals, out = brute_counts(rows), Counter(), []
    for g, n in f.items():
        totals[g[0]] += n if len(g) == 2 else 0
    chosen = {g: n for g, n in f.items() if len(g) > 2 and n >= least}
    for g, a in chosen.items():
        words = g[1:]
        if any(b >= a and h[0] == g[0] and len(h) > len(g) and any(h[1 + i : 1 + i + len(words)] == words for i in range(len(h) - len(words))) for h, b in chosen.items()):
            continue
        score, _, left, right = min((1000 * a * totals[g[0]] // (f[g[0], *words[:k]] * f[g[0], *words[k:]]), k, f[g[0], *words[:k]], f[g[0], *words[k:]]) for k in range(1, len(words)))
        out.append((g[0], " ".join(words), a, left, right, totals[g[0]], score))
    return sorted(out)


def test_portions_count_every_phrase_once():
    import pyarrow as pa

    words = [f"w{i % 7}" for i in range(53)]
    for lens in ([53], [1, 50, 2], [20, 33], [5] * 10 + [3]):
        seen = Counter()
        for sign, part, sizes, _ in collocations._portions(pa.array(words), np.array(lens), np.zeros(len(lens), int), 10):
            assert len(part) == sum(sizes) and (len(part) <= 10 or sign < 0)
            at = 0
            for n in sizes:
                piece = part[at : at + n].to_pylist()
                for k in range(1, 6):
                    for i in range(len(piece) - k + 1):
                        seen[tuple(piece[i : i + k])] += sign
                at += n
        want, at = Counter(), 0
        for n in lens:
            for k in range(1, 6):
                want.update(tuple(words[at + i : at + i + k]) for i in range(n - k + 1))
            at += n
        assert +seen == want and min(seen.values()) >= 0


@pytest.mark.parametrize("shard_words", [12, 90, 10**6])
def test_against_counting(spark, shard_words):
    rng = random.Random(5)
    vocabulary = ["the", "The", "a", "of", "ünder", "日本", "x y", "\x1c", "new", "york", "city", "</s>"]
    rows = [(None, "en"), ("", None), (" \t\n", "de"), ("... !", "en")]
    for i in range(60):
        words = [w for _ in range(rng.randrange(1, 40)) for w in (["new", "york", "city"] if rng.random() < 0.1 else [rng.choice(vocabulary) + rng.choice(["", "", "", ".", ",\n"])])]
        rows.append((rng.choice([" ", "\t ", "  "]).join(words), rng.choice(["en", "en", "de", None, ""])))
    rows += [("New York city a the", "en")] * 5 + [("of the " * 200, "en")]
    docs = spark.createDataFrame([(i % 50, t, lang, 3, "p") for i, (t, lang) in enumerate(rows)], DOCS)
    got = collocations.collocations(docs, least=4, shard_words=shard_words)
    found = sorted(map(tuple, got.select("lang", "phrase", "a", "l", "r", "n", "score").collect()))
    want = brute(rows, 4)
    assert found == want and len(want) > 20
    top = collocations.top_phrases(got, 3).collect()
    for lang in {r["lang"] for r in top}:
        mine = sorted((r["rank"], r["phrase"]) for r in top if r["lang"] == lang)
        best = sorted((w for w in want if w[0] == lang), key=lambda w: (-w[6], -w[2], w[1].encode()))[:3]
        assert mine == [(i + 1, w[1]) for i, w in enumerate(best)]


def test_a_part_is_summed_in_linear_work(monkeypatch):
    """Many small packs of mostly different phrases: each sum has about as many new phrases as old ones."""
    import pyarrow as pa

    rng, packs, want, summed = np.random.default_rng(3), [], Counter(), []
    for part in (4, 9):
        for i in range(800):
            phrases, lang = [f"a{x} b{x % 7}" for x in rng.integers(0, 9000, 10).tolist()], f"l{i % 3}"
            want.update((part, lang, p) for p in phrases)
            packs.append(collocations._packed(np.full(10, part), np.zeros(10, int), [lang], pa.array(phrases), np.ones((3, 10), np.int64)))
    monkeypatch.setattr(collocations, "HELD", 100)
    plain = pa.concat_tables
    monkeypatch.setattr(collocations.pa, "concat_tables", lambda ts: summed.append(sum(map(len, ts))) or plain(ts))
    got = [tuple(r.values()) for b in collocations._sums(2)(iter(packs)) for r in b.to_pylist()]
    assert sorted(got) == sorted((g, 2, p, n, n, n) for (_, g, p), n in want.items() if n >= 2)
    assert sum(summed) <= 4 * 16_000


def test_a_full_filter_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "MOST_BITS", 1 << 10)
    rows = [(f"word{i % 90} word{i % 7} word{i % 3} tail{i % 2}", "en") for i in range(3000)]
    docs = spark.createDataFrame([(i, t, lang, 3, "p") for i, (t, lang) in enumerate(rows)], DOCS)
    got = collocations.collocations(docs, least=20, shard_words=500).select("lang", "phrase", "a", "l", "r", "n", "score")
    assert sorted(map(tuple, got.collect())) == brute(rows, 20)


def test_no_rows_and_neighbour_counts(spark):
    empty = spark.createDataFrame([], DOCS)
    assert collocations.op11_collocations(empty).count() == 0
    docs = spark.createDataFrame([(1, "a b c. a b", "en", 1, "")] * 4, DOCS)
    rows = {r["phrase"]: (r["n"], r["left_n"], r["right_n"]) for r in collocations.frequent_phrases(collocations.index_shards(docs), 4).collect()}
    assert rows == {"a": (8, 0, 8), "b": (8, 8, 4), "c": (4, 4, 0), "a b": (8, 0, 4), "b c": (4, 4, 0), "a b c": (4, 0, 0)}
