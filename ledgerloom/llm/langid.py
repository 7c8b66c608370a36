"""Language of web pages by fusing text, declared language, address and host evidence (naive Bayes throughout)."""

from __future__ import annotations

import html as entities
import math
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.samples import in_share
from ledgerloom.session import ship_package, stage_table

#: Byte trigrams are counted in so many buckets, a power of two.
BUCKETS = 1 << 16
#: The most labelled documents, about, that the text model is fitted on; it knows all their languages.
SAMPLE = 20_000
#: Trigrams overlap, so the text's log-likelihood counts for so much a trigram; beyond KNEE of them a text repeats its
#: own words, and what counts grows with the logarithm only, but never stops.
TEMPER, KNEE = 0.2, 300
#: Seen buckets of a text that are looked up at once.
BLOCK = 4096
#: Pseudo-counts with which a parent's distribution is added at each level of the host hierarchy.
KAPPA = 8.0

_OPEN = re.compile(r"<!--|<(script|style|noscript|template)\b|<", re.IGNORECASE)
_CLOSE = {n: re.compile(rf"</{n}\s*+>", re.IGNORECASE) for n in ("script", "style", "noscript", "template")}
_HTML = re.compile(r"<html(?=[\s>/])", re.IGNORECASE)
_ATTRIBUTE = re.compile(r"""[\s/]*+([^\s/=>]++|=)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s>]*+)))?""")
_CODE = re.compile(r"\s*+([A-Za-z]{2,8})")


def without_markup(page: str) -> str:
    """The page with each comment, script, style, noscript and template element and each tag replaced by a space.

    An element or comment that is never closed is a tag only, and so ends at the next ">"; without one it is text. That a
    closing mark is missing is found once for each kind, so time is linear in the page, however often one is opened.
    """
    out: list[str] = []
    missing: set[str] = set()
    at = 0
    for m in iter(lambda: _OPEN.search(page, at), None):
        end, kind = -1, "--" if m[0] == "<!--" else (m[1] or "").lower()
        if kind and kind not in missing:
            if kind == "--":
                k = page.find("-->", m.end())
                end = k + 3 if k >= 0 else -1
            else:
                closed = _CLOSE[kind].search(page, m.end())
                end = closed.end() if closed else -1
            if end < 0:
                missing.add(kind)
        if end < 0:
            end = page.find(">", m.start()) + 1
            if not end:
                break
        out += (page[at : m.start()], " ")
        at = end
    return "".join((*out, page[at:]))


def declared_language(page: str) -> str | None:
    """The two to eight letters that begin the lang attribute (not xml:lang or data-lang) of the first html tag with one."""
    at = 0
    for m in iter(lambda: _HTML.search(page, at), None):
        end = page.find(">", m.end())
        tag = page[m.end() : end if end >= 0 else len(page)]
        for name, *values in _ATTRIBUTE.findall(tag):
            if name.lower() == "lang" and (code := _CODE.match("".join(values).lstrip("\"'"))):
                return code[1].lower()
        if end < 0:
            break
        at = end
    return None


def buckets_of(text: str) -> np.ndarray:
    b = np.frombuffer(b" " + " ".join(text.lower().split()).encode() + b" ", np.uint8).astype(np.uint32)
    return (((b[:-2] * 65536 + b[1:-1] * 256 + b[2:]) * np.uint32(2654435761)) >> np.uint32(33 - BUCKETS.bit_length())).astype(np.int64)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sums: dict[str, np.ndarray] = {}
        for t, lang in zip(b.column("text"), b.column("lang").to_pylist(), strict=True):
            sums[lang] = sums.get(lang, 0) + np.bincount(buckets_of(t.as_py() or ""), minlength=BUCKETS)
        for lang, c in sums.items():
            k = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array(k, pa.int64()), pa.array(c[k], pa.int64())], ["lang", "bucket", "n"])


@dataclass(frozen=True)
class TextModel:
    """Log-probabilities of buckets by language, held by seen cells: those of bucket b stand at upto[b] to upto[b + 1].

    A cell has its language's place and by how much its log-probability is above that language's for a bucket never seen.
    """

    langs: list[str]
    unseen: np.ndarray
    upto: np.ndarray
    lang: np.ndarray
    gain: np.ndarray

    @staticmethod
    def of(langs: list[str], lang: np.ndarray, bucket: np.ndarray, n: np.ndarray) -> TextModel:
        """From counts of seen (language's place, bucket) cells; every cell has half a count more."""
        total = np.bincount(lang, weights=n, minlength=len(langs)) + 0.5 * BUCKETS
        order = np.lexsort((lang, bucket))
        upto = np.concatenate(([0], np.cumsum(np.bincount(bucket, minlength=BUCKETS))))
        return TextModel(langs, np.log(0.5 / total), upto, lang[order].astype(np.int32), np.log(2.0 * n[order] + 1.0))

    def score(self, k: np.ndarray) -> np.ndarray:
        """Each language's log-likelihood of the buckets k."""
        total = len(k) * self.unseen
        seen, times = np.unique(k, return_counts=True)
        for a in range(0, len(seen), BLOCK):
            b, c = seen[a : a + BLOCK], times[a : a + BLOCK]
            size = self.upto[b + 1] - self.upto[b]
            cells = np.repeat(self.upto[b] - np.cumsum(size) + size, size) + np.arange(size.sum())
            total = total + np.bincount(self.lang[cells], weights=self.gain[cells] * np.repeat(c, size), minlength=len(total))
        return total


def weight(n: int) -> float:
    """What a trigram of a text with n of them counts: TEMPER up to KNEE, then such that n of them count TEMPER * KNEE * (1 + ln(n / KNEE))."""
    return TEMPER if n <= KNEE else TEMPER * KNEE * (1.0 + math.log(n / KNEE)) / n


def fit(docs: DataFrame, sample: int = SAMPLE) -> TextModel:
    """Trigram counts by declared label over a sample of at most about `sample` documents, chosen by a hash of doc_id.

    Rows that repeat a doc_id count once, with the least label and text of it. Without labelled documents there is one
    language, "und". The model has a cell for each trigram bucket that the sample shows in a language, so a language's
    figures do not depend on which others are known.
    """
    ship_package(docs.sparkSession)
    known = docs.where("lang is not null").select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.col("lang").cast("string"))
    picked = known.where(in_share("doc_id", sample, known.count())).groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("r"))
    rows = stage_table(picked.select("r.text", "r.lang"), "language-sample")
    counts = rows.mapInArrow(_count_batches, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    place = pc.index_in(counts["lang"], value_set=pa.array(langs, pa.string())).to_numpy()
    return TextModel.of(langs or ["und"], place.astype(np.int64), counts["bucket"].to_numpy(), counts["n"].to_numpy())


_MODELS: dict[str, TextModel] = {}


def _page_batches(batches: Iterator[pa.RecordBatch], key: str, value: TextModel) -> Iterator[pa.RecordBatch]:
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = value
    model = _MODELS[key]
    for b in batches:
        declared, scores = [], []
        for t in b.column("html"):
            page = t.as_py() or ""
            declared.append(declared_language(page))
            k = buckets_of(entities.unescape(without_markup(page)))
            total = model.score(k)
            scores.append(((total - total.max()) * weight(len(k))).round(6).tolist())
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(declared, pa.string()), pa.array(scores, pa.list_(pa.float64()))], ["page_id", "url", "declared", "text_score"])


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """(page_id, url, host, declared, text_lang, lang, confidence), one row per page.

    The text model is fitted on a sample of docs (doc_id, text, lang); everything else covers all pages. Evidence:
    the text's tempered trigram likelihood; P(declared | language), counted over all pages against the text's best
    language; and P(language | host), counted likewise without the page itself and smoothed with its domain's, that
    with its address suffix's, that with all pages'. Counts are grouped sums, pre-aggregated before each shuffle; pages
    meet them in one join on the host, which may be split where a host is hot. Null html or url count as empty; ties
    go to the first language by name; extra columns are ignored.
    """
    model = fit(docs)
    langs = model.langs
    shared = pages.sparkSession.sparkContext.broadcast(model)
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _page_batches(batches, key, shared.value)

    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    read = rows.mapInArrow(run, "page_id long, url string, declared string, text_score array<double>")
    best = F.array_position("text_score", F.array_max("text_score")).cast("int")
    host = host_of(F.col("url"))
    seen = stage_table(read.withColumn("best", best).withColumn("host", host), "evidence")
    known = F.when(F.col("declared").isin(langs), F.col("declared")).when(F.col("declared").isNull(), F.lit("")).otherwise(F.lit("?"))
    seen = seen.withColumn("said", known)
    # at most one row for each pair of languages
    pairs = {(r["said"], r["best"] - 1): r["count"] for r in seen.groupBy("said", "best").count().collect()}
    totals = [sum(n for (_, j), n in pairs.items() if j == k) for k in range(len(langs))]
    every = sum(totals) + len(langs)
    base = [(t + 1) / every for t in totals]
    words = [*langs, "", "?"]
    told = [(w, [float(np.log((pairs.get((w, k), 0) + 0.5) / (totals[k] + 0.5 * len(words)))) for k in range(len(langs))]) for w in words]
    told = pages.sparkSession.createDataFrame(told, "said string, told array<double>")
    parts = F.split("host", r"\.")
    domain = F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2), ".")
    counted = stage_table(seen.groupBy("host", "best").agg(F.count("*").alias("n")).withColumn("domain", domain).withColumn("suffix", F.element_at(parts, -1)), "hosts")

    def counts(level: str, *more: str) -> DataFrame:
        """One row per host, domain or suffix with its counts by language."""
        sums = counted.groupBy(level, *more, "best").agg(F.sum("n").alias("n"))
        return sums.groupBy(level, *more).agg(F.map_from_entries(F.collect_list(F.struct("best", F.col("n").cast("double")))).alias("c"))

    def dense(c: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.lit(len(langs))), lambda k: F.coalesce(F.try_element_at(c, k), F.lit(0.0)))

    def smooth(c: Column, parent: Column) -> Column:
        n = F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(c, parent, lambda x, p: (x + KAPPA * p) / (n + KAPPA))

    suffixes = counts("suffix").select("suffix", smooth(dense(F.col("c")), F.array(*map(F.lit, base))).alias("p_suffix"))
    domains = counts("domain", "suffix").join(suffixes, "suffix").select("domain", smooth(dense(F.col("c")), F.col("p_suffix")).alias("p_domain"))
    hosts = counts("host", "domain").join(domains, "domain").select("host", dense(F.col("c")).alias("c_host"), "p_domain")
    met = seen.join(hosts, "host").join(told, "said")
    own = F.transform(F.sequence(F.lit(1), F.lit(len(langs))), lambda k: (k == F.col("best")).cast("double"))
    prior = smooth(F.zip_with("c_host", own, lambda a, b: a - b), F.col("p_domain"))
    met = met.withColumn("z", F.zip_with(F.zip_with("text_score", prior, lambda a, p: a + F.log(p)), "told", lambda a, b: a + b))
    met = met.withColumn("e", F.transform("z", lambda x: F.exp(x - F.array_max("z"))))
    names = F.array(*map(F.lit, langs))
    return met.select(
        "page_id", "url", "host", "declared", F.element_at(names, F.col("best")).alias("text_lang"),
        F.element_at(names, F.array_position("e", F.array_max("e")).cast("int")).alias("lang"),
        F.round(F.array_max("e") / F.aggregate("e", F.lit(0.0), lambda a, x: a + x), 6).alias("confidence"),
    )


def op5_langid(pages: DataFrame, docs: DataFrame) -> DataFrame:
    return identify(pages, docs)
