"""Personal data: fixed finders, and contextual extraction bootstrapped from what they find."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import ship_package, stage_table

#: The kinds of base spans, in the order that breaks ties.
KINDS = ("email", "ip", "card", "phone")
#: Kinds found by form alone that only serve as more seeds; their spans are reported after the base kinds.
SEED_KINDS = ("secret",)
#: What the method adds: id and the kind of the seeds that its context had, or just id where they were mixed.
LEARNED = "id"
#: Share of a context's seeds that one kind needs to name what the context finds.
ONE_KIND = 0.8

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits either matches from its start or not at all, so no start inside a run is tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SECRET = re.compile(r"\b(?:AKIA[0-9A-Z]{16}\b|(?:password|passwd|secret|token|api_?key)\s*[=:]\s*\"?(?P<v>[A-Za-z0-9_\-/+]{8,}))", re.IGNORECASE)
_DIGIT = re.compile(r"[0-9]")
#: An identifier-like token: at least five characters of these, one of them a digit.
_TOKEN = re.compile(r"[A-Za-z0-9][A-Za-z0-9_@./:-]{3,}[A-Za-z0-9]")
_QUOTES = "\"'([{<"
_WORD = re.compile(r"\S+")
_GLUE = re.compile(r"[=:#]")
_SPACE = re.compile(r"\s")
#: Characters, about, of a text that are split into words at once.
PIECE = 1 << 18
#: Words longer than this stand in patterns as a digest of all of them, so that patterns stay small.
LONG_WORD = 64


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The leftmost non-overlapping matches of the email pattern, found from each @ outwards in linear time."""
    last, at = 0, text.find("@")
    while at >= 0:
        s = at
        while s > last and text[s - 1] in _LOCAL_CHARS:
            s -= 1
        if s < at and (m := _DOMAIN.match(text, at + 1)):
            yield s, m.end()
            last = m.end()
            at = text.find("@", last)
        else:
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds by start, then kind as listed; code points, end exclusive."""
    out = [(s, e, 0) for s, e in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((m.start(), m.end(), 1))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), 2))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append((m.start(), m.end(), 3))
    return [(s, e, KINDS[k]) for s, e, k in sorted(out, key=lambda x: (x[0], x[2], x[1]))]


def _overlaps(spans: list[tuple[int, int, str]], s: int, e: int) -> bool:
    return any(a < e and s < b for a, b, _ in spans)


class _Long:
    """Names of a word's growing beginnings, in time linear in the word."""

    def __init__(self, text: str, start: int) -> None:
        self._text, self.start, self._at, self._hash = text, start, start, hashlib.sha256()

    def upto(self, end: int) -> str:
        if end - self.start <= LONG_WORD:
            return self._text[self.start : end].lower()
        # sigma is the one letter whose lower case depends on what follows
        self._hash.update(self._text[self._at : end].replace("\u03a3", "\u03c3").lower().encode("utf-8", "surrogatepass"))
        self._at = end
        return "sha256 " + self._hash.hexdigest()  # no word has a space


def contexts(text: str, starts: Iterable[int]) -> Iterator[tuple[list[str], str]]:
    """For each of the ascending starts: the (at most two) words before it and the character before it, quotes and
    brackets next to it left out. Words are as long as they are, however wide the white space between; linear time."""
    words = _WORD.finditer(text)
    ahead = next(words, None)
    spans: list[tuple[int, int]] = []
    last, earlier = _Long(text, -1), []
    for s in starts:
        while s > 0 and text[s - 1] in _QUOTES:
            s -= 1
        while ahead and ahead.start() < s:
            spans = [*spans[-1:], ahead.span()]
            ahead = next(words, None)
        if not spans:
            yield [], ""
            continue
        if last.start != spans[-1][0]:
            last = _Long(text, spans[-1][0])
            earlier = [_Long(text, a).upto(b) for a, b in spans[:-1]]
        yield [*earlier, last.upto(min(spans[-1][1], s))], text[s - 1]


def mentions(text: str) -> list[tuple[int, int, str | None, str, list[str]]]:
    """(start, end, kind or None for a candidate, value, context patterns) of entities and identifier-like tokens.

    Patterns are the word before ("1:w"), the two words before ("2:w w") and a key glued on ("k:name="), lower-cased.
    """
    base = base_spans(text)
    found: list[tuple[int, int, str | None]] = list(base)
    for m in _SECRET.finditer(text):
        s, e = m.span("v") if m["v"] else m.span()
        if not _overlaps(base, s, e):
            found.append((s, e, "secret"))
    if _DIGIT.search(text):
        taken = sorted(found)
        k, reach = 0, -1
        for m in _TOKEN.finditer(text):
            s, e = m.span()
            while k < len(taken) and taken[k][0] < e:
                reach = max(reach, taken[k][1])
                k += 1
            if s >= reach and _DIGIT.search(m[0]):
                found.append((s, e, None))
    out = []
    found.sort(key=lambda x: (x[0], x[1]))
    for (s, e, kind), (w, glued) in zip(found, contexts(text, [x[0] for x in found]), strict=True):
        patterns = []
        if glued in ("=", ":", "#"):
            patterns.append("k:" + w[-1])
        if w:
            patterns.append("1:" + w[-1])
            if len(w) > 1:
                patterns.append("2:" + w[-2] + " " + w[-1])
        out.append((s, e, kind, text[s:e].lower(), patterns))
    return out


def context_uses(text: str, patterns: frozenset[str] | Counter) -> Counter:
    """How often each of the patterns stands in a text before a word, or goes on inside one. A long text is split into
    words piece by piece."""
    uses: Counter = Counter()
    two, glue = (any(p[0] == k for p in patterns) for k in "2k")
    before: list[str] = []
    at = 0
    while at < len(text):
        edge = _SPACE.search(text, at + PIECE)
        end = edge.start() if edge else len(text)
        words = [w.lower() if len(w) <= LONG_WORD else _Long(w, 0).upto(len(w)) for w in text[at:end].split()]
        at, new = end, words
        words = before + words
        uses.update(p for w in words[max(0, len(before) - 1) : -1] if (p := "1:" + w) in patterns)
        if two:
            uses.update(p for x, y in zip(words, words[1:-1], strict=False) if (p := f"2:{x} {y}") in patterns)
        if glue:
            uses.update(p for w in new if "=" in w or ":" in w or "#" in w for m in _GLUE.finditer(w, 0, len(w) - 1) if (p := "k:" + w[: m.end()]) in patterns)
        before = words[-2:]
    return uses


def ordinary_uses(text: str, found: list[tuple[int, int, str | None, str, list[str]]]) -> dict[str, int]:
    """How often the context patterns of a text's mentions stand in it before something that is no mention."""
    met = Counter(p for m in found for p in m[4])
    uses = context_uses(text, met) if met else met
    return {p: n for p in met if (n := uses[p] - met[p]) > 0}


MENTIONS = "row_id long, doc_id long, starts array<int>, ends array<int>, kinds array<string>, entity array<string>, patterns array<array<string>>, ordinary map<string,bigint>"


def _mention_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        cols: list[list] = [[] for _ in range(6)]
        for t in b.column("text"):
            text = t.as_py() or ""
            found = mentions(text)
            for c, k in zip(cols, range(5), strict=False):
                c.append([m[k] for m in found])
            cols[5].append(list(ordinary_uses(text, found).items()))
        kinds = [pa.list_(pa.int32())] * 2 + [pa.list_(pa.string())] * 2 + [pa.list_(pa.list_(pa.string())), pa.map_(pa.string(), pa.int64())]
        yield pa.RecordBatch.from_arrays([b.column("row_id"), b.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], ["row_id", "doc_id", "starts", "ends", "kinds", "entity", "patterns", "ordinary"])


def bootstrap(edges: DataFrame, ordinary: DataFrame, rounds: int = 3, least_score: float = 0.8, least_support: int = 5, prior: float = 1.0, doubt: float = 0.2) -> DataFrame:
    """(pattern, value, kind) graph edges, kind null for candidates, and (pattern, n) of ordinary uses -> (pattern,
    score, kind, s, n) of the patterns trusted after some rounds.

    Each round scores a pattern by s / (s + ordinary uses + doubt * u + prior), where s sums its distinct values' scores
    and u what they lack to n, one each, and a value by the best of its patterns (seeds keep 1). A word that stands before
    anything at all is no context, however many seeds it has met; unseen identifiers speak little against one. A trusted
    pattern has least_score and least_support values; kind names
    what it finds (see LEARNED). All of it is grouped counts and equi-joins; hot patterns are pre-aggregated and their
    joins may be split.
    """
    graph = stage_table(edges.groupBy("pattern", "value").agg(F.max("kind").alias("kind")), "graph")
    against = ordinary.groupBy("pattern").agg(F.sum("n").alias("ordinary"))
    seed = F.col("kind").isNotNull().cast("double")
    values = graph.groupBy("value").agg(F.max(seed).alias("score"))
    for k in range(rounds):
        sums = graph.join(values, "value").groupBy("pattern").agg(F.sum("score").alias("s"), F.count("*").alias("n"))
        scored = sums.where(F.col("n") >= least_support).join(against, "pattern", "left").withColumn("p", F.col("s") / (F.col("s") + F.coalesce("ordinary", F.lit(0)) + F.lit(doubt) * (F.col("n") - F.col("s")) + F.lit(prior)))
        patterns = stage_table(scored.where(F.col("p") >= least_score).select("pattern", "p", "s", "n"), "patterns")
        if k < rounds - 1:
            best = graph.join(patterns.select("pattern", "p"), "pattern", "left").groupBy("value").agg(F.greatest(F.coalesce(F.max("p"), F.lit(0.0)), F.max(seed)).alias("score"))
            values = stage_table(best, "values")
    kinds = graph.where("kind is not null").join(patterns.select("pattern", "p"), "pattern").groupBy("pattern", "p", "kind").agg(F.count("*").alias("n"))
    named = kinds.groupBy("pattern", "p").agg(F.max(F.struct("n", "kind")).alias("top"), F.sum("n").alias("n"))
    learned = F.when(F.col("top.n") >= ONE_KIND * F.col("n"), F.concat(F.lit(f"{LEARNED}_"), F.col("top.kind"))).otherwise(F.lit(LEARNED))
    return patterns.join(named.select("pattern", learned.alias("kind")), "pattern", "left").select("pattern", F.col("p").alias("score"), F.coalesce("kind", F.lit(LEARNED)).alias("kind"), "s", "n")


def personal_data(docs: DataFrame, **settings: float) -> DataFrame:
    """(row_id, doc_id, spans array<struct<start int, end int, kind string>>), spans by start, then kind as listed.

    Base kinds are always there as found. Candidates (identifier-like tokens that no finder took) are added where a
    trusted pattern precedes them, of the best one's kind; seeds are the base kinds and well-formed secrets. Null texts
    are empty; repeated rows each get their row; an empty table gives an empty result; extra columns are ignored.
    Mentions are staged; docs is read once more to weigh contexts; only candidates, never texts, are shuffled.
    """
    ship_package(docs.sparkSession)
    found = _mentions(docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "text"))
    return spans_of(found, trusted_patterns(found, docs, **settings))


def _mentions(rows: DataFrame) -> DataFrame:
    rows = rows.select("row_id", F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return stage_table(rows.mapInArrow(_mention_batches, MENTIONS), "mentions")


def _each(found: DataFrame) -> DataFrame:
    return found.where(F.size("starts") > 0).select("row_id", F.explode(F.arrays_zip("starts", "ends", "kinds", "entity", "patterns")).alias("m"))


def _use_batches(batches: Iterator[pa.RecordBatch], patterns: frozenset[str]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n: Counter = Counter()
        for t in b.column("text"):
            n.update(context_uses(t.as_py() or "", patterns))
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], ["pattern", "n"])


def pattern_uses(texts: DataFrame, patterns: DataFrame, at_once: int = 200_000) -> DataFrame:
    """(pattern, n) over all texts. Patterns are broadcast in blocks of about at_once, each block in a pass of its own."""
    spark = texts.sparkSession
    blocks = max(1, -(-patterns.count() // at_once))
    out = None
    for k in range(blocks):
        block = patterns.where(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == k).select("pattern")
        shared = spark.sparkContext.broadcast(frozenset(r["pattern"] for r in block.collect()))

        def run(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared) -> Iterator[pa.RecordBatch]:
            return _use_batches(batches, shared.value)

        part = texts.select(F.col("text").cast("string")).mapInArrow(run, "pattern string, n long")
        out = part if out is None else out.unionAll(part)
    return out.groupBy("pattern").agg(F.sum("n").alias("n"))


def trusted_patterns(found: DataFrame, texts: DataFrame, least_score: float = 0.8, prior: float = 1.0, doubt: float = 0.2, **settings: float) -> DataFrame:
    """Mentions and the texts they are from -> (pattern, score, kind), stored.

    bootstrap() knows the ordinary uses in texts with such a mention; what it trusts is then weighed by all its uses in
    all texts, so that a word that met a few seeds by chance is left out.
    """
    uses = _each(found).select(F.explode("m.patterns").alias("pattern"), F.col("m.entity").alias("value"), F.col("m.kinds").alias("kind"))
    first = stage_table(bootstrap(uses, found.select(F.explode("ordinary").alias("pattern", "n")), least_score=least_score, prior=prior, doubt=doubt, **settings), "provisional")
    met = uses.join(first.select("pattern"), "pattern").groupBy("pattern").agg(F.count("*").alias("met"))
    weighed = first.join(pattern_uses(texts, first).withColumnRenamed("n", "uses"), "pattern", "left").join(met, "pattern")
    others = F.greatest(F.coalesce("uses", F.lit(0)) - F.col("met"), F.lit(0))
    score = F.col("s") / (F.col("s") + others + F.lit(doubt) * (F.col("n") - F.col("s")) + F.lit(prior))
    return stage_table(weighed.withColumn("score", score).where(F.col("score") >= least_score).select("pattern", "score", "kind"), "trusted")


def spans_of(found: DataFrame, trusted: DataFrame) -> DataFrame:
    """Mentions and trusted patterns -> (row_id, doc_id, spans)."""
    each = _each(found)
    candidates = each.where(F.col("m.kinds").isNull()).select("row_id", F.col("m.starts").alias("start"), F.col("m.ends").alias("end"), F.explode("m.patterns").alias("pattern"))
    best = candidates.join(trusted, "pattern").groupBy("row_id", "start", "end").agg(F.max(F.struct("score", "kind")).alias("b"))
    learned = best.groupBy("row_id").agg(F.collect_list(F.struct("start", "end", F.col("b.kind").alias("kind"))).alias("learned"))
    known = F.filter(F.transform(F.arrays_zip("starts", "ends", "kinds"), lambda m: F.struct(m["starts"].alias("start"), m["ends"].alias("end"), m["kinds"].alias("kind"))), lambda m: m["kind"].isNotNull())
    order = F.array(*[F.lit(k) for k in (*KINDS, *SEED_KINDS)])
    rank = lambda kind: F.coalesce(F.nullif(F.array_position(order, kind), F.lit(0)), F.lit(99))
    ranked = F.transform(F.concat("known", F.coalesce("learned", F.array().cast("array<struct<start:int,end:int,kind:string>>"))), lambda m: F.struct(m["start"].alias("start"), rank(m["kind"]).alias("rank"), m["end"].alias("end"), m["kind"].alias("kind")))
    spans = F.transform(F.array_sort(ranked), lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["kind"].alias("kind")))
    return found.select("row_id", "doc_id", known.alias("known")).join(learned, "row_id", "left").select("row_id", "doc_id", spans.alias("spans"))


def _joined(spans: F.Column) -> F.Column:
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(":", m["kind"], m["start"].cast("string"), m["end"].cast("string"))), ",")


def _count(kind: str) -> F.Column:
    return F.size(F.filter("spans", lambda m: m["kind"] == kind)).cast("long")


def op3_pii(docs: DataFrame) -> DataFrame:
    """The digest columns: counts per base kind, base_sha256 over the base spans, and all spans."""
    found = personal_data(docs)
    base = F.filter("spans", lambda m: m["kind"].isin(*KINDS))
    counts = [_count(k).alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def mask(text: str, spans: list[tuple[int, int, str]]) -> str:
    """Each span replaced by [KIND]; overlapping spans by the kind of the one that begins first, of those the longest. The order
    in which spans are given doesn't matter."""
    out, at, last = [], 0, 0
    for s, e, kind in sorted(spans, key=lambda x: (x[0], -x[1], x[2])):
        if s >= last:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = last = max(last, e)
    return "".join([*out, text[at:]])


def _mask_batches(batches: Iterator[pa.RecordBatch], trusted: dict[str, tuple[float, str]]) -> Iterator[pa.RecordBatch]:
    """Masks where the texts are, by the trusted patterns (score, kind)."""
    for b in batches:
        at = b.schema.get_field_index("text")
        texts = []
        for t in b.column("text").to_pylist():
            found = []
            for s, e, kind, _, patterns in mentions(t or ""):
                kind = kind or max((trusted[p] for p in patterns if p in trusted), default=(0, None))[1]
                if kind:
                    found.append((s, e, kind))
            texts.append(mask(t, found) if found else t)
        yield b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))


def _mask_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Masks the spans that stand beside the texts."""
    for b in batches:
        at = b.schema.get_field_index("text")
        spans = b.column("spans").to_pylist()
        texts = [mask(t, [(x["start"], x["end"], x["kind"]) for x in found]) if found and t is not None else t for t, found in zip(b.column("text").to_pylist(), spans, strict=True)]
        yield b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type)).drop_columns(["spans"])


#: Up to so many trusted patterns are broadcast; beyond that spans are joined to the documents. The result is the same.
BROADCAST_PATTERNS = 200_000


def masked(docs: DataFrame, broadcast_patterns: int = BROADCAST_PATTERNS, **settings: float) -> DataFrame:
    """The documents with personal data and secrets replaced by [KIND], and n_chars (if there) counted anew.

    docs is read three times and must be a stored table. Few trusted patterns are broadcast and applied where the texts are,
    so no text is shuffled; with more than broadcast_patterns the documents are stored with a number per row first, and
    their spans are joined on it. Null texts stay null, repeated rows stay, all other columns stay as they are.
    """
    spark = docs.sparkSession
    ship_package(spark)
    trusted = trusted_patterns(_mentions(docs.select(F.monotonically_increasing_id().alias("row_id"), F.lit(None).alias("doc_id"), "text")), docs, **settings)
    if trusted.count() <= broadcast_patterns:
        shared = spark.sparkContext.broadcast({r["pattern"]: (r["score"], r["kind"]) for r in trusted.collect()})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _mask_batches(batches, shared.value)

        out = docs.mapInArrow(run, docs.schema)
    else:
        names = {c: "text" if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)}
        rows = stage_table(docs.select(F.monotonically_increasing_id().alias("row_id"), *[F.col(f"`{c}`").alias(n) for c, n in names.items()]), "numbered")
        spans = spans_of(_mentions(rows.select("row_id", F.lit(None).alias("doc_id"), "text")), trusted).where(F.size("spans") > 0).select("row_id", "spans")
        beside = rows.join(stage_table(spans, "spans"), "row_id", "left")
        out = beside.mapInArrow(_mask_spans, rows.schema).select(*[F.col(n).alias(c) for c, n in names.items()])
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
