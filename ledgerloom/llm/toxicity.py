"""Toxicity by a weighted finite-state pattern grammar over clauses."""

from __future__ import annotations

import math
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ledgerloom.llm.samples import in_share
from ledgerloom.session import ship_package, stage_table

#: Fixed word lists of the grammar's closed classes, for the languages of the corpus.
TARGETS = frozenset("you your yours yourself he him his she her they them their vous tu toi te votre vos ton ta tes il ils elle elles du dich dir dein deine ihr euch sie usted tú ti tus su ustedes él ella ellos".split())
NEGATIONS = frozenset("not no never none isn't aren't wasn't ain't nor pas ne jamais aucun nicht kein keine nie niemals nunca ningún tampoco".split())
REPORTS = frozenset("said says say saying told tells wrote writes quoted quotes called calls claims claimed reported dit disait écrit sagte sagt schrieb nannte dijo dice escribió llamó".split())
THREATS = frozenset("kill hurt destroy attack beat burn shoot tuer frapper détruire töten schlagen zerstören matar golpear destruir".split())
#: Words that a negation reaches, and within which a threat's target must follow.
REACH = 3

#: The most labelled documents, about, that the grammar is learned from; what it holds is bounded by their words.
SAMPLE = 20_000
#: Beginnings of so many letters are learned besides whole words.
STEMS = (4, 5, 6)
#: False lexicon keys that chance may bring, over all keys counted.
CHANCE = 0.5

_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
#: Clauses end at these marks.
_CLAUSE = re.compile(r"[.!?;:\n|]+")


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def keys_of(words: Iterable[str]) -> set[str]:
    """A document's lexicon keys: its words, and their beginnings marked by *."""
    out = set()
    for w in words:
        out.add(w)
        for n in STEMS:
            if len(w) > n:
                out.add(w[:n] + "*")
    return out


class Transducer:
    """A weighted transducer over single symbols: state -> input -> (output, weight, next state). Weights add up along a
    path, and of paths the heaviest counts."""

    def __init__(self, arcs: dict, start: object, finals: set) -> None:
        self.arcs, self.start, self.finals = arcs, start, finals

    def then(self, other: Transducer) -> Transducer:
        """The composition: this one's output is the other's input. Only states that can be reached are made."""
        start = (self.start, other.start)
        arcs, queue = {}, [start]
        while queue:
            p, q = state = queue.pop()
            if state in arcs:
                continue
            here = arcs[state] = {}
            for symbol, mine in self.arcs[p].items():
                steps = [(out, v + w, (p2, q2)) for mid, v, p2 in mine for out, w, q2 in other.arcs[q].get(mid, ())]
                if steps:
                    here[symbol] = steps
                    queue += [s for _, _, s in steps]
        return Transducer(arcs, start, {s for s in arcs if s[0] in self.finals and s[1] in other.finals})

    def numbered(self) -> Transducer:
        """The same with states 0, 1 and so on."""
        name = {s: k for k, s in enumerate(self.arcs)}
        return Transducer({name[s]: {x: [(o, w, name[t]) for o, w, t in steps] for x, steps in a.items()} for s, a in self.arcs.items()}, name[self.start], {name[s] for s in self.finals})


#: Symbols that the lexicon gives to words: insult, threat, target, negation, report, other.
SYMBOLS = "IHTNRo"


def _passing(symbols: str, to: object) -> dict:
    return {x: [(x, 0.0, to)] for x in symbols}


def negation() -> Transducer:
    """I and H become i and h within REACH words after a negation; state: words still reached."""
    arcs = {}
    for k in range(REACH + 1):
        left = max(k - 1, 0)
        arcs[k] = _passing("TRo", left) | {"N": [("o", 0.0, REACH)], "I": [("i" if k else "I", 0.0, left)], "H": [("h" if k else "H", 0.0, left)]}
    return Transducer(arcs, 0, set(arcs))


def reported() -> Transducer:
    """After a word of speech I and H become r and p; state: whether there was one."""
    return Transducer({0: _passing("IiHhTo", 0) | {"R": [("o", 0.0, 1)]}, 1: _passing("ihTo", 1) | {"R": [("o", 0.0, 1)], "I": [("r", 0.0, 1)], "H": [("p", 0.0, 1)]}}, 0, {0, 1})


def threat() -> Transducer:
    """H, h and p are threats X, y and z if a target follows within REACH words, else nothing; states that wait for the
    target are not final."""
    arcs = {0: _passing("IirTo", 0)}
    for k in range(1, REACH + 1):
        arcs[k] = {"T": [("T", 0.0, 0)]} | (_passing("Iiro", k - 1) | {x: [("o", 0.0, k - 1)] for x in "Hhp"} if k > 1 else {})
    for x, y in zip("Hhp", "Xyz", strict=True):
        arcs[0][x] = [("o", 0.0, 0), (y, 0.0, REACH)]
    return Transducer(arcs, 0, {0})


def target() -> Transducer:
    """I becomes t if its clause has a target before or after it; the state that waits for one is not final."""
    arcs = {0: _passing("irXyzo", 0) | {"T": [("o", 0.0, 1)], "I": [("I", 0.0, 0), ("t", 0.0, 2)]}}
    arcs |= {k: _passing("irXyzo", k) | {"T": [("o", 0.0, 1)], "I": [("t", 0.0, k)]} for k in (1, 2)}
    return Transducer(arcs, 0, {0, 1})


KINDS = ("plain", "targeted", "negated", "reported", "threat")
#: What each symbol that may match is called.
MATCHES = {"I": "plain", "t": "targeted", "i": "negated", "y": "negated", "r": "reported", "z": "reported", "X": "threat"}
#: Factors of the kinds before anything is learned; learning scales them and keeps their order.
FACTORS = (1.0, 1.3, 0.3, 0.5, 1.2)


def scorer(factors: Iterable[float]) -> Transducer:
    """Picks one match of a clause, with its kind and the logarithm of the kind's factor; state: whether one is picked."""
    by = dict(zip(KINDS, factors, strict=True))
    skip = lambda to: {x: [(None, 0.0, to)] for x in [*MATCHES, "o"]}
    arcs = {0: skip(0), 1: skip(1)}
    for x, kind in MATCHES.items():
        if by[kind] > 0:
            arcs[0][x] = [*arcs[0][x], (kind, math.log(by[kind]), 1)]
    return Transducer(arcs, 0, {1})


class Grammar:
    """The lexicon and the composition negation, reported speech, threat, target, scorer, run over clauses.

    lexicon maps a word, or a beginning with *, to its weight; a word may have several symbols. A clause's match is the
    heaviest path's: the largest product of a word's weight and its kind's factor. factors are those of KINDS.
    """

    def __init__(self, lexicon: dict[str, float], bias: float = -2.0, factors: Iterable[float] = FACTORS) -> None:
        self.lexicon, self.bias, self.factors = lexicon, bias, tuple(factors)
        self._finder: ahocorasick.Automaton | None = None
        self._machine = negation().then(reported()).then(threat()).then(target()).then(scorer(self.factors)).numbered()

    def weight(self, word: str) -> float:
        best = self.lexicon.get(word, 0.0)
        for n in STEMS:
            if len(word) > n:
                best = max(best, self.lexicon.get(word[:n] + "*", 0.0))
        return best

    def symbols(self, word: str) -> list[tuple[str, float]]:
        """The lexicon transducer's outputs for a word, with its weight."""
        out = [("I", w)] if (w := self.weight(word)) > 0 else []
        out += [(x, 1.0) for x, words in (("H", THREATS), ("T", TARGETS), ("N", NEGATIONS), ("R", REPORTS)) if word in words]
        return out or [("o", 1.0)]

    def clause(self, words: list[str]) -> tuple[str, float] | None:
        """The clause's strongest match as (kind, lexicon weight), None without one."""
        m = self._machine
        best: dict[int, tuple[float, str | None, float]] = {m.start: (0.0, None, 0.0)}
        for word in words:
            read = self.symbols(word)
            ahead: dict[int, tuple[float, str | None, float]] = {}
            for state, (total, kind, weight) in best.items():
                for symbol, w in read:
                    for out, cost, to in m.arcs[state].get(symbol, ()):
                        step = (total, kind, weight) if out is None else (total + cost + math.log(w), out, w)
                        if to not in ahead or ahead[to][0] < step[0]:
                            ahead[to] = step
            best = ahead
        ends = [v for s, v in best.items() if s in m.finals]
        return max(ends)[1:] if ends else None

    def features(self, text: str) -> np.ndarray:
        """Sum of the matched clauses' weights by kind (square-rooted, so that length counts less)."""
        sums = dict.fromkeys(KINDS, 0.0)
        low = text.lower()
        if self._may_match(low):
            for part in _CLAUSE.split(low):
                if self._may_match(part) and (found := self.clause(_WORD.findall(part))):
                    sums[found[0]] += found[1]
        return np.sqrt(np.array([sums[k] for k in KINDS]))

    def score(self, text: str) -> float:
        x = self.bias + float(self.features(text) @ np.array(self.factors))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))

    def _may_match(self, text: str) -> bool:
        """Whether the text holds a string that could make the automaton emit anything."""
        if self._finder is None:
            self._finder = ahocorasick.Automaton()
            for k in {k.rstrip("*") for k in self.lexicon} | THREATS:
                self._finder.add_word(k, 1)
            self._finder.make_automaton()
        return next(self._finder.iter(text), None) is not None


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, ctx, n0): of toxic texts each key with the word before it (hashed), of clean texts each key's documents."""
    for b in batches:
        clean, toxic = Counter(), set()
        for t, y in zip(b.column("text"), b.column("toxic").to_pylist(), strict=True):
            words = _WORD.findall((t.as_py() or "").lower())
            if y:
                for before, w in set(zip(["", *words], words, strict=False)):
                    ctx = zlib.crc32(before.encode())
                    toxic.update((k, ctx) for k in keys_of((w,)))
            else:
                clean.update(keys_of(set(words)))
            if len(clean) + len(toxic) > 500_000:
                yield _counts(clean, toxic)
                clean, toxic = Counter(), set()
        yield _counts(clean, toxic)


def _counts(clean: Counter, toxic: set[tuple[str, int]]) -> pa.RecordBatch:
    keys = [*clean, *(k for k, _ in toxic)]
    ctx = [None] * len(clean) + [c for _, c in toxic]
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(ctx, pa.int64()), pa.array([*clean.values(), *[0] * len(toxic)], pa.int64())], ["key", "ctx", "n0"])


def _feature_batches(batches: Iterator[pa.RecordBatch], lexicon: dict[str, float]) -> Iterator[pa.RecordBatch]:
    grammar = Grammar(lexicon)
    for b in batches:
        x = [grammar.features(t.as_py() or "").tolist() for t in b.column("text")]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column("toxic")], ["x", "toxic"])


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, toxic) of about sample labelled documents at most, chosen by a hash of doc_id among those not held out.

    A doc_id that repeats counts once, as toxic if any of its labels says so, with the least of its texts.
    """
    known = labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out("doc_id")).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    picked = stage_table(known.where(in_share("doc_id", sample, known.count())), "picked")
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).join(picked, "doc_id")
    return stage_table(rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic"), "labelled")


def learn(rows: DataFrame) -> Grammar:
    """Labelled texts (text, toxic) -> grammar.

    Lexicon: keys are counted by label in Spark, in toxic texts once for each word that stands before them, so that
    copies of one text count once. A key is kept if chance among all keys is unlikely (CHANCE of them), with its
    log-odds as weight; no word is known beforehand. Then the factors and the bias are fitted over the clause features.
    What comes to the driver is bounded by the labelled rows: keys that occur often enough in the toxic ones, and five
    numbers a row. Without both labels there is no lexicon, and only threats against a target match.
    """
    ship_package(rows.sparkSession)
    size = rows.agg(F.sum((F.col("toxic") == 0).cast("int")).alias("n0"), F.sum("toxic").alias("n1")).first()
    n0, n1 = size["n0"] or 0, size["n1"] or 0
    if not n1 or not n0:
        return Grammar({})
    pairs = rows.mapInArrow(_count_batches, "key string, ctx long, n0 long").groupBy("key", "ctx").agg(F.sum("n0").alias("n0"))
    counts = pairs.groupBy("key").agg(F.sum("n0").alias("n0"), F.count("ctx").alias("n1"))
    counts = stage_table(counts.where("n1 > 1"), "lexicon")
    total = counts.count()
    enough = math.log(max(1, total) / CHANCE) / math.log((n0 + n1) / n1)
    weight = F.log((F.col("n1") + 0.1) / (n1 + 1)) - F.log((F.col("n0") + 0.1) / (n0 + 1))
    kept = counts.where((F.col("n1") >= enough) & (F.col("n1") / n1 > 30 * F.col("n0") / n0)).select("key", "n1", weight.alias("w")).where("w > 3")
    found = {r["key"]: (r["w"], r["n1"]) for r in kept.collect()}
    lexicon = {k: w for k, (w, _) in found.items() if not k.endswith("*") or not _one_word(k, found)}
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _feature_batches(batches, shared.value)

    table = rows.mapInArrow(run, "x array<double>, toxic int").collect()
    x, y = np.array([r["x"] for r in table]), np.array([r["toxic"] for r in table], float)
    bias, factors = fit_factors(x, y)
    return Grammar(lexicon, bias, factors)


def _one_word(stem: str, found: dict[str, tuple[float, int]]) -> bool:
    """A beginning stands for a family of words: one that a single word explains is left to that word."""
    return any(found[stem][1] <= 1.2 * m for w, (_, m) in found.items() if not w.endswith("*") and w.startswith(stem[:-1]))


def fit_factors(x: np.ndarray, y: np.ndarray, rounds: int = 40, hold: float = 3.0) -> tuple[float, list[float]]:
    """(bias, factors) by logistic regression: one scale for FACTORS, and a deviation for each kind that a ridge holds
    back, so that kinds with few rows keep their proportion. Then negated is kept at most reported, that at most plain
    and that at most targeted."""
    ratios = np.array(FACTORS)
    design = np.hstack(((x @ ratios)[:, None], np.ones((len(x), 1)), x))
    mean = np.array([1.0, -3.0, *[0.0] * len(ratios)])
    ridge = np.array([0.1, 0.1, *[hold] * len(ratios)])
    w = mean.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + np.diag(ridge), design.T @ (p - y) + ridge * (w - mean))
        w = w - np.clip(step, -1, 1)
    f = dict(zip(KINDS, np.maximum(w[0] * ratios + w[2:], 0.0).tolist(), strict=True))
    f["targeted"] = max(f["targeted"], f["plain"])
    f["reported"] = min(f["reported"], f["plain"])
    f["negated"] = min(f["negated"], f["reported"])
    return float(w[1]), [f[k] for k in KINDS]


def held_out(name: str) -> F.Column:
    """crc32 of the id as text, mod 5, is 0."""
    return F.coalesce((F.crc32(F.col(name).cast("bigint").cast("string").cast("binary")) % 5) == 0, F.lit(False))


_BUILT: dict[str, Grammar] = {}


def _score_batches(batches: Iterator[pa.RecordBatch], key: str, spec: tuple, column: str) -> Iterator[pa.RecordBatch]:
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Grammar(*spec)
    grammar = _BUILT[key]
    for b in batches:
        scores = [grammar.score(t.as_py() or "") for t in b.column("text")]
        yield b.append_column(column, pa.array(scores, pa.float64()))


def scored(docs: DataFrame, grammar: Grammar, column: str = "toxicity") -> DataFrame:
    """docs with one more column (0 to 1): the logistic of the matched clauses' weights.

    A text without a match (also an empty or null one) scores the logistic of the bias; one row per row, repeated ones
    too. A column of that name that docs has already gives way, so name another one to keep it. No shuffle.
    """
    ship_package(docs.sparkSession)
    key = uuid.uuid4().hex
    shared = docs.sparkSession.sparkContext.broadcast((grammar.lexicon, grammar.bias, grammar.factors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _score_batches(batches, key, shared.value, column)

    rows = docs.drop(column)
    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(column, DoubleType())]))


def op10_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns: doc_id, held_out, score, predicted."""
    grammar = learn(training_rows(docs, labels))
    return scored(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), grammar).select(
        "doc_id", held_out("doc_id").alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted")
    )
