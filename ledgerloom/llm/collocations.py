"""Phrase collocation mining: an FM-index over word ids per shard, extended in both directions and summed across shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import ship_package, stage_table

#: Words of the longest phrase, occurrences that a candidate needs, and phrases that a language's report has.
LONGEST, LEAST, TOP = 5, 100, 2000
#: Words that a shard indexes at once; a task makes as many shards as its rows need.
SHARD_WORDS = 500_000
#: Bytes of text that are cut into words at once.
SLICE_BYTES = 1 << 20
#: Phrases that a task gathers before it packs them, and words of the corpus for each part that phrases are dealt to: a task sums
#: one part at a time, in about 250 bytes for each phrase that it was sent.
HELD, PART_WORDS, LEAST_PARTS = 200_000, 4_000_000, 64
#: Bits of a filter of frequent words or pairs, at most (32 MB); a fuller filter lets more rare phrases through to be
#: counted and dropped, it never loses one.
MOST_BITS = 1 << 28
#: A language's candidates are ranked in so many parts first.
PARTS = 64

_PIECE_EDGE = r"[.,;:!?\x0A-\x0D]"
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SHARD = "sign int, langs array<string>, totals array<long>, lang_of binary, words array<string>, forward binary, backward binary"
_PACKED = "part long, lang string, rows long, payload binary"
_GRAM = "lang string, words int, phrase string, n long, left_n long, right_n long"


# --- texts to shards


def _pieces(texts: pa.Array, langs: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Texts -> all their words, and for each piece that has words their number and the language's code."""
    parts = pc.split_pattern_regex(pc.ascii_lower(texts), _PIECE_EDGE)
    owner = np.repeat(langs, pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    cut = pc.ascii_split_whitespace(parts.flatten())  # of white space only space and tab are left
    words = cut.flatten()
    real = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False))
    upto = np.concatenate((np.zeros(1, np.int64), np.cumsum(real)))
    lens = np.diff(upto[np.concatenate((np.zeros(1, np.int64), ends))])
    return words.filter(pa.array(real)), lens[lens > 0], owner[lens > 0]


def _portions(words: pa.Array, lens: np.ndarray, langs: np.ndarray, most: int) -> Iterator[tuple[int, pa.Array, np.ndarray, np.ndarray]]:
    """(sign, words, lens, langs) of at most `most` words each. Pieces are kept whole; a longer one is cut into stretches that
    overlap by LONGEST - 1 words, and what lies inside an overlap, counted twice, is taken off once by a portion of sign -1."""
    if len(words) <= most:
        yield 1, words, lens, langs
        return
    starts, lap = np.cumsum(lens) - lens, LONGEST - 1
    at = 0
    while at < len(lens):
        to = max(at + 1, int(np.searchsorted(starts + lens, starts[at] + most, "right")))
        if to == at + 1 and lens[at] > most:
            first, laps = starts[at], []
            for begin in range(0, int(lens[at]) - lap, most - lap):
                n = min(most, int(lens[at]) - begin)
                yield 1, words.slice(first + begin, n), np.array([n]), langs[at : at + 1]
                laps += [words.slice(first + begin, lap)] if begin else []
            yield -1, pa.concat_arrays(laps), np.full(len(laps), lap), np.repeat(langs[at : at + 1], len(laps))
        else:
            end = starts[to - 1] + lens[to - 1]
            yield 1, words.slice(starts[at], end - starts[at]), lens[at:to], langs[at:to]
        at = to


def _order(seq: np.ndarray, depth: int) -> np.ndarray:
    """Positions of a circular sequence, sorted by the depth symbols from each on: patterns up to that length have one
    interval each, and ties stand by position."""
    rank, have = seq.astype(np.int32), 1
    while True:
        step = min(have, depth - have)
        key = rank * np.int64(int(rank.max()) + 1) + np.roll(rank, -step)
        order = np.argsort(key, kind="stable")
        have += step
        if have >= depth:
            return order
        key = key[order]
        rank[order] = np.cumsum(np.concatenate(([0], key[1:] != key[:-1])))


def _pack(x: np.ndarray) -> bytes:
    """Byte planes compress well, as high bytes are mostly zero."""
    return zstandard.ZstdCompressor(level=1).compress(x.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpack(b: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    return planes.reshape(4, -1).T.copy().view("<i4").ravel()


def _shard(sign: int, words: pa.Array, lens: np.ndarray, langs: np.ndarray, names: list[str]) -> pa.RecordBatch:
    """One row: the Burrows-Wheeler transforms of the pieces' word ids read forward and backward, 0 between pieces.

    An id stands for a word of a language, so that phrases of several languages share an index and never mix.
    """
    coded = words.dictionary_encode()
    v = len(coded.dictionary)
    code = np.repeat(langs.astype(np.int64), lens) * v + coded.indices.to_numpy(zero_copy_only=False)
    kinds, ids = np.unique(code, return_inverse=True)
    seq = np.zeros(len(ids) + len(lens), np.int32)
    seq[np.arange(len(ids)) + np.repeat(np.arange(1, len(lens) + 1), lens)] = ids + 1
    bwts = [_pack(s[_order(s, LONGEST) - 1]) for s in (seq, seq[::-1].copy())]
    lang_of = kinds // v
    totals = np.bincount(np.repeat(langs, lens), minlength=len(names)) * sign
    columns = [[sign], [names], [totals.tolist()], [_pack(lang_of)], None, [bwts[0]], [bwts[1]]]
    kinds_of = [pa.int32(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary(), None, pa.binary(), pa.binary()]
    own = coded.dictionary.take(pa.array(kinds % v))
    arrays = [pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own) if c is None else pa.array(c, k) for c, k in zip(columns, kinds_of, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["sign", "langs", "totals", "lang_of", "words", "forward", "backward"])


def _shards(most: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        names: dict[str, int] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if size:
                words, lens, langs = pa.concat_arrays([h[0] for h in held]), *(np.concatenate([h[i] for h in held]) for i in (1, 2))
                held.clear()
                for sign, *part in _portions(words, lens, langs, most):
                    yield _shard(sign, *part, list(names))

        for b in batches:
            texts, langs = b.column("text"), b.column("lang").to_pylist()
            lengths = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
            at = 0
            while at < len(texts):
                before = lengths[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(lengths, before + SLICE_BYTES, "right")))
                codes = np.array([names.setdefault(x, len(names)) for x in langs[at:to]], np.int64)
                held.append(_pieces(texts.slice(at, to - at), codes))
                size += len(held[-1][0])
                at = to
                if size >= most:
                    yield from flush()
                    names, size = {}, 0
        yield from flush()

    return make


def index_shards(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The shards' indexes, stored: a row for about every shard_words words of an input partition. Nothing is shuffled."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    return stage_table(rows.mapInArrow(_shards(shard_words), _SHARD), "fm-shards")


# --- shards to counted phrases


def _word_hashes(langs: list[str], words: list[str]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(f"{g} {w}") for g, w in zip(langs, words, strict=True)), np.uint64, len(words))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = a * _K1 + b
    return (h ^ (h >> np.uint64(29))) * _K2


def _has(bits: np.ndarray | None, h: np.ndarray) -> np.ndarray:
    if bits is None:
        return np.ones(len(h), bool)
    at = (h >> np.uint64(7)) & np.uint64(len(bits) * 64 - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


class _Side:
    """One direction's transform: which symbol stands before each row, where its row goes, and how many rows have none."""

    def __init__(self, bwt: np.ndarray):
        self.bwt = bwt
        self.edges = np.concatenate((np.zeros(1, np.int32), np.cumsum(bwt == 0, dtype=np.int32)))
        self.to = np.empty(len(bwt), np.int32)
        self.to[np.argsort(bwt, kind="stable")] = np.arange(len(bwt), dtype=np.int32)

    def neighbours(self, lo: np.ndarray, size: np.ndarray) -> np.ndarray:
        return size - (self.edges[lo + size] - self.edges[lo])


def _extend(side: _Side, lo: np.ndarray, size: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Every extension of the intervals by one symbol: (interval, symbol, its start in this direction, its size, its start in
    the other direction, which moves by the symbols that sort before it)."""
    begin = np.cumsum(size) - size
    of = np.repeat(np.arange(len(lo), dtype=np.int32), size)
    rows = np.arange(len(of), dtype=np.int32) + (lo - begin).astype(np.int32)[of]
    symbol = side.bwt[rows]
    key = of * np.int64(int(symbol.max(initial=0)) + 1) + symbol
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    at = order[first]
    return of[at], symbol[at], side.to[rows[at]], np.diff(np.append(first, len(key))), other[of[at]] + first - begin[of[at]]


def _grams_of(row: dict, shortest: int, longest: int, frequent: np.ndarray | None, pairs: np.ndarray | None) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]]:
    """(the phrases' word ids by place, occurrences, those with a word to the left, to the right) for each length, from
    intervals in both directions: by turns they grow to the right and to the left."""
    sides = {"left": _Side(_unpack(row["forward"])), "right": _Side(_unpack(row["backward"]))}
    counts = np.bincount(sides["left"].bwt, minlength=len(row["words"]) + 1)
    begin = np.cumsum(counts) - counts
    h = np.concatenate((np.zeros(1, np.uint64), row["hashes"]))
    ids = np.flatnonzero(_has(frequent, h) & (np.arange(len(h)) > 0) & (counts > 0))
    words, size = [ids], counts[ids]
    lo = {"left": begin[ids], "right": begin[ids]}
    for n in range(1, longest + 1):
        if n > 1:
            way, back = ("right", "left") if n % 2 == 0 else ("left", "right")
            of, symbol, here, size, there = _extend(sides[way], lo[way], size, lo[back])
            pair = (words[-1][of], symbol) if way == "right" else (symbol, words[0][of])
            stays = symbol > 0
            stays &= _has(pairs, _pair(h[pair[0]], h[pair[1]])) if pairs is not None else _has(frequent, h[symbol])
            of, symbol, size = of[stays], symbol[stays], size[stays]
            lo = {way: here[stays], back: there[stays]}
            words = [w[of] for w in words]
            words = [*words, symbol] if way == "right" else [symbol, *words]
        if n >= shortest:
            none = np.zeros(len(size), np.int64)  # of the longest nobody asks how it goes on
            yield words, size, *((none, none) if n == LONGEST else (sides[x].neighbours(lo[x], size) for x in ("left", "right")))


def _packed(parts: np.ndarray, langs: np.ndarray, names: list[str], phrases: pa.Array, numbers: np.ndarray) -> pa.RecordBatch:
    """Phrases with their numbers -> a compressed row per (part, language). A phrase has no line end, so one separates them."""
    order = np.lexsort((langs, parts))
    parts, langs, numbers = parts[order], langs[order], numbers[:, order]
    first = np.flatnonzero(np.concatenate(([True], (parts[1:] != parts[:-1]) | (langs[1:] != langs[:-1]))))
    edges = np.append(first, len(order))
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), phrases.take(pa.array(order))), "\n").to_pylist()
    pack = zstandard.ZstdCompressor(level=3).compress
    rows = [pack(np.ascontiguousarray(numbers[:, a:b]).tobytes() + t.encode()) for a, b, t in zip(edges, edges[1:], texts, strict=False)]
    columns = [pa.array(parts[first], pa.int64()), pa.array([names[x] for x in langs[first]]), pa.array(np.diff(edges), pa.int64()), pa.array(rows, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["part", "lang", "rows", "payload"])


def _grams(shortest: int, longest: int, parts: int, frequent, pairs):
    """frequent, pairs: broadcast filters, or None for no filter."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, met = (x and x.value for x in (frequent, pairs))
        names: dict[str, int] = {}
        held: list[tuple] = []
        size = 0
        for b in batches:
            for i in range(len(b)):
                row = {c: b.column(c)[i].as_py() for c in ("sign", "langs", "lang_of", "forward", "backward")}
                words, lang_of = b.column("words")[i].values, _unpack(row["lang_of"])
                row |= {"words": words, "hashes": _word_hashes([row["langs"][x] for x in lang_of], words.to_pylist())}
                own = np.array([names.setdefault(x, len(names)) for x in row["langs"]], np.int64)[lang_of]
                for ids, *numbers in _grams_of(row, shortest, longest, known, met):
                    hashed = np.zeros(len(ids[0]), np.uint64)
                    for x in ids:
                        hashed = _pair(hashed, row["hashes"][x - 1])
                    phrase = pc.binary_join_element_wise(*(words.take(pa.array(x - 1)) for x in ids), " ")
                    held.append(((hashed >> np.uint64(20)) % np.uint64(parts), own[ids[0] - 1], phrase, np.array(numbers, np.int64) * row["sign"]))
                    size += len(phrase)
                    if size >= HELD:
                        yield _packed(*_together(held, names))
                        held, size = [], 0
                del row, words, own
                pa.default_memory_pool().release_unused()  # idle workers keep what they hold
        if size:
            yield _packed(*_together(held, names))

    return make


def _together(held: list[tuple], names: dict[str, int]) -> tuple:
    parts, langs, phrases, numbers = zip(*held, strict=True)
    return np.concatenate(parts).astype(np.int64), np.concatenate(langs), list(names), pa.concat_arrays(phrases), np.concatenate(numbers, axis=1)


def _sums(least: int):
    """Rows sorted by part -> each part's phrases with their numbers summed, those with at least `least` occurrences."""

    def whole(tables: list[pa.Table]) -> pa.Table:
        t = pa.concat_tables(tables).group_by(["lang", "phrase"]).aggregate([(c, "sum") for c in ("n", "left_n", "right_n")])
        return t.rename_columns([c.removesuffix("_sum") for c in t.column_names])

    def read(packs: list[tuple[int, int, bytes]]) -> pa.Table:
        """Many packs are read as one, as a small one costs more than its phrases."""
        langs, rows = np.array([p[:2] for p in packs], np.int32).T
        raws = [zstandard.ZstdDecompressor().decompress(p[2]) for p in packs]
        numbers = np.concatenate([np.frombuffer(raw, np.int64, 3 * n).reshape(3, n) for raw, n in zip(raws, rows.tolist(), strict=True)], axis=1)
        phrases = pc.split_pattern(pa.array([b"\n".join(raw[24 * n :] for raw, n in zip(raws, rows.tolist(), strict=True)).decode()]), "\n").flatten()
        return pa.table([pa.array(np.repeat(langs, rows)), phrases, *map(pa.array, numbers)], ["lang", "phrase", "n", "left_n", "right_n"])

    def done(tables: list[pa.Table], names: dict[str, int]) -> Iterator[pa.RecordBatch]:
        t = whole(tables)
        t = t.filter(pc.greater_equal(t["n"], least))
        t = t.set_column(t.column_names.index("lang"), "lang", pa.array(list(names), pa.string()).take(t["lang"].combine_chunks()))
        t = t.append_column("words", pc.add(pc.count_substring(t["phrase"], " "), 1).cast(pa.int32()))
        yield from t.select(["lang", "words", "phrase", "n", "left_n", "right_n"]).to_batches()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, names, packs, tables, waiting, size, most = None, {}, [], [], 0, 0, 4 * HELD
        for b in batches:
            for part, lang, rows, payload in zip(*(b.column(c).to_pylist() for c in ("part", "lang", "rows", "payload")), strict=True):
                if packs and (part != now or waiting >= HELD):
                    tables.append(read(packs))
                    size += waiting
                    packs, waiting = [], 0
                    if size > most:  # twice what is left then, else a part of many different phrases is summed again for each pack
                        tables = [whole(tables)]
                        size = len(tables[0])
                        most = max(4 * HELD, 2 * size)
                if tables and part != now:
                    yield from done(tables, names)
                    names, tables, size, most = {}, [], 0, 4 * HELD
                now = part
                packs.append((names.setdefault(lang, len(names)), rows, payload))
                waiting += rows
        if packs:
            tables.append(read(packs))
        if tables:
            yield from done(tables, names)

    return make


def _positions(bits: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, phrases = b.column("lang").to_pylist(), [p.split(" ") for p in b.column("phrase").to_pylist()]
            h = _word_hashes(langs, [p[0] for p in phrases])
            if phrases and len(phrases[0]) == 2:
                h = _pair(h, _word_hashes(langs, [p[1] for p in phrases]))
            yield pa.RecordBatch.from_arrays([pa.array(((h >> np.uint64(7)) & np.uint64(bits - 1)).astype(np.int64))], ["at"])

    return make


def _filter_of(phrases: DataFrame):
    """A broadcast bit set of the phrases' hashes (all of one or all of two words): no more than MOST_BITS bits."""
    bits = 1 << 10
    want = min(MOST_BITS, 16 * phrases.count())
    while bits < want:
        bits *= 2
    at = phrases.select("lang", "phrase").mapInArrow(_positions(bits), "at long")
    words = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return phrases.sparkSession.sparkContext.broadcast(out)


def words_by_language(shards: DataFrame) -> DataFrame:
    """(lang, total), stored: all word occurrences."""
    each = shards.select(F.explode(F.arrays_zip("langs", "totals")).alias("t"))
    return stage_table(each.groupBy(F.col("t.langs").alias("lang")).agg(F.sum("t.totals").alias("total")), "words-by-language")


def frequent_phrases(shards: DataFrame, least: int = LEAST, longest: int = LONGEST, total: int | None = None) -> DataFrame:
    """(lang, words, phrase, n, left_n, right_n), stored: all phrases of up to `longest` words (single words too) that occur
    at least `least` times, with the occurrences that have a word before or after them in their piece (0 for LONGEST words).

    Three passes over the stored indexes: words; pairs of frequent words; longer phrases all of whose pairs are frequent.
    Frequent words and pairs reach the shards as filters of bounded size. In each pass phrases are dealt by a hash to parts, one
    for each PART_WORDS words of the corpus, and a task packs what it has for a part into compressed rows, which are a fraction
    of a row for each phrase; the task that has a part sums them. A very frequent phrase is one row from each task.
    """
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"phrases have 2 to {LONGEST} words")
    if total is None:
        total = words_by_language(shards).agg(F.sum("total")).first()[0] or 0
    parts = max(LEAST_PARTS, -(-total // PART_WORDS))

    def counted(a: int, b: int, *filters) -> DataFrame:
        packed = shards.select("sign", "langs", "lang_of", "words", "forward", "backward").mapInArrow(_grams(a, b, parts, *filters), _PACKED)
        return stage_table(packed.repartition("part").sortWithinPartitions("part").mapInArrow(_sums(least), _GRAM), "frequent-phrases")

    words = counted(1, 1, None, None)
    frequent = _filter_of(words)
    pairs = counted(2, 2, frequent, None)
    out = words.unionAll(pairs)
    return out.unionAll(counted(3, longest, frequent, _filter_of(pairs))) if longest > 2 else out


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, score, left_n, right_n): the candidates of two words and more that no longer
    candidate explains, scored by their weakest cut. All of them; the report's length is the caller's.

    Every part of a frequent phrase is frequent, so the parts of all cuts are among the counted phrases and an equality join
    finds them. A candidate is explained if a longer one that contains it occurs as often; then so does one of its
    extensions by a single word, so each phrase speaks against its own beginning and end only.

    Null texts are empty, null languages are `und`; texts without words, empty tables and other columns leave no trace.
    Repeated rows count as often as they stand. Texts and pieces of any length are indexed whole.
    """
    shards = index_shards(docs, shard_words)
    totals = words_by_language(shards)
    counted = frequent_phrases(shards, least, longest, totals.agg(F.sum("total")).first()[0] or 0)
    candidates = counted.where("words > 1")
    taken = lambda a, b: F.array_join(F.slice(F.split("phrase", " ", -1), a, b), " ")
    ends = candidates.where("words > 2").select("lang", F.col("n").alias("as_often"), F.explode(F.array(taken(F.lit(1), F.col("words") - 1), taken(F.lit(2), F.col("words") - 1))).alias("phrase"))
    explained = ends.groupBy("lang", "phrase").agg(F.max("as_often").alias("as_often"))
    open_ended = F.greatest("left_n", "right_n") == F.col("n")  # others cannot have an extension that occurs as often
    left = candidates.where(~open_ended | (F.col("words") == longest)).unionByName(
        candidates.where(open_ended & (F.col("words") < longest)).join(explained.withColumnRenamed("as_often", "n"), ["lang", "phrase", "n"], "left_anti")
    )
    cuts = left.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumns({"first": taken(F.lit(1), F.col("k")), "rest": taken(F.col("k") + 1, F.col("words") - F.col("k"))})
    known = counted.select(F.col("lang").alias("known_lang"), F.col("phrase").alias("known"), F.col("n").alias("f"))
    for part, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(known.withColumnRenamed("f", name), (F.col("lang") == F.col("known_lang")) & (F.col(part) == F.col("known"))).drop("known_lang", "known")
    big = lambda c: f"cast({c} as decimal(19, 0))"  # noqa: E731  a product of two has room in decimal(38, 0)
    score = F.expr(f"({big('1000 * n')} * {big('total')}) div ({big('l')} * {big('r')})")
    cuts = cuts.join(totals, "lang").withColumn("score", score)
    weakest = cuts.groupBy("lang", "phrase", "words", "n", "total", "left_n", "right_n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return weakest.select("lang", "phrase", "words", F.col("n").alias("a"), "cut.l", "cut.r", F.col("total").alias("n"), "cut.score", "left_n", "right_n")


def top_phrases(scored: DataFrame, top: int = TOP) -> DataFrame:
    """Each language's first phrases with their rank from 1: by score, occurrences (both descending) and phrase. A language
    is ranked in PARTS parts first, of which each hands on at most `top`, so that no task sorts all of a hot one."""
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    some = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*best))).where(F.col("rank") <= top)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("bigint")).where(F.col("rank") <= top)


def op11_collocations(docs: DataFrame) -> DataFrame:
    """The digest columns: lang, rank, phrase, a, l, r, n, score."""
    return top_phrases(collocations(docs)).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


OP11_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
cut as (select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') as ws from pieces),
grams as (
  select lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) as phrase
  from cut, (select unnest([1, 2, 3, 4, 5]) as k)),
f as (select lang, k, phrase, count(*) as f from grams group by all),
totals as (select lang, cast(sum(f) as bigint) as n from f where k = 1 group by lang),
candidates as (select * from f where k > 1 and f >= 100),
kept as (
  select * from candidates c where not exists (
    select 1 from candidates b where b.lang = c.lang and b.k > c.k and 100 * b.f >= 100 * c.f and contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' '))),
cuts as (
  select lang, phrase, f as a, k, unnest(range(1, k)) as place, string_split(phrase, ' ') as ws from kept),
scored as (
  select c.lang, c.phrase, c.a, c.place, x.f as l, y.f as r, t.n,
    cast((1000::hugeint * c.a * t.n) // (x.f::hugeint * y.f) as bigint) as score
  from cuts c join totals t using (lang)
  join f x on x.lang = c.lang and x.phrase = array_to_string(c.ws[1:c.place], ' ')
  join f y on y.lang = c.lang and y.phrase = array_to_string(c.ws[c.place + 1:], ' ')),
weakest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, place) = 1)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from weakest qualify rank <= 2000
"""
