"""Fill-in-the-middle transformation: cut offsets selected from a compressed set of the places where a text may be cut."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import ship_package

#: Marks of prefix, suffix and middle; of 100 documents KEEP are transformed, and SPM of those suffix first.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
KEEP, SPM = 90, 20
#: Offsets that share a container, and bytes of a bitmap container.
SPAN, BITMAP_BYTES = 1 << 16, 8192
#: Bytes of output that a task hands on at once.
BATCH_BYTES = 4 << 20


class BoundarySet:
    """The byte offsets of a UTF-8 text at which a code point begins, and its end, sorted into containers of SPAN offsets.

    Each container takes the smallest of three forms: an array of offsets, a bitmap of 64-bit words with the members before
    each word, or runs with the members before each run. `upto` has the members before each container, so the k-th offset
    is found by one binary search for the container and one inside it.
    """

    def __init__(self, text: bytes):
        data = np.frombuffer(text, np.uint8)
        member = np.ones(len(data) + 1, bool)
        member[:-1] = (data & 0xC0) != 0x80
        parts = [member[i : i + SPAN] for i in range(0, len(member), SPAN)]
        self.containers = [self._container(p) for p in parts]
        self.upto = np.concatenate((np.zeros(1, np.int64), np.cumsum([int(p.sum()) for p in parts])))

    @staticmethod
    def _container(member: np.ndarray) -> tuple[str, np.ndarray, np.ndarray]:
        edge = np.diff(np.concatenate(([0], member.view(np.int8), [0])))
        starts, n = np.flatnonzero(edge == 1), int(member.sum())
        if 2 + 4 * len(starts) <= min(2 * n, BITMAP_BYTES):
            lengths = np.flatnonzero(edge == -1) - starts
            return "run", starts, np.cumsum(lengths) - lengths
        if 2 * n <= BITMAP_BYTES:
            return "array", np.flatnonzero(member).astype(np.uint16), np.zeros(0, np.int64)
        words = np.packbits(np.pad(member, (0, -len(member) % 64)), bitorder="little").view("<u8")
        counts = np.bitwise_count(words).astype(np.int64)
        return "bitmap", words, np.cumsum(counts) - counts

    def __len__(self) -> int:
        return int(self.upto[-1])

    def select(self, k: int) -> int:
        """The k-th offset, from 0."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        c = int(np.searchsorted(self.upto, k, "right")) - 1
        k -= int(self.upto[c])
        kind, values, before = self.containers[c]
        if kind == "array":
            return c * SPAN + int(values[k])
        i = int(np.searchsorted(before, k, "right")) - 1
        k -= int(before[i])
        if kind == "run":
            return c * SPAN + int(values[i]) + k
        word = int(values[i])
        for _ in range(k):
            word &= word - 1
        return c * SPAN + i * 64 + (word & -word).bit_length() - 1


def _cut(text: str, a: int, b: int) -> tuple[int, int, int, str, str, str]:
    """(code points, prefix's and middle's code points, the three parts): the cuts lie after a % (n + 1) and b % (n + 1) code
    points, the smaller first."""
    data = text.encode()
    places = BoundarySet(data)
    n = len(places) - 1
    i, j = sorted((a % (n + 1), b % (n + 1)))
    x, y = places.select(i), places.select(j)
    return n, i, j - i, data[:x].decode(), data[x:y].decode(), data[y:].decode()


def _transformed(marks: tuple[str, str, str]):
    prefix_mark, suffix_mark, middle_mark = marks
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            size = 0
            for i in range(len(b)):
                doc, text, form, h1, h2 = (c[i].as_py() for c in b.columns)
                if form == "plain":
                    row = (doc, len(BoundarySet(text.encode())) - 1, form, None, None, text)
                else:
                    n, before, inside, prefix, middle, suffix = _cut(text, h1, h2)
                    parts = (prefix_mark, prefix, suffix_mark, suffix) if form == "psm" else (suffix_mark, suffix, prefix_mark, prefix)
                    row = (doc, n, form, before, inside, "".join((*parts, middle_mark, middle)))
                rows.append(row)
                size += len(text)
                if size > BATCH_BYTES or i == len(b) - 1:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
                    rows, size = [], 0

    return make


def fill_in_middle(docs: DataFrame, keep: int = KEEP, spm: int = SPM, seed: str = "1", marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): each row's whole text, cut in three and reordered.

    Cuts and form come from the SHA-256 of "seed:doc_id", so a row's result depends on its id and text only, and repeated rows
    get equal ones. Texts that are empty, null (counted as empty) or contain a mark stay plain, and so do 100 - keep of 100
    others. A null doc_id hashes as an empty one. Other columns are ignored. A row is handled by itself; nothing is shuffled.
    """
    ship_package(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc = F.col("doc_id").cast("bigint")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc.cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring("digest", 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]
    marked = (F.col("text") == "") | F.contains("text", F.lit(marks[0])) | F.contains("text", F.lit(marks[1])) | F.contains("text", F.lit(marks[2]))
    form = F.when(marked | (h[2] % 100 >= keep), "plain").when(h[3] % 100 < spm, "spm").otherwise("psm")
    rows = docs.select(doc.alias("doc_id"), text.alias("text"), digest.alias("digest")).select("doc_id", "text", form.alias("form"), h[0].alias("h1"), h[1].alias("h2"))
    return rows.mapInArrow(_transformed(marks), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: str = "output", form: str = "form", marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text of an output. A transformed text has no mark of its own, and as no mark ends as another begins, none can arise
    where parts meet, so each mark is found where it was set."""
    out = F.col(output)

    def rest(c: Column, mark: str) -> Column:
        return F.substr(c, F.instr(c, F.lit(mark)) + len(mark))

    def upto(c: Column, mark: str) -> Column:
        return F.substr(c, F.lit(1), F.instr(c, F.lit(mark)) - 1)

    psm, spm = rest(out, marks[0]), rest(out, marks[1])
    from_psm = F.concat(upto(psm, marks[1]), rest(psm, marks[2]), upto(rest(psm, marks[1]), marks[2]))
    from_spm = F.concat(upto(rest(spm, marks[0]), marks[2]), rest(spm, marks[2]), upto(spm, marks[0]))
    return F.when(F.col(form) == "psm", from_psm).when(F.col(form) == "spm", from_spm).otherwise(out)


def op12_fim(docs: DataFrame) -> DataFrame:
    """The digest columns: doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    out = fill_in_middle(docs)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"))


OP12_SQL = """
with d as (select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
e as (
  select doc_id, t, length(t) as n, cast('0x' || h[1:8] as bigint) as h1, cast('0x' || h[9:16] as bigint) as h2,
    cast('0x' || h[17:24] as bigint) as h3, cast('0x' || h[25:32] as bigint) as h4 from d),
f as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from e),
o as (
  select *, case form when 'plain' then t when 'psm' then '<P>' || substring(t, 1, a) || '<S>' || substring(t, b + 1) || '<M>' || substring(t, a + 1, b - a)
    else '<S>' || substring(t, b + 1) || '<P>' || substring(t, 1, a) || '<M>' || substring(t, a + 1, b - a) end as output from f)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
  sha256(output) as output_sha256, sha256(t) as restored_sha256 from o
"""
