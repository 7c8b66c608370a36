"""Comparing tables: multiset differences, fingerprints, quality gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def multiset_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with surplus = copies in a less copies in b; one shuffle for both sides."""
    if sorted(a.columns) != sorted(b.columns):
        raise ValueError(f"columns differ: {sorted(set(a.columns) ^ set(b.columns))}")
    names = a.columns
    tagged = a.withColumn("_t", F.lit(1)).unionAll(b.select(*names).withColumn("_t", F.lit(-1)))
    return tagged.groupBy(*names).agg(F.sum("_t").alias("surplus")).where("surplus <> 0")


def diff_count(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: differences, the rows on either side without a partner."""
    return multiset_diff(a, b).agg(F.coalesce(F.sum(F.abs("surplus")), F.lit(0)).cast("bigint").alias("differences"))


def equal(a: DataFrame, b: DataFrame) -> bool:
    return multiset_diff(a, b).isEmpty()


def parity_report(pairs: dict[str, tuple[DataFrame, DataFrame]], audit: dict[str, list[str]] | None = None) -> DataFrame:
    """(table_name, differences) of the tables that differ when their audit columns are left out."""
    audit = audit or {}
    parts = [diff_count(a.drop(*audit.get(n, [])), b.drop(*audit.get(n, []))).select(F.lit(n).alias("table_name"), "differences") for n, (a, b) in sorted(pairs.items())]
    return reduce(DataFrame.unionAll, parts).where("differences > 0")


def fingerprint(df: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """(row_count, fingerprint): a sum of row hashes, independent of order, that sees duplicates, nulls and positions."""
    kept = df.drop(*drop)
    row = F.to_json(F.struct(*kept.columns), {"ignoreNullFields": "false"})
    return kept.agg(F.count("*").alias("row_count"), F.coalesce(F.sum(F.xxhash64(row).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("string").alias("fingerprint"))


def schema_fingerprint(df: DataFrame) -> str:
    import hashlib

    return "sha256:" + hashlib.sha256("\n".join(f"{f.name} {f.dataType.simpleString()} {f.nullable}" for f in df.schema.fields).encode()).hexdigest()


def null_and_bounds(df: DataFrame, seq: str, keys: list[str] | None = None) -> DataFrame:
    """rows, nulls, first and last of a range column."""
    return df.groupBy(*(keys or [])).agg(F.count("*").alias("rows"), F.count_if(F.col(seq).isNull()).alias("nulls"), F.min(seq).alias("first_ledger"), F.max(seq).alias("last_ledger"))


def quality_gates(df: DataFrame, gates: dict[str, str]) -> DataFrame:
    """gates: name -> SQL condition that bad rows meet. One pass -> (gate, observed) of those that some row meets."""
    counts = df.agg(*[F.count_if(F.expr(c)).alias(n) for n, c in gates.items()])
    long = counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("gate"), F.col(n).alias("observed")) for n in gates])).alias("g")).select("g.*")
    return long.where("observed > 0")


def ordered_text(df: DataFrame, keys: list[str], item: str, order: str, sep: str = ",", flag: str | None = None, name: str = "items") -> DataFrame:
    """(keys, <name>, and has_flag with a condition): each key's items in order as one text, and whether any row meets flag.

    A key's text is one value, so its length is the key's size; ties in order stand by item. Null items are left out.
    """
    pairs = df.where(F.col(item).isNotNull()).select(*keys, F.col(order).alias("_o"), F.col(item).cast("string").alias("_i"))
    texts = pairs.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_o", "_i"))), lambda x: x["_i"]), sep).alias(name))
    if flag is None:
        return texts
    flags = df.groupBy(*keys).agg(F.coalesce(F.bool_or(F.expr(flag)), F.lit(False)).alias("has_flag"))
    cond = reduce(lambda x, y: x & y, [flags[k].eqNullSafe(texts[k]) for k in keys])
    return flags.join(texts, cond, "left").select(*[flags[k] for k in keys], texts[name], "has_flag")


def populated(tables: dict[str, DataFrame], columns: dict[str, list[str]]) -> DataFrame:
    """(table_name, column, problem) of columns that must exist and have a value somewhere; one pass per table."""
    parts = []
    for name, wanted in sorted(columns.items()):
        df = tables[name]
        there = [c for c in wanted if c in df.columns]
        absent = [(name, c, "no such column") for c in wanted if c not in df.columns]
        if absent:
            parts.append(df.sparkSession.createDataFrame(absent, "table_name string, column string, problem string"))
        if there:
            counts = df.agg(*[F.count(c).alias(c) for c in there])
            each = counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in there])).alias("x")).where("x.n = 0")
            parts.append(each.select(F.lit(name).alias("table_name"), "x.column", F.lit("never populated").alias("problem")))
    return reduce(DataFrame.unionAll, parts)
