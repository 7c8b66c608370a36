"""Replay-safe changes as DataFrames: what a table holds after a replace, an upsert or an insert."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def same_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality on all keys."""
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def replace_range(table: DataFrame, rows: DataFrame, seq: str, low: int, high: int, half_open: bool = False) -> DataFrame:
    """Rows of the range go (those with a null seq stay), the given rows come; given rows outside the range are refused."""
    inside = (F.col(seq) > low if half_open else F.col(seq) >= low) & (F.col(seq) <= high)
    kept = table.where(~F.coalesce(inside, F.lit(False)))
    checked = rows.withColumn(seq, F.when(inside, F.col(seq)).otherwise(F.raise_error(F.lit(f"{seq} outside the replaced range")).cast(rows.schema[seq].dataType)))
    return kept.unionByName(checked.select(*table.columns))


def replace_keys(table: DataFrame, rows: DataFrame, keys: list[str], gone: DataFrame | None = None) -> DataFrame:
    """Rows with any of the given rows' keys go (null equals null), all given rows come. gone are those keys, where the caller
    gets them at less cost than from rows."""
    gone = (rows if gone is None else gone).select(*keys).distinct()
    return table.join(gone, same_keys(table, gone, keys), "left_anti").unionByName(rows.select(*table.columns))


def upsert(table: DataFrame, rows: DataFrame, keys: list[str], by: str) -> DataFrame:
    """Each key's last given row (by `by`, then the largest row) replaces or joins the table's."""
    others = [c for c in table.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max(F.struct(F.col(by).alias("_by"), *others)).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])
    return replace_keys(table, last.select(*table.columns), keys)


def insert_if_absent(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Given rows whose keys the table lacks are added."""
    return table.unionByName(rows.join(table.select(*keys).distinct(), keys, "left_anti").select(*table.columns))


def enrich_last(rows: DataFrame, lookup: DataFrame, keys: list[str], position: str, columns: list[str]) -> DataFrame:
    """columns of the lookup's last row per key override those of rows; rows without a match keep theirs."""
    last = lookup.groupBy(*keys).agg(F.max(F.struct(F.col(position), *columns)).alias("_l"))
    joined = rows.join(last, keys, "left")
    kept = {c: F.when(F.col("_l").isNotNull(), F.col(f"_l.{c}")).otherwise(F.col(c) if c in rows.columns else F.lit(None)) for c in columns}
    return joined.withColumns(kept).drop("_l")
