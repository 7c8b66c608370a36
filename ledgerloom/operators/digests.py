"""Digests of tables and file sets of any size: a tree over the rows' own digests."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import half_open

#: Distinct rows that a leaf of the tree has on average, at most.
LEAF = 1024


def row_text(columns: list[str]) -> Column:
    """The columns as one text that tells null from empty and has no two readings: length:value, each."""
    each = [F.coalesce(F.concat(F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.concat_ws(",", *each)


def tree_digest(df: DataFrame, columns: list[str] | None = None, depth: int | None = None) -> DataFrame:
    """(rows, distinct_rows, digest): equal for equal multisets of rows, whatever their order, files or partitions.

    A row is its SHA-256 and the number of its copies. Rows that share the first `depth` hex digits make a leaf, whose digest
    is over its rows in order; sixteen digests at most make one of the level above. depth follows from the number of
    distinct rows unless it is given. No task has more than a leaf: hot rows are counted, not listed.
    """
    columns = columns or df.columns
    rows = df.select(F.sha2(row_text(columns), 256).alias("h")).groupBy("h").agg(F.count("*").alias("n"))
    counts = rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("distinct_rows"))
    if depth is None:
        depth = max(0, math.ceil(math.log(max(1, rows.count() / LEAF), 16)))
    listed = F.concat("h", F.lit(":"), F.col("n").cast("string"))
    for k in range(depth, -1, -1):
        prefix = F.substring("h", 1, k) if k == depth else F.substring("prefix", 1, k)
        item = listed if k == depth else F.concat("prefix", F.lit(":"), F.col("digest"))
        rows = rows.groupBy(prefix.alias("prefix")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(item)), ","), 256).alias("digest"))
    nothing = F.sha2(F.lit(""), 256)
    return counts.join(rows.select("digest"), how="left").select("rows", "distinct_rows", F.concat(F.lit("sha256:"), F.coalesce("digest", nothing)).alias("digest"))  # one row each


def range_digest(df: DataFrame, seq: str, low: int, high: int, drop: tuple[str, ...] = (), depth: int | None = None) -> DataFrame:
    """The same of the ledgers in (low, high], without the columns in drop."""
    return tree_digest(df.where(half_open(F.col(seq), low, high)), [c for c in df.columns if c not in drop], depth)


def generations_agree(a: DataFrame, b: DataFrame, leave_out: tuple[str, ...] = ("attempt", "worker", "uri", "started_at", "finished_at")) -> DataFrame:
    """(generation_a, generation_b, agree) of two attempts' file entries without attempt, place and time."""
    kept = sorted(c for c in a.columns if c not in leave_out)
    one, two = (tree_digest(df, kept).select(F.col("digest").alias(n)) for df, n in ((a, "generation_a"), (b, "generation_b")))
    return one.join(two).withColumn("agree", F.col("generation_a") == F.col("generation_b"))  # one row each
