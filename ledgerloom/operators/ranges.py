"""Sequence ranges: gaps, contiguity, duplicates, packing and splitting.

Windows are never over a whole table: they run inside range buckets, and what comes before a bucket is carried down a tree of
groups of buckets (`prefix.carried`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import RANGE_WIDTH, range_bucket
from ledgerloom.operators.prefix import carried


def neighbours(df: DataFrame, seq: str, keys: list[str] | None = None, width: int = RANGE_WIDTH) -> DataFrame:
    """Distinct (keys, seq) with prev, the next smaller seq of the same keys (null for the first).

    Inside a bucket by lag(); a bucket's first row takes the largest seq of the bucket before it.
    """
    keys = keys or []
    rows = df.where(F.col(seq).isNotNull()).select(*keys, F.col(seq).cast("bigint").alias(seq)).distinct().withColumn("_b", range_bucket(F.col(seq), width))
    edges = rows.groupBy(*keys, "_b").agg(F.max(seq).alias("_top"))
    edges = carried(edges, "_b", keys, maxes=("_top",)).select(*keys, "_b", F.col("_top_before").alias("_before"))
    inside = rows.withColumn("_prev", F.lag(seq).over(Window.partitionBy(*keys, "_b").orderBy(seq)))
    same = [inside[k].eqNullSafe(edges[k]) for k in [*keys, "_b"]]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    return inside.join(edges, cond).select(*[inside[k] for k in keys], inside[seq], F.coalesce("_prev", "_before").alias("prev"))


def gap_ranges(df: DataFrame, seq: str, keys: list[str] | None = None, width: int = RANGE_WIDTH) -> DataFrame:
    """(keys, gap_start, gap_end) of the missing numbers between the smallest and the largest present one."""
    near = neighbours(df, seq, keys, width)
    return near.where(F.col(seq) > F.col("prev") + 1).select(*(keys or []), (F.col("prev") + 1).alias("gap_start"), (F.col(seq) - 1).alias("gap_end"))


def gap_ledgers(df: DataFrame, seq: str, keys: list[str] | None = None, width: int = RANGE_WIDTH) -> DataFrame:
    """Every missing number; long gaps are cut into chunks first, so no row explodes into more than width rows."""
    chunks = gap_ranges(df, seq, keys, width).withColumn("_a", F.explode(F.sequence("gap_start", "gap_end", F.lit(width).cast("bigint"))))
    return chunks.select(*(keys or []), F.explode(F.sequence("_a", F.least(F.col("_a") + width - 1, "gap_end"))).alias(seq))


def contiguity_violations(df: DataFrame, seq: str, keys: list[str] | None = None, width: int = RANGE_WIDTH) -> DataFrame:
    """(keys, seq, expected): numbers that do not follow their predecessor."""
    return neighbours(df, seq, keys, width).where(F.col(seq) != F.col("prev") + 1).select(*(keys or []), seq, (F.col("prev") + 1).alias("expected"))


def is_contiguous(df: DataFrame, seq: str) -> Column:
    """As an aggregate: no gap and no duplicate."""
    return (F.max(seq) - F.min(seq) + 1 == F.count(seq)) & (F.count(seq) == F.count_distinct(seq))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def first_seen_duplicates(df: DataFrame, key: str, line: str) -> DataFrame:
    """(key, line, first_line): repeats of a key with where it was seen first; a join, so a hot key may be split."""
    first = df.groupBy(key).agg(F.min(line).alias("first_line"), F.count("*").alias("_n")).where("_n > 1").select(F.col(key).alias("_k"), "first_line")
    return df.join(first, df[key].eqNullSafe(first["_k"])).where(F.col(line) > F.col("first_line")).select(key, line, "first_line")


def continuity_report(df: DataFrame, seq: str, keys: list[str], width: int = RANGE_WIDTH) -> DataFrame:
    """Per keys: ledgers, first, last, missing, gaps."""
    near = neighbours(df, seq, keys, width)
    step = F.col(seq) - F.col("prev") - 1
    return near.groupBy(*keys).agg(
        F.count("*").alias("ledgers"), F.min(seq).alias("first_ledger"), F.max(seq).alias("last_ledger"),
        F.coalesce(F.sum(step), F.lit(0)).cast("bigint").alias("missing"), F.count_if(step > 0).alias("gaps"),
    )


def split_half_open(df: DataFrame, low: str, high: str, size: int) -> DataFrame:
    """Rows with bounds (low, high] -> one row per chunk (chunk_start, chunk_end]; an empty range gives one empty chunk."""
    starts = F.when(F.col(high) > F.col(low), F.sequence(F.col(low), F.col(high) - 1, F.lit(size).cast("bigint"))).otherwise(F.array(low))
    return df.withColumn("chunk_start", F.explode(starts)).withColumn("chunk_end", F.least(F.col("chunk_start") + size, F.col(high)))


def split_inclusive(df: DataFrame, low: str, high: str, size: int) -> DataFrame:
    """Rows with bounds [low, high] -> one row per chunk [chunk_start, chunk_end]."""
    return df.where(F.col(high) >= F.col(low)).withColumn("chunk_start", F.explode(F.sequence(low, high, F.lit(size).cast("bigint")))).withColumn("chunk_end", F.least(F.col("chunk_start") + (size - 1), F.col(high)))


def shard_split(df: DataFrame, low: str, high: str, shards: int) -> DataFrame:
    """[low, high] over shards whose sizes differ by one at most, the larger ones first; no shard is empty."""
    n = F.col(high) - F.col(low) + 1
    used = F.least(F.lit(shards).cast("bigint"), n)
    base, extra = F.floor(n / used), n % used
    k = F.col("shard")
    out = df.where(n > 0).withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), used - 1)))
    return out.withColumn("shard_start", (F.col(low) + k * base + F.least(k, extra)).cast("bigint")).withColumn("shard_end", (F.col("shard_start") + base + F.when(k < extra, 0).otherwise(-1)).cast("bigint"))


def coverage_violations(entries: DataFrame, start: str, end: str, low: int, high: int, width: int = RANGE_WIDTH) -> DataFrame:
    """(start, end, problem) of manifest entries that do not cover [low, high] end to end.

    Entries are ordered inside range buckets of their start; the last entry before a bucket and the first one after it are
    carried to it. Null bounds are an error of their own.
    """
    e = entries.select(start, end).where(F.col(start).isNotNull() & F.col(end).isNotNull()).withColumn("_b", range_bucket(F.col(start), width))
    order = Window.partitionBy("_b").orderBy(start, end)
    edges = e.groupBy("_b").agg(F.max(F.struct(F.col(start).alias("s"), F.col(end).alias("e"))).alias("_last"), F.max(-F.col(start)).alias("_first"))
    before = carried(edges, "_b", maxes=("_last",)).select("_b", F.col("_last_before")["e"].alias("_before"))
    after = carried(edges.select((-F.col("_b")).alias("_b"), "_first"), "_b", maxes=("_first",)).select((-F.col("_b")).alias("_b"), (-F.col("_first_before")).alias("_after"))
    near = e.withColumn("_p", F.lag(end).over(order)).withColumn("_n", F.lead(start).over(order)).join(before, "_b").join(after, "_b")
    near = near.withColumns({"_prev": F.coalesce("_p", "_before"), "_next": F.coalesce("_n", "_after")})
    problem = (
        F.when(F.col(end) < F.col(start), "ends before it starts")
        .when(F.col("_prev").isNull() & (F.col(start) != low), "does not start the range")
        .when(F.col(start) > F.col("_prev") + 1, "leaves a gap")
        .when(F.col(start) <= F.col("_prev"), "overlaps")
        .when(F.col("_next").isNull() & (F.col(end) != high), "does not end the range")
    )
    found = near.withColumn("problem", problem).where(F.col("problem").isNotNull()).select(start, end, "problem")
    return found.unionAll(entries.where(F.col(start).isNull() | F.col(end).isNull()).select(start, end, F.lit("has no bounds").alias("problem")))


def batch_violations(df: DataFrame, seq: str, network: str, width: int = RANGE_WIDTH) -> DataFrame:
    """(seq, problem) of a batch that must be one run of ledgers, each once, of the first ledger's network (null is none)."""
    copies = df.where(F.col(seq).isNotNull()).groupBy(seq).agg(F.count("*").alias("_n")).where("_n > 1").select(seq, F.lit("repeated").alias("problem"))
    holes = contiguity_violations(df, seq, width=width).select(seq, F.lit("does not follow").alias("problem"))
    first = df.agg(F.min_by(network, seq).alias("_network"))  # one row
    other = df.join(F.broadcast(first), ~F.col(network).eqNullSafe(F.col("_network")) | F.col(network).isNull()).where(F.col(seq).isNotNull()).select(seq, F.lit("another network").alias("problem")).distinct()
    return copies.unionAll(holes).unionAll(other).unionAll(df.where(F.col(seq).isNull()).select(seq, F.lit("no ledger").alias("problem")).distinct())


def range_descriptors(rows: DataFrame, group: str, seq: str, payload: str) -> DataFrame:
    """Per group: ledger_start, ledger_end, ledgers, bytes, rows, peak_bytes, peak_rows (of one ledger), payload_sha256.

    The digest goes over the ledgers' digests in their order, and a ledger's over its payloads' digests, sorted; so a
    task holds one digest a row of one ledger, then one a ledger of one group.
    """
    one = rows.groupBy(group, seq).agg(
        F.sum(F.octet_length(payload)).cast("bigint").alias("b"), F.count("*").alias("r"),
        F.sha2(F.array_join(F.array_sort(F.collect_list(F.sha2(payload, 256))), ""), 256).alias("h"),
    )
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(F.col(seq).alias("s"), "h"))), lambda x: x["h"])
    return one.groupBy(group).agg(
        F.min(seq).alias("ledger_start"), F.max(seq).alias("ledger_end"), F.count("*").alias("ledgers"), F.sum("b").alias("bytes"), F.sum("r").alias("rows"),
        F.max("b").alias("peak_bytes"), F.max("r").alias("peak_rows"), F.sha2(F.array_join(ordered, ""), 256).alias("payload_sha256"),
    )


def take_after(df: DataFrame, seq: str, offset: int, count: int, width: int = RANGE_WIDTH) -> DataFrame:
    """Rows of the `count` ledgers after the first `offset` ones; too few are an error.

    One count per range bucket tells which two buckets hold the bounds; only those are sorted.
    """
    ledgers = df.where(F.col(seq).isNotNull()).select(F.col(seq).cast("bigint").alias("s")).distinct().withColumn("b", range_bucket(F.col("s"), width))
    sizes = ledgers.groupBy("b").agg(F.count("*").alias("n"))
    ends = carried(sizes, "b", sums=("n",)).select("b", F.col("n_before").alias("before"), (F.col("n_before") + F.col("n")).alias("upto"))
    bounds = []
    for place in (offset + 1, offset + count):
        at = ends.where((F.col("before") < place) & (F.col("upto") >= place)).first()
        if at is None:
            raise ValueError(f"fewer than {offset + count} ledgers")
        bounds.append(ledgers.where(F.col("b") == at["b"]).orderBy("s").offset(place - at["before"] - 1).limit(1).first()["s"])
    return df.where(F.col(seq).between(*bounds))
