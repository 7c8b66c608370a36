"""Exact quantiles by distributed selection, and quantiles of mergeable histograms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import stage_table

#: Value ranges that a cell is cut into in one round, and rows that one task may sort at the end.
BINS, SORTED = 4096, 65_536


def _met(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Null-safe join on keys; b's are dropped."""
    other = b.toDF(*[f"_r{keys.index(c)}" if c in keys else c for c in b.columns])
    joined = a.join(other, reduce(lambda x, y: x & y, [a[k].eqNullSafe(other[f"_r{i}"]) for i, k in enumerate(keys)]), how)
    return joined.drop(*[f"_r{i}" for i in range(len(keys))])


def _bin(v: Column, lo: Column, hi: Column) -> Column:
    """Number of the value's range, never falling as v grows: lo is in the first and hi in the last, if they differ."""
    x, low, high = (c.cast("double") for c in (v, lo, hi))
    share = F.when(v == lo, 0.0).when(v == hi, 1.0).when(F.isnan(x) | (x == float("inf")), 1.0).when(x == float("-inf"), 0.0)
    low, high = F.greatest(low, F.lit(-8e307)), F.least(high, F.lit(8e307))  # keeps the difference finite
    inside = F.least(F.greatest((x - low) / F.nullif(high - low, F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    return F.when(v == hi, BINS + 1).when(v == lo, 0).otherwise(F.lit(1) + F.floor(F.coalesce(share, inside, F.lit(0.5)) * (BINS - 1))).cast("int")


def exact_quantiles(df: DataFrame, value: str, quantiles: dict[str, float], keys: list[str] | None = None, most: int = SORTED) -> DataFrame:
    """(keys, <name> for each quantile): the nearest-rank quantile, the smallest value that has at least that share of the
    key's values at or below it; null where a key has no value. NaN is the largest value.

    Selection by refinement: counts per (key, value range) tell which range holds a rank, and only the rows of such ranges are
    read again, until a range has at most `most` rows, which one task ranks, or one value. A hot key is thus counted in the map
    tasks and its values are never gathered. Each round cuts ranges at their own smallest and largest value, so it ends.
    """
    keys = list(keys or [])
    spark = df.sparkSession
    k = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(c).alias(a) for c, a in zip(keys, k, strict=True)], F.lit("").alias("_cell"), F.col(value).alias("_v"))
    at = [*k, "_cell"]
    bounds = [F.count("_v").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]
    cells = stage_table(rows.groupBy(*at).agg(*bounds), "cells")
    wants = F.explode(F.array(*[F.struct(F.lit(name).alias("_q"), F.greatest(F.ceil(F.col("_n") * F.lit(q).cast("decimal(10,8)")), F.lit(1)).cast("bigint").alias("_rank")) for name, q in quantiles.items()]))
    wanted = cells.where("_n > 0").select(*at, "_n", "_lo", "_hi", wants.alias("w")).select(*at, "_n", "_lo", "_hi", "w._q", "w._rank")
    names, answers = cells.select(*k), []
    rows = rows.where(F.col("_v").isNotNull())
    while True:
        single = F.col("_lo").eqNullSafe(F.col("_hi"))
        answers.append(wanted.where(single).select(*k, "_q", F.col("_lo").alias("_a")))
        small = wanted.where(~single & (F.col("_n") <= most))
        ranked = _met(rows, small.select(*at).distinct(), at, "left_semi")
        ranked = ranked.withColumn("_rank", F.row_number().over(Window.partitionBy(*at).orderBy("_v")).cast("bigint"))
        answers.append(_met(small.select(*at, "_q", "_rank"), ranked, [*at, "_rank"]).select(*k, "_q", F.col("_v").alias("_a")))
        wanted = wanted.where(~single & (F.col("_n") > most))
        if wanted.isEmpty():
            break
        cut = _met(rows, wanted.select(*at, "_lo", "_hi").distinct(), at).withColumn("_bin", _bin(F.col("_v"), F.col("_lo"), F.col("_hi")))
        parts = cut.groupBy(*at, "_bin").agg(*bounds)
        parts = parts.withColumn("_upto", F.sum("_n").over(Window.partitionBy(*at).orderBy("_bin")))
        held = _met(wanted.select(*at, "_q", "_rank"), parts, at).where((F.col("_rank") <= F.col("_upto")) & (F.col("_rank") > F.col("_upto") - F.col("_n")))
        deeper = F.concat_ws("/", "_cell", F.col("_bin").cast("string"))
        held = stage_table(held.select(*k, "_cell", "_bin", "_n", "_lo", "_hi", "_q", (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_rank")), "cells")
        rows = _met(cut, held.where(~single).select(*at, "_bin").distinct(), [*at, "_bin"], "left_semi")
        rows = stage_table(rows.select(*k, deeper.alias("_cell"), "_v"), "cell-rows")
        wanted = held.withColumn("_cell", deeper).drop("_bin")
    found = reduce(DataFrame.unionByName, answers).withColumn("_one", F.lit(1))
    wide = found.groupBy(*k, "_one").pivot("_q", list(quantiles)).agg(F.first("_a"))
    if k:
        out = _met(names, wide.drop("_one"), k, "left")
    else:
        out = spark.range(1).select(F.lit(1).alias("_one")).join(wide, "_one", "left")
    return out.select(*[F.col(a).alias(c) for c, a in zip(keys, k, strict=True)], *quantiles)


def with_quantiles(summary: DataFrame, df: DataFrame, value: str, quantiles: dict[str, float], keys: list[str]) -> DataFrame:
    """One row per keys, of df's own grouping -> the same with its quantiles."""
    found = exact_quantiles(df, value, quantiles, keys)
    return _met(summary, found, keys) if keys else summary.crossJoin(found)  # one row each


def histogram(df: DataFrame, value: str, bounds: list[float], keys: list[str]) -> DataFrame:
    """(keys, le, n): how many values are at most le, for each of the rising bounds and infinity. Values are counted into their
    range in the map tasks, then a key's few ranges are added up. Null values are left out, NaN counts under infinity only."""
    edges = [float(b) for b in bounds]
    if edges != sorted(set(edges)):
        raise ValueError("bounds must rise")
    slot = reduce(lambda rest, b: F.when(F.col(value) <= b, F.lit(b)).otherwise(rest), reversed(edges), F.lit(float("inf")))
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, slot.alias("le")).agg(F.count("*").alias("n"))
    every = counts.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("le", "n"))).alias("m"))  # at most len(bounds) + 1 entries
    step = every.select(*keys, "m", F.explode(F.array(*map(F.lit, [*edges, float("inf")]))).alias("le")).withColumn("n", F.coalesce(F.try_element_at("m", F.col("le")), F.lit(0)))
    upto = Window.partitionBy(*keys).orderBy("le")
    return step.select(*keys, "le", F.sum("n").over(upto).cast("bigint").alias("n"))


def merged(histograms: DataFrame, keys: list[str]) -> DataFrame:
    """Cumulative histograms over the same bounds -> their sum for each of the coarser keys."""
    return histograms.groupBy(*keys, "le").agg(F.sum("n").cast("bigint").alias("n"))


def histogram_quantile(histograms: DataFrame, q: float, keys: list[str], name: str = "quantile") -> DataFrame:
    """(keys, n, <name>): the q-quantile that a cumulative histogram tells, on a straight line inside the range that holds it.

    The first range begins at 0, or at its bound if that is not above 0; a quantile in the last, open range is the largest
    finite bound, and that of no values is null.
    """
    order = Window.partitionBy(*keys).orderBy("le")
    h = histograms.withColumns({"_below": F.coalesce(F.lag("n").over(order), F.lit(0)), "_from": F.lag("le").over(order), "_all": F.max("n").over(Window.partitionBy(*keys))})
    rank = F.col("_all") * F.lit(float(q))
    start = F.coalesce("_from", F.when(F.col("le") > 0, F.lit(0.0)).otherwise(F.col("le")))
    inside = F.when(F.col("le") == float("inf"), F.col("_from")).otherwise(start + (F.col("le") - start) * F.try_divide(rank - F.col("_below"), F.col("n") - F.col("_below")))
    hit = F.when((F.col("n") >= rank) & ((F.col("_below") < rank) | F.col("_from").isNull()) & (F.col("_all") > 0), F.struct("le", inside.alias("x")))
    return h.groupBy(*keys).agg(F.max("_all").alias("n"), F.min(hit)["x"].alias(name))
