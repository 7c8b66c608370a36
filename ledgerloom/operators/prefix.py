"""Running aggregates over a long order without a window over the whole table: a tree of groups hands totals down."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Neighbouring places that share a group of the next level.
FANOUT = 4096
#: Levels below the root, which has a row per FANOUT ** LEVELS places.
LEVELS = 2


def carried(df: DataFrame, at: str, keys: list[str] | None = None, sums: tuple[str, ...] = (), maxes: tuple[str, ...] = (), levels: int = LEVELS) -> DataFrame:
    """One row per (keys, at), `at` a whole number -> the same rows with `<c>_before` for each column c: its sum (0 for
    none) or largest value (null for none) over all smaller places of the same keys.

    A window runs inside groups of FANOUT places; each group's total goes up a level, and what comes before the group comes
    back by a join on the group. No window has more than FANOUT rows but the root's, which has one for each
    FANOUT ** LEVELS places: a single row for 16 million range buckets.
    """
    keys = keys or []
    names = [*sums, *maxes]
    group = F.floor(F.col(at) / F.lit(FANOUT)).cast("bigint") if levels else F.col(at) * 0  # a key for the root too
    up = f"_up{levels}"
    rows = df.withColumn(up, group)
    before = Window.partitionBy(*keys, up).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    total = {c: (F.sum if c in sums else F.max)(c) for c in names}
    inside = rows.withColumns({f"{c}_before": f.over(before) for c, f in total.items()})
    if levels:
        above = carried(rows.groupBy(*keys, up).agg(*(f.alias(c) for c, f in total.items())), up, keys, sums, maxes, levels - 1)
        above = above.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col(up).alias("_above"), *(F.col(f"{c}_before").alias(f"_{c}") for c in names))
        met = reduce(lambda x, y: x & y, [inside[k].eqNullSafe(above[f"_k{i}"]) for i, k in enumerate(keys)], inside[up] == above["_above"])
        inside = inside.join(above, met)
        both = {c: (F.coalesce(f"{c}_before", F.lit(0)) + F.col(f"_{c}")) if c in sums else F.greatest(f"{c}_before", f"_{c}") for c in names}
    else:
        both = {c: F.coalesce(f"{c}_before", F.lit(0)) if c in sums else F.col(f"{c}_before") for c in names}
    return inside.withColumns({f"{c}_before": x for c, x in both.items()}).select(*df.columns, *(f"{c}_before" for c in names))
