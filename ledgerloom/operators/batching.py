"""Greedy contiguous micro-batches of shards of any size: local successors, contracted blocks, pointer jumping."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.prefix import carried
from ledgerloom.session import ship_package, stage_table

#: Ledgers in a block, at least; a block also sees as many of the next as a batch may hold.
BLOCK = 8192


def _successors(b: np.ndarray, r: np.ndarray, own: int, most: tuple[int, int, int]) -> np.ndarray:
    """For each of the first `own` places, the place of the next batch's first ledger: sums before it, searched by bisection."""
    at = np.arange(own)
    reach = np.minimum(at + most[0], len(b))
    for x, limit in ((b, most[1]), (r, most[2])):
        sums = np.concatenate(([0], np.cumsum(x)))
        reach = np.minimum(reach, np.searchsorted(sums, sums[:own] + limit, "right") - 1)
    return np.maximum(reach, at + 1)


def _blocks(most: tuple[int, int, int]):
    """A block's rows -> (entry, exit): where a batch that begins at `entry` leaves the block, by going its successors backward."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("seq")
        own = int((~rows["tail"]).sum())
        after = _successors(rows["b"].to_numpy(), rows["r"].to_numpy(), own, most)
        leaves = after.copy()
        for i in range(own - 1, -1, -1):
            if after[i] < own:
                leaves[i] = leaves[after[i]]
        first = rows["seq"].iloc[0]
        entries = np.arange(min(own, most[0]) if rows["block"].iloc[0] else 1)
        return pd.DataFrame({"shard": rows["shard"].iloc[0], "entry": first + entries, "exit": first + leaves[entries]})

    return run


def _walked(most: tuple[int, int, int]):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("seq")
        own = int((~rows["tail"]).sum())
        b, r, first = rows["b"].to_numpy(), rows["r"].to_numpy(), int(rows["seq"].iloc[0])
        after = _successors(b, r, own, most)
        starts, i = [], int(rows["entry"].iloc[0]) - first
        while i < own:
            starts.append(i)
            i = int(after[i])
        out = pd.DataFrame({"i": starts, "j": [int(after[i]) for i in starts]})
        sums = [np.concatenate(([0], np.cumsum(x))) for x in (b, r)]
        return pd.DataFrame({
            "shard": rows["shard"].iloc[0], "block": rows["block"].iloc[0], "place": np.arange(len(out)), "ledger_start": first + out["i"], "ledger_end": first + out["j"] - 1,
            "ledgers": out["j"] - out["i"], "bytes": sums[0][out["j"]] - sums[0][out["i"]], "rows": sums[1][out["j"]] - sums[1][out["i"]],
        })

    return run


def oversized(sizes: DataFrame, size_bytes: str, rows: str, max_bytes: int, max_rows: int) -> DataFrame:
    """The rows whose ledger no batch can hold."""
    return sizes.where((F.col(size_bytes) > max_bytes) | (F.col(rows) > max_rows))


def pack_microbatches(sizes: DataFrame, shard: str, seq: str, size_bytes: str, rows: str, max_ledgers: int, max_bytes: int, max_rows: int, block: int = BLOCK) -> DataFrame:
    """Greedy contiguous batches per shard: (shard, batch, ledger_start, ledger_end, ledgers, bytes, rows).

    The first ledger that does not fit opens the next batch; one too large on its own, a hole or a repeated ledger inside a
    shard, and null sizes, are errors. Where a batch ends depends on at most max_ledgers ledgers, so each block of ledgers finds by
    itself where a batch beginning at any of its ledgers ends, and where a chain of batches that enters it leaves it.
    Those jumps are doubled until every block knows its true entry: O(log of the blocks) joins of max_ledgers rows a
    block, each stored. Then blocks walk their own batches. No task holds more than a block and its tail; a hot shard is many blocks.
    """
    spark = sizes.sparkSession
    ship_package(spark)
    most = (max_ledgers, max_bytes, max_rows)
    block = max(block, max_ledgers)
    kind = sizes.schema[shard].dataType.simpleString()
    items = sizes.select(F.col(shard).alias("shard"), F.col(seq).cast("bigint").alias("seq"), F.col(size_bytes).cast("bigint").alias("b"), F.col(rows).cast("bigint").alias("r"))
    whole = items.groupBy("shard").agg(
        F.min("seq").alias("low"), F.max("seq").alias("high"), F.count("*").alias("n"), F.count_if(F.col("seq").isNull() | F.col("b").isNull() | F.col("r").isNull()).alias("empty"),
        F.count_if((F.col("b") > max_bytes) | (F.col("r") > max_rows)).alias("large"),
    )
    # two equal numbers make a hole elsewhere, or fewer distinct numbers than rows, which the distinct (shard, seq) pairs show
    repeated = items.groupBy("shard", "seq").agg(F.count("*").alias("n")).where("n > 1")
    wrong = F.when((F.col("high") - F.col("low") + 1 != F.col("n")) | (F.col("empty") > 0), "ledgers of a shard are not contiguous").when(F.col("large") > 0, "a single ledger exceeds the batch limits")
    whole = stage_table(whole.withColumn("wrong", wrong), "shard-bounds")
    faults = [r["wrong"] for r in whole.where(F.col("wrong").isNotNull()).select("wrong").distinct().collect()]  # two texts at most
    if faults or not repeated.isEmpty():
        raise ValueError(faults[0] if faults else "ledgers of a shard are not contiguous")
    placed = items.join(whole.select(F.col("shard").alias("_s"), "low"), F.col("shard").eqNullSafe(F.col("_s"))).withColumn("at", F.col("seq") - F.col("low"))
    mine = F.floor(F.col("at") / block).cast("bigint")
    copies = F.when((F.col("at") >= block) & (F.col("at") % block < max_ledgers), F.array(mine, mine - 1)).otherwise(F.array(mine))
    spread = stage_table(placed.select("shard", "seq", "b", "r", mine.alias("mine"), F.explode(copies).alias("block")).withColumn("tail", F.col("block") != F.col("mine")).drop("mine"), "blocks")
    entries = whole.select("shard", F.col("low").alias("entry"))
    longest = whole.agg(F.max(F.ceil(F.col("n") / block))).first()[0] or 0
    if longest > 1:
        jumps = stage_table(spread.groupBy("shard", "block").applyInPandas(_blocks(most), f"shard {kind}, entry long, exit long"), "jumps")
    done = 1
    while done < longest:  # entries holds each shard's first `done` blocks, jumps lead over `done` blocks
        step = entries.join(jumps.toDF("_s", "_e", "next"), F.col("shard").eqNullSafe(F.col("_s")) & (F.col("entry") == F.col("_e"))).select("shard", F.col("next").alias("entry"))
        entries = stage_table(entries.unionAll(step).distinct(), "entries")
        done *= 2
        if done < longest:
            again = jumps.toDF("_s", "_e", "next")
            jumps = stage_table(jumps.join(again, jumps["shard"].eqNullSafe(again["_s"]) & (jumps["exit"] == again["_e"])).select("shard", "entry", F.col("next").alias("exit")), "jumps")
    known = entries.join(whole.select(F.col("shard").alias("_s"), "low"), F.col("shard").eqNullSafe(F.col("_s"))).select(F.col("_s"), F.floor((F.col("entry") - F.col("low")) / block).cast("bigint").alias("_b"), "entry")
    first = known.groupBy("_s", "_b").agg(F.min("entry").alias("entry"))
    walked = spread.join(first, F.col("shard").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b"))).select("shard", "block", "seq", "b", "r", "tail", "entry")
    out = walked.groupBy("shard", "block").applyInPandas(_walked(most), f"shard {kind}, block long, place long, ledger_start long, ledger_end long, ledgers long, bytes long, rows long")
    out = stage_table(out, "batches")
    before = carried(out.groupBy("shard", "block").agg(F.count("*").alias("batches")), "block", ["shard"], sums=("batches",)).select(F.col("shard").alias("_s"), F.col("block").alias("_b"), "batches_before")
    out = out.join(before, F.col("shard").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b")))
    return out.select(F.col("shard").alias(shard), (F.col("batches_before") + F.col("place")).alias("batch"), "ledger_start", "ledger_end", "ledgers", "bytes", "rows")
