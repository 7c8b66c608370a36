"""Connected components of an edge table by alternating star contraction, with every round in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import stage_table


def _state(edges: DataFrame) -> tuple[int, object]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(u, v) bigint edges -> (node, root): every node that has an edge, with the smallest node it can reach.

    Large-star / small-star rounds: each takes a minimum per node (partial aggregation) and an equi-join back to the
    edges (which Spark may split where a node is hot), so no neighbour list is ever gathered in one row. Edges shrink
    to a star forest; the loop ends when a round changes nothing. Loops (u = v) and repeated edges are allowed; an
    empty edge table gives an empty result. Needs O(log n) rounds in practice; exceeding max_rounds is an error.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    edges = stage_table(edges, "edges")
    state = _state(edges)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        edges = stage_table(small, "edges")
        new = _state(edges)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
