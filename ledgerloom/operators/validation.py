"""Checks that return their violations as rows (none: passed), so that they can be combined into one report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import digest_ok
from ledgerloom.operators.ranges import coverage_violations, duplicate_keys


def declared_differs(declared: DataFrame, observed: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, problem) where a declaration and what was observed disagree: either side missing, or unequal columns.

    Serves batch declarations, acknowledgements and declared row counts alike; one full outer join on the keys.
    """
    d = declared.select(*keys, F.struct(*columns).alias("_d"))
    o = observed.select(*keys, F.struct(*columns).alias("_o"))
    unequal = F.array_join(F.array_compact(F.array(*[F.when(~F.col(f"_d.{c}").eqNullSafe(F.col(f"_o.{c}")), F.lit(c)) for c in columns])), ",")
    problem = F.when(F.col("_o").isNull(), "not observed").when(F.col("_d").isNull(), "not declared").when(unequal != "", F.concat(F.lit("differs in "), unequal))
    return d.join(o, keys, "full_outer").withColumn("problem", problem).where("problem is not null").select(*keys, "problem")


def row_ledger_violations(rows: DataFrame, row_seq: str, batch_seq: str, keys: list[str]) -> DataFrame:
    """Rows whose own ledger differs from their batch's, or is missing."""
    return rows.where(~F.col(row_seq).eqNullSafe(F.col(batch_seq))).select(*keys, row_seq, batch_seq)


def shard_id(job: str, network: str, schema_version: int) -> F.Column:
    """A shard's id from what it covers, not from who worked on it: a digest of a definition of our own."""
    parts = [F.lit(job), F.lit(network), F.lit(schema_version), F.col("ledger_start"), F.col("ledger_end")]
    return F.concat(F.lit("shard_"), F.substring(F.sha2(F.to_json(F.array(*[p.cast("string") for p in parts])), 256), 1, 24))


def validate_job(shards: DataFrame, low: int, high: int, job: str, network: str, schema_version: int) -> DataFrame:
    """(subject, problem) of shards (shard_id, ledger_start, ledger_end) that do not tile [low, high] under derived ids."""
    name = F.concat_ws("-", "ledger_start", "ledger_end")
    tiles = coverage_violations(shards, "ledger_start", "ledger_end", low, high).select(name.alias("subject"), "problem")
    ids = shards.where(~F.coalesce(F.col("shard_id") == shard_id(job, network, schema_version), F.lit(False))).select(name.alias("subject"), F.lit("shard_id is not derived").alias("problem"))
    twice = duplicate_keys(shards, ["shard_id"]).select(F.col("shard_id").alias("subject"), F.lit("repeated shard_id").alias("problem"))
    return tiles.unionAll(ids).unionAll(twice)


def validate_corpus(manifest: DataFrame, low: int, high: int) -> DataFrame:
    """(subject, problem) of manifest entries (path, sha256, bytes, ledgers, ledger_start, ledger_end)."""
    rules = (
        F.when(F.coalesce(F.trim("path"), F.lit("")) == "", "no path")
        .when(~digest_ok(F.concat(F.lit("sha256:"), "sha256")), "digest form")
        .when(~F.coalesce(F.col("bytes") > 0, F.lit(False)), "no bytes")
        .when(~F.coalesce(F.col("ledgers") == F.col("ledger_end") - F.col("ledger_start") + 1, F.lit(False)), "count differs from range")
    )
    bad = manifest.withColumn("problem", rules).where("problem is not null").select(F.coalesce("path", F.lit("")).alias("subject"), "problem")
    twice = duplicate_keys(manifest, ["path"]).select(F.coalesce("path", F.lit("")).alias("subject"), F.lit("repeated path").alias("problem"))
    tiles = coverage_violations(manifest, "ledger_start", "ledger_end", low, high).select(F.concat_ws("-", "ledger_start", "ledger_end").alias("subject"), "problem")
    return bad.unionAll(twice).unionAll(tiles)


def retries_agree(a: DataFrame, b: DataFrame, leave_out: tuple[str, ...] = ("attempt", "worker", "uri", "started_at", "finished_at")) -> DataFrame:
    """(generation_a, generation_b, agree) of two attempts' file entries: digests without attempt, place and time."""
    digests = []
    for df, n in ((a, "generation_a"), (b, "generation_b")):
        kept = sorted(c for c in df.columns if c not in leave_out)
        digests.append(df.agg(F.concat(F.lit("sha256:"), F.sha2(F.to_json(F.array_sort(F.collect_list(F.struct(*kept)))), 256)).alias(n)))
    return digests[0].crossJoin(digests[1]).withColumn("agree", F.col("generation_a") == F.col("generation_b"))
