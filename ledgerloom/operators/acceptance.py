"""Accepting a shard's result: every rule that it breaks is a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import digest_ok, range_bucket
from ledgerloom.operators.digests import tree_digest
from ledgerloom.operators.prefix import carried

#: Names of tables with their schema, and of places that hold an object.
TABLE_NAME = r"^[a-z][a-z0-9_]*\.[a-z][a-z0-9_]*$"
URI = r"^(file:///|[A-Za-z][A-Za-z0-9+.-]*://[^/?#@]+/)[^?#]*[^/?#]$"
UNCLEAN = r"^[^:]+://[^/]*/(.*/)?(\.{1,2}|)(/|$)"


def file_rules(low: int, high: int) -> F.Column:
    """The first rule that a file entry (table, uri, sha256, schema_sha256, bytes, rows, min_ledger, max_ledger) breaks, or null."""
    says = lambda ok, what: F.when(~F.coalesce(ok, F.lit(False)), what)
    uri = F.col("uri")
    return F.coalesce(
        says(F.col("table").rlike(TABLE_NAME), "table name"),
        says(uri.rlike(URI) & ~uri.rlike(UNCLEAN), "uri"),
        says(digest_ok(F.col("sha256")), "file digest"),
        says(digest_ok(F.col("schema_sha256")), "schema digest"),
        says(F.col("bytes") > 0, "no bytes"),
        says(F.col("rows") > 0, "no rows"),
        says((F.col("min_ledger") > 0) & (F.col("max_ledger") >= F.col("min_ledger")), "ledger range"),
        says((F.col("min_ledger") >= low) & (F.col("max_ledger") <= high), "outside the shard"),
    )


def out_of_order(files: DataFrame, place: str, width: int = 4096) -> DataFrame:
    """The entries that do not follow their predecessor by place in strict order of table, range and URI. Places are ordered
    inside buckets; a bucket's first entry is held against the last one before it."""
    key = F.struct("table", "min_ledger", "max_ledger", "uri")
    rows = files.withColumns({"_key": key, "_b": range_bucket(F.col(place), width)})
    last = rows.groupBy("_b").agg(F.max(F.struct(F.col(place).alias("at"), F.col("_key").alias("k"))).alias("_last"))
    before = carried(last, "_b", maxes=("_last",)).select("_b", F.col("_last_before")["k"].alias("_before"))
    inside = rows.withColumn("_prev", F.lag("_key").over(Window.partitionBy("_b").orderBy(place)))
    return inside.join(before, "_b").where(F.coalesce("_prev", "_before") >= F.col("_key")).select(*files.columns)


def result_violations(result: dict, shard: dict, files: DataFrame, table_counts: DataFrame, place: str = "place") -> DataFrame:
    """(subject, problem) of a result for its shard; none: accepted.

    result and shard are the small documents (identity, range, digests, worker, times), files the entries with their place in
    the list, table_counts (table, rows) what is declared. Files and counts stay tables; only the documents are on the driver.
    """
    spark = files.sparkSession
    canonical = lambda x: isinstance(x, str) and x.startswith("sha256:") and len(x) == 71 and all(c in "0123456789abcdef" for c in x[7:])
    low, high = shard["ledger_start"], shard["ledger_end"]
    generation = generation_digest(files)
    started, ended = result.get("started_at"), result.get("completed_at")
    facts = {
        "format version": result.get("format_version") == shard.get("format_version"),
        "identity": (result.get("job_id"), result.get("shard_id")) == (shard["job_id"], shard["shard_id"]),
        "generation digest": result.get("generation_digest") == generation,
        "range": (result.get("ledger_start"), result.get("ledger_end")) == (low, high),
        "ledger count": result.get("ledger_count") == high - low + 1,
        "source digest": canonical(result.get("source_digest")),
        "schema fingerprint": canonical(result.get("schema_fingerprint")),
        "worker": bool((result.get("worker_id") or "").strip()),
        "attempt": 1 <= (result.get("attempt") or 0) <= shard["max_attempts"],
        "times": started is not None and ended is not None and ended >= started,
    }
    broken = spark.createDataFrame([("result", k) for k, ok in facts.items() if not ok], "subject string, problem string")
    none = files.agg(F.count("*").alias("n")).where("n = 0").select(F.lit("result").alias("subject"), F.lit("no files").alias("problem"))
    bad = files.withColumn("problem", file_rules(low, high)).where("problem is not null").select(F.col("uri").alias("subject"), "problem")
    order = out_of_order(files, place).select(F.col("uri").alias("subject"), F.lit("order").alias("problem"))
    twice = files.groupBy("uri").agg(F.count("*").alias("n")).where("n > 1").select(F.col("uri").alias("subject"), F.lit("repeated uri").alias("problem"))
    sums = files.groupBy("table").agg(F.sum("rows").alias("observed"))
    both = sums.join(table_counts.select(F.col("table").alias("_t"), F.col("rows").alias("declared")), F.col("table").eqNullSafe(F.col("_t")), "full_outer")
    off = both.where(~F.coalesce("observed", F.lit(0)).eqNullSafe(F.coalesce("declared", F.lit(0)))).select(F.coalesce("table", "_t").alias("subject"), F.lit("row count").alias("problem"))
    names = table_counts.where(~F.coalesce(F.col("table").rlike(TABLE_NAME), F.lit(False))).select(F.col("table").alias("subject"), F.lit("counted table name").alias("problem"))
    out = broken
    for part in (none, bad, order, twice, off, names):
        out = out.unionAll(part)
    return out


def generation_digest(files: DataFrame) -> str:
    """Over the entries without their place and URI: two attempts that wrote the same agree."""
    return tree_digest(files, ["table", "sha256", "schema_sha256", "bytes", "rows", "min_ledger", "max_ledger"]).first()["digest"]
