"""Point lookups by hash: range-sorted Parquet with Bloom filters and a small directory of the files' ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys that one lookup takes as a list; more of them are a join.
MOST_KEYS = 10_000


def write_lookup_index(rows: DataFrame, path: str, key: str, files: int = 16, rows_per_file: int = 1_000_000, audit: str = "indexed_at") -> None:
    """Rows range-partitioned and sorted by key below path/data, each file with a Bloom filter on the key, and path/directory with
    a row per file: name, lowest and highest key, rows. audit is the time of writing; comparisons leave it out.

    Hashes are uniform, so ranges are even; equal keys share a file, where maxRecordsPerFile may cut them.
    """
    spark = rows.sparkSession
    stamped = rows.withColumn(audit, F.current_timestamp())
    ordered = stamped.repartitionByRange(files, key).sortWithinPartitions(key)
    options = {f"parquet.bloom.filter.enabled#{key}": "true", f"parquet.bloom.filter.expected.ndv#{key}": str(rows_per_file), "maxRecordsPerFile": str(rows_per_file)}
    ordered.write.mode("errorifexists").options(**options).parquet(f"{path}/data")
    each = spark.read.schema(stamped.schema).parquet(f"{path}/data").select(F.col("_metadata.file_name").alias("file"), F.col(key).alias("_k"))
    each.groupBy("file").agg(F.min("_k").alias("low"), F.max("_k").alias("high"), F.count("*").alias("rows")).coalesce(1).write.mode("errorifexists").parquet(f"{path}/directory")


def files_for(spark: SparkSession, path: str, keys: list[str]) -> list[str]:
    """The data files that may hold any of the keys: at most a few for each key."""
    wanted = spark.createDataFrame([(k,) for k in keys], "k string")
    directory = spark.read.parquet(f"{path}/directory")
    return sorted(r["file"] for r in directory.join(F.broadcast(wanted), F.col("k").between(F.col("low"), F.col("high"))).select("file").distinct().collect())


def lookup(spark: SparkSession, path: str, key: str, keys: list[str], schema: str) -> DataFrame:
    """The rows of the keys: only files whose range holds one are opened, and of those only row groups whose statistics and
    Bloom filter let one through. No key, or none in any range, gives no rows."""
    if len(keys) > MOST_KEYS:
        raise ValueError(f"more than {MOST_KEYS} keys: join with the index instead")
    names = files_for(spark, path, keys) if keys else []
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/data/{n}" for n in names]).where(F.col(key).isin(*keys))
