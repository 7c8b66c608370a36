"""Two-pass external shuffle: rows are scattered into memory-sized buckets, each bucket is permuted and written in order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.prefix import carried
from ledgerloom.session import ship_package, stage_table, work_path

SHARDS, SEED = 40, 13
#: Bytes of text a bucket has about; it is permuted in memory. Small tables have at least LEAST_BUCKETS of them.
BUCKET_BYTES, LEAST_BUCKETS = 32 << 20, 64
#: Rows that a task hands on at once.
CHUNK = 1000


def fisher_yates(n: int, seed: list[int]) -> np.ndarray:
    """A uniform permutation of 0 to n - 1: from the last place down, each swaps with one drawn from those up to it."""
    draws = np.random.default_rng(seed).integers(0, np.arange(1, n + 1)).tolist() if n else []
    order = list(range(n))
    for i in range(n - 1, 0, -1):
        j = draws[i]
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def _permuted(seed: int):
    """Rows sorted by bucket -> each bucket's rows in their new order, with their place in it."""

    def bucket_of(b: int, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        order = fisher_yates(len(rows), [seed, b])
        for at in range(0, len(rows), CHUNK):
            part = rows.take(pa.array(order[at : at + CHUNK])).combine_chunks()
            place = pa.array(np.arange(at, at + len(part)), pa.int64())
            yield from pa.table([part["bucket"], place, part["size"], part["record"]], ["bucket", "place", "size", "record"]).to_batches()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for b in batches:
            own = b.column("bucket").to_numpy()
            edges = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
            for i, j in zip(edges, edges[1:], strict=False):
                if i == j:
                    continue
                if held and own[i] != now:
                    yield from bucket_of(now, held)
                    held = []
                now = int(own[i])
                held.append(b.slice(i, j - i))
        if held:
            yield from bucket_of(now, held)

    return make


def shuffled(docs: DataFrame, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, text: str = "text") -> DataFrame:
    """(bucket, place, size, record), stored: all rows (record has every column) in a uniform random order, which is that of
    (bucket, place). size is the text's UTF-8 bytes (null: none) plus 16.

    The bucket is a seeded hash of the row's number in its input partition, so equal rows, a hot key or null ids scatter like
    any others. Rows of a bucket are sorted by that number before they are permuted, so a task that runs again makes the
    same rows as long as its input does (files do). Neighbouring buckets go to one task, so its files serve few shards.
    """
    spark = docs.sparkSession
    ship_package(spark)
    size = F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("bigint") + 16
    total = docs.agg(F.sum(size)).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-total // bucket_bytes))
    tasks = max(1, min(buckets, max(spark.sparkContext.defaultParallelism, -(-2 * total // bucket_bytes))))
    rows = docs.select(F.monotonically_increasing_id().alias("at"), size.alias("size"), F.struct(*(docs[c] for c in docs.columns)).alias("record"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), F.col("at")), F.lit(buckets)).cast("bigint"))
    scattered = rows.repartitionById(tasks, (F.col("bucket") * tasks / buckets).cast("int")).sortWithinPartitions("bucket", "at").drop("at")
    kept = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("place", T.LongType()), T.StructField("size", T.LongType()), scattered.schema["record"]])
    return stage_table(scattered.select("bucket", "size", "record").mapInArrow(_permuted(seed), kept), "buckets")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Writes the rows in a uniform random order to path/shard=<number>/ as Parquet and returns what was written: shard, slot
    (from 0, without gaps), size and record (all columns of docs, whatever their names).

    The shuffled order is cut into `shards` stretches whose numbers of rows differ by one at most, the longer ones first.
    What comes before a bucket is summed from the stored buckets' counts, level by level. Repeated rows, null ids and null
    texts are rows like any other; an empty table gives no rows, and shards beyond the number of rows get none.
    """
    spark = docs.sparkSession
    mixed = shuffled(docs, seed, bucket_bytes)
    counts = mixed.groupBy("bucket").agg(F.count("*").alias("rows"))
    offsets = stage_table(carried(counts, "bucket", sums=("rows",)), "bucket-offsets")
    n = offsets.agg(F.sum("rows")).first()[0] or 0
    base, extra = divmod(n, shards)
    place = F.col("rows_before") + F.col("place")
    long_ones = extra * (base + 1)
    shard = F.when(place < long_ones, F.expr(f"(rows_before + place) div {base + 1}")).otherwise(F.lit(extra) + F.expr(f"(rows_before + place - {long_ones}) div {max(base, 1)}"))
    start = F.col("shard") * base + F.least("shard", F.lit(extra))
    placed = mixed.join(offsets.select("bucket", "rows_before"), "bucket").withColumn("shard", shard.cast("int"))
    placed = placed.select("shard", (place - start).cast("bigint").alias("slot"), "size", "record")
    placed.write.partitionBy("shard").option("compression", "zstd").parquet(path)
    return spark.read.schema(placed.select("slot", "size", "record", "shard").schema).parquet(path)


def op13_sharding(docs: DataFrame) -> DataFrame:
    """The digest columns: doc_id, size, text_crc32, law (`rows`), shard, slot, grown_shard (null: this law moves rows)."""
    out = write_shards(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), work_path(docs.sparkSession, "shards"))
    text = F.coalesce("record.text", F.lit(""))
    return out.select("record.doc_id", "size", F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.lit("rows").alias("law"), F.col("shard").cast("int"), "slot", F.lit(None).cast("int").alias("grown_shard"))
