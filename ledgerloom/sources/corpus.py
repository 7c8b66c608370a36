"""File corpora: recording, manifests, pruned scans, verification, sorted shard writes."""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.columns import digest_ok, file_overlap
from ledgerloom.session import ship_package

CODECS = ("zstd", "snappy", "uncompressed")
MANIFEST = "path string, sha256 string, bytes bigint, rows bigint, ledger_start bigint, ledger_end bigint, ledgers bigint"

#: Order of rows inside a ledger's part of a file (fixed values); tables not named here are sorted by all columns.
SORT_KEYS = {
    "transactions_row_v2": ["ledger_sequence", "transaction_hash"],
    "operations_row_v2": ["transaction_hash", "operation_index", "ledger_sequence"],
    "effects_row_v1": ["ledger_sequence", "transaction_hash", "operation_index", "effect_index", "effect_type", "effect_type_string"],
    "contract_events_stream_v1": ["ledger_sequence", "transaction_hash", "operation_index", "event_index", "event_type", "event_id", "contract_event_xdr", "topics_json", "data_xdr"],
    "token_transfers_stream_v1": [
        "ledger_sequence", "transaction_hash", "transaction_id", "operation_id", "operation_index", "event_type", "from", "to",
        "asset", "asset_type", "asset_code", "asset_issuer", "amount", "amount_raw", "contract_id", "era_id",
    ],
}


def _below(path: F.Column, folder: str) -> F.Column:
    return F.substring_index(path, f"/{folder.rstrip('/').rsplit('/', 1)[-1]}/", -1)


def file_table(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """(path below the folder, bytes, sha256) of a folder's files, read in parallel."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return files.select(_below(F.col("path"), folder).alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def write_shard(df: DataFrame, path: str, seq: str, order: list[str] | None = None, files: int = 1, codec: str = "zstd", max_rows: int | None = None) -> None:
    """Range-partitioned, sorted inside each file (nulls first), never over existing files."""
    if codec not in CODECS:
        raise ValueError(f"codec must be one of {CODECS}")
    sort = [F.asc_nulls_first(c) for c in [seq, *(order or [c for c in df.columns if c != seq])]]
    writer = df.repartitionByRange(files, seq).sortWithinPartitions(*sort).write.mode("errorifexists").option("compression", codec)
    (writer.option("maxRecordsPerFile", max_rows) if max_rows else writer).parquet(path)


def write_rolling(df: DataFrame, path: str, seq: str, target_bytes: int, max_bytes: int, order: list[str] | None = None, codec: str = "zstd") -> DataFrame:
    """Sorted files near target_bytes -> (path, bytes, rows, ledger_start, ledger_end); a file above max_bytes is an error.

    A first write below path/measured tells the bytes a row takes and how many files the range needs; it stays there.
    """
    spark = df.sparkSession
    write_shard(df, f"{path}/measured", seq, order, codec=codec, files=spark.sparkContext.defaultParallelism)
    total = _sizes(spark, f"{path}/measured").agg(F.sum("bytes")).first()[0]
    measured = spark.read.schema(df.schema).parquet(f"{path}/measured")
    rows = measured.count()
    per_file = max(1, int(rows * target_bytes / max(total or 1, 1)))
    write_shard(measured, f"{path}/data", seq, order, files=max(1, -(-rows // per_file)), codec=codec, max_rows=per_file)
    name = _below(F.col("_metadata.file_path"), f"{path}/data")
    ranges = spark.read.schema(df.schema).parquet(f"{path}/data").select(seq, name.alias("path")).groupBy("path").agg(F.count("*").alias("rows"), F.min(seq).alias("ledger_start"), F.max(seq).alias("ledger_end"))
    files = _sizes(spark, f"{path}/data").join(ranges, "path").select("path", "bytes", "rows", "ledger_start", "ledger_end")
    over = files.where(F.col("bytes") > max_bytes).first()
    if over is not None:
        raise ValueError(f"{over['path']} has {over['bytes']} bytes, more than {max_bytes}")
    return files


def _sizes(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(folder)
    return files.select(_below(F.col("path"), folder).alias("path"), F.col("length").alias("bytes"))


#: Bytes of rows that a file's writer holds before it makes a row group of them.
GROUP_BYTES = 32 << 20


class _KeyFile:
    """One Parquet file under a hidden name, which gets its own name when it is whole; repeated tasks replace it."""

    def __init__(self, folder: str, name: str, schema: pa.Schema) -> None:
        self.name, self.schema, self.rows = name, schema, 0
        self.path, self.part = f"{folder}/{name}", f"{folder}/.{name}.{uuid.uuid4().hex}"
        self.writer, self.held, self.bytes = pq.ParquetWriter(self.part, schema, compression="snappy"), [], 0

    def add(self, rows: pa.RecordBatch) -> None:
        self.held.append(rows)
        self.rows += rows.num_rows
        self.bytes += rows.nbytes
        if self.bytes >= GROUP_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.held:
            self.writer.write_table(pa.Table.from_batches(self.held, self.schema))
        self.held, self.bytes = [], 0

    def close(self) -> tuple[str, int]:
        self.flush()
        self.writer.close()
        os.replace(self.part, self.path)
        return self.name, self.rows


def _key_files(folder: str, key: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, current, value = [], None, None
        for b in batches:
            at = b.schema.get_field_index(key)
            rows = pa.RecordBatch.from_arrays([c for i, c in enumerate(b.columns) if i != at], schema=b.schema.remove(at))
            start = 0
            for v, run in groupby(b.column(at).to_pylist()):
                n = sum(1 for _ in run)
                if current is None or v != value:
                    done += [current.close()] if current else []
                    current, value = _KeyFile(folder, f"{key}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}.parquet", rows.schema), v
                current.add(rows.slice(start, n))
                start += n
        done += [current.close()] if current else []
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], ["name", "rows"])

    return make


def write_keyed(df: DataFrame, path: str, key: str, order: list[str]) -> None:
    """One Parquet file for each value of a whole-number column, which is left out of it; rows in the given order; never over
    an existing folder.

    On a shared file system (file:) the tasks write <key>=<value>.parquet into one folder: Hadoop's local file system starts two
    processes for each file it makes, and a folder for each file is one more task to list. Elsewhere Spark's writer makes
    a folder <key>=<value> with one file.
    """
    if not isinstance(df.schema[key].dataType, T.IntegralType):
        raise ValueError(f"{key} is not a whole number")
    spark = df.sparkSession
    dealt = df.repartition(key).sortWithinPartitions(key, *order)
    if not path.startswith("file:"):
        dealt.write.mode("errorifexists").partitionBy(key).parquet(path)
        return
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(folder):
        raise FileExistsError(path)
    system.mkdirs(folder)
    ship_package(spark)
    dealt.mapInArrow(_key_files(folder.toUri().getPath(), key), "name string, rows long").write.format("noop").mode("overwrite").save()


def _manifest_batches(seq: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for path, size, content in zip(b.column("path"), b.column("bytes"), b.column("content"), strict=True):
                data = content.as_buffer()
                ledgers = pq.ParquetFile(pa.BufferReader(data)).read(columns=[seq], use_threads=False).column(seq)
                ends = pc.min_max(ledgers).as_py()
                out.append((path.as_py(), hashlib.sha256(data).hexdigest(), size.as_py(), len(ledgers), ends["min"], ends["max"], pc.count_distinct(ledgers).as_py()))
            kinds = [pa.string(), pa.string(), *[pa.int64()] * 5]
            names = ["path", "sha256", "bytes", "rows", "ledger_start", "ledger_end", "ledgers"]
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return make


def record_corpus(df: DataFrame, path: str, seq: str, ledgers_per_file: int) -> DataFrame:
    """Write df in files of so many ledgers below path/data and the manifest, last, below path/manifest; returns it.

    Each written file is read once, for its digest and its ledgers.
    """
    spark = df.sparkSession
    low = df.agg(F.min(seq)).first()[0]
    chunk = F.floor((F.col(seq) - F.lit(low)) / ledgers_per_file).cast("bigint")
    write_keyed(df.withColumn("_chunk", chunk), f"{path}/data", "_chunk", [seq])
    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(f"{path}/data")
    files = files.select(_below(F.col("path"), f"{path}/data").alias("path"), F.col("length").alias("bytes"), "content")
    files.mapInArrow(_manifest_batches(seq), MANIFEST).hint("rebalance").write.mode("errorifexists").json(f"{path}/manifest")
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).json(f"{path}/manifest")


def scan_corpus(spark: SparkSession, path: str, schema: str, seq: str, low: int, high: int) -> DataFrame:
    """Only the files that overlap [low, high] and only those ledgers; a range outside the manifest is an error."""
    manifest = read_manifest(spark, path)
    bounds = manifest.agg(F.min("ledger_start"), F.max("ledger_end")).first()
    if bounds[0] is None or low < bounds[0] or high > bounds[1] or low > high:
        raise ValueError(f"range {low} to {high} is not inside the corpus")
    names = [r["path"] for r in manifest.where(file_overlap(F.col("ledger_start"), F.col("ledger_end"), low, high)).select("path").collect()]
    files = spark.read.schema(schema).parquet(*[f"{path}/data/{n}" for n in names])
    return files.where(F.col(seq).between(low, high))


def verify_files(manifest: DataFrame, files: DataFrame, low: int | None = None, high: int | None = None) -> DataFrame:
    """(path, problem) of manifest files that are missing or differ in size or digest, and of files it does not name."""
    m = manifest if low is None else manifest.where(file_overlap(F.col("ledger_start"), F.col("ledger_end"), low, high))
    m = m.select("path", F.col("bytes").alias("want_bytes"), F.col("sha256").alias("want"))
    both = m.join(files, "path", "full_outer" if low is None else "left")
    problem = F.when(F.col("sha256").isNull(), "missing").when(F.col("want").isNull(), "not in the manifest").when(F.col("bytes") != F.col("want_bytes"), "size").when(F.col("sha256") != F.col("want"), "digest")
    return both.withColumn("problem", problem).where(F.col("problem").isNotNull()).select("path", "problem")


def inventory(files: DataFrame) -> DataFrame:
    """One row: files, bytes, largest, and a digest over the files' digests in order of path (one row per file)."""
    listed = F.array_sort(F.collect_list(F.struct("path", "sha256")))
    return files.agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.max("bytes").alias("largest"), F.sha2(F.array_join(F.transform(listed, lambda x: x["sha256"]), ""), 256).alias("digest"))


def file_set_identity(files: DataFrame, columns: tuple[str, ...] = ("table", "ledger_start", "ledger_end", "rows", "sha256")) -> DataFrame:
    """Digest over file entries without place, worker or time; equal for equal contents in any order."""
    items = F.array_sort(F.collect_list(F.struct(*columns)))
    return files.agg(F.concat(F.lit("sha256:"), F.sha2(F.to_json(items), 256)).alias("identity"))


def validate_result(files: DataFrame, declared: DataFrame, low: int, high: int) -> DataFrame:
    """(subject, problem): file rules (range inside the shard, rows and bytes positive, digest form) and per-table sums
    against the declared counts, both ways."""
    rules = F.when(~file_range_ok(low, high), "outside the shard").when(F.col("rows") <= 0, "no rows").when(F.col("bytes") <= 0, "no bytes").when(~digest_ok(F.concat(F.lit("sha256:"), "sha256")), "digest form")
    bad = files.withColumn("problem", rules).where(F.col("problem").isNotNull()).select(F.col("uri").alias("subject"), "problem")
    sums = files.groupBy("table").agg(F.sum("rows").alias("observed")).join(declared.select("table", F.col("rows").alias("declared")), "table", "full_outer")
    off = sums.where(~F.coalesce(F.col("observed"), F.lit(0)).eqNullSafe(F.coalesce(F.col("declared"), F.lit(0)))).select(F.col("table").alias("subject"), F.lit("row count").alias("problem"))
    return bad.unionAll(off)


def file_range_ok(low: int, high: int) -> F.Column:
    return F.coalesce((F.col("min_ledger") >= low) & (F.col("max_ledger") <= high) & (F.col("min_ledger") <= F.col("max_ledger")), F.lit(False))


def write_report(spark: SparkSession, report: dict, path: str) -> None:
    """One JSON document, created exclusively."""
    spark.createDataFrame([(json.dumps(report, sort_keys=True),)], "value string").coalesce(1).write.mode("errorifexists").text(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """One object per row, null fields included."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Sorted rows with \\N for null, timestamps left out."""
    kept = df.drop(*[f.name for f in df.schema.fields if f.dataType.typeName().startswith("timestamp")])
    kept.orderBy(*kept.columns).write.mode("errorifexists").option("nullValue", "\\N").csv(path)


def write_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """To a staging table of a relational database; merging it is the database's part."""
    df.write.format("jdbc").options(url=url, dbtable=table, **options).mode("overwrite").save()
