"""Written files read back by their ends and by stretches: Parquet footers and digests, in parallel, no file in a row."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import ship_package

#: Bytes of a file that a task holds at once.
STRETCH = 4 << 20


def listed(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """(uri, bytes) of a folder's files; their contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder).select(F.col("path").alias("uri"), F.col("length").alias("bytes"))


def _opened(uri: str):
    if uri.startswith("file:"):
        return fs.LocalFileSystem().open_input_file(uri.removeprefix("file:").replace("///", "/", 1))
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for uri in b.column("uri").to_pylist():
            h = hashlib.sha256()
            with _opened(uri) as f:
                while part := f.read(STRETCH):
                    h.update(part)
            out.append("sha256:" + h.hexdigest())
        yield pa.RecordBatch.from_arrays([b.column("uri"), b.column("bytes"), pa.array(out, pa.string())], ["uri", "bytes", "sha256"])


def digests(files: DataFrame) -> DataFrame:
    """(uri, bytes, sha256) of files of any size: each is read in stretches by one task, large ones dealt out first."""
    spark = files.sparkSession
    ship_package(spark)
    dealt = files.select("uri", "bytes").repartition(max(1, spark.sparkContext.defaultParallelism * 4), F.xxhash64("uri"))
    return dealt.mapInArrow(_digest_batches, "uri string, bytes long, sha256 string")


def _footer_batches(seq: str):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for uri, size in zip(b.column("uri").to_pylist(), b.column("bytes").to_pylist(), strict=True):
                try:
                    with _opened(uri) as f:
                        meta = pq.ParquetFile(f).metadata
                        schema = meta.schema.to_arrow_schema()
                except (pa.ArrowInvalid, OSError) as e:
                    rows.append((uri, size, None, None, None, None, None, None, str(e)[:200]))
                    continue
                text = ", ".join(f"{x.name} {x.type}" for x in schema)
                low = high = nulls = None
                if seq in schema.names:
                    at = [meta.schema.column(i).path for i in range(len(meta.schema))].index(seq)
                    stats = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
                    if all(s is not None and s.has_null_count for s in stats):
                        nulls = sum(s.null_count for s in stats)
                        known = [s for s in stats if s.has_min_max]
                        low, high = min((int(s.min) for s in known), default=None), max((int(s.max) for s in known), default=None)
                rows.append((uri, size, meta.num_rows, meta.num_row_groups, text, low, high, nulls, None))
            names = ["uri", "bytes", "rows", "row_groups", "schema", "min_ledger", "max_ledger", "null_ledgers", "error"]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return make


def footers(files: DataFrame, seq: str) -> DataFrame:
    """(uri, bytes, rows, row_groups, schema, min_ledger, max_ledger, null_ledgers, error) of Parquet files, from their footers
    alone; ledger bounds come from the row groups' statistics of the column seq."""
    spark = files.sparkSession
    ship_package(spark)
    dealt = files.select("uri", "bytes").repartition(max(1, spark.sparkContext.defaultParallelism * 4), F.xxhash64("uri"))
    return dealt.mapInArrow(_footer_batches(seq), "uri string, bytes long, rows long, row_groups long, schema string, min_ledger long, max_ledger long, null_ledgers long, error string")


def footer_violations(found: DataFrame, declared: DataFrame, schema: str | None = None) -> DataFrame:
    """(uri, problem) where footers and declarations (uri, rows, min_ledger, max_ledger) disagree, every rule a row of its own."""
    d = declared.select("uri", F.struct("rows", "min_ledger", "max_ledger").alias("_d"))
    both = found.select("uri", F.struct(*[c for c in found.columns if c != "uri"]).alias("_f")).join(d, "uri", "full_outer")
    f, w = F.col("_f"), F.col("_d")
    there = f.isNotNull() & f["error"].isNull()
    rules = [
        F.when(f.isNull(), "missing"),
        F.when(w.isNull(), "not declared"),
        F.when(f["error"].isNotNull(), "not readable"),
        F.when(there & w.isNotNull() & (f["rows"] != w["rows"]), "rows"),
        F.when(there & w.isNotNull() & ~(f["min_ledger"].eqNullSafe(w["min_ledger"]) & f["max_ledger"].eqNullSafe(w["max_ledger"])), "range"),
        F.when(there & (f["null_ledgers"] > 0), "null ledger"),
        F.when(there & (f["min_ledger"] < 0), "negative ledger"),
        F.when(there & f["null_ledgers"].isNull(), "no ledger statistics"),
    ]
    if schema is not None:
        rules.append(F.when(there & (f["schema"] != schema), "schema"))
    return both.select("uri", F.explode(F.array_compact(F.array(*rules))).alias("problem"))


def same_schema(found: DataFrame) -> DataFrame:
    """(schema, files) of the schemas that occur, the most frequent first; more than one row: files differ."""
    return found.groupBy("schema").agg(F.count("*").alias("files")).orderBy(F.desc("files"), "schema")
