"""Versioned tables on plain Parquet: append-only rows and tombstones, and a log entry per commit.

Layout below root: <table>/rows/begin=N/..., <table>/tombstones/end=N/..., <table>/keys/end=N/..., _log/N.json. The log
entry is written last and exclusively; folders without one are invisible. One writer per root at a time; a second one
fails at the log.
"""

from __future__ import annotations

import json
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.columns import RANGE_WIDTH, range_bucket


class SnapshotExpired(ValueError):
    """A read below the floor that expire() set."""


class CommitConflict(RuntimeError):
    """Another writer took the snapshot id, or a batch id came again with other contents."""


@dataclass
class Change:
    """What a commit does to one table: ranges [lo, hi] whose rows end (None: all), rows that begin."""

    rows: DataFrame | None = None
    clear: list[tuple[int | None, int | None]] = field(default_factory=list)
    #: Or the single sequence numbers to clear, as a table with the range column; met by equality, however many.
    clear_keys: DataFrame | None = None
    #: Or rows to clear by equal values (null equals null) of this table's columns, whatever their range.
    clear_rows: DataFrame | None = None
    #: The caller knows that rows are so few that one task writes them, without a shuffle.
    few: bool = False


_TOMB = T.StructType([T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType())])


class Store:
    """All tables under one root; schemas and range columns are declared, never inferred."""

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, tuple[T.StructType, str]], width: int = RANGE_WIDTH) -> None:
        self.spark, self.root, self.tables, self.width = spark, root.rstrip("/"), tables, width
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        self._fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        self._known: dict[str, dict] = {}
        self._taken = 0

    def _path(self, name: str):  # noqa: ANN202
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def log(self) -> list[dict]:
        """Commits in order: one listing, and only entries that this store has not read yet are opened.

        Entries never change, so what was read is kept. An entry that cannot be read was never finished: it counts as
        no commit, but its number stays taken.
        """
        folder = self._path("_log")
        if not self._fs.exists(folder):
            return []
        names = sorted(n for s in self._fs.listStatus(folder) if (n := s.getPath().getName()).endswith(".json") and not n.startswith("."))
        io = self.spark._jvm.org.apache.commons.io.IOUtils
        for n in names:
            if n not in self._known:
                stream = self._fs.open(self._path(f"_log/{n}"))
                try:
                    self._known[n] = json.loads(io.toString(stream, "UTF-8"))
                except ValueError:
                    continue
                finally:
                    stream.close()
        self._taken = max((int(n[:-5]) for n in names), default=0)
        return [self._known[n] for n in names if n in self._known]

    def current(self) -> int:
        return max((e["snapshot"] for e in self.log()), default=0)

    def _append_log(self, entry: dict) -> None:
        """Written whole under another name, then renamed, which fails if the snapshot has its entry already."""
        jvm, path, part = self.spark._jvm, self._path(f"_log/{entry['snapshot']:012d}.json"), self._path(f"_log/.{uuid.uuid4().hex}.part")
        stream = self._fs.create(part, False)
        try:
            stream.write(bytearray(json.dumps(entry, sort_keys=True).encode()))
        finally:
            stream.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path("").toUri(), self.spark._jsc.hadoopConfiguration())
        never_over = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            files.rename(part, path, never_over)
        except Exception as e:
            self._fs.delete(part, False)
            raise CommitConflict(f"snapshot {entry['snapshot']} was taken by another writer") from e

    def _write(self, rows: DataFrame, seq: str, path: str, few: bool = False) -> None:
        """Rows of a range bucket go to one file, sorted, so that its statistics prune. Rebalancing lets small buckets
        share a file and splits a hot one over several tasks; no folder per bucket is made, whose number would grow
        with ledgers times commits."""
        if few:  # one file, no shuffle
            rows.coalesce(1).sortWithinPartitions(seq).write.parquet(f"{self.root}/{path}")
            return
        bucket = range_bucket(F.coalesce(F.col(seq), F.lit(-1)), self.width)
        dealt = rows.withColumn("_bucket", bucket).hint("rebalance", F.col("_bucket"))
        dealt.sortWithinPartitions(seq).drop("_bucket").write.parquet(f"{self.root}/{path}")

    def commit(self, changes: dict[str, Change], batch_id: str | None = None, digest: str | None = None, facts: dict | None = None) -> tuple[int, bool]:
        """All changes under one snapshot id -> (id, whether it was new). A batch id that is known is not done again.

        The tables' files are written at the same time, the log entry after all of them; facts (such as a watermark) stand in it.
        """
        log = self.log()
        for e in log:
            if batch_id is not None and e.get("batch_id") == batch_id:
                if e.get("digest") != digest:
                    raise CommitConflict(f"batch {batch_id} came again with other contents")
                return e["snapshot"], False
        n = self._taken + 1
        attempt = uuid.uuid4().hex
        wrote: dict[str, dict[str, str]] = {}
        writes = []
        for name, c in sorted(changes.items()):
            schema, seq = self.tables[name]
            done = wrote.setdefault(name, {})
            if c.rows is not None:
                rows = c.rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
                done["rows"] = f"{name}/rows/begin={n}/{attempt}"
                writes.append(partial(self._write, rows, seq, done["rows"], c.few))
            if (None, None) in c.clear:
                done["all"] = "cleared"
            ranges = [r for r in c.clear if r != (None, None)]
            if ranges:
                done["tombstones"] = f"{name}/tombstones/end={n}/{attempt}"
                writes.append(partial(self.spark.createDataFrame(ranges, _TOMB).write.parquet, f"{self.root}/{done['tombstones']}"))
            if c.clear_keys is not None:
                # not ranges of one: those would meet every row of their bucket
                key = F.col(seq).cast("bigint").try_cast(schema[seq].dataType).alias(seq)
                single = c.clear_keys.select(key).where(F.col(seq).isNotNull()).distinct()
                done["ledgers"] = f"{name}/keys/end={n}/{attempt}-ledgers"
                writes.append(partial(single.write.parquet, f"{self.root}/{done['ledgers']}"))
            if c.clear_rows is not None:
                done["keys"] = f"{name}/keys/end={n}/{attempt}"
                done["key_columns"] = ",".join(sorted(c.clear_rows.columns))
                gone = c.clear_rows.select(*[F.col(k).cast(schema[k].dataType).alias(k) for k in sorted(c.clear_rows.columns)]).distinct()
                writes.append(partial(gone.write.parquet, f"{self.root}/{done['keys']}"))
        with ThreadPoolExecutor(8) as pool:
            for job in [pool.submit(w) for w in writes]:
                job.result()
        self._append_log({"snapshot": n, "kind": "commit", "batch_id": batch_id, "digest": digest, "at": time.time(), "tables": wrote} | ({"facts": facts} if facts else {}))
        return n, True

    def floor(self) -> int:
        return max((e.get("floor", 0) for e in self.log()), default=0)

    def _check(self, version: int) -> None:
        if version < self.floor():
            raise SnapshotExpired(f"snapshot {version} is older than {self.floor()}")
        if version > self.current():
            raise ValueError(f"snapshot {version} does not exist yet")

    def _parts(self, name: str, upto: int, alive: bool = False) -> tuple[list[tuple[str, int]], list[tuple[str, int]], dict[str, list[tuple[str, int]]], list[int]]:
        """Folders of rows, range tombstones and key tombstones (by columns), and the snapshots that cleared everything.

        With alive, what such a snapshot ended is left out at once, so its files are not even listed.
        """
        rows: list[tuple[str, int]] = []
        tombs: list[tuple[str, int]] = []
        keys: dict[str, list[tuple[str, int]]] = {}
        cleared: list[int] = []
        for e in self.log():
            if e["snapshot"] > upto:
                continue
            if e["kind"] == "compact" and e["table"] == name:
                rows = [(e["rows"], 0)] + [r for r in rows if r[1] > e["upto"]]
                tombs = [t for t in tombs if t[1] > e["upto"]]
                keys = {c: kept for c, k in keys.items() if (kept := [t for t in k if t[1] > e["upto"]])}
                cleared = [n for n in cleared if n > e["upto"]]
            at = e.get("tables", {}).get(name, {})
            if "all" in at:
                cleared.append(e["snapshot"])
                if alive:
                    rows, tombs, keys, cleared = [], [], {}, []
            rows += [(at["rows"], e["snapshot"])] if "rows" in at else []
            tombs += [(at["tombstones"], e["snapshot"])] if "tombstones" in at else []
            if "ledgers" in at:
                keys.setdefault(self.tables[name][1], []).append((at["ledgers"], e["snapshot"]))
            if "keys" in at:
                keys.setdefault(at["key_columns"], []).append((at["keys"], e["snapshot"]))
        return rows, tombs, keys, cleared

    def _read(self, parts: list[tuple[str, int]], schema: T.StructType, stamp: str) -> DataFrame:
        """Parts with the snapshot that wrote them, all in one scan: a part's folder names its snapshot. A compacted part
        brings its own stamps and is a scan of its own."""
        full = T.StructType([*schema.fields, T.StructField(stamp, T.LongType())])
        frames = []
        if plain := [f"{self.root}/{path}" for path, n in parts if n]:
            number = F.regexp_extract(F.col("_metadata.file_path"), r"/(?:begin|end)=([0-9]+)/[^/]*/[^/]*$", 1).cast("bigint")
            frames.append(self.spark.read.schema(schema).parquet(*plain).select(*schema.fieldNames(), number.alias(stamp)))
        if packed := [f"{self.root}/{path}" for path, n in parts if not n]:
            own = T.StructType([*schema.fields, T.StructField("_begin", T.LongType())])
            frames.append(self.spark.read.schema(own).parquet(*packed).withColumnRenamed("_begin", stamp).select(*full.fieldNames()))
        return reduce(DataFrame.unionAll, frames) if frames else self.spark.createDataFrame([], full)

    def _spans(self, tombs_at: list[tuple[str, int]]) -> DataFrame:
        """Range tombstones, one row per range bucket they touch: (lo, hi, _e, _tb)."""
        tombs = self._read(tombs_at, _TOMB, "_e")
        buckets = F.sequence(range_bucket(F.col("lo"), self.width), range_bucket(F.col("hi"), self.width), F.lit(self.width).cast("bigint"))
        return tombs.select("lo", "hi", "_e", F.explode(buckets).alias("_tb"))

    def _keyed(self, name: str, columns: str, parts: list[tuple[str, int]]) -> DataFrame:
        """Key tombstones of one set of columns, renamed _k0, _k1 and so on, with their snapshot _ke."""
        names = columns.split(",")
        fields = T.StructType([self.tables[name][0][c] for c in names])
        return self._read(parts, fields, "_ke").toDF(*[f"_k{i}" for i in range(len(names))], "_ke")

    @staticmethod
    def _same(columns: str) -> Column:
        return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(columns.split(","))])

    def _alive(self, name: str, upto: int) -> DataFrame:
        """Rows alive at upto, with _begin: an anti join per kind of tombstone, on the range bucket or on the keys.

        Without tombstones this is a plain scan. Per key only the newest tombstone is met.
        """
        schema, seq = self.tables[name]
        rows_at, tombs_at, keys_at, _ = self._parts(name, upto, alive=True)
        rows = self._read(rows_at, schema, "_begin")
        if tombs_at:
            inside = (range_bucket(F.col(seq), self.width) == F.col("_tb")) & F.col(seq).between(F.col("lo"), F.col("hi")) & (F.col("_begin") < F.col("_e"))
            rows = rows.join(self._spans(tombs_at), inside, "left_anti")
        for columns, parts in sorted(keys_at.items()):
            ends = self._keyed(name, columns, parts)
            newest = ends.groupBy(*[c for c in ends.columns if c != "_ke"]).agg(F.max("_ke").alias("_ke"))
            rows = rows.join(newest, self._same(columns) & (F.col("_begin") < F.col("_ke")), "left_anti")
        return rows

    def _ended(self, name: str, upto: int) -> DataFrame:
        """Rows that a snapshot up to upto ended, with _begin and _end. Only rows that meet a tombstone are grouped."""
        schema, seq = self.tables[name]
        rows_at, tombs_at, keys_at, cleared = self._parts(name, upto)
        rows = self._read(rows_at, schema, "_begin").withColumn("_row", F.monotonically_increasing_id())
        ends = []
        if cleared:
            ends.append(F.array_min(F.filter(F.array(*[F.lit(e).cast("bigint") for e in cleared]), lambda e: e > F.col("_begin"))))
        if tombs_at:
            inside = (range_bucket(F.col(seq), self.width) == F.col("_tb")) & F.col(seq).between(F.col("lo"), F.col("hi")) & (F.col("_begin") < F.col("_e"))
            rows = rows.join(self._spans(tombs_at), inside, "left")
            ends.append(F.col("_e"))
        for i, (columns, parts) in enumerate(sorted(keys_at.items())):
            rows = rows.join(self._keyed(name, columns, parts), self._same(columns) & (F.col("_begin") < F.col("_ke")), "left")
            rows = rows.withColumnRenamed("_ke", f"_ke{i}").drop(*[f"_k{j}" for j in range(len(columns.split(",")))])
            ends.append(F.col(f"_ke{i}"))
        if not ends:
            return rows.where("false").drop("_row").withColumn("_end", F.lit(None).cast("bigint"))
        names = [*schema.fieldNames(), "_begin"]
        met = rows.withColumn("_end", F.array_min(F.array(*ends))).where("_end is not null")
        return met.groupBy("_row").agg(F.min("_end").alias("_end"), *[F.first(c).alias(c) for c in names]).select(*names, "_end")

    def as_of(self, name: str, version: int | None = None) -> DataFrame:
        """The table's rows at a version (None: now)."""
        version = self.current() if version is None else version
        self._check(version)
        return self._alive(name, version).select(*self.tables[name][0].fieldNames())

    def table_changes(self, name: str, low: int, high: int) -> DataFrame:
        """Rows inserted or deleted by snapshots low to high, inclusive: snapshot_id, change_type, the columns."""
        self._check(max(low - 1, 0) if self.floor() else low)
        self._check(high)
        schema = self.tables[name][0]
        names = schema.fieldNames()
        begun = self._read([r for r in self._parts(name, high)[0] if r[1] == 0 or r[1] >= low], schema, "_begin")
        ins = begun.where(F.col("_begin").between(low, high)).select(F.col("_begin").alias("snapshot_id"), F.lit("insert").alias("change_type"), *names)
        dels = self._ended(name, high).where(F.col("_end").between(low, high)).select(F.col("_end").alias("snapshot_id"), F.lit("delete").alias("change_type"), *names)
        return ins.unionAll(dels)

    def compact(self, name: str) -> None:
        """Rewrite a table's live rows in few sorted files, begin stamps kept; versions before become unreadable."""
        version = self.current()
        number = self._taken + 1
        schema, seq = self.tables[name]
        live = self._alive(name, version).select(*schema.fieldNames(), "_begin")
        path = f"{name}/rows/compact={number}/{uuid.uuid4().hex}"
        self._write(live, seq, path)
        self._append_log({"snapshot": number, "kind": "compact", "table": name, "rows": path, "upto": version, "floor": number})

    def expire(self, before: int) -> None:
        """Versions below `before` can no longer be read; files stay."""
        self.log()
        n = self._taken + 1
        self._append_log({"snapshot": n, "kind": "expire", "floor": min(before, n), "tables": {}})
