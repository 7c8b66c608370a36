"""Ordered, replay-safe ingest with foreachBatch, receipts and committed-sequence watermarks; a bounded reorder buffer."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgerloom.functions.columns import file_overlap
from ledgerloom.plans.versioned import Change, CommitConflict, Store

WATERMARKS = T.StructType([T.StructField("network_passphrase", T.StringType()), T.StructField("ledger_sequence", T.LongType())])
RECEIPTS = T.StructType([T.StructField("network_passphrase", T.StringType()), T.StructField("batch_id", T.StringType()), T.StructField("ledger_start", T.LongType()), T.StructField("ledger_end", T.LongType()), T.StructField("ledger_count", T.LongType()), T.StructField("payload_sha256", T.StringType())])


#: Optional tables: one row per committed ledger, and one per commit with what it took to prepare it.
LEDGER_BATCHES = T.StructType([T.StructField("network_passphrase", T.StringType()), T.StructField("ledger_sequence", T.LongType()), T.StructField("batch_id", T.StringType()), T.StructField("row_count", T.LongType())])
METRICS = T.StructType([T.StructField("batch_id", T.StringType()), T.StructField("ledger_start", T.LongType()), T.StructField("ledger_end", T.LongType()), T.StructField("ledgers", T.LongType()), T.StructField("rows", T.LongType()), T.StructField("bytes", T.LongType()), T.StructField("replayed", T.LongType()), T.StructField("prepare_ms", T.DoubleType())])


def row_digest(df: DataFrame, names: list[str]) -> Column:
    """Two hashes of a row as one exact number; nulls count, in their places."""
    cells = [c for n in names for c in (F.col(n).isNull(), F.col(n))]
    return F.xxhash64(F.lit(1), *cells).cast("decimal(38,0)") * F.lit(1 << 16) + F.pmod(F.xxhash64(F.lit(2), *cells), F.lit(1 << 16))


def payload_digest(batch: DataFrame, seq: str) -> str:
    """Order-free digest of a batch: its number of rows, the sum of their hashes and its bounds."""
    got = batch.agg(F.count("*").alias("n"), F.sum(row_digest(batch, sorted(batch.columns))).alias("s"), F.min(seq).alias("lo"), F.max(seq).alias("hi")).first()
    return _hex(got)


def _hex(got: Row) -> str:
    return hashlib.sha256(f"{got['n']}:{got['s']}:{got['lo']}:{got['hi']}".encode()).hexdigest()


def declared_limits(totals: DataFrame, max_ledgers: int | None = None, max_bytes: int | None = None, max_rows: int | None = None) -> DataFrame:
    """(keys of totals, problem) of batches or runs (ledgers, bytes, rows) beyond a limit, before anything is written."""
    limits = {"ledgers": max_ledgers, "bytes": max_bytes, "rows": max_rows}
    over = [F.when(F.col(c) > m, F.concat(F.lit(f"{c} "), F.col(c).cast("string"), F.lit(f" over {m}"))) for c, m in limits.items() if m is not None]
    problem = F.array_join(F.array_compact(F.array(*over)), ", ") if over else F.lit("")
    return totals.withColumn("problem", problem).where("problem <> ''").select(*[c for c in totals.columns if c not in limits], "problem")


def _told(store: Store) -> list[dict] | None:
    """What the commits that wrote watermarks say of themselves in the log; None if one of them says nothing."""
    wrote = [e for e in store.log() if "ingest_watermarks" in e.get("tables", {})]
    return [e["facts"] for e in wrote] if all("watermark" in e.get("facts", {}) for e in wrote) else None


def high_watermark(store: Store, network: str) -> int | None:
    """The largest committed ledger of a network: from the log entries, or from the table where one lacks it."""
    if not store.current():
        return None
    if (told := _told(store)) is not None:
        return max((f["watermark"] for f in told if f["network"] == network), default=None)
    return store.as_of("ingest_watermarks").where(F.col("network_passphrase") == network).agg(F.max("ledger_sequence")).first()[0]


def pinned_network(store: Store) -> str | None:
    """The one network of a store; two are an error."""
    if not store.current():
        return None
    if (told := _told(store)) is not None:
        found = sorted({f["network"] for f in told})
    else:
        found = [r[0] for r in store.as_of("ingest_watermarks").select("network_passphrase").distinct().limit(2).collect()]
    if len(found) > 1:
        raise ValueError(f"a store holds one network, found {sorted(found)}")
    return found[0] if found else None


#: A batch of so many rows at most is written by one task for each table.
FEW_ROWS = 20_000


def commit_batch(store: Store, tables: dict[str, DataFrame], seq: str, network: str, batch_id: str, contiguous: bool = False, max_ledgers: int | None = None, max_rows: int | None = None, max_bytes: int | None = None, declared: dict[str, int] | None = None, replay: bool = False, profile: str | None = None) -> tuple[int, bool]:
    """One batch of rows for several tables under one snapshot -> (snapshot, whether anything was written).

    A batch id seen before with the same contents does nothing, with others it is refused. Ledgers at or below the
    watermark are replays: their old rows end in the same commit, and so do receipts that overlap the replayed range;
    fresh ledgers need no tombstones. With replay all of them are taken for replays, whatever the
    watermark says, and contiguous only forbids gaps in and before them. A profile is kept in the log. With contiguous, ledgers must be gapless and start right after the watermark
    (backfill); limits refuse a batch that is too large, and one that differs from what was declared (ledgers, rows,
    bytes) is refused too. Bytes are those of the rows as JSON, counted only where they are asked for. Tables
    ledger_batches and ingest_metrics are filled if the store has them. Each table's ledger is its range column in the
    store; seq only names it inside this function.
    """
    began = time.monotonic()
    pinned = pinned_network(store)
    if not network.strip() or pinned not in (None, network.strip()):
        raise ValueError(f"this store belongs to network {pinned!r}, not {network!r}")
    network, spark = network.strip(), store.spark
    weigh = max_bytes is not None or "ingest_metrics" in store.tables or "bytes" in (declared or {})
    keys, digests = None, []
    for name, df in sorted(tables.items()):
        own = store.tables[name][1]
        size = F.octet_length(F.to_json(F.struct(*df.columns))) if weigh else F.lit(0)
        # per ledger first: everything below needs one small row a ledger, or their sums
        part = df.groupBy(F.col(own).cast("bigint").alias(seq)).agg(F.count("*").alias("n"), F.sum(row_digest(df, sorted(df.columns))).alias("s"), F.sum(size).cast("bigint").alias("b"))
        part = part.withColumn("t", F.lit(name))
        keys = part if keys is None else keys.unionAll(part)
    keys = keys.persist()
    try:
        each = {r["t"]: r for r in keys.groupBy("t").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.min(seq).alias("lo"), F.max(seq).alias("hi"), F.sum("b").alias("b"), F.sum(F.when(F.col(seq).isNull(), F.col("n"))).alias("nulls"), F.count("*").alias("ledgers")).collect()}
        if nulls := sum(r["nulls"] or 0 for r in each.values()):
            raise ValueError(f"{nulls} rows have no {seq}")
        rows, weight = sum(r["n"] for r in each.values()), sum(r["b"] or 0 for r in each.values())
        if not rows:
            return store.current(), False
        ledgers = keys.groupBy(seq).agg(F.sum("n").alias("n"))
        if len(each) == 1:
            (only,) = each.values()
            bounds = {"lo": only["lo"], "hi": only["hi"], "n": only["ledgers"]}
        else:
            bounds = ledgers.agg(F.min(seq).alias("lo"), F.max(seq).alias("hi"), F.count("*").alias("n")).first()
        counts = {"ledgers": bounds["n"], "rows": rows, "bytes": weight}
        for what, most in (("ledgers", max_ledgers), ("rows", max_rows), ("bytes", max_bytes)):
            if most is not None and counts[what] > most:
                raise ValueError(f"a batch of {counts[what]} {what} exceeds the limits")
        if off := {k: v for k, v in (declared or {}).items() if counts[k] != v}:
            raise ValueError(f"declared {off}, observed {counts}")
        digest = ":".join(_hex(each[n]) if n in each else "" for n in sorted(tables))
        for e in store.log():
            if e.get("batch_id") == batch_id:
                if e.get("digest") != digest:
                    raise CommitConflict(f"batch {batch_id} came again with other contents")
                return e["snapshot"], False
        mark = high_watermark(store, network)
        if contiguous and (bounds["hi"] - bounds["lo"] + 1 != bounds["n"] or (mark is not None and bounds["lo"] != mark + 1 and not (replay and bounds["lo"] <= mark))):
            raise ValueError(f"ledgers {bounds['lo']} to {bounds['hi']} do not follow {mark} without gaps")
        if replay:
            again = ledgers.select(seq)
        else:
            again = ledgers.where(F.col(seq) <= F.lit(mark)).select(seq) if mark is not None and bounds["lo"] <= mark else None

        def change(rows: DataFrame, own: str) -> Change:
            return Change(rows=rows, clear_keys=None if again is None else again.select(F.col(seq).alias(own)), few=counts["rows"] <= FEW_ROWS)

        changes = {n: change(df, store.tables[n][1]) for n, df in tables.items()}
        marks = ledgers.select(F.lit(network).alias("network_passphrase"), F.col(seq).alias("ledger_sequence"), F.lit(batch_id).alias("batch_id"), F.col("n").alias("row_count"))
        changes["ingest_watermarks"] = change(marks.select("network_passphrase", "ledger_sequence"), "ledger_sequence")
        if "ledger_batches" in store.tables:
            changes["ledger_batches"] = change(marks, "ledger_sequence")
        receipt = spark.createDataFrame([(network, batch_id, bounds["lo"], bounds["hi"], bounds["n"], digest)], RECEIPTS)
        stale = None
        if again is not None:
            overlap = (F.col("network_passphrase") == network) & file_overlap(F.col("ledger_start"), F.col("ledger_end"), bounds["lo"], bounds["hi"] if replay else min(bounds["hi"], mark))
            stale = None if not store.current() else store.as_of("receipts").where(overlap).select("network_passphrase", "batch_id")
        changes["receipts"] = Change(rows=receipt, clear_rows=stale, few=True)
        if "ingest_metrics" in store.tables:
            taken = again.count() if again is not None else 0
            row = (batch_id, bounds["lo"], bounds["hi"], bounds["n"], rows, weight, taken, (time.monotonic() - began) * 1000)
            changes["ingest_metrics"] = Change(rows=spark.createDataFrame([row], METRICS), few=True)
        facts = {"network": network, "watermark": max(bounds["hi"], mark if mark is not None else bounds["hi"])}
        return store.commit(changes, batch_id=batch_id, digest=digest, facts=facts | ({"profile": profile} if profile else {}))
    finally:
        keys.unpersist()


class Writer:
    """The one writer of a store, for one profile, that repeats a commit whose answer was lost.

    "live" takes batches of one ledger; "backfill" takes gapless ones within its limits (max_ledgers, max_rows, max_bytes).
    A store keeps the two apart: while its last commit by a writer came from the other profile, batches are refused until
    take_over() says that the change is meant. After any failure it is unknown whether the commit was done, so the next
    try (and the next batch, if no try worked) replaces its ledgers instead of adding to them.
    """

    def __init__(self, store: Store, seq: str, network: str, profile: str = "live", attempts: int = 2, wait: float = 0.0, **limits: int) -> None:
        if profile not in ("live", "backfill"):
            raise ValueError("the profile is live or backfill")
        if attempts < 1:
            raise ValueError("there is at least one attempt")
        if limits and profile == "live":
            raise ValueError("limits are for backfill, a live batch is one ledger")
        self.store, self.seq, self.network, self.profile = store, seq, network, profile
        self.attempts, self.wait, self.limits = attempts, wait, limits
        self.force_replay = False
        self.retries = 0
        self._taken_over = False

    def take_over(self) -> None:
        """The other profile is done with this store."""
        self._taken_over = True

    def write(self, tables: dict[str, DataFrame], batch_id: str) -> tuple[int, bool]:
        """Commit one batch, as commit_batch() does. What the batch itself has wrong is raised at once and forces nothing."""
        told = [p for e in self.store.log() if (p := e.get("facts", {}).get("profile"))]
        if told and told[-1] != self.profile and not self._taken_over:
            raise ValueError(f"this store is written by the {told[-1]} profile")
        own = {"contiguous": True, **self.limits} if self.profile == "backfill" else {"max_ledgers": 1}
        for attempt in range(1, self.attempts + 1):
            try:
                done = commit_batch(self.store, tables, self.seq, self.network, batch_id, replay=self.force_replay, profile=self.profile, **own)
            except (ValueError, CommitConflict):
                raise
            except Exception:
                self.force_replay = True
                if attempt == self.attempts:
                    raise
                self.retries += 1
                time.sleep(self.wait * 2 ** (attempt - 1))
            else:
                self.force_replay = False
                return done
        raise AssertionError("unreachable")


def stream_into(store: Store, stream: DataFrame, split: Callable[[DataFrame], dict[str, DataFrame]], seq: str, network: str, query: str, checkpoint: str, **limits: object):  # noqa: ANN201
    """Start a query whose batches go through commit_batch; its own checkpoint and the batch ids make reruns harmless."""

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            commit_batch(store, split(batch), seq, network, f"{query}-{number}", **limits)
        finally:
            batch.unpersist()

    return stream.writeStream.queryName(query).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def fan_out(batch: DataFrame, sinks: list[Callable[[DataFrame], None]]) -> None:
    """One batch to several sinks, computed once."""
    batch = batch.persist()
    try:
        for sink in sinks:
            sink(batch)
    finally:
        batch.unpersist()


class Reorder(StatefulProcessor):
    """Per key: holds up to `window` rows and emits the smallest numbers once more are held. A row at or below the last
    emitted number, or a repeat of a held one, is an error; a row with end=true flushes what is held."""

    def __init__(self, seq: str, window: int) -> None:
        self.seq, self.window = seq, window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getMapState("held", "seq long", "payload string")
        self.last = handle.getValueState("last", "seq long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        held = {k[0]: v[0] for k, v in self.held.iterator()}
        last = self.last.get()[0] if self.last.exists() else None
        out, flush = [], False

        def emit(s: int) -> int:
            if last is not None and s <= last:
                raise ValueError(f"ledger {s} came after {last} was passed on")
            out.append((key[0], s, held.pop(s)))
            return s

        for pdf in rows:
            for s, payload, end in zip(pdf[self.seq], pdf["payload"], pdf["end"], strict=True):
                if end:
                    flush = True
                    continue
                s = int(s)
                if s in held or (last is not None and s <= last):
                    raise ValueError(f"ledger {s} is repeated or later than the window allows")
                held[s] = payload
        while held and (flush or len(held) > self.window):
            last = emit(min(held))
        for (k,), _ in list(self.held.iterator()):
            if k not in held:
                self.held.removeKey((k,))
        for s, payload in held.items():
            self.held.updateValue((s,), (payload,))
        if last is not None:
            self.last.update((last,))
        yield pd.DataFrame(out, columns=["network", self.seq, "payload"])

    def close(self) -> None:
        pass


def reorder_stream(stream: DataFrame, seq: str, window: int) -> DataFrame:
    """Rows (network, seq, payload, end) of a stream in order per network; needs the RocksDB state store."""
    return stream.groupBy("network").transformWithStateInPandas(statefulProcessor=Reorder(seq, window), outputStructType=f"network string, {seq} long, payload string", outputMode="Append", timeMode="None")


def reorder_batch(rows: DataFrame, seq: str, position: str, window: int, keys: list[str]) -> DataFrame:
    """What the buffer makes of stored rows, without running it: each row's place in order, and whether it came too late.

    A row is too late if more than `window` larger numbers had come before it: then one of them was passed on already.
    Batch form for audits, by windows per key.
    """
    from pyspark.sql import Window

    order = Window.partitionBy(*keys).orderBy(seq)
    place = F.row_number().over(order)
    arrival = F.row_number().over(Window.partitionBy(*keys).orderBy(position))
    return rows.select(*keys, seq, position, place.alias("place"), arrival.alias("arrival")).withColumn("late", F.col("arrival") - F.col("place") > window)
