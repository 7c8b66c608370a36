"""The registered queries over the driver's tables, each with DuckDB SQL where SQL can express it.

events stand in for token transfers and contract events (ledger = event_id div 10), orders for transactions,
lineitem for operations and for watermarks with gaps. The operators take column names, so the mapping is only arguments.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import columns as C
from ledgerloom.operators import acceptance, batching, digests, mutations, parity, ranges, rollups, validation
from ledgerloom.plans import gatekeeper, loads, migrations, replica
from ledgerloom.plans.versioned import Change, Store
from ledgerloom.session import stage_table, work_path
from ledgerloom.sources import corpus, envelope, footers, lookup
from ledgerloom.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select((F.floor(F.col("event_id") / 10)).cast("bigint").alias("ledger_sequence"), "event_id", "event_type", "user_id", F.col("value").cast("decimal(18,2)").alias("amount"), "ts")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.floor(F.col("o_orderkey") / 10).cast("bigint").alias("ledger_sequence"), F.sha2(F.col("o_orderkey").cast("string"), 256).alias("transaction_hash"),
        (F.col("o_custkey") % 100).cast("int").alias("operation_count"), (F.col("o_orderstatus") != "F").alias("successful"), F.col("o_orderdate").alias("created_at"),
    )


_DAILY = """SELECT event_type AS asset, CAST(ts AS DATE) AS day, count(*) AS transfer_count, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS volume,
count(DISTINCT user_id) AS unique_senders, min(event_id // 10) AS first_ledger, max(event_id // 10) AS last_ledger FROM events"""


@query(_DAILY + " GROUP BY 1, 2")
def asset_daily_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.asset_daily_volume(transfers(spark, sf_dir), "ledger_sequence", "event_type", "user_id", "amount", "ts", scale=2)


@query(_DAILY + " WHERE event_id // 10 <= 60 AND CAST(ts AS DATE) IN (SELECT CAST(ts AS DATE) FROM events WHERE event_id // 10 > 50 AND event_id // 10 <= 60) GROUP BY 1, 2")
def asset_daily_volume_affected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.affected_daily_volume(transfers(spark, sf_dir), "ledger_sequence", "event_type", "user_id", "amount", "ts", 50, 60, base=-1, scale=2)


@query("""SELECT sha256(CAST(o_orderkey AS VARCHAR)) AS tx_hash, o_orderkey // 10 AS ledger_sequence, CAST(o_custkey % 100 AS INTEGER) AS operation_count, o_orderstatus <> 'F' AS successful,
o_orderdate AS closed_at, CAST((o_orderkey // 10) / 100 AS BIGINT) AS ledger_range FROM orders WHERE o_orderkey // 10 > 20""")
def tx_hash_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.tx_hash_index(transactions(spark, sf_dir), 20, 1 << 60, width=100)


@query("""SELECT event_type AS contract_id, event_id // 10 AS ledger_sequence, CAST(count(*) AS INTEGER) AS event_count, min(ts) AS first_seen_at, CAST((event_id // 10) / 100 AS BIGINT) AS ledger_range
FROM events WHERE event_type <> 'error' AND event_id // 10 > 10 GROUP BY 1, 2""")
def contract_events_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = transfers(spark, sf_dir).select("ledger_sequence", F.nullif("event_type", F.lit("error")).alias("contract_id"), F.col("ts").alias("closed_at"))
    return rollups.contract_events_index(e, 10, 1 << 60, width=100)


@query("SELECT o_orderkey, 'tx_' || substr(sha256('tx:' || o_orderkey || ':' || o_custkey), 1, 24) AS id, 'bronze_' || substr(sha256('bronze:' || o_orderpriority || ':' || o_orderkey), 1, 24) AS row_id FROM orders")
def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", C.stable_id("tx", F.col("o_orderkey"), F.col("o_custkey")).alias("id"), C.stable_id("bronze", F.col("o_orderpriority"), F.col("o_orderkey")).alias("row_id"))


@query("SELECT l_orderkey * 50000 AS seq, (l_orderkey * 50000) // 10000 * 10000 AS range_bucket, CAST(l_orderkey * 50000 / 100000 AS BIGINT) AS index_bucket FROM lineitem")
def range_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = F.col("l_orderkey") * 50000
    return table(spark, sf_dir, "lineitem").select(seq.alias("seq"), C.range_bucket(seq).alias("range_bucket"), C.index_bucket(seq).alias("index_bucket"))


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes made of orders (transactions) and lineitem (bronze rows), one a ledger."""
    o = table(spark, sf_dir, "orders").withColumn("q", F.floor(F.col("o_orderkey") / 10).cast("bigint"))
    tx = o.groupBy("q").agg(F.array_sort(F.collect_list(F.struct(F.col("o_orderkey").alias("i"), F.col("o_orderpriority").alias("p")))).alias("t"))
    rows = table(spark, sf_dir, "lineitem").withColumn("q", F.floor(F.col("l_orderkey") / 10).cast("bigint"))
    payload = F.to_json(F.struct(F.col("l_orderkey").alias("OrderKey"), F.col("l_linenumber").alias("LineNumber"), F.col("l_shipdate").alias("ShipDate"), F.col("l_partkey").alias("PartKey"), F.col("l_suppkey").alias("SuppKey")))
    rows = rows.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_returnflag").alias("n"), payload.alias("j")))).alias("b"))
    both = tx.join(rows, "q", "left")
    return both.select(
        F.lit("net").alias("networkPassphrase"), F.col("q").alias("ledgerSequence"), F.lit("1700000000").alias("closedAtUnix"),
        F.transform("t", lambda x: F.struct(F.sha2(x["i"].cast("string"), 256).alias("transactionHash"), x["p"].alias("envelopeXdr"))).alias("transactions"),
        F.array().cast("array<string>").alias("operations"),
        F.transform("b", lambda x: F.struct(x["n"].alias("tableName"), x["j"].alias("rowJson"))).alias("bronzeRows"),
    )


@query("""WITH t AS (SELECT o_orderkey // 10 AS q, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT l_orderkey // 10 AS q, count(*) AS m FROM lineitem GROUP BY 1)
SELECT 'net' AS network_passphrase, q AS ledger_sequence, CAST(1700000000 AS BIGINT) AS closed_at_unix, CAST(n AS INTEGER) AS transaction_count, 0 AS operation_count, CAST(coalesce(m, 0) AS INTEGER) AS bronze_row_count FROM t LEFT JOIN b USING (q)""")
def batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.batch_counts(batches(spark, sf_dir))


@query("""WITH r AS (SELECT l_orderkey // 10 AS ledger_sequence, l_returnflag AS table_name, CAST(row_number() OVER (PARTITION BY l_orderkey // 10, l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS INTEGER) AS row_ordinal,
l_orderkey AS order_key, l_linenumber AS line_number FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_orderkey // 10 IN (SELECT o_orderkey // 10 FROM orders))
SELECT *, 'bronze_' || substr(sha256('bronze:net:' || ledger_sequence || ':' || table_name || ':' || row_ordinal), 1, 24) AS bronze_row_id FROM r""")
def row_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explosion of the envelopes to known tables, with ordinals, ids and typed payloads."""
    rows = envelope.known_tables(envelope.bronze_rows(batches(spark, sf_dir)), ["A", "R"])
    parsed = F.from_json("row_json", "OrderKey bigint, LineNumber int")
    return rows.select(F.col("ledgerSequence").alias("ledger_sequence"), "table_name", "row_ordinal", parsed["OrderKey"].alias("order_key"), parsed["LineNumber"].alias("line_number"), "bronze_row_id")


@query("""SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS absent, 'net' AS network, 'v1' AS version_label, count(*) AS n FROM events GROUP BY 1""")
def typed_projection_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = envelope.TableSpec("e", T.StructType([T.StructField("k", T.IntegerType()), T.StructField("absent", T.StringType()), T.StructField("network", T.StringType()), T.StructField("version_label", T.StringType())]), names={"k": "k"}, constants={"network": "net"})
    return envelope.project_typed(table(spark, sf_dir, "events"), spec, payload="props").groupBy("k", "absent", "network", "version_label").agg(F.count("*").alias("n"))


@query("""WITH l AS (SELECT l_orderkey, l_returnflag, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_returnflag DESC) AS k FROM lineitem)
SELECT o_orderkey, coalesce(l_returnflag, o_orderstatus) AS l_returnflag FROM orders LEFT JOIN l ON o_orderkey = l_orderkey AND k = 1""")
def tx_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("l_returnflag"))
    lookup = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return mutations.enrich_last(rows, lookup, ["l_orderkey"], "l_linenumber", ["l_returnflag"]).withColumnRenamed("l_orderkey", "o_orderkey")


_SEQ = "WITH d AS (SELECT DISTINCT l_orderkey AS seq FROM lineitem), n AS (SELECT seq, lag(seq) OVER (ORDER BY seq) AS prev FROM d) "


def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("seq"))


@query("SELECT seq FROM (SELECT unnest(range(min(l_orderkey), max(l_orderkey) + 1)) AS seq FROM lineitem) EXCEPT SELECT l_orderkey FROM lineitem")
def gap_ledgers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.gap_ledgers(_keys(spark, sf_dir), "seq", width=1000)


@query(_SEQ + "SELECT prev + 1 AS gap_start, seq - 1 AS gap_end FROM n WHERE seq > prev + 1")
def gap_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.gap_ranges(_keys(spark, sf_dir), "seq", width=1000)


@query(_SEQ + "SELECT seq, prev + 1 AS expected FROM n WHERE seq <> prev + 1")
def contiguity_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.contiguity_violations(_keys(spark, sf_dir), "seq", width=1000)


@query("""WITH d AS (SELECT DISTINCT l_returnflag, l_orderkey AS seq FROM lineitem), n AS (SELECT *, seq - lag(seq) OVER (PARTITION BY l_returnflag ORDER BY seq) - 1 AS step FROM d)
SELECT l_returnflag, count(*) AS ledgers, min(seq) AS first_ledger, max(seq) AS last_ledger, CAST(coalesce(sum(step), 0) AS BIGINT) AS missing, count(*) FILTER (step > 0) AS gaps FROM n GROUP BY 1""")
def continuity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_orderkey").alias("seq"))
    return ranges.continuity_report(rows, "seq", ["l_returnflag"], width=1000)


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT * FROM (SELECT o_custkey, o_orderkey, min(o_orderkey) OVER (PARTITION BY o_custkey) AS first_line FROM orders) WHERE o_orderkey > first_line")
def first_seen_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.first_seen_duplicates(table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey")


@query("SELECT user_id, count(*) AS rows, count(*) FILTER (event_type = 'error') AS nulls, min(CASE WHEN event_type <> 'error' THEN event_id END) AS first_ledger, max(CASE WHEN event_type <> 'error' THEN event_id END) AS last_ledger FROM events GROUP BY 1")
def null_and_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("seq", F.when(F.col("event_type") != "error", F.col("event_id")))
    return parity.null_and_bounds(e, "seq", ["user_id"])


_A, _B = "SELECT o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 7 <> 0", "SELECT o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 5 <> 0"


def _two(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf_dir, "orders")
    return o.where("o_orderkey % 7 <> 0").select("o_orderstatus", "o_orderpriority"), o.where("o_orderkey % 5 <> 0").select("o_orderstatus", "o_orderpriority")


@query(f"SELECT count(*) AS differences FROM (({_A} EXCEPT ALL {_B}) UNION ALL ({_B} EXCEPT ALL {_A}))")
def symmetric_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity.diff_count(*_two(spark, sf_dir))


@query(f"SELECT 'orders' AS table_name, count(*) AS differences FROM (({_A} EXCEPT ALL {_B}) UNION ALL ({_B} EXCEPT ALL {_A}))")
def parity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return parity.parity_report({"orders": _two(spark, sf_dir), "nation": (n, n.withColumn("n_name", F.lit("x")))}, {"nation": ["n_name"]})


@query()
def table_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity.fingerprint(table(spark, sf_dir, "orders"), drop=("o_orderdate",))


_O = "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(f"{_O} WHERE o_orderkey % 11 <> 0 UNION ALL SELECT o_orderkey, 'X', o_orderpriority FROM orders WHERE o_orderkey % 11 = 0")
def keyed_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir)
    return mutations.replace_keys(o, o.where("o_orderkey % 11 = 0").withColumn("o_orderstatus", F.lit("X")), ["o_orderkey"])


@query("""WITH r AS (SELECT l_orderkey AS o_orderkey, l_linestatus AS o_orderstatus, l_returnflag AS o_orderpriority, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_linestatus DESC, l_returnflag DESC) AS k FROM lineitem WHERE l_orderkey % 3 = 0)
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM r WHERE k = 1 UNION ALL SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM r)""")
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").where("l_orderkey % 3 = 0").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linestatus").alias("o_orderstatus"), F.col("l_returnflag").alias("o_orderpriority"), "l_linenumber")
    return mutations.upsert(_orders(spark, sf_dir), rows, ["o_orderkey"], "l_linenumber")


@query(f"{_O} WHERE o_orderkey % 2 = 0 UNION ALL {_O} WHERE o_orderkey % 2 = 1 AND o_orderkey % 3 = 0")
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir)
    return mutations.insert_if_absent(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 3 = 0"), ["o_orderkey"])


@query(f"{_O} WHERE o_orderkey NOT BETWEEN 100 AND 900 UNION ALL SELECT o_orderkey, 'Y', o_orderpriority FROM orders WHERE o_orderkey BETWEEN 100 AND 900 AND o_orderkey % 2 = 0")
def replace_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir)
    return mutations.replace_range(o, o.where("o_orderkey BETWEEN 100 AND 900 AND o_orderkey % 2 = 0").withColumn("o_orderstatus", F.lit("Y")), "o_orderkey", 100, 900)


_ORDERS = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType()), T.StructField("o_orderpriority", T.StringType())])


def _history(spark: SparkSession, sf_dir: str) -> Store:
    """Three commits: all orders; keys 100 to 900 replaced by the even ones with status Z; keys divisible by 50 removed."""
    o = _orders(spark, sf_dir)
    store = Store(spark, work_path(spark, "store"), {"orders": (_ORDERS, "o_orderkey"), "sync_checkpoints": (replica.CHECKPOINTS, "last_snapshot_id")}, width=1000)
    store.commit({"orders": Change(rows=o)}, batch_id="load")
    store.commit({"orders": Change(rows=o.where("o_orderkey BETWEEN 100 AND 900 AND o_orderkey % 2 = 0").withColumn("o_orderstatus", F.lit("Z")), clear=[(100, 900)])}, batch_id="replace")
    store.commit({"orders": Change(clear_keys=o.where("o_orderkey % 50 = 0"))}, batch_id="remove")
    return store


_V2 = f"({_O} WHERE o_orderkey NOT BETWEEN 100 AND 900 UNION ALL SELECT o_orderkey, 'Z', o_orderpriority FROM orders WHERE o_orderkey BETWEEN 100 AND 900 AND o_orderkey % 2 = 0)"


@query(f"SELECT * FROM {_V2}")
def as_of_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir).as_of("orders", 2)


@query(f"""SELECT CAST(2 AS BIGINT) AS snapshot_id, 'delete' AS change_type, * FROM ({_O} WHERE o_orderkey BETWEEN 100 AND 900)
UNION ALL SELECT 2, 'insert', o_orderkey, 'Z', o_orderpriority FROM orders WHERE o_orderkey BETWEEN 100 AND 900 AND o_orderkey % 2 = 0 UNION ALL SELECT 3, 'delete', * FROM {_V2} WHERE o_orderkey % 50 = 0""")
def changes_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir).table_changes("orders", 2, 3)


@query("SELECT o_orderkey FROM orders WHERE o_orderkey BETWEEN 100 AND 900 OR o_orderkey % 50 = 0")
def changed_ledgers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replica.changed_ledgers(_history(spark, sf_dir).table_changes("orders", 2, 3), "o_orderkey")


@query(f"SELECT * FROM {_V2} WHERE o_orderkey % 50 <> 0")
def replica_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replica that saw version 1 in full and then only the changes up to version 3."""
    source = _history(spark, sf_dir)
    target = Store(spark, work_path(spark, "replica"), source.tables, width=1000)
    target.commit({"orders": Change(rows=source.as_of("orders", 1)), "sync_checkpoints": Change(rows=spark.createDataFrame([("r", "c", "orders", 1, "ok", None, None)], replica.CHECKPOINTS))}, batch_id="seed")
    replica.sync(source, target, ["orders"], "r", "c")
    return target.as_of("orders")


@query("SELECT user_id, max(event_id) AS event_id FROM events GROUP BY 1")
def latest_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.latest_row(table(spark, sf_dir, "events").select("user_id", "event_id"), ["user_id"], "event_id")


def _packed_sql(shard: str, first: str, most: int, size: int, rows: int) -> str:
    fits = f"an < {most} AND ab + s.b <= {size} AND ar + s.r <= {rows}"
    return f"""WITH RECURSIVE s AS (SELECT {shard} AS shard, event_id // 10 AS q, CAST(sum(strlen(props)) AS BIGINT) AS b, count(*) AS r FROM events GROUP BY 1, 2),
p AS (SELECT shard, q, b, r, CAST(0 AS BIGINT) AS batch, CAST(1 AS BIGINT) AS an, b AS ab, r AS ar FROM s WHERE q = {first}
UNION ALL SELECT s.shard, s.q, s.b, s.r, batch + CASE WHEN {fits} THEN 0 ELSE 1 END, CASE WHEN {fits} THEN an + 1 ELSE 1 END, CASE WHEN {fits} THEN ab + s.b ELSE s.b END, CASE WHEN {fits} THEN ar + s.r ELSE s.r END
FROM p JOIN s ON s.shard = p.shard AND s.q = p.q + 1)
SELECT shard, batch, min(q) AS ledger_start, max(q) AS ledger_end, count(*) AS ledgers, CAST(sum(b) AS BIGINT) AS bytes, CAST(sum(r) AS BIGINT) AS rows FROM p GROUP BY 1, 2"""


def _ledger_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(q, b, r): each ledger's bytes of payload and rows."""
    e = table(spark, sf_dir, "events").withColumn("q", F.floor(F.col("event_id") / 10).cast("bigint"))
    return e.groupBy("q").agg(F.sum(F.octet_length("props")).cast("bigint").alias("b"), F.count("*").alias("r"))


@query(_packed_sql("event_id // 10 // 20", "shard * 20", 7, 600, 65))
def microbatch_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small shards: a block each."""
    sizes = _ledger_sizes(spark, sf_dir).withColumn("shard", F.floor(F.col("q") / 20).cast("bigint"))
    return batching.pack_microbatches(sizes, "shard", "q", "b", "r", max_ledgers=7, max_bytes=600, max_rows=65)


@query(_packed_sql("CAST(0 AS BIGINT)", "(SELECT min(event_id // 10) FROM events)", 50, 3000, 400))
def microbatch_pack_one_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table is one shard, in blocks of 64 ledgers joined by pointer jumping."""
    return batching.pack_microbatches(_ledger_sizes(spark, sf_dir).withColumn("shard", F.lit(0).cast("bigint")), "shard", "q", "b", "r", max_ledgers=50, max_bytes=3000, max_rows=400, block=64)


@query("SELECT event_id // 10 AS q, CAST(sum(strlen(props)) AS BIGINT) AS b, count(*) AS r FROM events GROUP BY 1 HAVING sum(strlen(props)) > 88 OR count(*) > 10")
def oversized_ledgers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.oversized(_ledger_sizes(spark, sf_dir), "b", "r", 88, 10)


@query("""WITH f AS (SELECT min_by(event_type, event_id) AS w FROM events), l AS (SELECT event_id, event_type FROM events WHERE value < 90),
g AS (SELECT event_id, lag(event_id) OVER (ORDER BY event_id) AS p FROM (SELECT DISTINCT event_id FROM l))
SELECT event_id, 'does not follow' AS problem FROM g WHERE event_id <> p + 1
UNION ALL SELECT DISTINCT event_id, 'another network' FROM l WHERE event_type <> (SELECT min_by(event_type, event_id) FROM l)
UNION ALL SELECT event_id, 'repeated' FROM l GROUP BY 1 HAVING count(*) > 1""")
def batch_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ledgers, their type as the network; those of 90 and more are missing."""
    return ranges.batch_violations(table(spark, sf_dir, "events").where("value < 90"), "event_id", "event_type", width=1000)


_EDGES = "[0.01, 0.025, 0.05, 0.075, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5, 0.75, 1.0, 2.0, 5.0, 10.0, CAST('inf' AS DOUBLE)]"


@query(f"""WITH e AS (SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS window_start, value / 100 AS v FROM events),
b AS (SELECT DISTINCT window_start, le FROM e, (SELECT unnest({_EDGES}) AS le)),
h AS (SELECT b.window_start, le, count(v) FILTER (v <= le) AS n FROM b JOIN e USING (window_start) GROUP BY ALL),
o AS (SELECT *, coalesce(lag(n) OVER w, 0) AS below, lag(le) OVER w AS f, max(n) OVER (PARTITION BY window_start) AS total FROM h WINDOW w AS (PARTITION BY window_start ORDER BY le))
SELECT window_start, total AS n, round(CASE WHEN isinf(le) THEN f ELSE coalesce(f, 0) + (le - coalesce(f, 0)) * ((total * 0.99::DOUBLE - below) / (n - below)) END, 6) AS p99
FROM o WHERE n >= total * 0.99::DOUBLE AND (below < total * 0.99::DOUBLE OR f IS NULL)""")
def histogram_p99(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("ts", "event_type", (F.col("value") / 100).alias("v"))
    out = rollups.windowed_histogram_p99(e, "ts", "v", window="6 hours", step="1 hour", keys=["event_type"])
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n", F.round("p99", 6).alias("p99"))


_BOUNDS = "(SELECT o_orderstatus, min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders GROUP BY 1)"


def _bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"))


@query(f"""SELECT o_orderstatus, k AS shard, lo + k * ((hi - lo + 1) // 7) + least(k, (hi - lo + 1) % 7) AS shard_start,
lo + (k + 1) * ((hi - lo + 1) // 7) + least(k + 1, (hi - lo + 1) % 7) - 1 AS shard_end FROM {_BOUNDS}, (SELECT unnest(range(7)) AS k)""")
def shard_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.shard_split(_bounds(spark, sf_dir), "lo", "hi", 7).select("o_orderstatus", "shard", "shard_start", "shard_end")


@query(f"SELECT o_orderstatus, unnest(range(lo, hi, 250)) AS chunk_start, least(chunk_start + 250, hi) AS chunk_end FROM {_BOUNDS}")
def chunk_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.split_half_open(_bounds(spark, sf_dir), "lo", "hi", 250).select("o_orderstatus", "chunk_start", "chunk_end")


@query("""SELECT event_type, count(value) AS n, min(value) AS min, quantile_disc(value, 0.5) AS median, quantile_disc(value, 0.95) AS p95, quantile_disc(value, 0.99) AS p99, max(value) AS max, round(avg(value), 6) AS mean FROM events GROUP BY 1""")
def latency_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.latency_summary(table(spark, sf_dir, "events"), "value", ["event_type"])


@query("SELECT event_id, value > 50 AND event_id >= 100 AS over FROM events")
def over_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", C.over_budget(F.col("value"), 50.0, F.col("event_id") < 100).alias("over"))


@query("""SELECT l_returnflag, count(*) AS workers, CAST(sum(n) AS BIGINT) AS ledgers, CAST(sum(b) AS BIGINT) AS bytes, CAST(sum(r) AS BIGINT) AS rows, max(s) AS seconds, string_agg(DISTINCT d, ',' ORDER BY d) AS digests,
round(sum(n) / max(s), 3) AS ledgers_per_s, round(sum(r) / max(s), 3) AS rows_per_s, round(sum(b) / max(s), 3) AS bytes_per_s
FROM (SELECT l_returnflag, l_suppkey % 8 AS w, count(DISTINCT l_orderkey) AS n, CAST(sum(l_partkey) AS BIGINT) AS b, count(*) AS r, CAST(max(l_linenumber) AS DOUBLE) AS s, CAST(l_suppkey % 8 // 3 AS VARCHAR) AS d FROM lineitem GROUP BY l_returnflag, l_suppkey % 8) GROUP BY 1""")
def run_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", (F.col("l_suppkey") % 8).alias("w")).agg(
        F.count_distinct("l_orderkey").alias("ledgers"), F.sum("l_partkey").alias("bytes"), F.count("*").alias("rows"), F.max("l_linenumber").cast("double").alias("seconds"))
    return rollups.run_rollup(w.withColumn("digest", F.floor(F.col("w") / 3).cast("string")), ["l_returnflag"])


@query("""SELECT l_shipmonth, CAST(sum(l_linenumber + l_quantity) AS BIGINT) AS phase_ms, CAST(sum(l_partkey % 60) AS BIGINT) AS total_ms, count(*) AS ledgers,
abs(sum(l_linenumber + l_quantity) - sum(l_partkey % 60)) <= sum(l_partkey % 60) * 0.15 + count(*) * 1.0 AS reconciled
FROM (SELECT CAST(month(l_shipdate) AS INTEGER) AS l_shipmonth, l_linenumber, CAST(l_quantity AS BIGINT) AS l_quantity, l_partkey FROM lineitem) GROUP BY 1""")
def phase_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.month("l_shipdate").alias("l_shipmonth"), F.col("l_linenumber").cast("bigint").alias("a"), F.col("l_quantity").cast("bigint").alias("b"), (F.col("l_partkey") % 60).alias("t"), F.lit(1).cast("bigint").alias("one"))
    return rollups.phase_reconcile(rows, ["l_shipmonth"], ["a", "b"], "t", "one", each_ms=1.0)


@query("SELECT time_bucket(INTERVAL '6 hours', ts) AS window_start, count(*) AS n, quantile_disc(value, 0.99) AS p99 FROM events GROUP BY 1")
def windowed_p99(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.windowed_p99(table(spark, sf_dir, "events"), "ts", "value", "6 hours").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("""SELECT * FROM (SELECT 'discount' AS gate, count(*) FILTER (l_discount > 0.09) AS observed FROM lineitem UNION ALL SELECT 'late_line', count(*) FILTER (l_linenumber > 6) FROM lineitem UNION ALL SELECT 'no_key', count(*) FILTER (l_orderkey IS NULL) FROM lineitem) WHERE observed > 0""")
def dq_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity.quality_gates(table(spark, sf_dir, "lineitem"), {"discount": "l_discount > 0.09", "late_line": "l_linenumber > 6", "no_key": "l_orderkey IS NULL"})


@query("""WITH e AS (SELECT o_orderkey // 100 AS c, min(o_orderkey) AS s, max(o_orderkey) + CASE WHEN o_orderkey // 100 % 4 = 0 THEN 1 ELSE 0 END AS e FROM orders WHERE o_orderkey // 100 % 7 <> 3 GROUP BY 1),
n AS (SELECT s, e, lag(e) OVER (ORDER BY s, e) AS p FROM e)
SELECT s AS file_start, e AS file_end, CASE WHEN s > p + 1 THEN 'leaves a gap' ELSE 'overlaps' END AS problem FROM n WHERE s <> p + 1""")
def manifest_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunk = F.floor(F.col("o_orderkey") / 100)
    files = table(spark, sf_dir, "orders").where(chunk % 7 != 3).groupBy(chunk.alias("c")).agg(F.min("o_orderkey").alias("file_start"), F.max("o_orderkey").alias("top"))
    files = files.withColumn("file_end", F.col("top") + F.when(F.col("c") % 4 == 0, 1).otherwise(0))
    bounds = files.agg(F.min("file_start"), F.max("file_end")).first()
    return ranges.coverage_violations(files, "file_start", "file_end", *bounds)


@query("SELECT event_type, count(*) AS expected, count(*) FILTER (value > 0.5 AND event_type <> 'view') AS observed FROM events GROUP BY 1 HAVING count(*) <> count(*) FILTER (value > 0.5 AND event_type <> 'view')")
def table_count_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return rollups.table_counts_match(e, e.where("value > 0.5 AND event_type <> 'view'"), "event_type")


@query("SELECT o_orderkey // 100 AS file, min(o_orderkey) AS file_start, max(o_orderkey) AS file_end FROM orders GROUP BY 1 HAVING max(o_orderkey) >= 450 AND min(o_orderkey) <= 820")
def file_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "orders").groupBy(F.floor(F.col("o_orderkey") / 100).cast("bigint").alias("file")).agg(F.min("o_orderkey").alias("file_start"), F.max("o_orderkey").alias("file_end"))
    return files.where(C.file_overlap(F.col("file_start"), F.col("file_end"), 450, 820))


@query(f"{_O} WHERE o_orderkey BETWEEN 333 AND 777")
def corpus_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record a corpus of files with a manifest, then scan a range of it through the manifest."""
    path = work_path(spark, "corpus")
    corpus.record_corpus(_orders(spark, sf_dir), path, "o_orderkey", 500)
    return corpus.scan_corpus(spark, path, "o_orderkey bigint, o_orderstatus string, o_orderpriority string", "o_orderkey", 333, 777)


@query("SELECT o_orderkey // 1000 AS bucket, o_orderkey, CAST(row_number() OVER (PARTITION BY o_orderkey // 1000 ORDER BY o_orderpriority, o_orderstatus, o_orderkey) AS INTEGER) AS place FROM orders")
def canonical_sort_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    o = _orders(spark, sf_dir).withColumn("bucket", F.floor(F.col("o_orderkey") / 1000).cast("bigint"))
    order = Window.partitionBy("bucket").orderBy(*[F.asc_nulls_first(c) for c in ("o_orderpriority", "o_orderstatus", "o_orderkey")])
    return o.select("bucket", "o_orderkey", F.row_number().over(order).alias("place"))


_TRANSFERS = T.StructType([T.StructField("ledger_sequence", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("user_id", T.LongType()), T.StructField("amount", T.DecimalType(18, 2)), T.StructField("ts", T.TimestampNTZType())])
_VOLUME = T.StructType([T.StructField("asset", T.StringType()), T.StructField("day", T.DateType()), T.StructField("transfer_count", T.LongType()), T.StructField("volume", T.DecimalType(38, 2))])


def _silver(spark: SparkSession, sf_dir: str, start: int = 50, end: int = 60) -> tuple[Store, gatekeeper.Proposal]:
    tables = {"transfers": (_TRANSFERS, "ledger_sequence"), "daily": (_VOLUME, "transfer_count"), "promotions": (gatekeeper.RECEIPTS, "source_snapshot_id")}
    store = Store(spark, work_path(spark, "silver"), tables)
    rows = transfers(spark, sf_dir).select(*_TRANSFERS.fieldNames())
    store.commit({"transfers": Change(rows=rows), "daily": Change(rows=spark.createDataFrame([], _VOLUME)), "promotions": Change(rows=spark.createDataFrame([], gatekeeper.RECEIPTS))}, batch_id="load")
    proposal = gatekeeper.Proposal(
        "daily", "agent", "lake.raw.transfers", 1, start, end, "lake.silver.daily", ("asset", "day"),
        """WITH days AS (SELECT DISTINCT to_date(ts) AS day FROM source WHERE ledger_sequence > :start_ledger AND ledger_sequence <= :end_ledger)
        SELECT event_type AS asset, to_date(ts) AS day, count(*) AS transfer_count, CAST(sum(amount) AS DECIMAL(38,2)) AS volume
        FROM source LEFT SEMI JOIN days ON to_date(ts) = days.day WHERE ledger_sequence <= :end_ledger GROUP BY 1, 2""",
        (("unique_keys", "SELECT count(*) = count(DISTINCT asset, day) FROM candidate"), ("no_empty_day", "SELECT coalesce(min(transfer_count) > 0, true) FROM candidate")),
    )
    return store, proposal


@query("SELECT event_type AS asset, CAST(ts AS DATE) AS day, count(*) AS transfer_count, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS volume FROM events WHERE event_id // 10 <= 60 AND CAST(ts AS DATE) IN (SELECT CAST(ts AS DATE) FROM events WHERE event_id // 10 > 50 AND event_id // 10 <= 60) GROUP BY 1, 2")
def gatekeeper_promote(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, proposal = _silver(spark, sf_dir)
    gatekeeper.promote(spark, store, proposal)
    return store.as_of("daily")


@query("SELECT unnest(['confinement', 'reproducibility', 'reconciliation/unique_keys', 'reconciliation/no_empty_day', 'replay']) AS gate, true AS passed, count(*) AS source_rows FROM events")
def invariant_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, proposal = _silver(spark, sf_dir)
    _, gates = gatekeeper.run_gates(spark, store, proposal)
    return spark.createDataFrame(gates, "gate string, passed boolean").crossJoin(store.as_of("transfers").agg(F.count("*").alias("source_rows")))


@query("SELECT event_id // 10 AS ledger_sequence, event_type, user_id, CAST(value AS DECIMAL(18,2)) AS amount, ts FROM events")
def stream_ingest_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a file stream into a store, then the same files again under another query: nothing is doubled."""
    tables = {"transfers": (_TRANSFERS, "ledger_sequence"), "ingest_watermarks": (ingest.WATERMARKS, "ledger_sequence"), "receipts": (ingest.RECEIPTS, "ledger_start")}
    store = Store(spark, work_path(spark, "ingest"), tables)
    source = work_path(spark, "incoming")
    transfers(spark, sf_dir).select(*_TRANSFERS.fieldNames()).write.parquet(source)
    for name in ("first", "again"):
        stream = spark.readStream.schema(_TRANSFERS).parquet(source)
        q = ingest.stream_into(store, stream, lambda b: {"transfers": b}, "ledger_sequence", "net", f"{name}_{source[-8:]}", work_path(spark, "offsets"))
        q.awaitTermination()
    return store.as_of("transfers")


@query("""WITH a AS (SELECT user_id, event_id AS seq, (event_id * 7919) % 1009 AS pos FROM events), b AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seq) AS place, row_number() OVER (PARTITION BY user_id ORDER BY pos, seq) AS arrival FROM a)
SELECT user_id, seq, CAST(place AS INTEGER) AS place, CAST(arrival AS INTEGER) AS arrival, arrival - place > 4 AS late FROM b""")
def reorder_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("seq"), F.struct(((F.col("event_id") * 7919) % 1009).alias("p"), F.col("event_id").alias("s")).alias("pos"))
    return ingest.reorder_batch(rows, "seq", "pos", 4, ["user_id"]).drop("pos")


@query("""WITH one AS (SELECT event_id // 500 AS shard, event_id // 10 AS q, CAST(sum(strlen(props)) AS BIGINT) AS b, count(*) AS r, sha256(string_agg(sha256(props), '' ORDER BY sha256(props))) AS h FROM events GROUP BY 1, 2)
SELECT shard, min(q) AS ledger_start, max(q) AS ledger_end, count(*) AS ledgers, CAST(sum(b) AS BIGINT) AS bytes, CAST(sum(r) AS BIGINT) AS rows, max(b) AS peak_bytes, max(r) AS peak_rows, sha256(string_agg(h, '' ORDER BY q)) AS payload_sha256 FROM one GROUP BY 1""")
def range_descriptors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / 500).cast("bigint").alias("shard"), F.floor(F.col("event_id") / 10).cast("bigint").alias("q"), "props")
    return ranges.range_descriptors(e, "shard", "q", "props")


@query("""WITH w AS (SELECT user_id % 4 AS run, user_id AS w, count(DISTINCT event_id // 10) AS ledgers, CAST(sum(strlen(props)) AS BIGINT) AS bytes, count(*) AS rows, CAST(count(DISTINCT event_type) AS DOUBLE) AS seconds FROM events GROUP BY 1, 2)
SELECT run, count(*) AS batches, min(ledgers) AS min_ledgers, max(ledgers) AS max_ledgers, CAST(sum(ledgers) AS BIGINT) AS ledgers, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(sum(rows) AS BIGINT) AS rows, sum(seconds) AS seconds, round(sum(ledgers) / sum(seconds), 3) AS ledgers_per_s FROM w GROUP BY 1""")
def microbatch_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").groupBy((F.col("user_id") % 4).alias("run"), "user_id").agg(
        F.count_distinct(F.floor(F.col("event_id") / 10)).alias("ledgers"), F.sum(F.octet_length("props")).cast("bigint").alias("bytes"), F.count("*").alias("rows"), F.count_distinct("event_type").cast("double").alias("seconds"))
    return rollups.microbatch_rollup(e, ["run"])


@query("SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, count(*) AS over FROM events WHERE value > 90 GROUP BY 1")
def over_budget_increase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.over_budget_increase(table(spark, sf_dir, "events"), "ts", "value", 90.0).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) <= 5 AS exempt FROM events")
def burst_exempt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.burst_exempt(table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), ["user_id"], ["ts", "event_id"], 5).drop("ts")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IN (SELECT DISTINCT l_orderkey FROM lineitem ORDER BY 1 LIMIT 40 OFFSET 25)")
def offset_take(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.take_after(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "l_orderkey", 25, 40, width=100)


@query("SELECT count(*) AS rows, min(o_orderstatus) AS low, max(o_orderstatus) AS high, CASE WHEN count(*) = 0 THEN 'absent' WHEN min(o_orderstatus) <> max(o_orderstatus) THEN 'several values' WHEN count(*) > 1 THEN 'repeated' END AS problem FROM orders")
def catalog_network_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.single_value_state(table(spark, sf_dir, "orders"), "o_orderstatus")


@query("""WITH d AS (SELECT l_orderkey AS o_orderkey, count(*) AS n, max(l_linenumber) AS top FROM lineitem WHERE l_orderkey % 9 <> 0 GROUP BY 1), o AS (SELECT o_orderkey, o_custkey % 5 AS n, CAST(o_custkey % 7 AS INTEGER) AS top FROM orders)
SELECT o_orderkey, CASE WHEN o.n IS NULL THEN 'not observed' WHEN d.n IS NULL THEN 'not declared' WHEN d.n <> o.n AND d.top <> o.top THEN 'differs in n,top' WHEN d.n <> o.n THEN 'differs in n' ELSE 'differs in top' END AS problem
FROM d FULL JOIN o USING (o_orderkey) WHERE d.n IS NULL OR o.n IS NULL OR d.n <> o.n OR d.top <> o.top""")
def declaration_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared against observed counts, as for batch declarations and acknowledgements."""
    d = table(spark, sf_dir, "lineitem").where("l_orderkey % 9 <> 0").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"), F.max("l_linenumber").cast("bigint").alias("top"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 5).alias("n"), (F.col("o_custkey") % 7).cast("bigint").alias("top"))
    return validation.declared_differs(d, o, ["o_orderkey"], ["n", "top"])


@query("SELECT l_orderkey, l_linenumber, l_partkey // 10 AS own, l_suppkey AS batch FROM lineitem WHERE l_partkey // 10 IS DISTINCT FROM l_suppkey")
def row_ledger_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.floor(F.col("l_partkey") / 10).cast("bigint").alias("own"), F.col("l_suppkey").alias("batch"))
    return validation.row_ledger_violations(rows, "own", "batch", ["l_orderkey", "l_linenumber"])


@query("""WITH e AS (SELECT o_orderkey // 100 AS c, min(o_orderkey) AS s, max(o_orderkey) AS e FROM orders WHERE o_orderkey // 100 % 7 <> 3 GROUP BY 1), n AS (SELECT s, e, lag(e) OVER (ORDER BY s, e) AS p FROM e)
SELECT s || '-' || e AS subject, CASE WHEN s > p + 1 THEN 'leaves a gap' ELSE 'overlaps' END AS problem FROM n WHERE s <> p + 1 UNION ALL SELECT s || '-' || e, 'shard_id is not derived' FROM n WHERE s % 2 = 0""")
def job_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunk = F.floor(F.col("o_orderkey") / 100)
    shards = table(spark, sf_dir, "orders").where(chunk % 7 != 3).groupBy(chunk.alias("c")).agg(F.min("o_orderkey").alias("ledger_start"), F.max("o_orderkey").alias("ledger_end"))
    own = validation.shard_id("job", "net", 1)
    shards = shards.withColumn("shard_id", F.when(F.col("ledger_start") % 2 == 0, F.concat(F.lit("other-"), own)).otherwise(own))
    bounds = shards.agg(F.min("ledger_start"), F.max("ledger_end")).first()
    return validation.validate_job(shards, *bounds, "job", "net", 1)


@query("""SELECT event_id, CASE WHEN j IS NULL THEN 'null' WHEN j[1] = '"' THEN 'string' WHEN j IN ('true', 'false') THEN 'bool' WHEN TRY_CAST(j AS BIGINT) IS NOT NULL AND j NOT LIKE '%.%' THEN 'bigint' WHEN TRY_CAST(j AS DOUBLE) IS NOT NULL THEN 'double' ELSE 'json' END AS kind
FROM (SELECT event_id, CASE event_id % 6 WHEN 0 THEN props WHEN 1 THEN CAST(event_id AS VARCHAR) WHEN 2 THEN '"' || event_type || '"' WHEN 3 THEN event_id || '.5' WHEN 4 THEN 'true' END AS j FROM events)""")
def loose_json_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, i = F.col("event_id") % 6, F.col("event_id").cast("string")
    j = F.when(k == 0, F.col("props")).when(k == 1, i).when(k == 2, F.concat(F.lit('"'), "event_type", F.lit('"'))).when(k == 3, F.concat(i, F.lit(".5"))).when(k == 4, "true")
    return table(spark, sf_dir, "events").select("event_id", C.loose_kind(j).alias("kind"))


_INDEX = T.StructType([T.StructField("contract_id", T.StringType()), T.StructField("ledger_sequence", T.LongType()), T.StructField("event_count", T.IntegerType()), T.StructField("ledger_range", T.LongType())])


@query("SELECT event_type AS contract_id, event_id // 10 AS ledger_sequence, CAST(count(*) AS INTEGER) AS event_count, CAST((event_id // 10) / 100 AS BIGINT) AS ledger_range FROM events WHERE event_type <> 'error' AND event_id // 10 > 10 AND event_id // 10 <= 90 GROUP BY 1, 2")
def index_materialized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract index over (10, 90] in chunks of 30 ledgers, then (40, 60] once more: nothing is doubled."""
    store = Store(spark, work_path(spark, "index"), {"contract_events_index": (_INDEX, "ledger_sequence")}, width=100)
    e = transfers(spark, sf_dir).select("ledger_sequence", F.nullif("event_type", F.lit("error")).alias("contract_id"), F.col("ts").alias("closed_at"))
    build = lambda low, high: rollups.contract_events_index(e, low, high, width=100).drop("first_seen_at")
    loads.materialize(store, "contract_events_index", build, 10, 90, chunk=30)
    loads.materialize(store, "contract_events_index", build, 40, 60)
    return store.as_of("contract_events_index")


@query(f"SELECT * FROM {_V2} WHERE o_orderkey % 50 <> 0")
def compacted_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three commits of the history after a round of upkeep."""
    store = _history(spark, sf_dir)
    loads.maintain(store, small_commits=2)
    return store.as_of("orders")


_TYPED = T.StructType([T.StructField("order_key", T.LongType()), T.StructField("line_number", T.IntegerType()), T.StructField("part_key", T.LongType()), T.StructField("ledger_sequence", T.LongType())])


@query("SELECT l_orderkey AS order_key, l_linenumber AS line_number, l_partkey AS part_key, l_suppkey AS ledger_sequence FROM lineitem WHERE l_returnflag = 'A' AND l_orderkey // 10 IN (SELECT o_orderkey // 10 FROM orders)")
def typed_load_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes into a typed table, committed twice under different batch ids: the replay ends the first rows."""
    specs = {"A": envelope.TableSpec("A", _TYPED, names={"ledger_sequence": "SuppKey"})}
    tables = {"A": (_TYPED, "ledger_sequence"), "ingest_watermarks": (ingest.WATERMARKS, "ledger_sequence"), "receipts": (ingest.RECEIPTS, "ledger_start")}
    store = Store(spark, work_path(spark, "typed"), tables)
    rows = {k: stage_table(v, "typed") for k, v in loads.typed_tables(batches(spark, sf_dir), specs).items()}
    for name in ("first", "again"):
        ingest.commit_batch(store, rows, "ledger_sequence", "net", name)
    return store.as_of("A")


@query("""WITH r AS (SELECT l_orderkey // 10 AS q, l_returnflag AS t, count(*) AS n FROM lineitem WHERE l_orderkey // 10 IN (SELECT o_orderkey // 10 FROM orders) GROUP BY 1, 2)
SELECT q AS ledger_sequence, t AS table_name, n FROM r UNION ALL SELECT 0, 'kept', 1 ORDER BY 1, 2""")
def json_rows_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON rows replaced per (network, ledger, table): stale rows of the same keys go, a row of another key stays."""
    b = stage_table(batches(spark, sf_dir), "envelopes")
    schema = "id string, network_passphrase string, ledger_sequence bigint, table_name string, row_ordinal int, row_json string"
    stale = b.select(F.lit("old").alias("id"), F.col("networkPassphrase").alias("network_passphrase"), F.col("ledgerSequence").alias("ledger_sequence"), F.explode("bronzeRows.tableName").alias("table_name"), F.lit(99).alias("row_ordinal"), F.lit("{}").alias("row_json"))
    kept = spark.createDataFrame([("k", "net", 0, "kept", 0, "{}")], schema)
    return loads.replace_json_rows(stale.unionByName(kept), b).groupBy("ledger_sequence", "table_name").agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey // 10 AS ledger_sequence, CAST(row_number() OVER (PARTITION BY o_orderkey // 10 ORDER BY o_orderkey, o_orderpriority) - 1 AS BIGINT) AS transaction_index, o_orderpriority AS envelope_xdr FROM orders""")
def relational_upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions list upserted on its natural key over older rows of the same keys."""
    b = batches(spark, sf_dir)
    item = lambda x, i: F.struct(F.lit("net").alias("networkPassphrase"), F.col("ledgerSequence").alias("ledgerSequence"), i.cast("bigint").alias("transactionIndex"), x["envelopeXdr"].alias("envelopeXdr"))
    b = b.select("ledgerSequence", F.transform("transactions", item).alias("transactions"))
    old = loads.relational_rows(b, "transactions").drop("position").withColumn("envelope_xdr", F.lit("old"))
    return loads.upsert_relational({"transactions": old}, b)["transactions"].drop("network_passphrase")


@query("SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def rolled_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files rolled near a byte target, read back."""
    path = work_path(spark, "rolled")
    corpus.write_rolling(_orders(spark, sf_dir), path, "o_orderkey", target_bytes=8_000, max_bytes=1_000_000)
    return spark.read.schema(_ORDERS).parquet(f"{path}/data")


# The queries below do over the whole table, or a share of its own range, what their namesakes do over fixed ids.


def _span(df: DataFrame, c: str) -> tuple[int, int]:
    """Smallest and largest value of c; (0, 0) without any."""
    return tuple(df.agg(F.coalesce(F.min(c), F.lit(0)), F.coalesce(F.max(c), F.lit(0))).first())


def _last_tenth(spark: SparkSession, sf_dir: str) -> tuple[int, int, int]:
    """(first ledger, start, end): (start, end] is the last tenth of the ledgers, one at least."""
    low, high = _span(transfers(spark, sf_dir), "ledger_sequence")
    return low, high - max(1, (high - low + 1) // 10), high


def _middle_half(spark: SparkSession, sf_dir: str) -> tuple[int, int, int, int]:
    """Bounds of the order keys, and of the middle half of them."""
    low, high = _span(_orders(spark, sf_dir), "o_orderkey")
    return low, high, low + (high - low) // 4, high - (high - low) // 4


_LAST = "(SELECT event_id // 10 > hi - greatest(1, (hi - lo + 1) // 10) AS late, * FROM events, (SELECT min(event_id // 10) AS lo, max(event_id // 10) AS hi FROM events))"
_HALF = "(SELECT min(o_orderkey) + (max(o_orderkey) - min(o_orderkey)) // 4 AS a, max(o_orderkey) - (max(o_orderkey) - min(o_orderkey)) // 4 AS b FROM orders)"


@query(_DAILY + f" WHERE CAST(ts AS DATE) IN (SELECT CAST(ts AS DATE) FROM {_LAST} WHERE late) GROUP BY 1, 2")
def asset_daily_volume_affected_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days that the last tenth of the ledgers touches, over all ledgers."""
    low, start, end = _last_tenth(spark, sf_dir)
    return rollups.affected_daily_volume(transfers(spark, sf_dir), "ledger_sequence", "event_type", "user_id", "amount", "ts", start, end, base=low - 1, scale=2)


@query(f"SELECT event_type AS asset, CAST(ts AS DATE) AS day, count(*) AS transfer_count, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS volume FROM events WHERE CAST(ts AS DATE) IN (SELECT CAST(ts AS DATE) FROM {_LAST} WHERE late) GROUP BY 1, 2")
def gatekeeper_promote_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, start, end = _last_tenth(spark, sf_dir)
    store, proposal = _silver(spark, sf_dir, start, end)
    gatekeeper.promote(spark, store, proposal)
    return store.as_of("daily")


@query("SELECT event_type AS contract_id, event_id // 10 + 1 AS ledger_sequence, CAST(count(*) AS INTEGER) AS event_count, CAST((event_id // 10 + 1) / 100 AS BIGINT) AS ledger_range FROM events WHERE event_type <> 'error' GROUP BY 1, 2")
def index_materialized_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract index over all ledgers (counted from 1, as a range starts after 0) in ten chunks, then the middle half
    once more: nothing is doubled."""
    store = Store(spark, work_path(spark, "index"), {"contract_events_index": (_INDEX, "ledger_sequence")}, width=100)
    e = transfers(spark, sf_dir).select((F.col("ledger_sequence") + 1).alias("ledger_sequence"), F.nullif("event_type", F.lit("error")).alias("contract_id"), F.col("ts").alias("closed_at"))
    build = lambda low, high: rollups.contract_events_index(e, low, high, width=100).drop("first_seen_at")
    low, high = _span(e, "ledger_sequence")
    start = max(0, low - 1)
    loads.materialize(store, "contract_events_index", build, start, high, chunk=max(1, -(-(high - start) // 10)))
    quarter = (high - start) // 4
    loads.materialize(store, "contract_events_index", build, start + quarter, high - quarter)
    return store.as_of("contract_events_index")


@query(f"SELECT o_orderkey // 100 AS file, min(o_orderkey) AS file_start, max(o_orderkey) AS file_end FROM orders, {_HALF} GROUP BY 1, a, b HAVING max(o_orderkey) >= a AND min(o_orderkey) <= b")
def file_overlap_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, a, b = _middle_half(spark, sf_dir)
    files = table(spark, sf_dir, "orders").groupBy(F.floor(F.col("o_orderkey") / 100).cast("bigint").alias("file")).agg(F.min("o_orderkey").alias("file_start"), F.max("o_orderkey").alias("file_end"))
    return files.where(C.file_overlap(F.col("file_start"), F.col("file_end"), a, b))


@query(f"{_O}, {_HALF} WHERE o_orderkey BETWEEN a AND b")
def corpus_scan_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A corpus of files with a manifest, and the middle half of its keys through the manifest."""
    path = work_path(spark, "corpus")
    low, high, a, b = _middle_half(spark, sf_dir)
    corpus.record_corpus(_orders(spark, sf_dir), path, "o_orderkey", max(500, -(-(high - low + 1) // 100)))
    return corpus.scan_corpus(spark, path, "o_orderkey bigint, o_orderstatus string, o_orderpriority string", "o_orderkey", a, b)


@query(f"""SELECT gate, passed, n AS source_rows FROM (SELECT 'confinement' AS gate, true AS passed UNION ALL SELECT 'reproducibility', true UNION ALL SELECT 'replay', true UNION ALL SELECT 'foreign/confinement', false
UNION ALL SELECT 'reconciliation/few_assets', (SELECT count(DISTINCT event_type) <= 2 FROM events WHERE CAST(ts AS DATE) IN (SELECT CAST(ts AS DATE) FROM {_LAST} WHERE late))), (SELECT count(*) AS n FROM events)""")
def gate_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gates of a proposal with an invariant that does not hold, and of one that reads a file besides its source."""
    _, start, end = _last_tenth(spark, sf_dir)
    store, proposal = _silver(spark, sf_dir, start, end)
    few = dataclasses.replace(proposal, invariants=(("few_assets", "SELECT count(DISTINCT asset) <= 2 FROM candidate"),))
    foreign = dataclasses.replace(proposal, transformation=f"{proposal.transformation} UNION ALL SELECT r_name, current_date(), 1, 1 FROM parquet.`{sf_dir}/region.parquet`".replace("current_date()", "DATE '2024-01-01'"))
    gates = gatekeeper.run_gates(spark, store, few)[1] + [(f"foreign/{n}", ok) for n, ok in gatekeeper.run_gates(spark, store, foreign)[1]]
    return store.as_of("transfers").agg(F.count("*").alias("source_rows")).withColumn("g", F.explode(F.array(*[F.struct(F.lit(n).alias("gate"), F.lit(ok).alias("passed")) for n, ok in gates]))).select("g.*", "source_rows")


@query(f"SELECT 'orders' AS source_table, CAST(3 AS BIGINT) AS last_snapshot_id, 'ok' AS status, count(*) AS target_rows FROM {_V2} WHERE o_orderkey % 50 <> 0 UNION ALL SELECT 'drifted', NULL, 'error', 0")
def replica_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables to a new replica, one of which has other columns there: its checkpoint tells the error, the other is synced."""
    source = _history(spark, sf_dir)
    source.tables = source.tables | {"drifted": (_ORDERS, "o_orderkey")}
    target = Store(spark, work_path(spark, "replica"), {"drifted": (T.StructType(_ORDERS.fields[:2]), "o_orderkey")}, width=1000)
    try:
        replica.sync(source, target, ["orders", "drifted"], "r", "c")
    except RuntimeError:
        counts = target.as_of("orders").agg(F.lit("orders").alias("source_table"), F.count("*").alias("n"))
        marks = target.as_of("sync_checkpoints").select("source_table", "last_snapshot_id", "status")
        return marks.join(counts, "source_table", "left").select("source_table", "last_snapshot_id", "status", F.coalesce("n", F.lit(0)).alias("target_rows"))
    raise AssertionError("a table with other columns was synced")


def _replayed(spark: SparkSession, sf_dir: str) -> Store:
    """All ledgers in two batches, then the last quarter of them once more."""
    tables = {"transfers": (_TRANSFERS, "ledger_sequence"), "ingest_watermarks": (ingest.WATERMARKS, "ledger_sequence"), "receipts": (ingest.RECEIPTS, "ledger_start"), "ledger_batches": (ingest.LEDGER_BATCHES, "ledger_sequence"), "ingest_metrics": (ingest.METRICS, "ledger_start")}
    store = Store(spark, work_path(spark, "replayed"), tables)
    rows = transfers(spark, sf_dir).select(*_TRANSFERS.fieldNames())
    low, high = _span(rows, "ledger_sequence")
    half, last = low + (high - low) // 2, high - (high - low) // 4
    for name, a, b in (("first", low - 1, half), ("second", half, high), ("again", last, high)):
        ingest.commit_batch(store, {"transfers": rows.where(C.half_open(F.col("ledger_sequence"), a, b))}, "ledger_sequence", "net", name)
    return store


_PARTS = "(SELECT event_id // 10 AS q, lo, lo + (hi - lo) // 2 AS half, hi - (hi - lo) // 4 AS last FROM events, (SELECT min(event_id // 10) AS lo, max(event_id // 10) AS hi FROM events))"


@query(f"SELECT CASE WHEN q <= half THEN 'first' ELSE 'again' END AS batch_id, min(q) AS ledger_start, max(q) AS ledger_end, count(DISTINCT q) AS ledger_count FROM {_PARTS} WHERE q <= half OR q > last GROUP BY 1")
def receipts_after_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replay ends the receipts that overlap it."""
    return _replayed(spark, sf_dir).as_of("receipts").select("batch_id", "ledger_start", "ledger_end", "ledger_count")


@query(f"SELECT q AS ledger_sequence, CASE WHEN q <= half THEN 'first' WHEN q > last THEN 'again' ELSE 'second' END AS batch_id, count(*) AS row_count FROM {_PARTS} GROUP BY 1, 2")
def ledger_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which batch each ledger's rows are from, and how many they are."""
    return _replayed(spark, sf_dir).as_of("ledger_batches").select("ledger_sequence", "batch_id", "row_count")


@query(f"""SELECT batch_id, count(DISTINCT q) AS ledgers, count(*) AS rows, CAST(count(DISTINCT CASE WHEN batch_id = 'again' THEN q END) AS BIGINT) AS replayed FROM
(SELECT 'first' AS batch_id, q FROM {_PARTS} WHERE q <= half UNION ALL SELECT 'second', q FROM {_PARTS} WHERE q > half UNION ALL SELECT 'again', q FROM {_PARTS} WHERE q > last) GROUP BY 1""")
def ingest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replayed(spark, sf_dir).as_of("ingest_metrics").select("batch_id", "ledgers", "rows", "replayed")


_TEXT = "octet_length(encode(CAST({0} AS VARCHAR))) || ':' || CAST({0} AS VARCHAR)"
_ROW = " || ',' || ".join(f"coalesce({_TEXT.format(c)}, '-')" for c in ("o_orderkey", "o_orderstatus", "o_orderpriority"))


@query(f"""WITH r AS (SELECT sha256({_ROW}) AS h, count(*) AS n FROM orders WHERE o_orderkey > 10 AND o_orderkey <= 100000000 GROUP BY 1),
b AS (SELECT substr(h, 1, 2) AS p, sha256(string_agg(h || ':' || n, ',' ORDER BY h || ':' || n)) AS d FROM r GROUP BY 1),
a AS (SELECT substr(p, 1, 1) AS p, sha256(string_agg(p || ':' || d, ',' ORDER BY p || ':' || d)) AS d FROM b GROUP BY 1)
SELECT CAST((SELECT sum(n) FROM r) AS BIGINT) AS rows, (SELECT count(*) FROM r) AS distinct_rows, 'sha256:' || sha256(string_agg(p || ':' || d, ',' ORDER BY p || ':' || d)) AS digest FROM a""")
def table_digest_of_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests.range_digest(_orders(spark, sf_dir), "o_orderkey", 10, 100_000_000, depth=2)


@query("SELECT true AS agree")
def generations_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of orders per thousand keys, in another order and at other places."""
    entries = _orders(spark, sf_dir).groupBy(F.floor(F.col("o_orderkey") / 1000).alias("f")).agg(F.count("*").alias("rows"), F.min("o_orderkey").alias("min_ledger"), F.max("o_orderkey").alias("max_ledger"))
    again = entries.withColumn("uri", F.concat(F.lit("b/"), "f")).repartition(5, "rows")
    return digests.generations_agree(entries.withColumn("uri", F.concat(F.lit("a/"), "f")), again).select("agree")


@query("""SELECT sha256(CAST(o_orderkey AS VARCHAR)) AS tx_hash, o_orderkey // 10 AS ledger_sequence, CAST(o_custkey % 100 AS INTEGER) AS operation_count
FROM orders WHERE o_orderkey IN (SELECT n_nationkey * 40 + 1 FROM nation)""")
def tx_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index over all transactions, and the hashes of a few looked up in it."""
    path = work_path(spark, "lookup")
    rows = transactions(spark, sf_dir).select(F.col("transaction_hash").alias("tx_hash"), "ledger_sequence", "operation_count")
    lookup.write_lookup_index(rows, path, "tx_hash")
    keys = [r[0] for r in table(spark, sf_dir, "nation").select(F.sha2((F.col("n_nationkey") * 40 + 1).cast("string"), 256)).collect()]
    return lookup.lookup(spark, path, "tx_hash", keys, "tx_hash string, ledger_sequence bigint, operation_count int")


@query("""SELECT l_orderkey, string_agg(l_linestatus, ',' ORDER BY l_linenumber, l_linestatus) AS statuses, bool_or(l_returnflag = 'R') AS has_flag FROM lineitem GROUP BY 1""")
def ordered_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity.ordered_text(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linestatus", "l_linenumber", flag="l_returnflag = 'R'", name="statuses")


@query("SELECT * FROM (VALUES ('events', 'missing', 'no such column')) AS t(table_name, \"column\", problem) UNION ALL SELECT 'orders', 'gone', 'never populated' FROM (SELECT count(*) FILTER (o_orderkey < 0) AS n FROM orders) WHERE n = 0")
def populated_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("gone", F.when(F.col("o_orderkey") < 0, F.col("o_orderkey")))
    return parity.populated({"orders": orders, "events": table(spark, sf_dir, "events")}, {"orders": ["o_orderkey", "gone"], "events": ["ts", "missing"]})


_FILES = "(SELECT o_orderkey // 1000 AS f, count(*) AS n, min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders GROUP BY 1)"


@query(f"""SELECT f, p AS problem FROM {_FILES}, (VALUES ('rows', 1), ('range', 2), ('missing', 3), ('not declared', 4)) AS k(p, m)
WHERE (m = 1 AND f % 4 = 1) OR (m = 2 AND f % 4 = 2) OR (m = 4 AND f % 4 = 3) UNION ALL SELECT f + 1000000, 'missing' FROM {_FILES} WHERE f % 4 = 3""")
def footer_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a thousand keys each; of four in a row one is declared right, one with a row too many, one with another range, and
    one under another name."""
    path = work_path(spark, "footers")
    rows = _orders(spark, sf_dir).withColumn("f", F.floor(F.col("o_orderkey") / 1000).cast("bigint"))
    corpus.write_keyed(rows, path, "f", ["o_orderkey"])
    name = F.regexp_extract("uri", r"/f=(-?[0-9]+)[./]", 1).cast("bigint")
    found = footers.footers(footers.listed(spark, path), "o_orderkey").withColumn("uri", name.cast("string"))
    kind = F.col("f") % 4
    declared = rows.groupBy("f").agg((F.count("*") + F.when(kind == 1, 1).otherwise(0)).alias("rows"), F.min("o_orderkey").alias("min_ledger"), (F.max("o_orderkey") + F.when(kind == 2, 1).otherwise(0)).alias("max_ledger"))
    declared = declared.withColumn("uri", (F.col("f") + F.when(kind == 3, 1_000_000).otherwise(0)).cast("string"))
    return footers.footer_violations(found, declared).select(F.col("uri").cast("bigint").alias("f"), "problem")


@query(f"""WITH e AS (SELECT f, n, lo, hi, 'lake.t' || f % 3 AS t FROM {_FILES}), o AS (SELECT *, row_number() OVER (ORDER BY t, lo) AS place FROM e)
SELECT 's3://b/' || f AS subject, p AS problem FROM o, (VALUES ('uri', 5), ('no rows', 6), ('file digest', 7)) AS k(p, m) WHERE f % 11 = m
UNION ALL SELECT 'lake.t0', 'row count' UNION ALL SELECT 'result', 'attempt' UNION ALL SELECT 'result', 'ledger count'""".replace("'s3://b/' || f AS subject", "CASE WHEN f % 11 = 5 THEN 's3:///' || f ELSE 's3://b/' || f END AS subject"))
def result_acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result of one file per thousand orders with bad places, counts and digests, and two wrong facts."""
    files = _orders(spark, sf_dir).groupBy(F.floor(F.col("o_orderkey") / 1000).cast("bigint").alias("f")).agg(F.count("*").alias("n"), (F.min("o_orderkey") + 1).alias("min_ledger"), (F.max("o_orderkey") + 1).alias("max_ledger"))
    kind, good = F.col("f") % 11, F.concat(F.lit("sha256:"), F.sha2(F.col("f").cast("string"), 256))
    files = files.select(
        F.concat(F.lit("lake.t"), F.col("f") % 3).alias("table"), F.concat(F.when(kind == 5, "s3:///").otherwise("s3://b/"), "f").alias("uri"), F.when(kind == 7, F.upper(good)).otherwise(good).alias("sha256"),
        good.alias("schema_sha256"), (F.col("n") * 10).alias("bytes"), F.when(kind == 6, 0).otherwise(F.col("n")).alias("rows"), "min_ledger", "max_ledger",
    )
    # a file's table and range tell its place: three tables, each by its lowest key
    files = stage_table(files.withColumn("place", F.substring("table", 7, 1).cast("bigint") * 10**12 + F.col("min_ledger")), "entries")
    counts = files.groupBy("table").agg((F.sum("rows") + F.when(F.col("table") == "lake.t0", 1).otherwise(0)).alias("rows"))
    low, high = files.agg(F.min("min_ledger"), F.max("max_ledger")).first()
    shard = {"format_version": 1, "job_id": "j", "shard_id": "s", "ledger_start": low, "ledger_end": high, "max_attempts": 3}
    digest = "sha256:" + "0" * 64
    result = shard | {"generation_digest": acceptance.generation_digest(files), "ledger_count": high - low, "source_digest": digest, "schema_fingerprint": digest, "worker_id": "w", "attempt": 4, "started_at": "2024-01-01T00:00:00Z", "completed_at": "2024-01-01T00:00:01Z"}
    return acceptance.result_violations(result, shard, files, counts)


_WIDER = T.StructType([*_TRANSFERS.fields, T.StructField("kind", T.StringType()), T.StructField("large", T.BooleanType())])


@query("SELECT event_id // 10 AS ledger_sequence, event_type, user_id, CAST(value AS DECIMAL(18,2)) AS amount, ts, upper(event_type) AS kind, CAST(value AS DECIMAL(18,2)) > 50 AS large FROM events")
def migrated_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transfers written before two columns were declared, then two migrations that fill them, run twice."""
    path = work_path(spark, "migrated")
    Store(spark, path, {"transfers": (_TRANSFERS, "ledger_sequence")}).commit({"transfers": Change(rows=transfers(spark, sf_dir))})
    store = Store(spark, path, {"transfers": (_WIDER, "ledger_sequence"), "schema_migrations": (migrations.MIGRATIONS, "version")})
    steps = [migrations.Migration(2, "large", migrations.filled("transfers", large=F.col("amount") > 50)), migrations.Migration(1, "kind", migrations.filled("transfers", kind=F.upper("event_type")))]
    for _ in range(2):
        migrations.apply_migrations(store, steps)
    return store.as_of("transfers")


@query("SELECT event_id // 10 AS ledger_sequence, event_type, user_id, CAST(value AS DECIMAL(18,2)) AS amount, ts FROM events")
def backfill_after_lost_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in four gapless runs of ledgers; each is written, its answer counts as lost, and it comes again under another
    batch id: the same ledgers are replaced."""
    tables = {"transfers": (_TRANSFERS, "ledger_sequence"), "ingest_watermarks": (ingest.WATERMARKS, "ledger_sequence"), "receipts": (ingest.RECEIPTS, "ledger_start")}
    store = Store(spark, work_path(spark, "lost"), tables)
    rows = transfers(spark, sf_dir).select(*_TRANSFERS.fieldNames())
    low, high = _span(rows, "ledger_sequence")
    writer, step = ingest.Writer(store, "ledger_sequence", "net", "backfill"), -(-(high - low + 1) // 4)
    for k in range(4):
        part = rows.where(C.half_open(F.col("ledger_sequence"), low - 1 + k * step, low - 1 + (k + 1) * step))
        if part.isEmpty():
            continue
        writer.write({"transfers": part}, f"lost-{k}")
        writer.force_replay = True  # as after an answer that never came
        writer.write({"transfers": part}, f"again-{k}")
    return store.as_of("transfers")


@query("""WITH d AS (SELECT user_id, count(*) AS n, sum(CAST(value AS DECIMAL(18,2))) AS total FROM events GROUP BY 1)
SELECT user_id, n, total FROM d""")
def promoted_into_a_new_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A proposal whose target does not exist yet, published twice with reports: the table is made once, then replaced by keys."""
    path = work_path(spark, "new-target")
    store = Store(spark, path, {"transfers": (_TRANSFERS, "ledger_sequence"), "promotions": (gatekeeper.RECEIPTS, "source_snapshot_id")})
    store.commit({"transfers": Change(rows=transfers(spark, sf_dir)), "promotions": Change(rows=spark.createDataFrame([], gatekeeper.RECEIPTS))})
    low, high = _span(store.as_of("transfers"), "ledger_sequence")
    sql = "SELECT user_id, count(*) AS n, CAST(sum(amount) AS DECIMAL(38,2)) AS total FROM source WHERE ledger_sequence > :start_ledger AND ledger_sequence <= :end_ledger GROUP BY user_id"
    proposal = gatekeeper.Proposal("new", "agent", "lake.bronze.transfers", 1, low - 1, high, "lake.silver.by_user", ("user_id",), sql, (("unique_users", "SELECT count(*) = count(DISTINCT user_id) FROM candidate"),))
    for _ in range(2):
        gatekeeper.promote_reported(spark, store, proposal, work_path(spark, "reports"))
    again = Store(spark, path, gatekeeper.created_tables(store))
    return again.as_of("by_user")
