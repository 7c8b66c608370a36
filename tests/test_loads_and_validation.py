import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import columns as C
from ledgerloom.operators import ranges, rollups, validation
from ledgerloom.plans import loads, replica
from ledgerloom.plans.versioned import Change, SnapshotExpired, Store
from ledgerloom.session import stage_table, work_path
from ledgerloom.sources import corpus, envelope

S = T.StructType([T.StructField("seq", T.LongType()), T.StructField("v", T.StringType())])


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_declared_differs(spark):
    d = spark.createDataFrame([(1, 5, None), (2, 5, "a"), (3, 5, "a")], "k int, n int, h string")
    o = spark.createDataFrame([(1, 5, None), (2, 6, None), (4, 5, "a")], "k int, n int, h string")
    assert got(validation.declared_differs(d, o, ["k"], ["n", "h"])) == [(2, "differs in n,h"), (3, "not observed"), (4, "not declared")]
    assert validation.declared_differs(d.limit(0), o.limit(0), ["k"], ["n", "h"]).isEmpty()


def test_corpus_and_job(spark):
    fields = "path string, sha256 string, bytes bigint, ledgers bigint, ledger_start bigint, ledger_end bigint"
    good = [("a", "0" * 64, 1, 5, 1, 5), ("b", "1" * 64, 1, 5, 6, 10)]
    assert validation.validate_corpus(spark.createDataFrame(good, fields), 1, 10).isEmpty()
    bad = [("a", "0" * 64, 1, 5, 1, 5), ("a", "xyz", 1, 5, 6, 10), ("", "1" * 64, 1, 3, 12, 14), ("d", "1" * 64, 0, 1, 15, 15), ("e", "1" * 64, 1, 9, 16, 16)]
    assert got(validation.validate_corpus(spark.createDataFrame(bad, fields), 1, 16)) == sorted([
        ("a", "digest form"), ("", "no path"), ("d", "no bytes"), ("e", "count differs from range"), ("a", "repeated path"), ("12-14", "leaves a gap")], key=repr)
    shards = spark.createDataFrame([(1, 5), (6, 9)], "ledger_start bigint, ledger_end bigint").withColumn("shard_id", validation.shard_id("j", "n", 1))
    assert validation.validate_job(shards, 1, 9, "j", "n", 1).isEmpty()
    assert [p for _, p in got(validation.validate_job(shards, 1, 10, "j2", "n", 1))] == ["shard_id is not derived", "does not end the range", "shard_id is not derived"]


def test_retries(spark):
    a = spark.createDataFrame([("t", 1, "w1", "u1"), ("s", 2, "w1", "u2")], "table string, rows int, worker string, uri string")
    b = spark.createDataFrame([("s", 2, "w2", "x"), ("t", 1, "w2", "y")], "table string, rows int, worker string, uri string")
    assert validation.retries_agree(a, b).first()["agree"]
    assert not validation.retries_agree(a, b.where("rows = 1")).first()["agree"]


def test_burst_and_offset(spark):
    rows = spark.createDataFrame([(None, 3), (None, 1), (None, 2), ("a", 9), ("b", 1), ("b", 0)], "k string, o int")
    assert got(rollups.burst_exempt(rows, ["k"], ["o"], 1)) == sorted([(None, 3, False), (None, 1, True), (None, 2, False), ("a", 9, True), ("b", 1, False), ("b", 0, True)], key=repr)
    df = spark.createDataFrame([(i * 3, "x") for i in [0, 1, 1, 2, 5, 9, 40]] + [(None, "n")], S)
    assert sorted(r["seq"] for r in ranges.take_after(df, "seq", 1, 3, width=10).collect()) == [3, 3, 6, 15]
    with pytest.raises(ValueError):
        ranges.take_after(df, "seq", 4, 3, width=10)


def test_descriptors_ignore_row_order(spark):
    rows = [("g", 1, "a"), ("g", 1, "b"), ("g", 2, "ä"), ("h", 3, None)]
    df = spark.createDataFrame(rows, "g string, q bigint, p string")
    back = spark.createDataFrame(rows[::-1], "g string, q bigint, p string")
    assert got(ranges.range_descriptors(df, "g", "q", "p")) == got(ranges.range_descriptors(back, "g", "q", "p"))
    g = ranges.range_descriptors(df, "g", "q", "p").where("g = 'g'").first()
    assert (g["ledger_start"], g["ledger_end"], g["ledgers"], g["bytes"], g["rows"], g["peak_bytes"], g["peak_rows"]) == (1, 2, 2, 4, 3, 2, 2)


def test_network_state(spark):
    problem = lambda v: rollups.single_value_state(spark.createDataFrame([(x,) for x in v], "n string"), "n").first()["problem"]
    assert [problem(v) for v in ([], ["a"], ["a", "a"], ["a", "b"], [" "], [None])] == ["absent", None, "repeated", "several values", "blank", "blank"]


def test_loose_kinds(spark):
    texts = [None, "null", '"12"', "true", "12", "-7", "1.5", "1e3", "9223372036854775808", "[1]", '{"a": 1}', "NaN"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", C.loose_kind(F.col("t")).alias("k"))
    assert [k for _, k in sorted(df.collect())] == ["null", "null", "string", "bool", "bigint", "bigint", "double", "double", "double", "json", "json", "json"]


def test_materialize(spark):
    store = Store(spark, work_path(spark, "index"), {"i": (S, "seq")}, width=10)
    build = lambda lo, hi: spark.range(lo + 1, hi + 1).selectExpr("id AS seq", "'x' AS v")
    assert loads.materialize(store, "i", build, 0, 25, chunk=10) == 3
    assert loads.materialize(store, "i", build, 5, 5) == 0
    loads.materialize(store, "i", build, 3, 18)
    assert sorted(r["seq"] for r in store.as_of("i").collect()) == list(range(1, 26))
    with pytest.raises(RuntimeError, match="ledgers 11 to 20"):
        loads.materialize(store, "i", lambda lo, hi: build(lo, hi) if lo < 10 else build(lo, hi).select("absent"), 0, 25, chunk=10)
    for args in (("j", build, 0, 1), ("i", build, 2, 1), ("i", build, 0, 1, 0)):
        with pytest.raises(ValueError):
            loads.materialize(store, *args)


def test_maintenance(spark):
    store = Store(spark, work_path(spark, "upkeep"), {"t": (S, "seq"), "sync_checkpoints": (replica.CHECKPOINTS, "last_snapshot_id")}, width=10)
    for i in range(3):
        store.commit({"t": Change(rows=spark.createDataFrame([(i, "a")], S))})
    lagging = spark.createDataFrame([("r", "c", "t", 1, "ok", None, None)], replica.CHECKPOINTS)
    with pytest.raises(ValueError, match="replica"):
        loads.maintain(store, retain=1, checkpoints=lagging)
    assert loads.maintain(store, retain=1) == {"expire": "2"}
    with pytest.raises(SnapshotExpired):
        store.as_of("t", 1)
    assert loads.maintain(store, small_commits=3) == {"t": "compacted"}
    assert got(store.as_of("t")) == [(0, "a"), (1, "a"), (2, "a")]


def test_typed_tables_from_lines(spark, tmp_path):
    rows = [{"tableName": "ledgers", "rowJson": json.dumps({"Sequence": 7, "LedgerHash": "h"})}, {"tableName": "other", "rowJson": "{}"}, {"tableName": "tx", "rowJson": json.dumps({"LedgerSequence": 7, "TransactionHash": "a"})}]
    batch = {"networkPassphrase": "net", "ledgerSequence": 7, "closedAtUnix": "1", "bronzeRows": rows, "transactions": [{"transactionHash": "a", "envelopeXdr": "old"}, {"transactionHash": "a", "envelopeXdr": "new", "resultXdr": "r"}]}
    (tmp_path / "b.json").write_text(json.dumps({"type": "batch", "batch": batch}) + "\n" + json.dumps({"type": "ping"}) + "\n")
    q = envelope.stream_batches(spark, str(tmp_path), "batch").writeStream.format("memory").queryName("lines").option("checkpointLocation", work_path(spark, "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    b = spark.table("lines")
    long, text = T.LongType(), T.StringType()
    specs = {
        "ledgers": envelope.TableSpec("ledgers", T.StructType([T.StructField("sequence", long), T.StructField("ledger_hash", text)]), seq="sequence"),
        "tx": envelope.TableSpec("tx", T.StructType([T.StructField("ledger_sequence", long)] + [T.StructField(n, text) for n in ("transaction_hash", "tx_envelope", "tx_result", "tx_meta")])),
    }
    tables = loads.typed_tables(b, specs)
    assert got(tables["ledgers"]) == [(7, "h")]
    assert got(tables["tx"]) == [(7, "a", "new", "r", None)]
    with pytest.raises(Exception, match="unknown table other"):
        loads.typed_tables(b, specs, unknown="fail")["tx"].collect()


def test_rolling(spark):
    df = spark.range(0, 5000).select(F.col("id").alias("seq"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    path = work_path(spark, "rolling")
    files = corpus.write_rolling(df, path, "seq", 60_000, 200_000)
    assert files.count() > 3 and files.agg(F.sum("rows")).first()[0] == 5000
    with pytest.raises(ValueError):
        corpus.write_rolling(df, work_path(spark, "rolling"), "seq", 60_000, 10_000)


def test_json_rows_are_replaced_without_reading_payloads_for_keys(spark):
    lists = "networkPassphrase string, ledgerSequence long, bronzeRows array<struct<tableName: string, rowJson: string>>"
    b = stage_table(spark.createDataFrame([("n", 1, [("a", "{1}"), (None, "{2}"), ("a", "{3}")]), ("n", 2, None), ("n", 3, [])], lists), "envelopes")
    schema = "id string, network_passphrase string, ledger_sequence long, table_name string, row_ordinal int, row_json string"
    table = spark.createDataFrame([("x", "n", 1, "a", 9, "old"), ("x", "n", 1, None, 9, "old"), ("y", "n", 1, "b", 9, "stays"), ("y", "n", 2, "a", 9, "stays"), ("y", "n", 3, None, 9, "stays"), ("y", None, 1, "a", 9, "stays")], schema)
    got = loads.replace_json_rows(table, b)
    found = sorted((r["ledger_sequence"], r["table_name"] or "", r["row_ordinal"], r["row_json"]) for r in got.collect())
    assert found == sorted([(1, "a", 0, "{1}"), (1, "", 0, "{2}"), (1, "a", 1, "{3}"), (1, "b", 9, "stays"), (2, "a", 9, "stays"), (3, "", 9, "stays"), (1, "a", 9, "stays")])
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        plan = loads.replace_json_rows(table, b)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert plan.count("ReadSchema") == 2 and plan.count("rowJson:string") == 1
