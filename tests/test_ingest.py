import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.plans.versioned import CommitConflict, Store
from ledgerloom.session import work_path
from ledgerloom.streaming import ingest

S = T.StructType([T.StructField("seq", T.LongType()), T.StructField("v", T.StringType())])
TABLES = {"t": (S, "seq"), "ingest_watermarks": (ingest.WATERMARKS, "ledger_sequence"), "receipts": (ingest.RECEIPTS, "ledger_start")}


def test_replays_receipts_and_limits(spark):
    store = Store(spark, work_path(spark, "ing"), TABLES, width=10)
    df = lambda *s, v="a": {"t": spark.createDataFrame([(x, v) for x in s], S)}
    put = lambda rows, i, **k: ingest.commit_batch(store, rows, "seq", "net", i, **k)
    assert put(df(1, 2, 3), "b1", contiguous=True) == (1, True)
    assert put(df(1, 2, 3), "b1", contiguous=True) == (1, False)
    with pytest.raises(CommitConflict):
        put(df(1, 2), "b1")
    with pytest.raises(ValueError, match="follow"):
        put(df(5), "b2", contiguous=True)
    with pytest.raises(ValueError, match="limits"):
        put(df(4, 5, 6), "b2", max_ledgers=2)
    with pytest.raises(ValueError, match="network"):
        ingest.commit_batch(store, df(4), "seq", "other", "b2")
    put(df(2, 4, v="b"), "b3")
    assert sorted(map(tuple, store.as_of("t").collect())) == [(1, "a"), (2, "b"), (3, "a"), (4, "b")]
    assert store.as_of("ingest_watermarks").count() == 4 and ingest.high_watermark(store, "net") == 4


def test_receipts_batches_and_metrics(spark):
    tables = TABLES | {"ledger_batches": (ingest.LEDGER_BATCHES, "ledger_sequence"), "ingest_metrics": (ingest.METRICS, "ledger_start")}
    store = Store(spark, work_path(spark, "full"), tables, width=10)
    df = lambda *s: {"t": spark.createDataFrame([(x, "v") for x in s], S)}
    put = lambda rows, i, **k: ingest.commit_batch(store, rows, "seq", " net ", i, **k)
    put(df(1, 2, 3), "a")
    put(df(4, 5), "b", declared={"ledgers": 2, "rows": 2})
    put(df(3, 4, 4, 6), "c")  # replays 3 and 4: both receipts overlap
    assert [r["batch_id"] for r in store.as_of("receipts").collect()] == ["c"]
    assert sorted(map(tuple, store.as_of("ledger_batches").collect())) == [("net", 1, "a", 1), ("net", 2, "a", 1), ("net", 3, "c", 1), ("net", 4, "c", 2), ("net", 5, "b", 1), ("net", 6, "c", 1)]
    told = {r["batch_id"]: r for r in store.as_of("ingest_metrics").collect()}
    assert (told["c"]["ledgers"], told["c"]["rows"], told["c"]["replayed"], told["a"]["bytes"]) == (3, 4, 2, 3 * len('{"seq":1,"v":"v"}')) and told["a"]["prepare_ms"] > 0
    with pytest.raises(ValueError, match="declared"):
        put(df(7), "d", declared={"ledgers": 2})
    with pytest.raises(ValueError, match="bytes exceeds"):
        put(df(7, 8, 9), "d", max_bytes=40)
    runs = spark.createDataFrame([("r1", 5, 100, 9), ("r2", 50, 10, 9)], "run string, ledgers long, bytes long, rows long")
    assert list(map(tuple, ingest.declared_limits(runs, max_ledgers=10, max_bytes=1000).collect())) == [("r2", "ledgers 50 over 10")]


def test_digests_see_places_and_nulls(spark):
    of = lambda *rows: ingest.payload_digest(spark.createDataFrame(rows, "seq long, a string, b string"), "seq")
    same = of((1, "x", None), (2, "y", "z"))
    assert same == of((2, "y", "z"), (1, "x", None)) != of((1, None, "x"), (2, "y", "z"))
    assert of((1, "x", None)) != of((1, "x", None), (1, "x", None))


def test_stream_restart(spark):
    store = Store(spark, work_path(spark, "stream"), TABLES, width=10)
    src, offsets = work_path(spark, "in"), work_path(spark, "off")
    for k in range(3):
        spark.createDataFrame([(i, f"v{k}") for i in range(k * 5, k * 5 + 5)], S).write.mode("append").parquet(src)
        ingest.stream_into(store, spark.readStream.schema(S).parquet(src), lambda b: {"t": b}, "seq", "net", "q", offsets).awaitTermination()
    assert store.as_of("t").count() == 15 and store.current() == 3


def test_reorder_stream(spark):
    schema = "network string, seq long, payload string, end boolean"
    src, off, out = work_path(spark, "rin"), work_path(spark, "roff"), work_path(spark, "rout")

    def feed(*seqs, end=False):
        spark.createDataFrame([("n", s, f"p{s}", False) for s in seqs] + [("n", None, None, True)] * end, schema).coalesce(1).write.mode("append").parquet(src)
        ingest.reorder_stream(spark.readStream.schema(schema).parquet(src), "seq", 2).writeStream.format("parquet").option("checkpointLocation", off).option("path", out).trigger(availableNow=True).start().awaitTermination()
        return sorted(r["seq"] for r in spark.read.parquet(out).collect())

    assert feed(3, 1, 2, 5) == [1, 2]
    assert feed(4, 6, 7) == [1, 2, 3, 4, 5]
    assert feed(end=True) == [1, 2, 3, 4, 5, 6, 7]
    with pytest.raises(Exception, match="later than the window|after"):
        feed(2)


def test_fan_out(spark):
    seen = []
    ingest.fan_out(spark.range(3), [lambda d: seen.append(d.count()), lambda d: seen.append(d.agg(F.sum("id")).first()[0])])
    assert seen == [3, 3]


def test_writer_repeats_after_a_lost_answer(spark, monkeypatch):
    store = Store(spark, work_path(spark, "writer"), TABLES, width=10)
    df = lambda *s, v="a": {"t": spark.createDataFrame([(x, v) for x in s], S)}
    w, commit = ingest.Writer(store, "seq", "net", "backfill", max_ledgers=3), store.commit
    with pytest.raises(ValueError, match="limits"):
        w.write(df(1, 2, 3, 4), "big")
    assert not w.force_replay and w.write(df(1, 2, 3), "b1") == (1, True)
    lost = iter([True, False])

    def forgetful(*a, **k):
        got = commit(*a, **k)
        if next(lost):
            raise OSError("no answer")
        return got

    monkeypatch.setattr(store, "commit", forgetful)
    assert w.write(df(4, 5), "b2") == (2, False) and w.retries == 1 and not w.force_replay  # it had been done: found by its id
    monkeypatch.setattr(store, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("down")))
    with pytest.raises(OSError):
        w.write(df(6), "b3")
    assert w.force_replay and w.retries == 2
    monkeypatch.setattr(store, "commit", commit)
    with pytest.raises(ValueError, match="follow"):
        w.write(df(8), "gap")
    w.write(df(5, 6, v="b"), "b4")  # replaces what may have been written, whatever the watermark says
    assert not w.force_replay and sorted(map(tuple, store.as_of("t").collect())) == [(1, "a"), (2, "a"), (3, "a"), (4, "a"), (5, "b"), (6, "b")]
    assert sorted(r["batch_id"] for r in store.as_of("receipts").collect()) == ["b1", "b4"]


def test_profiles_do_not_mix(spark):
    store = Store(spark, work_path(spark, "profiles"), TABLES, width=10)
    df = lambda *s: {"t": spark.createDataFrame([(x, "a") for x in s], S)}
    back, live = ingest.Writer(store, "seq", "net", "backfill"), ingest.Writer(store, "seq", "net")
    back.write(df(1, 2), "b")
    with pytest.raises(ValueError, match="backfill profile"):
        live.write(df(3), "l")
    live.take_over()
    live.write(df(3), "l")
    with pytest.raises(ValueError, match="limits"):
        live.write(df(4, 5), "two")
    with pytest.raises(ValueError, match="live profile"):
        back.write(df(4), "b2")
    for bad in ({"profile": "other"}, {"attempts": 0}, {"max_rows": 1}):
        with pytest.raises(ValueError):
            ingest.Writer(store, "seq", "net", **bad)


def ended_by_equality(store, name):
    """Replays leave no ranges, whose join would meet every row of a bucket with every replayed ledger of it."""
    told = [at for e in store.log() for at in e.get("tables", {}).values()]
    return not any("tombstones" in at for at in told) and any("ledgers" in at for at in told) and " lo#" not in store.as_of(name)._jdf.queryExecution().optimizedPlan().toString()


def replayed_store(spark, label):
    schema = T.StructType([T.StructField("ledger_sequence", T.LongType()), T.StructField("v", T.StringType())])
    tables = {"t": (schema, "ledger_sequence"), "ingest_watermarks": (ingest.WATERMARKS, "ledger_sequence"), "receipts": (ingest.RECEIPTS, "ledger_start")}
    return Store(spark, work_path(spark, label), tables), spark.range(1, 301).select(F.col("id").alias("ledger_sequence"), F.concat(F.lit("v"), "id").alias("v")), schema


def test_a_replayed_stream_ends_single_ledgers(spark):
    store, rows, schema = replayed_store(spark, "replayed-stream")
    source = work_path(spark, "incoming")
    rows.write.parquet(source)
    for name in ("one", "two"):
        ingest.stream_into(store, spark.readStream.schema(schema).parquet(source), lambda b: {"t": b}, "ledger_sequence", "net", f"{name}_{source[-8:]}", work_path(spark, "offsets")).awaitTermination()
    assert ended_by_equality(store, "t") and ended_by_equality(store, "ingest_watermarks")
    assert sorted(map(tuple, store.as_of("t").collect())) == sorted(map(tuple, rows.collect())) and store.as_of("ingest_watermarks").count() == 300


def test_a_lost_answer_ends_single_ledgers(spark):
    store, rows, _ = replayed_store(spark, "replayed-backfill")
    writer = ingest.Writer(store, "ledger_sequence", "net", "backfill")
    for low, high in ((1, 200), (201, 300)):
        part = rows.where(F.col("ledger_sequence").between(low, high))
        writer.write({"t": part}, f"lost-{low}")
        writer.force_replay = True
        writer.write({"t": part.withColumn("v", F.concat("v", F.lit("!")))}, f"again-{low}")
    assert ended_by_equality(store, "t")
    assert sorted(map(tuple, store.as_of("t").collect())) == sorted((k, f"v{k}!") for k in range(1, 301)) and store.as_of("receipts").count() == 2
