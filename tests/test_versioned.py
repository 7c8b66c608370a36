import random

import pytest
from pyspark.sql import types as T

from ledgerloom.operators import parity
from ledgerloom.plans import replica
from ledgerloom.plans.versioned import Change, CommitConflict, SnapshotExpired, Store
from ledgerloom.session import work_path

S = T.StructType([T.StructField("seq", T.LongType()), T.StructField("v", T.StringType())])
TABLES = {"t": (S, "seq"), "sync_checkpoints": (replica.CHECKPOINTS, "last_snapshot_id")}


def rows(df):
    return sorted((r["seq"] if r["seq"] is not None else -1, r["v"] or "") for r in df.collect())


@pytest.fixture(scope="module")
def history(spark):
    """A store and a Python model of every version."""
    rng = random.Random(5)
    store, now, versions = Store(spark, work_path(spark, "model"), TABLES, width=10), [], [[]]
    for k in range(9):
        lo = rng.randrange(40)
        clear = [(lo, lo + rng.randrange(15))] if k and k != 6 else []
        new = [(rng.randrange(50), f"v{k}") for _ in range(12)] + ([(None, f"n{k}")] if k % 2 else [])
        gone = {4: ["v1", "n1", None], 8: ["v7", "absent"]}.get(k, [])
        if k == 2:
            new += [(3, None), (4, None)]
        now = [r for r in now if k != 6 and r[1] not in gone and not any(r[0] is not None and a <= r[0] <= b for a, b in clear)] + new
        keys = spark.createDataFrame([(v,) for v in gone], "v string") if gone else None
        store.commit({"t": Change(rows=spark.createDataFrame(new, S), clear=[(None, None)] if k == 6 else clear, clear_rows=keys)}, batch_id=f"b{k}", digest="d")
        versions.append(list(now))
    return store, versions


def test_every_version(history):
    store, versions = history
    for n in range(1, len(versions)):
        assert rows(store.as_of("t", n)) == sorted((s if s is not None else -1, v or "") for s, v in versions[n])


@pytest.mark.parametrize(("low", "high"), [(3, 6), (4, 9), (7, 7)])
def test_changes_lead_from_version_to_version(history, spark, low, high):
    store, versions = history
    got = store.table_changes("t", low, high)
    keep = got.where("change_type = 'insert'").select("seq", "v")
    gone = got.where("change_type = 'delete'").select("seq", "v")
    assert parity.equal(store.as_of("t", low - 1).unionAll(keep), store.as_of("t", high).unionAll(gone))


def test_batch_ids(history, spark):
    store, _ = history
    n = store.current()
    assert store.commit({"t": Change(rows=spark.createDataFrame([(1, "again")], S))}, batch_id="b3", digest="d") == (4, False)
    with pytest.raises(CommitConflict):
        store.commit({"t": Change()}, batch_id="b3", digest="other")
    assert store.current() == n


def test_second_writer_loses(spark):
    store = Store(spark, work_path(spark, "race"), TABLES)
    store.commit({"t": Change(rows=spark.createDataFrame([(1, "a")], S))})
    with pytest.raises(CommitConflict):
        store._append_log({"snapshot": 1, "kind": "commit", "tables": {}})


def test_an_unfinished_entry_is_no_commit(spark):
    root = work_path(spark, "torn")
    store = Store(spark, root, TABLES)
    store.commit({"t": Change(rows=spark.createDataFrame([(1, "a")], S))})
    store._fs.create(store._path("_log/000000000002.json"), False).close()
    other = Store(spark, root, TABLES)
    assert other.current() == 1 and rows(other.as_of("t")) == [(1, "a")]
    assert other.commit({"t": Change(rows=spark.createDataFrame([(2, "b")], S))}) == (3, True)
    assert rows(store.as_of("t")) == [(1, "a"), (2, "b")]


def test_many_commits_are_one_scan(spark):
    store = Store(spark, work_path(spark, "many"), TABLES, width=10)
    for k in range(12):
        store.commit({"t": Change(rows=spark.createDataFrame([(k, f"v{k}")], S).coalesce(1), clear=[(k - 5, k - 5)] if k > 8 else [])})
    plan = store.as_of("t")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2  # the rows, the tombstones
    assert rows(store.as_of("t")) == [(k, f"v{k}") for k in (0, 1, 2, 3, 7, 8, 9, 10, 11)]


def test_replica_incremental_and_full(spark):
    source, target = (Store(spark, work_path(spark, n), TABLES, width=10) for n in ("src", "dst"))
    source.commit({"t": Change(rows=spark.createDataFrame([(i, "a") for i in range(30)], S))})
    target.commit({"t": Change(rows=spark.createDataFrame([(99, "stale")], S)), "sync_checkpoints": Change(rows=spark.createDataFrame([], replica.CHECKPOINTS))})
    assert replica.sync(source, target, ["t"], "r", "c") == {"t": "incremental"}
    source.commit({"t": Change(rows=spark.createDataFrame([(5, "b"), (6, "b")], S), clear=[(4, 8)])})
    assert replica.sync(source, target, ["t"], "r", "c") == {"t": "incremental"}
    assert rows(target.as_of("t").where("seq <> 99")) == rows(source.as_of("t"))
    assert replica.sync(source, target, ["t"], "r", "c") == {"t": "unchanged"}
    source.commit({"t": Change(rows=spark.createDataFrame([(7, "c")], S))})
    source.compact("t")
    with pytest.raises(SnapshotExpired):
        source.as_of("t", 1)
    assert replica.sync(source, target, ["t"], "r", "c") == {"t": "full"}
    assert rows(target.as_of("t")) == rows(source.as_of("t"))


def test_a_failing_table_keeps_its_mark(spark):
    other = T.StructType([*S.fields, T.StructField("more", T.StringType())])
    source = Store(spark, work_path(spark, "two"), {"t": (S, "seq"), "u": (S, "seq")}, width=10)
    target = Store(spark, work_path(spark, "dst2"), {"u": (other, "seq")}, width=10)
    source.commit({"t": Change(rows=spark.createDataFrame([(1, "a")], S)), "u": Change(rows=spark.createDataFrame([(1, "p w")], S))})
    with pytest.raises(RuntimeError, match="unexpected"):
        replica.sync(source, target, ["t", "u"], "r", "c", secrets=("more",))
    marks = {r["source_table"]: r for r in target.as_of("sync_checkpoints").collect()}
    assert (marks["t"]["last_snapshot_id"], marks["t"]["status"]) == (1, "ok") and rows(target.as_of("t")) == [(1, "a")]
    assert (marks["u"]["last_snapshot_id"], marks["u"]["status"]) == (None, "error") and marks["u"]["error_message"] == "u: unexpected [REDACTED]"
    target.tables["u"] = (S, "seq")
    assert replica.sync(source, target, ["t", "u"], "r", "c") == {"t": "unchanged", "u": "incremental"}
    assert rows(target.as_of("u")) == [(1, "p w")] and target.as_of("sync_checkpoints").count() == 2


def test_drift_is_refused(spark):
    assert replica.column_drift(["a", "b"], ["b", "c"]) == "missing a; unexpected c"


def test_single_ledgers_end_by_equality(spark):
    """In one range bucket: no join compares a bucket's rows with all its ended ledgers; null sequence numbers stay."""
    store = Store(spark, work_path(spark, "single"), TABLES)
    store.commit({"t": Change(rows=spark.createDataFrame([(k, "old") for k in range(200)] + [(None, "none")], S))})
    gone = spark.createDataFrame([(k,) for k in range(0, 200, 2)] + [(0,), (None,), (9_999,)], "seq int")
    store.commit({"t": Change(rows=spark.createDataFrame([(4, "new")], S), clear_keys=gone, clear=[(101, 103)], clear_rows=spark.createDataFrame([(7, "old")], S))})
    store.commit({"t": Change(clear_rows=spark.createDataFrame([(9,)], "seq long"))})
    want = [(-1, "none"), (4, "new")] + [(k, "old") for k in range(1, 200, 2) if k not in (7, 9, 101, 103)]
    assert rows(store.as_of("t")) == sorted(want)
    ended = store.table_changes("t", 2, 3).where("change_type = 'delete'")
    assert sorted((r["snapshot_id"], r["seq"]) for r in ended.collect()) == sorted([(2, k) for k in range(0, 200, 2)] + [(2, 7), (2, 101), (2, 103), (3, 9)])
    only = Store(spark, work_path(spark, "only"), TABLES)
    only.commit({"t": Change(rows=spark.createDataFrame([(1, "a"), (2, "b")], S))})
    only.commit({"t": Change(clear_keys=spark.createDataFrame([(1,)], "seq long"))})
    plan = only.as_of("t")._jdf.queryExecution().optimizedPlan().toString()
    assert rows(only.as_of("t")) == [(2, "b")] and "sequence(" not in plan and " lo#" not in plan
