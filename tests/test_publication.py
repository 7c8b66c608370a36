import dataclasses

import pytest
from pyspark.sql import types as T

from ledgerloom.plans import gatekeeper as G
from ledgerloom.plans.versioned import Change, Store
from ledgerloom.session import work_path

SRC = T.StructType([T.StructField("ledger", T.LongType()), T.StructField("k", T.StringType())])
OUT = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType())])
P = G.Proposal("p", "a", "c.s.src", 1, 0, 20, "c.s.out", ("k",), "SELECT k, count(*) AS n FROM source WHERE ledger > :start_ledger AND ledger <= :end_ledger GROUP BY k", (("some", "SELECT count(*) > 0 FROM candidate"),))


@pytest.fixture()
def store(spark):
    s = Store(spark, work_path(spark, "gate"), {"src": (SRC, "ledger"), "out": (OUT, "n"), "promotions": (G.RECEIPTS, "source_snapshot_id")})
    s.commit({"src": Change(rows=spark.createDataFrame([(i, None if i % 5 == 0 else f"k{i % 3}") for i in range(30)], SRC)), "out": Change(rows=spark.createDataFrame([(None, 1), ("old", 2)], OUT)), "promotions": Change(rows=spark.createDataFrame([], G.RECEIPTS))})
    return s


def test_promotes_null_safe(spark, store):
    G.promote(spark, store, P)
    got = {r["k"]: r["n"] for r in store.as_of("out").collect()}
    assert got == {None: 4, "old": 2, "k0": 5, "k1": 6, "k2": 5}
    assert store.as_of("promotions").count() == 1


def test_rejects_and_publishes_nothing(spark, store):
    bad = dataclasses.replace(P, invariants=(("none", "SELECT count(*) = 0 FROM candidate"),))
    with pytest.raises(G.Rejected) as e:
        G.promote(spark, store, bad)
    assert ("reconciliation/none", False) in e.value.gates and store.current() == 1


@pytest.mark.parametrize("sql", ["SELECT CAST(NULL AS BOOLEAN) FROM candidate LIMIT 1", "SELECT true FROM candidate", "SELECT 1 FROM candidate LIMIT 1"])
def test_an_unclear_invariant_is_an_error(spark, store, sql):
    with pytest.raises(ValueError, match="boolean"):
        G.promote(spark, store, dataclasses.replace(P, invariants=(("x", sql),)))


def test_nondeterminism_is_refused(spark, store):
    with pytest.raises(G.Rejected):
        G.promote(spark, store, dataclasses.replace(P, transformation="SELECT k, cast(rand() * 9 as bigint) AS n FROM source"))


@pytest.mark.parametrize("change", [{"start": 20}, {"snapshot": 0}, {"replace_keys": ()}, {"transformation": "DROP TABLE source"}, {"transformation": "SELECT 1 FROM source; SELECT 2"}, {"target": "d.s.out"}])
def test_bad_proposals(change):
    with pytest.raises(ValueError):
        dataclasses.replace(P, **change).validate()


def test_replay_range_is_inside():
    for end in (1, 5, 20, 1000):
        lo, hi = dataclasses.replace(P, end=end).replay_range()
        assert 0 <= lo < hi <= end and hi - lo == max(1, end // 10)


REGION = "/root/testdata/sf0.001/region.parquet"


@pytest.mark.parametrize("more", [
    f"UNION ALL SELECT r_name, count(*) FROM parquet.`{REGION}` GROUP BY r_name",
    f"HAVING count(*) > (SELECT min(r_regionkey) FROM parquet.`{REGION}`)",
    f"HAVING k IN (SELECT r_name FROM parquet.`{REGION}` AS source)",
    "UNION ALL SELECT name, 1 FROM other_table",
])
def test_other_data_is_refused(spark, store, more):
    spark.createDataFrame([("x",)], "name string").createOrReplaceTempView("other_table")
    with pytest.raises(G.Rejected) as e:
        G.promote(spark, store, dataclasses.replace(P, transformation=f"{P.transformation} {more}"))
    assert e.value.gates == [("confinement", False)] and store.current() == 1


def test_invariants_are_confined(spark, store):
    bad = f"SELECT count(*) > 0 FROM candidate CROSS JOIN parquet.`{REGION}`"
    with pytest.raises(ValueError, match="reads more"):
        G.promote(spark, store, dataclasses.replace(P, invariants=(("x", bad),)))


def test_constants_and_clauses_are_allowed(spark, store):
    sql = """WITH t AS (SELECT k, ledger FROM source WHERE ledger > :start_ledger AND ledger <= :end_ledger), names AS (SELECT * FROM VALUES ('k0'), ('k1') AS v(n))
    SELECT k, count(*) AS n FROM t WHERE k IN (SELECT n FROM names) AND ledger <= (SELECT max(ledger) FROM source) GROUP BY k"""
    both = ("both", "SELECT (SELECT sum(n) FROM candidate) <= count(*) FROM source")
    G.promote(spark, store, dataclasses.replace(P, transformation=sql, invariants=(both,)))
    assert {r["k"]: r["n"] for r in store.as_of("out").collect()} == {None: 1, "old": 2, "k0": 5, "k1": 6}
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(("_source", "_candidate"))]


@pytest.mark.parametrize("sql", ["localtimestamp()", "current_user()", "current_timezone()", "now()", "current_date()", "current_database()", "unix_timestamp()", "(SELECT max(current_user()) FROM source)"])
def test_what_belongs_to_the_run_is_refused(spark, store, sql):
    gates = G.run_gates(spark, store, dataclasses.replace(P, transformation=f"SELECT k, CAST({sql} AS STRING) AS n FROM source"))[1]
    assert gates == [("confinement", False)]


def test_a_text_that_names_a_function_is_none(spark, store):
    gates = G.run_gates(spark, store, dataclasses.replace(P, transformation="SELECT k, count(*) AS n FROM source WHERE 'now(' <> 'rand(' GROUP BY k"))[1]
    assert all(ok for _, ok in gates)


def _reports(spark, folder):
    return sorted(map(tuple, spark.read.schema(G.REPORT).json(f"{folder}/*").select("status", "promoted_rows", "error").collect()), key=str)


def test_new_target_reports_and_staging(spark, store):
    """A missing target is made once; reports say promoted, rejected and error; only a rejected candidate stays."""
    folder, before = work_path(spark, "reports"), set(_staging(spark))
    new = dataclasses.replace(P, target="c.s.fresh", replace_keys=("n",), transformation="SELECT count(*) AS n, k FROM source WHERE ledger > :start_ledger AND ledger <= :end_ledger GROUP BY k")
    G.promote_reported(spark, store, new, folder)
    assert set(_staging(spark)) == before
    other = Store(spark, store.root, {"src": (SRC, "ledger"), "promotions": (G.RECEIPTS, "source_snapshot_id")})
    G.promote_reported(spark, other, new, folder)
    want = sorted([(4, None), (5, "k0"), (6, "k1"), (5, "k2")], key=str)
    assert sorted(map(tuple, other.as_of("fresh").collect()), key=str) == want and other.as_of("promotions").count() == 2
    report = G.promote_reported(spark, store, dataclasses.replace(new, invariants=(("none", "SELECT count(*) = 0 FROM candidate"),)), folder)
    assert report["status"] == "rejected" and ["reconciliation/none", False] in report["gates"] and len(set(_staging(spark)) - before) == 1
    with pytest.raises(ValueError, match="does not exist yet"):
        G.promote_reported(spark, store, dataclasses.replace(new, snapshot=99), folder)
    with pytest.raises(ValueError, match="whole number"):
        G.promote_reported(spark, store, dataclasses.replace(new, target="c.s.none", replace_keys=("k",)), folder)
    assert "none" not in store.tables
    got = _reports(spark, folder)
    assert [g[:2] for g in got] == [("error", None), ("error", None), ("promoted", 4), ("promoted", 4), ("rejected", None)] and got[0][2] and got[4][2] is None


def _staging(spark):
    import os

    root = work_path(spark, "x").removeprefix("file://").rsplit("/", 1)[0]
    return [n for n in os.listdir(root) if n.startswith("proposal-")]
