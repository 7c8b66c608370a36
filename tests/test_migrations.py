import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.plans import migrations as M
from ledgerloom.plans.versioned import Change, Store
from ledgerloom.session import work_path

OLD = T.StructType([T.StructField("seq", T.LongType()), T.StructField("v", T.StringType())])
NEW = T.StructType([*OLD.fields, T.StructField("size", T.IntegerType())])
RECORDS = {"schema_migrations": (M.MIGRATIONS, "version")}


@pytest.fixture()
def store(spark):
    path = work_path(spark, "migrations")
    Store(spark, path, {"t": (OLD, "seq")}).commit({"t": Change(rows=spark.createDataFrame([(1, "abc"), (2, None)], OLD))})
    return Store(spark, path, {"t": (NEW, "seq")} | RECORDS)


def rows(store):
    return sorted(map(tuple, store.as_of("t").collect()))


def test_in_order_and_once_each(spark, store):
    assert rows(store) == [(1, "abc", None), (2, None, None)]  # a new column of old rows
    fill, add = M.Migration(2, "fill", M.filled("t", size=F.length("v"))), M.Migration(1, "add", lambda s: {"t": Change(rows=spark.createDataFrame([(3, "z", None)], NEW))})
    assert M.apply_migrations(store, [fill, add]) == [1, 2] and M.apply_migrations(store, [fill, add]) == []
    assert rows(store) == [(1, "abc", 3), (2, None, None), (3, "z", 1)]
    assert M.applied(store) == {1: "add", 2: "fill"} and store.current() == 3
    assert sorted(map(tuple, store.as_of("t", 1).collect())) == [(1, "abc", None), (2, None, None)]


def test_a_failure_leaves_nothing_and_stops(spark, store):
    bad = M.Migration(2, "bad", M.filled("t", size=F.raise_error(F.lit("no")).cast("int")))
    steps = [M.Migration(1, "add", M.filled("t", size=F.lit(7))), bad, M.Migration(3, "later", M.filled("t", v=F.lit("x")))]
    with pytest.raises(RuntimeError, match="migration 2 bad"):
        M.apply_migrations(store, steps)
    assert M.applied(store) == {1: "add"} and rows(store) == [(1, "abc", 7), (2, None, 7)]
    steps[1] = M.Migration(2, "bad", M.filled("t", size=F.lit(8)))
    assert M.apply_migrations(store, steps) == [2, 3] and rows(store) == [(1, "x", 8), (2, "x", 8)]


def test_what_is_refused(spark, store):
    nothing = lambda s: {}
    for bad in ([M.Migration(1, "a", nothing), M.Migration(1, "b", nothing)], [M.Migration(0, "a", nothing)], [M.Migration(1, "a", lambda s: {"schema_migrations": Change()})]):
        with pytest.raises(ValueError):
            M.apply_migrations(store, bad)
    assert M.apply_migrations(store, [M.Migration(5, "a", nothing)]) == [5]
    with pytest.raises(ValueError, match="recorded as"):
        M.apply_migrations(store, [M.Migration(5, "b", nothing)])
    with pytest.raises(ValueError, match="comes after"):
        M.apply_migrations(store, [M.Migration(4, "c", nothing), M.Migration(5, "a", nothing)])
    store.commit({"schema_migrations": Change(rows=store.as_of("schema_migrations"))})
    with pytest.raises(ValueError, match="more than once"):
        M.apply_migrations(store, [])
