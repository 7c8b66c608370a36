from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
import pytest

from ledgerloom.operators import batching, ranges

few = settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@few
@given(st.sets(st.integers(0, 400), max_size=60))
def test_gaps_model(spark, present):
    df = spark.createDataFrame([(x,) for x in present], "seq long")
    want = sorted(set(range(min(present), max(present) + 1)) - present) if present else []
    assert sorted(r[0] for r in ranges.gap_ledgers(df, "seq", width=16).collect()) == want
    assert sum(r["gap_end"] - r["gap_start"] + 1 for r in ranges.gap_ranges(df, "seq", width=7).collect()) == len(want)


def greedy(items, most):
    out = []
    for s, b, r in items:
        if out and out[-1][2] + 1 <= most[0] and out[-1][3] + b <= most[1] and out[-1][4] + r <= most[2]:
            x = out[-1]
            out[-1] = [x[0], s, x[2] + 1, x[3] + b, x[4] + r]
        else:
            out.append([s, s, 1, b, r])
    return out


@few
@given(st.lists(st.tuples(st.integers(1, 9), st.integers(1, 9)), min_size=1, max_size=30))
def test_packing_model(spark, sizes):
    items = [(i, b, r) for i, (b, r) in enumerate(sizes)]
    df = spark.createDataFrame([("a", *x) for x in items], "shard string, seq long, b long, r long")
    got = batching.pack_microbatches(df, "shard", "seq", "b", "r", 4, 20, 15, block=5).orderBy("batch").collect()
    assert [[r["ledger_start"], r["ledger_end"], r["ledgers"], r["bytes"], r["rows"]] for r in got] == greedy(items, (4, 20, 15))


def test_packing_refuses(spark):
    for rows in ([("a", 0, 99, 1)], [("a", 0, 1, 1), ("a", 2, 1, 1)], [("a", 0, 1, 1), ("a", 2, 1, 1), ("a", 2, 1, 1)], [("a", 0, None, 1)]):
        with pytest.raises(Exception, match="exceeds|contiguous"):
            batching.pack_microbatches(spark.createDataFrame(rows, "shard string, seq long, b long, r long"), "shard", "seq", "b", "r", 4, 20, 15).collect()


@few
@given(st.integers(-50, 50), st.integers(0, 90), st.integers(1, 9))
def test_splits_cover(spark, low, n, k):
    df = spark.createDataFrame([(low, low + n)], "lo long, hi long")
    shards = ranges.shard_split(df, "lo", "hi", k).orderBy("shard").collect()
    assert [x for r in shards for x in range(r["shard_start"], r["shard_end"] + 1)] == list(range(low, low + n + 1))
    sizes = [r["shard_end"] - r["shard_start"] + 1 for r in shards]
    assert max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes, reverse=True)
    chunks = ranges.split_half_open(df, "lo", "hi", k).collect()
    assert sum(r["chunk_end"] - r["chunk_start"] for r in chunks) == n and len(chunks) == max(1, -(-n // k))


def test_coverage(spark):
    df = spark.createDataFrame([(0, 9), (10, 19), (21, 30), (30, 40)], "s long, e long")
    for width in (1, 7, 1000):
        found = ranges.coverage_violations(df, "s", "e", 0, 40, width)
        assert {(r["s"], r["problem"]) for r in found.collect()} == {(21, "leaves a gap"), (30, "overlaps")}
        assert "SinglePartition" not in found._jdf.queryExecution().toString()
    ends = spark.createDataFrame([(5, 9), (10, 12), (3, None)], "s long, e long")
    assert {(r["s"], r["problem"]) for r in ranges.coverage_violations(ends, "s", "e", 0, 41, 4).collect()} == {(5, "does not start the range"), (10, "does not end the range"), (3, "has no bounds")}


def test_no_window_over_the_whole_table(spark):
    df = spark.createDataFrame([(x, "n") for x in [1, 2, 5, 90, 91, 400]], "seq long, network string")
    for out in (ranges.gap_ranges(df, "seq", width=8), ranges.contiguity_violations(df, "seq", width=8)):
        assert "SinglePartition" not in out._jdf.queryExecution().toString()
    assert [r["seq"] for r in ranges.take_after(df, "seq", 2, 3, width=8).orderBy("seq").collect()] == [5, 90, 91]
    with pytest.raises(ValueError, match="fewer"):
        ranges.take_after(df, "seq", 2, 5, width=8)


def test_batches_are_one_run_of_one_network(spark):
    rows = [(1, "a"), (2, "a"), (2, "a"), (4, "b"), (5, None), (None, "a")]
    got = {tuple(r) for r in ranges.batch_violations(spark.createDataFrame(rows, "seq long, network string"), "seq", "network", width=2).collect()}
    assert got == {(2, "repeated"), (4, "does not follow"), (4, "another network"), (5, "another network"), (None, "no ledger")}


def test_a_million_ledgers_in_one_shard(spark):
    sizes = spark.range(1_000_000).selectExpr("'x' as shard", "id + 7 as seq", "(id * 7919) % 1000 + 1 as b", "id % 5 as r")
    got = batching.pack_microbatches(sizes, "shard", "seq", "b", "r", 100, 20_000, 1000).orderBy("batch").collect()
    items = [(i + 7, (i * 7919) % 1000 + 1, i % 5) for i in range(1_000_000)]
    assert [[r["ledger_start"], r["ledger_end"], r["ledgers"], r["bytes"], r["rows"]] for r in got] == greedy(items, (100, 20_000, 1000))
    assert [r["batch"] for r in got] == list(range(len(got)))


def test_nulls_and_empty(spark):
    empty = spark.createDataFrame([], "seq long")
    assert ranges.gap_ranges(empty, "seq").count() == 0
    assert ranges.gap_ledgers(spark.createDataFrame([(None,), (3,)], "seq long"), "seq").count() == 0
