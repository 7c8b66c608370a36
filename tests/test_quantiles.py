import math
import random

import pytest

from ledgerloom.operators import quantiles, rollups

RANKS = {"low": 0.0, "median": 0.5, "p99": 0.99, "top": 1.0}


def nearest(values, q):
    values = sorted(v for v in values if v is not None)
    return values[max(math.ceil(q * len(values)), 1) - 1] if values else None


@pytest.mark.parametrize("most", [7, 10_000])
def test_selection_against_sorting(spark, most, monkeypatch):
    monkeypatch.setattr(quantiles, "BINS", 64)
    rng = random.Random(2)
    hot = [rng.choice([0.0, -1.5, 3.25, 1e300, -1e300, float("inf"), float("-inf"), rng.random(), rng.gauss(0, 1e-9)]) for _ in range(400)]
    rows = [("hot", v) for v in hot] + [(None, 2.0), (None, None), ("none", None)] + [("few", float(x)) for x in (5, 1, 1)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: tuple(r[n] for n in RANKS) for r in quantiles.exact_quantiles(df, "v", RANKS, ["k"], most).collect()}
    assert got == {k: tuple(nearest([v for x, v in rows if x == k], q) for q in RANKS.values()) for k in ("hot", None, "none", "few")}
    whole = quantiles.exact_quantiles(df.drop("k"), "v", RANKS, most=most).collect()
    assert [tuple(r) for r in whole] == [tuple(nearest([v for _, v in rows], q) for q in RANKS.values())]
    big = spark.createDataFrame([(10**17 + i // 3,) for i in range(200)], "v long")
    assert quantiles.exact_quantiles(big, "v", RANKS, most=most).first()["median"] == 10**17 + 33
    nothing = quantiles.exact_quantiles(df.limit(0), "v", RANKS, ["k"], most)
    assert nothing.count() == 0 and nothing.columns == ["k", *RANKS]


def test_one_key_of_ten_million_values(spark):
    df = spark.range(10_000_000).selectExpr("'hot' as k", "pmod(id * 7919, 10000000) as v")
    r = rollups.latency_summary(df, "v", ["k"]).first()
    assert (r["n"], r["min"], r["median"], r["p95"], r["p99"], r["max"]) == (10_000_000, 0, 4_999_999, 9_499_999, 9_899_999, 9_999_999)


def test_histograms_merge_and_interpolate(spark):
    rows = [("a", 0.5), ("a", 1.0), ("a", 3.0), ("b", 9.0), ("b", None), ("b", 1.5)]
    df = spark.createDataFrame(rows, "k string, v double")
    h = quantiles.histogram(df, "v", [1, 2, 4], ["k"])
    assert {(r["k"], r["le"], r["n"]) for r in h.collect()} == {("a", 1.0, 2), ("a", 2.0, 2), ("a", 4.0, 3), ("a", math.inf, 3), ("b", 1.0, 0), ("b", 2.0, 1), ("b", 4.0, 1), ("b", math.inf, 2)}
    from pyspark.sql import functions as F

    whole = quantiles.merged(h.withColumn("one", F.lit(1)), ["one"])
    for q, want in ((0.2, 0.5), (0.5, 1.5), (0.8, 4.0), (0.99, 4.0)):
        r = quantiles.histogram_quantile(whole, q, ["one"]).first()
        assert (r["n"], pytest.approx(r["quantile"])) == (5, want)
    with pytest.raises(ValueError, match="rise"):
        quantiles.histogram(df, "v", [2, 1], ["k"])
