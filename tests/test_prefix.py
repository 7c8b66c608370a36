import random

from ledgerloom.operators import prefix


def test_carried_against_running_sums(spark, monkeypatch):
    monkeypatch.setattr(prefix, "FANOUT", 4)
    rng = random.Random(3)
    rows = [(k, at, rng.randrange(9), rng.choice([None, rng.randrange(50)])) for k in ("a", None) for at in rng.sample(range(-300, 300), 80)]
    df = spark.createDataFrame(rows, "k string, at long, n long, top long")
    out = prefix.carried(df, "at", ["k"], sums=("n",), maxes=("top",))
    assert "SinglePartition" not in out._jdf.queryExecution().toString()
    for r in out.collect():
        before = [x for x in rows if x[0] == r["k"] and x[1] < r["at"]]
        assert r["n_before"] == sum(x[2] for x in before)
        assert r["top_before"] == max((x[3] for x in before if x[3] is not None), default=None)
    whole = prefix.carried(df.where("k is null").drop("k"), "at", sums=("n",))
    assert "SinglePartition" not in whole._jdf.queryExecution().toString()
    mine = sorted((x[1], x[2]) for x in rows if x[0] is None)
    assert sorted((r["at"], r["n_before"]) for r in whole.collect()) == [(at, sum(n for _, n in mine[:i])) for i, (at, _) in enumerate(mine)]
    assert prefix.carried(df.limit(0), "at", ["k"], sums=("n",)).count() == 0
