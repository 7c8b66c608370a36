from pathlib import Path

import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import columns as C
from ledgerloom.operators import mutations, parity, rollups
from ledgerloom.session import work_path
from ledgerloom.sources import corpus, envelope

DECLARED = Path(__file__).resolve().parents[1] / "FIXTURES.md"


def test_declared_tables():
    specs = envelope.declared_tables(DECLARED)
    assert len(specs) == 21 and sum(len(s.schema) for s in specs.values()) == 461
    assert specs["contract_creations_v1"].seq == "created_ledger" and specs["ledgers_row_v2"].seq == "sequence"


def test_every_declared_table_projects(spark):
    one = spark.createDataFrame([("{}",)], "row_json string")
    for spec in envelope.declared_tables(DECLARED).values():
        got = envelope.project_typed(one, spec)
        assert got.columns == spec.schema.fieldNames() and got.count() == 1


def test_jsonl_round_trip_and_malformed(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"networkPassphrase":"n","ledgerSequence":7,"closedAtUnix":"1782900000","bronzeRows":[{"tableName":"t","rowJson":"{}"},{"tableName":"u","rowJson":"{}"}]}\n\n')
    df = envelope.normalized(envelope.read_batches(spark, f"file://{tmp_path}/a.jsonl"))
    assert df.count() == 1 and df.first()["closedAtUnix"] == 1782900000
    assert envelope.batch_counts(df).first()["bronze_row_count"] == 2
    assert envelope.known_tables(envelope.bronze_rows(df), ["t"]).count() == 1
    with pytest.raises(Exception, match="unknown table"):
        envelope.known_tables(envelope.bronze_rows(df), ["t"], "fail").collect()
    (tmp_path / "b.jsonl").write_text("{oops\n")
    with pytest.raises(Exception):
        envelope.read_batches(spark, f"file://{tmp_path}/b.jsonl").collect()


def test_enrichment_last_wins_and_falls_through(spark):
    rows = spark.createDataFrame([(1, "x", "own"), (1, "y", "own")], "q long, h string, tx string")
    lookup = spark.createDataFrame([(1, "x", 0, "first"), (1, "x", 1, "last")], "q long, h string, pos int, tx string")
    assert {r["h"]: r["tx"] for r in mutations.enrich_last(rows, lookup, ["q", "h"], "pos", ["tx"]).collect()} == {"x": "last", "y": "own"}


def test_columns(spark):
    r = spark.range(1).select(
        C.index_bucket(F.lit(62_050_000)).alias("a"), C.index_bucket(F.lit(62_150_000)).alias("b"), C.range_bucket(F.lit(12345)).alias("c"), C.default_text(F.lit("  "), "d").alias("d"),
        C.stable_id("tx", F.lit("a"), F.lit(None).cast("string")).alias("e"), C.redact(F.lit("it's s'x and s''x"), ["s'x"]).alias("f"), C.over_budget(F.lit(5), 0, F.lit(False)).alias("g"),
    ).first()
    assert (r.a, r.b, r.c, r.d, r.e, r.f, r.g) == (620, 622, 10000, "d", None, "it's [REDACTED] and [REDACTED]", False)
    with pytest.raises(ValueError):
        C.stable_id("other", F.lit(1))


def test_corpus(spark):
    path = work_path(spark, "corpus")
    df = spark.range(100).select(F.col("id").alias("q"), F.lit("x").alias("v"))
    manifest = corpus.record_corpus(df, path, "q", 30)
    assert manifest.count() == 4
    assert corpus.scan_corpus(spark, path, "q long, v string", "q", 25, 65).count() == 41
    with pytest.raises(ValueError):
        corpus.scan_corpus(spark, path, "q long, v string", "q", 90, 120)
    files = corpus.file_table(spark, f"{path}/data")
    assert corpus.verify_files(manifest, files).count() == 0
    assert corpus.verify_files(manifest.withColumn("sha256", F.lit("0")), files).count() == 4
    assert corpus.inventory(files).first()["files"] == 4
    with pytest.raises(Exception):
        corpus.record_corpus(df, path, "q", 30)


def test_corpus_files_share_one_folder(spark):
    """No folder and no listing task for each file; the manifest tells what each file holds, nulls too."""
    path = work_path(spark, "flat")
    df = spark.range(1000).select((F.col("id") - 500).alias("q"), F.col("id").cast("string").alias("v")).unionAll(spark.sql("select cast(null as bigint), 'n' union all select 3L, 'again'"))
    spark.sparkContext.setJobGroup("flat", "recorded")
    manifest = corpus.record_corpus(df, path, "q", 10)
    status = spark.sparkContext.statusTracker()
    tasks = [status.getStageInfo(s).numTasks for j in status.getJobIdsForGroup("flat") for s in status.getJobInfo(j).stageIds if status.getStageInfo(s)]
    spark.sparkContext.setJobGroup("", "")
    folder = Path(path.removeprefix("file://")) / "data"
    names = {p.name: hashlib.sha256(p.read_bytes()).hexdigest() for p in folder.iterdir()}
    got = {r["path"]: r for r in manifest.collect()}
    assert len(names) == 101 and all(p.is_file() for p in folder.iterdir()) and {p: r["sha256"] for p, r in got.items()} == names
    assert max(tasks) < 50
    assert [tuple(r)[3:] for r in got.values() if r["ledger_start"] is None] == [(1, None, None, 0)]
    assert [tuple(r)[3:] for r in got.values() if r["ledger_start"] == 0] == [(11, 0, 9, 10)]
    assert sorted(map(tuple, corpus.scan_corpus(spark, path, "q long, v string", "q", -3, 3).collect())) == sorted([(k, str(k + 500)) for k in range(-3, 4)] + [(3, "again")])
    other = work_path(spark, "folders").removeprefix("file://")  # not known to be a shared file system: Spark's writer
    there = corpus.record_corpus(df, other, "q", 10)
    same = ["rows", "ledger_start", "ledger_end", "ledgers"]
    assert parity.equal(there.select(*same), manifest.select(*same)) and (Path(other) / "data").is_dir()
    assert corpus.scan_corpus(spark, other, "q long, v string", "q", -3, 3).count() == 8


def test_shards_never_overwrite(spark):
    path = work_path(spark, "shard")
    corpus.write_shard(spark.range(10), path, "id")
    with pytest.raises(Exception):
        corpus.write_shard(spark.range(10), path, "id")
    with pytest.raises(ValueError):
        corpus.write_shard(spark.range(10), path + "x", "id", codec="lzo")


def test_fingerprint_sees_copies_nulls_and_order_free(spark):
    f = lambda rows: parity.fingerprint(spark.createDataFrame(rows, "a long, b long")).first()["fingerprint"]
    assert f([(1, 2), (3, 4)]) == f([(3, 4), (1, 2)])
    assert len({f([(1, 1)]), f([(1, 1), (1, 1)]), f([(None, 1)]), f([(1, None)])}) == 4


def test_whole_days_of_a_partial_range(spark):
    rows = [(q, "a", 1, 1.5, f"2024-01-0{1 + q // 10} 00:00:00") for q in range(30)]
    df = spark.createDataFrame(rows, "q long, asset string, s long, v double, at string").withColumn("at", F.to_timestamp("at"))
    got = rollups.affected_daily_volume(df, "q", "asset", "s", "v", "at", 14, 16, base=-1).collect()
    assert [(r["transfer_count"], r["first_ledger"], r["last_ledger"]) for r in got] == [(7, 10, 16)]
