import hashlib

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import acceptance, digests, parity
from ledgerloom.session import work_path
from ledgerloom.sources import corpus, footers, lookup

COLUMNS = "place long, table string, uri string, sha256 string, schema_sha256 string, bytes long, rows long, min_ledger long, max_ledger long"
SHA = "sha256:" + "ab" * 32


def test_tree_digest_is_of_the_multiset(spark):
    rows = [(i % 700, None if i % 5 == 0 else f"v{i % 9}") for i in range(3000)]
    df = spark.createDataFrame(rows, "seq long, v string")
    one = digests.tree_digest(df, depth=2).collect()
    assert one == digests.tree_digest(df.repartition(7, "v").orderBy(F.desc("seq")), depth=2).collect()
    assert one != digests.tree_digest(df.unionAll(df.limit(1)), depth=2).collect()
    assert one != digests.tree_digest(df.withColumn("v", F.coalesce("v", F.lit(""))), depth=2).collect()
    assert digests.range_digest(df, "seq", 10, 20).first()["rows"] == sum(10 < r[0] <= 20 for r in rows)
    assert digests.tree_digest(df.limit(0)).first()["digest"] == "sha256:" + hashlib.sha256(b"").hexdigest()
    pair = spark.createDataFrame([("a", "b:c")], "x string, y string"), spark.createDataFrame([("a,1:b", "c")], "x string, y string")
    assert digests.tree_digest(pair[0]).first()["digest"] != digests.tree_digest(pair[1]).first()["digest"]


def entries(n=6):
    return [[i, "lake.t" if i < 4 else "lake.u", f"s3://b/{i}", SHA, SHA, 10, 2, 1 + 10 * (i % 4), 10 + 10 * (i % 4)] for i in range(n)]


def judged(spark, rows, result=None, counts=None):
    files = spark.createDataFrame([tuple(r) for r in rows], COLUMNS)
    shard = {"format_version": 1, "job_id": "j", "shard_id": "s", "ledger_start": 1, "ledger_end": 40, "max_attempts": 2}
    facts = shard | {"generation_digest": acceptance.generation_digest(files), "ledger_count": 40, "source_digest": SHA, "schema_fingerprint": SHA, "worker_id": "w", "attempt": 1, "started_at": "2024-01-01T00:00:00Z", "completed_at": "2024-01-01T00:00:00Z"}
    counts = spark.createDataFrame(counts or [("lake.t", 8), ("lake.u", 4)], "table string, rows long")
    return {tuple(r) for r in acceptance.result_violations(facts | (result or {}), shard, files, counts).collect()}


def test_a_right_result_is_accepted(spark):
    assert judged(spark, entries()) == set()


@pytest.mark.parametrize(
    ("column", "value", "problem"),
    [(1, "T", "table name"), (2, "b/1", "uri"), (2, "s3://u@b/1", "uri"), (2, "s3://b/a/../1", "uri"), (2, "s3://b/1?x", "uri"), (2, "s3:///1", "uri"), (3, "sha256:AB", "file digest"), (4, None, "schema digest"), (5, 0, "no bytes"), (6, 0, "no rows"), (7, 0, "ledger range"), (8, None, "ledger range"), (8, 41, "outside the shard")],
)
def test_rules_of_a_file(spark, column, value, problem):
    rows = entries(4)
    rows[1][column] = value
    found = spark.createDataFrame([tuple(r) for r in rows], COLUMNS).withColumn("problem", acceptance.file_rules(1, 40)).where("problem is not null").collect()
    assert [(r["place"], r["problem"]) for r in found] == [(1, problem)]


def test_facts_order_and_counts(spark):
    wrong = {"format_version": 2, "shard_id": "x", "generation_digest": SHA, "ledger_end": 39, "ledger_count": 39, "source_digest": "x", "schema_fingerprint": None, "worker_id": " ", "attempt": 3, "completed_at": "2023-01-01T00:00:00Z"}
    names = ["format version", "identity", "generation digest", "range", "ledger count", "source digest", "schema fingerprint", "worker", "attempt", "times"]
    assert judged(spark, entries(), wrong) == {("result", n) for n in names}
    rows = entries()
    rows[2][0], rows[1][0] = 1, 2
    assert judged(spark, rows) == {("s3://b/1", "order")}
    same = entries()
    same[5][2] = "s3://b/4"
    assert judged(spark, same) == {("s3://b/4", "repeated uri")}
    assert judged(spark, entries(), counts=[("lake.t", 9), ("nowhere", 4)]) == {("lake.t", "row count"), ("lake.u", "row count"), ("nowhere", "row count"), ("nowhere", "counted table name")}
    many = spark.createDataFrame([(i, "lake.t", f"s3://b/{i:05}", SHA, SHA, 1, 1, i + 1 - 7 * (i == 500), i + 1) for i in range(1000)], COLUMNS)
    found = acceptance.out_of_order(many, "place", width=64)
    assert [r["place"] for r in found.collect()] == [500]
    assert "SinglePartition" not in found._jdf.queryExecution().toString()


def test_footers_find_tampered_files(spark, tmp_path):
    df = spark.range(100).select(F.when(F.col("id") != 7, F.col("id") - 1).alias("seq"), F.col("id").cast("string").alias("v"))
    df.repartitionByRange(4, "seq").write.parquet(f"file://{tmp_path}/t")
    found = footers.footers(footers.listed(spark, f"file://{tmp_path}/t"), "seq")
    rows = {r["uri"]: r for r in found.collect()}
    assert sum(r["rows"] for r in rows.values()) == 100 and sum(r["null_ledgers"] for r in rows.values()) == 1
    declared = spark.createDataFrame([(u, r["rows"], r["min_ledger"], r["max_ledger"]) for u, r in rows.items()], "uri string, rows long, min_ledger long, max_ledger long")
    assert {r["problem"] for r in footers.footer_violations(found, declared, "seq int64, v string").collect()} == {"null ledger", "negative ledger"}
    assert {r["problem"] for r in footers.footer_violations(found, declared, "seq int64").collect()} >= {"schema"}
    victim = sorted((tmp_path / "t").glob("*.parquet"))[0]
    victim.write_bytes(b"PAR1 not a file any more")
    (tmp_path / "t" / f".{victim.name}.crc").unlink(missing_ok=True)
    again = footers.footers(footers.listed(spark, f"file://{tmp_path}/t"), "seq")
    assert "not readable" in {r["problem"] for r in footers.footer_violations(again, declared).collect()}
    assert footers.same_schema(found).count() >= 1


def test_a_file_for_each_key_in_one_folder(spark, tmp_path, monkeypatch):
    df = spark.sql("""select id, case when id < 25000 then 7 when id = 25000 then null else -(id % 3) end as k, timestamp_micros(id) as at, cast(id / 7 as decimal(20, 3)) as d,
        array(struct(id as a, cast(null as string) as b)) as nested, case when id % 2 = 0 then 'x' end as s from range(30000)""")
    path = f"file://{tmp_path}/keyed"
    corpus.write_keyed(df, path, "k", ["id"])
    found = {r["uri"].rsplit("/", 1)[1]: r for r in footers.footers(footers.listed(spark, path), "id").collect()}
    assert {n: r["rows"] for n, r in found.items()} == {"k=7.parquet": 25000, "k=__HIVE_DEFAULT_PARTITION__.parquet": 1, "k=0.parquet": 1666, "k=-1.parquet": 1666, "k=-2.parquet": 1667}
    assert (found["k=7.parquet"]["min_ledger"], found["k=7.parquet"]["max_ledger"], found["k=7.parquet"]["null_ledgers"]) == (0, 24999, 0)
    assert sorted(p.name for p in (tmp_path / "keyed").iterdir()) == sorted(found)  # no folders, no parts
    assert parity.equal(spark.read.schema(df.drop("k").schema).parquet(path), df.drop("k"))
    one = spark.read.parquet(f"{path}/k=-1.parquet").select("id").collect()
    assert [r[0] for r in one] == sorted(r[0] for r in one)
    with pytest.raises(FileExistsError):
        corpus.write_keyed(df, path, "k", ["id"])
    with pytest.raises(ValueError, match="whole number"):
        corpus.write_keyed(df, path + "x", "s", ["id"])
    monkeypatch.setattr(corpus, "GROUP_BYTES", 100)
    batches = [pa.RecordBatch.from_pydict({"k": [1] * 20, "v": list(range(20))}), pa.RecordBatch.from_pydict({"k": [1] * 20 + [2], "v": list(range(21))})]
    (done,) = corpus._key_files(str(tmp_path), "k")(iter(batches))
    assert done.to_pydict() == {"name": ["k=1.parquet", "k=2.parquet"], "rows": [40, 1]}
    assert pq.ParquetFile(tmp_path / "k=1.parquet").num_row_groups == 2 and pq.read_table(tmp_path / "k=1.parquet").to_pydict() == {"v": [*range(20), *range(20)]}


def test_digests_of_large_files_are_streamed(spark, tmp_path):
    with open(tmp_path / "big.bin", "wb") as f:
        f.truncate(300 << 20)
    (tmp_path / "small.bin").write_bytes(b"x")
    got = {r["uri"].rsplit("/", 1)[1]: (r["bytes"], r["sha256"]) for r in footers.digests(footers.listed(spark, f"file://{tmp_path}", "*.bin")).collect()}
    h = hashlib.sha256()
    for _ in range(300):
        h.update(bytes(1 << 20))
    assert got == {"big.bin": (300 << 20, "sha256:" + h.hexdigest()), "small.bin": (1, "sha256:" + hashlib.sha256(b"x").hexdigest())}


def test_lookups_open_few_files(spark):
    rows = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("tx_hash"), F.col("id").alias("seq"))
    path = work_path(spark, "test-lookup")
    lookup.write_lookup_index(rows, path, "tx_hash", files=8)
    key = hashlib.sha256(b"77").hexdigest()
    assert len(lookup.files_for(spark, path, [key])) == 1
    got = lookup.lookup(spark, path, "tx_hash", [key, "zz"], "tx_hash string, seq bigint, indexed_at timestamp")
    assert [(r["seq"], r["indexed_at"] is not None) for r in got.collect()] == [(77, True)]
    assert len(got.inputFiles()) == 1 and "In(tx_hash" in got._jdf.queryExecution().toString()
    assert lookup.lookup(spark, path, "tx_hash", [], "tx_hash string, seq bigint").count() == 0
    with pytest.raises(ValueError, match="join"):
        lookup.lookup(spark, path, "tx_hash", ["x"] * 10_001, "tx_hash string")


def test_ordered_text_and_populated_columns(spark):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 10, "x"), ("a", None, "n"), ("b", 1, None), (None, 1, "z")], "k string, o int, v string")
    got = {r["k"]: (r["items"], r["has_flag"]) for r in parity.ordered_text(df, ["k"], "v", "o", "|", "o > 5").collect()}
    assert got == {"a": ("n|y|x", True), "b": (None, False), None: ("z", False)}
    found = parity.populated({"t": df.withColumn("e", F.lit(None).cast("int"))}, {"t": ["k", "e", "absent"]}).collect()
    assert {(r["column"], r["problem"]) for r in found} == {("e", "never populated"), ("absent", "no such column")}
