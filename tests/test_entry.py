import os

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
FAST = ["asset_daily_volume", "gap_ranges", "continuity_report", "microbatch_pack", "as_of_version", "shard_split", "row_ordinals", "upsert_latest", "symmetric_diff", "migrated_transfers", "backfill_after_lost_answers", "promoted_into_a_new_table"]


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", FAST)
def test_against_sql(spark, name):
    import __spark_entry__ as e

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = e.queries()[name](spark, SF)
    rel = c.sql(e.oracle_sql()[name])
    names = sorted(df.columns)
    assert names == sorted(rel.columns)
    want = sorted(repr(tuple(r[rel.columns.index(n)] for n in names)) for r in rel.fetchall())
    assert sorted(repr(tuple(r[n] for n in names)) for r in df.collect()) == want


WHOLE = ["index_materialized_whole", "asset_daily_volume_affected_last", "gatekeeper_promote_last", "corpus_scan_half", "file_overlap_half"]


def test_whole_range_queries_follow_the_table(spark, tmp_path):
    """4,000 events from ledger 500 on (half of them in one), and 3,000 orders from key 5,000 on."""
    import __spark_entry__ as e

    c = duckdb.connect()
    c.execute(f"""copy (select cast(case when i % 2 = 0 then 5003 else 5000 + i end as bigint) as event_id, timestamp '2024-01-01' + interval (i * 20) minute as ts,
        'k' || i % 5 as event_type, cast(i % 17 as bigint) as user_id, cast(i % 90 as double) as value, '{{}}' as props from range(4000) r(i)) to '{tmp_path}/events.parquet' (format parquet)""")
    c.execute(f"copy (select 5000 + i as o_orderkey, 'F' as o_orderstatus, 'p' || i % 3 as o_orderpriority from range(3000) r(i)) to '{tmp_path}/orders.parquet' (format parquet)")
    for t in ("events", "orders"):
        c.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet'")
    for name in WHOLE:
        df = e.queries()[name](spark, str(tmp_path))
        want = c.sql(f"select {', '.join(sorted(df.columns))} from ({e.oracle_sql()[name]})").fetchall()
        assert sorted(map(tuple, df.select(*sorted(df.columns)).collect())) == sorted(want), name
        assert len(want) >= 15, name
    assert max(r[0] for r in c.sql(f"select ledger_sequence from ({e.oracle_sql()['index_materialized_whole']})").fetchall()) == 900
