"""Migrations of a store: numbered changes in order, each applied once and recorded in the snapshot that it makes."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.plans.versioned import Change, Store

MIGRATIONS = T.StructType([T.StructField("version", T.LongType()), T.StructField("name", T.StringType()), T.StructField("applied_at", T.TimestampType())])


@dataclass(frozen=True)
class Migration:
    """A number, a name, and what it does: the changes to tables, made when its turn comes."""

    version: int
    name: str
    change: Callable[[Store], dict[str, Change]]


def filled(name: str, **columns: Column) -> Callable[[Store], dict[str, Change]]:
    """A change that gives a table's rows new values for columns, such as those that its declared schema has gained.

    Rows written before a column was declared read as null there. The rows are rewritten as one DataFrame job.
    """

    def change(store: Store) -> dict[str, Change]:
        rows = store.as_of(name).withColumns(columns)
        return {name: Change(rows=rows, clear=[(None, None)])}

    return change


def applied(store: Store, table: str = "schema_migrations") -> dict[int, str]:
    """Recorded migrations; one that is recorded twice is an error. There are as many as changes of schema."""
    if not store.current():
        return {}
    seen = store.as_of(table).groupBy("version").agg(F.count("*").alias("n"), F.min("name").alias("name")).collect()
    if twice := sorted(r["version"] for r in seen if r["n"] > 1):
        raise ValueError(f"migrations {twice} are recorded more than once")
    return {r["version"]: r["name"] for r in seen}


def apply_migrations(store: Store, migrations: list[Migration], table: str = "schema_migrations") -> list[int]:
    """Apply what is not recorded yet, by version -> the versions applied now.

    A migration's changes and its record are one snapshot, so one that fails leaves nothing and is tried again next time,
    and those after it wait. Versions must be distinct and positive, a recorded one must keep its name, and a new one
    must be above all recorded ones, so that every store has gone through the same order.
    """
    versions = [m.version for m in migrations]
    if len(set(versions)) != len(versions) or any(v <= 0 for v in versions):
        raise ValueError("migrations have distinct, positive versions")
    done, now = applied(store, table), []
    for m in sorted(migrations, key=lambda m: m.version):
        if m.version in done:
            if done[m.version] != m.name:
                raise ValueError(f"migration {m.version} is recorded as {done[m.version]!r}, not {m.name!r}")
            continue
        if done and m.version < max(done):
            raise ValueError(f"migration {m.version} comes after {max(done)} was applied")
        row: DataFrame = store.spark.range(1).select(F.lit(m.version).cast("bigint").alias("version"), F.lit(m.name).alias("name"), F.current_timestamp().alias("applied_at"))
        changes = m.change(store)
        if table in changes:
            raise ValueError(f"migration {m.version} writes {table} itself")
        try:
            store.commit(changes | {table: Change(rows=row, few=True)}, batch_id=f"migration {m.version}", digest=hashlib.sha256(m.name.encode()).hexdigest())
        except Exception as e:
            raise RuntimeError(f"migration {m.version} {m.name} failed") from e
        done[m.version] = m.name
        now.append(m.version)
    return now
