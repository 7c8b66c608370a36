"""Incremental replicas: changed sequence numbers from the change feed, rebuilt in the target, checkpointed after."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.columns import redact
from ledgerloom.operators.rollups import latest_row
from ledgerloom.plans.versioned import Change, SnapshotExpired, Store

#: One row per replica and table; fixed names, as a checkpoint is read by other tools too.
CHECKPOINTS = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("replica_name", "source_catalog", "source_table")]
    + [T.StructField("last_snapshot_id", T.LongType()), T.StructField("status", T.StringType()), T.StructField("error_message", T.StringType()), T.StructField("updated_at", T.TimestampType())]
)
_KEYS = ("replica_name", "source_catalog", "source_table")


def column_drift(source: list[str], target: list[str]) -> str:
    """What differs, in words; empty if the same names occur."""
    missing, extra = sorted(set(source) - set(target)), sorted(set(target) - set(source))
    return "; ".join([f"missing {', '.join(missing)}"] * bool(missing) + [f"unexpected {', '.join(extra)}"] * bool(extra))


def changed_ledgers(changes: DataFrame, seq: str) -> DataFrame:
    """Distinct sequence numbers of a change feed; a change without one is an error."""
    checked = F.when(F.col(seq).isNull(), F.raise_error(F.lit(f"a change has no {seq}")).cast("bigint")).otherwise(F.col(seq))
    return changes.select(checked.alias(seq)).distinct()


def latest_checkpoint(checkpoints: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The newest row per key by updated_at, the larger snapshot where two are of one time."""
    return latest_row(checkpoints.withColumn("_at", F.struct("updated_at", "last_snapshot_id")), list(keys or _KEYS), "_at").drop("_at")


def ensure_target(source: Store, target: Store, name: str) -> None:
    """A table the target lacks is declared there like the source's; one with other columns is an error."""
    target.tables.setdefault(name, source.tables[name])
    target.tables.setdefault("sync_checkpoints", (CHECKPOINTS, "last_snapshot_id"))
    if drift := column_drift(source.tables[name][0].fieldNames(), target.tables[name][0].fieldNames()):
        raise ValueError(f"{name}: {drift}")


def save_checkpoint(target: Store, key: tuple[str, str, str], snapshot: int | None, status: str, error: str | None = None) -> Change:
    """The change that puts one row for (replica, catalog, table) in place of what is there."""
    row = target.spark.createDataFrame([(*key, snapshot, status, error)], T.StructType(CHECKPOINTS.fields[:-1]))
    return Change(rows=row.withColumn("updated_at", F.current_timestamp()), clear_rows=target.spark.createDataFrame([key], T.StructType(CHECKPOINTS.fields[:3])))


def sync_table(source: Store, target: Store, name: str, replica: str, catalog: str, upto: int | None = None) -> str:
    """Bring one table of the target up to a snapshot of the source (None: the current one) -> "unchanged",
    "incremental" or "full".

    The new checkpoint is committed with the data. A feed that has expired means a full rebuild, which also clears
    target rows outside the source's bounds. A checkpoint ahead of the source is an error.
    """
    ensure_target(source, target, name)
    seq, key = source.tables[name][1], (replica, catalog, name)
    now = source.current() if upto is None else upto
    marks = target.as_of("sync_checkpoints").where((F.col("replica_name") == replica) & (F.col("source_catalog") == catalog) & (F.col("source_table") == name))
    found = latest_checkpoint(marks).first()
    last = (found["last_snapshot_id"] if found else None) or 0
    if last > now:
        raise ValueError(f"{name}: the checkpoint {last} is ahead of the source's {now}")
    if last == now and found["status"] == "ok":
        return "unchanged"
    try:
        keys = changed_ledgers(source.table_changes(name, last + 1, now), seq) if last < now else None
        change, how = (Change(rows=source.as_of(name, now).join(keys, seq, "left_semi"), clear_keys=keys) if keys is not None else Change()), "incremental"
    except SnapshotExpired:
        change, how = Change(rows=source.as_of(name, now), clear=[(None, None)]), "full"
    target.commit({name: change, "sync_checkpoints": save_checkpoint(target, key, now, "ok")}, batch_id=f"{replica}:{catalog}:{name}:{last}:{now}:{target.current()}")
    return how


def sync(source: Store, target: Store, names: list[str], replica: str, catalog: str, secrets: tuple[str, ...] = ()) -> dict[str, str]:
    """Every table to the one snapshot that is current at the beginning, each on its own.

    A table that fails keeps its data and its last snapshot, and its checkpoint tells the error, secrets masked; all
    errors are raised together at the end.
    """
    now = source.current()
    done, errors = {}, {}
    for n in names:
        try:
            done[n] = sync_table(source, target, n, replica, catalog, now)
        except Exception as e:  # noqa: BLE001
            errors[n] = target.spark.range(1).select(redact(F.lit(str(e)), list(secrets)).alias("m")).first()["m"]
            target.tables.setdefault("sync_checkpoints", (CHECKPOINTS, "last_snapshot_id"))
            known = latest_checkpoint(target.as_of("sync_checkpoints").where((F.col("replica_name") == replica) & (F.col("source_catalog") == catalog) & (F.col("source_table") == n))).first()
            target.commit({"sync_checkpoints": save_checkpoint(target, (replica, catalog, n), known["last_snapshot_id"] if known else None, "error", errors[n])})
    if errors:
        raise RuntimeError("; ".join(f"{n}: {m}" for n, m in sorted(errors.items())))
    return done
