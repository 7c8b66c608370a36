"""Loads into a store: typed tables from envelopes, relational and JSON rows, indexes by chunk, and upkeep."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import mutations
from ledgerloom.plans.versioned import Change, Store
from ledgerloom.sources.envelope import TableSpec, bronze_rows, known_tables, project_typed, with_transaction_texts

#: Natural keys of the relational form (fixed values).
RELATIONAL_KEYS = {
    "ledgers": ("network_passphrase", "ledger_sequence"),
    "transactions": ("network_passphrase", "ledger_sequence", "transaction_index"),
    "operations": ("network_passphrase", "ledger_sequence", "transaction_index", "operation_index"),
}


def typed_tables(batches: DataFrame, specs: dict[str, TableSpec], unknown: str = "skip") -> dict[str, DataFrame]:
    """Envelopes -> one typed DataFrame per declared table; transactions take their texts from the envelope."""
    rows = known_tables(bronze_rows(batches), sorted(specs), unknown)
    out = {}
    for name, spec in specs.items():
        typed = project_typed(rows.where(F.col("table_name") == name), spec)
        if {"ledger_sequence", "transaction_hash", "tx_envelope", "tx_result", "tx_meta"} <= set(typed.columns):
            typed = with_transaction_texts(typed, batches).select(*spec.schema.fieldNames())
        out[name] = typed
    return out


def relational_rows(batches: DataFrame, kind: str) -> DataFrame:
    """One of the envelope's lists (ledgers, transactions, operations) as rows with snake_case names, and position."""
    fields = batches.schema[kind].dataType.elementType.fieldNames()
    snake = {f: "".join("_" + ch.lower() if ch.isupper() else ch for ch in f) for f in fields}
    return batches.select(F.posexplode(kind).alias("position", "r")).select(*[F.col(f"r.{f}").alias(n) for f, n in snake.items()], "position")


def upsert_relational(tables: dict[str, DataFrame], batches: DataFrame) -> dict[str, DataFrame]:
    """The relational tables after a batch: all other columns replaced on the natural keys, the last position wins."""
    return {k: mutations.upsert(t, relational_rows(batches, k), list(RELATIONAL_KEYS[k]), "position") for k, t in tables.items()}


def replace_json_rows(table: DataFrame, batches: DataFrame) -> DataFrame:
    """The table of JSON rows after a batch: what it held for the batch's (network, ledger, table) keys is replaced.

    The keys are the names in each envelope's list; no payload is read for them.
    """
    rows = bronze_rows(batches).select(F.col("bronze_row_id").alias("id"), F.col("networkPassphrase").alias("network_passphrase"), F.col("ledgerSequence").alias("ledger_sequence"), "table_name", "row_ordinal", "row_json")
    gone = batches.select(F.col("networkPassphrase").alias("network_passphrase"), F.col("ledgerSequence").alias("ledger_sequence"), F.explode(F.array_distinct("bronzeRows.tableName")).alias("table_name"))
    return mutations.replace_keys(table, rows.select(*table.columns), ["network_passphrase", "ledger_sequence", "table_name"], gone)


def materialize(store: Store, index: str, build: Callable[[int, int], DataFrame], start: int, end: int, chunk: int | None = None) -> int:
    """Rebuild an index over (start, end], as one commit or as one per chunk of ledgers -> commits made.

    build(low, high) gives the index rows of (low, high]. Each commit ends the chunk's old rows and brings the new
    ones, so a rerun after a failure repeats chunks harmlessly; the error names the chunk.
    """
    if index not in store.tables:
        raise ValueError(f"unknown index {index}")
    if start < 0 or start > end or (chunk is not None and chunk <= 0):
        raise ValueError("an index range is (start, end] with 0 <= start <= end and a positive chunk")
    low, done = start, 0
    while low < end:
        high = end if chunk is None else min(end, low + chunk)
        try:
            store.commit({index: Change(rows=build(low, high), clear=[(low + 1, high)])})
        except Exception as e:
            raise RuntimeError(f"{index} failed at ledgers {low + 1} to {high}") from e
        low, done = high, done + 1
    return done


def maintain(store: Store, small_commits: int = 8, retain: int = 0, checkpoints: DataFrame | None = None) -> dict[str, str]:
    """One round of upkeep -> what was done. Tables with so many row folders are compacted into few sorted files, then
    versions more than `retain` snapshots old expire (0: never).

    A step that fails does not keep the others from running; the first error is raised at the end. Expiry is refused
    while a replica's checkpoint (last_snapshot_id) lies below the new floor, because its change feed would be gone.
    """
    done: dict[str, str] = {}
    errors: list[Exception] = []
    for name in sorted(store.tables):
        try:
            if len(store._parts(name, store.current(), alive=True)[0]) >= small_commits:
                store.compact(name)
                done[name] = "compacted"
        except Exception as e:  # noqa: BLE001
            errors.append(e)
    try:
        before = store.current() - retain
        if retain > 0 and before > store.floor():
            lag = checkpoints.agg(F.min("last_snapshot_id")).first()[0] if checkpoints is not None else None
            if lag is not None and lag < before:
                raise ValueError(f"a replica stands at snapshot {lag}, below the new floor {before}")
            store.expire(before)
            done["expire"] = str(before)
    except Exception as e:  # noqa: BLE001
        errors.append(e)
    if errors:
        raise errors[0]
    return done
