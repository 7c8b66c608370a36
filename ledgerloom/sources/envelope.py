"""Batch envelopes (one ledger a row): reading, explosion into typed tables, projection of JSON payloads."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.columns import default_text, range_bucket, stable_id
from ledgerloom.operators.mutations import enrich_last

#: Fixed names of the envelope's JSON form; 64-bit integers are text there, 32-bit ones numbers.
_ITEM = "id string, networkPassphrase string, ledgerSequence bigint"
ENVELOPE = f"""networkPassphrase string, schemaVersion string, extractionVersion string, ledgerSequence bigint, closedAtUnix string,
ledgers array<struct<{_ITEM}, closedAtUnix: string, ledgerHash: string, previousLedgerHash: string, protocolVersion: bigint, transactionCount: bigint>>,
transactions array<struct<{_ITEM}, transactionIndex: bigint, transactionHash: string, successful: boolean, envelopeXdr: string, resultXdr: string, metaXdr: string>>,
operations array<struct<{_ITEM}, transactionId: string, transactionIndex: bigint, operationIndex: bigint, operationType: string, operationXdr: string>>,
contractEvents array<struct<{_ITEM}, transactionId: string, transactionIndex: bigint, eventIndex: bigint, contractId: string, topicJson: string, valueJson: string>>,
contractInvocations array<struct<{_ITEM}, transactionId: string, transactionIndex: bigint, invocationIndex: bigint, contractId: string, functionName: string, argumentsJson: string>>,
tokenTransfers array<struct<{_ITEM}, transactionId: string, transactionIndex: bigint, operationIndex: bigint, assetCode: string, assetIssuer: string, fromAccount: string, toAccount: string, amount: string>>,
accountEffects array<struct<{_ITEM}, transactionId: string, transactionIndex: bigint, operationIndex: bigint, accountId: string, effectType: string, effectJson: string>>,
bronzeRows array<struct<id: string, tableName: string, networkPassphrase: string, ledgerSequence: bigint, ledgerRange: bigint, rowJson: string>>"""
ENVELOPE_SCHEMA = re.sub(r"struct<id string, networkPassphrase string, ledgerSequence bigint", "struct<id: string, networkPassphrase: string, ledgerSequence: bigint", ENVELOPE)
#: Columns of the payload whose exported name does not follow the rule of exported_name().
ACRONYMS = {"id": "ID", "xdr": "XDR", "ttl": "TTL", "json": "JSON"}


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    seq: str = "ledger_sequence"
    pinned: tuple[str, ...] = ()
    #: column -> payload name, where the rule gives another one; column -> constant.
    names: dict[str, str] = field(default_factory=dict)
    constants: dict[str, str] = field(default_factory=dict)


def declared_tables(path: str | Path) -> dict[str, TableSpec]:
    """Specs from a declaration file: per table a heading, a line with its range column and pinned columns, and its
    columns as `name` type pairs. Any type but the six declared ones is an error."""
    kinds = {"string", "bigint", "int", "double", "boolean", "timestamp"}
    out: dict[str, TableSpec] = {}
    text = Path(path).read_text()
    for block in re.split(r"^### ", text, flags=re.MULTILINE)[1:]:
        name = block.split("\n", 1)[0].strip()
        columns = re.findall(r"`(\w+)` (\w+)", block)
        if not re.fullmatch(r"\w+", name) or not columns:
            continue
        if bad := {t for _, t in columns} - kinds:
            raise ValueError(f"{name}: unknown types {sorted(bad)}")
        seq = re.search(r"range column `(\w+)`", block)
        pinned = re.search(r"pinned: ([\w, ]+)$", block.split("\n\n")[1], re.MULTILINE)
        pins = tuple(p.strip() for p in pinned[1].split(",")) if pinned and pinned[1].strip() != "none" else ()
        fields = [T.StructField(c, T._parse_datatype_string(t if t != "timestamp" else "timestamp")) for c, t in columns]
        out[name] = TableSpec(name, T.StructType(fields), seq[1] if seq else "ledger_sequence", pins)
    return out


def exported_name(column: str) -> str:
    """snake_case -> the payload's CamelCase with fixed acronyms."""
    return "".join(ACRONYMS.get(p, p.capitalize()) for p in column.split("_"))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """One envelope per JSON line; malformed lines are errors, blank ones are skipped."""
    return spark.read.schema(ENVELOPE_SCHEMA).option("mode", "FAILFAST").json(path)


def stream_batches(spark: SparkSession, path: str, kind: str | None = None, per_trigger: int | None = None) -> DataFrame:
    """Envelopes as a file stream; with kind, lines are (type, batch) events and other types are passed over."""
    schema = ENVELOPE_SCHEMA if kind is None else T.StructType([T.StructField("type", T.StringType()), T.StructField("batch", T._parse_datatype_string(ENVELOPE_SCHEMA))])
    reader = spark.readStream.schema(schema).option("mode", "FAILFAST")
    stream = (reader.option("maxFilesPerTrigger", per_trigger) if per_trigger else reader).json(path)
    return stream if kind is None else stream.where(F.col("type") == kind).select("batch.*")


def normalized(batches: DataFrame, network: str = "", schema_version: str = "v1", extraction_version: str = "v1") -> DataFrame:
    """Envelopes with defaults filled, the close time as a number and the range bucket."""
    return batches.withColumns({
        "networkPassphrase": default_text(F.col("networkPassphrase"), network),
        "schemaVersion": default_text(F.col("schemaVersion"), schema_version),
        "extractionVersion": default_text(F.col("extractionVersion"), extraction_version),
        "closedAtUnix": F.col("closedAtUnix").cast("bigint"),
        "ledgerRange": range_bucket(F.col("ledgerSequence")),
    })


def batch_counts(batches: DataFrame) -> DataFrame:
    """Per ledger: transactions, operations, bronze rows."""
    n = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("int")
    return batches.select(
        F.col("networkPassphrase").alias("network_passphrase"), F.col("ledgerSequence").alias("ledger_sequence"), F.col("closedAtUnix").cast("bigint").alias("closed_at_unix"),
        n("transactions").alias("transaction_count"), n("operations").alias("operation_count"), n("bronzeRows").alias("bronze_row_count"),
    )


def bronze_rows(batches: DataFrame) -> DataFrame:
    """One row per payload with its ordinal in (ledger, table) and a position-based id, so that replays give equal ids.

    Ordinals are places in the envelope's own list, told table by table inside the row: no shuffle and no window. Each ledger
    has one envelope."""
    names = F.array_distinct(F.transform("bronzeRows", lambda x: x["tableName"]))
    own = lambda n: F.transform(F.filter("bronzeRows", lambda x: x["tableName"].eqNullSafe(n)), lambda x, i: F.struct(n.alias("table_name"), x["rowJson"].alias("row_json"), i.alias("row_ordinal")))
    rows = batches.select("networkPassphrase", "ledgerSequence", F.explode(F.flatten(F.transform(names, own))).alias("r")).select("networkPassphrase", "ledgerSequence", "r.*")
    return rows.withColumn("bronze_row_id", stable_id("bronze", F.col("networkPassphrase"), F.col("ledgerSequence"), F.col("table_name"), F.col("row_ordinal")))


def known_tables(rows: DataFrame, names: list[str], mode: str = "skip") -> DataFrame:
    """Rows of known tables; an unknown name is skipped, or an error with mode="fail"."""
    known = F.col("table_name").isin(names)
    if mode == "skip":
        return rows.where(known)
    if mode != "fail":
        raise ValueError("mode is skip or fail")
    return rows.withColumn("table_name", F.when(known, F.col("table_name")).otherwise(F.raise_error(F.concat(F.lit("unknown table "), F.coalesce("table_name", F.lit("null"))))))


def _typed(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.to_timestamp(text)
    return text.cast(kind)


def project_typed(rows: DataFrame, spec: TableSpec, payload: str = "row_json", extraction_version: str = "v1") -> DataFrame:
    """JSON payloads -> the spec's typed columns: constants first, then the payload's value; nested values stay JSON text.

    The payload is parsed once, as text fields of just the names needed; numbers and booleans are cast strictly.
    """
    named = {f.name: spec.names.get(f.name, exported_name(f.name)) for f in spec.schema.fields}
    parsed = rows.withColumn("_p", F.from_json(payload, T.StructType([T.StructField(n, T.StringType()) for n in dict.fromkeys(named.values())])))
    out = []
    for f in spec.schema.fields:
        if f.name == "version_label":
            c = F.lit(extraction_version)
        elif f.name in spec.constants:
            c = F.lit(spec.constants[f.name]).cast(f.dataType)
        else:
            c = _typed(F.col(f"_p.{named[f.name]}"), f.dataType)
        out.append(c.alias(f.name))
    return parsed.select(*out)


def with_transaction_texts(typed: DataFrame, batches: DataFrame) -> DataFrame:
    """Transaction rows take their envelope, result and meta texts from the batch's transaction list (the last one wins)."""
    t = batches.select("ledgerSequence", F.posexplode("transactions").alias("pos", "t"))
    lookup = t.select(F.col("ledgerSequence").alias("ledger_sequence"), F.col("t.transactionHash").alias("transaction_hash"), "pos", F.col("t.envelopeXdr").alias("tx_envelope"), F.col("t.resultXdr").alias("tx_result"), F.col("t.metaXdr").alias("tx_meta"))
    return enrich_last(typed, lookup, ["ledger_sequence", "transaction_hash"], "pos", ["tx_envelope", "tx_result", "tx_meta"])


def pin_times(df: DataFrame, spec: TableSpec, at: Column) -> DataFrame:
    """Materialization times set to one pinned time; event times stay."""
    return df.withColumns({c: at for c in spec.pinned})
