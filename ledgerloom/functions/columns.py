"""Column functions: identifiers, buckets, text defaults, amounts, latencies and predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Kinds that stable_id may name (fixed values).
ID_KINDS = ("ledger", "tx", "op", "bronze", "contract-event", "contract-invocation", "token-transfer", "account-effect")
RANGE_WIDTH = 10_000
INDEX_WIDTH = 100_000


def stable_id(kind: str, *parts: Column) -> Column:
    """kind_ and the first 24 hex digits of SHA-256 over kind and parts joined by colons.

    A null part makes the id null instead of being dropped, so that ids never collide over missing parts.
    """
    if kind not in ID_KINDS:
        raise ValueError(f"unknown kind of id: {kind}")
    text = F.concat(F.lit(kind), *[F.concat(F.lit(":"), p.cast("string")) for p in parts])
    return F.concat(F.lit(f"{kind}_"), F.substring(F.sha2(text, 256), 1, 24))


def range_bucket(seq: Column, width: int = RANGE_WIDTH) -> Column:
    """The bucket's first sequence number (floor), in whole numbers."""
    seq = seq.cast("bigint")
    return seq - F.pmod(seq, F.lit(width).cast("bigint"))


def index_bucket(seq: Column, width: int = INDEX_WIDTH) -> Column:
    """seq / width rounded half to even, as index tables number their buckets."""
    return F.rint(seq / width).cast("bigint")


def default_text(c: Column, fallback: str) -> Column:
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(fallback))


def strip_nul(c: Column) -> Column:
    return F.regexp_replace(c, r"\x00", "")


def epoch_to_ts(c: Column) -> Column:
    """Epoch seconds, as text or number, to a timestamp."""
    return F.timestamp_seconds(c.cast("bigint"))


def hex_hash(c: Column) -> Column:
    return F.lower(F.hex(c))


def exact_amount(c: Column, scale: int = 18) -> Column:
    """Exact decimal of an amount; sums of it do not depend on the order of rows."""
    return c.cast(f"decimal(38,{scale})")


def nested_to_json(c: Column) -> Column:
    return F.to_json(c)


def loose_value(text: Column, kind: str) -> Column:
    """A value of loosely typed JSON text as kind, null where it does not fit."""
    return text.try_cast(kind)


def loose_kind(json: Column) -> Column:
    """What a JSON text is, tried in this order: null, string, bool, bigint, double, json (arrays and objects)."""
    text = F.trim(json)
    return (
        F.when(text.isNull() | (text == "null"), "null")
        .when(text.startswith('"'), "string")
        .when(text.isin("true", "false"), "bool")
        .when(text.try_cast("bigint").isNotNull() & text.rlike(r"^-?[0-9]+$"), "bigint")
        .when(text.try_cast("double").isNotNull() & text.rlike(r"^-?[0-9]"), "double")
        .otherwise("json")
    )


def redact(c: Column, secrets: list[str], mark: str = "[REDACTED]") -> Column:
    """Each secret, also where it is quoted or its quotes are doubled, replaced by mark; longest first."""
    for s in sorted({x for secret in secrets if secret for x in (secret, secret.replace("'", "''"), secret.replace('"', '\\"'))}, key=lambda x: (-len(x), x)):
        c = F.replace(c, F.lit(s), F.lit(mark))
    return c


def canonical_digest(*columns: str) -> Column:
    """sha256: and the digest of the columns' compact JSON, in the given order, nulls kept."""
    return F.concat(F.lit("sha256:"), F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256))


def millis(microseconds: Column) -> Column:
    return F.round(microseconds / 1000.0, 3)


def schedule_lag(scheduled: Column, sent: Column) -> Column:
    """How late something was sent, 0 if early."""
    return F.greatest(F.lit(0), sent - scheduled)


def over_budget(latency: Column, budget: float, exempt: Column) -> Column:
    """Whether a latency exceeds its budget; exempt rows never do, and a budget of 0 turns the check off."""
    return (F.lit(budget > 0)) & ~exempt & (latency > F.lit(budget))


def half_open(c: Column, low: Column | int, high: Column | int) -> Column:
    return (c > low) & (c <= high)


def file_overlap(start: Column, end: Column, low: int, high: int) -> Column:
    return (end >= low) & (start <= high)


def identifier_ok(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^[A-Za-z_][A-Za-z0-9_]*$"), F.lit(False))


def relation_ok(c: Column) -> Column:
    """catalog.schema.table of identifiers."""
    return F.coalesce(c.rlike(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*){2}$"), F.lit(False))


def digest_ok(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^sha256:[0-9a-f]{64}$"), F.lit(False))


def raise_if(condition: Column, message: str) -> Column:
    return F.when(condition, F.raise_error(F.lit(message)))
