"""Gated publication: a declared SQL transformation is built twice, checked, replayed on a sample, then published."""

from __future__ import annotations

import hashlib
import json
import re
import time
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.parity import equal
from ledgerloom.plans.versioned import Change, Store
from ledgerloom.session import drop_path, work_path

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*\Z")


class Rejected(RuntimeError):
    """A gate failed; nothing was published. gates has all results."""

    def __init__(self, gates: list[tuple[str, bool]]) -> None:
        super().__init__("rejected by " + ", ".join(n for n, ok in gates if not ok))
        self.gates = gates


@dataclass(frozen=True)
class Proposal:
    """SQL over the views source and (in invariants) candidate, with the named arguments :start_ledger and :end_ledger.

    The range is (start, end].
    """

    proposal_id: str
    agent_id: str
    source: str
    snapshot: int
    start: int
    end: int
    target: str
    replace_keys: tuple[str, ...]
    transformation: str
    invariants: tuple[tuple[str, str], ...] = field(default=())

    @staticmethod
    def from_yaml(text: str) -> Proposal:
        """Strict: exactly one document, no unknown and no missing keys."""
        import yaml

        docs = list(yaml.safe_load_all(text))
        if len(docs) != 1 or not isinstance(docs[0], dict):
            raise ValueError("a proposal is exactly one document")
        d = docs[0]
        known = {"api_version", "proposal_id", "agent_id", "source", "ledger_range", "target", "transformation", "invariants"}
        if set(d) - known or known - set(d) - {"invariants"}:
            raise ValueError(f"unknown or missing keys: {sorted(set(d) ^ known)}")
        put = lambda s: re.sub(r"\{\{(\w+)\}\}", lambda m: m[1] if m[1] in ("source", "candidate") else ":" + m[1], s)
        return Proposal(
            d["proposal_id"], d["agent_id"], d["source"]["relation"], int(d["source"]["snapshot_id"]), int(d["ledger_range"]["start_exclusive"]), int(d["ledger_range"]["end_inclusive"]),
            d["target"]["relation"], tuple(d["target"]["replace_keys"]), put(d["transformation"]), tuple((i["name"], put(i["sql"])) for i in d.get("invariants", [])),
        )

    def validate(self) -> None:
        parts = self.source.split("."), self.target.split(".")
        if any(len(p) != 3 or not all(map(_NAME.match, p)) for p in parts) or parts[0][0] != parts[1][0]:
            raise ValueError("source and target must be catalog.schema.table in one catalog")
        if self.snapshot <= 0 or self.start >= self.end:
            raise ValueError("snapshot must be positive and start below end")
        if not self.replace_keys or len(set(self.replace_keys)) != len(self.replace_keys) or not all(map(_NAME.match, self.replace_keys)):
            raise ValueError("replace_keys must be distinct names")
        if len({n for n, _ in self.invariants}) != len(self.invariants):
            raise ValueError("invariants must have distinct names")
        for sql, needed in [(self.transformation, "source"), *[(q, "candidate") for _, q in self.invariants]]:
            if ";" in sql or not re.match(r"\s*(select|with)\b", sql, re.IGNORECASE) or not re.search(rf"\b{needed}\b", sql):
                raise ValueError("SQL must be one query that reads " + needed)

    def digest(self) -> str:
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True, separators=(",", ":")).encode()).hexdigest()

    def replay_range(self) -> tuple[int, int]:
        """A tenth of the range (at least one ledger), placed by the digest."""
        span = self.end - self.start
        width = max(1, span // 10)
        low = self.start + int(self.digest()[:16], 16) % (span - width + 1)
        return low, low + width


#: Plan leaves that hold no stored data.
_CONSTANT = frozenset(("OneRowRelation", "LocalRelation", "CTERelationRef", "Range"))


def _foreign(plan: object, allowed: set[str]) -> list[str]:
    """Leaves of an analysed plan, subqueries among them, that are neither constants nor below one of the allowed views."""
    kind = plan.getClass().getSimpleName()
    if kind == "View" and plan.desc().identifier().table().lower() in allowed:
        return []
    below = [*_items(plan.children()), *_items(plan.subqueries())]
    if not below and kind not in _CONSTANT:
        return [kind]
    return [f for child in below for f in _foreign(child, allowed)]


def _items(seq: object) -> list:
    return [seq.apply(i) for i in range(seq.size())]


#: Expressions whose value belongs to the run or its session, not to the data (Spark's own class names).
_OF_THE_RUN = frozenset((
    "CurrentCatalog", "CurrentDatabase", "CurrentDate", "CurrentTime", "CurrentTimeZone", "CurrentTimestamp", "CurrentUser", "InputFileBlockLength", "InputFileBlockStart",
    "InputFileName", "LocalTimestamp", "Now", "SparkVersion",
))


def _of_the_run(plan: object, allowed: set[str]) -> bool:
    """Whether an expression of the plan, subqueries among them, differs from run to run; allowed views are not looked into."""
    if plan.getClass().getSimpleName() == "View" and plan.desc().identifier().table().lower() in allowed:
        return False
    todo = _items(plan.expressions())
    while todo:
        e = todo.pop()
        if e.getClass().getSimpleName() in _OF_THE_RUN:
            return True
        todo += _items(e.children())
    return any(_of_the_run(child, allowed) for child in [*_items(plan.children()), *_items(plan.subqueries())])


def confined(df: DataFrame, views: set[str]) -> bool:
    """The analysed plan is a deterministic query that reads nothing but these views: no command, no other table or file,
    nothing that differs from run to run. Expressions are judged by their classes, so a text that names one is none."""
    plan, allowed = df._jdf.queryExecution().analyzed(), {v.lower() for v in views}
    return plan.deterministic() and "Command" not in plan.getClass().getSimpleName() and not _foreign(plan, allowed) and not _of_the_run(plan, allowed)


def _naming(sql: str, views: dict[str, str]) -> str:
    """The query with names for views put before it as a WITH clause, so that runs in one session do not mix."""
    names = ", ".join(f"{n} AS (SELECT * FROM {v})" for n, v in views.items())
    return re.sub(r"\A\s*with\b", f"WITH {names}, ", sql, count=1, flags=re.IGNORECASE) if re.match(r"\s*with\b", sql, re.IGNORECASE) else f"WITH {names} {sql}"


#: What a receipt has; fixed names, as other tools read receipts by them.
RECEIPTS = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("promotion_id", "proposal_id", "proposal_hash", "agent_id")]
    + [T.StructField(n, T.LongType()) for n in ("source_snapshot_id", "start_ledger_exclusive", "end_ledger_inclusive")]
    + [T.StructField("target_relation", T.StringType()), T.StructField("promoted_rows", T.LongType()), T.StructField("gate_results_json", T.StringType()), T.StructField("promoted_at", T.TimestampType())]
)


#: What a report has; fixed names, as other tools read reports by them.
REPORT = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("status", "proposal_id", "proposal_hash", "promotion_id")]
    + [T.StructField("promoted_rows", T.LongType()), T.StructField("gates", T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("passed", T.BooleanType())]))), T.StructField("error", T.StringType())]
)


def _staged(df: DataFrame, staging: str, name: str) -> DataFrame:
    path = f"{staging}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_gates(spark: SparkSession, store: Store, p: Proposal, staging: str | None = None) -> tuple[DataFrame, list[tuple[str, bool]]]:
    """Build twice, compare, check invariants, replay a sample -> the candidate and all gates' results.

    Nothing is built where the transformation is not confined to the source. An invariant that reads anything but the
    candidate and the source, or is not exactly one boolean row, is an error, not a failed gate. What is built stands below
    staging (a new folder named by the proposal's digest where none is given) and stays there.
    """
    p.validate()
    staging = staging or work_path(spark, f"proposal-{p.digest()[:16]}")
    if p.snapshot > store.current():
        raise ValueError("the proposal pins a snapshot that does not exist yet")
    views = {n: f"_{n}_{uuid.uuid4().hex}" for n in ("source", "candidate")}
    store.as_of(p.source.split(".")[2], p.snapshot).createOrReplaceTempView(views["source"])

    def ask(sql: str, low: int, high: int, *names: str) -> DataFrame:
        return spark.sql(_naming(sql, {n: views[n] for n in names}), args={"start_ledger": low, "end_ledger": high})

    try:
        built = ask(p.transformation, p.start, p.end, "source")
        gates = [("confinement", confined(built, {views["source"]}))]
        if not gates[0][1]:
            return built, gates
        a, b = _staged(built, staging, "a"), _staged(ask(p.transformation, p.start, p.end, "source"), staging, "b")
        gates.append(("reproducibility", equal(a, b)))
        a.createOrReplaceTempView(views["candidate"])
        for name, sql in p.invariants:
            check = ask(sql, p.start, p.end, "source", "candidate")
            if not confined(check, set(views.values())):
                raise ValueError(f"invariant {name} reads more than the candidate and the source")
            got = check.limit(2).collect()
            if len(got) != 1 or len(got[0]) != 1 or not isinstance(got[0][0], bool):
                raise ValueError(f"invariant {name} did not return one boolean row")
            gates.append((f"reconciliation/{name}", got[0][0]))
        low, high = p.replay_range()
        gates.append(("replay", equal(*(_staged(ask(p.transformation, low, high, "source"), staging, f"replay-{x}") for x in "ab"))))
        return a, gates
    finally:
        for v in views.values():
            spark.catalog.dropTempView(v)


def created_tables(store: Store) -> dict[str, tuple[T.StructType, str]]:
    """Targets that promotions have made, as the store's declarations: {name: (schema, range column)}, from the log."""
    return {n: (T.StructType.fromJson(json.loads(schema)), seq) for e in store.log() for n, (schema, seq) in e.get("facts", {}).get("created", {}).items()}


def _new_target(candidate: DataFrame, keys: tuple[str, ...]) -> tuple[T.StructType, str]:
    """The candidate's columns; rows are laid out by the first replace key that is a whole number."""
    whole = [k for k in keys if isinstance(candidate.schema[k].dataType, T.IntegralType)]
    if not whole:
        raise ValueError("a target that does not exist yet needs a whole number among its replace_keys")
    return candidate.schema, whole[0]


def promote(spark: SparkSession, store: Store, p: Proposal) -> dict:
    """Publish into the store's target table with a receipt in table promotions, under one snapshot, or raise Rejected.

    Published rows with a candidate's keys end by key tombstones; the rest of the target is neither read nor rewritten. A
    target that the store does not know is made with the candidate's columns, in the same snapshot (see created_tables).
    What was built is deleted after success; what was rejected stays to be looked at.
    """
    store.tables |= {n: t for n, t in created_tables(store).items() if n not in store.tables}
    staging = work_path(spark, f"proposal-{p.digest()[:16]}")
    candidate, gates = run_gates(spark, store, p, staging)
    if not all(ok for _, ok in gates):
        raise Rejected(gates)
    target = p.target.split(".")[2]
    now = time.time()
    rows = candidate.count()
    receipt = {
        "promotion_id": hashlib.sha256(f"{p.digest()}:{p.start}:{p.end}:{now}".encode()).hexdigest()[:32], "proposal_id": p.proposal_id, "proposal_hash": p.digest(), "agent_id": p.agent_id,
        "source_snapshot_id": p.snapshot, "start_ledger_exclusive": p.start, "end_ledger_inclusive": p.end, "target_relation": p.target, "promoted_rows": rows, "gate_results_json": json.dumps(gates),
    }
    row = spark.createDataFrame([receipt], T.StructType([f for f in RECEIPTS.fields if f.name != "promoted_at"])).withColumn("promoted_at", F.timestamp_seconds(F.lit(now)))
    known, facts = target in store.tables, None
    if not known:
        schema, seq = _new_target(candidate, p.replace_keys)
        store.tables[target], facts = (schema, seq), {"created": {target: [schema.json(), seq]}}
    try:
        store.commit({target: Change(rows=candidate, clear_rows=candidate.select(*p.replace_keys) if known else None), "promotions": Change(rows=row)}, batch_id=receipt["promotion_id"], facts=facts)
    except BaseException:
        if not known:
            del store.tables[target]
        raise
    drop_path(spark, staging)
    return receipt


def promote_reported(spark: SparkSession, store: Store, p: Proposal, folder: str) -> dict:
    """promote(), with a report of how it ended as one JSON row in a new folder below `folder` -> the report.

    Its status is promoted, rejected (all gates' results are in it) or error (with the message); only an error is raised
    again, after its report is written.
    """
    report = {"status": "error", "proposal_id": p.proposal_id, "proposal_hash": p.digest(), "promotion_id": None, "promoted_rows": None, "gates": [], "error": None}
    failed: Exception | None = None
    try:
        receipt = promote(spark, store, p)
        report |= {"status": "promoted", "promotion_id": receipt["promotion_id"], "promoted_rows": receipt["promoted_rows"], "gates": json.loads(receipt["gate_results_json"])}
    except Rejected as e:
        report |= {"status": "rejected", "gates": [list(g) for g in e.gates]}
    except Exception as e:  # noqa: BLE001
        failed = e
        report["error"] = str(e)
    gates = [{"name": n, "passed": ok} for n, ok in report["gates"]]
    spark.createDataFrame([report | {"gates": gates}], REPORT).coalesce(1).write.json(f"{folder}/report-{uuid.uuid4().hex}", ignoreNullFields=False)
    if failed is not None:
        raise failed
    return report
