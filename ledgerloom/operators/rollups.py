"""Derived tables and summaries: daily volumes, lookup indexes, latencies, counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import INDEX_WIDTH, exact_amount, half_open, index_bucket
from ledgerloom.operators.quantiles import histogram, histogram_quantile, merged, with_quantiles

#: Bounds of the ingest latency histogram, in seconds.
LATENCY_BOUNDS = [0.01, 0.025, 0.05, 0.075, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5, 0.75, 1.0, 2.0, 5.0, 10.0]


def asset_daily_volume(transfers: DataFrame, seq: str, asset: str, sender: str, amount: str, at: str, scale: int = 18) -> DataFrame:
    """Per (asset, day): transfers, exact volume, distinct senders, first and last ledger.

    Distinct senders are counted in two aggregations, so that a hot asset is spread over its senders first.
    """
    rows = transfers.select(F.col(asset).alias("asset"), F.to_date(at).alias("day"), F.col(sender).alias("_s"), exact_amount(F.col(amount), scale).alias("_v"), F.col(seq).alias("_q"))
    part = rows.groupBy("asset", "day", "_s").agg(F.count("*").alias("n"), F.sum("_v").alias("v"), F.min("_q").alias("lo"), F.max("_q").alias("hi"))
    return part.groupBy("asset", "day").agg(
        F.sum("n").alias("transfer_count"), F.sum("v").cast(f"decimal(38,{scale})").alias("volume"),
        F.count("_s").alias("unique_senders"), F.min("lo").alias("first_ledger"), F.max("hi").alias("last_ledger"),
    )


def affected_daily_volume(transfers: DataFrame, seq: str, asset: str, sender: str, amount: str, at: str, start: int, end: int, base: int = 0, scale: int = 18) -> DataFrame:
    """The same for whole days that (start, end] touches, counting from base up to end.

    A day has many transfers but days are few: the semi join's right side is one row per day.
    """
    days = transfers.where(half_open(F.col(seq), start, end)).select(F.to_date(at).alias("_day")).distinct()
    scope = transfers.where((F.col(seq) > base) & (F.col(seq) <= end)).withColumn("_day", F.to_date(at)).join(days, "_day", "left_semi")
    return asset_daily_volume(scope, seq, asset, sender, amount, at, scale)


def tx_hash_index(transactions: DataFrame, start: int, end: int, width: int = INDEX_WIDTH) -> DataFrame:
    """(tx_hash, ledger_sequence, operation_count, successful, closed_at, ledger_range) of (start, end]."""
    t = transactions.where(half_open(F.col("ledger_sequence"), start, end))
    return t.select(F.col("transaction_hash").alias("tx_hash"), "ledger_sequence", F.col("operation_count").cast("int"), "successful", F.col("created_at").alias("closed_at"), index_bucket(F.col("ledger_sequence"), width).alias("ledger_range"))


def contract_events_index(events: DataFrame, start: int, end: int, width: int = INDEX_WIDTH) -> DataFrame:
    """Per (contract_id, ledger_sequence) of (start, end] with a contract: event_count, first_seen_at, ledger_range."""
    e = events.where(half_open(F.col("ledger_sequence"), start, end) & F.col("contract_id").isNotNull())
    out = e.groupBy("contract_id", "ledger_sequence").agg(F.count("*").cast("int").alias("event_count"), F.min("closed_at").alias("first_seen_at"))
    return out.withColumn("ledger_range", index_bucket(F.col("ledger_sequence"), width))


def latency_summary(df: DataFrame, value: str, keys: list[str] | None = None) -> DataFrame:
    """count, min, nearest-rank median, p95 and p99, max and mean of a latency; a hot key's values are never in one task."""
    keys = keys or []
    sums = df.groupBy(*keys).agg(F.count(value).alias("n"), F.min(value).alias("min"), F.max(value).alias("max"), F.round(F.avg(value), 6).alias("mean"))
    ranks = {"median": 0.5, "p95": 0.95, "p99": 0.99}
    return with_quantiles(sums, df, value, ranks, keys).select(*keys, "n", "min", *ranks, "max", "mean")


def run_rollup(workers: DataFrame, keys: list[str]) -> DataFrame:
    """Workers' results (ledgers, bytes, rows, seconds, digest) -> per run: sums, the slowest worker, rates, digests."""
    out = workers.groupBy(*keys).agg(
        F.count("*").alias("workers"), F.sum("ledgers").alias("ledgers"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"),
        F.max("seconds").alias("seconds"), F.array_join(F.sort_array(F.collect_set("digest")), ",").alias("digests"),
    )
    return out.withColumns({f"{n}_per_s": F.round(F.try_divide(F.col(n), F.col("seconds")), 3) for n in ("ledgers", "rows", "bytes")})


def phase_reconcile(df: DataFrame, keys: list[str], phases: list[str], total: str, count: str, share: float = 0.15, each_ms: float = 10.0) -> DataFrame:
    """Whether the phases' sum is near the total: within share of it plus each_ms per ledger."""
    sums = df.groupBy(*keys).agg(F.sum(sum(F.col(p) for p in phases)).alias("phase_ms"), F.sum(total).alias("total_ms"), F.sum(count).alias("ledgers"))
    return sums.withColumn("reconciled", F.abs(F.col("phase_ms") - F.col("total_ms")) <= F.col("total_ms") * share + F.col("ledgers") * each_ms)


def windowed_p99(df: DataFrame, at: str, value: str, window: str = "15 minutes", threshold: float | None = None) -> DataFrame:
    """Per window: count and exact p99; with a threshold only windows above it (alerts)."""
    rows = df.where(F.col(at).isNotNull()).select(F.window(at, window)["start"].alias("window_start"), F.col(value).alias("_v"))
    out = with_quantiles(rows.groupBy("window_start").agg(F.count("*").alias("n")), rows, "_v", {"p99": 0.99}, ["window_start"])
    return out if threshold is None else out.where(F.col("p99") > threshold)


def windowed_histogram_p99(df: DataFrame, at: str, value: str, bounds: list[float] = LATENCY_BOUNDS, window: str = "15 minutes", step: str = "5 minutes", keys: list[str] | None = None) -> DataFrame:
    """(window_start, n, p99) as a monitor tells it: bucket counts per step, summed over keys and over the steps of each window."""
    keys = keys or []
    rows = df.where(F.col(at).isNotNull()).select(*keys, F.window(at, step)["start"].alias("_step"), F.col(value).alias("_v"))
    each = histogram(rows, "_v", bounds, [*keys, "_step"])
    whole = merged(each.withColumn("window_start", F.window("_step", window)["start"]), ["window_start"])
    return histogram_quantile(whole, 0.99, ["window_start"], "p99")


def table_counts_match(source: DataFrame, output: DataFrame, name: str) -> DataFrame:
    """Tables whose row counts differ between source and output, also those on one side only."""
    a, b = source.groupBy(name).agg(F.count("*").alias("a")), output.groupBy(name).agg(F.count("*").alias("b"))
    both = a.join(b, name, "full_outer").select(name, F.coalesce("a", F.lit(0)).cast("bigint").alias("expected"), F.coalesce("b", F.lit(0)).cast("bigint").alias("observed"))
    return both.where("expected <> observed")


def latest_row(df: DataFrame, keys: list[str], by: str) -> DataFrame:
    """The newest row per key by one aggregate (ties: the largest row)."""
    names = [c for c in df.columns if c not in keys]
    top = df.groupBy(*keys).agg(F.max(F.struct(F.col(by), *[c for c in names if c != by])).alias("_r"))
    return top.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in names])


def microbatch_rollup(receipts: DataFrame, keys: list[str]) -> DataFrame:
    """Receipts (ledgers, bytes, rows, seconds) -> per keys: batches, smallest and largest batch, totals, ledgers a second."""
    out = receipts.groupBy(*keys).agg(
        F.count("*").alias("batches"), F.min("ledgers").alias("min_ledgers"), F.max("ledgers").alias("max_ledgers"),
        F.sum("ledgers").alias("ledgers"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"), F.sum("seconds").alias("seconds"),
    )
    return out.withColumn("ledgers_per_s", F.round(F.try_divide("ledgers", "seconds"), 3))


def single_value_state(df: DataFrame, column: str) -> DataFrame:
    """(rows, low, high, problem) of a key that must have one non-blank value, such as a catalog's network."""
    s = df.agg(F.count("*").alias("rows"), F.min(column).alias("low"), F.max(column).alias("high"), F.count_if(F.coalesce(F.trim(column), F.lit("")) == "").alias("_blank"))
    problem = F.when(F.col("rows") == 0, "absent").when(F.col("_blank") > 0, "blank").when(F.col("low") != F.col("high"), "several values").when(F.col("rows") > 1, "repeated")
    return s.withColumn("problem", problem).drop("_blank")


def over_budget_increase(df: DataFrame, at: str, latency: str, budget: float, window: str = "5 minutes") -> DataFrame:
    """(window_start, over) of the windows in which some latency went over budget."""
    late = df.where(F.col(latency) > budget).groupBy(F.window(at, window).alias("w")).agg(F.count("*").alias("over"))
    return late.select(F.col("w.start").alias("window_start"), "over")


def burst_exempt(df: DataFrame, keys: list[str], order: list[str], burst: int) -> DataFrame:
    """exempt marks the first `burst` rows of each key; (keys, order) must be unique.

    Only the first rows of each key are ranked (the rank limit applies before the shuffle, so a hot key is cut in its
    map tasks); one row per key, the last exempt place, goes back to the rows by a join.
    """
    from pyspark.sql import Window

    place = F.struct(*order)
    first = df.select(*keys, place.alias("_o")).withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy("_o"))).where(F.col("_k") <= burst)
    last = first.groupBy(*keys).agg(F.max("_o").alias("_last")).toDF(*[f"_g{i}" for i in range(len(keys))], "_last")
    same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(last[f"_g{i}"]) for i, k in enumerate(keys)])
    return df.join(last, same, "left").withColumn("exempt", F.coalesce(place <= F.col("_last"), F.lit(False))).select(*df.columns, "exempt")
