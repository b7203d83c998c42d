"""Batch contracts: coerce, flag violations per row, decide per batch.

A batch is the unit of failure: one violation rejects the whole (source,
zone, market day, run) frame, and the other batches still load. All of it is
grouped aggregation on the executors; nothing is looped over on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.operators.keys import null_safe_join
from gridmart.specs import Contract

BATCH = ("source", "zone_code", "market_day", "run_id")

# Violation counters, in the order reasons are listed.
CHECKS = ("bad_type", "null_required", "bad_zone", "out_of_range", "bad_resolution", "duplicate_keys")


class ContractError(ValueError):
    """The input lacks a declared column: no batch in it can be validated."""


def check_columns(df: DataFrame, contract: Contract) -> None:
    missing = [c for c in contract.columns if c not in df.columns]
    if missing:
        raise ContractError(f"missing declared columns: {missing}")


def _uniq(cols: Sequence[str]) -> list[str]:
    return list(dict.fromkeys(cols))


def flag_rows(df: DataFrame, contract: Contract, batch: Sequence[str] = BATCH) -> DataFrame:
    """Coerce declared columns and add one boolean per row-level check.

    Undeclared columns are dropped. Coercion is ``try_cast`` (ANSI casts would
    fail the job): a value that was present and casts to null is a type
    violation. NaN measures are normalised to null first; a null measure is
    allowed, a null required column is not.
    """
    check_columns(df, contract)
    keep = _uniq([*batch, *contract.columns])
    # Every text is parsed once, in a projection of its own that the flags refer to.
    kinds = {n: t for n, t in contract.columns.items() if df.schema[n].dataType != t}
    df = df.select("*", *[F.col(n).try_cast(t).alias(f"_cast_{n}") for n, t in kinds.items()])
    coerced: dict[str, Column] = {}
    bad_type = F.lit(False)
    for name, dtype in contract.columns.items():
        value = F.col(f"_cast_{name}" if name in kinds else name)
        if name in kinds:
            bad_type = bad_type | (F.col(name).isNotNull() & value.isNull())
        if name == contract.measure:
            value = F.when(~F.isnan(value), value)
        coerced[name] = value
    null_required = F.lit(False)
    for name in _uniq([*contract.required, *batch]):  # a broken line also loses its batch key
        null_required = null_required | F.col(name).isNull()
    lo, hi = contract.measure_range
    m = coerced[contract.measure]
    res = coerced["resolution_minutes"]
    zone = coerced["zone_code"]
    flags = {
        "bad_type": bad_type,
        "null_required": null_required,
        "bad_zone": zone.isNotNull() & ~zone.rlike(contract.zone_pattern),
        "out_of_range": m.isNotNull() & ~m.between(lo, hi),
        "bad_resolution": res.isNotNull() & ~res.isin(*contract.resolutions),
    }
    out = [coerced[c].alias(c) if c in coerced else F.col(c) for c in keep]
    return df.select(*out, *[v.alias(k) for k, v in flags.items()])


def _row_hash(contract: Contract, batch: Sequence[str]) -> Column:
    """Hash of a row's declared content, its batch key left out; a null is a value like any other."""
    content = [c for c in contract.columns if c not in batch or c == "zone_code"]
    return F.xxhash64(*[F.struct(F.col(c).isNull().alias("n"), F.col(c).alias("v")) for c in content])


def verdicts(flagged: DataFrame, contract: Contract, batch: Sequence[str] = BATCH, digest: bool = False) -> DataFrame:
    """One row per batch: row count, violation counts, passed, reason.

    With ``digest`` also a text that names the batch's rows whatever their order:
    their number, and the exclusive or and the sum of their hashes (copies cancel in
    the one and count in the other).

    Two chained aggregations and no join: first per (batch, key) -- rows and
    flag counts per key -- then per batch, where a key with more than one row
    is a duplicate. Both combine map-side, so neither a hot batch nor a key
    repeated millions of times reaches one task whole.
    """
    row_checks = [k for k in CHECKS if k != "duplicate_keys"]
    per_row, per_batch = [], []
    if digest:
        flagged = flagged.withColumn("_hash", _row_hash(contract, batch))
        # The sum in two halves: sums of longs, whose overflow is two thousand million rows away.
        low, high = F.col("_hash").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftright("_hash", 32)
        per_row = [F.bit_xor("_hash").alias("_xor"), F.sum(low).alias("_low"), F.sum(high).alias("_high")]
        per_batch = [F.bit_xor("_xor").alias("_xor"), F.sum("_low").alias("_low"), F.sum("_high").alias("_high")]
    per_key = flagged.groupBy(*_uniq([*batch, *contract.key])).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(k)).alias(k) for k in row_checks], *per_row
    )
    v = per_key.groupBy(*batch).agg(
        F.sum("_n").alias("rows"),
        *[F.sum(k).alias(k) for k in row_checks],
        F.count_if(F.col("_n") > 1).alias("duplicate_keys"),
        *per_batch,
    )
    total = F.col("_high").cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.col("_low").cast("decimal(20,0)")
    made = [F.concat_ws(":", "rows", F.hex("_xor"), total.cast("string")).alias("digest")] if digest else []
    failing = [F.when(F.col(k) > 0, F.lit(k)) for k in CHECKS]
    passed = F.lit(True)
    for k in CHECKS:
        passed = passed & (F.col(k) == 0)
    return v.select(
        *batch,
        F.col("rows").cast("bigint").alias("rows"),
        *[F.col(k).cast("bigint").alias(k) for k in CHECKS],
        passed.alias("passed"),
        F.nullif(F.concat_ws(",", *failing), F.lit("")).alias("reason"),
        *made,
    )


def mark_replays(verdict: DataFrame, loaded: DataFrame, batch: Sequence[str] = BATCH) -> DataFrame:
    """``verdict`` (with ``digest``) and ``replayed``: the batch passes, and what it last loaded has this digest.

    ``loaded`` are ledger rows of loaded batches with their ``digest`` and
    ``ingested_at``. The last load of a batch decides, so a content that was
    replaced in between loads again.
    """
    # Texts are aggregated by sorting; a hash as the first key keeps that to comparing numbers.
    last = (loaded.groupBy(F.xxhash64(*batch).alias("_hash"), *batch)
            .agg(F.max_by("digest", F.struct("ingested_at", "digest")).alias("_last")).drop("_hash"))
    marked = null_safe_join(verdict, last, batch, "left")
    same = F.col("passed") & F.coalesce(F.col("digest") == F.col("_last"), F.lit(False))
    return marked.withColumn("replayed", same).drop("_last")


def valid_rows(
    flagged: DataFrame,
    verdict: DataFrame,
    contract: Contract,
    batch: Sequence[str] = BATCH,
    mode: str = "batch",
) -> DataFrame:
    """Rows that may be written to bronze.

    ``mode="batch"`` (default): drop every row of a rejected batch (anti join
    on the batch key, null parts included; the verdict side has one row per batch, so AQE can
    broadcast it once measured small, or split a hot batch otherwise).
    ``mode="row"``: quarantine only offending rows and colliding keys.
    """
    cols = _uniq([*batch, *contract.columns])
    if mode == "batch":
        bad = verdict.filter(~F.col("passed")).select(*batch)
        return null_safe_join(flagged, bad, batch, "left_anti").select(*cols)
    if mode == "row":
        clean = flagged
        for k in CHECKS:
            if k != "duplicate_keys":
                clean = clean.filter(~F.col(k))
        keys = _uniq([*batch, *contract.key])
        dup = flagged.groupBy(*keys).count().filter(F.col("count") > 1).select(*keys)
        return null_safe_join(clean, dup, keys, "left_anti").select(*cols)
    raise ValueError(f"unknown mode {mode!r}")


LEDGER_COLUMNS = (*BATCH, "rows", "rows_loaded", "status", "reason")
MISSING_REASON = "no data for the requested window"
FAILURES = ("rejected", "missing")


def ledger(verdict: DataFrame, missing: DataFrame | None = None, batch: Sequence[str] = BATCH) -> DataFrame:
    """Per-batch outcome: loaded, rejected with reason, or replayed; missing batches too.

    ``missing`` has (some of) the batch columns, and may bring the ``rows`` that
    were landed, a ``status`` (default: missing), a ``reason`` and a ``file`` of its own.
    """
    replayed = F.col("replayed") if "replayed" in verdict.columns else F.lit(False)
    loads = F.col("passed") & ~replayed
    out = verdict.select(
        *batch,
        F.col("rows"),
        F.when(loads, F.col("rows")).otherwise(F.lit(0)).cast("bigint").alias("rows_loaded"),
        F.when(replayed, F.lit("replayed")).when(loads, F.lit("loaded")).otherwise(F.lit("rejected")).alias("status"),
        F.col("reason"),
        *([F.col("digest")] if "digest" in verdict.columns else []),
    )
    if missing is not None:
        have = missing.columns
        key = [F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in batch]
        rows = F.coalesce("rows", F.lit(0)) if "rows" in have else F.lit(0)
        status = F.coalesce("status", F.lit("missing")) if "status" in have else F.lit("missing")
        reason = F.coalesce("reason", F.lit(MISSING_REASON)) if "reason" in have else F.lit(MISSING_REASON)
        out = out.unionByName(missing.select(
            *key, rows.cast("bigint").alias("rows"), F.lit(0).cast("bigint").alias("rows_loaded"),
            status.alias("status"), reason.alias("reason"), *([F.col("file")] if "file" in have else []),
        ), allowMissingColumns=True)
    return out


def summary(ledger_df: DataFrame) -> DataFrame:
    """Per source: zones, batches, failures, rows loaded (the run summary).

    Rejected and missing batches are failures. A batch that was landed in order but
    has nothing inside its window (``empty``) or was loaded before (``replayed``) is none.
    """
    return ledger_df.groupBy("source").agg(
        F.countDistinct("zone_code").alias("zones"),
        F.count(F.lit(1)).alias("batches"),
        F.count_if(F.col("status").isin(*FAILURES)).alias("failures"),
        F.sum("rows_loaded").cast("bigint").alias("rows_loaded"),
    )
