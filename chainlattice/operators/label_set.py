"""The label set: append-only merges of attributed batches, with provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import base58
from ..functions.address import canonical_case, is_case_destroyed
from ..functions.chains import SET_INCLUDED, set_chain, strip
from .dedupe import in_order, union_sorted
from .gates import GateFailure, check_subset, check_unique

REASONS = ("no address", "synthetic '::' key (no on-chain address)", "no chain", "invalid tron base58check address", "case-destroyed address", "missing source_url/source_date provenance", "no classes")


def screen(batch: DataFrame) -> DataFrame:
    """batch with chain and address in the set's form and reject_reason, the first of REASONS that holds."""
    plain = strip(F.coalesce("address", F.lit("")))
    rows = batch.withColumns({"__plain": plain, "__chain": set_chain(F.col("chain")), "__cased": canonical_case(plain)})
    t_form = (F.col("__chain") == "tron") & (F.char_length("__cased") == 34) & F.startswith("__cased", F.lit("T"))
    rows = rows.withColumn("__key", F.when(t_form, base58.tron_to_hex(F.col("__cased"))).otherwise(F.col("__cased")))
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    tests = (
        F.col("__plain") == "",
        F.contains("__plain", F.lit("::")),
        F.col("__chain") == "",
        F.col("__key").isNull(),
        is_case_destroyed(F.col("__key"), F.col("__chain")),
        empty("source_url") | empty("source_date"),
        F.coalesce(F.size("classes"), F.lit(0)) <= 0,
    )
    reason = F
    for test, name in zip(tests, REASONS, strict=True):
        reason = reason.when(test, name)
    return rows.withColumns({"reject_reason": reason, "chain": F.col("__chain"), "address": F.col("__key")}).drop("__plain", "__chain", "__cased", "__key")


def provenance(batch_id: str, now: str) -> Column:
    """JSON of a batch row: keys sorted, nulls kept, a space after commas and colons."""
    fields = {"anchor_type": F.col("anchor_type"), "attributed_utc": F.lit(now), "batch_id": F.lit(batch_id), "method": F.col("method"), "note": F.col("note"), "source_date": F.col("source_date"), "source_url": F.col("source_url")}

    def spelt(value: Column) -> Column:
        json = F.to_json(F.struct(value.cast("string").alias("v")))
        return F.when(value.isNull(), "null").otherwise(F.substring(json, F.lit(6), F.char_length(json) - 6))

    return F.concat(F.lit("{"), F.concat_ws(", ", *[F.concat(F.lit(f'"{k}": '), spelt(v)) for k, v in sorted(fields.items())]), F.lit("}"))


def merge_batch(base: DataFrame, batch: DataFrame, batch_id: str, now: str) -> DataFrame:
    """The label set with a screened batch (which has `ord`) merged in; refused rows are left out.

    base: LABEL_SET columns. The result has them in their order and `is_new`. One shuffle by key."""
    origin = F.array(F.lit(f"attribution_batch:{batch_id}"))
    old = base.select("chain", "address", "classes", "sources", "origins", "graph_key", "case_broken", "case_provenance", "label_addr_original", F.col("provenance").alias("before"), F.lit(None).cast("string").alias("entry"), F.lit(True).alias("old"), F.lit(-1).cast("long").alias("ord"))
    new = batch.where("reject_reason is null").select(
        "chain", "address", "classes", origin.alias("sources"), origin.alias("origins"),
        F.when(F.col("chain").isin(*SET_INCLUDED), F.concat_ws(":", "chain", "address")).alias("graph_key"), F.lit(False).alias("case_broken"),
        F.lit(f"attributed:{batch_id}").alias("case_provenance"), F.lit(None).cast("string").alias("label_addr_original"), F.array().cast("array<string>").alias("before"),
        provenance(batch_id, now).alias("entry"), F.lit(False).alias("old"), F.col("ord").cast("long").alias("ord"),
    )
    first = lambda c: F.col(f"own.{c}").alias(c)
    grouped = (
        old.unionByName(new)
        .groupBy("chain", "address")
        .agg(
            *[union_sorted(F.col(c)).alias(c) for c in ("classes", "sources", "origins")],
            F.min_by(F.struct("graph_key", "case_broken", "case_provenance", "label_addr_original", "before"), "ord").alias("own"),
            in_order(["ord"], F.col("entry")).alias("entries"),
            (~F.bool_or("old")).alias("is_new"),
        )
    )
    return grouped.select(
        "chain", "address", "classes", "sources", "origins", first("graph_key"), first("case_broken"), first("case_provenance"), first("label_addr_original"),
        F.col("chain").isin(*SET_INCLUDED).alias("in_included_5"), F.concat(F.coalesce("own.before", F.array().cast("array<string>")), "entries").alias("provenance"), "is_new",
    )


def stats(screened: DataFrame, merged: DataFrame, base: DataFrame) -> dict:
    """Counts of a merge: batch_rows, added_new, merged_into_existing, refused_total, refused_breakdown."""
    reasons = {r.reject_reason: r["count"] for r in screened.groupBy("reject_reason").count().collect()}
    added = merged.where("is_new").count()
    accepted = reasons.pop(None, 0)
    return {
        "batch_rows": accepted + sum(reasons.values()),
        "added_new": added,
        "merged_into_existing": accepted - added,
        "refused_total": sum(reasons.values()),
        "refused_breakdown": {f"refused:{k}": v for k, v in sorted(reasons.items())},
    }


def check_append_only(base: DataFrame, merged: DataFrame) -> None:
    """GateFailure if the merge lost or repeated a key."""
    check_unique(merged, ["chain", "address"], "label set")
    check_subset(base, merged, ["chain", "address"], "label set")


def verify_base(rows: int, keys: int, manifest: dict | None, digest: str | None) -> None:
    """GateFailure unless a base file is what its manifest says and has no repeated key."""
    if rows != keys:
        raise GateFailure(f"{keys} keys in {rows} rows of the base")
    if manifest is None:
        return
    if not manifest.get("parquet_sha256"):
        raise GateFailure("the base manifest has no parquet_sha256")
    if manifest["parquet_sha256"] != digest:
        raise GateFailure("the base file differs from its manifest's parquet_sha256")
    if manifest.get("rows_total") is not None and manifest["rows_total"] != rows:
        raise GateFailure(f"the base has {rows} rows, its manifest {manifest['rows_total']}")
