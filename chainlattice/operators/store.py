"""The unified store: an order-aware fold of records into one per address.

Records carry `ord`, a number or struct that gives their order: base before files, files as listed,
records as they stand. One shuffle by address serves the window and both aggregations.

A scalar is the first value there is; only the first sanctioned record after the first record puts
its own values before those that came earlier. Flags are true if any record's is. Labels are united
by (name, source, chain, context.source_url), first ones first; the first record keeps its own
duplicates. Extras keep the first record that has the key. Everything else is the first record's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..schema import FLAGS, LABEL, SCALARS
from .dedupe import first_wins


def scalar(field: str) -> Column:
    """Aggregate of a field over an address's records, which have `first` and `promoted` orders."""
    value = F.col(field)
    at_promotion = F.max(F.when(F.col("ord") == F.col("promoted"), value))
    promotes = F.first(F.col("promoted") > F.col("first")) & at_promotion.isNotNull()
    late = F.col("ord") >= F.col("promoted")
    full, some = value != "", value.isNotNull()

    def pick(scope: Column) -> Column:
        return F.coalesce(F.min_by(value, F.when(scope & full, F.col("ord"))), F.when(F.max(scope & some), F.lit("")))

    return F.when(F.coalesce(promotes, F.lit(False)), pick(late)).otherwise(pick(F.lit(True)))


def united_labels(records: DataFrame) -> DataFrame:
    """address and the union of its records' labels."""
    each = records.select("address", "ord", F.min("ord").over(Window.partitionBy("address")).alias("first"), F.posexplode("labels").alias("pos", "label"))
    key = [F.col("address"), F.col("label.name"), F.col("label.source"), F.col("label.chain"), F.col("label.context.source_url")]
    ranked = each.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy("ord", "pos")))
    kept = ranked.where((F.col("rank") == 1) | (F.col("ord") == F.col("first")))
    return kept.groupBy("address").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "pos", "label"))), lambda x: x["label"]).alias("labels"))


def united_extras(records: DataFrame) -> DataFrame:
    each = records.select("address", "ord", F.explode("extras").alias("k", "v"))
    first = first_wins(each, ["address", "k"], ["ord"])
    return first.groupBy("address").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("extras"))


def merge(records: DataFrame) -> DataFrame:
    """One record for each address, with n_records and the order of its first record as `ord`."""
    own = Window.partitionBy("address")
    marked = records.withColumns({"first": F.min("ord").over(own), "promoted": F.min(F.when(F.col("sanctioned"), F.col("ord"))).over(own)})
    folded = marked.groupBy("address").agg(
        F.min_by(F.struct("chain", "last_verified"), "ord").alias("own"),
        *[F.bool_or(F.coalesce(f, F.lit(False))).alias(f) for f in FLAGS],
        *[scalar(f).alias(f) for f in SCALARS],
        F.count("*").alias("n_records"),
        F.min("ord").alias("ord"),
    )
    out = folded.join(united_labels(records), "address", "left").join(united_extras(records), "address", "left")
    return out.select(
        "address", "own.chain", F.coalesce("labels", F.array().cast(f"array<{LABEL}>")).alias("labels"), *FLAGS, *SCALARS, "own.last_verified",
        F.coalesce("extras", F.create_map().cast("map<string,string>")).alias("extras"), "n_records", "ord",
    )


def add_spellbook(store: DataFrame, found: DataFrame) -> DataFrame:
    """store with the labels of found (address, chain, entity_name, distinct_name, ord): appended to an
    address that is there, or as a new record. Repeated labels stay; all take the chain of the
    address's first row; only appended ones carry the distinct name."""
    first = F.first("chain").over(Window.partitionBy("address").orderBy("ord"))
    suffix = F.when((F.col("distinct_name") != "") & (F.col("distinct_name") != F.col("entity_name")), F.concat(F.lit(" "), F.col("distinct_name"))).otherwise(F.lit(""))

    def label(name: Column) -> Column:
        return F.struct(
            name.alias("name"), F.lit("exchange").alias("type"), F.lit("dune_spellbook").alias("source"), F.col("chain"),
            F.replace(F.lower("entity_name"), F.lit(" "), F.lit("_")).alias("subtype"), F.lit(None).cast("string").alias("chain_evidence"), F.lit(None).alias("context"),
        ).cast(LABEL)

    rows = found.withColumn("chain", first)
    listed = lambda value: F.transform(F.array_sort(F.collect_list(F.struct("ord", value.alias("label")))), lambda x: x["label"])
    grouped = rows.groupBy("address").agg(F.first("chain").alias("new_chain"), listed(label(F.concat("entity_name", suffix))).alias("appended"), listed(label(F.col("entity_name"))).alias("fresh"))
    both = store.withColumn("__old", F.lit(True)).join(grouped, "address", "full")
    empty = F.array().cast(f"array<{LABEL}>")
    return both.withColumns(
        {
            "labels": F.when(F.col("__old"), F.concat(F.coalesce("labels", empty), F.coalesce("appended", empty))).otherwise(F.col("fresh")),
            "is_exchange": F.coalesce("is_exchange", F.lit(False)) | F.col("new_chain").isNotNull(),
            "chain": F.coalesce("chain", "new_chain"),
            "is_ai_agent": F.coalesce("is_ai_agent", F.lit(False)),
            "is_illicit": F.coalesce("is_illicit", F.lit(False)),
        }
    ).drop("__old", "new_chain", "appended", "fresh")
