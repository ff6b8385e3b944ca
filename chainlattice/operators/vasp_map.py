"""Addresses of registered entities: exchange labels of the store joined with the directory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import Rules, label_brand, label_to_canonical


def label_index(store: DataFrame, aliases: Rules, exact: dict[str, str]) -> DataFrame:
    """address, chain, raw_label_names and canonical_id (null: unmapped) of every address with an exchange
    label. The first label that maps decides; names are mapped once each. Labels that map to nothing are told
    from others by min_by's order: a filter on the id would be pushed below the distinct names, to every row."""
    exchange = F.filter("labels", lambda x: F.lower(F.coalesce(x["type"], F.lit(""))) == "exchange")
    rows = store.select("address", F.coalesce("chain", F.lit("unknown")).alias("chain"), F.transform(exchange, lambda x: F.coalesce(x["name"], F.lit(""))).alias("raw_label_names")).where(F.size("raw_label_names") > 0)
    each = rows.select("address", F.posexplode("raw_label_names").alias("pos", "name"))
    ids = each.select("name").distinct().withColumn("canonical_id", label_to_canonical(F.col("name"), aliases, exact))
    mapped = F.when(F.col("canonical_id").isNotNull(), F.col("pos"))
    first = each.join(ids, "name").groupBy("address").agg(F.min_by("canonical_id", mapped).alias("canonical_id"))
    return rows.join(first, "address", "left")


def unmapped_brands(index: DataFrame, k: int = 40) -> DataFrame:
    """The most frequent brands of unmapped addresses' labels. Names are counted first, so each is cut to its brand once."""
    brand = label_brand(F.col("name"))
    each = index.where("canonical_id is null").select(F.explode("raw_label_names").alias("name")).groupBy("name").agg(F.count("*").alias("n"))
    brands = each.select(F.when(brand == "", "(empty)").otherwise(brand).alias("brand"), "n")
    return brands.groupBy("brand").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "brand").limit(k)


def build(directory: DataFrame, index: DataFrame) -> DataFrame:
    """One row for each entity and address."""
    entities = directory.select(F.col("canonical_id"), F.coalesce("name", F.lit("")).alias("vasp_canonical_name"), F.size("jurisdictions").alias("vasp_n_jurisdictions"), F.col("jurisdictions").alias("vasp_jurisdictions"))
    return index.where("canonical_id is not null").join(entities, "canonical_id").select(
        F.col("canonical_id").alias("vasp_canonical_id"), "vasp_canonical_name", "vasp_n_jurisdictions", "vasp_jurisdictions", "address", "chain",
        F.lit(1.0).alias("confidence"), F.lit("direct_label").alias("match_type"), "raw_label_names",
    )


def coverage(directory: DataFrame, index: DataFrame) -> DataFrame:
    """One row: records, entities in all and with addresses, and the same of those in two jurisdictions or more."""
    own = index.where("canonical_id is not null").groupBy("canonical_id").agg(F.count("*").alias("n"))
    rows = directory.select("canonical_id", (F.size("jurisdictions") >= 2).alias("multi")).join(own, "canonical_id", "left")
    some = F.col("n").isNotNull()
    return rows.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_records"), F.count_if(some).alias("entities_with_addresses"), F.count("*").alias("entities_total"),
        F.count_if("multi").alias("multi_total"), F.count_if(F.col("multi") & some).alias("multi_with_addresses"), F.count_if(F.col("multi") & ~some).alias("multi_without_addresses"),
    )
