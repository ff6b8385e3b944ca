"""The mixer registry: three ordered sources folded by address, its checks, and the delta against bridges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedupe import in_order, sample

# Feature types with their chains, chain numbers, sentinels and privacy words.
FEATURE_CHAINS = {
    "344": "btc", "345": "eth", "444": "xmr", "566": "ltc", "686": "zec", "687": "dash", "688": "btg", "689": "etc", "706": "bsv", "726": "bch", "746": "xvg", "887": "usdt",
    "907": "xrp", "992": "tron", "998": "usdc", "1007": "arbitrum", "1008": "bsc", "1167": "sol",
}
CHAIN_IDS = {1: "eth", 56: "bsc", 137: "polygon", 42161: "arbitrum"}
SEMENOV_SENTINEL = "0xdcbeffbecce100cce9e4b153c4e15cb885643193"
SINBAD_SENTINELS = ("1JHdQHkBZiim1cb4hyUh2PbzEbbg6z2TrF", "bc1qq7p0es3dv5hcynjjf40f2xjjr6qp5py47d2f6n847vduuq9gvnyq7y9ecd")
PRIVACY = "privacy|mixer|tumbler|shielded|anonym"
SOURCE = "struct<kind:string,fixedref:string,feature_id:string,feature_type_id:string,idx:int,label:string,name_tag:string,raw:string>"
PENDING = "PENDING: to be derived from first-party or on-chain evidence; the lead columns are a classification by others and no label"


def hex_lower(address: Column) -> Column:
    return F.when(F.startswith(F.lower(address), F.lit("0x")), F.lower(address)).otherwise(address)


def is_dprk3(programs: Column) -> Column:
    return F.exists(programs, lambda p: F.upper(p) == "DPRK3")


def sinbad(features: DataFrame) -> DataFrame:
    """Features of the party of that name or alias."""
    return features.where(F.lower("party_primary_name").rlike(r"\bsinbad\b") | F.lower(F.array_join("party_all_aliases", " ; ")).rlike(r"\bsinbad\b"))


def semenov(features: DataFrame) -> DataFrame:
    return features.where(F.contains(F.lower("party_primary_name"), F.lit("semenov")))


def tornado(records: DataFrame) -> DataFrame:
    """Records (with idx) whose names say tornado."""
    return records.where(F.lower(F.concat_ws(" ", "label", "nameTag", "name", "category")).contains("tornado"))


def _from_features(rows: DataFrame, step: int, family: str, operator: str) -> DataFrame:
    address = F.when(F.col("chain") == "eth", hex_lower(F.col("address_raw"))).otherwise(F.col("address_raw"))
    source = F.struct(F.lit("ofac_sdn").alias("kind"), F.col("party_uid").alias("fixedref"), F.col("feature_id"), F.col("feature_type_id"), F.lit(None).cast("int").alias("idx"), F.lit(None).cast("string").alias("label"), F.lit(None).cast("string").alias("name_tag"), F.col("address_raw").alias("raw"))
    return rows.select(address.alias("address"), "chain", F.lit(family).alias("family"), F.col("party_programs").alias("programs"), F.concat("party_uid", F.lit(f":{operator}")).alias("operator"), source.cast(SOURCE).alias("source"), F.struct(F.lit(step).alias("step"), F.col("ord").cast("long").alias("pos")).alias("ord"))


def _from_records(rows: DataFrame, step: int) -> DataFrame:
    raw = F.trim(F.coalesce(F.col("address"), F.lit("")))
    chain = F.coalesce(*[F.when(F.col("chainId") == i, c) for i, c in CHAIN_IDS.items()], F.lit("eth"))
    none = F.lit(None).cast("string")
    source = F.struct(F.lit("dawsbot").alias("kind"), none.alias("fixedref"), none.alias("feature_id"), none.alias("feature_type_id"), F.col("idx").cast("int"), F.col("label"), F.col("nameTag").alias("name_tag"), raw.alias("raw"))
    return rows.select(hex_lower(raw).alias("address"), chain.alias("chain"), F.lit("tornado_cash").alias("family"), F.array().cast("array<string>").alias("programs"), none.alias("operator"), source.cast(SOURCE).alias("source"), F.struct(F.lit(step).alias("step"), F.col("idx").cast("long").alias("pos")).alias("ord")).where("address != ''")


def fold(entries: DataFrame) -> DataFrame:
    """Entries (address, chain, family, programs, operator, source, ord) as one row for each address: the
    first entry's chain and family, programs in order of appearance, the first operator, all sources."""
    return entries.groupBy("address").agg(
        F.min_by(F.struct("chain", "family"), "ord").alias("own"),
        F.array_distinct(F.flatten(in_order(["ord"], F.col("programs")))).alias("entity_program_tags"),
        F.min_by("operator", F.when(F.col("operator").isNotNull(), F.col("ord"))).alias("operator_party"),
        in_order(["ord"], F.col("source")).alias("sources"),
        F.min("ord").alias("ord"),
    ).select("address", "own.chain", "own.family", "entity_program_tags", "operator_party", "sources", F.lit(None).cast("string").alias("first_seen_utc"), "ord")


def registry(features: DataFrame, records: DataFrame) -> DataFrame:
    """The registry from OFAC features (ord) and label records (idx)."""
    return fold(
        _from_features(sinbad(features), 0, "sinbad", "Sinbad")
        .unionByName(_from_records(tornado(records), 1))
        .unionByName(_from_features(semenov(features), 2, "tornado_cash", "Semenov_Roman"))
    )


def as_written(rows: DataFrame) -> DataFrame:
    """The registry as its file has it: sources as JSON."""
    return rows.withColumn("sources", F.to_json("sources")).drop("ord")


def dprk3_parties(features: DataFrame) -> DataFrame:
    """Parties of the program with their addresses and their number, most first."""
    address = F.when(F.col("chain") == "eth", hex_lower(F.col("address_raw"))).otherwise(F.col("address_raw"))
    rows = features.where(is_dprk3(F.col("party_programs")))
    out = rows.groupBy("party_uid").agg(F.min_by("party_primary_name", "ord").alias("name"), in_order(["ord"], F.struct(address.alias("address"), "chain", "feature_id")).alias("addresses"), F.min("ord").alias("first"))
    return out.withColumn("addr_count", F.size("addresses")).orderBy(F.desc("addr_count"), "first")


def canary(rows: DataFrame, features: DataFrame, records: DataFrame, n: int = 10) -> DataFrame:
    """A seeded sample of the registry with whether its first source still says the address."""
    chosen = sample(rows.select("address", F.get("sources", F.lit(0)).alias("s")), "address", n)
    f = features.select(F.col("party_uid").alias("fixedref"), "feature_id", F.when(F.col("chain") == "eth", hex_lower(F.col("address_raw"))).otherwise(F.col("address_raw")).alias("f_address"))
    r = records.select(F.col("idx").cast("int").alias("idx"), hex_lower(F.col("address")).alias("r_address"))
    found = chosen.select("address", "s.*").join(f, ["fixedref", "feature_id"], "left").join(r, "idx", "left")
    return found.select("address", "kind", F.coalesce(F.coalesce("f_address", "r_address") == F.col("address"), F.lit(False)).alias("verified"))


def is_privacy() -> Column:
    return F.lower(F.concat_ws(" ", "project_kind", "project_declared_type", "bridge")).rlike(PRIVACY)


def delta(excluded: DataFrame, registry_rows: DataFrame) -> DataFrame:
    """Privacy escrows as candidates of the registry, with whether it has them; attribution stays pending."""
    address = F.lower(F.coalesce("escrow_address", "escrow_address_raw"))
    known = registry_rows.select(F.lower("address").alias("address")).distinct().withColumn("known", F.lit(True))
    rows = excluded.where(is_privacy()).withColumn("address", address).where("address != ''").join(known, "address", "left")
    return rows.select(
        "address", "chain", F.col("bridge").alias("lead_project"), F.col("project_kind").alias("lead_kind"), F.col("project_declared_type").alias("lead_declared_type"), F.col("source_repo").alias("lead_source_repo"),
        F.col("source_commit").alias("lead_source_commit"), F.coalesce("known", F.lit(False)).alias("already_in_mixer_registry"), F.lit(None).cast("string").alias("attribution"), F.lit(PENDING).alias("attribution_basis"),
    )
