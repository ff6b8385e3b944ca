"""The sanctions list: the CSV, and both XML forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.address import EVM, infer_chain
from ..functions.chains import strip
from ..operators.dedupe import first_wins
from ..operators.mixers import FEATURE_CHAINS
from ..schema import LABEL

_CSV = "sdn_id string, entity_name string, entity_type string, programs string, title string, call_sign string, vessel_type string, tonnage string, grt string, flag string, owner string, remarks string"
DIGITAL = r"Digital Currency Address\s*-\s*([A-Z]{2,8})\s+([A-Za-z0-9]{20,90})"


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """The CSV without a header; rows with fewer than twelve columns are left out."""
    return spark.read.schema(_CSV).option("quote", '"').option("escape", '"').csv(path).where("remarks is not null")


def addresses(rows: DataFrame) -> DataFrame:
    """One row for each digital currency address in the remarks, with its chain."""
    found = F.arrays_zip(F.regexp_extract_all("remarks", F.lit(DIGITAL), F.lit(1)).alias("ticker"), F.regexp_extract_all("remarks", F.lit(DIGITAL), F.lit(2)).alias("address"))
    bare = lambda c: F.regexp_replace(strip(F.col(c)), '^"+|"+\\z', "")
    each = rows.select(strip(F.col("sdn_id")).alias("sdn_id"), strip(F.col("entity_name")).alias("entity_name"), bare("entity_type").alias("entity_type"), bare("programs").alias("programs"), F.posexplode(found).alias("pos", "m"))
    raw = each.select("sdn_id", "entity_name", "entity_type", "programs", "pos", F.col("m.ticker").alias("ticker"), F.col("m.address").alias("raw"), infer_chain(F.col("m.ticker"), F.col("m.address")).alias("chain"))
    lower = F.col("chain").isin("ethereum", "bitcoin_cash", "arbitrum", "base") & F.col("raw").rlike(EVM)
    return raw.select("sdn_id", "entity_name", "entity_type", "programs", "ticker", F.when(lower, F.lower("raw")).otherwise(F.col("raw")).alias("address"), "chain", "pos")


def on_chain(rows: DataFrame, chain: str = "tron") -> DataFrame:
    return rows.where(F.col("chain") == chain)


def records(rows: DataFrame, day: str, url: str = "https://www.treasury.gov/ofac/downloads/sdn.csv") -> DataFrame:
    """Addresses of the list as raw records."""
    label = F.struct(F.col("entity_name").alias("name"), F.lit("sanctioned").alias("type"), F.lit("ofac_sdn").alias("source"), F.col("chain"), F.lit(None).cast("string").alias("subtype"), F.lit(None).cast("string").alias("chain_evidence"), F.lit(None).alias("context")).cast(LABEL)
    return rows.where("chain != 'unknown'").select(
        "address", "chain", F.array(label).alias("labels"), F.lit(True).alias("sanctioned"), F.lit(True).alias("is_illicit"), F.lit(False).alias("is_exchange"), F.lit(False).alias("is_ai_agent"),
        F.col("entity_name"), F.lit("sanctioned").alias("category"), F.concat(F.lit("SDN-"), "sdn_id").alias("sanctions_reference"), F.lit(url).alias("source_url"), F.lit(day).alias("source_date"),
    )


def _xml(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", tag).option("ignoreNamespace", "true").schema(schema).load(path)


def read_enhanced(spark: SparkSession, path: str) -> DataFrame:
    """The enhanced XML: one row for each crypto feature with its entity's name and sorted programs."""
    schema = (
        "_id string, names struct<name:array<struct<translations:struct<translation:array<struct<formattedFullName:string>>>>>>, "
        "sanctionsPrograms struct<sanctionsProgram:array<struct<_VALUE:string>>>, features struct<feature:array<struct<type:struct<_VALUE:string>,value:string>>>"
    )
    rows = _xml(spark, path, "entity", schema)
    name = F.get(F.flatten(F.transform("names.name", lambda n: F.transform(n["translations"]["translation"], lambda t: t["formattedFullName"]))), F.lit(0))
    programs = F.array_sort(F.array_distinct(F.transform("sanctionsPrograms.sanctionsProgram", lambda p: p["_VALUE"])))
    each = rows.select(F.col("_id").alias("entity_id"), name.alias("entity_name"), programs.alias("programs"), F.explode("features.feature").alias("f"))
    prefix = r"^Digital Currency Address - ([A-Z0-9]+)\z"
    return each.where(F.col("f.type._VALUE").rlike(prefix)).select("entity_id", "entity_name", "programs", F.regexp_extract("f.type._VALUE", prefix, 1).alias("currency"), F.trim("f.value").alias("address"))


def distinct_wallets(rows: DataFrame) -> DataFrame:
    """The first row of each address and currency, by entity."""
    return first_wins(rows, ["address", "currency"], ["entity_id", "entity_name"])


def wallet_records(rows: DataFrame, day: str) -> DataFrame:
    """Wallets of the enhanced list as raw records; those whose chain nothing tells are left out."""
    name = F.coalesce(F.nullif("entity_name", F.lit("")), F.concat(F.lit("OFAC SDN "), "entity_id"))
    named = rows.select("address", infer_chain(F.col("currency"), F.col("address")).alias("chain"), name.alias("entity_name"), F.col("entity_id").alias("sdn_id"))
    return records(named, day).withColumn("sanctions_reference", F.concat(F.lit("OFAC "), "sanctions_reference")).drop("source_url")


def read_advanced(spark: SparkSession, path: str) -> DataFrame:
    """The advanced XML: one row for each crypto feature of a party, with aliases and programs.

    Parties and programs are two scans of the file, joined by the party's profile."""
    name = "array<struct<DocumentedNamePart:array<struct<NamePartValue:struct<_VALUE:string>>>>>"
    party = (
        f"_FixedRef string, Profile struct<_ID:string,Identity:array<struct<Alias:array<struct<_Primary:boolean,DocumentedName:{name}>>>>,"
        "Feature:array<struct<_ID:string,_FeatureTypeID:string,FeatureVersion:array<struct<VersionDetail:array<struct<_VALUE:string>>>>>>>"
    )
    entry = "_ProfileID string, SanctionsMeasure array<struct<Comment:string>>"
    rows = _xml(spark, path, "DistinctParty", party)
    aliases = F.flatten(F.transform("Profile.Identity", lambda i: i["Alias"]))
    spelt = lambda a: F.array_join(F.transform(F.flatten(F.transform(a["DocumentedName"], lambda d: d["DocumentedNamePart"])), lambda p: p["NamePartValue"]["_VALUE"]), " ")
    primary = F.get(F.transform(F.filter(aliases, lambda a: a["_Primary"]), spelt), F.lit(0))
    each = rows.select(F.col("_FixedRef").alias("party_uid"), F.col("Profile._ID").alias("profile"), F.coalesce(primary, F.lit("")).alias("party_primary_name"), F.transform(aliases, spelt).alias("party_all_aliases"), F.posexplode("Profile.Feature").alias("pos", "f"))
    known = F.create_map(*[F.lit(x) for pair in FEATURE_CHAINS.items() for x in pair])
    value = F.get(F.flatten(F.transform("f.FeatureVersion", lambda v: F.transform(v["VersionDetail"], lambda d: d["_VALUE"]))), F.lit(0))
    features = each.select("party_uid", "profile", "party_primary_name", "party_all_aliases", "pos", F.col("f._FeatureTypeID").alias("feature_type_id"), F.col("f._ID").alias("feature_id"), F.try_element_at(known, F.col("f._FeatureTypeID")).alias("chain"), F.trim(value).alias("address_raw")).where("chain is not null and address_raw != ''")
    programs = _xml(spark, path, "SanctionsEntry", entry).select(F.col("_ProfileID").alias("profile"), F.filter(F.transform("SanctionsMeasure", lambda m: F.trim(m["Comment"])), lambda c: c != "").alias("party_programs"))
    last = programs.groupBy("profile").agg(F.max("party_programs").alias("party_programs"))
    out = features.join(last, "profile", "left").withColumn("party_programs", F.coalesce("party_programs", F.array().cast("array<string>")))
    return out.withColumn("ord", F.xxhash64("party_uid").bitwiseAND(0x7FFFFFFF) * 4096 + F.col("pos")).drop("profile", "pos")


def parties(features: DataFrame) -> DataFrame:
    """Party grain of the features: ids and programs joined by "; "."""
    return features.groupBy("party_uid").agg(F.first("party_primary_name").alias("name"), F.array_join(F.first("party_all_aliases"), "; ").alias("all_names"), F.array_join(F.first("party_programs"), "; ").alias("programs"), F.array_join(F.array_sort(F.collect_list("address_raw")), "; ").alias("id_values"))

