"""The directory of registered entities: records of all registers grouped under one id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.chains import strip
from ..functions.names import Rules, canonical_id
from .dedupe import first_wins

# The registers in their order with the jurisdictions they cover, and the EU and EEA.
EEA = "AT BE BG HR CY CZ DK EE FI FR DE GR HU IE IT LV LT LU MT NL PL PT RO SK SI ES SE NO IS LI".split()
REGISTERS = {"esma": EEA, "fca": ["GB"], "nydfs": ["US-NY"], "mas": ["SG"], "fincen": ["US"], "hk_sfc": ["HK"], "jp_jfsa": ["JP"], "ch_finma": ["CH"], "uae_vara": ["AE-DU"]}
DATE_KEYS = ("_esma_authorisation_date", "_fca_mlr_effective_date", "_nydfs_license_date", "_fincen_auth_date", "_hk_amlo_effective_date", "_jp_registration_date_iso", "_vara_licence_issued")


def surrogate_licence(name: Column, jurisdiction: Column, regulator: Column, url: Column) -> Column:
    """A stable licence id for registers that print none, or null."""
    slug = F.regexp_replace(F.regexp_replace(strip(F.lower(F.coalesce(name, F.lit("")))), r"(?U)[^\w]+", "_"), r"^_+|_+\z", "")
    jur, reg = F.upper(F.coalesce(jurisdiction, F.lit(""))), F.coalesce(regulator, F.lit(""))
    prefix = (
        F.when((jur == "US-NY") | reg.rlike("NY DFS|Department of Financial Services"), "nydfs")
        .when((jur == "US") & F.contains(reg, F.lit("FinCEN")), "fincen")
        .when(F.startswith(F.coalesce(url, F.lit("")), F.lit("https://www.esma.europa.eu")) | reg.rlike("ESMA|MiCA|CASP"), F.concat(F.lit("esma_"), F.when(jur == "", "EU").otherwise(jur)))
    )
    return F.when(slug != "", F.concat(prefix, F.lit("::"), slug))


def licence() -> Column:
    """The licence that a record of a register stands for."""
    given = F.nullif(F.col("license_id"), F.lit(""))
    made = F.coalesce(given, surrogate_licence(F.col("entity_name"), F.col("jurisdiction"), F.col("regulator"), F.col("source_url")))
    date = F.coalesce(*[F.nullif(F.try_element_at("extras", F.lit(k)), F.lit("")) for k in DATE_KEYS])
    return F.struct(
        F.col("jurisdiction"), made.alias("license_id"), (F.col("license_id").isNull() & made.isNotNull()).alias("license_id_is_surrogate"), F.col("regulator"), F.col("license_status"),
        date.alias("license_date"), F.when(F.substring("jurisdiction", 1, 2).isin(EEA), True).alias("casp_registered"), F.col("source_url"),
    )


def identify(records: DataFrame, aliases: Rules, exact: dict[str, str], pinned: dict[str, str]) -> DataFrame:
    """records with canonical_id. Names are resolved once each: the rules run on distinct (name, lei)."""
    lei = F.try_element_at("extras", F.lit("_esma_lei"))
    keyed = records.withColumns({"lei": lei, "__name": F.coalesce("entity_name", F.lit("")), "__lei": F.coalesce(lei, F.lit(""))})
    ids = keyed.select("__name", "__lei").distinct().withColumn("__id", canonical_id(F.col("__name"), F.col("__lei"), F.lit(None).cast("string"), aliases, exact, pinned))
    found = F.when(F.col("__id") == "raw::unknown", F.concat(F.lit("raw::"), F.coalesce("address", F.lit("unknown")))).otherwise(F.col("__id"))
    return keyed.join(ids, ["__name", "__lei"]).withColumn("canonical_id", found).drop("__name", "__lei", "__id")


def primary_name(rows: DataFrame, key: str, name: str, order: str) -> DataFrame:
    """key and its longest name; of equally long ones the most frequent, then the first."""
    each = rows.groupBy(key, name).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return first_wins(each, [key], [F.desc(F.char_length(name)), F.desc("n"), "first"]).select(key, F.col(name).alias("name"))


def distinct_licences(rows: DataFrame, order: str) -> DataFrame:
    """The first licence of each entity, jurisdiction and regulator (white space collapsed)."""
    regulator = F.regexp_replace(strip(F.col("licence.regulator")), r"(?U)\s+", " ")
    return first_wins(rows.withColumns({"__jur": F.col("licence.jurisdiction"), "__reg": regulator}), ["canonical_id", "__jur", "__reg"], [order]).drop("__jur", "__reg")


def build(records: DataFrame, primary: dict[str, str] | None = None) -> DataFrame:
    """The directory from identified records with register and ord: one row for each entity, with rank
    (most jurisdictions, then most licences, then name)."""
    rows = records.withColumns({"licence": licence(), "entity_name": F.coalesce("entity_name", F.lit(""))})
    names = primary_name(rows, "canonical_id", "entity_name", "ord")
    licences = (
        distinct_licences(rows, "ord")
        .groupBy("canonical_id")
        .agg(
            F.array_sort(F.array_compact(F.collect_set(F.nullif("licence.jurisdiction", F.lit(""))))).alias("jurisdictions"),
            F.count("*").alias("n_licenses"),
            F.transform(F.array_sort(F.collect_list(F.struct("ord", "licence"))), lambda x: x["licence"]).alias("licenses"),
        )
    )
    rest = rows.groupBy("canonical_id").agg(
        F.array_sort(F.collect_set("register")).alias("source_tags"),
        F.array_sort(F.collect_set(F.nullif("lei", F.lit("")))).alias("leis"),
        F.transform(F.array_sort(F.collect_list(F.struct("ord", F.coalesce("address", F.lit("")).alias("a")))), lambda x: x["a"]).alias("raw_addresses"),
        F.array_sort(F.collect_set("entity_name")).alias("raw_names"),
        F.min("ord").alias("first"),
    )
    out = names.join(licences, "canonical_id").join(rest, "canonical_id").withColumn("n_jurisdictions", F.size("jurisdictions"))
    for cid, name in (primary or {}).items():
        out = out.withColumn("name", F.when(F.col("canonical_id") == cid, name).otherwise(F.col("name")))
    return out


def ranked(directory: DataFrame) -> DataFrame:
    """The directory in its order of output."""
    return directory.orderBy(F.desc("n_jurisdictions"), F.desc("n_licenses"), F.lower("name"), "first")


def lei_conflicts(directory: DataFrame) -> DataFrame:
    """Alias entities that unite two LEIs or more."""
    return directory.where(F.startswith("canonical_id", F.lit("alias::")) & (F.size("leis") >= 2)).select("canonical_id", "name", "leis", "raw_names", "source_tags")


def by_jurisdiction(directory: DataFrame) -> DataFrame:
    return directory.select(F.explode("jurisdictions").alias("jurisdiction")).groupBy("jurisdiction").agg(F.count("*").alias("n_entities"))


def null_rates(rows: DataFrame, by: str, value: str) -> DataFrame:
    """Rows, nulls and per cent of nulls (one digit, half to even) of each group."""
    out = rows.groupBy(by).agg(F.count("*").alias("n"), F.count_if(F.col(value).isNull()).alias("n_null"))
    return out.withColumn("pct", F.bround(F.lit(100.0) * F.col("n_null") / F.col("n"), 1))


def carry_name(key: list[str], order: list[str], value: str) -> Column:
    """A cell that stands only in the first row of its block, carried down."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
