"""Probe of mixer families in several sources: a grid of cells, and what each family's cells decide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Words of each family, what must stand beside some, and the shapes of addresses.
FAMILIES = {"tornado_cash": r"tornado.?cash", "sinbad": r"\bsinbad\b", "samourai": r"\bsamourai\b", "chipmixer": r"chip.?mixer", "wasabi": r"\bwasabi\b", "helix": r"\bhelix\b|bitcoin.?fog"}
BESIDE = {"samourai": r"whirlpool|\bwallet\b|bitcoin|crypto|mixer|\bbtc\b", "helix": r"\bmix(?:er|ing)\b|bitcoin.?fog|\bdarknet\b|laundering"}
EVM = r"\b0x[a-fA-F0-9]{40}\b"
BTC = r"\b(?:bc1[a-z0-9]{25,90}|[13][a-km-zA-HJ-NP-Z1-9]{25,34})\b"
CONTROL = 10


def addresses(text: Column) -> Column:
    """Distinct EVM (lower case) and Bitcoin addresses of a text."""
    return F.array_union(F.transform(F.regexp_extract_all(text, F.lit(EVM), F.lit(0)), lambda a: F.lower(a)), F.regexp_extract_all(text, F.lit(BTC), F.lit(0)))


def families_of(text: Column, families: dict[str, str] | None = None, beside: dict[str, str] | None = None) -> Column:
    """The families that a text names, with what must stand beside."""
    low = F.lower(F.coalesce(text, F.lit("")))
    own, also = families or FAMILIES, BESIDE if beside is None else beside
    return F.array_compact(F.array(*[F.when(low.rlike(p) & (low.rlike(also[f]) if f in also else F.lit(True)), F.lit(f)) for f, p in own.items()]))


def _smallest(values: DataFrame, n: int, name: str) -> DataFrame:
    """The n smallest distinct values v of each family: every task keeps n before they meet."""
    place = F.row_number().over(Window.partitionBy("family").orderBy("v"))
    return values.withColumn("place", place).where(F.col("place") <= n).groupBy("family").agg(F.sort_array(F.collect_list("v")).alias(name))


def cells(rows: DataFrame, source: str, families: dict[str, str] | None = None, beside: dict[str, str] | None = None) -> DataFrame:
    """The source's cell of every family from rows (text, name, found: array of addresses): families are
    told row by row, so each row is read once and families without a match still get a cell."""
    own = families or FAMILIES
    each = rows.select(F.explode(families_of(F.col("text"), own, beside)).alias("family"), "name", "found")
    named = each.groupBy("family").agg(F.count("*").alias("named_match_count"))
    address = each.select("family", F.explode("found").alias("v")).distinct()
    counts = address.groupBy("family").agg(F.count("v").alias("n_addresses"))
    names = each.select("family", F.nullif(F.substring("name", 1, 80), F.lit("")).alias("v")).where("v is not null").distinct()
    counted = named.join(counts, "family", "left").join(_smallest(address, 5, "all"), "family", "left").join(_smallest(names, 3, "sample_names"), "family", "left")
    grid = rows.sparkSession.createDataFrame([(f,) for f in own], "family string")
    return grid.join(counted, "family", "left").select(
        "family", F.lit(source).alias("source"), F.coalesce("n_addresses", F.lit(0)).cast("int").alias("distinct_addresses"), F.coalesce("named_match_count", F.lit(0)).alias("named_match_count"),
        F.coalesce("all", F.array().cast("array<string>")).alias("sample_addresses"), F.coalesce("sample_names", F.array().cast("array<string>")).alias("sample_names"),
    )


def control(parties: DataFrame) -> DataFrame:
    """One row: DPRK3 parties with addresses, their addresses, and whether these reach CONTROL.
    parties: programs and id_values, each joined by "; "."""
    own = F.filter(F.split("id_values", "; "), lambda v: v != "")
    rows = parties.where(F.array_contains(F.split("programs", "; "), "DPRK3")).select(F.size(own).alias("n")).where("n > 0")
    return rows.agg(F.count("*").alias("parties"), F.coalesce(F.sum("n"), F.lit(0)).alias("addresses")).withColumn("passed", F.col("addresses") >= CONTROL)


def decide(grid: DataFrame, passed: bool, secondary_ok: bool, primary: str = "ofac_sdn") -> DataFrame:
    """family and decision from all cells."""
    first = F.col("source") == primary
    rows = grid.groupBy("family").agg(
        F.sum(F.when(first, F.col("distinct_addresses")).otherwise(0)).alias("own"), F.sum(F.when(first, F.col("named_match_count")).otherwise(0)).alias("named"), F.sum(F.when(~first, F.col("distinct_addresses")).otherwise(0)).alias("others")
    )
    decision = (
        F.when(F.lit(not passed), "ABSTAIN")
        .when(F.col("own") >= 1, "INCLUDE")
        .when(F.col("named") >= 1, "BUG_FLAG")
        .when(F.col("others") >= 1, "INCLUDE marginal")
        .when(F.lit(not secondary_ok), "BUG_FLAG")
        .otherwise("CEILING")
    )
    return rows.select("family", decision.alias("decision"), F.col("own").alias("primary_addresses"), F.col("named").alias("primary_named"), F.col("others").alias("other_addresses"))
