"""Tag packs: one tag for each (address, currency, label, source) of the store's labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import base58
from ..functions.chains import lookup, strip
from .gates import GateFailure

REPOSITORY = "https://example.org/labels"  # the address that curated lists cite; a deployment sets its own
# Public sources with their addresses, levels of confidence, actors, currencies and categories.
SOURCES = {
    "ofac": "https://www.treasury.gov/ofac/downloads/sdn.csv", "ofac_sdn": "https://www.treasury.gov/ofac/downloads/sdn.csv",
    "ofac_press_release": "https://home.treasury.gov/policy-issues/financial-sanctions/recent-actions", "opensanctions": "https://data.opensanctions.org/datasets/",
    "walletexplorer": "https://www.walletexplorer.com/", "dawsbot_eth_labels": "https://github.com/dawsbot/eth-labels", "dawsbot_tokens": "https://github.com/dawsbot/eth-labels",
    "virtuals": "https://api.virtuals.io/api/virtuals", "virtuals_bridge": "https://api.virtuals.io/api/virtuals", "crypto_rekts": "https://rekt.news/",
    "tronscan_public": "https://apilist.tronscanapi.com", "flashbots": "https://github.com/flashbots/mev-inspect-py", "mev_inspect": "https://github.com/flashbots/mev-inspect-py",
    "tornado_interactors": "https://github.com/tornadocash",
}
CURATED = ("known_exchanges", "known_mixers", "ethereum_agents_curated")
CONFIDENCE = {"ofac": "authority_data", "ofac_sdn": "authority_data", "ofac_press_release": "authority_data"}
FLOOR = "unknown"
LEVELS = (
    "override ownership ledger_immanent manual_transaction service_api forensic_investigation authority_data trusted_provider service_data forensic "
    "untrusted_transaction web_crawl heuristic unknown"
).split()
ACTORS = {"HYDRA MARKET": "hydramarket", "BLENDER.IO": "blenderio", "GARANTEX EUROPE OU": "garantex", "CHATEX": "chatex", "LAZARUS GROUP": "lazarusgroup", "SINBAD": "sinbadio"}
EXCLUDED = ("opensanctions", "dune_spellbook")
CURRENCIES = {"bitcoin": "BTC", "ethereum": "ETH", "tron": "TRX", "litecoin": "LTC", "arbitrum": "ETH", "base": "ETH", "optimism": "ETH"}
CATEGORIES = {"exchange": "exchange", "sanctioned": "sanction", "rugpull": "scam", "honeypot": "scam", "phishing": "phishing"}
OWN_CURRENCY = ("bitcoin", "ethereum", "tron", "litecoin")


def screen(store: DataFrame, allow_unsourced: bool = False, excluded: tuple[str, ...] = EXCLUDED, repository: str = REPOSITORY) -> DataFrame:
    """One row for each label of the store (which has ord) with its tag's columns and skip_reason:
    chain, licence, unsourced, or null."""
    sources = SOURCES | dict.fromkeys(CURATED, repository)
    rows = store.select("ord", "address", F.col("chain").alias("own"), F.posexplode("labels").alias("pos", "label"))
    chain = F.coalesce(F.nullif("label.chain", F.lit("")), F.col("own"), F.lit(""))
    source = F.coalesce("label.source", F.lit(""))
    rows = rows.select("ord", "pos", "address", "label", chain.alias("chain"), source.alias("source_name"), lookup(chain, CURRENCIES).alias("currency"), lookup(source, sources).alias("uri"))
    reason = F.when(F.col("currency").isNull(), "chain").when(F.col("source_name").isin(*excluded) if excluded else F.lit(False), "licence").when(F.col("uri").isNull() & F.lit(not allow_unsourced), "unsourced")
    name = F.coalesce(F.nullif(strip(F.col("label.name")), F.lit("")), F.nullif(strip(F.col("label.type")), F.lit("")), F.lit("unknown"))
    hexed = (F.col("chain") == "tron") & F.col("address").rlike(r"^0x.{40}\z")
    return rows.select(
        "ord", "pos", "chain", "source_name", "currency", reason.alias("skip_reason"), F.when(hexed, base58.hex_to_tron(F.col("address"))).otherwise(F.col("address")).alias("address"),
        name.alias("label"), F.coalesce("uri", F.concat(F.lit("unverified:"), F.col("source_name"))).alias("source"), lookup(F.col("label.type"), CATEGORIES).alias("category"),
        F.coalesce(lookup(F.col("source_name"), CONFIDENCE), F.lit(FLOOR)).alias("confidence"), lookup(name, ACTORS).alias("actor"),
    )


def context(chains: Column) -> Column:
    """JSON of a tag's chains where its currency doesn't tell them."""
    one = F.element_at(chains, 1)
    return F.when(F.size(chains) > 1, F.concat(F.lit('{"chains": ["'), F.array_join(chains, '", "'), F.lit('"]}'))).when(~one.isin(*OWN_CURRENCY), F.concat(F.lit('{"evm_chain": "'), one, F.lit('"}')))


def tags(screened: DataFrame) -> DataFrame:
    """The tags of the rows without a skip_reason; the first row of a tag decides its other columns."""
    place = F.struct("ord", "pos")
    out = (
        screened.where("skip_reason is null")
        .groupBy("address", "currency", "label", "source")
        .agg(F.min_by(F.struct("category", "confidence", "actor"), place).alias("own"), F.array_sort(F.collect_set("chain")).alias("chains"), F.min(place).alias("place"))
    )
    return out.select("address", "currency", "label", "source", "own.category", "own.confidence", "own.actor", context(F.col("chains")).alias("context"), "place")


def header_confidence(pack: DataFrame) -> str | None:
    """The level that all tags share, or None: then each keeps its own."""
    found = [r[0] for r in pack.select("confidence").distinct().limit(2).collect()]
    return found[0] if len(found) == 1 else None


def errors(pack: DataFrame, header: str | None = None) -> DataFrame:
    """The tags with what is wrong with each as an array; an empty array passes."""
    blank = lambda c: F.coalesce(strip(F.col(c).cast("string")), F.lit("")) == ""
    missing = F.coalesce(*[F.when(blank(c), F.lit(f"missing/blank {c}")) for c in ("address", "currency", "label", "source")])
    level = F.coalesce("confidence", F.lit(header))
    tron = base58.is_tron(F.col("address"))
    trx = F.coalesce(F.col("currency") == "TRX", F.lit(False))
    found = F.array(
        missing,
        F.when(level.isNull(), "no confidence").when(~level.isin(LEVELS), "confidence outside the taxonomy"),
        F.when(tron & ~trx, "Tron address under another currency").when(trx & F.startswith("address", F.lit("0x")), "TRX address in 0x-hex"),
    )
    return pack.withColumn("errors", F.array_compact(found))


def validate(pack: DataFrame, header: dict) -> list[str]:
    """Up to twenty things that are wrong with a pack."""
    out = [f"missing header field: {f}" for f in ("title", "creator", "lastmod") if f not in header]
    level = header.get("confidence")
    out += [f"header confidence {level!r} not in the taxonomy"] if level is not None and level not in LEVELS else []
    if pack.isEmpty():
        out.append("tags must be a non-empty list")
    out += [f"{r.address}: {e}" for r in errors(pack, level).where("size(errors) > 0").limit(20).collect() for e in r.errors]
    return out[:20]


def check_floor(pack: DataFrame, least: int) -> int:
    n = pack.count()
    if n < least:
        raise GateFailure(f"only {n} tags, the floor is {least}")
    return n
