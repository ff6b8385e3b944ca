"""Chain names as columns: one spelling per chain, and the two vocabularies that are keyed by them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of the label store, and the chains that it may carry.
STORE_ALIASES = {
    "eth": "ethereum", "trx": "tron", "btc": "bitcoin", "arb": "arbitrum", "arb1": "arbitrum", "op": "optimism", "gno": "gnosis", "xdai": "gnosis",
    "gnosis chain": "gnosis", "matic": "polygon", "avax": "avalanche_c", "avalanche": "avalanche_c", "bnb chain": "bsc", "bnb smart chain": "bsc",
    "binance": "bsc", "etc": "ethereum_classic", "ltc": "litecoin", "xmr": "monero", "sol": "solana", "doge": "dogecoin", "ripple": "xrp",
    "bnb beacon chain": "bnb_beacon", "beacon": "bnb_beacon",
}
EVM_CHAINS = (
    "ethereum ethereum_classic bsc polygon avalanche_c arbitrum optimism base fantom cronos harmony heco okex gnosis celo moonbeam moonriver aurora evm"
).split()
OTHER_CHAINS = "bitcoin bitcoin_cash bitcoin_sv bitcoin_gold litecoin dogecoin verge dash zcash monero tron solana xrp bnb_beacon multi".split()
STORE_CHAINS = EVM_CHAINS + OTHER_CHAINS
# Spellings of the label set, whose names are shorter, and its included chains.
SET_ALIASES = {"ethereum": "eth", "eth": "eth", "xdai": "gnosis", "gnosis": "gnosis", "arbitrum": "arbitrum", "arb": "arbitrum", "base": "base", "tron": "tron", "trx": "tron", "btc": "btc", "bitcoin": "btc"}
SET_INCLUDED = ("eth", "tron", "base", "arbitrum", "gnosis")


#: Every character that counts as white space.
WHITE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def strip(text: Column) -> Column:
    """Text without white space at either end."""
    return F.btrim(text, F.lit(WHITE))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lookup(key: Column, table: dict[str, str]) -> Column:
    """The value of a small constant table, or null."""
    pairs = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.try_element_at(pairs, key)


def _folded(name: Column) -> Column:
    return F.lower(strip(F.coalesce(name, F.lit(""))))


def normalize_chain(name: Column) -> Column:
    """Store spelling of a chain; unknown spellings pass through in lower case, null is empty."""
    return let(_folded(name), lambda n: F.coalesce(lookup(n, STORE_ALIASES), n))


def is_canonical_chain(name: Column) -> Column:
    return F.coalesce(name, F.lit("")).isin(STORE_CHAINS)


def resolve_bnb(chain: Column, address: Column) -> Column:
    """A bare bnb is the smart chain for 0x addresses and the beacon chain for others."""
    hexed = F.startswith(_folded(address), F.lit("0x"))
    return F.when(chain != "bnb", chain).when(chain == "bnb", F.when(hexed, "bsc").otherwise("bnb_beacon"))


def store_chain(name: Column, address: Column) -> Column:
    return let(normalize_chain(name), lambda chain: resolve_bnb(chain, address))


def set_chain(name: Column) -> Column:
    """Label-set spelling of a chain."""
    return let(_folded(name), lambda n: F.coalesce(lookup(n, SET_ALIASES), n))
