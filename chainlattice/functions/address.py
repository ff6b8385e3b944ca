"""Addresses as columns: case policy, storage keys, and chains told by form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import base58
from .chains import let, lookup, strip

# Fixed values.
CASE_SENSITIVE = "btc bitcoin ltc litecoin doge dogecoin dash bch bitcoincash xrp ripple sol solana xmr monero zec zcash tron trx".split()
TICKERS = {
    "XBT": "bitcoin", "BTC": "bitcoin", "BCH": "bitcoin_cash", "BSV": "bitcoin_sv", "BTG": "bitcoin_gold", "ETH": "ethereum", "ETC": "ethereum_classic", "TRX": "tron",
    "XMR": "monero", "LTC": "litecoin", "DOGE": "dogecoin", "XRP": "xrp", "ZEC": "zcash", "DASH": "dash", "XVG": "verge", "SOL": "solana", "BNB": "bnb_beacon",
    "ARB": "arbitrum", "BASE": "base", "BSC": "bsc",
}
TOKENS = ("USDT", "USDC")
EVM = r"^0x[0-9a-fA-F]{40}\z"
TOKEN = r"^[A-Za-z0-9:]{20,120}\z"
BASE58 = r"^[1-9A-HJ-NP-Za-km-z]+\z"


def is_evm(address: Column) -> Column:
    return address.rlike(EVM)


def is_bech32(address: Column) -> Column:
    return F.lower(address).rlike("^(?:bc1|tb1|ltc1)")


def canonical_case(address: Column) -> Column:
    """Lower case where case means nothing (EVM, bech32 in one case); otherwise untouched but for white space."""

    def cased(a: Column) -> Column:
        one_case = (a == F.lower(a)) | (a == F.upper(a))
        return F.when(is_evm(a) | (is_bech32(a) & one_case), F.lower(a)).otherwise(a)

    return let(strip(address), cased)


def _judged(address: Column, chain: Column | None) -> Column:
    form = ~is_evm(address) & ~is_bech32(address)
    return form if chain is None else form & (chain.isNull() | F.lower(strip(chain)).isin(CASE_SENSITIVE))


def is_case_sensitive_form(address: Column, chain: Column | None = None) -> Column:
    """Whether lower-casing would destroy the address."""
    a = strip(address)
    return (a != "") & _judged(a, chain)


def is_case_destroyed(address: Column, chain: Column | None = None) -> Column:
    """Whether an address of a case-sensitive alphabet has letters, and none in upper case."""
    a = strip(address)
    return _judged(a, chain) & (a == F.lower(a)) & (F.lower(a) != F.upper(a))


def storage_key(address: Column, chain: Column) -> Column:
    """Key of the label store: Tron T forms as 0x-hex, everything else in canonical case."""
    tron = F.when((chain == "tron") & (F.char_length(address) == 34) & F.startswith(address, F.lit("T")), base58.tron_to_hex(address))
    return F.coalesce(tron, canonical_case(address))


def chain_by_form(address: Column) -> Column:
    """Chain that the form alone tells; the first rule that fits decides."""
    a = strip(address)
    size, first, b58 = F.char_length(a), F.substring(a, 1, 1), a.rlike(BASE58)
    rules = (
        (base58.is_tron(a), "tron"),
        (is_evm(a), "ethereum"),
        (base58.is_bitcoin_legacy(a) | F.startswith(F.lower(a), F.lit("bc1")), "bitcoin"),
        (F.startswith(F.lower(a), F.lit("ltc1")) | (first.isin("L", "M") & size.between(26, 35) & b58), "litecoin"),
        ((first == "r") & size.between(25, 35) & b58, "xrp"),
        (size.isin(95, 106) & first.isin("4", "8") & b58, "monero"),
        ((size == 34) & (first == "D") & b58, "dogecoin"),
        ((size == 35) & F.substring(a, 1, 2).isin("t1", "t3") & b58, "zcash"),
        ((size == 34) & (first == "X") & b58, "dash"),
        ((size == 34) & first.isin("G", "A") & b58, "bitcoin_gold"),
        (F.startswith(F.lower(a), F.lit("bnb1")) & (size == 42), "bnb_beacon"),
        (size.between(32, 44) & b58, "solana"),
    )
    out = F
    for test, chain in rules:
        out = out.when(test, chain)
    return out.otherwise("unknown")


def infer_chain(ticker: Column, address: Column) -> Column:
    """Chain of a published (ticker, address): a valid Tron form wins, token tickers go by form."""
    return F.when(base58.is_tron(address), "tron").when(ticker.isin(*TOKENS), chain_by_form(address)).otherwise(F.coalesce(lookup(ticker, TICKERS), F.lit("unknown")))
