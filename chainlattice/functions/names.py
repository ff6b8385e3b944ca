"""Entity names as columns: roots, normal forms, brands, junk, ids and slugs."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .chains import let, lookup, strip

# Fixed values.
TLDS = (".com", ".net", ".io", ".exchange", ".co")
ROLES = (" Hot Wallet", " Cold Wallet", " Cold Storage", " Hot Storage", " Deposit", " Settlement", " Trading", " Exchange", " Reserve", " Wallet")
LEGAL = (
    "ltd.", "ltd", "limited", "llc", "l.l.c.", "inc.", "inc", "incorporated", "corp.", "corp", "corporation", "co.", "co", "pte.", "pte", "pte ltd", "plc",
    "gmbh", "gmbh & co. kg", "ag", "s.a.", "sa", "s.l.", "sl", "n.a.", "na", "trust company", "trust co.", "trust", "bank", "bancorp", "holdings", "holding",
    "group", "international", "global", "(usa)", "(uk)", "(eu)", "(europe)", "europe", "ireland", "germany", "uk", "usa", "asia", "pty", "kk", "k.k.",
)
JUNK = (
    r"\bcapital\s+foundation\b", r"\bblockrock\s+ai\b", r"\bdecentralized\s+exchange\b", r"\bcrypto\s+capital\b", r"\b(?:crypto|blockchain)\s+investment\s+foundation\b",
    r"\bcoin[- ]pro\s+crypto\s+foundation\b", r"^(?:huobi|kucoin|bittrex|poloniex|bitmex|mexc|bitfinex)\s+foundation\b",
    r"\b(?:gemini)(?:fin|blu|moonbase|cloud|ex|fn)\b", r"\b(?:888)okx\b", r"\bokx(?:le|g|s|fn)\b", r"\baokx\b", r"\bgrokcoin\b", r"\bbitgoo\b", r"\bcrypto[-]gate\s+capital",
    r"^onramp\s+bitcoin", r"^block\s+chain\s+wallet", r"^tocgy\s+crypto\s+block", r"^(?:axpout|cuphax|rthae|cresia|fenrod)\s+crypto\s+finance", r"\bkakucoin\b", r"\bbinancex\b",
    r"\bcoinbasex\b", r"\bkrakenex\b", r"\bpaxosex\b", r"^bybit\s+currency\s+trading\b", r"\blexinova\b", r"^tiny\s+score\s+ripple\b", r"^tripple\s+s\b",
)
BRANDS = (
    "binance", "okx", "kraken", "coinbase", "gemini", "bitstamp", "crypto.com", "paxos", "circle", "bybit", "kucoin", "huobi", "bitfinex", "gate.io", "blackrock", "blockfi",
)
LABEL_ALIASES = (("gate.io", "gate_io"), ("gate.com", "gate_io"), ("circle internet", "circle"), ("paypal", "paypal"), ("blockchain.com", "blockchain_com"))

Rules = list[tuple[str, str]]


def _until_fixed(text: Column, some: str, cut: Callable[[Column], Column]) -> Column:
    """cut, repeated while something matches some. Each cut that changes a text takes one of its runs of word characters
    at least, so as many rounds as it has runs reach the fixpoint; texts without a match take one round, which keeps them."""
    runs = F.when(text.rlike(some), F.size(F.regexp_extract_all(text, F.lit(r"(?U)\w+"), F.lit(0))) + 1).otherwise(1)
    return F.aggregate(F.sequence(F.lit(1), runs), text, lambda s, _: F.when(s.rlike(some), cut(s)).otherwise(s))


def entity_root(name: Column) -> Column:
    """Name without numbers, one domain ending, role words and trailing marks: "Binance 14" is Binance."""
    plain = strip(F.regexp_replace(F.coalesce(name, F.lit("")), r"\s+#?[0-9]{1,4}\s*\z", ""))
    fits = F.coalesce(*[F.when(F.endswith(plain, F.lit(t)) & (F.char_length(plain) > len(t) + 1), F.lit(len(t))) for t in TLDS], F.lit(0))
    bare = F.substring(plain, F.lit(1), F.char_length(plain) - fits)
    roles = "(?:" + "|".join(map(re.escape, ROLES)) + r")\z"
    cut = _until_fixed(bare, roles, lambda s: strip(F.regexp_replace(s, roles, "")))
    return strip(F.regexp_replace(F.regexp_replace(cut, r":+\z", ""), r"-+\z", ""))


def _squeeze(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\s+", " ")


def _without_forms(text: Column) -> Column:
    """Text without legal forms at its end, which are tried in their order, again and again until none is left or
    nothing would stay. A form begins at a bound of a word. Only those that the text has somewhere are tried, as
    plain strings; each cut takes a run of word characters at least, so as many rounds as it has runs do."""
    forms = F.filter(F.array(*map(F.lit, LEGAL)), lambda e: F.contains(text, e))

    def cut(a: Column, e: Column) -> Column:
        rest = F.substring(a, F.lit(1), F.char_length(a) - F.char_length(e))
        bound = rest.rlike(r"(?U)\b\z") == F.startswith(e, F.lit("("))
        return F.when(F.endswith(a, e), F.when(bound & (strip(rest) != ""), strip(rest)).otherwise(a)).otherwise(a)

    def rounds(own: Column) -> Column:
        runs = F.when(F.exists(own, lambda e: F.endswith(text, e)), F.size(F.regexp_extract_all(text, F.lit(r"(?U)\w+"), F.lit(0))) + 1).otherwise(1)
        return F.aggregate(F.sequence(F.lit(1), runs), text, lambda s, _: F.aggregate(own, s, cut))

    return let(forms, rounds)


def normalize_name(name: Column) -> Column:
    """Lower case, without separators, legal forms at the end (as long as something stays) and marks."""
    text = _squeeze(F.regexp_replace(strip(F.lower(F.coalesce(name, F.lit("")))), "[,/_]", " "))
    return strip(_squeeze(F.regexp_replace(let(text, _without_forms), r"(?U)[^\w\s]", " ")))


def label_brand(label: Column) -> Column:
    """Brand of an exchange label: "Kraken: Hot Wallet 2" is kraken."""
    text = F.lower(strip(F.coalesce(label, F.lit(""))))
    for _ in range(5):
        text = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"\s*[:\-]\s*[a-z0-9].*\z", ""), r"\s+[0-9]+\z", ""), r"\s*\([^)]+\)\z", "")
    return strip(text)


def is_junk_name(name: Column) -> Column:
    """Whether a name has a known scam shape or two brands in it."""
    text = F.coalesce(name, F.lit(""))
    brands = F.filter(F.array(*map(F.lit, BRANDS)), lambda b: F.contains(F.lower(text), b))
    return text.rlike("(?i)" + "|".join(JUNK)) | (F.size(brands) >= 2)


def first_alias(text: Column, rules: Rules) -> Column:
    """Id of the first rule (needle, id) whose needle is in text."""
    return F.coalesce(*[F.when(F.contains(text, F.lit(needle)), F.lit(f"alias::{to}")) for needle, to in rules]) if rules else F.lit(None).cast("string")


def label_to_canonical(label: Column, aliases: Rules, exact: dict[str, str]) -> Column:
    """Directory id of an exchange label, or null."""
    brand = label_brand(label)
    named = F.concat(F.lit("name::"), F.nullif(normalize_name(brand), F.lit("")))
    known = F.concat(F.lit("alias::"), lookup(brand, exact)) if exact else F.lit(None).cast("string")
    return F.when((brand == "") | is_junk_name(brand), F.lit(None).cast("string")).otherwise(F.coalesce(known, first_alias(brand, aliases), first_alias(brand, list(LABEL_ALIASES)), named))


def canonical_id(name: Column, lei: Column, address: Column, aliases: Rules, exact: dict[str, str], pinned: dict[str, str]) -> Column:
    """Id of a registered entity: pinned LEI, exact name, alias rule, LEI, normal name, raw address."""
    folded, code = strip(F.lower(F.coalesce(name, F.lit("")))), strip(F.coalesce(lei, F.lit("")))
    hit = lambda key, table: F.concat(F.lit("alias::"), lookup(key, table)) if table else F.lit(None).cast("string")
    return F.coalesce(
        hit(code, pinned),
        hit(folded, exact),
        F.when(~is_junk_name(name), first_alias(folded, aliases)),
        F.when(F.char_length(code) == 20, F.concat(F.lit("lei::"), code)),
        F.concat(F.lit("name::"), F.nullif(normalize_name(name), F.lit(""))),
        F.concat(F.lit("raw::"), F.coalesce(address, F.lit("unknown"))),
    )


def slug(text: Column, mark: str = "-", size: int | None = None) -> Column:
    """Lower case, runs of other characters as one mark, none at the ends."""
    out = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", mark), f"^{mark}+|{mark}+\\z", "")
    return out if size is None else F.substring(out, 1, size)
