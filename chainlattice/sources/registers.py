"""Registers of licensed entities: each reader turns landed files into rows, and rows into raw records.

Nothing is fetched here; files are landed in a folder by other means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import dates, names
from ..functions.chains import strip
from ..functions.text import split_at_starts
from ..operators.dedupe import first_wins, last_wins
from ..operators.directory import carry_name
from ..schema import LABEL

# Vocabularies of the registers.
CRYPTO_WORDS = (
    "crypto", "bitcoin", " btc ", "btc.", "ethereum", "eth ", "eth.", "blockchain", "web3", "defi", "dao", "digital asset", "digital-asset", "digitalasset", "virtual currency",
    "virtual-currency", "stablecoin", "stable coin", "wallet", "mining pool", "tokenized", "tokenisation", "nft", "metaverse", "ledger", "decentralized", " dex ", "dex.", "swap.",
)
FINMA_ALWAYS = ("persons under Article 1b of the Banking Act", "Swiss trading venue", "Multilateral trading system", "Organised trading facility")
FINMA_WITH_SEED = (
    "Bank", "Securities firm", "Custodian bank", "Central custodian", "Fund management company", "Portfolio manager", "Manager of collective assets",
    "Representatives of foreign collective investment schemes (CISA)", "Branch of a foreign bank", "Branch of a foreign securities firm",
)
VARA_ACTIVITIES = [
    "Category 1 VA Issuance", "Category 2 VA Issuance", "VA Custody Services", "Advisory Services", "Broker-Dealer Services", "Custody Services", "Exchange Services",
    "Lending and Borrowing Services", "Management and Investment Services", "Payment and Remittances Services", "Transfer and Settlement Services", "VA Issuance",
]
MAS_ACTIVITIES = (
    "Account Issuance Service", "Domestic Money Transfer Service", "Cross-border Money Transfer Service", "Merchant Acquisition Service", "E-money Issuance Service",
    "Digital Payment Token Service", "Money-changing Service",
)
BUREAUS = {
    "関東財務局": "kanto", "近畿財務局": "kinki", "東海財務局": "tokai", "九州財務局": "kyushu", "北海道財務局": "hokkaido", "東北財務局": "tohoku", "中国財務局": "chugoku",
    "四国財務局": "shikoku", "北陸財務局": "hokuriku", "沖縄総合事務局": "okinawa",
}
LEGAL_FORMS = (" AG", " SA", " S.A.", " GMBH", " SARL", " S.A.R.L.", " AKTIENGESELLSCHAFT", " LIMITED", " LTD", " LTD.", " LLC", " HOLDING")
VATP = 101
TRON_ENTITIES = {
    "Binance": ("Binance", "KY"), "HTX": ("HTX", "SC"), "Huobi": ("HTX", "SC"), "OKX": ("OKX", "KY"), "Bybit": ("Bybit", "AE"), "KuCoin": ("KuCoin", "SC"), "Kucoin": ("KuCoin", "SC"), "Kraken": ("Kraken", "US"),
    "Gate": ("Gate.io", "KY"), "MXC": ("MEXC", "SC"), "MEXC": ("MEXC", "SC"), "Bitfinex": ("Bitfinex", "VG"), "Bithumb": ("Bithumb", "KR"), "Upbit": ("Upbit", "KR"), "Poloniex": ("Poloniex", "US"),
    "BigONE": ("BigONE", "HK"), "BitPanda": ("Bitpanda", "AT"), "Bitpanda": ("Bitpanda", "AT"), "FixedFloat": ("FixedFloat", "unknown"), "CoinSpot": ("CoinSpot", "AU"), "Vaneck": ("VanEck", "US"),
    "Heleket": ("Heleket", "unknown"), "TronLucky": ("TronLucky", "unknown"), "WestWallet": ("WestWallet", "unknown"),
}
TRON_OTHERS = ("SR", "JustLend", "SunSwap", "Stake")


def _or_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def record(register: str, source: Column | str, address: Column, name: Column, jurisdiction: Column | str, licence: Column | None, regulator: Column | str, status: Column | str, url: Column | str, day: str, extras: dict[str, Column]) -> list[Column]:
    """The columns of a register's raw record."""
    text = lambda x: F.lit(x) if isinstance(x, str) else x
    none = F.lit(None).cast("string")
    label = F.struct(name.alias("name"), F.lit("exchange").alias("type"), text(source).alias("source"), F.lit("multi").alias("chain"), none.alias("subtype"), none.alias("chain_evidence"), F.lit(None).alias("context")).cast(LABEL)
    kept = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(k).alias("k"), v.cast("string").alias("v")) for k, v in extras.items()]), lambda e: e["v"].isNotNull()))
    return [
        F.lit(register).alias("register"), address.alias("address"), F.lit("multi").alias("chain"), F.array(label).alias("labels"), F.lit(False).alias("sanctioned"), F.lit(False).alias("is_illicit"),
        F.lit(True).alias("is_exchange"), F.lit(False).alias("is_ai_agent"), name.alias("entity_name"), F.lit("vasp").alias("category"), text(jurisdiction).alias("jurisdiction"),
        (none if licence is None else licence).alias("license_id"), text(regulator).alias("regulator"), text(status).alias("license_status"), text(url).alias("source_url"), F.lit(day).alias("source_date"), kept.alias("extras"),
    ]


def read_esma(spark: SparkSession, path: str) -> DataFrame:
    """The MiCA CSV: replacement characters go, the commercial name falls back to the legal one."""
    raw = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)
    spelt = {c.strip().lstrip("﻿"): F.nullif(strip(F.replace(F.col(f"`{c}`"), F.lit("�"), F.lit(""))), F.lit("")) for c in raw.columns}
    field = lambda c: spelt.get(c, F.lit(None).cast("string"))
    rows = raw.select(
        field("ae_competentAuthority").alias("authority"), field("ae_homeMemberState").alias("state"), field("ae_lei_name").alias("lei_name"), field("ae_lei").alias("lei"), field("ae_lei_cou_code").alias("lei_country"),
        F.coalesce(field("ae_commercial_name"), field("ae_lei_name")).alias("name"), field("ae_address").alias("street"), field("ae_website").alias("website"),
        F.coalesce(field("ac_authorisationNotificationDate"), field("ae_decision_date")).alias("authorised"), field("ac_authorisationEndDate").alias("ended"), field("ac_serviceCode").alias("services"),
        field("ac_serviceCode_cou").alias("passports"), F.coalesce(field("ac_lastupdate"), field("ae_lastupdate")).alias("updated"),
    )
    return rows.where("name is not null")


def two_forms(text: Column) -> Column:
    """dd/mm/yyyy or yyyy-mm-dd as an ISO day."""
    return F.date_format(F.coalesce(F.try_to_date(text, "d/M/yyyy"), F.try_to_date(text, "yyyy-M-d")), "yyyy-MM-dd")


def status_from_dates(authorised: Column, ended: Column) -> Column:
    return F.when(ended.isNotNull(), "revoked").when(authorised.isNotNull(), "active").otherwise("pending")


def esma(rows: DataFrame, day: str, url: str, file: str) -> DataFrame:
    start, end = two_forms(F.col("authorised")), two_forms(F.col("ended"))
    address = F.coalesce("lei", F.concat(F.lit("esma::"), F.replace(F.lower("name"), F.lit(" "), F.lit("_"))))
    extras = {"_esma_lei": F.col("lei"), "_esma_lei_legal_name": F.col("lei_name"), "_esma_competent_authority": F.col("authority"), "_esma_home_member_state": F.col("state"), "_esma_authorisation_date": start, "_esma_authorisation_end_date": end, "_esma_service_codes": F.col("services"), "_esma_passporting_countries": F.col("passports"), "_esma_website": F.col("website"), "_esma_address": F.col("street"), "_esma_source_file": F.lit(file), "_esma_last_update": F.col("updated")}
    return rows.select(*record("esma", f"esma_mica_{file}", address, F.col("name"), F.coalesce("state", "lei_country"), F.col("lei"), F.coalesce("authority", F.lit("ESMA (EU MiCA)")), status_from_dates(start, end), url, day, extras))


def esma_united(records: DataFrame, order: str) -> DataFrame:
    """One record for each LEI, or name and jurisdiction without one; labels of all in order."""
    key = F.coalesce("license_id", F.concat_ws("|", F.lower("entity_name"), F.coalesce("jurisdiction", F.lit(""))))
    rows = records.withColumn("__key", key)
    labels = rows.groupBy("__key").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(order, "labels"))), lambda x: x["labels"])).alias("__labels"))
    return first_wins(rows, ["__key"], [order]).join(labels, "__key").withColumn("labels", F.array_distinct("__labels")).drop("__key", "__labels")


def read_fincen(spark: SparkSession, path: str) -> DataFrame:
    """The tab-separated list; short lines are left out, an unreadable number of branches is 0."""
    lines = spark.read.text(path).select(F.split("value", "\t").alias("c")).where(F.size("c") >= 13).where(~F.contains(F.upper(F.get("c", F.lit(0))), F.lit("LEGAL NAME")))
    named = ("legal_name", "dba_name", "street", "city", "state", "zip", "activities", "states_offered", "foreign_flag", "foreign_location")
    cell = lambda i: strip(F.get("c", F.lit(i)))
    return lines.select(*[cell(i).alias(n) for i, n in enumerate(named)], F.coalesce(cell(10).try_cast("int"), F.lit(0)).alias("branches"), cell(11).alias("auth_date"), cell(12).alias("received_date"))


def is_crypto_msb(known: list[str]) -> Column:
    blob = F.concat(F.lit(" "), F.lower("legal_name"), F.lit(" | "), F.lower("dba_name"), F.lit(" "))
    return F.exists(F.array(*map(F.lit, [*CRYPTO_WORDS, *known])), lambda w: F.contains(blob, w))


def fincen(rows: DataFrame, day: str) -> DataFrame:
    name = F.coalesce(F.nullif("legal_name", F.lit("")), "dba_name")
    address = F.concat(F.lit("fincen::"), F.substring(F.replace(F.lower(name), F.lit(" "), F.lit("_")), 1, 60))
    extras = {f"_fincen_{c}": F.nullif(src, F.lit("")) for c, src in (("dba_name", "dba_name"), ("address", "street"), ("state", "state"), ("zip", "zip"), ("activities", "activities"), ("states_offered", "states_offered"), ("foreign_location", "foreign_location"))}
    extras |= {"_fincen_auth_date": dates.us_date(F.col("auth_date")), "_fincen_received_date": dates.us_date(F.col("received_date")), "_fincen_branches": F.col("branches")}
    return rows.select(*record("fincen", "fincen_msb", address, name, "US", None, "Financial Crimes Enforcement Network (FinCEN)", "active", "https://msb.fincen.gov/retrieve.msb.list.php", day, extras))


def read_finma(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("header", True).option("sep", ";").option("quote", '"').csv(path)
    have = {c.lstrip("﻿"): c for c in raw.columns}
    cell = lambda c: F.coalesce(strip(F.col(f"`{have[c]}`")), F.lit("")) if c in have else F.lit("")
    return raw.select(cell("Name").alias("name"), cell("City").alias("city"), *[cell(f"AuthorisationType{x}").alias(f"auth_{x.lower()}") for x in ("DE", "FR", "IT", "EN")], cell("UID").alias("uid"))


def finma_kept(rows: DataFrame, seeds: list[str], order: str) -> DataFrame:
    """Rows whose authorisation is always a VASP's, or with a seed word in the name (the longest is given);
    the last of each (uid, authorisation)."""
    found = F.array_sort(F.filter(F.array(*map(F.lit, seeds)), lambda s: F.contains(F.lower("name"), F.lower(s))), lambda a, b: F.char_length(b) - F.char_length(a)) if seeds else F.array().cast("array<string>")
    rows = rows.withColumn("seed", F.get(found, F.lit(0)))
    reason = F.when(F.col("auth_en").isin(*FINMA_ALWAYS), F.concat(F.lit("auth-type:"), "auth_en")).when(F.col("auth_en").isin(*FINMA_WITH_SEED) & F.col("seed").isNotNull(), F.concat(F.lit("seed:"), "seed", F.lit("|auth:"), "auth_en"))
    return last_wins(rows.withColumn("reason", reason).where("reason is not null"), ["uid", "auth_en"], [order])


def legal_form(name: Column) -> Column:
    upper = F.upper(name)
    return F.coalesce(*[F.when(F.endswith(upper, F.lit(f)) | F.endswith(upper, F.lit(f + ".")), f.strip().rstrip(".")) for f in LEGAL_FORMS])


def finma(rows: DataFrame, day: str, url: str) -> DataFrame:
    slug = names.slug(F.col("name"))
    address = F.when(F.col("uid") != "", F.concat(F.lit("ch_finma::license_id::"), "uid")).otherwise(F.concat(F.lit("ch_finma::name::"), slug))
    extras = {"_ch_uid": F.nullif("uid", F.lit("")), "_ch_legal_form": legal_form(F.col("name")), "_ch_city": F.nullif("city", F.lit("")), "_ch_activity_class": F.nullif("auth_en", F.lit("")), "_ch_match_reason": F.col("reason")}
    extras |= {f"_ch_activity_class_{x}": F.nullif(f"auth_{x}", F.lit("")) for x in ("de", "fr", "it")}
    return rows.select(*record("ch_finma", "ch_finma_register", address, F.col("name"), "CH", F.coalesce(F.nullif("uid", F.lit("")), F.concat(F.lit("slug-"), slug)), "Swiss Financial Market Supervisory Authority (CH FINMA)", "active", url, day, extras))


def vara_rows(pages: DataFrame) -> DataFrame:
    """Rows of the register's table: cells by their data-label."""
    cells = r'(?s)<td[^>]*data-label="([^"]+)"[^>]*>(.*?)</td>'
    plain = lambda c: strip(F.regexp_replace(F.replace(F.replace(F.replace(F.regexp_replace(c, "<[^>]+>", " "), F.lit("&amp;"), F.lit("&")), F.lit("&nbsp;"), F.lit(" ")), F.lit("&#39;"), F.lit("'")), r"(?U)\s+", " "))
    rows = pages.select(F.posexplode(F.regexp_extract_all("body", F.lit(r"(?s)<tr[^>]*>(.*?)</tr>"), F.lit(1))).alias("pos", "tr"))
    pairs = F.zip_with(F.regexp_extract_all("tr", F.lit(cells), F.lit(1)), F.transform(F.regexp_extract_all("tr", F.lit(cells), F.lit(2)), plain), lambda k, v: F.struct(k.alias("k"), v.alias("v")))
    rows = rows.withColumn("m", pairs)
    cell = lambda k: F.coalesce(F.get(F.transform(F.filter("m", lambda p: p["k"] == k), lambda p: p["v"]), F.size(F.filter("m", lambda p: p["k"] == k)) - 1), F.lit(""))
    return rows.select(
        "pos", cell("VASP Name").alias("vasp_name"), cell("Licence Type").alias("licence_type"), cell("Reference").alias("reference"), split_at_starts(cell("Licensed Activities"), VARA_ACTIVITIES).alias("activities"),
        F.nullif(cell("Licence Issued"), F.lit("")).alias("issued"), cell("Status").alias("status"), F.nullif(cell("SCA Registration Number"), F.lit("")).alias("sca"),
    ).where("vasp_name != ''")


def normalize_status(status: Column) -> Column:
    s = F.lower(strip(F.coalesce(status, F.lit(""))))
    return (
        F.when(s.isin("active", "issued"), "active").when(s.isin("revoked", "withdrawn", "cancelled", "canceled"), "revoked").when(s == "suspended", "suspended")
        .when(s.isin("pending", "in-principle approval", "ipa"), "pending").when(F.contains(s, F.lit("active")) | (s == ""), "active").otherwise(s)
    )


def vara(rows: DataFrame, day: str, url: str) -> DataFrame:
    name = strip(F.regexp_replace("vasp_name", r"\s*\([^)]*\)\s*\z", ""))
    address = F.when(F.col("reference") != "", F.concat(F.lit("uae_vara::license_id::"), "reference")).otherwise(F.concat(F.lit("uae_vara::name::"), names.slug(F.col("vasp_name"), "-", 80)))
    issued = F.date_format(F.coalesce(F.try_to_date("issued", "yyyy/M/d"), F.try_to_date("issued", "d/M/yyyy"), F.try_to_date("issued", "yyyy-M-d")), "yyyy-MM-dd")
    extras = {"_vara_categories": F.to_json("activities"), "_vara_licence_class": F.col("licence_type"), "_vara_licence_issued": issued, "_vara_status_raw": F.col("status"), "_vara_sca_registration": F.col("sca"), "_vara_emirate": F.lit("Dubai")}
    return rows.select(*record("uae_vara", "uae_vara_register", address, name, "AE-DU", F.col("reference"), "Virtual Asset Regulatory Authority (UAE VARA)", normalize_status(F.col("status")), url, day, extras))


def name_from_slug(slug: Column) -> Column:
    """"431405-2C2P-Pte-Ltd" is 2C2P Pte Ltd."""
    rest = F.regexp_extract(slug, r"^[0-9]+-(.*)\z", 1)
    return F.when(~F.contains(slug, F.lit("-")), slug).otherwise(F.replace(F.when(slug.rlike("^[0-9]+-"), rest).otherwise(slug), F.lit("-"), F.lit(" ")))


def mas_listing(pages: DataFrame) -> DataFrame:
    """Slug and name of the institutions on listing pages, each once."""
    paths = F.regexp_extract_all("body", F.lit(r'href="/fid/institution/detail/([^"]+)"'), F.lit(1))
    return pages.select(F.explode(paths).alias("path")).select(F.substring_index("path", "/", -1).alias("slug")).distinct().select("slug", name_from_slug(F.col("slug")).alias("name"))


def mas_details(pages: DataFrame) -> DataFrame:
    """slug and body to the institution's category, activities and contacts."""
    start = F.coalesce(F.nullif(F.instr("body", "Major Payment Institution"), F.lit(0)), F.nullif(F.instr("body", "Standard Payment Institution"), F.lit(0)))
    section = F.when(start.isNotNull(), F.substring(F.col("body"), start, F.lit(5000))).otherwise(F.substring("body", 1, 8000))
    rows = pages.withColumn("section", section)
    text = F.lower(strip(F.regexp_replace(F.regexp_replace("section", "<[^>]+>", " "), r"(?U)\s+", " ")))
    activities = F.filter(F.array(*map(F.lit, MAS_ACTIVITIES)), lambda a: F.contains(text, F.lower(a)))
    category = F.when(F.contains("section", F.lit("Major Payment")), "Major Payment Institution").when(F.contains("section", F.lit("Standard Payment")), "Standard Payment Institution").otherwise("unknown")
    pick = lambda p: F.nullif(strip(F.regexp_extract("body", p, 1)), F.lit(""))
    return rows.select("slug", category.alias("mas_category"), activities.alias("activities"), pick(r"<td[^>]*>\s*([0-9][^<]{15,180}\b(?:SINGAPORE|Singapore)\b[^<]*)</td>").alias("street"), pick(r'href="(https?://[^"]+)"[^>]*>\s*https?://').alias("website"), pick(r'href="tel:([^"]+)"').alias("phone"))


def is_dpt_licensee() -> Column:
    return F.array_contains("activities", "Digital Payment Token Service")


def mas(rows: DataFrame, day: str, base_url: str) -> DataFrame:
    extras = {"_mas_category": F.col("mas_category"), "_mas_activities": F.to_json("activities"), "_mas_address": F.col("street"), "_mas_website": F.col("website"), "_mas_phone": F.col("phone")}
    return rows.select(*record("mas", "mas_fid_sg", F.concat(F.lit("mas::"), "slug"), F.col("name"), "SG", F.col("slug"), "Monetary Authority of Singapore (MAS)", "active", F.concat(F.lit(f"{base_url}/institution/detail/"), "slug"), day, extras))


def sfc_date(text: Column) -> Column:
    """"Apr 19, 2024 12:00:00 AM" and plainer forms as an ISO day."""
    return F.date_format(F.coalesce(F.try_to_date(F.regexp_extract(text, r"^([A-Z][a-z]{2} [0-9]{1,2}, [0-9]{4})", 1), "MMM d, yyyy"), F.try_to_date(text, "yyyy-MM-dd"), F.try_to_date(text, "d/M/yyyy")), "yyyy-MM-dd")


def sfc_details(pages: DataFrame) -> DataFrame:
    """ceref and body to the licence of a trading platform and the sorted types of other activities."""
    rows = "array<struct<actType:int,effDate:string,status:string>>"
    embedded = lambda name: F.from_json(F.nullif(F.regexp_extract("body", rf"(?s)var\s+{name}\s*=\s*(\[.*?\]);", 1), F.lit("")), rows)
    own = F.get(F.filter(embedded("amloDetailData"), lambda r: r["actType"] == VATP), F.lit(0))
    types = F.array_sort(F.array_distinct(F.filter(F.transform(embedded("raDetailData"), lambda r: r["actType"]), lambda t: t.isNotNull())))
    return pages.select("ceref", sfc_date(own["effDate"]).alias("amlo_date"), own["status"].alias("amlo_status"), F.coalesce(types, F.array().cast("array<int>")).alias("sfo_types"))


def sfc(items: DataFrame, details: DataFrame, day: str, url: str, order: str) -> DataFrame:
    """Search items (ceref, name, nameChi, hasActiveLicence, hasActiveLicenceAmlo, isDeemedLicenceAmlo,
    full_address) with their details; of repeated items the last counts."""
    rows = last_wins(items.where("coalesce(ceref, '') != ''"), ["ceref"], [order]).join(details, "ceref", "left")
    flag = lambda c: F.coalesce(F.col(c) == "Y", F.lit(False))
    status = F.when(F.col("amlo_status") == "E", "revoked").when((F.col("amlo_status") == "A") | flag("hasActiveLicenceAmlo"), "active").when(flag("isDeemedLicenceAmlo"), "pending").otherwise("revoked")
    extras = {"_hk_ceref": F.col("ceref"), "_hk_name_chi": _or_null(F.col("nameChi")), "_hk_address": F.col("full_address"), "_hk_has_active_amlo": flag("hasActiveLicenceAmlo"), "_hk_is_deemed_amlo": flag("isDeemedLicenceAmlo"), "_hk_has_active_sfo": flag("hasActiveLicence"), "_hk_amlo_effective_date": F.col("amlo_date"), "_hk_amlo_status_code": F.col("amlo_status"), "_hk_sfo_act_types": F.to_json("sfo_types")}
    return rows.select(*record("hk_sfc", "hk_sfc_register", F.concat(F.lit("hk_sfc::license_id::"), "ceref"), strip(F.coalesce("name", F.lit(""))), "HK", F.col("ceref"), "Securities and Futures Commission (HK SFC)", status, F.replace(F.lit(url), F.lit("{ceref}"), F.col("ceref")), day, extras))


def fca_candidates(hits: DataFrame, limit: int = 5) -> DataFrame:
    """seed and frn: the first firms that each seed's search (pos, url, kind, reference) found."""
    frn = F.coalesce(F.nullif(F.regexp_extract("url", r".*/Firm/(.*)\z", 1), F.lit("")), F.when((F.col("kind") == "Firm") & ~F.contains(F.coalesce("url", F.lit("")), F.lit("/Firm/")), F.nullif("reference", F.lit(""))))
    rows = hits.withColumn("frn", frn).where("frn is not null")
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("seed").orderBy("pos"))).where(F.col("rank") <= limit).select("seed", "frn")


def fca(firms: DataFrame, candidates: DataFrame, day: str) -> DataFrame:
    """Candidates that are registered under the money laundering regulations. firms: frn, name, status,
    mlr_status, mlr_date, business_type, companies_house."""
    rows = firms.where("mlr_status = 'MLRs Registered'").join(candidates.select("frn").distinct(), "frn", "left_semi").dropDuplicates(["frn"])
    status = F.when(F.lower("status").isin("no longer authorised", "deauthorised"), "revoked").when(F.lower("status").isin("applied", "in progress"), "pending").otherwise("active")
    extras = {"_fca_frn": F.col("frn"), "_fca_status": F.col("status"), "_fca_mlr_status": F.col("mlr_status"), "_fca_mlr_effective_date": two_forms(F.col("mlr_date")), "_fca_business_type": F.col("business_type"), "_fca_companies_house": F.col("companies_house")}
    return rows.select(*record("fca", "fca_register_uk", F.concat(F.lit("fca::frn::"), "frn"), F.col("name"), "GB", F.col("frn"), "Financial Conduct Authority (FCA)", status, F.concat(F.lit("https://register.fca.org.uk/s/firm?id="), "frn"), day, extras))


def nydfs(rows: DataFrame, day: str, url: str) -> DataFrame:
    """A curated list: name, license_type, license_date, status."""
    address = F.concat(F.lit("nydfs::"), F.substring(F.replace(F.lower("name"), F.lit(" "), F.lit("_")), 1, 60))
    extras = {"_nydfs_license_type": F.col("license_type"), "_nydfs_license_date": F.col("license_date")}
    return rows.select(*record("nydfs", "nydfs_bitlicense", address, F.col("name"), "US-NY", None, "New York State Department of Financial Services (NY DFS)", F.col("status"), url, day, extras))


def licence_number(cell: Column) -> Column:
    """number (five digits), bureau and full form of a JFSA licence cell; number is empty without one."""
    flat = F.translate(F.regexp_replace(F.coalesce(cell, F.lit("")), r"(?U)\s+", ""), "０１２３４５６７８９", "0123456789")
    digits = F.regexp_extract(flat, "第([0-9]+)号", 1)
    number = F.when(digits != "", F.lpad(digits, F.greatest(F.char_length(digits), F.lit(5)), F.lit("0"))).otherwise("")
    bureau = F.regexp_extract(flat, "^([一-鿿]+?財務局)長", 1)
    full = F.when(number == "", strip(F.coalesce(cell, F.lit("")))).otherwise(F.concat(F.when(bureau != "", F.concat(bureau, F.lit("長 "))).otherwise(""), F.lit("第"), number, F.lit("号")))
    return F.struct(number.alias("number"), F.when(number != "", bureau).otherwise("").alias("bureau"), full.alias("full"))


def detect_bureau(cell: Column) -> Column:
    flat = F.regexp_replace(F.coalesce(cell, F.lit("")), r"(?U)\s+", "")
    return F.coalesce(*[F.when(F.contains(flat, F.lit(b)), b) for b in BUREAUS])


def latin_alias(name: Column) -> Column:
    """The longest Latin run of two letters or more in a Japanese name, or null."""
    bare = F.replace(F.regexp_replace(F.coalesce(name, F.lit("")), "※[0-9]*", ""), F.lit("株式会社"), F.lit(""))
    runs = F.transform(F.regexp_extract_all(bare, F.lit(r"([A-Za-z][A-Za-z0-9 .&'\-]*)"), F.lit(1)), lambda r: F.struct(F.char_length(r).alias("n"), r.alias("r")))
    longest = F.aggregate(runs, F.struct(F.lit(0).alias("n"), F.lit("").alias("r")), lambda a, r: F.when(r["n"] > a["n"], r).otherwise(a))["r"]
    trimmed = F.regexp_replace(longest, r"^[ .\-']+|[ .\-']+\z", "")
    return F.when(F.char_length(trimmed) >= 2, trimmed)


def jfsa(cells: DataFrame, day: str, url: str) -> DataFrame:
    """Cells of the register's tables (page, pos, c: nine texts), already taken out of the PDF. The bureau
    is the licence's own, else the one that a cell above carries."""
    c = lambda i: F.coalesce(F.get("c", F.lit(i)), F.lit(""))
    rows = cells.where(F.size("c") >= 9).withColumn("above", detect_bureau(c(0))).withColumn("header", F.contains(c(1), F.lit("登録番号")))
    rows = rows.withColumn("carried", carry_name([], ["page", "pos"], "above")).withColumn("l", licence_number(c(1))).where("not header and l.number != ''")
    bureau = F.coalesce(F.nullif("l.bureau", F.lit("")), "carried", F.lit(""))
    slug = F.coalesce(*[F.when(bureau == b, s) for b, s in BUREAUS.items()], F.nullif(bureau, F.lit("")), F.lit("jfsa"))
    name = strip(F.regexp_replace(c(3), "※[0-9]*", ""))
    extras = {"_jp_license_number": F.col("l.number"), "_jp_bureau": bureau, "_jp_latin_alias": latin_alias(c(3)), "_jp_corporate_number": _or_null(c(4)), "_jp_postal_code": _or_null(c(5)), "_jp_address": _or_null(c(6)), "_jp_phone": _or_null(c(7)), "_jp_registration_date_iso": dates.wareki_date(c(2)), "_jp_registration_date_wareki": c(2), "_jp_supported_assets": _or_null(c(8))}
    address = F.concat(F.lit("jp_jfsa::license_id::"), slug, F.lit("-"), "l.number")
    return rows.select(*record("jp_jfsa", "jp_jfsa_register", address, name, "JP", F.col("l.full"), "Financial Services Agency (JP JFSA)", "active", url, day, extras))


def tag_entity(tag: Column) -> Column:
    """entity, category and jurisdiction of an account's public tag, by its first word; null: not an
    exchange. Unknown words are taken as depositors' wallets."""
    first = F.regexp_replace(F.get(F.split(strip(F.substring_index(tag, "-", 1)), r"\s+"), F.lit(0)), ":+$", "")
    known = F.create_map(*[x for k, (n, j) in TRON_ENTITIES.items() for x in (F.lit(k), F.struct(F.lit(n).alias("n"), F.lit(j).alias("j")))])
    found = F.try_element_at(known, first)
    out = F.struct(F.coalesce(found["n"], first).alias("entity"), F.when(found.isNotNull() & ~first.isin("Vaneck", "SR"), "vasp").otherwise("exchange_depositor").alias("category"), F.coalesce(found["j"], F.lit("unknown")).alias("jurisdiction"))
    return F.when((first != "") & ~first.isin(*TRON_OTHERS), out)


def read_tronscan(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages of accounts: address, tag and ord."""
    page = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.posexplode(F.from_json("value", "data array<struct<address:string,addressTag:string,publicTag:string>>")["data"]).alias("pos", "a"))
    return page.select(F.col("a.address").alias("address"), F.coalesce("a.publicTag", "a.addressTag").alias("tag"), F.struct("file", "pos").alias("ord"))


def tronscan(accounts: DataFrame, day: str, url: str = "https://apilist.tronscanapi.com") -> DataFrame:
    """Raw records of tagged accounts (address, tag)."""
    rows = accounts.withColumn("v", tag_entity(F.col("tag"))).where("v is not null")
    none = F.lit(None).cast("string")
    label = F.struct(F.col("tag").alias("name"), F.lit("exchange").alias("type"), F.lit("tronscan_public").alias("source"), F.lit("tron").alias("chain"), none.alias("subtype"), none.alias("chain_evidence"), F.lit(None).alias("context")).cast(LABEL)
    return rows.select("address", F.lit("tron").alias("chain"), F.array(label).alias("labels"), F.col("v.entity").alias("entity_name"), F.col("v.category").alias("category"), F.col("v.jurisdiction").alias("jurisdiction"), F.lit(url).alias("source_url"), F.lit(day).alias("source_date"), F.lit(True).alias("is_exchange"))
