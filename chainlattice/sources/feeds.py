"""Feeds of labels: analytics SQL, an entity graph as JSON lines, incident files, label lists, action pages,
and a checkout of project files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.address import canonical_case, chain_by_form
from ..functions.arrays import running
from ..functions.chains import EVM_CHAINS, lookup, strip
from ..functions.text import links
from ..schema import LABEL

# Keywords of files, the two tuples, network names, and the taxonomy of the entity graph.
CEX = r"\((0x[0-9a-fA-F]{40}),\s*'([^']+)',\s*'([^']*)',\s*'([^']*)',\s*date\s+'([^']+)'\)"
LABELS = r"\(\s*'(ethereum|bnb|polygon|arbitrum|optimism|base|avalanche_c|fantom|gnosis|celo|linea|scroll|zksync)',\s*(0x[0-9a-fA-F]{40}),\s*'([^']+)',\s*'([^']*)'"
NETWORKS = {
    "binance": "bsc", "bsc": "bsc", "bnb": "bsc", "bnb chain": "bsc", "ethereum": "ethereum", "ethereum classic": "ethereum_classic", "eth": "ethereum", "polygon": "polygon",
    "polygon (matic)": "polygon", "matic": "polygon", "avalanche": "avalanche_c", "avax": "avalanche_c", "arbitrum": "arbitrum", "optimism": "optimism", "base": "base", "fantom": "fantom",
    "cronos": "cronos", "tron": "tron", "trx": "tron", "bitcoin": "bitcoin", "btc": "bitcoin", "solana": "solana", "sol": "solana", "near": "near", "cardano": "cardano", "harmony": "harmony",
    "heco": "heco", "okex": "okex", "okc": "okex", "xdai": "gnosis", "gnosis": "gnosis", "celo": "celo", "moonbeam": "moonbeam", "moonriver": "moonriver", "aurora": "aurora",
}
SANCTION_TOPICS = ("sanction", "sanction.linked", "sanction.counter")
SANCTION_DATASETS = "ofac|hmt|eu_fsf|un_sc|ch_seco|ca_sema|sanctions|jp_mof"
DATASET_KINDS = {"ransomwhere": "ransomware", "il_mod_crypto": "terror_financing", "us_fbi_lazarus_crypto": "hack"}
TOPIC_KINDS = {
    "crime.theft": "theft", "crime.terror": "terror_financing", "crime.fin": "financial_crime", "crime.cyber": "cybercrime", "crime.fraud": "fraud", "crime.traffick": "trafficking",
    "crime.war": "war_crimes", "crime": "crime", "wanted": "wanted", "debarment": "debarment", "export.control": "export_control",
}
ILLICIT_DATASETS = "il_mod|fbi_|interpol"
ENTITY = "id string, caption string, schema string, datasets array<string>, first_seen string, last_change string, properties struct<name:array<string>,alias:array<string>,weakAlias:array<string>,holder:array<string>,publicKey:array<string>,topics:array<string>,createdAt:array<string>>"
REKT = (
    "id string, project_name string, title string, date string, proof_link string, webarchive_link string, token_address string, description string, "
    "scam_type struct<type:string>, scamNetworks array<struct<networks:struct<name:string>>>, token_addresses array<string>"
)
_HEX, _TRON = r"\b0x[0-9a-fA-F]{40}\b", r"\bT[1-9A-HJ-NP-Za-km-z]{33}\b"
_LEGACY, _BECH32 = r"\b[13][1-9A-HJ-NP-Za-km-z]{25,34}\b", r"\bbc1[02-9ac-hj-np-z]{38,58}\b"


def _label(name: Column, kind: Column, source: str, chain: Column, subtype: Column | None = None, context: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(name.alias("name"), kind.alias("type"), F.lit(source).alias("source"), chain.alias("chain"), (none if subtype is None else subtype).alias("subtype"), none.alias("chain_evidence"), (F.lit(None) if context is None else context).alias("context")).cast(LABEL)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """path and body of every file."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))


def sql_files(files: DataFrame, include: list[str], exclude: tuple[str, ...] = ("/test_", "README", ".md", ".yml")) -> DataFrame:
    """The SQL files whose path has a keyword to include and none to exclude."""
    found = F.lower("path").endswith(".sql") & F.exists(F.array(*map(F.lit, include)), lambda k: F.contains(F.lower("path"), k))
    return files.where(found & ~F.exists(F.array(*map(F.lit, exclude)), lambda k: F.contains("path", k)))


def spellbook(files: DataFrame) -> DataFrame:
    """Rows of the two kinds of tuples: address, chain, entity_name, distinct_name, category, source_file, ord."""
    group = lambda pattern, i: F.regexp_extract_all("body", F.lit(pattern), F.lit(i))
    cex = F.arrays_zip(group(CEX, 1).alias("a"), group(CEX, 2).alias("n"), group(CEX, 3).alias("d"))
    lab = F.arrays_zip(group(LABELS, 1).alias("c"), group(LABELS, 2).alias("a"), group(LABELS, 3).alias("n"), group(LABELS, 4).alias("k"))
    one = F.transform(cex, lambda x: F.struct(F.lower(x["a"]).alias("address"), F.lit("ethereum").alias("chain"), x["n"].alias("entity_name"), F.nullif(x["d"], F.lit("")).alias("distinct_name"), F.lit("exchange").alias("category")))
    two = F.transform(lab, lambda x: F.struct(F.lower(x["a"]).alias("address"), x["c"].alias("chain"), x["n"].alias("entity_name"), F.lit(None).cast("string").alias("distinct_name"), x["k"].alias("category")))
    return files.select("path", F.posexplode(F.concat(one, two)).alias("pos", "r")).select("r.*", F.col("path").alias("source_file"), F.struct(F.col("path"), F.col("pos")).alias("ord"))


def read_entities(spark: SparkSession, path: str) -> DataFrame:
    """Entities of a JSON-lines graph; unreadable lines are left out."""
    return spark.read.text(path).select(F.from_json("value", ENTITY).alias("e")).where("e.id is not null").select("e.*")


def entity_name() -> Column:
    first = lambda c: F.nullif(F.get(F.col(f"properties.{c}"), F.lit(0)), F.lit(""))
    return F.coalesce(first("name"), first("alias"), first("weakAlias"), F.nullif("caption", F.lit("")), F.col("id"))


def wallet_kind(topics: Column, datasets: Column) -> Column:
    """type and subtype of a wallet by its source's own taxonomy; the first rule that fits decides."""
    mapped = lambda items, table: F.get(F.filter(F.transform(items, lambda x: lookup(x, table)), lambda x: x.isNotNull()), F.lit(0))
    by_dataset, by_topic = mapped(datasets, DATASET_KINDS), mapped(topics, TOPIC_KINDS)
    listed = F.exists(topics, lambda t: t.isin(*SANCTION_TOPICS)) | F.exists(datasets, lambda d: F.lower(d).rlike(SANCTION_DATASETS))
    illicit = F.exists(datasets, lambda d: F.lower(d).rlike(ILLICIT_DATASETS))
    none = F.lit(None).cast("string")
    kind = F.when(listed, "sanctioned").when(by_dataset.isNotNull() | by_topic.isNotNull() | illicit, "illicit").otherwise("vasp")
    subtype = F.when(listed, none).otherwise(F.coalesce(by_dataset, by_topic, F.when(illicit, "unspecified")))
    return F.struct(kind.alias("type"), subtype.alias("subtype"))


def wallets(entities: DataFrame, base_url: str) -> DataFrame:
    """One raw record for each public key of a wallet whose chain its form tells. The holder is the first
    of the wallet's holders that is an entity with a name: a join, not a map on the driver."""
    named = entities.select(F.col("id").alias("holder_id"), entity_name().alias("holder_name"))
    rows = entities.where("schema = 'CryptoWallet'").withColumn("own_name", entity_name())
    holders = rows.select("id", F.posexplode("properties.holder").alias("pos", "holder_id")).join(named, "holder_id").groupBy("id").agg(F.min_by("holder_name", "pos").alias("holder"))
    topics, datasets = (F.coalesce(c, F.array().cast("array<string>")) for c in ("properties.topics", "datasets"))
    each = rows.join(holders, "id", "left").withColumns({"topics": topics, "sets": datasets}).select("id", "holder", "own_name", "topics", "sets", "last_change", "first_seen", F.explode("properties.publicKey").alias("key"))
    each = each.withColumns({"chain": chain_by_form(F.col("key")), "kind": wallet_kind(F.col("topics"), F.col("sets"))}).where("chain != 'unknown' and trim(key) != ''")
    listed = F.col("kind.type") == "sanctioned"
    illicit = F.col("kind.type").isin("sanctioned", "illicit")
    none = F.lit(None).cast("string")
    context = F.struct(*[none.alias(c) for c in ("source_url", "action", "action_date", "action_evidence")], F.lit(None).cast("array<string>").alias("sections"), F.col("sets").alias("datasets"), F.col("topics"))
    return each.select(
        canonical_case(F.col("key")).alias("address"), "chain", F.array(_label(F.col("own_name"), F.col("kind.type"), "opensanctions", F.col("chain"), F.col("kind.subtype"), context)).alias("labels"),
        listed.alias("sanctioned"), illicit.alias("is_illicit"), F.lit(False).alias("is_exchange"), F.lit(False).alias("is_ai_agent"), F.coalesce("holder", "own_name").alias("entity_name"),
        F.when(listed, "sanctioned").when(~illicit, "unknown").alias("category"), F.when(listed, F.array_join(F.concat("topics", F.slice("sets", 1, 3)), "; ")).alias("sanctions_reference"),
        F.concat(F.lit(f"{base_url}/entities/"), "id", F.lit("/")).alias("source_url"), F.coalesce(F.nullif("last_change", F.lit("")), "first_seen").alias("source_date"),
    )


def text_addresses(text: Column) -> Column:
    """Addresses in prose: (chain, address), EVM ones under evm_unknown."""
    shapes = ((_HEX, "evm_unknown", True), (_TRON, "tron", False), (_LEGACY, "bitcoin", False), (_BECH32, "bitcoin", True))

    def of(pattern: str, chain: str, lower: bool) -> Column:
        return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda a: F.struct(F.lit(chain).alias("chain"), (F.lower(a) if lower else a).alias("address")))

    return F.array_distinct(F.concat(*[of(*s) for s in shapes]))


def read_incidents(spark: SparkSession, path: str) -> DataFrame:
    """Incident files, one JSON document each; unreadable ones have a null id."""
    rows = read_texts(spark, path).select("path", F.from_json("body", REKT).alias("r"))
    return rows.select("path", "r.*")


def network_chain(name: Column) -> Column:
    return lookup(F.lower(strip(F.coalesce(name, F.lit("")))), NETWORKS)


def incidents(rows: DataFrame, base_url: str = "https://github.com/liqtags/crypto-rekts") -> DataFrame:
    """One raw record for each address and chain of an incident. EVM addresses of the fields stand on every
    EVM chain that the incident declares, or on evm; those of the prose on declared chains only."""
    declared = F.array_compact(F.array_distinct(F.transform(F.coalesce("scamNetworks", F.array().cast("array<struct<networks:struct<name:string>>>")), lambda n: network_chain(n["networks"]["name"]))))
    evm = F.array_sort(F.filter(declared, lambda c: c.isin([x for x in EVM_CHAINS if x != "evm"])))
    listed = F.transform(F.coalesce("token_addresses", F.array().cast("array<string>")), lambda a: F.when(F.startswith(a, F.lit("{")), F.struct(F.coalesce(F.get_json_object(a, "$.address"), F.get_json_object(a, "$.token_address")).alias("a"), network_chain(F.coalesce(F.get_json_object(a, "$.network.name"), F.get_json_object(a, "$.network"))).alias("hint"))).otherwise(F.struct(a.alias("a"), F.lit(None).cast("string").alias("hint"))))
    fields = F.array_distinct(F.concat(F.array(F.struct(F.col("token_address").alias("a"), F.lit(None).cast("string").alias("hint"))), listed))

    def placed(x: Column) -> Column:
        a, hint = x["a"], x["hint"]
        chains = (
            F.when(F.startswith(a, F.lit("T")) & (F.char_length(a) == 34), F.array(F.lit("tron")))
            .when(F.startswith(a, F.lit("0x")) & (F.char_length(a) == 42), F.when(hint.isin(EVM_CHAINS), F.array(hint)).when(F.size("evm") > 0, F.col("evm")).otherwise(F.array(F.lit("evm"))))
            .when(a.rlike("^(?:1|3|bc1)"), F.array(F.lit("bitcoin")))
            .otherwise(F.array().cast("array<string>"))
        )
        return F.transform(chains, lambda c: F.struct(c.alias("chain"), F.when(F.startswith(a, F.lit("0x")), F.lower(a)).otherwise(a).alias("address")))

    rows = rows.withColumns({"evm": evm, "fields": fields})
    prose = F.flatten(F.transform(text_addresses(F.coalesce("description", F.lit(""))), lambda m: F.when(m["chain"] == "evm_unknown", F.transform(F.col("evm"), lambda c: F.struct(c.alias("chain"), m["address"].alias("address")))).otherwise(F.array(m))))
    every = F.array_distinct(F.concat(F.flatten(F.transform(F.filter("fields", lambda x: F.coalesce(x["a"], F.lit("")) != ""), placed)), prose))
    name = F.coalesce(F.nullif("project_name", F.lit("")), "title", F.lit(""))
    kind = F.lower(F.coalesce(F.nullif("scam_type.type", F.lit("")), F.lit("scam")))
    url = F.coalesce(F.nullif("proof_link", F.lit("")), F.nullif("webarchive_link", F.lit("")), F.concat(F.lit(f"{base_url}/blob/main/rekts/"), F.coalesce("id", F.lit("?")), F.lit(".json")))
    each = rows.select(F.explode(every).alias("x"), name.alias("n"), kind.alias("k"), url.alias("u"), "date")
    return each.select(
        "x.address", "x.chain", F.array(_label(F.col("n"), F.col("k"), "crypto_rekts", F.col("x.chain"))).alias("labels"), F.lit(False).alias("sanctioned"), F.lit(True).alias("is_illicit"),
        F.lit(False).alias("is_exchange"), F.lit(False).alias("is_ai_agent"), F.col("n").alias("entity_name"), F.lit("scam").alias("category"), F.col("u").alias("source_url"), F.coalesce("date", F.lit("")).alias("source_date"),
    )


def label_list(docs: DataFrame) -> DataFrame:
    """A label list in any of its three layouts (list; lists by category; objects by address) as rows with
    idx, address, label, nameTag, name, category, chainId. docs: body."""
    field = lambda c: F.try_variant_get("v", f"$.{c}", "string").alias(c)
    root = docs.select(F.try_parse_json("body").alias("root"))
    top = root.selectExpr("schema_of_variant(root) as kind", "root").selectExpr("kind", "root", "posexplode(case when kind like 'ARRAY%' then try_variant_get(root, '$', 'array<variant>') end) as (idx, v)")
    listed = top.select(F.col("idx").cast("long").alias("idx"), F.lit(None).cast("string").alias("key"), "v")
    entries = root.where("schema_of_variant(root) like 'OBJECT%'").select(F.map_entries(F.expr("try_variant_get(root, '$', 'map<string,variant>')")).alias("entries"))
    sizes = F.expr("transform(entries, e -> cast(coalesce(nullif(size(try_variant_get(e.value, '$', 'array<variant>')), -1), 0) as bigint))")
    totals = entries.withColumn("sizes", sizes).withColumn("totals", running(F.col("sizes"), F.size("sizes"), lambda a, b: a + b, F.lit(0).cast("long")))
    pairs = totals.select("sizes", "totals", F.posexplode("entries").alias("p", "e")).select("p", (F.expr("totals[p]") - F.expr("sizes[p]")).alias("before"), F.col("e.key").alias("key"), F.col("e.value").alias("v"))
    grouped = pairs.where("schema_of_variant(v) like 'ARRAY%'").selectExpr("p", "key", "before", "posexplode(try_variant_get(v, '$', 'array<variant>')) as (q, w)").select((F.col("before") + F.col("q")).alias("idx"), F.col("key"), F.col("w").alias("v")).withColumn("by", F.lit("category"))
    keyed = pairs.where("schema_of_variant(v) like 'OBJECT%'").select(F.col("p").cast("long").alias("idx"), "key", "v").withColumn("by", F.lit("address"))
    rows = listed.withColumn("by", F.lit("list")).unionByName(grouped).unionByName(keyed)
    out = rows.select("idx", "by", "key", *[field(c) for c in ("address", "label", "nameTag", "name", "category")], F.try_variant_get("v", "$.chainId", "int").alias("chainId"))
    return out.select("idx", F.when(F.col("by") == "address", F.coalesce("address", "key")).otherwise(F.col("address")).alias("address"), "label", "nameTag", "name", F.when(F.col("by") == "category", F.coalesce("category", "key")).otherwise(F.col("category")).alias("category"), "chainId")


def checkout(spark: SparkSession, root: str) -> DataFrame:
    """Project files of a checkout for bridges.registry: path, project, body (tvs.json), declaration
    (the .ts file of the same folder and name, null without one) and ord."""
    folder = F.regexp_extract("path", r"^(.*)/[^/]+\z", 1)
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body")).withColumn("folder", folder)
    name = F.substring_index("folder", "/", -1)
    tvs = files.where(F.endswith("path", F.lit("/tvs.json"))).withColumn("project", F.coalesce(F.get_json_object("body", "$.projectId"), name))
    source = files.where(F.endswith("path", F.concat(F.lit("/"), name, F.lit(".ts")))).select("folder", F.col("body").alias("declaration"))
    return tvs.join(source, "folder", "left").select("path", "project", "body", "declaration", F.col("path").alias("ord"))


def fresh(files: DataFrame, hours: float) -> DataFrame:
    """Files of a cache that are younger than so many hours; none is too old if hours is 0 or less.
    files: path and modified (a timestamp)."""
    return files if hours <= 0 else files.where((F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("modified")) <= hours * 3600)


def action_links(indexes: DataFrame) -> DataFrame:
    """Sorted distinct links to action pages, of index pages and of a site map."""
    both = F.concat(links(F.col("body"), r'href="(/recent-actions/[0-9a-zA-Z_\-\.]+)"'), links(F.col("body"), r"<loc>https://ofac\.treasury\.gov(/recent-actions/[0-9a-zA-Z_\-\.]+)</loc>"))
    return indexes.select(F.explode(both).alias("link")).distinct().orderBy("link")


def cached_pages(spark: SparkSession, folder: str, wanted: DataFrame, least: int = 500) -> DataFrame:
    """link and html of the wanted links that have a cached page (named by the link's sha1) of some size."""
    pages = read_texts(spark, folder).select(F.regexp_extract("path", r"([^/]+?)(?:\.html)?\z", 1).alias("name"), F.col("body").alias("html")).where(F.octet_length("html") > least)
    return wanted.withColumn("name", F.sha1("link")).join(pages, "name").select("link", "html")
