"""Queries of pages, sections, patterns, feeds and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import pages, probe, scan
from ..sources import feeds, ofac, registers
from .catalog import query
from .derive import dealt, evm, evm_sql, pick, pick_sql, table


@query(r"""select page_id, replace(replace(replace(replace(replace(escaped, '&quot;', '"'), '&#39;', chr(39)), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') as title from (select page_id, nullif(trim(regexp_replace(regexp_replace(regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')), '') as escaped from pages)""")
def page_title_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages", "page_id", "html").select("page_id", T.heading(F.col("html")).alias("title"))


@query("""select page_id, link from (select page_id, unnest(list_distinct(regexp_extract_all(html, 'href="([^"]+)"', 1))) as link from pages)""")
def page_link_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages", "page_id", "html").select("page_id", F.explode(T.links(F.col("html"))).alias("link"))


@query("""select event_id, coalesce(last_value(case when event_type = 'signup' then event_id end ignore nulls) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding), -1) as section,
  coalesce(last_value(case when event_type = 'purchase' then value end ignore nulls) over (partition by user_id order by event_id rows between unbounded preceding and current row), -1) as carried from events""")
def section_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last sign-up strictly before each event of a user, and the last purchase carried forward."""
    section = pages.last_before(["user_id"], ["event_id"], F.when(F.col("event_type") == "signup", F.col("event_id")))
    carried = pages.last_upto(["user_id"], ["event_id"], F.when(F.col("event_type") == "purchase", F.col("value")))
    return table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "value").select("event_id", F.coalesce(section, F.lit(-1)).alias("section"), F.coalesce(carried, F.lit(-1.0)).alias("carried"))


_HEADS = ("The following deletions have been made to the List:", "The following individuals have been added to the List:", "The following changes have been made:", "No header here")
_ACTS = ("removal", "designation", "change", None)


@query(f"""select o_orderkey, {evm_sql('o_custkey')} as address, 'ethereum' as chain, 'ticker' as evidence, coalesce({pick_sql(('removal', 'designation', 'change', ''), 'o_orderkey')}, '') as action from orders where o_orderkey % 4 < 3
union all select o_orderkey, {evm_sql('o_custkey')}, 'ethereum', 'ticker', 'designation' from orders where o_orderkey % 4 = 3""")
def page_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses printed under section headers."""
    o = F.col("o_orderkey")
    html = F.concat(F.lit("<p>"), pick(_HEADS, o), F.lit("\n</p> Digital Currency Address - ETH "), evm(F.col("o_custkey")), F.lit("; and more"))
    rows = dealt(table(spark, sf_dir, "orders", "o_orderkey", "o_custkey"), "o_orderkey").select(o.alias("link"), html.alias("html"))
    return pages.address_actions(rows).select(F.col("link").alias("o_orderkey"), "address", "chain", "evidence", "action")


_FAMILIES = {"mail": r"[a-z0-9._%+-]+@[a-z0-9.-]+", "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "secret": r"password=|akia[0-9a-z]+", "licence": r"licensed under|all rights reserved"}


_PROBED = rf"""with d as (select coalesce(text, '') || ' ' || {evm_sql('doc_id % 7')} as t from documents),
f as (select family, t from d join (values {', '.join(f"('{k}', '{v}')" for k, v in _FAMILIES.items())}, ('nobody', 'no such word')) as p(family, pattern) on regexp_matches(lower(t), pattern)),
a as (select family, unnest(list_concat(list_transform(regexp_extract_all(t, '\b0x[a-fA-F0-9]{{40}}\b'), lambda x: lower(x)), regexp_extract_all(t, '\b(?:bc1[a-z0-9]{{25,90}}|[13][a-km-zA-HJ-NP-Z1-9]{{25,34}})\b'))) as address from f)
select family, 'documents' as source, (select count(*) from f where f.family = p.family)::bigint as named_match_count, (select count(distinct address) from a where a.family = p.family)::bigint as distinct_addresses
from (values {', '.join(f"('{k}')" for k in _FAMILIES)}, ('nobody')) as p(family)"""


@query(_PROBED)
def probe_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every family's cell, empty ones too: texts that name it, and the distinct addresses in them."""
    body = F.concat(F.coalesce("text", F.lit("")), F.lit(" "), evm(F.col("doc_id") % 7))
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source").select(body.alias("text"), F.col("source").alias("name"), probe.addresses(body).alias("found"))
    grid = probe.cells(docs, "documents", _FAMILIES | {"nobody": "no such word"}, {})
    return grid.select("family", "source", F.col("named_match_count").cast("long").alias("named_match_count"), F.col("distinct_addresses").cast("long").alias("distinct_addresses"))


@query("""with c as (select n_name as family, count(s_suppkey)::bigint as own, count(s_suppkey) filter (where s_acctbal > 5000)::bigint as named from nation left join supplier on s_nationkey = n_nationkey group by 1)
select family, case when own >= 1 then 'INCLUDE' when named >= 1 then 'BUG_FLAG' else 'CEILING' end as decision from c""")
def probe_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "supplier"), F.col("n_nationkey") == F.col("s_nationkey"), "left")
    grid = rows.groupBy(F.col("n_name").alias("family")).agg(F.lit("ofac_sdn").alias("source"), F.count("s_suppkey").alias("distinct_addresses"), F.count_if(F.expr("s_acctbal > 5000")).alias("named_match_count"))
    return probe.decide(grid, True, True).select("family", "decision")


_PATTERNS = [("mail", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+", "text"), ("key", "AKIA[A-Z0-9]+", "text"), ("joined", "acme-[0-9]+-corp", "text"), ("third", "src3$", "path")]


@query("""with d as (select doc_id, doc_id::varchar || '/' || source as path, text from documents)
select * from (select path, 'mail' as name, regexp_extract(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+', 0) as match, false as obfuscated from d union all select path, 'key', regexp_extract(text, 'AKIA[A-Z0-9]+', 0), false from d
  union all select path, 'joined', 'acme-' || doc_id || '-corp', doc_id % 2 = 0 from d where text is not null union all select path, 'third', regexp_extract(path, 'src3$', 0), false from d) where match <> ''""")
def pattern_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with a word put in, whole or as two literals with a seam, against patterns of texts and paths."""
    k = F.col("doc_id").cast("string")
    put = F.concat(F.lit(' x = "acme-'), F.when(F.col("doc_id") % 2 == 0, F.concat(k, F.lit('-" + "corp"'))).otherwise(F.concat(k, F.lit('-corp"'))))
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text").select(F.concat_ws("/", k, "source").alias("path"), F.concat("text", put).alias("text"))
    return scan.violations(docs, spark.createDataFrame(_PATTERNS, scan.PATTERN)).select("path", "name", "match", "obfuscated")


@query(f"""select c_custkey as sdn_id, 'ETH' as ticker, {evm_sql('c_custkey')} as address, 'ethereum' as chain from customer union all
select c_custkey, 'USDT', {evm_sql('c_custkey + 1')}, 'ethereum' from customer where c_custkey % 2 = 0""")
def sdn_remarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    remark = F.concat(F.lit("DOB 1970; Digital Currency Address - ETH 0x"), F.upper(F.substring(evm(c), 3, 40)), F.when(c % 2 == 0, F.concat(F.lit("; alt. Digital Currency Address - USDT "), evm(c + 1), F.lit("."))).otherwise("; more"))
    rows = table(spark, sf_dir, "customer", "c_custkey", "c_name").select(c.alias("sdn_id"), F.col("c_name").alias("entity_name"), F.lit('"individual"').alias("entity_type"), F.lit("P").alias("programs"), remark.alias("remarks"))
    return ofac.addresses(rows.withColumn("sdn_id", F.col("sdn_id").cast("string"))).select(F.col("sdn_id").cast("long").alias("sdn_id"), "ticker", "address", "chain")


_TOPICS, _SETS = ("sanction", "crime.theft", "role.pep", "crime"), ("us_ofac_sdn", "ransomwhere", "interpol_red", "wikidata")


@query(f"""with t as (select c_custkey, {pick_sql(_TOPICS, 'c_custkey')} as topic, {pick_sql(_SETS, 'c_custkey // 4')} as ds from customer)
select c_custkey, case when topic = 'sanction' or ds = 'us_ofac_sdn' then 'sanctioned' when ds = 'ransomwhere' or topic in ('crime.theft', 'crime') or ds = 'interpol_red' then 'illicit' else 'vasp' end as type,
  case when topic = 'sanction' or ds = 'us_ofac_sdn' then null when ds = 'ransomwhere' then 'ransomware' when topic = 'crime.theft' then 'theft' when topic = 'crime' then 'crime' when ds = 'interpol_red' then 'unspecified' end as subtype from t""")
def wallet_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    kind = feeds.wallet_kind(F.array(pick(_TOPICS, c)), F.array(pick(_SETS, F.floor(c / 4))))
    return table(spark, sf_dir, "customer", "c_custkey").select("c_custkey", kind["type"].alias("type"), kind["subtype"].alias("subtype"))


@query(f"""with h as (select c_custkey, c_nationkey, n_name from customer join nation on n_nationkey = c_nationkey)
select {evm_sql('c_custkey')} as address, 'ethereum' as chain, coalesce(n_name, 'w' || c_custkey) as entity_name from h""")
def holder_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wallets with their holder's name: the first holder that is an entity."""
    kind = f"struct<{feeds.ENTITY.split('struct<')[1]}"
    props = lambda **k: F.struct(*[k.get(c, F.lit(None).cast("array<string>")).alias(c) for c in ("name", "alias", "weakAlias", "holder", "publicKey", "topics", "createdAt")]).cast(kind).alias("properties")
    entity = lambda df, ident, schema, p: df.select(ident.alias("id"), F.lit(None).cast("string").alias("caption"), F.lit(schema).alias("schema"), F.array().cast("array<string>").alias("datasets"), F.lit("2020-01-01").alias("first_seen"), F.lit("").alias("last_change"), p)
    c = F.col("c_custkey")
    wallet = entity(table(spark, sf_dir, "customer"), F.concat(F.lit("w"), c.cast("string")), "CryptoWallet", props(holder=F.array(F.lit("nobody"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string"))), publicKey=F.array(evm(c))))
    owner = entity(table(spark, sf_dir, "nation"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string")), "Company", props(name=F.array("n_name")))
    return feeds.wallets(wallet.unionByName(owner), "https://x").select("address", "chain", "entity_name")


_NETS = ("Avax", "BNB Chain", "Tron", "Other", "xDai")


@query(f"""with t as (select c_custkey, {pick_sql(_NETS, 'c_custkey')} as net from customer)
select c_custkey as k, {evm_sql('c_custkey')} as address, case net when 'Avax' then 'avalanche_c' when 'BNB Chain' then 'bsc' when 'xDai' then 'gnosis' else 'evm' end as chain from t
union all select c_custkey, {evm_sql('c_custkey + 1')}, case net when 'Avax' then 'avalanche_c' when 'BNB Chain' then 'bsc' else 'gnosis' end from t where net in ('Avax', 'BNB Chain', 'xDai')""")
def incident_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    nets = F.array(F.struct(F.struct(pick(_NETS, c).alias("name")).alias("networks"))).cast("array<struct<networks:struct<name:string>>>")
    rows = table(spark, sf_dir, "customer", "c_custkey").select(
        c.cast("string").alias("id"), F.concat(F.lit("p"), c.cast("string")).alias("project_name"), F.lit(None).cast("string").alias("title"), F.lit("2021-01-01").alias("date"), F.lit("").alias("proof_link"),
        F.lit("").alias("webarchive_link"), evm(c).alias("token_address"), F.concat(F.lit("<p>see "), evm(c + 1), F.lit(" there")).alias("description"), F.struct(F.lit("Rugpull").alias("type")).alias("scam_type"), nets.alias("scamNetworks"),
        F.lit(None).cast("array<string>").alias("token_addresses"),
    )
    return feeds.incidents(rows).select(F.substring("entity_name", 2, 20).cast("long").alias("k"), "address", "chain")


@query(f"""select p_partkey as k, {evm_sql('p_partkey')} as address, 'ethereum' as chain, p_brand as entity_name, 'exchange' as category from part union all
select p_partkey, {evm_sql('p_partkey + 1')}, 'bnb', p_name, p_type from part""")
def spellbook_tuples(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_partkey")
    body = F.concat(F.lit("VALUES\n("), evm(p), F.lit(", '"), F.col("p_brand"), F.lit("', '', 'x', date '2020-01-01'),\n( 'bnb', "), evm(p + 1), F.lit(", '"), F.col("p_name"), F.lit("', '"), F.col("p_type"), F.lit("', 1)"))
    rows = feeds.spellbook(table(spark, sf_dir, "part").select(p.cast("string").alias("path"), body.alias("body")))
    return rows.select(F.col("source_file").cast("long").alias("k"), "address", "chain", "entity_name", "category")


_STATES = ("Active", "Issued ", "WITHDRAWN", "suspended", "IPA", "", "other", "still active")


@query(f"select s_suppkey, {pick_sql(('active', 'active', 'revoked', 'suspended', 'pending', 'active', 'other', 'active'), 's_suppkey')} as status from supplier")
def status_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier", "s_suppkey").select("s_suppkey", registers.normalize_status(pick(_STATES, F.col("s_suppkey"))).alias("status"))


@query(f"""select p_partkey, {pick_sql(tuple(registers.VARA_ACTIVITIES), 'p_partkey')} || ' [a]|' || {pick_sql(tuple(registers.VARA_ACTIVITIES), 'p_size')} as activities from part""")
def activity_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concatenated activities taken apart at the starts of known phrases."""
    words = registers.VARA_ACTIVITIES
    joined = F.concat(F.lit("x "), pick(tuple(words), F.col("p_partkey")), F.lit(" [a],"), pick(tuple(words), F.col("p_size")))
    return table(spark, sf_dir, "part", "p_partkey", "p_size").select("p_partkey", F.array_join(T.split_at_starts(joined, words), "|").alias("activities"))


_MSB = "lower(' ' || p_name || ' | ' || p_brand || ' ')"


@query(f"select p_partkey, {_MSB} like '%widget%' or {_MSB} like '%wallet%' as crypto from part")
def msb_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("legal_name"), F.col("p_brand").alias("dba_name"))
    return rows.select("p_partkey", registers.is_crypto_msb(["widget"]).alias("crypto"))


