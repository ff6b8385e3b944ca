"""Queries of names, the directory, the address mapping, tag packs, mixers and bridges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import base58, names
from ..operators import bridges, directory, mixers, store, tagpack, vasp_map
from ..schema import LABEL
from .catalog import query
from .derive import evm, evm_sql, in_sql, pick, pick_sql, table

_ROOTS = (" 14", " #3", ".com", " Hot Wallet", ": Deposit 2", " Exchange Reserve", "-", "", " Wallet" * 11)
_ROLES = "( Hot Wallet| Cold Wallet| Cold Storage| Hot Storage| Deposit| Settlement| Trading| Exchange| Reserve| Wallet)+$"


@query(f"""with t as (select p_partkey, p_brand || {pick_sql(_ROOTS, 'p_partkey')} as name from part),
u as (select p_partkey, trim(regexp_replace(name, '\\s+#?[0-9]{{1,4}}\\s*$', '')) as a from t),
v as (select p_partkey, case when a like '%.com' and length(a) > 5 then left(a, length(a) - 4) else a end as b from u)
select p_partkey, trim(regexp_replace(regexp_replace(trim(regexp_replace(b, '{_ROLES}', '')), ':+$', ''), '-+$', '')) as root from v""")
def entity_root_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat("p_brand", pick(_ROOTS, F.col("p_partkey")))
    return table(spark, sf_dir, "part", "p_partkey", "p_brand").select("p_partkey", names.entity_root(name).alias("root"))


_LEGAL = (" Ltd.", ", Inc", " GmbH", " Holdings Group", " Trust Company", " B.V.", "", " Group" * 40)


@query(f"""with t as (select p_partkey, upper(p_name) || {pick_sql(_LEGAL, 'p_partkey')} as name from part),
u as (select p_partkey, regexp_replace(lower(name), '[,/_]', ' ', 'g') as s from t),
v as (select p_partkey, case when s like '%ltd.' then left(s, length(s) - 4) when s like '%  inc' then left(s, length(s) - 5) when s like '% gmbh' then left(s, length(s) - 5)
  when s like '%holdings group' then left(s, length(s) - 15) when s like '% group group' then regexp_replace(s, '( group)+$', '') when s like '%trust company' then left(s, length(s) - 14) else s end as s from u)
select p_partkey, trim(regexp_replace(regexp_replace(s, '[^a-z0-9_\\s]', ' ', 'g'), '\\s+', ' ', 'g')) as normal from v""")
def name_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.upper("p_name"), pick(_LEGAL, F.col("p_partkey")))
    return table(spark, sf_dir, "part", "p_partkey", "p_name").select("p_partkey", names.normalize_name(name).alias("normal"))


_LABELS = (": Hot Wallet", " 14", "-Cold", " (old)", ": Deposit 7", "")


@query(f"""with t as (select p_partkey, p_name || {pick_sql(_LABELS, 'p_partkey')} as s from part)
select p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(lower(s), '\\s*[:\\-]\\s*[a-z0-9].*$', ''), '\\s+[0-9]+$', ''), '\\s*\\([^)]+\\)$', '')) as brand from t""")
def label_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part", "p_partkey", "p_name").select("p_partkey", names.label_brand(F.concat("p_name", pick(_LABELS, F.col("p_partkey")))).alias("brand"))


#: Alias rules of the queries, in their order: what a deployment passes as its own table.
RULES = [("small", "mini"), ("widget", "widget_co"), ("red", "red_group"), ("bolt", "bolt_ag"), ("large", "large_inc")]
_ALIAS = "case " + " ".join(f"when {{c}} like '%{n}%' then 'alias::{i}'" for n, i in RULES) + " end"


@query(f"select p_partkey, {_ALIAS.format(c='p_name')} as id from part")
def alias_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part", "p_partkey", "p_name").select("p_partkey", names.first_alias(F.col("p_name"), RULES).alias("id"))


_JUNK = ("Huobi Foundation", "Binance OKX Ltd", "Gemini Trust", "OKXLE", "Plain Co", "Crypto Capital")


@query(f"select c_custkey, {pick_sql(_JUNK, 'c_custkey')} in ('Huobi Foundation', 'Binance OKX Ltd', 'OKXLE', 'Crypto Capital') as junk from customer")
def junk_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer", "c_custkey").select("c_custkey", names.is_junk_name(pick(_JUNK, F.col("c_custkey"))).alias("junk"))


_TAGS = tuple(directory.REGISTERS)


def registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier x part as register records: names of parts, nations as jurisdictions."""
    p = F.col("p_partkey")
    rows = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_size")
    return rows.select(
        p.alias("ord"), pick(_TAGS, p).alias("register"), F.concat(F.lit("x::"), p.cast("string")).alias("address"), F.when(p % 9 > 0, F.col("p_name")).otherwise(F.concat("p_name", F.lit(" Foundation"))).alias("entity_name"),
        F.when(p % 10 > 0, pick(("DE", "FR", "US", "GB", "SG"), p)).alias("jurisdiction"), F.when(p % 3 > 0, F.concat(F.lit("L"), p.cast("string"))).alias("license_id"),
        F.when(p % 4 == 0, "ESMA  (EU)").when(p % 4 == 1, "ESMA (EU)").otherwise(F.col("p_brand")).alias("regulator"), F.lit("active").alias("license_status"), F.lit("https://r").alias("source_url"),
        F.when(p % 6 == 0, F.create_map(F.lit("_esma_lei"), F.lpad(F.col("p_size").cast("string"), 20, "0"))).otherwise(F.create_map(F.lit("_fca_mlr_effective_date"), F.lit("2020-01-01"))).alias("extras"),
    )


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return directory.build(directory.identify(registered(spark, sf_dir), RULES, {}, {}))


_REG = f"""reg as (select p_partkey as ord, {pick_sql(_TAGS, 'p_partkey')} as register, case when p_partkey % 9 > 0 then p_name else p_name || ' Foundation' end as entity_name,
  case when p_partkey % 10 > 0 then {pick_sql(('DE', 'FR', 'US', 'GB', 'SG'), 'p_partkey')} end as jurisdiction, case when p_partkey % 4 in (0, 1) then 'ESMA (EU)' else p_brand end as regulator,
  case when p_partkey % 6 = 0 then lpad(p_size::varchar, 20, '0') else '' end as lei, case when p_partkey % 6 <> 0 then '2020-01-01' end as license_date from part),
ids as (select *, coalesce({_ALIAS.format(c='lower(entity_name)')}, case when length(lei) = 20 then 'lei::' || lei end, 'name::' || lower(entity_name)) as cid from reg)"""


@query(f"""with {_REG}, lic as (select *, row_number() over (partition by cid, jurisdiction, regulator order by ord) as rank from ids),
nam as (select cid, entity_name, row_number() over (partition by cid order by length(entity_name) desc, count(*) desc, min(ord)) as rank from ids group by cid, entity_name)
select l.cid as canonical_id, max(n.entity_name) as name, string_agg(distinct l.jurisdiction, ',' order by l.jurisdiction) filter (where l.rank = 1) as jurisdictions,
  count(*) filter (where l.rank = 1)::bigint as n_licenses, string_agg(distinct l.register, ',' order by l.register) as source_tags, string_agg(distinct nullif(l.lei, ''), ',' order by nullif(l.lei, '')) as leis
from lic l join nam n on n.cid = l.cid and n.rank = 1 group by l.cid""")
def directory_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    spelt = lambda c: F.nullif(F.array_join(c, ","), F.lit("")).alias(c)
    return entities(spark, sf_dir).select("canonical_id", "name", spelt("jurisdictions"), "n_licenses", spelt("source_tags"), spelt("leis"))


@query(f"""with {_REG} select jurisdiction, count(distinct cid)::bigint as n_entities from ids where jurisdiction is not null group by 1""")
def entities_by_jurisdiction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return directory.by_jurisdiction(entities(spark, sf_dir))


@query(f"""with {_REG}, l as (select cid, count(distinct nullif(lei, ''))::bigint as n from ids where cid like 'alias::%' group by 1) select cid as canonical_id, n as n_leis from l where n >= 2""")
def lei_disagreements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return directory.lei_conflicts(entities(spark, sf_dir)).select("canonical_id", F.size("leis").cast("long").alias("n_leis"))


@query(f"""with {_REG} select register, count(*)::bigint as n, count(*) filter (where license_date is null)::bigint as n_null from ids group by 1""")
def licence_date_null_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = registered(spark, sf_dir).select("register", directory.licence()["license_date"].alias("license_date"))
    return directory.null_rates(rows, "register", "license_date").select("register", "n", "n_null")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customers as store records with labels named after parts."""
    c = F.col("c_custkey")
    none = F.lit(None).cast("string")
    one = lambda name, kind, source: F.struct(name.alias("name"), kind.alias("type"), source.alias("source"), F.when(c % 5 > 0, pick(("ethereum", "tron", "base", "dogecoin", "bitcoin"), c)).alias("chain"), none.alias("subtype"), none.alias("chain_evidence"), F.lit(None).alias("context")).cast(LABEL)
    first = one(F.when(c % 4 == 0, "Unheard 7").otherwise(F.concat(pick(("Small Bolt", "Red Rod", "Gemini Binance"), c), F.lit(": Hot Wallet"))), F.when(c % 7 > 0, "exchange").otherwise("other"), pick(("walletexplorer", "ofac", "opensanctions", "nobody"), c))
    second = one(F.lit("Large Gear 2"), F.lit("Exchange"), F.lit("ofac"))
    return table(spark, sf_dir, "customer", "c_custkey").select(c.alias("ord"), evm(c).alias("address"), pick(("ethereum", "arbitrum", "tron"), c).alias("chain"), F.when(c % 3 == 0, F.array(first, second)).otherwise(F.array(first)).alias("labels"))


_LABELLED = f"""lab as (select c_custkey as ord, {evm_sql('c_custkey')} as address, {pick_sql(('ethereum', 'arbitrum', 'tron'), 'c_custkey')} as own, 0 as pos,
    case when c_custkey % 4 = 0 then 'Unheard 7' else {pick_sql(('Small Bolt', 'Red Rod', 'Gemini Binance'), 'c_custkey')} || ': Hot Wallet' end as name, case when c_custkey % 7 > 0 then 'exchange' else 'other' end as type,
    {pick_sql(('walletexplorer', 'ofac', 'opensanctions', 'nobody'), 'c_custkey')} as source, case when c_custkey % 5 > 0 then {pick_sql(('ethereum', 'tron', 'base', 'dogecoin', 'bitcoin'), 'c_custkey')} end as chain from customer
  union all select c_custkey, {evm_sql('c_custkey')}, {pick_sql(('ethereum', 'arbitrum', 'tron'), 'c_custkey')}, 1, 'Large Gear 2', 'Exchange', 'ofac', case when c_custkey % 5 > 0 then {pick_sql(('ethereum', 'tron', 'base', 'dogecoin', 'bitcoin'), 'c_custkey')} end from customer where c_custkey % 3 = 0),
mapped as (select *, case name when 'Unheard 7' then 'name::unheard' when 'Small Bolt: Hot Wallet' then 'alias::mini' when 'Red Rod: Hot Wallet' then 'alias::red_group' when 'Large Gear 2' then 'alias::large_inc' end as cid from lab where lower(type) = 'exchange'),
idx as (select address, any_value(own) as chain, arg_min(cid, pos) filter (where cid is not null) as cid, count(*)::bigint as n_names from mapped group by address)"""
_DIR = f"""{_REG}, dir as (select cid, count(distinct jurisdiction)::bigint as n_jur from ids group by cid)"""


@query(f"""with {_DIR}, {_LABELLED} select i.cid as vasp_canonical_id, n_jur as vasp_n_jurisdictions, address, chain, n_names from idx i join dir using (cid)""")
def vasp_address_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vasp_map.build(entities(spark, sf_dir), vasp_map.label_index(labelled(spark, sf_dir), RULES, {}))
    return rows.select("vasp_canonical_id", F.col("vasp_n_jurisdictions").cast("long").alias("vasp_n_jurisdictions"), "address", "chain", F.size("raw_label_names").cast("long").alias("n_names"))


@query(f"""with {_DIR}, {_LABELLED}, c as (select cid, count(*) as n from idx where cid is not null group by 1)
select coalesce(sum(n), 0)::bigint as n_records, count(n)::bigint as entities_with_addresses, count(*)::bigint as entities_total, count(*) filter (where n_jur >= 2)::bigint as multi_total,
  count(*) filter (where n_jur >= 2 and n is not null)::bigint as multi_with_addresses, count(*) filter (where n_jur >= 2 and n is null)::bigint as multi_without_addresses from dir left join c using (cid)""")
def vasp_map_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vasp_map.coverage(entities(spark, sf_dir), vasp_map.label_index(labelled(spark, sf_dir), RULES, {}))


@query(f"""with {_LABELLED} select case name when 'Gemini Binance: Hot Wallet' then 'gemini binance' end as brand, count(*)::bigint as n from mapped where address in (select address from idx where cid is null) group by 1""")
def unmapped_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vasp_map.unmapped_brands(vasp_map.label_index(labelled(spark, sf_dir), RULES, {}))


_CURRENCY = "case coalesce(chain, own) " + " ".join(f"when '{k}' then '{v}'" for k, v in tagpack.CURRENCIES.items()) + " end"
_SCREENED = f"""{_LABELLED}, tag as (select *, coalesce(chain, own) as c, {_CURRENCY} as currency, case when {_CURRENCY} is null then 'chain' when source in {in_sql(tagpack.EXCLUDED)} then 'licence' when source = 'nobody' then 'unsourced' end as skip from lab)"""


@query(f"with {_SCREENED} select skip as skip_reason, count(*)::bigint as n from tag where skip is not null group by 1")
def tag_skip_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagpack.screen(labelled(spark, sf_dir)).where("skip_reason is not null").groupBy("skip_reason").agg(F.count("*").alias("n"))


_PACK = f"""with {_SCREENED} select address, currency, name as label, case source when 'ofac' then 'https://www.treasury.gov/ofac/downloads/sdn.csv' else 'https://www.walletexplorer.com/' end as source,
  case arg_min(type, ord * 2 + pos) when 'exchange' then 'exchange' end as category, case source when 'ofac' then 'authority_data' else 'unknown' end as confidence,
  case when min(c) not in ('bitcoin', 'ethereum', 'tron', 'litecoin') then '{{"evm_chain": "' || min(c) || '"}}' end as context
from tag where skip is null and currency {{kept}} 'TRX' group by address, currency, name, source"""


@query(_PACK.replace("{kept}", "<>"))
def tag_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags but for Tron ones, whose addresses SQL can't encode."""
    return tagpack.tags(tagpack.screen(labelled(spark, sf_dir))).where("currency != 'TRX'").drop("actor", "place")


@query(_PACK.replace("{kept}", "="))
def tag_pack_tron(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Tron tags, with their addresses decoded again (null for a wrong checksum)."""
    rows = tagpack.tags(tagpack.screen(labelled(spark, sf_dir))).where("currency = 'TRX'").drop("actor", "place")
    return rows.withColumn("address", base58.tron_to_hex(F.col("address")))


@query(f"""with t as (select o_orderkey, case when o_orderkey % 5 = 0 then ' ' else {evm_sql('o_custkey')} end as address, {pick_sql(('ETH', 'TRX', 'BTC'), 'o_orderkey')} as currency,
  case when o_orderkey % 7 = 0 then 'sure' when o_orderkey % 7 = 1 then null else 'heuristic' end as confidence from orders)
select o_orderkey, concat_ws('|', case when trim(address) = '' then 'missing/blank address' end, case when confidence is null then 'no confidence' when confidence = 'sure' then 'confidence outside the taxonomy' end,
  case when currency = 'TRX' and address like '0x%' then 'TRX address in 0x-hex' end) as errors from t""")
def pack_validation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey").select(
        o, F.when(o % 5 == 0, " ").otherwise(evm(F.col("o_custkey"))).alias("address"), pick(("ETH", "TRX", "BTC"), o).alias("currency"), F.lit("l").alias("label"), F.lit("s").alias("source"),
        F.when(o % 7 == 0, "sure").when(o % 7 > 1, "heuristic").alias("confidence"),
    )
    return tagpack.errors(rows).select("o_orderkey", F.array_join("errors", "|").alias("errors"))


@query(f"""with e as (select {evm_sql('c_nationkey')} as address, 'eth' as chain, c_mktsegment as program, case when c_custkey % 2 = 0 then 'op' || c_custkey end as op, 0 as step, c_custkey as pos from customer
  union all select {evm_sql('s_nationkey')}, 'bsc', 'S', 'sup' || s_suppkey, 1, s_suppkey from supplier)
select address, arg_min(chain, step * 1000000000 + pos) as chain, count(distinct program)::bigint as n_programs, arg_min(op, step * 1000000000 + pos) filter (where op is not null) as operator_party, count(*)::bigint as n_sources from e group by address""")
def mixer_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ordered sources folded by address."""
    entry = lambda df, key, nation, chain, program, operator, step: df.select(
        evm(F.col(nation)).alias("address"), F.lit(chain).alias("chain"), F.lit("f").alias("family"), F.array(program).alias("programs"), operator.alias("operator"),
        F.struct(F.lit("ofac_sdn").alias("kind"), *[F.lit(None).cast("string").alias(c) for c in ("fixedref", "feature_id", "feature_type_id")], F.lit(None).cast("int").alias("idx"), *[F.lit(None).cast("string").alias(c) for c in ("label", "name_tag")], F.col(key).cast("string").alias("raw")).cast(mixers.SOURCE).alias("source"),
        F.struct(F.lit(step).alias("step"), F.col(key).alias("pos")).alias("ord"),
    )
    c = entry(table(spark, sf_dir, "customer"), "c_custkey", "c_nationkey", "eth", F.col("c_mktsegment"), F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("op"), F.col("c_custkey").cast("string"))), 0)
    s = entry(table(spark, sf_dir, "supplier"), "s_suppkey", "s_nationkey", "bsc", F.lit("S"), F.concat(F.lit("sup"), F.col("s_suppkey").cast("string")), 1)
    rows = mixers.fold(c.unionByName(s))
    return rows.select("address", "chain", F.size("entity_program_tags").cast("long").alias("n_programs"), "operator_party", F.size("sources").cast("long").alias("n_sources"))


@query(f"""select {evm_sql('s_suppkey')} as address, n_name as lead_project, s_suppkey % 2 = 0 as already_in_mixer_registry from supplier join nation on n_nationkey = s_nationkey where s_suppkey % 3 = 0""")
def mixer_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.upper(evm(F.col("s_suppkey"))).alias("escrow_address"), F.lit(None).cast("string").alias("escrow_address_raw"), F.lit("eth").alias("chain"), F.col("n_name").alias("bridge"),
        F.when(F.col("s_suppkey") % 3 == 0, "Privacy").otherwise("bridge").alias("project_kind"), F.lit("x").alias("project_declared_type"), F.lit("r").alias("source_repo"), F.lit("c").alias("source_commit"),
    )
    known = table(spark, sf_dir, "supplier", "s_suppkey").where("s_suppkey % 2 = 0").select(evm(F.col("s_suppkey")).alias("address"))
    return mixers.delta(rows, known).select("address", "lead_project", "already_in_mixer_registry")


_DECLARED = ("type: 'intent'", "class ScalingProject", "ProjectPrivacyToken", "type: 'denomination'", "nothing")


@query(f"""select o_orderkey as k, {evm_sql('o_custkey')} as escrow_address, {pick_sql(('eth', 'base'), 'o_orderkey')} as chain, {pick_sql(('bridge', 'scaling_l2', 'privacy', 'privacy', 'unknown'), 'o_orderkey')} as kind from orders where o_orderkey % 3 < 2 or o_orderkey % 96 = 2""")
def bridge_escrows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Escrows nested at different depths of JSON documents, up to 1,200 levels, with the kind of their project."""
    o = F.col("o_orderkey")
    inner = F.concat(F.lit('{"type":"balanceOfEscrow","escrowAddress":"'), evm(F.col("o_custkey")), F.lit('","chain":"'), pick(("eth", "base"), o), F.lit('"}'))
    body = F.when(o % 3 == 0, F.concat(F.lit('{"a":[1,{"b":'), inner, F.lit("}]}"))).when(o % 3 == 1, F.concat(F.lit("["), inner, F.lit("]"))).when(o % 96 == 2, F.concat(F.repeat(F.lit("["), 1200), inner, F.repeat(F.lit("]"), 1200))).otherwise('{"type":"other"}')
    docs = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey").select(o.alias("path"), body.alias("body"), bridges.classify(pick(_DECLARED, o))["kind"].alias("kind"))
    return bridges.walk(docs).join(docs.select("path", "kind"), "path").select(F.col("path").alias("k"), "escrow_address", "chain", "kind")


@query("select o_orderkey as k from orders where o_orderkey % 7 in (0, 3)")
def bridge_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that are cut off or have a wrong bracket."""
    o = F.col("o_orderkey")
    whole = F.concat(F.lit('{"a":[1,{"type":"balanceOfEscrow","escrowAddress":"'), evm(F.col("o_custkey")), F.lit('"}]'))
    body = F.when(o % 7 == 0, whole).when(o % 7 == 3, F.concat(whole, F.lit("]"))).otherwise(F.concat(whole, F.lit("}")))
    return bridges.failures(table(spark, sf_dir, "orders", "o_orderkey", "o_custkey").select(o.alias("k"), body.alias("body")), "k").select("k")


@query(f"""with f as (select {evm_sql('c_custkey % 40')} as address, 'Brand' || (c_custkey % 3) as name, c_custkey as ord from customer), s as (select {evm_sql('s_suppkey')} as address from supplier)
select address, s.address is not null as was_there, count(f.name)::bigint as n_labels from f full join s using (address) group by all""")
def spellbook_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    found = table(spark, sf_dir, "customer", "c_custkey").select(evm(c % 40).alias("address"), F.lit("ethereum").alias("chain"), F.concat(F.lit("Brand"), (c % 3).cast("string")).alias("entity_name"), F.lit(None).cast("string").alias("distinct_name"), c.alias("ord"))
    old = table(spark, sf_dir, "supplier", "s_suppkey").select(evm(F.col("s_suppkey")).alias("address"), F.lit("base").alias("chain"), F.array().cast(f"array<{LABEL}>").alias("labels"), *[F.lit(False).alias(x) for x in ("is_exchange", "is_ai_agent", "is_illicit")], F.lit(True).alias("was_there"))
    return store.add_spellbook(old, found).select("address", F.coalesce("was_there", F.lit(False)).alias("was_there"), F.size("labels").cast("long").alias("n_labels"))
