"""Queries of addresses, screening, the store, standing and the label set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import address as A
from ..functions import base58, dates
from ..functions import chains as C
from ..operators import dedupe, gates, ingest, label_set, standing, store
from ..schema import CATEGORIES, LICENCE_STATES
from .catalog import query
from .derive import CHAINS, chain_sql, evm, evm_sql, in_sql, pick, pick_sql, raw_records, screened_sql, table

ISO = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
SET_CASES = " ".join(f"when '{k}' then '{v}'" for k, v in C.SET_ALIASES.items())
_NAMED = pick_sql(CHAINS, "c_custkey")


@query(f"""with t as (select c_custkey, {_NAMED} as raw, case when c_custkey % 2 = 0 then {evm_sql('c_custkey')} else 'plain' || c_custkey end as a from customer)
select c_custkey, {chain_sql('raw', 'a')} as chain, ({chain_sql('raw', 'a')}) in {in_sql(C.STORE_CHAINS)} as known,
  case lower(trim(raw)) {SET_CASES} else lower(trim(raw)) end as set_chain from t""")
def chain_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    raw, address = pick(CHAINS, k), F.when(k % 2 == 0, evm(k)).otherwise(F.concat(F.lit("plain"), k.cast("string")))
    chain = C.store_chain(raw, address)
    return table(spark, sf_dir, "customer", "c_custkey").select(k, chain.alias("chain"), C.is_canonical_chain(chain).alias("known"), C.set_chain(raw).alias("set_chain"))


_CASED = f"case c_custkey % 4 when 0 then ' 0x' || upper(substr({evm_sql('c_custkey')}, 3)) || ' ' when 1 then 'BC1' || upper(md5(c_custkey::varchar)) when 2 then '1' || md5(c_custkey::varchar) else 'bc1Q' || md5(c_custkey::varchar) end"
_LIST = in_sql(A.CASE_SENSITIVE)


@query(f"""with t as (select c_custkey, {_CASED} as raw, case when c_custkey % 8 < 4 then 'btc' else 'eth' end as chain from customer),
u as (select *, trim(raw) as a, regexp_matches(trim(raw), '^0x[0-9a-fA-F]{{40}}$') as is_evm, regexp_matches(lower(trim(raw)), '^(bc1|tb1|ltc1)') as is_bech from t)
select c_custkey, case when is_evm or (is_bech and (a = lower(a) or a = upper(a))) then lower(a) else a end as canonical,
  not is_evm and not is_bech and chain in {_LIST} as case_sensitive, not is_evm and not is_bech and chain in {_LIST} and a = lower(a) and lower(a) <> upper(a) as destroyed from u""")
def address_canonical_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    digest = F.md5(k.cast("string"))
    raw = (
        F.when(k % 4 == 0, F.concat(F.lit(" 0x"), F.upper(F.substring(evm(k), 3, 40)), F.lit(" "))).when(k % 4 == 1, F.concat(F.lit("BC1"), F.upper(digest)))
        .when(k % 4 == 2, F.concat(F.lit("1"), digest)).otherwise(F.concat(F.lit("bc1Q"), digest))
    )
    chain = F.when(k % 8 < 4, "btc").otherwise("eth")
    return table(spark, sf_dir, "customer", "c_custkey").select(k, A.canonical_case(raw).alias("canonical"), A.is_case_sensitive_form(raw, chain).alias("case_sensitive"), A.is_case_destroyed(raw, chain).alias("destroyed"))


@query(f"select c_custkey, {evm_sql('c_custkey')} as hexed, true as same, 'tron' as chain, 34 as n_chars, 'T' as first from customer")
def base58_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tron forms of derived addresses and back; the flag says whether the round trip holds. Keys are few bytes and the
    forms dear, so keys are dealt over all tasks first: a small file would be one task's."""
    k = F.col("c_custkey")
    keys = table(spark, sf_dir, "customer", "c_custkey").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), k)
    rows = keys.select(k, evm(k).alias("hexed"), base58.hex_to_tron(evm(k)).alias("tron"))
    return rows.select("c_custkey", "hexed", (base58.tron_to_hex(F.col("tron")) == F.col("hexed")).alias("same"), A.chain_by_form(F.col("tron")).alias("chain"), F.char_length("tron").alias("n_chars"), F.left("tron", F.lit(1)).alias("first"))


@query(f"""{screened_sql()} select file, reject_reason, count(*)::bigint as n from screened where reject_reason is not null group by all""")
def reject_cascade_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.reject_counts(ingest.screen(raw_records(spark, sf_dir)), "file").select("file", "reject_reason", "n")


_DATED = f"length(trim(source_date)) > 10 and regexp_matches(substr(trim(source_date), 1, 10), '{ISO}')"
_ALIGNED = f"""aligned as (select * replace (
    case when category in {in_sql(CATEGORIES)} then category end as category, case when license_status in {in_sql(LICENCE_STATES)} then license_status end as license_status,
    case when {_DATED} then substr(trim(source_date), 1, 10) when regexp_matches(trim(source_date), '{ISO}') then source_date end as source_date),
  coalesce(category not in {in_sql(CATEGORIES)}, false) as s_category, coalesce(license_status not in {in_sql(LICENCE_STATES)}, false) as s_status,
  coalesce({_DATED}, false) as s_date, coalesce(not ({_DATED}) and not regexp_matches(trim(source_date), '{ISO}'), false) as s_null
  from screened where reject_reason is null)"""


@query(f"""{screened_sql()}, {_ALIGNED} select count(*) filter (where s_category)::bigint as category_stashed, count(*) filter (where s_status)::bigint as license_status_stashed,
  count(*) filter (where s_date)::bigint as date_truncated, count(*) filter (where s_null)::bigint as date_invalid_nulled, count(*)::bigint as n from aligned""")
def align_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("category_stashed", "license_status_stashed", "date_truncated", "date_invalid_nulled")
    return accepted(spark, sf_dir).agg(*[F.count_if(c).alias(c) for c in names], F.count("*").alias("n"))


def accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Screened and aligned records, keyed by their storage address."""
    rows = ingest.screen(raw_records(spark, sf_dir)).where("reject_reason is null")
    return ingest.align(rows).withColumn("address", F.col("key")).drop("key")


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.merge(accepted(spark, sf_dir))


def _scalar(f: str) -> str:
    first = f"arg_min({f}, ord) filter (where {{}} {f} <> '')"
    some = f"max(case when {{}} {f} is not null then '' end)"
    late = f"coalesce({first.format('ord >= promoted and')}, {some.format('ord >= promoted and')})"
    every = f"coalesce({first.format('')}, {some.format('')})"
    return f"case when min(promoted) > min(first) and max(case when ord = promoted then {f} end) is not null then {late} else {every} end as {f}"


_FOLD = f"""marked as (select *, min(ord) over (partition by key) as first, min(case when sanctioned then ord end) over (partition by key) as promoted from aligned)"""


@query(f"""{screened_sql()}, {_ALIGNED}, {_FOLD}
select key as address, arg_min(chain, ord) as chain, coalesce(bool_or(sanctioned), false) as sanctioned, coalesce(bool_or(is_illicit), false) as is_illicit, coalesce(bool_or(is_exchange), false) as is_exchange,
  {', '.join(_scalar(f) for f in ('entity_name', 'category', 'jurisdiction', 'license_status', 'sanctions_reference', 'source_url', 'source_date'))}, count(*)::bigint as n_records
from marked group by key""")
def unified_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store: one record for each address."""
    names = ("address", "chain", "sanctioned", "is_illicit", "is_exchange", "entity_name", "category", "jurisdiction", "license_status", "sanctions_reference", "source_url", "source_date", "n_records")
    return merged(spark, sf_dir).select(*names)


@query(f"""{screened_sql()}, {_ALIGNED},
labels as (select key, ord, l_name, l_source, l_chain, l_url, min(ord) over (partition by key) as first, row_number() over (partition by key, l_name, l_source, l_chain, l_url order by ord) as rank,
  from aligned where l_kept)
select key as address, string_agg(l_name || ':' || l_source || ':' || coalesce(l_chain, '-'), '|' order by ord) as labels, count(*)::bigint as n from labels where rank = 1 or ord = first group by key""")
def label_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = store.united_labels(accepted(spark, sf_dir))
    spelt = F.array_join(F.transform("labels", lambda x: F.concat_ws(":", x["name"], x["source"], F.coalesce(x["chain"], F.lit("-")))), "|")
    return rows.select("address", spelt.alias("labels"), F.size("labels").cast("long").alias("n"))


@query(f"""{screened_sql()}, {_ALIGNED}, firsts as (select key, x_key, arg_min(x_value, ord) as v from aligned group by all),
stashed as (select key, '_category_raw' as x_key, category_raw as v from (select s.key, arg_min(s.category, s.ord) as category_raw from screened s where s.reject_reason is null and s.category not in {in_sql(CATEGORIES)} group by 1))
select key as address, string_agg(x_key || '=' || v, ',' order by x_key) as extras from (select * from firsts union all select * from stashed) group by key""")
def extras_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = store.united_extras(accepted(spark, sf_dir))
    own = F.filter(F.array_sort(F.map_entries("extras")), lambda e: e["key"].rlike("^_(?:k|category)"))
    return rows.select("address", F.array_join(F.transform(own, lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("extras"))


_UNION = """labels as (select *, min(ord) over (partition by key) as first, row_number() over (partition by key, l_name, l_source, l_chain, l_url order by ord) as rank from aligned where l_kept)"""
_STANDING = f"""{_UNION}, votes as (select key, l_day, case l_action when 'designation' then 2 when 'change' then 1 else 0 end as p, l_source, l_type, ord from labels where rank = 1 or ord = first),
status as (select key, case when max(l_day) filter (where l_source = 'ofac_press_release') is null then null
    when arg_max(p, l_day || p) filter (where l_source = 'ofac_press_release') = 0 then 'removed' else 'listed' end as press_status,
  bool_or(l_type = 'sanctioned' and l_source <> 'ofac_press_release') as elsewhere,
  bool_or(l_source <> 'ofac_press_release' and (l_type in ('sanctioned', 'phishing') or l_source = 'crypto_rekts')) as illicit from votes group by key)"""


@query(f"""{screened_sql()}, {_ALIGNED}, {_FOLD}, folded as (select key, coalesce(bool_or(sanctioned), false) as s, coalesce(bool_or(is_illicit), false) as i from marked group by key), {_STANDING}
select f.key as address, press_status, case when press_status is null then s when press_status = 'listed' or elsewhere then true else false end as sanctioned,
  case when press_status is null then i when press_status = 'listed' or elsewhere then true else coalesce(illicit, false) end as is_illicit from folded f left join status using (key)""")
def standing_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standing.reconcile(merged(spark, sf_dir)).select("address", "press_status", "sanctioned", "is_illicit")


def batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as an attribution batch."""
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").select(
        o.alias("ord"), pick(("ethereum", "ETH", "xdai", "base", "", "unheard"), o).alias("chain"), F.when(o % 11 == 0, "").when(o % 13 == 0, F.concat(F.lit("a::"), c.cast("string"))).otherwise(evm(c)).alias("address"),
        F.when(o % 7 > 0, F.array(F.col("o_orderstatus"), F.col("o_orderpriority"))).alias("classes"), F.lit("a").alias("anchor_type"), F.lit("m").alias("method"),
        F.when(o % 5 > 0, "https://u").alias("source_url"), F.lit("2024-01-01").alias("source_date"), F.lit(None).cast("string").alias("note"),
    )


def base_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    none = F.lit(None).cast("string")
    return table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment").where("c_custkey % 3 = 0").select(
        F.lit("eth").alias("chain"), evm(c).alias("address"), F.array("c_mktsegment").alias("classes"), F.array(F.lit("base")).alias("sources"), F.array(F.lit("base")).alias("origins"),
        F.concat(F.lit("eth:"), evm(c)).alias("graph_key"), F.lit(False).alias("case_broken"), none.alias("case_provenance"), none.alias("label_addr_original"), F.lit(True).alias("in_included_5"), F.array().cast("array<string>").alias("provenance"),
    )


_BATCH = f"""batch as (select o_orderkey as ord, {pick_sql(('ethereum', 'ETH', 'xdai', 'base', '', 'unheard'), 'o_orderkey')} as raw, o_orderstatus, o_orderpriority,
    case when o_orderkey % 11 = 0 then '' when o_orderkey % 13 = 0 then 'a::' || o_custkey else {evm_sql('o_custkey')} end as address from orders),
judged as (select *, case lower(trim(raw)) {SET_CASES} else lower(trim(raw)) end as chain, case when address = '' then 'no address' when address like '%::%' then 'synthetic ''::'' key (no on-chain address)'
    when raw = '' then 'no chain' when ord % 5 = 0 then 'missing source_url/source_date provenance' when ord % 7 = 0 then 'no classes' end as reject_reason from batch)"""


@query(f"""with {_BATCH}, rows as (
  select chain, address, o_orderstatus as class, ord, 1 as entry from judged where reject_reason is null union all select chain, address, o_orderpriority, ord, 0 from judged where reject_reason is null
  union all select 'eth', {evm_sql('c_custkey')}, c_mktsegment, -1, 0 from customer where c_custkey % 3 = 0)
select chain, address, string_agg(distinct class, ',' order by class) as classes, sum(entry)::bigint as n_provenance, min(ord) >= 0 as is_new, chain in {in_sql(C.SET_INCLUDED)} as in_included_5 from rows group by all""")
def label_set_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = label_set.merge_batch(base_set(spark, sf_dir), label_set.screen(batch(spark, sf_dir)), "b1", "2024-01-01T00:00:00Z")
    return rows.select("chain", "address", F.array_join("classes", ",").alias("classes"), F.size("provenance").cast("long").alias("n_provenance"), "is_new", "in_included_5")


@query(f"""with {_BATCH} select reject_reason, count(*)::bigint as n from judged where reject_reason is not null group by all""")
def label_set_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_set.screen(batch(spark, sf_dir)).where("reject_reason is not null").groupBy("reject_reason").agg(F.count("*").alias("n"))


@query(f"""with {_BATCH} select count(*)::bigint as n_lost from (select {evm_sql('c_custkey')} as a from customer where c_custkey % 3 = 0) b
where a not in (select address from judged where reject_reason is null and chain = 'eth' union all select {evm_sql('c_custkey')} from customer where c_custkey % 3 = 0)""")
def label_set_append_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = base_set(spark, sf_dir)
    rows = label_set.merge_batch(base, label_set.screen(batch(spark, sf_dir)), "b1", "2024-01-01T00:00:00Z")
    return base.join(rows, ["chain", "address"], "left_anti").agg(F.count("*").alias("n_lost"))


@query("""select coalesce(a.k, b.k) as o_orderpriority, coalesce(a.n, 0)::bigint as before, coalesce(b.n, 0)::bigint as after, (coalesce(b.n, 0) - coalesce(a.n, 0))::bigint as delta
from (select o_orderpriority as k, count(*) as n from orders where year(o_orderdate) = 1996 group by 1) a full join (select o_orderpriority as k, count(*) as n from orders where year(o_orderdate) = 1997 group by 1) b on a.k = b.k
where coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def per_class_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders", "o_orderpriority", "o_orderdate")
    return dedupe.delta(rows.where("year(o_orderdate) = 1996"), rows.where("year(o_orderdate) = 1997"), "o_orderpriority")


@query("""with a as (select distinct doc_id as k from labels), b as (select distinct doc_id as k from documents where doc_id % 2 = 0)
select (select count(*) from (select k from a union select k from b))::bigint as total, (select count(*) from (select k from a intersect select k from b))::bigint as both,
  (select count(*) from (select k from a except select k from b))::bigint as only_a, (select count(*) from (select k from b except select k from a))::bigint as only_b""")
def overlap_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.overlap(table(spark, sf_dir, "labels", "doc_id"), table(spark, sf_dir, "documents", "doc_id").where("doc_id % 2 = 0"), "doc_id")


@query("select user_id, arg_min(event_type, event_id) as first_type, arg_max(event_type, event_id) as last_type from events group by 1")
def first_and_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events", "event_id", "user_id", "event_type")
    first = dedupe.first_wins(rows, ["user_id"], ["event_id"]).select("user_id", F.col("event_type").alias("first_type"))
    return first.join(dedupe.last_wins(rows, ["user_id"], ["event_id"]).select("user_id", F.col("event_type").alias("last_type")), "user_id")


@query("select p_brand, n from (select p_brand, count(*)::bigint as n, min(p_partkey) as first from part group by 1) order by n desc, first limit 10")
def top_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.top(table(spark, sf_dir, "part", "p_brand", "p_partkey"), "p_brand", 10, "p_partkey")


@query("""select * from (select 'customers' as name, count(*)::double as value, 100.0::double as floor, count(*) >= 100 as passed from customer
union all select 'segments', count(distinct c_mktsegment)::double, 9.0, count(distinct c_mktsegment) >= 9 from customer)""")
def gate_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.measure(table(spark, sf_dir, "customer"), [gates.Gate("customers", F.count("*"), 100), gates.Gate("segments", F.count_distinct("c_mktsegment"), 9)])


_WRITTEN = "case o_orderkey % 4 when 0 then strftime(o_orderdate, '%d/%m/%Y') when 1 then strftime(o_orderdate, '%Y-%m-%d') when 2 then strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') else 'soon' end"


@query(f"select o_orderkey, case when o_orderkey % 4 < 3 then strftime(o_orderdate, '%Y-%m-%d') end as day from (select o_orderkey, o_orderdate, {_WRITTEN} as w from orders)")
def date_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, d = F.col("o_orderkey"), F.col("o_orderdate")
    written = F.when(o % 4 == 0, F.date_format(d, "dd/MM/yyyy")).when(o % 4 == 1, F.date_format(d, "yyyy-MM-dd")).when(o % 4 == 2, F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T00:00:00Z"))).otherwise("soon")
    return table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate").select("o_orderkey", dates.any_date(written).alias("day"))
