"""Addresses and records derived from the star schema, the same in Spark and in SQL.

The driver's tables hold no wallet addresses; the queries apply the operators to these derivations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHAINS = ("eth", "Avax", "xdai", "bnb", " Polygon ", "TRX", "btc", "dogechain", "ripple", "")
SOURCES = ("ofac_press_release", "walletexplorer", "crypto_rekts", "opensanctions", "tronscan_public")
TYPES = ("sanctioned", "exchange", "other", "mixer", "phishing")
ACTIONS = ("designation", "change", "removal")


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns or "*")


def dealt(rows: DataFrame, key: str) -> DataFrame:
    """Rows dealt over all tasks by key: a small file is one task, however much is made of each of its rows."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def evm(key: Column) -> Column:
    digest = F.md5(key.cast("string"))
    return F.concat(F.lit("0x"), digest, F.substring(digest, 1, 8))


EVM_SQL = "'0x' || md5(({k})::varchar) || substr(md5(({k})::varchar), 1, 8)"


def evm_sql(key: str) -> str:
    return EVM_SQL.format(k=key)


def pick(items: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, items)), (number % len(items) + 1).cast("int"))


def pick_sql(items: tuple[str, ...], number: str) -> str:
    listed = ", ".join("'" + i.replace("'", "''") + "'" for i in items)
    return f"list_extract([{listed}], (({number}) % {len(items)} + 1)::int)"


def chain_sql(name: str, address: str) -> str:
    """Store spelling of a chain in SQL."""
    from ..functions.chains import STORE_ALIASES

    folded = f"lower(trim(coalesce({name}, '')))"
    cases = " ".join(f"when '{k}' then '{v}'" for k, v in STORE_ALIASES.items())
    return f"case when {folded} = 'bnb' then case when lower(trim({address})) like '0x%' then 'bsc' else 'bnb_beacon' end else case {folded} {cases} else {folded} end end"


def in_sql(items) -> str:
    return "(" + ", ".join(f"'{i}'" for i in items) + ")"


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as raw records: addresses of users in mixed case, some of them unfit, labels with dated actions."""
    from ..schema import LABEL

    e, u = F.col("event_id"), F.col("user_id")
    odd = F.when(e % 2 == 1, F.concat(F.lit("0x"), F.upper(F.substring(evm(u), 3, 40)))).otherwise(evm(u))
    address = F.when(e % 17 == 0, "").when(e % 19 == 0, "short").when(e % 23 == 0, F.concat(F.lit("1"), F.md5(u.cast("string")))).when(e % 29 == 0, F.concat(F.lit("CHFINMA::"), F.md5(u.cast("string")))).otherwise(odd)
    none = F.lit(None).cast("string")
    day = F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (e % 40).cast("int")), "yyyy-MM-dd")
    context = F.struct(F.concat(F.lit("https://p/"), (e % 5).cast("string")).alias("source_url"), pick(ACTIONS, F.floor(e / 3)).alias("action"), day.alias("action_date"), none.alias("action_evidence"), *[F.lit(None).cast("array<string>").alias(c) for c in ("sections", "datasets", "topics")])
    label = F.struct(F.concat(F.lit("n"), (e % 4).cast("string")).alias("name"), pick(TYPES, e).alias("type"), pick(SOURCES, F.floor(e / 2)).alias("source"), F.when(e % 6 > 0, pick(CHAINS, e + 1)).alias("chain"), none.alias("subtype"), none.alias("chain_evidence"), context.alias("context"))
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        e.alias("ord"), F.concat(F.lit("f"), (e % 3).cast("string")).alias("file"), address.alias("address"), pick(CHAINS, e).alias("chain"), F.array(label.cast(LABEL)).alias("labels"),
        F.when(kind == "error", True).when(kind == "view", False).alias("sanctioned"), (kind == "click").alias("is_illicit"), F.when(kind == "signup", True).alias("is_exchange"), F.lit(None).cast("boolean").alias("is_ai_agent"),
        F.when(e % 3 == 0, F.concat(F.lit("e"), e.cast("string"))).when(e % 3 == 1, "").alias("entity_name"), F.when(kind != "view", F.when(kind == "error", "sanctioned").when(kind == "click", "whale").otherwise("unknown")).alias("category"),
        F.when(e % 4 == 0, F.concat(F.lit("J"), (e % 9).cast("string"))).alias("jurisdiction"), none.alias("license_id"), none.alias("regulator"), pick(("active", "expired", "revoked"), e).alias("license_status"),
        F.when(kind == "error", F.concat(F.lit("R"), e.cast("string"))).alias("sanctions_reference"), F.concat(F.lit("https://s/"), (e % 7).cast("string")).alias("source_url"),
        F.when(e % 5 == 0, "2021-03").when(e % 5 == 1, "2021-03-04T10:00:00Z").when(e % 5 == 2, "2021-03-04").when(e % 5 == 3, "").alias("source_date"), none.alias("last_verified"),
        F.create_map(F.concat(F.lit("_k"), (e % 3).cast("string")), F.concat(F.lit("v"), e.cast("string"))).alias("extras"),
    )


RAW_SQL = f"""raw as (
  select event_id as ord, 'f' || (event_id % 3) as file,
    case when event_id % 17 = 0 then '' when event_id % 19 = 0 then 'short' when event_id % 23 = 0 then '1' || md5(user_id::varchar) when event_id % 29 = 0 then 'CHFINMA::' || md5(user_id::varchar)
      when event_id % 2 = 1 then '0x' || upper(substr({evm_sql('user_id')}, 3)) else {evm_sql('user_id')} end as address,
    {pick_sql(CHAINS, 'event_id')} as chain, 'n' || (event_id % 4) as l_name, {pick_sql(TYPES, 'event_id')} as l_type, {pick_sql(SOURCES, 'event_id // 2')} as l_source,
    case when event_id % 6 > 0 then {pick_sql(CHAINS, 'event_id + 1')} end as l_chain, 'https://p/' || (event_id % 5) as l_url, {pick_sql(ACTIONS, 'event_id // 3')} as l_action,
    strftime(date '2020-01-01' + (event_id % 40)::int, '%Y-%m-%d') as l_day,
    case event_type when 'error' then true when 'view' then false end as sanctioned, event_type = 'click' as is_illicit, case when event_type = 'signup' then true end as is_exchange,
    case event_id % 3 when 0 then 'e' || event_id when 1 then '' end as entity_name,
    case when event_type <> 'view' then case event_type when 'error' then 'sanctioned' when 'click' then 'whale' else 'unknown' end end as category,
    case when event_id % 4 = 0 then 'J' || (event_id % 9) end as jurisdiction, {pick_sql(('active', 'expired', 'revoked'), 'event_id')} as license_status,
    case when event_type = 'error' then 'R' || event_id end as sanctions_reference, 'https://s/' || (event_id % 7) as source_url,
    case event_id % 5 when 0 then '2021-03' when 1 then '2021-03-04T10:00:00Z' when 2 then '2021-03-04' when 3 then '' end as source_date,
    '_k' || (event_id % 3) as x_key, 'v' || event_id as x_value
  from events)"""


def screened_sql() -> str:
    """RAW_SQL and the screening of its records."""
    from ..functions.address import CASE_SENSITIVE
    from ..functions.chains import STORE_CHAINS

    return f"""with {RAW_SQL},
placed as (select * replace ({chain_sql('chain', 'address')} as chain, case when l_chain is null then null else {chain_sql('l_chain', 'address')} end as l_chain), l_chain is null as l_bare from raw),
keyed as (select *, case when regexp_matches(trim(address), '^0x[0-9a-fA-F]{{40}}$') then lower(trim(address)) else trim(address) end as key,
  coalesce(l_chain in {in_sql(STORE_CHAINS)}, l_bare) as l_kept from placed),
screened as (select *, case when address = '' then 'no_address' when not regexp_full_match(trim(address), '[A-Za-z0-9:]{{20,120}}') then 'bad_address'
  when chain not in {in_sql(STORE_CHAINS)} then 'unknown_chain'
  when not regexp_matches(key, '^0x[0-9a-fA-F]{{40}}$') and not regexp_matches(lower(key), '^(bc1|tb1|ltc1)') and chain in {in_sql(CASE_SENSITIVE)} and key = lower(key) and lower(key) <> upper(key) then 'case_destroyed'
  when key like '%::%' then 'synthetic' end as reject_reason from keyed)"""
