"""Queries of validation, order, slugs, dates, samples, written forms, commands and streams."""

from __future__ import annotations

import contextlib
import io
import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import commands
from ..functions import dates, names, text
from ..operators import directory, ingest, label_set, mixers, probe, standing, tagpack
from ..schema import LABEL, RECORD
from ..sources import registers, stores
from ..streaming import incremental
from .catalog import query
from .derive import evm, evm_sql, pick, pick_sql, table
from .landing import files, landed, place
from .queries_sources import _advanced, _sdn_csv

_NONE = "cast(null as varchar)"


@query("""select p_partkey, p_partkey % 2 = 0 and p_partkey % 3 <> 1 and p_partkey % 5 <> 2 and p_partkey % 7 <> 3 and p_partkey % 11 <> 4 and p_partkey % 13 <> 5 as valid from part""")
def record_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records against the schema's lengths and vocabularies: address, category, status, date, a label's name and chain."""
    k, none = F.col("p_partkey"), F.lit(None)
    own = {
        "address": F.when(k % 2 == 0, "a" * 256).otherwise("a" * 257), "chain": F.lit("ethereum"), "category": F.when(k % 3 == 1, "whale").when(k % 3 == 2, "mixer"), "license_status": F.when(k % 5 == 2, "expired").when(k % 5 == 1, "active"),
        "source_date": F.when(k % 7 == 3, "2021-1-1").when(k % 7 == 2, "2021-01-01"), "labels": F.array(F.struct(F.when(k % 11 == 4, "n" * 257).otherwise("n").alias("name"), F.lit("t").alias("type"), F.lit("s").alias("source"), F.when(k % 13 != 5, "eth").alias("chain"), *[none.cast("string").alias(c) for c in ("subtype", "chain_evidence")], none.alias("context")).cast(LABEL)),
    }
    fields = spark.createDataFrame([], RECORD).schema
    rows = table(spark, sf_dir, "part", "p_partkey").select("p_partkey", *[own.get(f.name, none).cast(f.dataType).alias(f.name) for f in fields])
    return rows.select("p_partkey", ingest.is_valid().alias("valid"))


@query("""select p_partkey, row_number() over (order by p_size % 3 desc, p_partkey % 4 desc, lower(p_name), p_partkey)::bigint as place from part""")
def directory_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The directory's order of output; equal names stay as they came."""
    rows = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") % 3).alias("n_jurisdictions"), (F.col("p_partkey") % 4).alias("n_licenses"), F.col("p_name").alias("name"), F.col("p_partkey").alias("first"))
    at = directory.ranked(rows).select("p_partkey").withColumn("at", F.monotonically_increasing_id())
    return at.select("p_partkey", F.row_number().over(Window.orderBy("at")).cast("long").alias("place"))


@query("""select p_partkey, left(trim(regexp_replace(lower(p_name || ' & Co!'), '[^a-z0-9]+', '-', 'g'), '-'), 12) as slug, p_name || ' Pte Ltd' as from_slug, case p_partkey % 3 when 0 then 'AG' when 1 then 'S.A' else null end as legal_form from part""")
def slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    slug = F.concat(k.cast("string"), F.lit("-"), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("-Pte-Ltd"))
    return table(spark, sf_dir, "part").select(k, names.slug(F.concat("p_name", F.lit(" & Co!")), "-", 12).alias("slug"), registers.name_from_slug(slug).alias("from_slug"), registers.legal_form(F.concat("p_name", pick((" AG", " S.A.", " Oy"), k))).alias("legal_form"))


@query(f"""select c_custkey, {evm_sql('c_custkey')} || '|1BoatSLRHtKNngkdXEeobR76b53LETtpyT' as found from customer""")
def probe_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct addresses of a text: EVM ones in any case, Bitcoin ones as they stand."""
    k = F.col("c_custkey")
    body = F.concat(F.lit("to 0x"), F.upper(F.substring(evm(k), 3, 40)), F.lit(", "), evm(k), F.lit(" or 1BoatSLRHtKNngkdXEeobR76b53LETtpyT; no 0x12, 1Boat0"))
    return table(spark, sf_dir, "customer", "c_custkey").select(k, F.array_join(probe.addresses(body), "|").alias("found"))


@query("""select c_custkey, '{"anchor_type": ' || case when c_custkey % 2 = 0 then '"a\\"b"' else 'null' end || ', "attributed_utc": "2024-01-01T00:00:00Z", "batch_id": "b1", "method": "é, m", "note": null, "source_date": "2024-01-01", "source_url": "https://x/' || c_custkey || '"}' as entry from customer""")
def provenance_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch row's provenance: sorted keys, nulls kept, a space after commas and colons."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer", "c_custkey").select(k, F.when(k % 2 == 0, 'a"b').alias("anchor_type"), F.lit("é, m").alias("method"), F.lit(None).cast("string").alias("note"), F.lit("2024-01-01").alias("source_date"), F.concat(F.lit("https://x/"), k.cast("string")).alias("source_url"))
    return rows.select("c_custkey", label_set.provenance("b1", "2024-01-01T00:00:00Z").alias("entry"))


@query("""select o_orderkey, case o_orderkey % 4 when 3 then '2021-12-05' else strftime(o_orderdate, '%Y-%m-%d') end as day from orders""")
def action_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day of an action page: in its link, else a written US date in two forms, else the page's own."""
    o, d = F.col("o_orderkey"), F.col("o_orderdate")
    link = F.when(o % 4 == 0, F.concat(F.lit("/recent-actions/"), F.date_format(d, "yyyyMMdd"), F.lit("_33"))).otherwise("/recent-actions/notice")
    published = F.when(o % 4 == 1, F.date_format(d, "M/d/yyyy")).when(o % 4 == 2, F.date_format(d, "MMMM d, yyyy")).when(o % 4 == 3, "2021-12-05T10:00:00")
    return table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate").select(o, dates.action_day(link, published).alias("day"))


@query("""select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as era, strftime(o_orderdate, '%Y-%m-%d') as listed, strftime(o_orderdate, '%Y-%m-%d') as uk, strftime(o_orderdate, '%Y-%m-%d') as two from orders""")
def register_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates of the registers: Japanese eras, a listing's English form, written months, two plain forms."""
    o, d = F.col("o_orderkey"), F.col("o_orderdate")
    year = F.year(d)
    era = F.when(d >= F.lit("2019-05-01"), F.concat(F.lit("令和"), F.when(year == 2019, "元").otherwise((year - 2018).cast("string")))).otherwise(F.concat(F.lit("平成"), (year - 1988).cast("string")))
    wareki = F.concat(era, F.lit(" 年"), F.month(d).cast("string"), F.lit("月 "), F.translate(F.dayofmonth(d).cast("string"), "0123456789", "０１２３４５６７８９"), F.lit("日"))
    return table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate").select(
        o, dates.wareki_date(wareki).alias("era"), registers.sfc_date(F.concat(F.date_format(d, "MMM d, yyyy"), F.lit(" 12:00:00 AM"))).alias("listed"),
        dates.uk_date(F.when(o % 2 == 0, F.date_format(d, "d MMMM yyyy")).otherwise(F.date_format(d, "dd/MM/yyyy"))).alias("uk"), registers.two_forms(F.when(o % 2 == 0, F.date_format(d, "d/M/yyyy")).otherwise(F.date_format(d, "yyyy-MM-dd"))).alias("two"),
    )


@query("""select p_partkey, 'key = "ab' || p_partkey || 'cd"; x = "ef"' as plain from part""")
def deobfuscated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literals with a seam, a plus sign or white space, are joined."""
    k = F.col("p_partkey")
    source = F.concat(F.lit('key = "ab"'), F.when(k % 2 == 0, " + ").otherwise("\n "), F.lit("'"), k.cast("string"), F.lit("""' + "cd"; x = "ef\""""))
    return table(spark, sf_dir, "part", "p_partkey").select(k, text.deobfuscate(source).alias("plain"))


_HTML = ("&eacute;&#160;&#x27;", "&#8364;&#150;&lt;", "&amp;lt;&notit;&copy", "&unknown; & &#0;")
_PLAIN = ("é ''", "€–<", "&lt;¬it;©", "&unknown; & �")


@query(f"select p_partkey, p_name || {pick_sql(tuple(x.replace(chr(39) * 2, chr(39)) for x in _PLAIN), 'p_partkey')} as plain from part")
def unescaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References by name and number, legacy ones without a semicolon, and what is none."""
    return table(spark, sf_dir, "part").select("p_partkey", text.unescape(F.concat("p_name", pick(_HTML, F.col("p_partkey")))).alias("plain"))


@query("""select 'shared' as pack, 'heuristic' as level union all select 'mixed', null union all select 'nulls', null""")
def pack_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The confidence that all tags of a pack share, which then stands in its header."""
    rows = table(spark, sf_dir, "part", "p_partkey")
    level = lambda c: tagpack.header_confidence(rows.select(c.cast("string").alias("confidence")))
    return spark.createDataFrame([("shared", level(F.lit("heuristic"))), ("mixed", level(pick(("heuristic", "unknown"), F.col("p_partkey")))), ("nulls", level(F.lit(None)))], "pack string, level string")


# the mixer registry ---------------------------------------------------------------------------


def _mixers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    features = _advanced(spark, sf_dir).withColumn("party_primary_name", F.when(F.col("party_uid").cast("long") % 2 == 0, F.concat(F.lit("Semenov "), "party_primary_name")).otherwise(F.col("party_primary_name")))
    k = F.col("n_nationkey")
    listed = table(spark, sf_dir, "nation").select(k.alias("idx"), evm(k + 5_000_000).alias("address"), F.when(k % 2 == 0, "Tornado.Cash").otherwise("other").alias("label"), F.lit(None).cast("string").alias("nameTag"), F.col("n_name").alias("name"), F.lit(None).cast("string").alias("category"), F.lit(56).alias("chainId"))
    return mixers.registry(features, listed), features, listed


@query(f"""select {evm_sql('s_suppkey')} as address, 'eth' as chain, 'tornado_cash' as family, s_suppkey || ':Semenov_Roman' as operator_party, '[{{"kind":"ofac_sdn","fixedref":"' || s_suppkey || '","feature_id":"f1","feature_type_id":"345","raw":"' || {evm_sql('s_suppkey')} || '"}}]' as sources from supplier where s_suppkey % 2 = 0
union all select {evm_sql('n_nationkey + 5000000')}, 'bsc', 'tornado_cash', null, '[{{"kind":"dawsbot","idx":' || n_nationkey || ',"label":"Tornado.Cash","raw":"' || {evm_sql('n_nationkey + 5000000')} || '"}}]' from nation where n_nationkey % 2 = 0""")
def mixer_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry as its file has it, sources as JSON, written and read again; Tron features of the same parties aside."""
    rows, _, _ = _mixers(spark, sf_dir)
    path = place(spark, "mixers")
    stores.write_table(mixers.as_written(rows), path, ["address"])
    return spark.read.parquet(path).where("chain != 'tron'").select("address", "chain", "family", "operator_party", "sources")


@query("""select kind, true as verified, n::bigint as n from (select 'ofac_sdn' as kind, (select count(*) from supplier where s_suppkey % 2 = 0) + (select count(distinct s_suppkey % 5) from supplier where s_suppkey % 2 = 0) as n
union all select 'dawsbot', (select count(*) from nation where n_nationkey % 2 = 0))""")
def mixer_canary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the first source of each entry still says its address (the sample is as large as the registry)."""
    rows, features, listed = _mixers(spark, sf_dir)
    return mixers.canary(rows, features, listed, 1 << 20).groupBy("kind", "verified").agg(F.count("*").alias("n"))


@query("select 10::bigint as n, true as same, true as inside")
def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seeded sample: its size, that it doesn't depend on the order of rows, and that it comes from them."""
    from ..operators.dedupe import sample

    rows = table(spark, sf_dir, "customer", "c_custkey")
    one, two = sample(rows, "c_custkey", 10), sample(rows.repartition(7).orderBy(F.desc("c_custkey")), "c_custkey", 10)
    both = one.select("c_custkey", F.lit(1).alias("w")).unionByName(two.select("c_custkey", F.lit(2).alias("w"))).groupBy("c_custkey").agg(F.sum("w").alias("w")).join(rows.withColumn("known", F.lit(True)), "c_custkey", "left")
    return both.agg(F.count("*").alias("n"), F.bool_and(F.col("w") == 3).alias("same"), F.bool_and(F.coalesce("known", F.lit(False))).alias("inside"))


# commands -------------------------------------------------------------------------------------


def _run(spark: SparkSession, *argv: str) -> int:
    """A command's exit code; what it prints is not shown."""
    with contextlib.redirect_stdout(io.StringIO()):
        return commands.main(list(argv), spark)


@query(f"""select address, 'DOE, ' || c_name as entity_name, 0 as code from (select c_name, {pick_sql(("TUuxcF4nxR9fRC4WNnQqug4ZFjJQm9WmZn", "TTujjqVrErT4RNQ2mZsVx1fbso8p3k41iR", "TUDLcxCsLKrAmereBPBCVCuGsXdXTk44Vc", "TXZGbS9QNcXyxXpraUkPYu3aCmeFaf8Kfn", "TRL9pJCHPAYGV7T1Pa97LbCgFHY5ttiKbw"), 'c_custkey')} as address from customer where c_custkey % 3 = 0 and c_custkey % 7 <> 0)""")
def command_tron_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The command that turns the landed list into raw records of Tron wallets, and its file."""
    out = os.path.join(files(spark, {"x": ""}, "out"), "tron.json")
    code = _run(spark, "scrape-ofac-tron", "--sdn-cache", _sdn_csv(spark, sf_dir), "--output", out, "--source-date", "2024-01-01")
    return stores.read_records(spark, out).select("address", "entity_name", F.lit(code).alias("code"))


@query("""select 'label_set.parquet' as file, false as dry, true as executed union all select 'manifest.json', false, true""")
def command_label_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing is written without --execute; with it, the label set and its manifest."""
    line = F.concat(F.lit('{"chain":"eth","address":"'), evm(F.col("n_nationkey")), F.lit('","classes":["c"],"anchor_type":"a","method":"m","source_url":"u","source_date":"2024-01-01"}'))
    batch = landed(table(spark, sf_dir, "nation"), line, "n_nationkey", "batch", one=True)
    found = []
    for extra in ([], ["--execute"]):
        out = files(spark, {"x": ""}, "set")
        _run(spark, "build-label-set", "--batch", batch, "--batch-id", "b", "--out-dir", out, "--attributed-utc", "2024-01-01T00:00:00Z", *extra)
        found.append({n for n in ("label_set.parquet", "manifest.json") if os.path.exists(os.path.join(out, n))})
    return spark.createDataFrame([(n, n in found[0], n in found[1]) for n in ("label_set.parquet", "manifest.json")], "file string, dry boolean, executed boolean")


@query(f"""select {evm_sql('n_nationkey')} as address, 'p' || n_nationkey as lead_project, n_nationkey % 2 = 0 as already_in_mixer_registry, true as pending from nation where n_nationkey % 3 = 0""")
def command_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The command that lists privacy escrows as candidates: attribution stays empty and pending."""
    k, none = F.col("n_nationkey"), F.lit(None).cast("string")
    rows = table(spark, sf_dir, "nation").select(F.concat(F.lit("p"), k.cast("string")).alias("bridge"), F.when(k % 3 == 0, "privacy").otherwise("unknown").alias("project_kind"), none.alias("project_declared_type"), evm(k).alias("escrow_address"), evm(k).alias("escrow_address_raw"), F.lit("eth").alias("chain"), F.lit("r").alias("source_repo"), F.lit("c").alias("source_commit"))
    known = table(spark, sf_dir, "nation").where("n_nationkey % 2 = 0").select(evm(k).alias("addr"))
    a, b = place(spark, "excluded"), place(spark, "known")
    rows.write.parquet(a)
    known.write.parquet(b)
    out = os.path.join(files(spark, {"x": ""}, "out"), "delta.json")
    _run(spark, "mixer-registry-delta", "--excluded", a, "--mixer", b, "--out", out)
    with open(out, encoding="utf-8") as f:
        got = [(r["address"], r["lead_project"], r["already_in_mixer_registry"], r.get("attribution") is None and r["attribution_basis"].startswith("PENDING")) for r in json.load(f)]
    return spark.createDataFrame(got, "address string, lead_project string, already_in_mixer_registry boolean, pending boolean")


# streams --------------------------------------------------------------------------------------


@query(f"""with a as (select {evm_sql('user_id')} as address, strftime(date '2020-01-01' + (event_id % 40)::int, '%Y-%m-%d') as day, {pick_sql(('designation', 'change', 'removal'), 'event_id // 3')} as action from events),
r as (select address, day, case action when 'designation' then 2 when 'change' then 1 else 0 end as p from a), l as (select address, max(day) as day from r group by 1)
select address, day as action_date, case when max(p) = 0 then 'removed' else 'listed' end as status from r join l using (address, day) group by 1, 2""")
def streamed_standing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each address's standing from a stream of dated actions, in several micro-batches of files in any order."""
    e = F.col("event_id")
    day = F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (e % 40).cast("int")), "yyyy-MM-dd")
    rows = table(spark, sf_dir, "events").select(evm(F.col("user_id")).alias("address"), pick(("designation", "change", "removal"), F.floor(e / 3)).alias("action"), day.alias("action_date"))
    root = place(spark, "stream")
    rows.repartition(4).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/in")
    keep = lambda df, _: df.write.mode("overwrite").parquet(f"{root}/out")
    incremental.latest_actions(stream).writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/out")


@query("""select page_id, 'https://p/' || (page_id % 40) as link from pages where page_id in (select min(page_id) from pages group by page_id % 40)""")
def streamed_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of arriving pages, each once within the watermark; the first page that has a link is joined to it."""
    k = F.col("page_id")
    link = F.concat(F.lit("https://p/"), (k % 40).cast("string"))
    rows = table(spark, sf_dir, "pages", "page_id").select(F.concat(F.lit('<a href="'), link, F.lit('">')).alias("html"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("ts"))
    root = place(spark, "stream")
    rows.repartition(3).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    incremental.page_links(stream).writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    first = table(spark, sf_dir, "pages", "page_id").groupBy(link.alias("link")).agg(F.min("page_id").alias("page_id"))
    return spark.read.parquet(f"{root}/out").join(first, "link").select("page_id", "link")


_STANDING = ("designation", "change", "removal", None)


@query(f"""select c_custkey, case c_custkey % 4 when 0 then 'designation' when 1 then 'change' when 2 then 'designation' else 'designation' end as action, 'change|designation|removal' as every from customer where c_custkey % 4 <> 1
union all select c_custkey, 'change', 'change|removal' from customer where c_custkey % 4 = 1""")
def net_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The action that prevails over all sections of a page, and over all chains of an address."""
    k = F.col("c_custkey")
    per_chain = lambda *own: F.array(*[F.lit(x) for x in own])
    rows = table(spark, sf_dir, "customer", "c_custkey")
    one = rows.select(k.cast("string").alias("link"), evm(k).alias("address"), F.when(k % 4 == 1, per_chain("removal")).otherwise(per_chain("removal", "designation")).alias("actions"), F.lit("none").alias("action_evidence"))
    two = one.withColumn("actions", per_chain("change"))
    from ..operators import pages

    out = pages.page_actions(one.unionByName(two))
    return out.select(F.col("link").cast("long").alias("c_custkey"), standing.net_action(F.col("sections")).alias("action"), F.array_join("sections", "|").alias("every"))
