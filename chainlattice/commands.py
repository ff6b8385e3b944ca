"""The command line: python -m chainlattice COMMAND. Files in, files and a manifest out.

Exit codes: 0 done, 1 refused or invalid, 2 input or configuration, 3 partial, 4 a floor not reached.
Nothing is fetched: inputs are landed files."""

from __future__ import annotations

import argparse
import json
import os
import sys
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import bridges, directory, gates, ingest, label_set, mixers, pages, probe, scan, standing, store, tagpack, vasp_map
from .operators.gates import Gate, GateFailure
from .sources import feeds, ofac, registers, stores

COMMANDS: dict[str, tuple[Callable, list[tuple[str, dict]]]] = {}


def command(*options: tuple[str, dict]):
    def add(f):
        COMMANDS[f.__name__.replace("_", "-")] = (f, list(options))
        return f

    return add


def need(name: str, **more) -> tuple[str, dict]:
    return name, {"required": True, **more}


def may(name: str, **more) -> tuple[str, dict]:
    return name, more


def _counts(df: DataFrame, key: str) -> dict:
    return {str(r[0]): r[1] for r in df.groupBy(key).count().orderBy(F.desc("count"), key).collect()}


def _json(rows: DataFrame, path: str) -> int:
    """A DataFrame as one JSON list, row by row."""
    n = 0
    with open(path, "w", encoding="utf-8") as f:
        f.write("[")
        for (r,) in rows.select(F.to_json(F.struct(*rows.columns))).toLocalIterator():
            f.write((",\n" if n else "\n") + r)
            n += 1
        f.write("\n]\n")
    return n


def _now() -> str:
    return datetime.now(UTC).isoformat(timespec="seconds")


def _store(spark: SparkSession, path: str) -> DataFrame:
    return stores.read_records(spark, path)


@command(need("--raw-dir"), may("--base"), need("--output"), may("--inputs", nargs="*"), may("--skip-validation", action="store_true"), may("--manifest"))
def merge_to_unified(spark: SparkSession, a: argparse.Namespace) -> int:
    """Raw files, in the order given, into a store."""
    raw = stores.read_many(spark, a.raw_dir, a.inputs)
    screened = ingest.screen(raw)
    good = ingest.align(screened.where("reject_reason is null")).withColumn("address", F.col("key"))
    if a.base:
        base = stores.read_records(spark, a.base).withColumn("file", F.lit("base"))
        good = base.unionByName(good.select(base.columns))
    merged = standing.reconcile(store.merge(good))
    kept = merged.drop("press_status", "changed")
    n = stores.write_store(kept, a.output)
    if a.manifest:
        invalid = 0 if a.skip_validation else merged.where(~ingest.is_valid()).count()
        refused = {f"{r.file}:{r.reject_reason}": r.n for r in ingest.reject_counts(screened, "file").collect()}
        stores.write_manifest(a.manifest, records=n, refused=refused, invalid=invalid, restated=merged.where("changed").count(), by_chain=_counts(merged, "chain"), output_sha256=stores.file_digest(a.output), content=stores.content_digest(kept.drop("ord")))
    return 0


@command(may("--base"), may("--base-manifest"), need("--batch"), need("--batch-id"), may("--out-dir", default="out"), may("--attributed-utc"), may("--execute", action="store_true"))
def build_label_set(spark: SparkSession, a: argparse.Namespace) -> int:
    base = stores.read_label_set(spark, a.base)
    rows, keys = base.count(), base.select("chain", "address").distinct().count()
    manifest = json.load(open(a.base_manifest)) if a.base_manifest else None
    digest = stores.file_digest(a.base) if a.base and os.path.isfile(a.base) else None
    label_set.verify_base(rows, keys, manifest, digest)
    screened = label_set.screen(stores.read_batch(spark, a.batch))
    now = a.attributed_utc or _now()
    merged = label_set.merge_batch(base, screened, a.batch_id, now)
    label_set.check_append_only(base, merged)
    report = {"built_utc": now, "rows_total": merged.count(), "batch": label_set.stats(screened, merged, base), "per_chain": _counts(merged, "chain")}
    print(json.dumps(report, indent=2))
    if a.execute:
        os.makedirs(a.out_dir, exist_ok=True)
        stores.write_table(merged.drop("is_new"), os.path.join(a.out_dir, "label_set.parquet"), ["chain", "address"])
        stores.write_manifest(os.path.join(a.out_dir, "manifest.json"), **report)
    return 0


@command(need("--out"), need("--from-dir"), may("--min-addresses", type=int, default=gates.OFAC_ADDRESSES))
def fetch_ofac_primary(spark: SparkSession, a: argparse.Namespace) -> int:
    """Wallets of the landed enhanced lists."""
    paths = [os.path.join(a.from_dir, f"{n}.xml") for n in ("sdn_enhanced", "cons_enhanced")]
    if missing := [p for p in paths if not os.path.isfile(p)]:
        raise GateFailure(f"missing: {missing}")
    rows = ofac.distinct_wallets(ofac.read_enhanced(spark, paths[0]).unionByName(ofac.read_enhanced(spark, paths[1])))
    found = gates.check(rows, [Gate("addresses", F.count_distinct("address"), a.min_addresses)])
    os.makedirs(a.out, exist_ok=True)
    out = os.path.join(a.out, "ofac_wallets.json")
    n = _json(rows, out)
    stores.write_manifest(os.path.join(a.out, "manifest.json"), rows_address_currency=n, distinct_addresses=found["addresses"], by_currency=_counts(rows, "currency"), sources={p: stores.file_digest(p) for p in paths}, output_sha256=stores.file_digest(out))
    return 0


@command(need("--sdn-cache"), need("--output"), need("--source-date"), may("--all-chains", action="store_true"))
def scrape_ofac_tron(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = ofac.addresses(ofac.read_csv(spark, a.sdn_cache))
    out = ofac.records(rows if a.all_chains else ofac.on_chain(rows), a.source_date)
    return 0 if _json(out, a.output) else 1


@command(need("--wallets"), need("--source-date"), need("--out"))
def ofac_wallets_to_raw(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = spark.read.option("multiLine", True).schema("entity_id string, entity_name string, programs array<string>, currency string, address string").json(a.wallets)
    _json(ofac.wallet_records(rows, a.source_date), a.out)
    return 0


@command(need("--input-dir"), need("--output"))
def parse_crypto_rekts(spark: SparkSession, a: argparse.Namespace) -> int:
    _json(feeds.incidents(feeds.read_incidents(spark, a.input_dir)), a.output)
    return 0


@command(need("--input"), need("--output"), may("--source-url-base", default="https://www.opensanctions.org"))
def parse_opensanctions(spark: SparkSession, a: argparse.Namespace) -> int:
    if not os.path.exists(a.input):
        return 1
    _json(feeds.wallets(feeds.read_entities(spark, a.input), a.source_url_base), a.output)
    return 0


@command(need("--index-dir"), need("--cache-dir"), need("--output"), may("--max-actions", type=int, default=0))
def parse_ofac_press_releases(spark: SparkSession, a: argparse.Namespace) -> int:
    links = feeds.action_links(feeds.read_texts(spark, a.index_dir))
    found = feeds.cached_pages(spark, a.cache_dir, links.limit(a.max_actions) if a.max_actions > 0 else links)
    rows = pages.records(pages.address_actions(pages.recent(found)), pages.about(found))
    _json(rows.orderBy("source_url", "address", "chain"), a.output)
    return 0


@command(need("--input-dir"), need("--output"), may("--keywords", nargs="*", default=["cex", "labels", "addresses", "institution/identifier"]))
def harvest_spellbook(spark: SparkSession, a: argparse.Namespace) -> int:
    _json(feeds.spellbook(feeds.sql_files(feeds.read_texts(spark, a.input_dir), a.keywords)).drop("ord"), a.output)
    return 0


@command(need("--base"), need("--spellbook"), need("--output"))
def merge_spellbook_into_unified(spark: SparkSession, a: argparse.Namespace) -> int:
    found = spark.read.text(a.spellbook, wholetext=True).select(F.posexplode(F.from_json("value", "array<struct<address:string,chain:string,entity_name:string,distinct_name:string>>")).alias("ord", "r")).select("ord", "r.*")
    base = _store(spark, a.base)
    out = store.add_spellbook(base, found)
    stores.write_store(out.withColumn("ord", F.coalesce("ord", F.struct(F.lit(1).alias("source"), F.xxhash64("address").alias("pos")))), a.output)
    return 0


@command(need("--raw-dir"), need("--out-parquet"), need("--out-json"), may("--aliases"))
def merge_vasp_directory(spark: SparkSession, a: argparse.Namespace) -> int:
    """The nine registers' raw files (<register>.json) into the directory. --aliases: JSON with rules, exact,
    pinned and primary."""
    own = json.load(open(a.aliases)) if a.aliases else {}
    parts = []
    for i, tag in enumerate(directory.REGISTERS):
        path = os.path.join(a.raw_dir, f"{tag}.json")
        if not os.path.exists(path):
            raise FileNotFoundError(path)
        parts.append(stores.read_records(spark, path, i).withColumn("register", F.lit(tag)))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    built = directory.build(directory.identify(rows, [tuple(r) for r in own.get("rules", [])], own.get("exact", {}), own.get("pinned", {})), own.get("primary"))
    stores.write_table(built, a.out_parquet, [F.desc("n_jurisdictions"), F.desc("n_licenses"), F.lower("name"), "first"], "zstd")
    _json(directory.ranked(built).drop("first"), a.out_json)
    print(json.dumps(_counts(directory.by_jurisdiction(built), "jurisdiction")))
    return 0


@command(need("--directory"), need("--labels"), need("--output"), may("--aliases"), may("--allow-partial", action="store_true"))
def build_vasp_to_address(spark: SparkSession, a: argparse.Namespace) -> int:
    own = json.load(open(a.aliases)) if a.aliases else {}
    entities = spark.read.parquet(a.directory)
    index = vasp_map.label_index(_store(spark, a.labels), [tuple(r) for r in own.get("rules", [])], own.get("exact", {}))
    stats = vasp_map.coverage(entities, index).first()
    print(json.dumps(stats.asDict()))
    if not a.allow_partial and (stats.n_records < gates.VASP_ROWS or stats.multi_with_addresses < gates.VASP_MULTI):
        return 2
    stores.write_table(vasp_map.build(entities, index), a.output, ["vasp_canonical_id", "address"])
    return 0


@command(need("--checkout"), need("--commit"), may("--repo", default="l2beat/l2beat"), may("--local-dir", default="out/bridge_registry"))
def build_bridge_registry(spark: SparkSession, a: argparse.Namespace) -> int:
    docs = feeds.checkout(spark, a.checkout)
    if not docs.where(F.try_parse_json("body").isNull()).isEmpty():
        return 3
    kept, apart = bridges.split(bridges.registry(docs, a.commit, a.repo, _now()))
    gates.check(kept, bridges.gates())
    os.makedirs(a.local_dir, exist_ok=True)
    stores.write_table(kept, os.path.join(a.local_dir, "bridge_registry.parquet"), ["bridge", "escrow_address", "chain"])
    stores.write_table(apart, os.path.join(a.local_dir, "excluded_non_bridge.parquet"), ["bridge", "escrow_address", "chain"], refuse_empty=False)
    return 0


@command(need("--sdn-advanced"), need("--labels"), need("--out-dir"))
def build_mixer_registry(spark: SparkSession, a: argparse.Namespace) -> int:
    features = ofac.read_advanced(spark, a.sdn_advanced)
    listed = feeds.label_list(feeds.read_texts(spark, a.labels))
    if features.isEmpty() or listed.count() < 100:
        return 2
    rows = mixers.registry(features, listed)
    sentinels = spark.createDataFrame([(mixers.SEMENOV_SENTINEL,), *[(x,) for x in mixers.SINBAD_SENTINELS]], "address string")
    if not sentinels.join(rows, "address", "left_anti").isEmpty():
        return 3
    if not mixers.canary(rows, features, listed).where("not verified").isEmpty():
        return 4
    os.makedirs(a.out_dir, exist_ok=True)
    stores.write_table(mixers.as_written(rows), os.path.join(a.out_dir, "mixer_registry.parquet"), ["address"])
    return 0


@command(need("--sdn-advanced"), need("--labels"), need("--spellbook"), need("--out"))
def probe_mixer_sources(spark: SparkSession, a: argparse.Namespace) -> int:
    parties = ofac.parties(ofac.read_advanced(spark, a.sdn_advanced))
    listed = feeds.label_list(feeds.read_texts(spark, a.labels))
    book = spark.read.option("multiLine", True).schema("address string, name string, category string").json(a.spellbook)
    one = parties.select(F.col("all_names").alias("text"), "name", probe.addresses(F.col("id_values")).alias("found"))
    two = listed.select(F.concat_ws(" ", "name", "category", "label", "nameTag").alias("text"), "name", F.array(mixers.hex_lower(F.col("address"))).alias("found"))
    three = book.select(F.concat_ws(" ", "name", "category").alias("text"), "name", F.array(mixers.hex_lower(F.col("address"))).alias("found"))
    grid = probe.cells(one, "ofac_sdn").unionByName(probe.cells(two, "dawsbot_eth_labels")).unionByName(probe.cells(three, "dune_spellbook"))
    passed = bool(probe.control(parties).first().passed)
    _json(probe.decide(grid, passed, not listed.isEmpty() or not book.isEmpty()), a.out)
    return 0 if passed else 3


@command(need("--excluded"), need("--mixer"), need("--out"))
def mixer_registry_delta(spark: SparkSession, a: argparse.Namespace) -> int:
    known = spark.read.parquet(a.mixer)
    column = next((c for c in known.columns if "address" in c.lower() or c.lower() in ("addr", "hex")), None)
    if column is None:
        raise GateFailure(f"no address column among {known.columns}")
    _json(mixers.delta(spark.read.parquet(a.excluded), known.select(F.col(column).alias("address"))), a.out)
    return 0


@command(may("--labels"), may("--out"), may("--min-rows", type=int, default=100), may("--allow-unsourced", action="store_true"), may("--exclude-sources", default=",".join(tagpack.EXCLUDED)), may("--lastmod"), may("--title", default="Public-label tag pack"), may("--creator", default="chainlattice"))
def generate_tagpack(spark: SparkSession, a: argparse.Namespace) -> int:
    excluded = tuple(s.strip() for s in a.exclude_sources.split(",") if s.strip())
    pack = tagpack.tags(tagpack.screen(_store(spark, a.labels), a.allow_unsourced, excluded))
    tagpack.check_floor(pack, a.min_rows)
    level = tagpack.header_confidence(pack)
    header = {"title": a.title, "creator": a.creator, "description": "Public-source address labels; each tag names the source it was taken from.", "lastmod": a.lastmod or _now()[:10]}
    if wrong := tagpack.validate(pack, header | ({"confidence": level} if level else {})):
        print("\n".join(wrong))
        return 1
    stores.write_tagpack(pack, header, a.out, level)
    return 0


@command(need("--register", choices=list(directory.REGISTERS)), need("--input"), need("--output"), need("--day"), may("--url", default=""), may("--seeds", nargs="*", default=[]))
def read_register(spark: SparkSession, a: argparse.Namespace) -> int:
    """A landed register file as raw records."""
    order = F.monotonically_increasing_id()
    if a.register == "esma":
        out = registers.esma_united(registers.esma(registers.read_esma(spark, a.input), a.day, a.url, os.path.basename(a.input)).withColumn("ord", order), "ord").drop("ord")
    elif a.register == "fincen":
        rows = registers.read_fincen(spark, a.input)
        out = registers.fincen(rows.where(registers.is_crypto_msb(a.seeds)), a.day)
    elif a.register == "ch_finma":
        out = registers.finma(registers.finma_kept(registers.read_finma(spark, a.input).withColumn("ord", order), a.seeds, "ord"), a.day, a.url)
    elif a.register == "uae_vara":
        out = registers.vara(registers.vara_rows(feeds.read_texts(spark, a.input)), a.day, a.url)
    elif a.register == "mas":
        found = feeds.read_texts(spark, a.input).withColumn("slug", F.regexp_extract("path", r"([^/]+?)(?:\.html)?\z", 1))
        details = registers.mas_details(found).withColumn("name", registers.name_from_slug(F.col("slug")))
        out = registers.mas(details.where(registers.is_dpt_licensee()), a.day, a.url)
    elif a.register == "nydfs":
        out = registers.nydfs(spark.read.option("header", True).csv(a.input), a.day, a.url)
    elif a.register == "jp_jfsa":
        out = registers.jfsa(spark.read.schema("page int, pos int, c array<string>").json(a.input), a.day, a.url)
    elif a.register == "fca":
        firms = spark.read.schema("frn string, name string, status string, mlr_status string, mlr_date string, business_type string, companies_house string").json(a.input)
        out = registers.fca(firms, firms.select("frn"), a.day)
    else:
        items = spark.read.schema("ceref string, name string, nameChi string, hasActiveLicence string, hasActiveLicenceAmlo string, isDeemedLicenceAmlo string, full_address string, body string").json(a.input).withColumn("ord", order)
        out = registers.sfc(items.drop("body"), registers.sfc_details(items.select("ceref", "body").distinct()), a.day, a.url, "ord")
    _json(out, a.output)
    return 0


@command(need("--input"), need("--output"), need("--day"), may("--max-accounts", type=int, default=10_000))
def scrape_tronscan_vasps(spark: SparkSession, a: argparse.Namespace) -> int:
    _json(registers.tronscan(registers.read_tronscan(spark, a.input).orderBy("ord").limit(a.max_accounts), a.day), a.output)
    return 0


@command(need("--root"), may("--private-patterns"), may("--public-mode", action="store_true"), may("--overrides"))
def sanitize_gate(spark: SparkSession, a: argparse.Namespace) -> int:
    if not a.private_patterns and not a.public_mode:
        raise GateFailure("choose --private-patterns FILE or --public-mode", 2)
    if a.private_patterns and not os.path.isfile(a.private_patterns):
        raise GateFailure(f"no such file: {a.private_patterns}", 2)
    read = lambda p: open(p, encoding="utf-8").read() if p and os.path.isfile(p) else None
    found = scan.gate(spark, a.root, read(a.private_patterns), read(a.overrides)).orderBy("path", "name").collect()
    for r in found:
        print(f"{r.path}: {r.name}{' (concat-obfuscated)' if r.obfuscated else ''}: {r['match'][:60]!r}")
    return int(bool(found))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="chainlattice", description=__doc__)
    sub = parser.add_subparsers(dest="command", required=True)
    for name, (f, options) in COMMANDS.items():
        own = sub.add_parser(name, help=(f.__doc__ or "").split("\n")[0])
        for flag, how in options:
            own.add_argument(flag, **how)
    args = parser.parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"chainlattice {args.command}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        return COMMANDS[args.command][0](spark, args)
    except GateFailure as e:
        print(f"HALT: {e}", file=sys.stderr)
        return e.code
