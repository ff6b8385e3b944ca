"""Operators on small tables: order, ties, nulls, empty inputs."""

import json
import random

import pytest
from pyspark.sql import functions as F

from chainlattice.operators import bridges, dedupe, directory, gates, ingest, label_set, mixers, pages, probe, scan, standing, store, tagpack
from chainlattice.schema import BATCH, FLAGS, LABEL, LABEL_SET, RECORD, SCALARS

EVM = "0x" + "ab" * 20


def label(name="n", source="s", chain=None, kind="other", **context):
    keys = ("source_url", "action", "action_date", "action_evidence", "sections", "datasets", "topics")
    return (name, kind, source, chain, None, None, tuple(context.get(k) for k in keys) if context else None)


def records(spark, *rows):
    """Records of dicts in their order."""
    columns = [c.split()[0] for c in RECORD.replace(f"labels array<{LABEL}>", "labels x").replace("map<string,string>", "y").split(", ")]
    data = [(i, *[r.get(c, [] if c == "labels" else {} if c == "extras" else None) for c in columns]) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, f"ord int, {RECORD}")


def fold(rows):
    """The merge as a plain loop over records."""
    out = {}
    for r in rows:
        old = out.get(r["address"])
        if old is None:
            out[r["address"]] = {**r}
            continue
        promoted = bool(r.get("sanctioned")) and not old.get("sanctioned")
        for f in SCALARS:
            if r.get(f) is not None and (promoted or old.get(f) in (None, "")):
                old[f] = r[f]
        for f in FLAGS:
            old[f] = bool(old.get(f)) or bool(r.get(f))
    return out


def test_merge_is_the_fold(spark):
    rng = random.Random(4)
    rows = [{"address": f"a{rng.randrange(12)}", "chain": rng.choice("xy"), "sanctioned": rng.choice([None, False, True, False]), "entity_name": rng.choice([None, "", "e1", "e2"]), "source_url": rng.choice([None, "", "u"])} for _ in range(150)]
    want = fold(rows)
    for r in store.merge(records(spark, *rows)).collect():
        w = want[r.address]
        assert (r.entity_name, r.source_url, r.sanctioned, r.chain) == (w.get("entity_name"), w.get("source_url"), bool(w.get("sanctioned")), w["chain"])


def test_merge_of_nothing(spark):
    assert store.merge(records(spark)).count() == 0


def test_labels_of_the_first_record_keep_their_duplicates(spark):
    a, b = label("a"), label("b")
    rows = records(spark, {"address": "x", "labels": [a, a]}, {"address": "x", "labels": [a, b, b]}, {"address": "y"})
    got = {r.address: [x.name for x in r.labels] for r in store.united_labels(rows).collect()}
    assert got == {"x": ["a", "a", "b"]}


def test_extras_keep_the_first_by_presence(spark):
    rows = records(spark, {"address": "x", "extras": {"_a": None}}, {"address": "x", "extras": {"_a": "1", "_b": "2"}})
    assert store.united_extras(rows).first().extras == {"_a": None, "_b": "2"}


def test_screen(spark):
    t = "TR7NHqjeKQxGTCi8q8ZY4pL8otSzgjLj6t"
    rows = records(
        spark, {"address": None, "chain": "eth"}, {"address": "a b", "chain": "eth"}, {"address": EVM, "chain": "near"}, {"address": "1" + "a" * 30, "chain": "btc"}, {"address": "A::" + "B" * 20, "chain": "eth"},
        {"address": t, "chain": "trx", "labels": [label(chain="near"), label(chain="TRX"), label()]}, {"address": EVM.upper().replace("0X", "0x"), "chain": "bnb"},
    )
    got = ingest.screen(rows).orderBy("ord").collect()
    assert [r.reject_reason for r in got] == ["no_address", "bad_address", "unknown_chain", "case_destroyed", "synthetic", None, None]
    assert got[5].key == "0xa614f803b6fd780986a42c78ec9c7f77e6ded13c" and got[5].dropped_labels == 1 and [x.chain for x in got[5].labels] == ["tron", None]
    assert (got[6].chain, got[6].key) == ("bsc", EVM)


def test_align(spark):
    rows = records(spark, {"address": "a", "category": "whale", "license_status": "gone", "source_date": "2020-01-02T03:04"}, {"address": "b", "category": "vasp", "source_date": "2020-01"}, {"address": "c", "source_date": "2020-01-02"}, {"address": "d"})
    got = ingest.align(rows).orderBy("ord").collect()
    assert [(r.category, r.source_date) for r in got] == [(None, "2020-01-02"), ("vasp", None), (None, "2020-01-02"), (None, None)]
    assert got[0].extras == {"_category_raw": "whale", "_license_status_raw": "gone", "_source_date_raw": "2020-01-02T03:04"} and got[1].extras == {"_source_date_raw": "2020-01"}
    assert [r.date_invalid_nulled for r in got] == [False, True, False, False]
    assert [r[0] for r in ingest.align(rows).orderBy("ord").select(ingest.is_valid()).collect()] == [False] * 4  # no chain


PR = "ofac_press_release"


@pytest.mark.parametrize(
    ("votes", "want"),
    [([], None), ([("designation", "2020-01-01")], "listed"), ([("designation", "2020-01-01"), ("removal", "2021-01-01")], "removed"), ([("removal", "2021-01-01"), ("designation", "2021-01-01")], "listed"), ([("removal", None), ("x", "2022-01-01")], None), ([("removal", "2021-1-1")], None)],
)
def test_press_status(spark, votes, want):
    rows = records(spark, {"address": "a", "labels": [label(source=PR, action=a, action_date=d) for a, d in votes]})
    assert rows.select(standing.press_status(F.col("labels"))).first()[0] == want


def test_reconcile(spark):
    gone = label(source=PR, action="removal", action_date="2021-01-01")
    rows = records(
        spark, {"address": "a", "sanctioned": True, "is_illicit": True, "category": "sanctioned", "labels": [gone]}, {"address": "b", "sanctioned": True, "labels": [gone, label(kind="Sanctioned", source="eu")]},
        {"address": "c", "sanctioned": True, "labels": [gone, label(kind="scam")]}, {"address": "d", "category": "unknown", "labels": [label(source=PR, action="change", action_date="2021-01-01")]}, {"address": "e"},
    )
    got = standing.reconcile(rows).orderBy("ord").collect()
    assert [(r.sanctioned, r.is_illicit, r.category, r.changed) for r in got] == [(False, False, None, True), (True, True, "sanctioned", True), (False, True, None, True), (True, True, "sanctioned", True), (False, False, None, False)]
    again = standing.reconcile(standing.reconcile(rows).select(rows.columns))
    assert again.where("changed").count() == 0


def test_label_set(spark):
    row = ("eth", EVM, ["b"], ["base"], ["base"], f"eth:{EVM}", False, None, None, True, [])
    base = spark.createDataFrame([row], LABEL_SET)
    good = {"chain": "ethereum", "address": EVM.upper().replace("0X", "0x"), "classes": ["a", "b"], "source_url": "u", "source_date": "d"}
    rows = [good, {**good, "address": ""}, {**good, "address": "x::y"}, {**good, "chain": ""}, {**good, "chain": "tron", "address": "T" + "1" * 33}, {**good, "chain": "btc", "address": "1abcdef"}, {**good, "source_url": None}, {**good, "classes": []}, {**good, "chain": "btc", "address": "1Abc"}]
    names = [c.split()[0] for c in BATCH.split(", ")]
    batch = spark.createDataFrame([(i, *[r.get(n) for n in names]) for i, r in enumerate(rows)], f"ord long, {BATCH}")
    screened = label_set.screen(batch)
    assert [r.reject_reason for r in screened.orderBy("ord").collect()] == [None, *label_set.REASONS, None]
    merged = label_set.merge_batch(base, screened, "b1", "now")
    got = {(r.chain, r.address): r for r in merged.collect()}
    old, new = got["eth", EVM], got["btc", "1Abc"]
    assert old.classes == ["a", "b"] and old.sources == ["attribution_batch:b1", "base"] and not old.is_new and len(old.provenance) == 1
    assert json.loads(old.provenance[0]) == {"anchor_type": None, "attributed_utc": "now", "batch_id": "b1", "method": None, "note": None, "source_date": "d", "source_url": "u"}
    assert new.graph_key is None and new.case_provenance == "attributed:b1" and new.is_new
    label_set.check_append_only(base, merged)
    assert label_set.stats(screened, merged, base)["refused_total"] == 7
    with pytest.raises(gates.GateFailure):
        label_set.verify_base(1, 1, {"parquet_sha256": "a"}, "b")
    assert merged.columns[:-1] == [c.split()[0] for c in LABEL_SET.replace("array<string>", "x").split(", ")]


def test_pages(spark):
    added, gone = "The following individuals have been added to OFAC's SDN List:", "The following deletions have been made to OFAC's SDN List:"
    other = "0x" + "cd" * 20
    html = f"{other} {gone}\n Digital Currency Address - ETH {EVM}; {added}\n Digital Currency Address - ARB {EVM}; Digital Currency Address - QQQ 0x{'ef' * 20} and {EVM}"
    got = {(r.address, r.chain): (r.evidence, r.action, r.action_evidence) for r in pages.address_actions(spark.createDataFrame([("l", html), ("m", None), ("n", "")], "link string, html string")).collect()}
    assert got == {(EVM, "ethereum"): ("ticker", "removal", "section"), (EVM, "arbitrum"): ("ticker", "designation", "section"), (other, "ethereum"): ("shape", "designation", "none")}
    heads = spark.createDataFrame([(h,) for h in ("In addition, the following changes were made", "the following additions and removals", "language added to the below names", "hello")], "h string")
    assert [r[0] for r in heads.select(pages.header_action(F.col("h"))).collect()] == ["change", None, "change", None]
    net = pages.page_actions(pages.address_actions(spark.createDataFrame([("l", html)], "link string, html string")))
    assert {r.address: r.action for r in net.collect()}[EVM] == "designation"


def test_tag_pack(spark):
    hexed = "0xa614f803b6fd780986a42c78ec9c7f77e6ded13c"
    rows = records(
        spark, {"address": EVM, "chain": "ethereum", "labels": [label("A", "ofac", kind="sanctioned"), label("A", "ofac_sdn", "arbitrum"), label(" ", "walletexplorer", "base", kind="exchange"), label("A", "opensanctions"), label("A", "nobody"), label("A", "ofac", "near")]},
        {"address": hexed, "chain": "tron", "labels": [label("SINBAD", "ofac")]},
    )
    screened = tagpack.screen(rows)
    assert {r.skip_reason: r["count"] for r in screened.groupBy("skip_reason").count().collect()} == {None: 4, "licence": 1, "unsourced": 1, "chain": 1}
    tags = tagpack.tags(screened).orderBy("place").collect()
    assert [(t.address, t.currency, t.label, t.category, t.actor, t.context) for t in tags] == [(EVM, "ETH", "A", "sanction", None, '{"chains": ["arbitrum", "ethereum"]}'), (EVM, "ETH", "exchange", "exchange", None, '{"evm_chain": "base"}'), ("TR7NHqjeKQxGTCi8q8ZY4pL8otSzgjLj6t", "TRX", "SINBAD", None, "sinbadio", None)]
    pack = tagpack.tags(screened)
    assert tagpack.header_confidence(pack) is None
    assert tagpack.validate(pack, {"title": "t", "creator": "c", "lastmod": "d"}) == []
    assert len(tagpack.validate(pack.withColumn("currency", F.lit("ETH")).withColumn("label", F.lit(" ")), {})) > 3
    with pytest.raises(gates.GateFailure):
        tagpack.check_floor(pack, 100)


def test_directory(spark):
    rows = [
        {"address": "1", "entity_name": "Kraken Ltd", "jurisdiction": "GB", "license_id": "7", "regulator": "FCA  X", "extras": {"_esma_lei": "A" * 20}}, {"address": "2", "entity_name": "Kraken Longer", "jurisdiction": "GB", "license_id": "8", "regulator": "FCA X"},
        {"address": "3", "entity_name": "kraken", "jurisdiction": "US-NY", "regulator": "NY DFS", "extras": {"_esma_lei": "B" * 20, "_nydfs_license_date": "2020-01-01"}}, {"address": "4", "entity_name": None},
    ]
    raw = records(spark, *rows).withColumn("register", F.when(F.col("ord") < 2, "fca").otherwise("nydfs"))
    built = directory.build(directory.identify(raw, [("kraken", "kraken")], {}, {}))
    got = {r.canonical_id: r for r in built.collect()}
    k = got["alias::kraken"]
    assert (k.name, k.jurisdictions, k.n_licenses, k.source_tags, k.raw_addresses) == ("Kraken Longer", ["GB", "US-NY"], 2, ["fca", "nydfs"], ["1", "2", "3"])
    assert [x.license_id for x in k.licenses] == ["7", "nydfs::kraken"] and k.licenses[1].license_date == "2020-01-01"
    assert got["raw::4"].n_jurisdictions == 0
    assert directory.ranked(built).first().canonical_id == "alias::kraken"
    assert directory.lei_conflicts(built).count() == 1


def test_mixers(spark):
    f = "party_uid string, party_primary_name string, party_all_aliases array<string>, party_programs array<string>, feature_type_id string, feature_id string, chain string, address_raw string, ord long"
    features = spark.createDataFrame([("1", "Sinbad", [], ["DPRK3"], "344", "f1", "btc", "1Abc", 0), ("2", "SEMENOV, Roman", [], ["DPRK3", "CYBER"], "345", "f2", "eth", EVM.upper(), 1), ("3", "Other", ["x"], [], "345", "f3", "eth", EVM, 2)], f)
    listed = spark.createDataFrame([(0, EVM, "Tornado Cash", "t", None, None, 1), (1, "0x1", "other", None, None, None, 1)], "idx int, address string, label string, nameTag string, name string, category string, chainId int")
    got = {r.address: r for r in mixers.registry(features, listed).collect()}
    assert set(got) == {"1Abc", EVM}
    assert got[EVM].entity_program_tags == ["DPRK3", "CYBER"] and got[EVM].operator_party == "2:Semenov_Roman" and [s.kind for s in got[EVM].sources] == ["dawsbot", "ofac_sdn"]
    assert mixers.dprk3_parties(features).count() == 2
    assert all(r.verified for r in mixers.canary(mixers.registry(features, listed), features, listed).collect())
    assert json.loads(mixers.as_written(mixers.registry(features, listed)).where(F.col("address") == EVM).first().sources)[0]["kind"] == "dawsbot"


def test_bridges(spark):
    inner = '{"type":"balanceOfEscrow","escrowAddress":"0xAA","chain":"eth","address":""}'
    docs = spark.createDataFrame([("p/a", "A", f'{{"x":[{inner},{{"y":{inner}}}]}}', "class ScalingProject", 0), ("p/b", "B", inner, "ProjectPrivacyToken", 1), ("p/c", "C", "not json", None, 2)], "path string, project string, body string, declaration string, ord int")
    rows = bridges.registry(docs, "c1", "r", "now")
    assert sorted((r.bridge, r.project_kind, r.escrow_address, r.chain, r.token_address) for r in rows.collect()) == [("A", "scaling_l2", "0xaa", "eth", None), ("B", "privacy", "0xaa", "eth", None)]
    kept, apart = bridges.split(rows)
    assert kept.count() == 1 and apart.count() == 1
    with pytest.raises(gates.GateFailure) as e:
        gates.check(kept, bridges.gates())
    assert e.value.code == 4


def test_probe(spark):
    rows = spark.createDataFrame([("Tornado-Cash pool", "t", [EVM]), ("samourai", "s", []), ("samourai wallet", "s2", ["1A"]), (None, None, None)], "text string, name string, found array<string>")
    grid = probe.cells(rows, "ofac_sdn")
    got = {r.family: (r.distinct_addresses, r.named_match_count) for r in grid.collect()}
    assert got["tornado_cash"] == (1, 1) and got["samourai"] == (1, 1) and got["helix"] == (0, 0)
    assert {r.family: r.decision for r in probe.decide(grid, True, True).collect()}["helix"] == "CEILING"
    assert {r.decision for r in probe.decide(grid, False, True).collect()} == {"ABSTAIN"}
    parties = spark.createDataFrame([("DPRK3; X", "a; b; "), ("DPRK30", "c"), (None, "d")], "programs string, id_values string")
    assert tuple(probe.control(parties).first()) == (1, 2, False)


def test_scan(spark, tmp_path):
    (tmp_path / "a.py").write_text('x = "sec" + "ret"\n')
    (tmp_path / "b.txt").write_text("secret")
    (tmp_path / "link").symlink_to("nowhere")
    (tmp_path / ".git").mkdir()
    (tmp_path / ".git" / "c.txt").write_text("secret")
    rows = scan.tree(spark, str(tmp_path))
    patterns = spark.createDataFrame([("s", "secret", "text"), ("l", "^link$", "path")], scan.PATTERN)
    got = {(r.path, r.name, r.obfuscated) for r in scan.violations(rows, patterns).collect()}
    assert got == {("a.py", "s", True), ("b.txt", "s", False), ("link", "l", False)}
    exempt = spark.createDataFrame([("b.txt", "s")], "path string, name string")
    assert scan.violations(rows, patterns, exempt).count() == 2


def test_dedupe(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2), (None, 5), (None, 4)], "k string, o int")
    assert {r.k: r.o for r in dedupe.first_wins(df, ["k"], ["o"]).collect()} == {"a": 1, "b": 2, None: 4}
    assert {r.k: r.o for r in dedupe.last_wins(df, ["k"], ["o"]).collect()} == {"a": 3, "b": 2, None: 5}
    assert [r.k for r in dedupe.top(df, "k", 2, "o").collect()] == ["a", None]
    assert tuple(dedupe.overlap(df, df.where("k = 'a'"), "k").first()) == (3, 1, 2, 0)
    assert dedupe.sample(df, "o", 2).collect() == dedupe.sample(df.repartition(3), "o", 2).collect()
    empty = df.limit(0)
    assert dedupe.first_wins(empty, ["k"], ["o"]).count() == 0 and tuple(dedupe.overlap(empty, empty, "k").first()) == (0, 0, 0, 0)


def test_walk_of_many_and_deep_documents(spark):
    """More objects than a recursive query may return, and one 200 levels down."""
    body = F.concat(F.lit('{"e":[{"f":{"type":"balanceOfEscrow","escrowAddress":"0xA'), "id", F.lit('"}},{"x":[1,2,{"y":[3,{"type":"sum","z":[4,5,6]}]}]}]}'))
    many = spark.range(100_000).select(F.col("id").cast("string").alias("path"), body.alias("body"))
    assert bridges.walk(many).agg(F.count_distinct("escrow_address")).first()[0] == 100_000
    deep = "[" * 200 + '{"type":"balanceOfEscrow","escrowAddress":"0xD","chain":"c"}' + "]" * 200
    rows = spark.createDataFrame([("a", deep), ("b", "no json"), ("c", None), ("d", "{}"), ("e", "3")], "path string, body string")
    assert [tuple(r) for r in bridges.walk(rows).collect()] == [("a", "0xD", "c", None)]


def test_header_rules():
    """Each rule decides, in order."""
    assert [a for *_, a in pages.ANNOUNCES] == ["change", "removal", "designation", None, "change"]


def test_walk_of_deep_large_and_broken_documents(spark):
    inner = '{"type":"balanceOfEscrow","escrowAddress":"0x\\u0061","chain":"eth","address":null}'
    bodies = {"deep": "[" * 5000 + inner + "]" * 5000, "twice": '{"type":"x","type":"balanceOfEscrow","escrowAddress":"0xb"}', "cut": "[" + inner, "wrong": "[" + inner + "}", "comma": "[1,]", "empty": "", "plain": f"[{inner}]", "null": None}
    docs = spark.createDataFrame(list(bodies.items()), "path string, body string")
    assert sorted((r.path, r.escrow_address, r.chain) for r in bridges.walk(docs).collect()) == [("deep", "0xa", "eth"), ("plain", "0xa", "eth"), ("twice", "0xb", None)]
    assert sorted(r.path for r in bridges.failures(docs).collect()) == ["comma", "cut", "empty", "wrong"]
    assert list(bridges.escrows('["' + "x" * 130_000_000 + f'",{inner}]')) == [("0xa", "eth", None)]


def test_page_records_look_for_addresses_once(spark):
    """The net action stands beside the rows; a join of the actions with themselves found every address twice."""
    rows = spark.createDataFrame([("/recent-actions/20210101", "<h1>T</h1><p>The following deletions have been made to the List:\n</p> 0x" + "ab" * 20 + " The following individuals have been added to the List:\n 0x" + "ab" * 20)], "link string, html string")
    out = pages.records(pages.address_actions(rows), pages.about(rows))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") == 1
    context = out.first()["labels"][0]["context"]
    assert (context["action"], context["action_evidence"], context["sections"]) == (pages.page_actions(pages.address_actions(rows)).first()["action"], "section", ["designation", "removal"])


def test_names_of_labels_are_mapped_once_each(spark):
    from chainlattice.operators import vasp_map

    label = lambda name, kind="exchange": f"named_struct('name', {name}, 'type', '{kind}')"
    labels = {"a": [label("'Foo Ltd: 1'"), label("'Red 2'")], "b": [label("''"), label("'Red 3'")], "c": [label("'Binance OKX'"), label("null")], "d": [label("'Red'", "other")], "e": [label("'Binance OKX 7'")]}
    store = spark.range(1).select(F.explode(F.map_from_arrays(F.array(*map(F.lit, labels)), F.array(*[F.expr(f"array({', '.join(x)})") for x in labels.values()]))).alias("address", "labels")).withColumn("chain", F.lit("eth"))
    index = vasp_map.label_index(store, [("red", "r")], {})
    assert {r.address: r.canonical_id for r in index.collect()} == {"a": "name::foo", "b": "alias::r", "c": None, "e": None}
    assert [(r.brand, r.n) for r in vasp_map.unmapped_brands(index).collect()] == [("binance okx", 2), ("(empty)", 1)]
    for rows in (index, vasp_map.unmapped_brands(index)):  # no rule in a filter, which Spark would push to every row
        assert not [x for x in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in x and "regexp_replace" in x]


def test_pages_of_old_links_are_not_looked_through(spark):
    rows = spark.createDataFrame([("/a/20181127", "x"), ("/a/20181128_33", "x"), ("/a/b", '<time datetime="2017-05-06">'), (None, "x")], "link string, html string")
    assert [r.link for r in pages.recent(rows).collect()] == ["/a/20181128_33", "/a/b", None]
    good, bad = "1A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNa", "1A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNb"
    found = spark.createDataFrame([("l", f"{good} {bad} ltc1{'q' * 39} LTC1Q")], "link string, html string")
    assert {(r.address, r.chain) for r in pages.address_actions(found).collect()} == {(good, "bitcoin"), ("ltc1" + "q" * 39, "litecoin")}
