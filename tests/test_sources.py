"""Readers and writers on small files."""

import json

import pytest
from pyspark.sql import functions as F

from chainlattice.operators import ingest, store
from chainlattice.sources import feeds, ofac, registers, stores

EVM = "0x" + "ab" * 20


def write(path, content):
    path.write_text(content if isinstance(content, str) else json.dumps(content), encoding="utf-8")
    return str(path)


def test_records_of_lists_and_objects(spark, tmp_path):
    rec = {"address": EVM, "chain": "eth", "sanctioned": True, "labels": [{"name": "é", "type": "x", "source": "s", "chain": "eth", "context": {"source_url": "u"}}], "_k": 1, "_n": None}
    write(tmp_path / "a.json", [rec, {"chain": "btc"}])
    write(tmp_path / "b.json", {EVM: {"chain": "base"}, "zz": {"address": "own", "chain": "x"}})
    rows = stores.read_many(spark, str(tmp_path)).orderBy("ord").collect()
    assert [(r.file, r.address, r.chain) for r in rows] == [("a.json", EVM, "eth"), ("a.json", None, "btc"), ("b.json", EVM, "base"), ("b.json", "own", "x")]
    assert rows[0].sanctioned is True and rows[0].labels[0].name == "é" and rows[0].labels[0].context.source_url == "u" and rows[0].extras == {"_k": "1", "_n": None}
    with pytest.raises(FileNotFoundError):
        stores.read_many(spark, str(tmp_path), ["c.json"])
    assert stores.read_many(spark, str(tmp_path), []).count() == 0


def test_pipeline_of_files_is_deterministic(spark, tmp_path):
    write(tmp_path / "a.json", [{"address": EVM, "chain": "eth", "entity_name": "A", "labels": []}, {"address": EVM, "chain": "eth", "sanctioned": True, "entity_name": "B"}, {"address": "bad", "chain": "eth"}])
    digests = set()
    for i in range(2):
        rows = ingest.screen(stores.read_many(spark, str(tmp_path), ["a.json"]).repartition(3))
        ok = ingest.align(rows.where("reject_reason is null")).withColumn("address", F.col("key"))
        merged = store.merge(ok)
        assert stores.write_store(merged, str(tmp_path / f"out{i}")) == 1
        digests.add((stores.file_digest(str(tmp_path / f"out{i}")), stores.content_digest(merged)))
    assert len(digests) == 1
    assert json.loads((tmp_path / "out0").read_text())[EVM]["entity_name"] == "B"


def test_batch_and_label_set(spark, tmp_path):
    path = write(tmp_path / "b.jsonl", '{"chain":"eth","address":"0x1","classes":["a"]}\n\n{"chain":"eth"}\n')
    assert [(r.ord, r.classes) for r in stores.read_batch(spark, path).collect()] == [(0, ["a"]), (2, None)]
    assert stores.read_label_set(spark, None).count() == 0
    with pytest.raises(ValueError):
        stores.write_table(stores.read_label_set(spark, None), str(tmp_path / "t"), ["chain"])


def test_tag_pack_file(spark, tmp_path):
    tags = spark.createDataFrame([("a", "ETH", "l: x", "s", None, "unknown", None, '{"a": 1}', 1)], "address string, currency string, label string, source string, category string, confidence string, actor string, context string, place int")
    assert stores.write_tagpack(tags, {"title": "t"}, str(tmp_path / "p.yaml"), "unknown") == 1
    assert (tmp_path / "p.yaml").read_text() == 'title: "t"\nconfidence: "unknown"\ntags:\n- address: "a"\n  currency: "ETH"\n  label: "l: x"\n  source: "s"\n  context: "{\\"a\\": 1}"\n'


def test_sanctions_csv(spark, tmp_path):
    remark = f"DOB; Digital Currency Address - XBT TR7NHqjeKQxGTCi8q8ZY4pL8otSzgjLj6t; alt. Digital Currency Address - ETH {EVM.upper().replace('0X', '0x')}; Digital Currency Address - ZZZ {'A' * 30}."
    path = write(tmp_path / "sdn.csv", f'1,"DOE, John ""J""","individual","P] [Q","-0- ",,,,,,,"{remark}"\n2,short\n')
    got = ofac.addresses(ofac.read_csv(spark, path)).orderBy("pos").collect()
    assert [(r.ticker, r.chain, r.address) for r in got] == [("XBT", "tron", "TR7NHqjeKQxGTCi8q8ZY4pL8otSzgjLj6t"), ("ETH", "ethereum", EVM), ("ZZZ", "unknown", "A" * 30)]
    assert got[0].entity_name == 'DOE, John "J"' and ofac.on_chain(ofac.addresses(ofac.read_csv(spark, path))).count() == 1
    assert ofac.records(ofac.addresses(ofac.read_csv(spark, path)), "2024-01-01").count() == 2


def test_enhanced_xml(spark, tmp_path):
    path = write(
        tmp_path / "e.xml",
        f"""<sanctionsData><entities><entity id="007"><sanctionsPrograms><sanctionsProgram refId="1">B</sanctionsProgram><sanctionsProgram refId="2">A</sanctionsProgram><sanctionsProgram refId="2">A</sanctionsProgram></sanctionsPrograms>
<names><name><translations><translation><formattedFullName>X Y</formattedFullName></translation></translations></name></names>
<features><feature id="1"><type featureTypeId="345">Digital Currency Address - ETH</type><value> {EVM} </value></feature><feature id="2"><type featureTypeId="1">Other</type><value>v</value></feature></features></entity></entities></sanctionsData>""",
    )
    got = ofac.read_enhanced(spark, path).collect()
    assert [(r.entity_id, r.entity_name, r.programs, r.currency, r.address) for r in got] == [("007", "X Y", ["A", "B"], "ETH", EVM)]


def test_advanced_xml(spark, tmp_path):
    path = write(
        tmp_path / "a.xml",
        f"""<Sanctions><DistinctParties><DistinctParty FixedRef="9"><Profile ID="9"><Identity ID="1"><Alias Primary="true"><DocumentedName ID="1"><DocumentedNamePart><NamePartValue NamePartGroupID="1">SINBAD</NamePartValue></DocumentedNamePart></DocumentedName></Alias></Identity>
<Feature ID="f" FeatureTypeID="345"><FeatureVersion ID="1"><VersionDetail DetailTypeID="1">{EVM}</VersionDetail></FeatureVersion></Feature></Profile></DistinctParty></DistinctParties>
<SanctionsEntries><SanctionsEntry ID="1" ProfileID="9"><SanctionsMeasure ID="1"><Comment>DPRK3</Comment></SanctionsMeasure><SanctionsMeasure ID="2"><Comment></Comment></SanctionsMeasure></SanctionsEntry></SanctionsEntries></Sanctions>""",
    )
    r = ofac.read_advanced(spark, path).first()
    assert (r.party_uid, r.party_primary_name, r.chain, r.address_raw, r.party_programs) == ("9", "SINBAD", "eth", EVM, ["DPRK3"])
    assert ofac.parties(ofac.read_advanced(spark, path)).first().programs == "DPRK3"


def test_spellbook(spark, tmp_path_factory):
    tmp_path = tmp_path_factory.mktemp("sqlfiles")  # a path with /test_ in it is left out
    write(tmp_path / "cex_addresses.sql", f"VALUES ({EVM}, 'Kraken', 'Kraken 2', 'x', date '2020-01-01'), ('bnb', {EVM}, 'N', 'dex', 1)")
    write(tmp_path / "readme.md", "cex")
    files = feeds.sql_files(feeds.read_texts(spark, str(tmp_path)), ["cex"])
    got = feeds.spellbook(files).orderBy("ord").collect()
    assert [(r.chain, r.entity_name, r.distinct_name, r.category) for r in got] == [("ethereum", "Kraken", "Kraken 2", "exchange"), ("bnb", "N", None, "dex")]
    base = spark.createDataFrame([(EVM, "eth", [], False, False, False)], f"address string, chain string, labels array<{store.LABEL}>, is_exchange boolean, is_ai_agent boolean, is_illicit boolean")
    assert [x.name for x in store.add_spellbook(base, feeds.spellbook(files)).first().labels] == ["Kraken Kraken 2", "N"]


def test_entities(spark, tmp_path):
    wallet = {"id": "w", "schema": "CryptoWallet", "datasets": ["ransomwhere"], "last_change": "2020", "properties": {"publicKey": [EVM, "?"], "holder": ["none", "h"], "topics": ["crime"]}}
    path = write(tmp_path / "e.jsonl", "\n".join([json.dumps(wallet), "broken{", json.dumps({"id": "h", "schema": "Person", "properties": {"alias": ["Al"]}})]))
    got = feeds.wallets(feeds.read_entities(spark, path), "https://x").collect()
    assert [(r.address, r.chain, r.entity_name, r.category, r.labels[0].type, r.labels[0].subtype) for r in got] == [(EVM, "ethereum", "Al", None, "illicit", "ransomware")]


def test_incidents(spark, tmp_path):
    rekt = {"id": "1", "project_name": "P", "date": "2021", "token_address": EVM, "scam_type": {"type": "Rugpull"}, "scamNetworks": [{"networks": {"name": "AVAX"}}, {"networks": {"name": "Base"}}], "token_addresses": [{"address": "0x" + "cd" * 20, "network": {"name": "BNB"}}, "T" + "A" * 33], "description": f"at {EVM}"}
    write(tmp_path / "1.json", rekt)
    write(tmp_path / "2.json", "broken")
    got = sorted((r.address[:4], r.chain) for r in feeds.incidents(feeds.read_incidents(spark, str(tmp_path))).collect())
    assert got == [("0xab", "avalanche_c"), ("0xab", "base"), ("0xcd", "bsc"), ("TAAA", "tron")]


def test_label_lists(spark):
    docs = spark.createDataFrame([('[{"address":"a","label":"l","chainId":56}]',), ('{"mixers":[{"address":"b"}]}',), ('{"c":{"name":"n"}}',)], "body string")
    assert sorted((r.address, r.label or r.name or r.category) for r in feeds.label_list(docs).collect()) == [("a", "l"), ("b", "mixers"), ("c", "n")]


def test_action_pages(spark, tmp_path):
    index = spark.createDataFrame([('<a href="/recent-actions/20200101">',), ("<loc>https://ofac.treasury.gov/recent-actions/20190101</loc>",)], "body string")
    links = feeds.action_links(index)
    assert [r.link for r in links.collect()] == ["/recent-actions/20190101", "/recent-actions/20200101"]
    import hashlib

    write(tmp_path / (hashlib.sha1(b"/recent-actions/20200101").hexdigest() + ".html"), "x" * 600)
    assert [r.link for r in feeds.cached_pages(spark, str(tmp_path), links).collect()] == ["/recent-actions/20200101"]


def test_registers(spark, tmp_path):
    esma = registers.read_esma(spark, write(tmp_path / "e.csv", '﻿ae_lei,ae_lei_name,ae_commercial_name,ae_homeMemberState,ac_authorisationNotificationDate\nL1,Legal,,DE,01/02/2024\n,,,FR,\n,,"Stra�e, X",AT,\n'))
    got = registers.esma(esma, "2024-01-01", "https://e", "casp").collect()
    assert [(r.address, r.entity_name, r.license_status, r.extras.get("_esma_authorisation_date")) for r in got] == [("L1", "Legal", "active", "2024-02-01"), ("esma::strae,_x", "Strae, X", "pending", None)]
    assert registers.esma_united(registers.esma(esma.unionByName(esma), "d", "u", "f").withColumn("ord", F.monotonically_increasing_id()), "ord").count() == 2
    fincen = registers.read_fincen(spark, write(tmp_path / "f.tsv", "LEGAL NAME\t" + "\t".join("abcdefghijkl") + "\nBitcoin Co\tX\ts\tc\tNY\tz\t401\t\t\t\tmany\t1/2/2024\t\nshort\n\n"))
    assert [(r.legal_name, r.branches) for r in fincen.where(registers.is_crypto_msb([])).collect()] == [("Bitcoin Co", 0)]
    assert registers.fincen(fincen, "d").first().extras["_fincen_auth_date"] == "2024-01-02"
    finma = registers.read_finma(spark, write(tmp_path / "c.csv", "Name;City;AuthorisationTypeDE;AuthorisationTypeFR;AuthorisationTypeIT;AuthorisationTypeEN;UID\nSygnum Bank AG;Z;;;;Bank;C1\nOther;Z;;;;Bank;C2\nSDX;Z;;;;Swiss trading venue;C3\n")).withColumn("ord", F.monotonically_increasing_id())
    kept = registers.finma_kept(finma, ["Sygnum"], "ord")
    assert {r.uid: r.reason for r in kept.collect()} == {"C1": "seed:Sygnum|auth:Bank", "C3": "auth-type:Swiss trading venue"}
    assert {r.extras.get("_ch_legal_form") for r in registers.finma(kept, "d", "u").collect()} == {"AG", None}
    html = '<table><tr><th>h</th></tr><tr><td data-label="VASP Name">B &amp; C FZE (Trade)</td><td data-label="Licensed Activities">VA Custody Services Exchange Services</td><td data-label="Status">Issued</td><td data-label="Licence Issued">2024/01/05</td></tr></table>'
    vara = registers.vara(registers.vara_rows(spark.createDataFrame([(html,)], "body string")), "d", "u").first()
    assert (vara.entity_name, vara.license_status, vara.extras["_vara_categories"], vara.extras["_vara_licence_issued"]) == ("B & C FZE", "active", '["VA Custody Services","Exchange Services"]', "2024-01-05")
    listing = registers.mas_listing(spark.createDataFrame([('<a href="/fid/institution/detail/431405-2C2P-Pte-Ltd">',)], "body string"))
    assert listing.first().name == "2C2P Pte Ltd"
    detail = registers.mas_details(spark.createDataFrame([("s", '<h2>Major Payment Institution</h2><li>Digital Payment Token Service</li><a href="tel:+65 1">')], "slug string, body string"))
    assert detail.where(registers.is_dpt_licensee()).first().phone == "+65 1"
    page = 'var amloDetailData = [{"actType":101,"effDate":"Apr 19, 2024 12:00:00 AM","status":"A"}]; var raDetailData = [{"actType":7},{"actType":1},{"actType":7}];'
    details = registers.sfc_details(spark.createDataFrame([("B1", page)], "ceref string, body string"))
    items = spark.createDataFrame([(0, "B1", "F", None, "Y", "N", "N", None), (1, "B2", "G", " ", None, None, "Y", "a")], "o int, ceref string, name string, nameChi string, hasActiveLicence string, hasActiveLicenceAmlo string, isDeemedLicenceAmlo string, full_address string")
    got = {r.license_id: (r.license_status, r.extras.get("_hk_amlo_effective_date"), r.extras.get("_hk_sfo_act_types")) for r in registers.sfc(items, details, "d", "u/{ceref}", "o").collect()}
    assert got == {"B1": ("active", "2024-04-19", "[1,7]"), "B2": ("pending", None, None)}
    hits = spark.createDataFrame([("s", 0, "x/Firm/1", "Firm", None), ("s", 1, "", "Firm", "2"), ("s", 2, None, "Individual", "3")], "seed string, pos int, url string, kind string, reference string")
    firms = spark.createDataFrame([("1", "A", "Authorised", "MLRs Registered", "01/02/2020", None, None), ("2", "B", "x", None, None, None, None)], "frn string, name string, status string, mlr_status string, mlr_date string, business_type string, companies_house string")
    assert [r.address for r in registers.fca(firms, registers.fca_candidates(hits), "d").collect()] == ["fca::frn::1"]
    cells = spark.createDataFrame([(0, 0, ["近畿財務局\n【計2業者】", "登録番号", "", "", "", "", "", "", ""]), (0, 1, [None, "第０００３１号", "令和元年9月6日", "株式会社bitFlyer※1", "1", "", "", "", ""]), (0, 2, [None, "関東財務局長\n第00001号", "x", "コイン株式会社", "", "", "", "", ""])], "page int, pos int, c array<string>")
    jp = {r.address: r for r in registers.jfsa(cells, "d", "u").collect()}
    assert set(jp) == {"jp_jfsa::license_id::kinki-00031", "jp_jfsa::license_id::kanto-00001"}
    assert jp["jp_jfsa::license_id::kinki-00031"].extras["_jp_latin_alias"] == "bitFlyer" and jp["jp_jfsa::license_id::kinki-00031"].extras["_jp_registration_date_iso"] == "2019-09-06"
    ny = registers.nydfs(spark.createDataFrame([("Paxos Trust", "BitLicense", "2015-05-07", "active")], "name string, license_type string, license_date string, status string"), "d", "u").first()
    assert ny.address == "nydfs::paxos_trust"
    tags = spark.createDataFrame([("T1", "Binance-Hot 1"), ("T2", "Who: 3"), ("T3", None), ("T4", "SR-x"), ("T5", "")], "address string, tag string")
    assert {r.address: (r.entity_name, r.category) for r in registers.tronscan(tags, "d").collect()} == {"T1": ("Binance", "vasp"), "T2": ("Who", "exchange_depositor")}


def test_landed_rows_are_dealt_over_files(spark, monkeypatch):
    from chainlattice.plans import landing

    monkeypatch.setattr(landing, "PART", 10)
    rows = spark.range(35).withColumn("line", landing.tag("entity", F.col("id").cast("string"), id=F.col("id")))
    path = landing.landed(rows, F.col("line"), "id", "xml", "all")
    got = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file")).where(F.startswith("value", F.lit("<entity"))).groupBy("file").count().collect()
    assert len(got) > 1 and sum(r["count"] for r in got) == 35 and max(r["count"] for r in got) < 35
    assert {r._id for r in spark.read.format("xml").option("rowTag", "entity").schema("_id long").load(path).collect()} == set(range(35))
    assert spark.read.text(landing.landed(rows, F.col("line"), "id", "one", one=True)).select("_metadata.file_name").distinct().count() == 1


def test_store_is_written_by_tasks(spark, tmp_path, monkeypatch):
    import pyspark.sql.classic.dataframe as classic

    def refuse(*_, **__):
        raise AssertionError("rows go to the driver")

    for name in ("toLocalIterator", "collect", "toPandas", "toArrow"):
        monkeypatch.setattr(classic.DataFrame, name, refuse)
    rows = spark.range(500, numPartitions=7).select((500 - F.col("id")).alias("ord"), F.concat(F.lit('é" \n'), F.col("id").cast("string")).alias("address"), F.lit("eth").alias("chain"), F.lit(None).cast("string").alias("entity_name"), F.create_map(F.lit("_x"), F.col("id").cast("string")).alias("extras"))
    path = str(tmp_path / "store.json")
    assert stores.write_store(rows, path) == 500
    with open(path, encoding="utf-8", newline="") as f:
        text = f.read()
    assert text == "{" + ",".join("\n" + json.dumps(f'é" \n{i}') + ": " + json.dumps({"address": f'é" \n{i}', "chain": "eth", "_x": str(i)}, ensure_ascii=False) for i in range(499, -1, -1)) + "\n}\n"
    assert stores.write_store(rows.where("ord < 0"), path) == 0 and (tmp_path / "store.json").read_text() == "{\n}\n"
