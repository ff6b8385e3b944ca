"""The command line on small folders: files in, files out, exit codes."""

import json

from chainlattice.commands import COMMANDS, main

EVM = "0x" + "ab" * 20
LABEL = {"name": "Kraken 3", "type": "exchange", "source": "walletexplorer", "chain": "ethereum"}


def test_store_tag_pack_and_mapping(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.json").write_text(json.dumps([{"address": EVM, "chain": "eth", "labels": [LABEL], "_x": "1"}, {"address": "bad", "chain": "eth"}]))
    out, manifest = str(tmp_path / "store.json"), str(tmp_path / "m.json")
    assert main(["merge-to-unified", "--raw-dir", str(raw), "--output", out, "--manifest", manifest], spark) == 0
    assert json.load(open(out))[EVM]["labels"][0]["name"] == "Kraken 3" and json.load(open(manifest))["refused"] == {"a.json:bad_address": 1}
    assert main(["merge-to-unified", "--raw-dir", str(raw), "--base", out, "--output", out + "2"], spark) == 0
    assert list(json.load(open(out + "2"))) == [EVM]
    pack = str(tmp_path / "p.yaml")
    assert main(["generate-tagpack", "--labels", out, "--out", pack], spark) == 1
    assert main(["generate-tagpack", "--labels", out, "--out", pack, "--min-rows", "1", "--lastmod", "2024-01-01"], spark) == 0
    assert 'label: "Kraken 3"' in open(pack).read()
    regs = tmp_path / "regs"
    regs.mkdir()
    for tag in ("esma", "fca", "nydfs", "mas", "fincen", "hk_sfc", "jp_jfsa", "ch_finma", "uae_vara"):
        (regs / f"{tag}.json").write_text(json.dumps([{"address": tag, "entity_name": "Kraken Ltd", "jurisdiction": tag[:2].upper()}]))
    directory = str(tmp_path / "d.parquet")
    assert main(["merge-vasp-directory", "--raw-dir", str(regs), "--out-parquet", directory, "--out-json", str(tmp_path / "d.json")], spark) == 0
    assert json.load(open(tmp_path / "d.json"))[0]["n_jurisdictions"] >= 8
    mapped = str(tmp_path / "v.parquet")
    assert main(["build-vasp-to-address", "--directory", directory, "--labels", out, "--output", mapped], spark) == 2
    assert main(["build-vasp-to-address", "--directory", directory, "--labels", out, "--output", mapped, "--allow-partial"], spark) == 0
    assert spark.read.parquet(mapped).first().address == EVM


def test_label_set_command(spark, tmp_path):
    batch = tmp_path / "b.jsonl"
    batch.write_text(json.dumps({"chain": "eth", "address": EVM, "classes": ["x"], "source_url": "u", "source_date": "d"}) + "\n")
    out = tmp_path / "out"
    run = ["build-label-set", "--batch", str(batch), "--batch-id", "b1", "--out-dir", str(out), "--attributed-utc", "now"]
    assert main(run, spark) == 0 and not out.exists()
    assert main([*run, "--execute"], spark) == 0
    assert spark.read.parquet(str(out / "label_set.parquet")).first().address == EVM
    assert main([*run, "--base", str(out / "label_set.parquet"), "--base-manifest", str(out / "manifest.json")], spark) == 1


def test_gate_command(spark, tmp_path):
    (tmp_path / "a.txt").write_text("clean")
    assert main(["sanitize-gate", "--root", str(tmp_path)], spark) == 2
    assert main(["sanitize-gate", "--root", str(tmp_path), "--public-mode"], spark) == 0
    (tmp_path / "b.py").write_text('x = "AKIA" + "ABCDEFGHIJKLMNOP"')
    assert main(["sanitize-gate", "--root", str(tmp_path), "--public-mode"], spark) == 1
    (tmp_path / "none").mkdir()
    assert main(["sanitize-gate", "--root", str(tmp_path / "none"), "--public-mode"], spark) == 2
    (tmp_path / "o").write_text("import os")
    assert main(["sanitize-gate", "--root", str(tmp_path), "--public-mode", "--overrides", str(tmp_path / "o")], spark) == 2
    (tmp_path / "p").write_text("name: clean\n")
    assert main(["sanitize-gate", "--root", str(tmp_path), "--private-patterns", str(tmp_path / "p")], spark) == 1


def test_pages_and_lists(spark, tmp_path):
    import hashlib

    index, cache = tmp_path / "i", tmp_path / "c"
    index.mkdir()
    cache.mkdir()
    (index / "x.html").write_text('<a href="/recent-actions/20200101">')
    page = f"<h1>Cyber</h1> The following individuals have been added to the List:\n Digital Currency Address - ETH {EVM}; SDGT" + " " * 600
    (cache / (hashlib.sha1(b"/recent-actions/20200101").hexdigest() + ".html")).write_text(page)
    out = str(tmp_path / "o.json")
    assert main(["parse-ofac-press-releases", "--index-dir", str(index), "--cache-dir", str(cache), "--output", out], spark) == 0
    r = json.load(open(out))[0]
    assert (r["address"], r["category"], r["sanctions_reference"], r["labels"][0]["context"]["action_date"]) == (EVM, "sanctioned", "OFAC; SDGT", "2020-01-01")
    assert main(["parse-opensanctions", "--input", str(tmp_path / "no"), "--output", out], spark) == 1
    assert main(["fetch-ofac-primary", "--out", str(tmp_path / "w"), "--from-dir", str(tmp_path)], spark) == 1
    assert len(COMMANDS) >= 19
