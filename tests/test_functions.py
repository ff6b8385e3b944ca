"""Scalar functions on hand-made values, nulls and empty strings among them."""

import hashlib
import html
import random
import re
import time
from html.entities import html5

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chainlattice.functions import address, base58, chains, dates, names, text
from chainlattice.plans.catalog import ORACLE_SQL

B58 = base58.ALPHABET


def values(spark, expr, *rows):
    """expr over rows of one string column x."""
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def encode(data: bytes) -> str:
    n, out = int.from_bytes(data, "big"), ""
    while n:
        n, r = divmod(n, 58)
        out = B58[r] + out
    return "1" * (len(data) - len(data.lstrip(b"\0"))) + out


def checked(payload: bytes) -> str:
    return encode(payload + hashlib.sha256(hashlib.sha256(payload).digest()).digest()[:4])


def test_chains(spark):
    x = F.col("x")
    assert values(spark, chains.normalize_chain(x), " ETH ", "xDai", "Solana", None, "") == ["ethereum", "gnosis", "solana", "", ""]
    assert values(spark, chains.resolve_bnb(F.lit("bnb"), x), "0xAB", " 0Xab", "bnb1q", None) == ["bsc", "bsc", "bnb_beacon", "bnb_beacon"]
    assert values(spark, chains.is_canonical_chain(x), "evm", "near", None) == [True, False, False]
    assert values(spark, chains.set_chain(x), "Bitcoin", "xdai", "sui") == ["btc", "gnosis", "sui"]


def test_case_policy(spark):
    x = F.col("x")
    evm = "0x" + "Ab" * 20
    assert values(spark, address.canonical_case(x), f" {evm} ", "BC1QXY", "bc1Qxy", " 1AbC ") == [evm.lower(), "bc1qxy", "bc1Qxy", "1AbC"]
    assert values(spark, address.is_case_destroyed(x), "1abc", "1aBc", "123", evm.lower(), "bc1qq") == [True, False, False, False, False]
    assert values(spark, address.is_case_destroyed(x, F.lit("eth")), "1abc") == [False]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.binary(min_size=20, max_size=20), min_size=1, max_size=20))
def test_base58_round_trip(spark, payloads):
    tron = [checked(b"\x41" + p) for p in payloads]
    assert values(spark, base58.tron_to_hex(F.col("x")), *tron) == ["0x" + p.hex() for p in payloads]
    assert values(spark, base58.hex_to_tron(F.col("x")), *["0x" + p.hex() for p in payloads]) == tron


def test_base58_refuses(spark):
    good = checked(b"\x41" + bytes(range(20)))
    bad = good[:-1] + ("1" if good[-1] != "1" else "2")
    legacy = [checked(b"\x00" + bytes(20)), checked(b"\x05" + bytes(range(1, 21)))]
    x = F.col("x")
    assert values(spark, base58.tron_to_hex(x), bad, good + "1", "0OIl", "", None) == [None] * 5
    assert values(spark, base58.is_bitcoin_legacy(x), *legacy, good, "", None) == [True, True, False, False, False]
    assert values(spark, base58.is_tron(x), "TR7NHqjeKQxGTCi8q8ZY4pL8otSzgjLj6t") == [True]
    assert values(spark, base58.tron_to_hex(x), "TR7NHqjeKQxGTCi8q8ZY4pL8otSzgjLj6t") == ["0xa614f803b6fd780986a42c78ec9c7f77e6ded13c"]


def test_chain_by_form(spark):
    rows = [checked(b"\x41" + bytes(20)), "0x" + "a" * 40, checked(b"\x00" * 21), "bc1qxyz", "ltc1qq", "r" + "A" * 30, "4" + "A" * 94, "D" + "A" * 33, "t1" + "A" * 33, "X" + "A" * 33, "G" + "A" * 33, "bnb1" + "q" * 38, "S" + "A" * 40, "?"]
    want = "tron ethereum bitcoin bitcoin litecoin xrp monero dogecoin zcash dash bitcoin_gold bnb_beacon solana unknown".split()
    assert values(spark, address.chain_by_form(F.col("x")), *rows) == want
    assert values(spark, address.infer_chain(F.lit("XBT"), F.col("x")), rows[0], rows[1]) == ["tron", "bitcoin"]
    assert values(spark, address.infer_chain(F.lit("USDT"), F.col("x")), rows[1], rows[2]) == ["ethereum", "bitcoin"]


@pytest.mark.parametrize(("name", "root"), [("Binance 14", "Binance"), ("Binance #3", "Binance"), ("Kraken.com", "Kraken"), ("OKX Hot Wallet Deposit", "OKX"), ("Gate: ", "Gate"), ("Huobi-", "Huobi"), (None, ""), (" ", ""), ("Cold Wallet", "Cold")])
def test_entity_root(spark, name, root):
    assert values(spark, names.entity_root(F.col("x")), name) == [root]


def test_normalize_name(spark):
    rows = ["Coinbase Global, Inc.", "LTD", "株式会社bitFlyer", "Payward  Ventures LLC", "A/B_C Trust Company", None, "Crypto.com Holdings Group"]
    assert values(spark, names.normalize_name(F.col("x")), *rows) == ["coinbase", "ltd", "株式会社bitflyer", "payward ventures", "a b c", "", "crypto com"]


def test_names(spark):
    x = F.col("x")
    assert values(spark, names.label_brand(x), "Coinbase 14", "Kraken-Cold", "Binance: Hot Wallet", None) == ["coinbase", "kraken", "binance", ""]
    assert values(spark, names.is_junk_name(x), "Huobi Foundation", "Binance Kraken Ltd", "Kraken", None) == [True, True, False, False]
    rules = [("bin", "b"), ("kraken", "k")]
    assert values(spark, names.label_to_canonical(x, rules, {"okx": "okx"}), "OKX 3", "Kraken 1", "Gate.io", "Solo 1", "OKXLE", "") == ["alias::okx", "alias::k", "alias::gate_io", "name::solo", None, None]
    ids = names.canonical_id(x, F.lit("L" * 20), F.lit("a"), rules, {}, {})
    assert values(spark, ids, "Kraken Inc", "Foo Ltd", "") == ["alias::k", "lei::" + "L" * 20, "lei::" + "L" * 20]


def test_normal_names_of_many_forms_take_no_pattern_each(spark):
    """Names with forty legal forms at their end: the patterns of all forms, compiled anew in each round, took minutes."""
    rows = spark.range(0, 6000, 1, 4).select(names.normalize_name(F.concat(F.lit("Acme "), F.col("id").cast("string"), F.lit(" Group" * 40))).alias("n"))
    begun = time.time()
    assert rows.where("not n rlike '^acme [0-9]+$'").isEmpty() and time.time() - begun < 20


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*names.LEGAL, "Foo", "É", "a_b", "x.", "&", "(bank)uk", "9", " "]), max_size=6).map(" ".join), min_size=1, max_size=40))
def test_normal_names_against_brute_force(spark, rows):
    def normal(name):
        s = re.sub(r"\s+", " ", re.sub("[,/_]", " ", name.lower().strip()))
        while True:
            before = s
            for e in names.LEGAL:
                s = re.sub(rf"\b{re.escape(e)}\Z", "", s).strip() or s
            if s == before:
                return re.sub(r"\s+", " ", re.sub(r"[^\w\s]", " ", s)).strip()

    assert values(spark, names.normalize_name(F.col("x")), *rows) == [normal(x) for x in rows]


def test_dates(spark):
    x = F.col("x")
    assert values(spark, dates.us_date(x), "3/1/2024", "2024-01-01", "13/45/2024") == ["2024-03-01", None, "2024-13-45"]
    assert values(spark, dates.wareki_date(x), "平成29年9月29日", "令和元年９月６日", "x", None) == ["2017-09-29", "2019-09-06", None, None]
    assert values(spark, dates.action_day(x, F.lit("3/21/2025")), "/recent-actions/20250321_33", "/recent-actions/note") == ["2025-03-21", "2025-03-21"]


def test_text(spark):
    x = F.col("x")
    assert values(spark, text.title(x), "<h1 class=a>A &amp; <b>B</b></h1>", "<h1>open", "") == ["A & B", None, None]
    got = values(spark, text.places(x, "b+"), "abb cb é b", "", None)
    assert [(p.at, p.till, p.value) for p in got[0]] == [(1, 3, "bb"), (5, 6, "b"), (9, 10, "b")]
    words = ["VA Custody Services", "Custody Services", "VA Issuance"]
    assert values(spark, text.split_at_starts(x, words), "a VA Custody Services [x] VA Issuance", "none", "", None) == [["VA Custody Services [x]", "VA Issuance"], ["none"], [], []]
    assert values(spark, text.deobfuscate(x), '"ab" + "cd"') == ['"abcd"']


def test_heading_keeps_references_that_are_cut_off(spark):
    """As the SQL of page_title_extract has it."""
    texts = ["<h1>a&&amp</h1>", "<h1 x>A &amp;lt; &quot;b&quot; &#39;&lt;&gt;</h1>", "<h1> <b> </b>\n</h1>", "<h1>\x0ba\u00a0 &eacute; &copy</h1>", "<h1>open", "", None, "<H1>A</H1><h1>b</h1><h1>c</h1>", "<h1>a<script>b</script></h1>"]
    rows = spark.createDataFrame(list(enumerate(texts)), "page_id int, html string")
    got = rows.select("page_id", text.heading(F.col("html")).alias("title")).collect()
    con = duckdb.connect()
    con.execute("create table pages (page_id int, html varchar)")
    con.executemany("insert into pages values (?, ?)", list(enumerate(texts)))
    assert sorted(map(tuple, got)) == sorted(con.execute(ORACLE_SQL["page_title_extract"]).fetchall())


def test_unescape_is_the_standard_one(spark):
    """Named, numeric and broken references, as the standard library resolves them."""
    numbers = [0, 1, 9, 11, 13, 38, 127, 128, 129, 150, 159, 160, 8364, 55296, 57343, 64976, 65534, 65536, 131071, 1114111, 1114112, 10**25]
    texts = [f"a&#{n};b&#{n} &#x{n:x};" for n in numbers] + [f"x&{n}y" for n in sorted(html5)[::7]] + ["&", "&;", "&#;", "&#x;", "&ampx &notit; &copy2 &amp;lt; &lt;&gt &unknown; a&b=c", "", "plain"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", text.unescape(F.col("t")).alias("u")).collect()
    assert [(texts[r.i], r.u) for r in rows if r.u != html.unescape(texts[r.i])] == []
    assert spark.range(1).select(text.unescape(F.lit(None).cast("string"))).first()[0] is None


def test_places_of_many_matches(spark):
    """100,000 matches in one text, with their places in code points."""
    start = time.time()
    row = spark.range(1).select(text.places(F.repeat(F.lit("é ab x"), F.lit(100_000)), "ab").alias("p")).first()
    assert len(row.p) == 100_000 and all((p.at, p.till) == (6 * i + 2, 6 * i + 4) for i, p in enumerate(row.p))
    assert time.time() - start < 30


def looped(name):
    """The looping rule for legal forms at the end of a lower-case name without marks."""
    while True:
        before = name
        for e in names.LEGAL:
            cut = re.sub(rf"\b{re.escape(e)}\Z", "", name).strip()
            name = cut or name
        if name == before:
            return " ".join(re.sub(r"[^\w\s]", " ", name).split())


def test_endings_of_any_number(spark):
    rng = random.Random(3)
    forms = ["foo" + "".join(" " + rng.choice(names.LEGAL) for _ in range(n)) for n in range(41)] + ["foo" + " group" * 9, "group group", "n.a. na", ""]
    roles = ["Foo" + "".join(rng.choice(names.ROLES) for _ in range(n)) for n in range(41)]
    rows = spark.createDataFrame([(f, None) for f in forms] + [(None, r) for r in roles], "form string, role string")
    got = rows.select("form", names.normalize_name(F.col("form")).alias("a"), "role", names.entity_root(F.col("role")).alias("b")).collect()
    assert {r.form: r.a for r in got if r.form is not None} == {f: looped(f) for f in forms}
    assert {r.b for r in got if r.role is not None} == {"Foo"}


def test_places_look_for_matches_once():
    """The matches are bound; each use of them looked through the text again."""
    assert str(text.places(F.col("x"), "b+")).count("regexp_extract_all") == 1


def test_base58_reads_any_digits(spark):
    """The least and the greatest number of every length, as plain numbers say."""
    texts = [d * n for n in range(1, base58.CHARS + 1) for d in "1zA"] + ["1" * n + B58[23 + n :] for n in range(35)]
    want = ["00" * (len(t) - len(t.lstrip("1"))) + (lambda h: "0" * (len(h) % 2) + h)(f"{sum(B58.index(c) * 58**i for i, c in enumerate(reversed(t))):x}") for t in texts]
    want = [w[:-2] if set(t) == {"1"} else w for t, w in zip(texts, want, strict=True)]  # no number is left
    assert values(spark, base58.decode(F.col("x")), *texts) == want
