"""Change applier, license scan and prefix trie: brute force, nulls, ties, repeated rows, empty tables, clashing names."""

import datetime
import hashlib
import math
import random
import zlib

from pyspark.sql import functions as F

from chainlattice.llm import change_applier, license_scan, prefix_trie

CHANGES = "change_id long, client_id long, seq long, op string, valid_at timestamp_ntz, city string, balance double, batch string, n string"
FIRST = datetime.datetime(2024, 1, 1)


def key(row):
    return tuple((v is not None, v) if v is not None else (False,) for v in row)


def brute_changes(rows):
    """The rule, row by row: batches, clients, next numbers."""
    rows = set(rows)
    seqs = {}
    for r in rows:
        seqs.setdefault(r[1], set()).add(r[2])
    rank = {c: {s: i + 1 for i, s in enumerate(sorted(v, key=lambda s: (s is not None, s or 0)))} for c, v in seqs.items()}
    batches, state, out, top = {}, {}, [], None
    for change_id, client, seq, op, at, city, balance, *_ in rows:
        h = zlib.crc32(str(change_id).encode()) if change_id is not None else 0
        if at is not None and change_id is not None and h % 11:
            day = (at - datetime.datetime(1970, 1, 1)).days + 5 * (h % 4)
            batches.setdefault(min(10, 1 + (day - 19723) * 10 // 160), []).append((day, change_id, client, rank[client][seq], op, city, balance))

    def run(client, batch, missed):
        s = state[client]
        while (r := s["held"].pop(s["next"], None)) is not None:
            _, change_id, _, _, op, city, balance = r
            s["city"], s["balance"] = {"I": (city, balance), "D": (None, None)}.get(op, (city or s["city"], s["balance"] if balance is None else balance))
            s["last"] = [change_id, client, "applied", batch, missed, s["city"], None if s["balance"] is None else math.floor(100 * s["balance"] + 0.5), False], op
            out.append(s["last"][0])
            s["next"], missed = s["next"] + 1, 0

    for batch in range(1, 12):
        for client, s in state.items():
            while s["held"] and (batch == 11 or (top is not None and min(h[0] for h in s["held"].values()) + 8 <= top)):
                least = min(s["held"])
                missed, s["next"] = least - s["next"], least
                run(client, batch, missed)
        for r in sorted(batches.get(batch, []), key=lambda r: r[:2]):
            s = state.setdefault(r[2], {"next": 1, "held": {}, "city": None, "balance": None})
            if r[3] < s["next"] or r[3] in s["held"]:
                out.append([r[1], r[2], "rejected", batch, 0, None, None, False])
            else:
                s["held"][r[3]] = r
                run(r[2], batch, 0)
        top = max([r[0] for r in batches.get(batch, [])] + ([top] if top is not None else []), default=None)
    for s in state.values():
        if "last" in s and s["last"][1] != "D":
            s["last"][0][7] = True
    return sorted(map(tuple, out), key=key)


def test_change_applier(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        seq = rng.randrange(60)
        at = None if i % 50 == 7 else FIRST + datetime.timedelta(days=min(119, 2 * seq + rng.randrange(3)) // (2 if i % 5 else 1), hours=rng.randrange(24))
        rows.append((i if i != 9 else None, rng.choice([1, 1, 1, 2, 3, None]), None if i % 90 == 4 else seq, rng.choice("IUUUD"), at, rng.choice(["a", "b", None]), rng.choice([1.005, -3.25, None]), "x", "y"))
    rows += rows[:20]
    got = change_applier.apply(spark.createDataFrame(rows, CHANGES)).collect()
    assert sorted(map(tuple, got), key=key) == brute_changes(rows)


def test_change_applier_splits_long_clients(spark, monkeypatch):
    """Numbers of long clients in units of 3, so that runs and jumps cross many units and the scan has levels."""
    rng = random.Random(8)
    rows = []
    for i in range(600):
        client = rng.choice([1, 1, 1, None, 3, 4 + i])
        seq = rng.randrange(260 if client in (1, None) else 5)
        at = FIRST + datetime.timedelta(days=min(165, 5 * seq // 8 + rng.choice([0, 0, 1, 30])), hours=rng.randrange(24))
        rows.append((i, client, seq, rng.choice("IUUUUUD"), at, rng.choice(["a", "b", "c", None]), rng.choice([1.005, -3.25, None, None]), "x", "y"))
    want, df = brute_changes(rows), spark.createDataFrame(rows, CHANGES)
    assert {r[3] for r in want} == set(range(1, 12)) and any(r[4] > 1 for r in want)
    monkeypatch.setattr(change_applier, "SALTS", 4)
    assert sorted(map(tuple, change_applier.apply(df, 3, 100).collect()), key=key) == want


def test_wheel_visits_due_slots_only():
    bucket, out = change_applier.Bucket(), []
    bucket.take([(1, "a", 3, 10, "I", "x", 1.0), (2, "b", 2, 20, "I", "y", 2.0)], 1, out)
    assert set(bucket.wheel) == {18, 28} and not out
    bucket.tick(18, 2, out)
    assert [(r[0], r[5]) for r in out] == [(1, 2)] and bucket.wheel == {28: {"b"}}


def test_change_applier_without_rows(spark):
    assert change_applier.apply(spark.createDataFrame([], CHANGES)).collect() == []


def test_license_phrases_and_notices(spark):
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    edited = notice.replace("granted", "grantd").replace("person", "persons")
    texts = {1: "x GNU General\nPublic License; Apache-License cc by cc by", 2: "far " * 3000 + edited, 3: None, 4: "", 5: "mitt license. mit licenses", 6: notice.replace("granted free of charge", "x").replace("obtaining a copy", "selling my boat"), 7: "é mit license é"}
    docs = spark.createDataFrame([(k, v, "s") for k, v in texts.items()], "doc_id long, text string, SCORE string")
    got = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    assert [(p.label, p.first_word) for p in got[1].places] == [("gpl", 1), ("apache", 5), ("cc-by", 7), ("cc-by", 9)] and got[1].n_words == 11
    (match,) = got[2].matches
    assert match.label == "mit" and match.errors == 2 and texts[2][match["at"] : match.till] == edited and match.first_word == 3000
    assert all(not got[k].places and not got[k].matches and got[k].score == 0 for k in (3, 4, 5)) and got[3].n_words == 0
    assert [(p.label, p.first_word) for p in got[7].places] == [("mit", 1)] and got[7].score == 1
    assert license_scan.scan(docs.limit(0)).collect() == []


def test_license_notices_with_every_number_of_edits():
    sought, rng = license_scan.Notices(license_scan.NOTICES), random.Random(2)
    for label, notice in license_scan.NOTICES:
        letters = list(notice)
        for at in rng.sample(range(len(letters)), license_scan.edits(notice)):
            letters[at] = "q"
        words = license_scan.normal("before " + "".join(letters) + " after")
        assert label in {license_scan.NOTICES[i][0] for i, _ in sought.matches(words)}


def test_license_windows_that_are_not_matched_hold_nothing():
    """The count of sequences against the pattern alone, for windows with up to twice the edits that a notice may have."""
    sought, rng = license_scan.Notices(license_scan.NOTICES[1:6]), random.Random(4)
    found = 0
    for i, (_, notice) in enumerate(license_scan.NOTICES[1:6]):
        for n in range(2 * license_scan.edits(notice) + 1):
            letters = list(notice)
            for at in rng.sample(range(len(letters)), n):
                letters[at] = rng.choice(["", "q", letters[at] + "q"])
            window = "so " + "".join(letters) + " it"
            m = sought.patterns[i].search(window)
            assert sought.best(i, window) == (m and license_scan.Found(m.start(), m.end(), sum(m.fuzzy_counts)))
            found += m is not None
    assert found > 20


def brute_trie(convs, base, head):
    nodes = {}
    for c, own in convs.items():
        seq = convs.get(base(c), [])[: head(c)] + own[head(c) :]
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append((c, d == len(seq)))
    out = []
    for node, members in nodes.items():
        below = [(n, m) for n, m in nodes.items() if n[: len(node)] == node]
        children = {n for n, _ in below if len(n) == len(node) + 1}
        leaves = sum(not any(o[: len(n)] == n and len(o) > len(n) for o, _ in below) for n, _ in below)
        saved = sum((len(m) - 1) * len(n[-1][1]) for n, m in below if n)
        ends = ",".join(str(c) for c in sorted(c for c, end in members if end))
        out.append((min(c for c, _ in members), len(node), min(c for c, _ in nodes[node[:-1]]) if node else None, len(members), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=key)


def test_prefix_trie(spark):
    rng = random.Random(11)
    rows = [(c, t if t else None, rng.choice(["user", None]), rng.choice(["a", "", "ét", None])) for c in range(-3, 260) for t in range(rng.choice([0, 1, 2, 3, 3, 7]))]
    rows += [(c, t, "user", "same") for c in (300, 301, 302) for t in range(9)]
    convs = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        convs.setdefault(c, []).append((role or "", text or ""))
    turns = spark.createDataFrame([(*r, "x") for r in rows] + [(None, 1, "user", "lost", "x")], "conv_id long, turn long, role string, text string, depth string").repartition(3)
    base, head = lambda c: int(math.fmod(c, 100)) * -1 + c, lambda c: zlib.crc32(str(c).encode()) % 6
    own = F.col("conv_id")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        for on in ("true", "false"):  # one block, and several that nodes cross
            spark.conf.set("spark.sql.adaptive.enabled", on)
            seqs = prefix_trie.rebuilt(prefix_trie.sequences(turns), own - own % 100, (F.crc32(own.cast("string").cast("binary")) % 6).cast("int"))
            assert sorted(map(tuple, prefix_trie.trie(seqs).collect()), key=key) == brute_trie(convs, base, head)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert prefix_trie.trie(prefix_trie.sequences(turns.limit(0))).collect() == []
