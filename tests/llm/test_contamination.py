"""Leaks against brute force, radius guarantee, long texts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexgrain.llm import contamination as con

DOCS = "doc_id long, text string, item_id string"
ITEMS = "item_id long, text string, doc_id string"


def brute(docs, items):
    grams = lambda t: {tuple(w[i : i + 12]) for w in [con.words(t)] for i in range(len(w) - 11)}
    return {(d, i) for d, t, *_ in docs for i, u, *_ in items if grams(t) & grams(u)}


def made(seed):
    rng = random.Random(seed)
    vocabulary = [f"parola{k}" for k in range(200)] + ["città", "perché", "l'art"]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(some(rng.randint(8, 40))), "x") for k in range(40)]
    items += [(40, None, "x"), (41, "", "x"), (42, items[3][1], "x"), (3, items[3][1], "x")]
    docs = []
    for k in range(200):
        ws = some(rng.randint(0, 120))
        if k % 3 == 0:
            source = (rng.choice(items[:40])[1]).split()
            a = rng.randint(0, max(0, len(source) - 12))
            part = source[a : a + rng.choice([10, 11, 12, 13, 40])]
            at = rng.randint(0, len(ws))
            ws[at:at] = [w.upper() if rng.random() < 0.3 else w for w in part]
        docs.append((k, rng.choice([" ", " -- ", "\n"]).join(ws), "y"))
    return docs + [(500, None, "y"), (501, "", "y"), (1, docs[1][1], "y")], items


def test_found_equals_brute_force(spark):
    docs, items = made(1)
    got = [tuple(r) for r in con.leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(docs, items) and got


def test_blocks_of_windows_and_long_texts(spark, monkeypatch):
    docs, items = made(2)
    long = (900, " ".join([*[f"w{k}" for k in range(40)], items[0][1] + " " + items[1][1], *[f"w{k}" for k in range(50)], "x" * 5000, items[2][1]]), "y")
    monkeypatch.setattr(con, "WINDOW_BLOCK", 25)
    monkeypatch.setattr(con, "TEXT_CHARS", 300)
    got = {tuple(r) for r in con.leaks(spark.createDataFrame([*docs, long], DOCS), spark.createDataFrame(items, ITEMS)).collect()}
    assert got == brute([*docs, long], items)


def test_a_full_filter_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(con, "FILTER_PART", 64)
    monkeypatch.setattr(con, "FILTER_BYTES", 64)
    docs, items = made(5)
    got = {tuple(r) for r in con.leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), radius=3).collect()}
    assert got == brute(docs, items)


def test_empty_tables(spark):
    docs, items = made(3)
    d, i = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    assert con.leaks(d.limit(0), i).count() == 0
    assert con.leaks(d, i.limit(0)).count() == 0


def test_fingerprints_are_majorities_of_bits():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 2**63, 300).astype(np.uint64)
    for window, shingle in ((12, 5), (5, 5), (40, 3), (259, 5)):
        shingles = con.shingle_hashes(hashes, shingle)
        bits = (shingles[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
        inside = window - shingle + 1
        want = [sum(int(b) << k for k, b in enumerate(bits[i : i + inside].sum(axis=0) * 2 > inside)) for i in range(300 - window + 1)]
        assert con.fingerprints(hashes, window, shingle).tolist() == want


def test_words_of_a_batch_are_those_of_each_text():
    texts = ["L’Àrt. 5-bis", "", "x" * 50 + " città", "\0a\0b ", "Ⅻ ß é"]
    w = con.Words(texts)
    assert [[w.text(i, 1) for i in np.flatnonzero(w.owner == k)] for k in range(len(texts))] == [con.words(t) for t in texts]
    again = con.Words(["città"])
    assert again.hashes[0] in w.hashes and len(np.unique(w.hashes)) == len({w.text(i, 1) for i in range(len(w.start))})


def test_blocks_find_all_fingerprints_within_the_radius(spark):
    rng = np.random.default_rng(4)
    for radius in (0, 1, 3):
        prints = rng.integers(-(2**63), 2**63, 120)
        near = prints.copy()
        for k in range(len(near)):
            for b in rng.choice(64, rng.integers(0, radius + 2), replace=False):
                near[k] ^= np.int64(np.uint64(1) << np.uint64(b))
        frame = lambda xs, name: spark.createDataFrame([(int(x), f"{name}{i}") for i, x in enumerate(xs)], "print long, words string")
        got = {(int(r[0][1:]), int(r[1][1:])) for r in con.alike(frame(near, "n"), frame(prints, "p"), radius, 5, 0.0, False).collect()}
        distance = np.bitwise_count((near[:, None] ^ prints[None, :]).view(np.uint64))
        assert got == {(int(i), int(j)) for i, j in zip(*np.nonzero(distance <= radius), strict=True)}
        held = con.BlockFilter(radius, con.BlockFilter.bits_for(120 * (radius + 1)))
        held.add(prints.view(np.uint64))
        assert set(np.flatnonzero(distance.min(axis=1) <= radius)) <= set(held.passing(near.view(np.uint64)).tolist())


def test_near_copies_are_found_by_similarity(spark):
    """Recall of the similarity mode against brute force over all pairs of windows."""
    rng = random.Random(6)
    ws = [f"voce{k}" for k in range(60)]
    docs = []
    for k in range(30):
        other = list(ws)
        for _ in range(k % 5):
            other[rng.randrange(60)] = f"altra{rng.randrange(99)}"
        docs.append((k, " ".join(other), "y"))
    want = {(k, 9) for k, t, _ in docs if con.similarity(t, " ".join(ws)) >= 0.8}
    items = spark.createDataFrame([(9, " ".join(ws), "x")], ITEMS)
    got = {tuple(r) for r in con.leaks(spark.createDataFrame(docs, DOCS), items, window=60, radius=con.radius_for(0.8), exact=False).collect()}
    assert got <= want and len(got) >= 0.95 * len(want) and 5 < len(want) < 30
    with pytest.raises(ValueError, match="bits"):
        con.leaks(spark.createDataFrame(docs, DOCS), items, exact=False)


def test_similarity_of_shingles():
    a = " ".join(f"p{k}" for k in range(10, 22))
    assert con.similarity(a, a) == 1.0 and con.similarity(a, a.replace("p10", "q10")) == 7 / 9 and con.similarity(a, "x") == 0.0


def test_placed_similarity_is_one_for_equal_words_only():
    rng = random.Random(8)
    some = lambda: " ".join(rng.choice("ab") for _ in range(7))
    pairs = [(some(), some()) for _ in range(3000)]
    assert any(a == b for a, b in pairs) and any(a != b and con.similarity(a, b, 2) == 1.0 for a, b in pairs)
    assert all((con.similarity(a, b, 2, placed=True) == 1.0) == (a == b) for a, b in pairs)
    a = " ".join(f"p{k}" for k in range(10, 22))
    assert con.similarity(a, a.replace("p10", "q10"), placed=True) == 7 / 9


def test_the_verification_decides_on_candidates(spark, monkeypatch):
    """Near windows reach the verification, and nothing but it drops those that are not equal."""
    ws = [f"voce{k}" for k in range(12)]
    cycle = [f"giro{k % 8}" for k in range(13)]  # its two windows have the same shingles and fingerprint
    docs = [(1, " ".join(ws), "y"), (2, " ".join([*ws[:11], "altra"]), "y"), (3, " ".join(cycle[1:]), "y"), (4, "x " * 30, "y")]
    items = [(8, " ".join(ws), "x"), (9, " ".join(cycle[:12]), "x")]
    d, i = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    prints = [con.fingerprints(con.Words([t]).hashes, con.WINDOW, con.SHINGLE)[0] for t in (docs[0][1], docs[1][1], docs[2][1], items[1][1])]
    assert 1 < np.bitwise_count(prints[0] ^ prints[1]) <= 20 and prints[2] == prints[3]
    found = lambda: {tuple(r) for r in con.leaks(d, i, radius=20).collect()}
    assert found() == brute(docs, items) == {(1, 8)}
    monkeypatch.setattr(con, "_similarity", lambda *_: lambda a, b: F.lit(1.0))
    assert found() >= {(1, 8), (2, 8), (3, 9)}


def test_words():
    assert con.words("L’Àrt. 5-bis del\nd.lgs.") == ["l", "art", "5", "bis", "del", "d", "lgs"]
