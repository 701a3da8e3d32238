"""Packing: capacities, whole texts, use of room, ranks."""

import random
from collections import Counter, defaultdict
from pathlib import Path

import pytest

from lexgrain.llm import packing

ITEMS = "doc_id long, n_tokens long, slot string"


def packed(spark, sizes, capacity=100, **more):
    df = spark.createDataFrame([(i, n, "x") for i, n in enumerate(sizes)], ITEMS)
    return packing.pack(df, capacity, **more).collect()


def check(rows, sizes, capacity):
    parts = defaultdict(list)
    bins = defaultdict(list)
    for r in rows:
        parts[r["doc_id"]].append((r["part_no"], r["n_tokens"]))
        bins[r["container"]].append((r["slot"], r["n_tokens"]))
    for i, n in enumerate(sizes):
        mine = sorted(parts.pop(i, []))
        assert sum(x for _, x in mine) == (n or 0)
        assert all(x == capacity for _, x in mine[:-1]) and [k for k, _ in mine] == list(range(len(mine)))
    assert not parts
    for inside in bins.values():
        assert sum(x for _, x in inside) <= capacity and sorted(k for k, _ in inside) == list(range(len(inside)))
    assert sorted(bins) == list(range(len(bins)))
    return bins


@pytest.mark.parametrize("seed", range(3))
def test_random_sizes(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 1, 5, 33, 34, 50, 51, 99, 100, 101, 250, 10**4, rng.randint(1, 100)]) for _ in range(700)]
    bins = check(packed(spark, sizes), sizes, 100)
    least = -(-sum(sizes) // 100)
    assert len(bins) <= least * 1.05 + 1


def test_one_size_is_ranked_in_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 100)
    sizes = [30] * 900 + [10] * 300 + [70] * 50
    rows = packed(spark, sizes)
    bins = check(rows, sizes, 100)
    assert len(bins) <= 338
    steps = Counter()
    for r in rows:
        steps[r["step_no"]] += r["n_tokens"]
    assert max(steps.values()) <= 1.1 * min(steps.values()) + 100


def room(histogram, capacity, tiers=4, nested=True):
    """Containers of a plan, after checking that every item stands in it once and nothing is overfull."""
    used, number = defaultdict(list), 0
    lengths = packing.tier_lengths(capacity, tiers)
    runs = packing.plan(histogram, capacity, tiers, nested)
    for run in runs:
        number += run.number
        windows = defaultdict(int)
        for w, t, s, r in run.held:
            used[s].append((r, r + run.number))
            windows[w] += s
            assert s <= lengths[t] and (t == len(lengths) - 1 or s > lengths[t + 1])
        assert sum(windows.values()) == run.used <= (capacity if nested else lengths[min(t for _, t, *_ in run.held)])
        if nested:
            assert all(n <= lengths[min(t for x, t, *_ in run.held if x == w)] for w, n in windows.items())
    for s, n in histogram.items():
        spans = sorted(used[s])
        assert [a for a, _ in spans] == [0, *[b for _, b in spans[:-1]]] and spans[-1][1] == n
    return number, runs


def test_plan_work_depends_on_the_sizes_only():
    histogram = {s: 10**9 + s for s in range(1, 2049)}
    number, runs = room(histogram, 2048)
    assert sum(len(r.held) for r in runs) < 200_000
    assert number <= 1.002 * sum(s * n for s, n in histogram.items()) / 2048


@pytest.mark.parametrize("seed", range(6))
def test_tiers_are_packed_in_windows_of_their_own(seed):
    rng = random.Random(seed)
    histogram = {rng.randint(1, 512): rng.randint(1, 40) for _ in range(rng.randint(1, 150))}
    number, _ = room(histogram, 512)
    assert number <= room(histogram, 512, tiers=1)[0] * 1.03 + 1  # plain best fit decreasing
    assert room(histogram, 512, nested=False)[0] >= number


def test_gaps_of_long_windows_are_filled_from_shorter_tiers():
    (run,) = packing.plan({1500: 3, 500: 3, 48: 3}, 2048)
    assert run.number == 3 and run.used == 2048 and {t for _, t, *_ in run.held} == {0, 2, 3}
    (pair,) = packing.plan({1000: 4}, 2048)
    assert pair.number == 2 and [(w, t) for w, t, *_ in pair.held] == [(0, 1), (1, 1)]


def test_containers_of_several_lengths(spark):
    rows = packed(spark, [90, 40, 40, 20, 20, 5], tiers=3, nested=False)
    lengths = {r["container"]: r["length"] for r in rows}
    assert sorted(lengths.values(), reverse=True)[0] == 100 and min(lengths.values()) < 100
    for c, length in lengths.items():
        assert sum(r["n_tokens"] for r in rows if r["container"] == c) <= length


def test_empty_and_null_texts(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (3, "una frase", "a"), (3, "una frase", "a")], "doc_id long, text string, slot string")
    rows = packing.pack(packing.sizes(docs)).collect()
    assert [r["doc_id"] for r in rows] == [3, 3] and {r["container"] for r in rows} == {0}
    assert packing.pack(packing.sizes(docs.limit(0))).count() == 0


def test_long_texts_are_counted_as_a_whole(monkeypatch):
    enc = packing.encoding(Path(packing.VOCABULARY).read_bytes())
    t = "Entro il termine di 45 giorni, l'ente\n\n gestore  provvede.  _x_ a 'l è\u00a0si 7 b\t c  " * 300 + "x" * 1000 + " !? " * 50
    whole = len(enc.encode_ordinary(t))
    for part in (1, 7, 97, 1000):
        monkeypatch.setattr(packing, "PART_CHARS", part)
        assert packing.token_count(t, enc) == whole
    assert packing.token_count(None, enc) == packing.token_count("", enc) == 0 and packing.token_count("x\ud800y", enc) > 0
