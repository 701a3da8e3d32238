"""Pieces: limits, overlap, natural cuts, ranges and giant files."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lexgrain.llm import splitting


def text(rng, n):
    out = []
    while sum(map(len, out)) < n:
        out.append(rng.choice(["parola", "è", "x" * rng.choice([3, 50, 900, 2500]), "fine."]) + rng.choice([" ", " ", "\n", "\n\n", "  ", " "]))
    return "".join(out)[:n]


def check(t, pieces, limit, overlap):
    assert [p[0] for p in pieces] == list(range(len(pieces)))
    end, hard = 0, False
    for _, a, b, h in pieces:
        assert 0 < b - a <= limit and a <= end < b
        assert end - a <= overlap
        natural = b == len(t) or t[b - 1].isspace() or t[b].isspace()
        assert h == (not natural)
        hard |= h
        end = b
    assert end == len(t)
    assert hard == bool(re.search(r"\S{%d}" % (limit + 1), t))


@pytest.mark.parametrize("seed", range(6))
def test_pieces_keep_the_limit_and_cut_naturally(seed):
    rng = random.Random(seed)
    texts = [text(rng, rng.choice([1, 199, 2000, 2001, 2200, 9000, 30000])) for _ in range(40)]
    for limit, overlap in ((2000, 200), (100, 20), (50, 0)):
        got = list(splitting.cut_batch([None, "", *texts], limit, overlap))
        for i, t in enumerate(texts):
            check(t, sorted(g[1:] for g in got if g[0] == i + 2), limit, overlap)
        assert {g[0] for g in got} == set(range(2, len(texts) + 2))


def test_ranges_give_the_same_pieces(monkeypatch):
    rng = random.Random(11)
    texts = [text(rng, 60000) + "y" * 7000 + text(rng, 9000), text(rng, 2500), "x" * 4001, text(rng, 5000), "z" * 9000 + " ", "kurz"]
    whole = sorted(splitting.cut_batch(texts, size=10**6))
    for i, t in enumerate(texts):
        check(t, [g[1:] for g in whole if g[0] == i], 2000, 200)
    for size in (2000, 2001, 2500, 5000, 8192, 40000):
        for buffer in (1, 12_000, 10**6):
            monkeypatch.setattr(splitting, "BUFFER_CHARS", buffer)
            assert sorted(splitting.cut_batch(texts, size=size)) == whole


@pytest.mark.parametrize("seed", range(4))
def test_pieces_do_not_depend_on_neighbours(seed):
    rng = random.Random(seed)
    texts = [rng.choice(["", " ", ". ", "\n", "a"]) + text(rng, rng.choice([1, 2001, 9000])) + rng.choice(["", " ", ".", "\n"]) for _ in range(25)]
    alone = {i: sorted(g[1:] for g in splitting.cut_batch([t])) for i, t in enumerate(texts)}
    for _ in range(3):
        order = rng.sample(range(len(texts)), len(texts))
        got = list(splitting.cut_batch([texts[i] for i in order]))
        assert {i: sorted(g[1:] for g in got if g[0] == n) for n, i in enumerate(order)} == alone


def test_tables_follow_every_chain():
    rng = random.Random(3)
    t = text(rng, 30_000)
    ranges = splitting._ranges_of(t, 300, 40, 5000)
    tables = splitting.entry_tables(ranges, 300, 40)
    assert [len(x) for x, _ in tables] == [1] + [301] * 5
    for k, (left, made) in enumerate(tables):
        for entry in rng.sample(range(len(left)), min(len(left), 25)):
            chain = list(splitting.emitted([ranges[k]], [entry], 300, 40))
            assert len(chain) == made[entry] and chain[-1][3] - len(ranges[k].own) == left[entry]
    whole = splitting.composed([(len(r.own), *x) for r, x in zip(ranges, tables, strict=True)])
    assert whole[0] == 30_000 and whole[1].tolist() == [0] and whole[2][0] == len(list(splitting.cut_batch([t], 300, 40)))


def test_sentences_and_paragraphs_are_preferred():
    t = ("Una frase breve che finisce qui. " * 80).strip()
    (_, _, _, b, _), *_ = sorted(splitting.cut_batch([t]))
    assert t[:b].rstrip().endswith(".")
    p = "riga senza punto " * 90 + "\n\n" + "altra riga " * 200
    (_, _, _, b, _), *_ = sorted(splitting.cut_batch([p]))
    assert p[:b].endswith("\n\n")


def test_giant_files_by_byte_ranges(spark, tmp_path):
    rng = random.Random(2)
    texts = [text(rng, 150_000), "é" * 90_000, "breve", text(rng, 33_000) + "z" * 5000]
    paths = []
    for i, t in enumerate(texts):
        paths.append(str(tmp_path / f"{i}.txt"))
        open(paths[-1], "w", encoding="utf-8", newline="").write(t)
    paths.append(str(tmp_path / "empty.txt"))
    open(paths[-1], "w").close()
    short_end = text(rng, 32_768 - 5) + "w" * 900  # the last range is shorter than a piece
    texts.append(short_end)
    paths.append(str(tmp_path / "end.txt"))
    open(paths[-1], "w", encoding="utf-8", newline="").write(short_end)
    for fan in (2, 256):
        got = splitting.split_files(spark, paths, range_bytes=32_768, fan=fan).orderBy("path", "piece_no").collect()
        for path, t in zip([p for p in paths if "empty" not in p], texts, strict=True):
            mine = [r for r in got if r["path"] == path]
            want = sorted(splitting.cut_batch([t]))
            assert [(r["piece_no"], r["start_at"], r["end_at"]) for r in mine] == [(n, a, b) for _, n, a, b, _ in want]
            assert all(r["piece_text"] == t[r["start_at"] : r["end_at"]] for r in mine)
    assert splitting.split_files(spark, [str(tmp_path / "empty.txt")]).count() == 0


def test_frames(spark):
    rows = [("a", "x " * 1500, "k"), ("a", "y" * 2001, "k"), ("b", "x " * 1001, "k"), ("c", "kurz", "k"), ("d", None, "k"), ("e", "", "k"), (None, "w " * 1100, "k"), ("f", "x" * 2000, "k")]
    df = spark.createDataFrame(rows, "node_id string, t string, piece_no string").select("node_id", "t", F.col("piece_no").alias("cut"))
    assert {tuple(r) for r in splitting.oversized(df, "node_id", "t").collect()} == {("a", "hard"), ("b", "soft"), (None, "soft")}
    assert splitting.oversized(df.limit(0), "node_id", "t").count() == 0
    whole = splitting.pieces(df.where("node_id = 'c'"), ["node_id"], "t").collect()
    assert [tuple(r) for r in whole] == [("c", 0, 0, 4, "end", "kurz")]
    assert splitting.pieces(df.where("node_id in ('d', 'e')"), ["node_id"], "t").count() == 0
