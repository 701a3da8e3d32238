"""Upserts, conflicts, lookups, vectors, deltas, catalogue."""

import datetime as dt
import importlib.util
import random
import sys
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexgrain.operators import conflicts, deltas, lookups, upserts, vectors


def day(n):
    return None if n is None else dt.date(2000, 1, n)


def test_overlaps(spark):
    rows = [("a", "d", 1, "p", day(1), day(5), False), ("b", "d", 2, "p", day(10), day(20), False), ("c", "d", 3, "p", day(3), day(4), None), ("e", "d", 4, "p", day(5), None, True), ("f", "d", 5, "p", None, None, True), ("g", None, 6, "p", None, None, True)]
    df = spark.createDataFrame(rows, "node_id string, doc_id string, version_id long, canonical_path string, valid_from date, valid_to date, is_current_law boolean")
    pairs = conflicts.conflict_pairs(df)
    got = {(r["node_id_a"], r["node_id_b"]): r["severity"] for r in pairs.collect()}
    assert got == {("a", "c"): "warning", ("a", "e"): "warning", ("a", "f"): "warning", ("b", "e"): "warning", ("b", "f"): "warning", ("c", "f"): "warning", ("e", "f"): "critical"}
    assert conflicts.new_events(pairs, pairs.where("severity = 'warning'")).count() == 1
    assert conflicts.conflict_pairs(df.limit(0)).count() == 0
    swapped = conflicts.ordered_pair(spark.createDataFrame([("z", "a", 1, 2)], "node_id_a string, node_id_b string, v_a int, v_b int"), "node_id_a", "node_id_b", "v").first()
    assert tuple(swapped) == ("a", "z", 2, 1)


def test_upserts(spark):
    ddl = "k long, v string, made int, at int"
    held = spark.createDataFrame([(1, "a", 1, 1), (2, "b", 1, 1)], ddl)
    fresh = spark.createDataFrame([(1, None, 9, 2), (1, "old", 9, 1), (3, "c", 9, 1)], ddl)
    assert sorted(map(tuple, upserts.upsert(held, fresh, ["k"], ["made"], "at").collect())) == [(1, None, 1, 2), (2, "b", 1, 1), (3, "c", 9, 1)]
    assert sorted(map(tuple, upserts.insert_absent(held, fresh, ["k"], "at").collect())) == [(1, "a", 1, 1), (2, "b", 1, 1), (3, "c", 9, 1)]
    again = upserts.insert_absent(held, held, ["k"], "at")
    assert again.count() == 2 and upserts.upsert(held.limit(0), fresh.limit(0), ["k"], [], "at").count() == 0
    numbers = upserts.numbered(spark.range(1000).selectExpr("id * 7 % 1000 as x"), "n", "x").collect()
    assert all(r["n"] == r["x"] + 1 for r in numbers)
    assert upserts.numbered(spark.range(0).selectExpr("id x"), "n", "x").count() == 0


ACTS = "doc_id string, canonical_doc string, doc_type string, act_number int, act_year int, title string, publication_date date, updated_at int"


def test_lookups(spark, tmp_path):
    acts = spark.createDataFrame([("d", "l:1:2000", "l", 1, 2000, " Uno_a ", None, 1), ("d", "l:1:2000", "l", 1, 2000, "x", None, 2), ("e", "l:2:2000", "l", 2, 2000, None, None, 1)], ACTS)
    versions = spark.createDataFrame([("d", 1, "v1", None, None), ("d", 2, "v2", None, None), ("d", 2, "v2", None, None)], "doc_id string, version_id long, version_tag string, valid_from date, valid_to date")
    nodes = spark.createDataFrame([("n1", "d", 1, "art:1", "T", "articolo"), ("n2", "d", 2, "art:10", None, "articolo"), ("n3", "d", 2, "art:1/c:2", "Ente gestore", "comma"), ("n4", "zz", 3, "x", "", "comma")], "node_id string, doc_id string, version_id long, canonical_path string, text_content string, node_type string")
    assert lookups.acts_query(acts, "l", None, 2).count() == 1 and lookups.acts_query(acts, "", 0, None).count() == 3
    assert [r["node_id"] for r in lookups.tree(acts, versions, nodes, "l:1:2000").collect()] == ["n2", "n3"]
    assert [r["node_id"] for r in lookups.tree(acts, versions, nodes, "l:1:2000", "v1").collect()] == ["n1"]
    assert lookups.tree(acts, versions, nodes, "none").count() == 0
    assert len(lookups.with_versions(acts, versions).where("doc_id = 'd'").first()["versions"]) == 2
    export = {r["id"]: r for r in lookups.export_rows(nodes, acts).collect()}
    assert export["n1"]["source"] == "l:1:2000" and export["n4"]["source"] == "Documento Sconosciuto" and export["n4"]["source_id"] == ""
    assert {tuple(r) for r in lookups.quality(nodes).collect()} == {("articolo", 2, 1), ("comma", 2, 1)} and lookups.quality(nodes, limit=1).count() == 1
    lookups.build_index(nodes, "node_id", "text_content").write.mode("overwrite").parquet(str(tmp_path / "fts"))
    index = spark.read.schema("token string, node_id string").parquet(str(tmp_path / "fts"))
    assert lookups.search_index(index, "node_id", " ?! ").count() == 0 and "EqualTo(token,ente)" in lookups.search_index(index, "node_id", "ente")._jdf.queryExecution().executedPlan().toString()
    assert [r[0] for r in lookups.search_index(index, "node_id", "GESTORE ente ente").collect()] == ["n3"] and lookups.search_index(index, "node_id", "ente t").count() == 0
    assert lookups.search_like(nodes, "text_content", "e_te").count() == 1
    assert lookups.preview(nodes, acts, 5).count() == 0


def test_health(spark):
    runs = spark.createDataFrame([(1, dt.datetime(2020, 1, 1), "finished"), (2, None, "finished"), (3, dt.datetime(2021, 1, 1), "failed")], "run_id long, finished_at timestamp_ntz, status string")
    raw = spark.createDataFrame([("new", dt.datetime(2020, 1, 2)), ("error", dt.datetime(2020, 1, 2)), ("error", dt.datetime(2019, 1, 2)), (None, None)], "status string, discovered_at timestamp_ntz")
    assert tuple(lookups.health(runs, raw, "2020-01-02 12:00:00").first()) == ("ok", 2, 1, 0.5)
    assert tuple(lookups.health(runs.limit(0), raw.limit(0), "2020-01-02 12:00:00").first()) == ("ok", None, 0, 0.0)
    assert lookups.last_finished(runs).first()["run_id"] == 2 and lookups.error_rate(raw, "2030-01-01").first()[0] == 0.0


def test_nearest(spark):
    rng = np.random.default_rng(1)
    data = [(i, [float(x) for x in rng.integers(-3, 4, 8)]) for i in range(300)] + [(300, None), (301, []), (302, [1.0, 2.0]), (303, [0.0] * 8), (304, [1.0] * 8), (305, [1.0] * 8)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(5)
    got = sorted(map(tuple, vectors.nearest(df, df.where("vec_id % 50 = 4 or vec_id = 302 or vec_id = 303"), 4).collect()))
    want = []
    good = [(i, np.array(v)) for i, v in data if v and len(v) == 8 and np.linalg.norm(v) > 0]
    for q, v in good:
        if q % 50 == 4:
            scored = sorted((-round(float(v @ w / np.linalg.norm(v) / np.linalg.norm(w)), 9), i) for i, w in good if i != q)[:4]
            want += [(q, i, -s) for s, i in scored]
    assert [(q, round(s, 6)) for q, _, s in got] == [(q, round(s, 6)) for q, _, s in sorted(want, key=lambda x: (x[0], x[1]))] or sorted((q, round(s, 6)) for q, _, s in got) == sorted((q, round(s, 6)) for q, _, s in want)
    assert (304, 305, 1.0) in [(q, i, round(s, 9)) for q, i, s in got]
    assert vectors.nearest(df, df.limit(0), 3).count() == 0 and vectors.nearest(df.limit(0), df, 3).count() == 0
    small = vectors.nearest(df, df.where("vec_id < 60"), 3, block=20)
    assert small.count() == 3 * small.select("query_id").distinct().count()


def test_vector_job(spark):
    items = spark.createDataFrame([("1", "s", "i", "c", "un testo abbastanza lungo", "u"), ("2", "s", "i", None, "corto", "u"), ("3", "s", "i", "c", "cattivo testo per il modello", "u"), ("4", None, None, None, None, None)], "id string, source string, source_id string, context string, text string, url string")
    made = vectors.records(items)
    assert made.count() == 2

    def model(texts):
        if any("cattivo" in t for t in texts):
            raise ValueError("bad")
        return np.ones((len(texts), 3))

    got = {r["id"]: (r["embedding"], r["error"]) for r in vectors.embed(made, model).collect()}
    assert got["1"] == ([1.0, 1.0, 1.0], None) and got["3"][0] is None and "bad" in got["3"][1]
    assert vectors.pending(made, made.where("id = '1'")).count() == 1


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60), st.text(max_size=60))
def test_delta_round_trip(a, b):
    assert deltas.apply(a, deltas.build(a, b)) == b


def test_deltas_are_small_for_small_changes_of_any_length():
    words = [f"parola{k}" for k in range(30)] + ["di", "la", ","]
    rng = random.Random(8)
    for n in (50, 5_000, 300_000):
        a = [rng.choice(words) for _ in range(n)] + ["unica"]
        b = a[: n // 3] + ["nuova", "voce"] + a[n // 3 + 2 :]
        made = deltas.build(" ".join(a), " ".join(b))
        assert deltas.apply(" ".join(a), made) == " ".join(b) and len(made) < 80


def test_delta_form():
    assert deltas.build("abc", "abc") == "=3" and deltas.build(None, "x\ty") == "+x%09y" and deltas.build("abc", "") == "-3" and deltas.apply("abc", "=1\t-1\t+Z\t=1") == "aZc"
    rng = random.Random(1)
    long = " ".join(rng.choice(["uno", "due", "tre"]) for _ in range(3000))
    assert deltas.apply(long, deltas.build(long, long.replace("due", "quattro"))) == long.replace("due", "quattro")


def test_catalogue():
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry

    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q) and len(sql) > 80
    assert {f"p{k}_found" for k in (1, 2, 3, 4, 5, 7)} <= set(q)
    if importlib.util.find_spec("lexgrain.llm"):
        assert {"p6_found", "p8_pack", "p9_found", "p10_found"} <= set(q)


SF = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not SF.exists(), reason="test tables are not there")
def test_flagship(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
