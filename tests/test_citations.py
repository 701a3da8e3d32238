"""Citations, resolution and scalar functions on hand-made cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lexgrain.functions import ids, text, urn
from lexgrain.operators import citations

C = F.col


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


def test_acts_and_articles(spark):
    t = "Ai sensi del d.lgs. 74/2000 e del DPR 917/1986, come modificato da legge 212/2000."
    got = citations.extract_text(spark, t).orderBy("ordinal").collect()
    assert [r["target_canonical_doc"] for r in got] == ["dlgs:74:2000", "dpr:917:1986", "l:212:2000"]
    assert all(r["confidence"] == 0.6 and r["relation_type"] == "AMENDS" and t[r["start"] :].startswith(r["match_text"]) for r in got)
    art = citations.extract_text(spark, "Art. 5-bis, comma 2, lettera b, n. 3").first()
    assert [art[f"target_{p}"] for p in ("article", "comma", "letter", "number")] == ["5-bis", "2", "b", "3"] and art["confidence"] == 0.4
    near = citations.extract_text(spark, "all'art. 3 della legge 1/2001").collect()
    assert [r["confidence"] for r in near] == [0.9, 0.4]
    alias = citations.extract_text(spark, "il tuir e lo STATUTO del contribuente").collect()
    assert [(r["match_text"], r["method"], r["start"]) for r in alias] == [("TUIR", "alias:v1", 3), ("Statuto del contribuente", "alias:v1", 13)]
    assert citations.extract_text(spark, "").count() == 0 and citations.extract_text(spark, "d.P.R. 917/1986").first()["target_canonical_doc"] == "dpr:917:1986"


@pytest.mark.parametrize(
    ("match", "around", "own", "want"),
    [
        ("urn:nir:x;1 y", "", None, ("urn:nir:x;1", 1.0, "explicit")),
        ("d.lgs. 74/2000", "", None, ("urn:nir:stato:decreto.legislativo:2000;74", 0.85, "dynamic_parsing")),
        ("legge 1/98", "", None, ("urn:nir:stato:legge:1998;1", 0.85, "dynamic_parsing")),
        ("legge 1/12", "", None, ("urn:nir:stato:legge:2012;1", 0.85, "dynamic_parsing")),
        ("art. 5, comma 2", "della legge n. 40 del 1998", None, ("urn:nir:stato:legge:1998;40#art5-com2", 0.85, "dynamic_parsing")),
        ("TUIR", "", None, ("dpr:917:1986", 0.8, "alias")),
        ("art. 3", "", "l:1:2000", ("l:1:2000#art3", 0.6, "contextual")),
        ("art. 3", "", None, (None, 0.0, "unresolved")),
    ],
)
def test_resolver(spark, match, around, own, want):
    got = one(spark, urn.resolve(C("m"), C("a"), C("o")), m=match, a=around, o=own)
    assert tuple(got) == want


def test_decree_law_is_told_apart_on_request(spark):
    assert one(spark, urn.law_urn(C("t")), t="d.l. 5/2001").endswith("legge:2001;5")
    assert one(spark, urn.law_urn(C("t"), False), t="d.l. 5/2001") == "urn:nir:stato:decreto.legge:2001;5"
    assert one(spark, urn.law_urn(C("t"), False), t="DPR 917/1986") == "urn:nir:stato:decreto.presidente.repubblica:1986;917"
    assert one(spark, urn.law_urn(C("t")), t="nessuna") is None and one(spark, urn.law_urn(C("t")), t=None) is None


@pytest.mark.parametrize(
    ("path", "want"),
    [
        ("art:1-bis/c:1/lett:a/num:2", "Art. 1-bis > c 1 > lett. a > n. 2"), ("akomaNtoso/act/body/article:art_1", "body > Art. art_1"), ("act/main", "act > main"), ("act:1/COM", "act 1 > Comma"),
        ("//chapter:I//Foo:Bar", "Capo I > foo Bar"), ("", None), ("/", None), (None, None),
    ],
)
def test_hierarchy(spark, path, want):
    assert one(spark, text.hierarchy(C("p")), p=path) == want


@pytest.mark.parametrize(
    ("t", "want"),
    [
        ("il 1/2/2003", dt.date(2003, 2, 1)), ("1 Febbraio 2003", dt.date(2003, 2, 1)), ("31/2/2003 e 1 marzo 2004", None), ("12 marzo 2004 e 1/2/2003", dt.date(2003, 2, 1)), ("1/0/2003, 5 maggio 1999", dt.date(1999, 5, 5)),
        ("niente", None), ("", None), (None, None),
    ],
)
def test_dates(spark, t, want):
    assert one(spark, text.italian_date(C("t")), t=t) == want


def test_small_functions(spark):
    assert one(spark, text.clean(C("t")), t="\xa0a \t b\r\n\r\n\r\n\rc\n") == "a b\n\nc"
    assert one(spark, text.clean_inline(C("t")), t=" a\x07b  , c\n; d ") == "a b, c; d"
    assert one(spark, ids.canonical_doc(C("a"), C("b"), C("c")), a="l", b="", c=None) == "l:0:0"
    assert one(spark, ids.node_ref(C("d"), C("a"), C("b"), C("b"), C("e")), d="l:1", a="5", b=None, e="") == "l:1#art:5"
    assert one(spark, ids.node_ref(C("d"), C("b"), C("b"), C("b"), C("b")), d="l:1", b=None) == "l:1"
    assert one(spark, ids.fragment_path(C("f")), f="art5-bis-com2-leta-num3") == "art:5-bis/c:2/lett:a/num:3"
    assert one(spark, ids.fragment_path(C("f")), f="chp_1") == "chp_1"
    assert one(spark, text.snippet(C("t"), F.lit(300)), t="x" * 100 + " " * 600 + "y") == "x" * 100 + " " * 300
    assert one(spark, text.snippet(C("t"), F.lit(0)), t=None) == "(testo vuoto)"
    assert one(spark, text.snippet(C("t"), F.lit(450)), t=" " * 700) == " " * 400
    assert one(spark, text.compression_ratio(C("a"), C("b")), a="", b="xx") == 0.0 and one(spark, text.compression_ratio(C("a"), C("b")), a="abcd", b="x") == 0.75
    assert one(spark, text.embedding_text(C("c"), C("t")), c=None, t="1234567890") is None
    assert one(spark, text.embedding_text(C("c"), C("t")), c=" A ", t=" 12345678901 ") == "passage: A 12345678901"
    assert one(spark, text.source_name(C("t"), C("c"), F.lit(True)), t=" a_b c", c="l:1:1") == "a b c"
    assert one(spark, text.export_context(C("h")), h="body > art_1 > para_2__x .") == "1 > 2x."


def test_extraction_job_twice_inserts_nothing(spark):
    nodes = spark.createDataFrame([("n1", "d1", "art. 1 e art. 1 della legge 5/2001"), ("n2", "dx", "art. 2"), ("n3", "d1", None)], "node_id string, doc_id string, text_content string")
    acts = spark.createDataFrame([("d1", "l:9:1999")], "doc_id string, canonical_doc string")
    first = citations.extraction_job(nodes, acts)
    assert first.count() == 4 and citations.extraction_job(nodes, acts, dedup_within_run=True).count() == 3
    assert citations.extraction_job(nodes, acts, existing=first).count() == 0
    assert citations.resolution_log(first).where("resolution_method = 'unresolved'").count() == 1


def test_resolution_job(spark):
    refs = spark.createDataFrame([(2, "n", None, "l:1:1#art:5", "CITES", 0.9), (1, "n", " l:1:1#art:5 ", "x", "CITES", 0.4), (3, "n", None, " ", "CITES", 0.4), (4, "m", None, "art:5", "CITES", 0.6)], "ref_id long, source_node_id string, target_canonical_node string, target_canonical_doc string, relation_type string, confidence double")
    nodes = spark.createDataFrame([("z", 1, "art:5"), ("a", 2, "art:5"), ("q", 1, None)], "node_id string, version_id long, canonical_path string")
    got = {tuple(r) for r in citations.resolution_job(refs, nodes, None).collect()}
    assert got == {("n", "l:1:1#art:5", "CITES", "z", 0.4), ("m", "art:5", "CITES", "z", 0.6)}
    owned = nodes.selectExpr("if(node_id = 'a', 'd1', 'd2') as doc_id", "*")
    acts = spark.createDataFrame([("d1", "l:1:1"), ("d2", "l:2:2")], "doc_id string, canonical_doc string")
    scoped = {tuple(r) for r in citations.resolution_job(refs, owned, acts).collect()}
    assert scoped == {("n", "l:1:1#art:5", "CITES", "a", 0.4), ("m", "art:5", "CITES", "z", 0.6)}


def test_patterns_can_be_given(spark):
    own = citations.Patterns(aliases={"Carta dei mercati": "carta:1:2001"}, acts=(("reg", r"(?i)reg\.\s*(\d+)/(\d{4})"),), relations=(("AMENDS", "ritoccato da"), ("CITES", "visto")))
    nodes = spark.createDataFrame([("n", "d", "La Carta dei mercati, ritoccato da reg. 7/2009 e legge 1/2000", "x")], "node_id string, doc_id string, text_content string, extra string")
    got = [(r["target_canonical_doc"], r["relation_type"], r["extra"]) for r in citations.extract(nodes, patterns=own, keep=("extra",)).collect()]
    assert got == [("carta:1:2001", "AMENDS", "x"), ("reg:7:2009", "AMENDS", "x")]
    plain = [r["target_canonical_doc"] for r in citations.extract(nodes).collect()]
    assert plain == ["l:1:2000"]
