"""Act XML, zips, JSON lines, streaming."""

import xml.etree.ElementTree as ET
import zipfile

import pytest
from pyspark.sql import functions as F

from lexgrain.plans import reference_queries
from lexgrain.sources import acts_xml, files
from lexgrain.streaming import ingest

SIMPLE = """<?xml version="1.0"?><!-- c --><atto><meta><doc_type>REG</doc_type><number>12</number><year>2009</year><title>Regolamento dei mercati</title><version_tag>t3</version_tag>
<valid_from>2009-07-15</valid_from><valid_to></valid_to></meta><preambolo>Sentita la giunta</preambolo>
<articolo id="7"><rubrica>\tBanchi </rubrica><testo>I banchi sono numerati.</testo><comma id="2">Chi vende <!-- x -->olio
   <lettera id="c">espone il prezzo
      <numero id="4">per litro.</numero></lettera></comma></articolo>
<articolo id="7-ter"><testo>Abrogato.</testo></articolo>
<allegato id="B"><tabella id="9">Zona; Canone
A; 30</tabella></allegato><nota>Letto e approvato</nota></atto>"""
AKOMA = """<akomaNtoso xmlns="http://docs.oasis-open.org/legaldocml/ns/akn/3.0"><act><meta><identification>
<FRBRWork><FRBRthis value="/akn/it/act/legge/stato/2001-05-06/231/!main"/><FRBRuri value="/akn/it/act/legge/stato/2001-05-06/231"/><FRBRdate date="2001-05-06"/></FRBRWork>
<FRBRExpression><FRBRthis value="/akn/e"/><FRBRdate date="2002-01-01"/></FRBRExpression></identification></meta>
<body><article eId="art_1"><num>Art. 1</num><paragraph id="p1"><content><p>Testo <b>misto</b> , <ref href="/akn/x">l 1/2001</ref>.</p></content></paragraph><paragraph> </paragraph></article></body></act></akomaNtoso>"""


def test_simple_act():
    doc, nodes, error = acts_xml.parse(SIMPLE)
    assert error is None and doc["canonical_doc"] == "reg:12:2009" and doc["valid_to"] is None and doc["valid_from"] == "2009-07-15" and doc["year"] == 2009
    assert [(n["canonical_path"], n["label"]) for n in nodes] == [
        ("atto/preambolo", "Preambolo"), ("art:7", "Art. 7"), ("art:7/c:2", "comma 2"), ("art:7/c:2/lett:c", "lett. c"), ("art:7/c:2/lett:c/num:4", "num. 4"), ("art:7-ter", "Art. 7-ter"),
        ("allegato:B", "Allegato B"), ("allegato:B/tabella:9", "Tabella 9"), ("nota:1", "nota 1"),
    ]
    by = {n["canonical_path"]: n for n in nodes}
    assert by["art:7/c:2/lett:c/num:4"]["hierarchy_string"] == "Articolo 7 (Banchi) > Comma 2 > Lettera c > Numero 4"
    assert by["art:7"]["text_clean"] == "I banchi sono numerati." and by["art:7"]["heading"] == "Banchi" and by["art:7-ter"]["heading"] is None
    assert by["art:7/c:2/lett:c"]["text_clean"] == "espone il prezzo\n per litro." and "x" not in by["art:7/c:2"]["text_clean"]
    assert by["allegato:B"]["text_clean"] == by["allegato:B/tabella:9"]["text_clean"] == "Zona; Canone\nA; 30"


def test_akoma_act():
    doc, nodes, error = acts_xml.parse(AKOMA.encode())
    assert error is None and doc["canonical_doc"] == "legge:231:2001" and doc["version_tag"] == "/akn/e" and doc["authority"] == "stato"
    assert [(n["canonical_path"], n["level"]) for n in nodes] == [("akomaNtoso/act/body/article:art_1", 3), ("akomaNtoso/act/body/article:art_1/paragraph:p1", 4)]
    assert nodes[1]["text_clean"] == "Testo misto, l 1/2001." and nodes[1]["refs"] == [{"href": "/akn/x", "text": "l 1/2001"}]


def test_nested_structures_can_be_left_out():
    nodes = acts_xml.parse(AKOMA, acts_xml.Tags(exclude_structural=True))[1]
    assert [n["text_clean"] for n in nodes] == ["Art. 1", "Testo misto, l 1/2001."]


@pytest.mark.parametrize("content", [None, "", b"", b"\x00\xff", "kein xml", "<!-- <a> -->"])
def test_unreadable_files_give_an_error(content):
    doc, nodes, error = acts_xml.parse(content)
    assert doc is None and nodes == [] and error


def test_broken_acts_are_recovered():
    broken = SIMPLE.replace("</lettera>", "").replace("olio", "olio & pane < 3").replace("</atto>", "</sezione>")
    assert acts_xml.parse(broken, recover=False)[2]
    doc, nodes, error = acts_xml.parse(broken.encode())
    want = acts_xml.parse(SIMPLE)[1]
    assert error is None and doc["canonical_doc"] == "reg:12:2009" and [n["canonical_path"] for n in nodes] == [n["canonical_path"] for n in want]
    assert "olio & pane < 3" in {n["canonical_path"]: n for n in nodes}["art:7/c:2"]["text_clean"]
    cut = acts_xml.parse(AKOMA[: AKOMA.index("misto") + 5])
    assert cut[2] is None and [n["canonical_path"] for n in cut[1]] == ["akomaNtoso/act/body/article:art_1", "akomaNtoso/act/body/article:art_1/paragraph:p1"]
    assert cut[1][1]["text_clean"] == "Testo misto" and cut[0]["canonical_doc"] == "legge:231:2001"


def test_frbr_of_broken_text_is_null(spark):
    rows = spark.createDataFrame([(AKOMA,), ("<a",), (None,)], "x string").select(acts_xml.frbr(F.col("x")).alias("m")).collect()
    assert rows[0]["m"]["urn"] == "/akn/it/act/legge/stato/2001-05-06/231/!main" and rows[1]["m"]["urn"] is None and rows[2]["m"]["urn"] is None


def test_empty_and_deep_acts():
    assert acts_xml.parse("<atto></atto>")[0]["canonical_doc"] == "altro:0:0"
    deep = "<akomaNtoso>" + "<list>" * 1500 + "x" + "</list>" * 1500 + "</akomaNtoso>"
    assert len(acts_xml.parse(deep)[1]) == 1500


def test_scan_zip_parse_and_stream(spark, tmp_path):
    src = tmp_path / "in" / "sub"
    src.mkdir(parents=True)
    (src / "a.xml").write_text(SIMPLE)
    (src / "copy.xml").write_text(SIMPLE)
    (src / "bad.xml").write_text("kein Element")
    (src / "x.txt").write_text("no")
    (src / "broken.zip").write_bytes(b"no zip")
    with zipfile.ZipFile(tmp_path / "in" / "z.zip", "w") as z:
        z.writestr("d1/a.XML", AKOMA)
        z.writestr("d2/a.XML", AKOMA + " ")
        z.writestr("b.txt", "no")
    found = files.with_members(files.scan(spark, str(tmp_path / "in")))
    records = files.raw_records(found)
    assert records.count() == 7 and records.where("status = 'container'").count() == 2 and records.where("is_from_zip").count() == 2
    assert tuple(files.run_stats(records).first()) == (5, 3, 2)
    assert sorted(r["path"].rpartition("!")[2] for r in records.where("is_from_zip").collect()) == ["d1/a.XML", "d2/a.XML"]
    parsed = acts_xml.parsed(found.where("not path like '%.zip'"))
    assert parsed.where("parse_error is not null").count() == 1 and parsed.selectExpr("sum(size(nodes)) n").first()["n"] == 22
    out = str(tmp_path / "out")
    for _ in range(2):
        ingest.watch_acts(spark, str(tmp_path / "in"), out, str(tmp_path / "cp")).awaitTermination()
        assert spark.read.parquet(f"{out}/docs").count() == 4  # the copy has the same content
    (src / "late.xml").write_text(SIMPLE)
    (src / "new.xml").write_text("<atto></atto>")
    ingest.watch_acts(spark, str(tmp_path / "in"), out, str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(f"{out}/docs").count() == 5 and spark.read.parquet(f"{out}/nodes").count() == 13


def test_dialects(spark):
    df = spark.createDataFrame([(SIMPLE,), (AKOMA,), ("",), (None,), ("﻿<?xml?>\n<Atto x='1'/>",)], "x string")
    assert [r[0] for r in df.select(acts_xml.dialect(df["x"])).collect()] == ["simple", "akoma", None, None, "simple"]
    assert df.where("x like '%FRBR%'").select(acts_xml.frbr(df["x"]).alias("m")).first()["m"]["publication_date"] == "2001-05-06"


def test_jsonl(spark, tmp_path):
    rows = spark.createDataFrame([("1", "è", "s", None, "t", "")], files.EXPORT)
    files.write_jsonl(rows, str(tmp_path / "j"))
    assert [tuple(r) for r in files.read_jsonl(spark, str(tmp_path / "j")).collect()] == [("1", "è", "s", None, "t", "", False)]
    lines = spark.createDataFrame([("",), ("  ",), ("{bad",), ('{"id": "2"}',), (None,)], "value string")
    assert [r["bad"] for r in files.parse_jsonl(lines).collect()] == [True, True, True, False, True]
    assert files.publish(rows, str(tmp_path / "p")) == 1 and files.publish(rows.limit(0), str(tmp_path / "p")) == 0


def test_windowed_stream(spark, tmp_path):
    spark.createDataFrame([(1, "2024-01-01 00:10:00"), (1, "2024-01-01 00:50:00"), (2, "2024-01-01 01:10:00")], "k int, t string").selectExpr("k", "cast(t as timestamp) t").write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema("k int, t timestamp").parquet(str(tmp_path / "e"))
    q = ingest.windowed_counts(stream, "t", "k").writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r["n"] for r in spark.table("w").collect()) == [1, 2]


FRAGMENTS = [
    "<article eId='a'><num>Art. 1</num><paragraph><list><point>uno <b>due</b></point><item>tre</item></list></paragraph></article>",
    "<annex><p>x &amp; y</p>\n <p>è &#8364;</p></annex>", "<point><p>a</p><p>b</p></point>", "<section><p>a<eol/>b</p></section>", "<chapter/>", "<list><point>cut", "", None,
]


def walk(element):
    found = [element.text] if element.text else []
    for child in element:
        found += walk(child) + ([child.tail] if child.tail else [])
    return found


@pytest.fixture
def fragment_tables(spark, tmp_path):
    rows = [(k, [(f,), ("<point>due</point>",)]) for k, f in enumerate(FRAGMENTS)]
    spark.createDataFrame(rows + rows[:2], "parse_id long, nodes array<struct<text_xml_fragment string>>").write.parquet(f"{tmp_path}/parsed_acts.parquet")
    return str(tmp_path)


def test_text_of_any_element(spark, fragment_tables):
    got = {(r["parse_id"], r["node_pos"]): r["txt"] for r in reference_queries.f08_all_elements(spark, fragment_tables).collect()}
    want = {(k, 1): "due" for k in range(len(FRAGMENTS))}
    for k, f in enumerate(FRAGMENTS[:-1]):
        want[k, 0] = " ".join(walk(ET.fromstring(f))) if f.endswith(">") else None
    assert got == want and got[0, 0] == "Art. 1 uno  due tre" and got[1, 0] == "x & y \n  è €" and got[3, 0] == "a b" and got[5, 0] is None


def test_visit_takes_fragments_with_empty_tags(spark, fragment_tables):
    got = {(r["parse_id"], r["node_pos"]): (r["n_nodes"], r["root"]) for r in reference_queries.x09_akoma_visit(spark, fragment_tables).collect()}
    assert got == {(k, 1): (1, "point") for k in range(len(FRAGMENTS))} | {(0, 0): (5, "article"), (1, 0): (1, "annex"), (2, 0): (1, "point"), (3, 0): (1, "section")}
