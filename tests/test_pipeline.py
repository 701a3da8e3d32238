"""The whole pipeline twice over a folder, and the command line."""

import json

import pytest
from test_sources import AKOMA, SIMPLE

from lexgrain import pipeline, schemas, settings
from lexgrain.__main__ import main


def test_pipeline_is_idempotent(spark, tmp_path, capsys):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.xml").write_text(SIMPLE)
    (src / "a2.xml").write_text(SIMPLE.replace("t3", "t4").replace("per litro", "per litro, art. 5 della legge 7/2001"))
    (src / "k.xml").write_text(AKOMA)
    (src / "bad.xml").write_text("kein Element")
    t = pipeline.Tables(spark, f"file://{tmp_path}/t")
    seen = []
    for _ in range(2):
        assert pipeline.ingest(t, str(src)).first()["files"] == 4
        made = pipeline.parse(t)
        made |= {"refs": pipeline.extract_references(t), "edges": pipeline.resolve_references(t), "events": pipeline.detect_conflicts(t), "deltas": pipeline.build_deltas(t)}
        seen.append(made)
    assert seen[0]["documents"] == 2 and seen[0]["document_versions"] == 3 and seen[0]["nodes"] == 20 and seen[0]["errors"] == 1
    assert seen[0]["refs"] > 0 and seen[1]["refs"] == 0
    assert seen[0] | {"refs": 0} == seen[1]
    assert seen[0]["events"] == 9  # both versions of the simple act are open
    assert t.read("ingestion_runs").count() == 2 and t.read("raw_files").where("status = 'parsed'").count() == 3
    assert pipeline.latest_versions(t).count() == 2
    assert schemas.too_long(t.read("nodes")).where("n_rows > 0").count() == 0
    tables = ["--tables", f"file://{tmp_path}/t"]
    assert main([*tables, "export-rag", "--output", str(tmp_path / "out")], spark) == 0
    lines = [json.loads(x) for f in (tmp_path / "out").glob("part-*") for x in f.read_text().splitlines()]
    assert len(lines) == 20 and {"Regolamento dei mercati", "legge:231:2001"} == {x["source"] for x in lines}
    assert [g[0] for g in t._generations("raw_content")] == ["a", "a"] and t.read("raw_content").count() == 4
    cited = t.read("references_extracted").count()
    (src / "a3.xml").write_text(SIMPLE.replace("t3", "t4").replace('<numero id="4">per litro.</numero>', ""))  # the version again, without the node that cites
    pipeline.ingest(t, str(src))
    pipeline.parse(t)
    assert t.read("nodes").count() == 19 and t.read("references_extracted").join(t.read("nodes").selectExpr("node_id source_node_id"), "source_node_id", "left_anti").count() == 0
    assert 0 < cited - t.read("references_extracted").count()
    for verb in (["build-fts"], ["search-like", "x"], ["stats"], ["search", "base"], ["tree", "reg:12:2009"], ["backfill-hierarchy"], ["reset"]):
        assert main([*tables, *verb], spark) == 0
    assert t.read("nodes").count() == 0 and "articolo" in capsys.readouterr().out


def test_settings(monkeypatch):
    monkeypatch.delenv("LEXGRAIN_TABLES", raising=False)
    with pytest.raises(settings.ValidationError):
        settings.Settings.from_env()
    assert settings.Settings.from_env("x", "y").input_dir == "y"
    assert "conflict_events" not in schemas.tables(1) and len(schemas.tables()) == 10
