import json

import pytest
from pyspark.sql import functions as F

from spanloom import __main__ as cli
from spanloom.config import load_config, load_paths
from spanloom.sources import files


def test_build_enrich_and_evaluate(spark, tmp_path, capsys):
    (tmp_path / "c.xml").write_text('<quran><sura index="1" name="g"><aya index="1" text="باب دار قلم كتاب نور"/><aya index="2" text="ليل نهار شمس قمر نجم"/></sura></quran>', encoding="utf-8")
    cli.main(["build", f"{tmp_path}/c.xml", f"{tmp_path}/c"])
    (tmp_path / "t" / "g").mkdir(parents=True)
    doc = {"surah": "g", "surah_order": 1, "episode": 1, "segments": [{"id": 0, "start": 0.0, "end": 7.0, "text": "قال باب دار قلم كتاب نور ثم"}]}
    (tmp_path / "t" / "g" / "ep_001.json").write_text(json.dumps(doc), encoding="utf-8")
    (tmp_path / "t" / "g" / "ep_002.json").write_text("{cut", encoding="utf-8")
    cli.main(["enrich-all", f"{tmp_path}/t", f"{tmp_path}/c", f"{tmp_path}/o"])
    out = capsys.readouterr().out
    stats = json.loads(out.strip().splitlines()[-1])
    assert (stats["documents"], stats["failed"], stats["total_matches"]) == (1, 1, 1)
    assert sorted(str(p.relative_to(tmp_path / "o" / "documents")) for p in (tmp_path / "o" / "documents").rglob("*.json")) == ["g/ep_001.json"]
    cli.main(["gold-sheet", f"{tmp_path}/t", f"{tmp_path}/c", f"{tmp_path}/sheet"])
    capsys.readouterr()
    sheet = files.gold(spark, f"{tmp_path}/sheet").withColumn("VERDICT", F.lit("1"))
    assert [(r.episode, r.surah, r.ayah) for r in sheet.collect()] == [("g/ep_001.json", "g", 1)]
    sheet.write.csv(f"{tmp_path}/judged", header=True, escape='"')
    cli.main(["evaluate", f"{tmp_path}/judged", f"{tmp_path}/o/documents"])
    assert json.loads(capsys.readouterr().out.splitlines()[0]) == {"tp": 1, "fp": 0, "fn": 0, "precision": 1.0, "recall": 1.0, "f1": 1.0}
    cli.main(["enrich-file", f"{tmp_path}/t/g/ep_001.json", f"{tmp_path}/c"])
    back = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert back["segments"][0]["enriched_text"] == "قال ﴿ باب دار قلم كتاب نور ﴾ [g:1] ثم"
    cli.main(["demo", f"{tmp_path}/c", "قال باب دار قلم كتاب نور"])
    assert "accepted" in capsys.readouterr().out


def test_ingest_is_resumable(spark, tmp_path, capsys):
    (tmp_path / "v").mkdir()
    for n in ("سورة يونس رقم 3.mp4", "سورة يونس رقم 4.mp4", "سورة مجهول رقم 1.mp4", "odd.mp4"):
        (tmp_path / "v" / n).write_bytes(b"x")
    (tmp_path / "orders.json").write_text(json.dumps({"surahs": [{"order": 10, "name": "يونس"}]}, ensure_ascii=False), encoding="utf-8")
    run = ["ingest", f"{tmp_path}/v", f"{tmp_path}/orders.json", f"{tmp_path}/w", "--manifest", f"{tmp_path}/m", "--batch-size", "2"]
    cli.main([*run, "--command", "false"])
    assert json.loads(capsys.readouterr().out.splitlines()[-1]) == {"total": 3, "done": 0, "failed": 3, "pending": 0}
    cli.main([*run, "--limit", "2", "--command", "cp", "{input}", "{output}"])
    assert json.loads(capsys.readouterr().out.splitlines()[-1]) == {"total": 3, "done": 2, "failed": 1, "pending": 0}
    (tmp_path / "w" / "مجهول").mkdir(parents=True, exist_ok=True)
    (tmp_path / "w" / "مجهول" / "ep_001.wav").write_bytes(b"x")
    cli.main([*run, "--dry-run"])
    assert capsys.readouterr().out.startswith("0 pending")
    cli.main(["catalogue", f"{tmp_path}/v", f"{tmp_path}/orders.json", f"{tmp_path}/k", "--manifest", f"{tmp_path}/m"])
    assert spark.read.json(f"{tmp_path}/k/unmatched").count() == 2


SETTINGS = """
paths: {quran_xml: data/q.xml, output_dir: /abs}
normalization: {normalize_hamza: false}
retrieval: {window_size: 8, bigram_df_cap: 40}
verification: {accept_threshold: 0.9}
multiverse: {extend_threshold: 0.72}
output: {replace_with: full_ayah, open_marker: "<"}
"""


def test_sectioned_settings(tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "s.yaml").write_text(SETTINGS)
    c = load_config(tmp_path / "s.yaml")
    assert (c.rules.unify_hamza, c.bigram_df_cap, c.accept, c.extend_score, c.replace_with, c.open_mark) == (False, 40, 0.9, 72.0, "full", "<")
    assert load_paths(tmp_path / "s.yaml", "/root/x") == {"quran_xml": "/root/x/data/q.xml", "output_dir": "/abs"}
    (tmp_path / "w.yaml").write_text("retrieval: {no_such: 1}")
    with pytest.raises(ValueError):
        load_config(tmp_path / "w.yaml")
