import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from spanloom import schema
from spanloom.operators import corpus, manifest
from spanloom.sources import files
from spanloom.sources.package import ship
from spanloom.streaming import incremental


def test_corpus_xml_and_jsonl(spark, tmp_path):
    x = tmp_path / "c.xml"
    x.write_text('<quran><sura index="2" name="ب"><aya index="1" text="نور ٱلدَّارِ"/></sura><sura index="1" name="ا"><aya index="1" text="باب"/><aya index="2" text="دار"/></sura></quran>', encoding="utf-8")
    c = files.corpus_xml(spark, str(x))
    assert [(r.verse_id, r.surah_no, r.ayah_no, r.text_norm) for r in c.orderBy("verse_id").collect()] == [(1, 1, 1, "باب"), (2, 1, 2, "دار"), (3, 2, 1, "نور الدار")]
    files.write_json(c, f"{tmp_path}/c")
    assert files.corpus_jsonl(spark, f"{tmp_path}/c").count() == 3
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "a.json").write_text("\n\n")
    with pytest.raises(ValueError):
        files.corpus_jsonl(spark, f"{tmp_path}/empty")
    files.copy_if_missing(spark, str(x), str(tmp_path / "to" / "c.xml"))
    assert files.locate(spark, "/nowhere", str(x)) == str(x)
    with pytest.raises(FileNotFoundError):
        files.locate(spark, "/nowhere")


def test_documents_listing_and_mirror(spark, tmp_path):
    rows = spark.createDataFrame([("g/a.json", json.dumps({"surah": "g", "episode": 1, "segments": [{"id": 0, "text": "x"}]})), ("g/b.json", "{cut off")], "name string, body string")
    files.write_mirrored(rows, "name", "body", f"{tmp_path}/d")
    d = files.transcripts(spark, f"{tmp_path}/d").select("episode", "_corrupt_record", "path").collect()
    assert sorted((r.episode is None, r._corrupt_record is None) for r in d) == [(False, True), (True, False)]
    assert files.listing(spark, f"{tmp_path}/d", recursive=True, glob="*.json").count() == 2
    with pytest.raises(Exception):
        files.transcripts(spark, f"{tmp_path}/d", strict=True).collect()
    (tmp_path / "v").mkdir()
    for n in ("سورة يونس رقم 3.MP4", "odd.mkv", "notes.txt"):
        (tmp_path / "v" / n).write_bytes(b"x")
    good, bad = files.videos(spark, f"{tmp_path}/v")
    assert [r.number for r in good.collect()] == [3] and bad.count() == 1


def test_sheet_and_manifest(spark, tmp_path):
    s = spark.createDataFrame([("e.json", "s", 1, "accepted", 0.9, 1.0, 2.0, 'he said "x", y', "q")], "episode string, surah string, ayah int, status string, confidence double, start double, end double, transcript_text string, canonical_quoted string")
    files.write_gold_sheet(s, f"{tmp_path}/g")
    back = files.gold(spark, f"{tmp_path}/g").first()
    assert back.transcript_text == 'he said "x", y' and back.VERDICT in (None, "")
    assert files.manifest(spark, f"{tmp_path}/none").count() == 0
    st = manifest.register(files.manifest(spark, f"{tmp_path}/none"), spark.createDataFrame([("a", "o/a"), ("b", "o/b")], "key string, output_path string"))
    st = files.save_manifest(st, f"{tmp_path}/m")
    ch = spark.createDataFrame([("a", "done", None, "2024"), ("b", "failed", "why", "2024")], "key string, status string, error string, at string")
    files.save_manifest(manifest.apply(st, ch), f"{tmp_path}/m")
    assert {tuple(r) for r in files.manifest(spark, f"{tmp_path}/m").collect()} == {("a", "done", "o/a", None, "2024"), ("b", "failed", "o/b", "why", "2024")}
    with pytest.raises(Exception, match="not registered"):
        manifest.apply(st, spark.createDataFrame([("z", "done", "2024")], "key string, status string, at string")).collect()
    (tmp_path / "one.json").write_text(json.dumps({"phase": "p", "records": {"a": {"status": "done", "output_path": "x", "error": None, "processed_at": "t"}}}))
    assert [tuple(r) for r in files.manifest(spark, f"{tmp_path}/one.json").collect()] == [("a", "done", "x", None, "t")]


def test_a_file_of_several_records_is_read_whole(spark, tmp_path):
    (tmp_path / "two.json").write_text('{"surah": "a", "episode": 1}\n{"surah": "b", "episode": 2}\n\n')
    (tmp_path / "one.json").write_text('{"surah": "c",\n "episode":\n 3}')
    (tmp_path / "bad.json").write_text('{"surah": "d"\n')
    d = files.transcripts(spark, str(tmp_path)).collect()
    assert sorted(r.surah for r in d if r._corrupt_record is None) == ["a", "b", "c"] and len(d) == 4


def test_time_is_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        got = spark.range(1).select(files.utc_now()).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert abs((datetime.strptime(got, "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=timezone.utc) - datetime.now(timezone.utc)).total_seconds()) < 120


def test_fulltext_tables_and_predictions(spark, tmp_path):
    v = spark.createDataFrame([(1, 1, "g", 1, "a b", "a b", None)], schema.VERSE)
    files.fulltext_tables(corpus.passages(v), "ft_test")
    assert spark.table("ft_test.postings").count() == 2
    spark.sql("DROP DATABASE ft_test CASCADE")
    (tmp_path / "e" / "g").mkdir(parents=True)
    (tmp_path / "e" / "g" / "ep_001.json").write_text(json.dumps({"matches": [{"surah": "s", "ayah": 1, "status": "accepted"}, {"surah": "s", "ayah": 2, "status": "review"}]}))
    p = files.predictions(spark, f"{tmp_path}/e", spark.createDataFrame([("g/ep_001.json",)], "episode string"), ["accepted"])
    assert [tuple(r) for r in p.collect()] == [("g/ep_001.json", "s", 1)]


def test_a_failing_file_does_not_end_the_run(spark):
    def load():
        def model(path):
            if "bad" in path:
                raise ValueError("cannot read")
            return '{"segments": []}'

        return model

    got = {r.path: (r.body, r.error) for r in files.run_model(spark.createDataFrame([("ok",), ("bad",)], "path string"), load).collect()}
    assert got == {"ok": ('{"segments": []}', None), "bad": (None, "ValueError: cannot read")}
    with pytest.raises(RuntimeError):
        files.external_tool("no-such-program")


def test_new_files_only(spark, tmp_path):
    ship(spark)
    from tests.test_quotes import corpus_of, docs_of

    verses = corpus_of(spark, ["باب دار قلم كتاب نور"])
    docs = docs_of(spark, ["قال باب دار قلم كتاب نور", "كلام"])
    docs.write.parquet(f"{tmp_path}/in")
    for n in (1, 1, 2):
        if n == 2:
            docs.withColumn("transcript_id", F.col("transcript_id") + 10).write.mode("append").parquet(f"{tmp_path}/in")
        stream = incremental.table_stream(spark, f"{tmp_path}/in", f"transcript_id long, surah_order int, segments array<{schema.SEGMENT}>")
        incremental.enrich_new(stream, verses, f"{tmp_path}/out", f"{tmp_path}/state")
        assert sorted(r.doc for r in spark.read.parquet(f"{tmp_path}/out/matches").collect()) == [0, 10][:n]
        assert {r.enriched_text for r in spark.read.parquet(f"{tmp_path}/out/texts").collect()} == {"قال ﴿ باب دار قلم كتاب نور ﴾ [g1:1]"}


def test_streamed_windows_equal_batch(spark, tmp_path):
    ev = spark.sql("SELECT timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,id*7) AS ts, if(id % 2 = 0, 'a', 'b') AS event_type, cast(id as double) AS value FROM range(500)")
    ev.write.parquet(f"{tmp_path}/ev")
    incremental.run_windowed(incremental.table_stream(spark, f"{tmp_path}/ev", "ts timestamp, event_type string, value double"), f"{tmp_path}/o", f"{tmp_path}/s")
    batch = {tuple(r) for r in incremental.windowed_counts(ev, "ts", "event_type").collect()}
    assert batch and {tuple(r) for r in incremental.latest(spark.read.parquet(f"{tmp_path}/o")).collect()} == batch
