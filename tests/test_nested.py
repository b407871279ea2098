import json

import pyarrow as pa

from spanloom.operators import nested
from spanloom.plans import general


def unwrap(d):
    for _ in range(40):
        if isinstance(d, str):
            d = json.loads(d)
        elif isinstance(d, dict) and d.get("payload") is not None and d.get("segments") is None and d.get("matches") is None:
            d = d["payload"]
    return d


def listed(x):
    return x if isinstance(x, list) else [x] if isinstance(x, dict) else []


def brute(rows):
    out = set()
    for rid, body in rows:
        try:
            d = unwrap(json.loads(body))
        except Exception:
            continue
        if not isinstance(d, dict):
            continue
        for i, s in enumerate(listed(d.get("segments"))):
            if isinstance(s, dict):
                out.add((rid, "segment", -1, i))
                for node, field in (("word", "words"), ("segment_match", "matches")):
                    out |= {(rid, node, i, j) for j, w in enumerate(listed(s.get(field))) if isinstance(w, dict)}
        out |= {(rid, "match", -1, i) for i, m in enumerate(listed(d.get("matches"))) if isinstance(m, dict)}
    return out


def test_bodies_of_every_shape(spark, tmp_path):
    plain = {"segments": [{"id": 1, "words": [{"word": "a"}, None, {"word": None}], "matches": {"status": "x"}}, None, {"id": "2"}], "matches": [None, {"status": 5}]}
    one = {"segments": {"words": {"word": "x"}, "matches": []}, "matches": {}}
    text = json.dumps(plain)
    bodies = [
        text, json.dumps(one), json.dumps(text), json.dumps({"version": 2, "payload": plain}), json.dumps({"payload": text}), json.dumps(json.dumps({"payload": one})), text[:-5], text + " x", text + text,
        "", "   ", "null", "[]", "5", '"x"', None, "{'segments': [{}]}", '{"segments": [{}, 5, "x", [1], {"words": 5}]}', '{"segments": "x"}', '{"segments": null}', "\n " + text, '{"meta": {"segments": [{}]}}',
        json.dumps(plain, indent=1), json.dumps({"segments": [{"text": "نص", "words": []}]}), '{"segments": [{"words": [{"word": {"deep": [1, {"words": [{}]}]}}]}]}',
    ]
    six, quoted = one, text
    for _ in range(6):
        six = {"version": 1, "payload": six}
        quoted = json.dumps(quoted)
    both = text
    for i in range(9):
        both = json.dumps({"payload": both} if i % 2 else both)
    bodies += [json.dumps(six), quoted, both, both[:-3], '{"p\\u0061yload": {"segments": [{}, {}]}}', '{"payload": {"payload": null}}', '{"payload": "payload"}', '{"segments": [{}]}], "d": 5']
    rows = list(enumerate(bodies))
    spark.createDataFrame(rows, "record_id long, body string").write.parquet(f"{tmp_path}/raw_records.parquet")
    got = general.p4_found(spark, str(tmp_path)).collect()
    assert set(map(tuple, got)) == brute(rows) and len(got) == len(set(got))


def test_offsets_of_sliced_and_null_lists():
    lists = pa.array([[1], None, [], [2, None, 3], [4]], pa.list_(pa.int32())).slice(1)
    parents, pos, values = nested.list_children(lists)
    assert (parents.to_pylist(), pos.to_pylist(), values.to_pylist()) == ([2, 2, 2, 3], [0, 1, 2, 0], [2, None, 3, 4])
    assert [x.to_pylist() for x in nested.descend([pa.array(["a", "b", "c", "d"])], lists)[1:]] == [[-1, -1, -1], [0, 2, 0], [2, 3, 4]]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "record_id long, body string").write.parquet(f"{tmp_path}/raw_records.parquet")
    assert general.p4_found(spark, str(tmp_path)).count() == 0


def test_typed_children(spark, tmp_path):
    body = {"segments": [{"id": "7", "start": 1, "text": 5, "end": "x"}, None, {"text": "t", "words": [{}]}], "matches": {"verse_id": "12", "is_cross_surah": True, "confidence": 1}}
    spark.createDataFrame([(1, json.dumps(body)), (2, None)], "record_id long, body string").write.parquet(f"{tmp_path}/raw_records.parquet")
    s = sorted(general.p4_segments(spark, str(tmp_path)).collect())
    assert [(r.record_id, r.parent_pos, r.pos, r.id, r.start, r.end, r.text) for r in s] == [(1, -1, 0, 7, 1.0, None, "5"), (1, -1, 2, None, None, None, "t")]
    m = general.p4_matches(spark, str(tmp_path)).first()
    assert (m.pos, m.verse_id, m.is_cross_surah, m.confidence, m.surah) == (0, 12, True, 1.0, None)


def test_children_of_segments_and_their_documents(spark, tmp_path):
    match = {"verse_id": "12", "status": "accepted", "confidence": 0.5}
    seg = {"id": 1, "enriched_text": "e", "words": [{"word": "a", "start": 1, "probability": "x"}, None, {"word": None}], "matches": match}
    doc = {"surah": "s", "episode": "3", "total_matches": 1, "segments": [None, seg, 5], "matches": None}
    bodies = [json.dumps(doc), json.dumps(json.dumps({"payload": doc})), json.dumps({"payload": 5}), json.dumps(json.dumps("x")), "{}", "[]", "[{}]", "5", "null", '"x"', "", "{", '{"a": 1} x', None, json.dumps({"payload": json.dumps({"surah": "t", "matches": {}})})]
    spark.createDataFrame(list(enumerate(bodies)), "record_id long, body string").write.parquet(f"{tmp_path}/raw_records.parquet")
    rows = lambda q, *names: sorted((tuple(r[n] for n in names) for r in q(spark, str(tmp_path)).collect()), key=repr)
    assert rows(general.p4_segment_words, "record_id", "parent_pos", "pos", "word", "start", "end", "probability") == [(k, 1, i, w, s, None, None) for k in (0, 1) for i, w, s in ((0, "a", 1.0), (2, None, None))]
    assert rows(general.p4_segment_matches, "record_id", "parent_pos", "pos", "verse_id", "status", "confidence", "surah") == [(k, 1, 0, 12, "accepted", 0.5, None) for k in (0, 1)]
    assert rows(general.p4_segments, "record_id", "pos", "id", "enriched_text") == [(0, 1, 1, "e"), (1, 1, 1, "e")]
    assert rows(general.p4_parents, "record_id", "surah", "episode", "total_matches") == [(0, "s", 3, 1), (1, "s", 3, 1), (14, "t", None, None), (4, None, None, None)]
