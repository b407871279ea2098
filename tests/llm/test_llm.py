import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.llm import bpe, forms, langid, leak, lookalikes, queries, repetition, spans


def spans_by_hand(rows, n):
    owners = {}
    for f, o, i, t in rows:
        w = [x for x in (t or "").split(" ") if x]
        for k in range(len(w) - n + 1):
            owners.setdefault(tuple(w[k : k + n]), set()).add(o)
    out = set()
    for f, o, i, t in rows:
        w = [x for x in (t or "").split(" ") if x]
        hit = [False] * len(w)
        for k in range(len(w) - n + 1):
            if len(owners[tuple(w[k : k + n])]) > 1:
                hit[k : k + n] = [True] * n
        k = 0
        while k < len(w):
            e = k
            while e < len(w) and hit[e]:
                e += 1
            if e > k:
                out.add((f, o, i, k, e - 1))
            k = max(e, k + 1)
    return out


@pytest.mark.parametrize("n", [4, 5])
def test_shared_spans(spark, n):
    rnd = random.Random(n)
    common = [" ".join(rnd.choice("abcd") for _ in range(rnd.randrange(3, 12))) for _ in range(6)]
    rows = []
    for i in range(80):
        t = " ".join(rnd.choice(common) if rnd.random() < 0.4 else rnd.choice("abcdefgh") for _ in range(rnd.randrange(0, 8)))
        rows.append((rnd.choice("xy"), rnd.randrange(6), i, rnd.choice([t, t.replace(" ", "  "), " " + t, t + "\tz"])))
    rows += [("x", 1, 900, None), ("x", 2, 901, ""), ("y", 3, 902, "q q q q q q q q"), ("y", 3, 903, "q q q q q q q q"), ("x", 7, 904, "a b c d " * 2000), ("x", 8, 905, "a b c d " * 2000)]
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], "field_name string, transcript_id long, item_id long, text string, pos string, h1 int")
    got = spans.shared_spans(df, "transcript_id", n).collect()
    assert set(map(tuple, got)) == spans_by_hand(rows, n) and len(got) == len(set(got))
    share = {(r.field_name, r.transcript_id, r.item_id): (r.n_shared, r.level) for r in spans.shared_share(df, "transcript_id", n).collect()}
    assert share[("x", 7, 904)] == (8000, n * 2 ** int(np.log2(8000 / n)))
    assert spans.shared_spans(df.limit(0), "transcript_id", n).count() == 0


def test_share_of_every_text(spark):
    rows = [("x", 1, 1, "a b c d e"), ("x", 2, 1, "z a b c d"), ("y", 2, 2, "q"), ("x", 3, 1, ""), ("x", 3, 2, None), ("x", 1, 1, "a b c d e"), ("y", 4, None, "p q")]
    df = spark.createDataFrame(rows, "field_name string, transcript_id long, item_id long, text string")
    got = [(r.field_name, r.transcript_id, r.item_id, r.n_words, r.n_shared, r.share, r.level) for r in spans.shared_share(df, "transcript_id", 4).collect()]
    assert sorted(got, key=repr) == [("x", 1, 1, 5, 4, 0.8, 4), ("x", 2, 1, 5, 4, 0.8, 4), ("x", 3, 1, 0, 0, 0.0, 0), ("y", 2, 2, 1, 0, 0.0, 0), ("y", 4, None, 2, 0, 0.0, 0)]


def test_repetition(spark):
    rnd = random.Random(1)

    def slow(w):
        seen, hit = set(), [False] * len(w)
        for i in range(len(w) - 2):
            t = tuple(w[i : i + 3])
            if t in seen:
                hit[i] = hit[i + 1] = hit[i + 2] = True
            seen.add(t)
        return sum(hit)

    m = repetition.Measure(bpe.DEFAULT)
    texts = [[rnd.choice("abc") * rnd.choice([1, 2, 9]) for _ in range(rnd.randrange(0, 40))] for _ in range(500)]
    for w, x in zip(texts, m.all(texts, 8, 0.5)):
        assert repetition.repeated_words(w) == slow(w)
        if len(w) >= 8 and 2 * slow(w) >= len(w):
            assert x[11] and x[1] == slow(w)
    for w, x in zip(texts, m.all(texts, 8, 0.5, True)):
        assert x[11] or len(w) < 8 or 2 * slow(w) < len(w)  # the bounds lose no case
    seg = "array<struct<id:int,text:string,avg_logprob:double>>"
    rows = [
        (1, [(2, "a b c", -0.1), (1, "A, b; ḉc a b ｃ a bَ c", None), (None, "x", 0.0), (3, None, 0.0)], "n"),
        (2, [], "n"), (3, None, "n"), (4, [(1, "ق ل م " * 5000, 0.0)], "n"), (5, [(1, "?! ...", 0.0), (2, "", 0.0)], "n"),
    ]
    out = {(r.transcript_id, r.segment_id): r for r in repetition.measure(spark.createDataFrame(rows, f"transcript_id long, segments {seg}, n_words string"), "transcript_id", "segments", bands=repetition.fit_bands([("ar", "باب دار قلم كتاب نور ليل نهار شمس"), ("en", "the heart of the garden and a river by the gate")])).collect()}
    assert set(out) == {(1, 1), (1, 2), (1, -1), (4, 1), (4, -1)}
    assert (out[4, 1].n_words, out[4, 1].n_repeated, out[4, 1].outside) == (15000, 14997, True)
    assert out[1, -1].n_words == 12


def test_every_text_has_its_share_of_repeated_words(spark):
    seg = "array<struct<id:int,text:string,avg_logprob:double>>"
    texts = ["a b c a b c", "p q r s t u v w p q r x y z k l m n o i", "one two"]
    df = spark.createDataFrame([(1, list(zip(range(3), texts, [0.0] * 3)))], f"transcript_id long, segments {seg}")
    got = {r.segment_id: (r.n_words, r.n_repeated, r.share, r.exact) for r in repetition.measure(df, "transcript_id", "segments").collect()}
    assert got == {0: (6, 3, 0.5, True), 1: (20, 3, 0.15, True), 2: (2, 0, 0.0, True), -1: (28, 6, 6 / 28, True)}
    m, words = repetition.Measure(bpe.DEFAULT), [t.split() for t in (*texts, "a b c d e " * 3)]
    assert [x[1] for x in m.all(words, 8, 0.5, True)] == [-1, -1, -1, 10]


def test_bands_are_of_all_samples(spark, tmp_path):
    rnd = random.Random(3)
    words = {"ar": "باب دار قلم كتاب نور ليل نهار شمس بحر جبل".split(), "en": "the heart of a garden and river by old gate".split()}
    samples = [(lang, " ".join(rnd.choices(w, k=rnd.randrange(4, 30)))) for lang, w in words.items() for _ in range(langid.PER_LANGUAGE)]
    late = "internationalization " * 12 + "crystallographically"
    samples += [("en", late), ("ar", "ڰۑݥ " * 9), ("en", "?! 12 ..."), ("en", ""), (None, "x y z"), ("ar", None)]
    spark.createDataFrame([(i, *s) for i, s in enumerate(samples)], "sample_id long, lang string, text string").repartition(3).write.parquet(f"{tmp_path}/lang_samples.parquet")
    seg = "array<struct<id:int,text:string,avg_logprob:double>>"
    spark.createDataFrame([(1, "en", [(1, late, 0.0), (2, "the river and the old gate by a garden", 0.0), (3, "𐎠𐎡𐎢 " * 9, 0.0)])], f"transcript_id long, language string, segments {seg}").write.parquet(f"{tmp_path}/transcripts.parquet")
    got = {r.segment_id: (r.band, r.outside) for r in queries.p3_measures(spark, str(tmp_path)).collect()}
    assert got[1] == ("en", False) and got[2] == ("en", False) and got[3] == ("en", True)
    table, plain = repetition.table_bands(spark.read.parquet(f"{tmp_path}/lang_samples.parquet"), "lang", "text"), repetition.fit_bands([s for s in samples if s[0] and s[1]])
    assert set(table) == set(plain) == {"ar", "en", "ARABIC", "LATIN", "OTHER"}
    for name, band in plain.items():
        for (low, high, byte, line), want in zip(table[name], band, strict=True):
            assert (low, high, byte) == pytest.approx(want[:3]) and np.allclose(line, want[3])


@pytest.mark.parametrize("text, wider, odd", [
    ("باب دار", False, False), ("باب دار", False, True), ("با​ب", False, True), ("ﺑﺎﺏ", False, True), ("آ", False, True), ("کتاب", False, True), ("کتاب می‌شود", True, False), ("می‌شود", False, True),
    ("abc, 1!", False, False), ("аbc", False, True), ("ａｂｃ", False, True), ("", False, False), ("﻿bab", True, True), ("😀", False, False), ("مُدَّ", False, not unicodedata.is_normalized("NFC", "مُدَّ")),
])
def test_odd_spellings(text, wider, odd):
    keep = forms.PERSIAN_URDU if wider else ""
    assert forms.is_odd(text, keep) == odd
    form = forms.ordinary(text, keep)
    assert not forms.is_odd(form, keep) and forms.skeleton(form) == forms.skeleton(text)


@pytest.mark.parametrize("signs", ["۰۱۲۳۴۵۶۷۸۹", "ٮڡٯۍٲٳ", "ɑɡɩʋᴄᴏᴠᴡᴢꜱʏǀƖ", "ѵѴӀӏҮүԌԚԜ", "օՕսՏՍԼհոռցզգյա"])
def test_look_alikes_agree_with_the_sql(signs):
    duckdb = pytest.importorskip("duckdb")
    for ch in signs:
        text = f"ab {ch} cd"
        sql = duckdb.execute(f"SELECT nfc_normalize(?) <> ? OR regexp_matches(?, '{queries._class()}')", [text] * 3).fetchone()[0]
        twin = forms.ordinary(text)
        assert sql and forms.is_odd(text) and not forms.is_odd(twin) and forms.skeleton(text) == forms.skeleton(twin), hex(ord(ch))
    assert not any(forms.is_odd(ch, forms.PERSIAN_URDU) for ch in "۰۱۲۳۴۵۶۷۸۹")


def test_groups_of_one_look(spark):
    rows = [("بابي", False), ("بابی", False), ("بابي", False), ("دار", False), (None, False), ("بابي‏", True)]
    df = spark.createDataFrame(rows, "t string, w boolean")
    assert [(r.n_rows, r.n_forms) for r in lookalikes.groups(df, "t", "w").collect()] == [(4, 3)]
    assert lookalikes.consistent(df.limit(0), [], "t", "w", True, False).count() == 0


def test_encoding_equals_the_library(spark):
    tiktoken = pytest.importorskip("tiktoken")
    import base64

    with open(bpe.DEFAULT, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    lib = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(2)
    kinds = ["abcdefghij", "aab", "ابتثج ", "the in er ", "<|endoftext|>\n\t ", "é漢🙂 ", "'s 12"]
    texts = ["".join(rnd.choice(rnd.choice(kinds)) for _ in range(rnd.choice([1, 5, 30, 80, 300]))) for _ in range(400)]
    texts += [None, "", "<|endoftext|>", "a" * 3000, " " * 500, "".join(rnd.choice("abcdefghijklmnop") for _ in range(5000)), "ab" * 2000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit(0))
    got = {r.doc_id: r.ids for r in bpe.encode(df, "doc_id", "text").collect()}
    assert got == {i: lib.encode_ordinary(t) if t else [] for i, t in enumerate(texts)}
    assert bpe.encode(df.limit(0), "doc_id", "text").count() == 0


def test_pieces_remembered_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "MOST_PIECES", 10)
    e = bpe.Encoder(bpe.DEFAULT)
    for i in range(5):
        off, ids = e.encode([f" w{i}{j} x" for j in range(20)])
        assert len(off) == 21 and off[-1] == len(ids)


def test_leaks(spark):
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randrange(2, 20)))) for i in range(15)] + [(99, None), (98, "")]
    docs = []
    for d in range(120):
        parts = []
        for _ in range(rnd.randrange(0, 5)):
            words = (rnd.choice(items)[1] or "x").split()
            a = rnd.randrange(len(words) + 1)
            parts += [w.upper() + rnd.choice(["", ",", "​"]) for w in words[a : a + rnd.randrange(14)]] + ["zz"] * rnd.randrange(2)
        docs.append((d, rnd.choice([" ", "\n", " - "]).join(parts)))
    docs += [(900, None), (901, ""), (902, items[0][1] * 1), (903, "zz " * 30000 + items[3][1])]
    n = 4
    bare = forms.BareWords(True)
    want = {}
    for d, t in docs:
        w = bare.words(t or "")
        for i, it in items:
            v = bare.words(it or "")
            best = (0, 0)
            for a in range(len(w)):
                for b in range(len(v)):
                    k = 0
                    while a + k < len(w) and b + k < len(v) and w[a + k] == v[b + k]:
                        k += 1
                    best = max(best, (k, -a))
            if best[0] >= n:
                want[d, i] = (best[0], -best[1])
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    it = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_words, r.at_word) for r in leak.leaks(df, "doc_id", "text", it, "item_id", "text", n).collect()}
    assert got == want
    old = leak.BLOCK_BYTES, leak.SHARD_WORDS
    leak.BLOCK_BYTES, leak.SHARD_WORDS = 200, 50
    try:
        assert {(r.doc_id, r.item_id) for r in leak.leaks(df, "doc_id", "text", it, "item_id", "text", n).collect()} == set(want)
    finally:
        leak.BLOCK_BYTES, leak.SHARD_WORDS = old
    assert leak.leaks(df, "doc_id", "text", it.limit(0), "item_id", "text", n).count() == 0


def test_equal_items_and_equal_documents_are_matched_once():
    import resource
    import time

    words = " ".join(f"w{i}" for i in range(40))
    items = leak.Items([(i, words) for i in range(1000)], 12)
    ids = np.array([items.number[f"w{i}"] for i in range(40)], np.int32)
    began, before = time.time(), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    got = list(leak.find([ids.copy() for _ in range(1000)], items, 12))
    assert sum(len(d) for d, *_ in got) == 1_000_000 and max(len(d) for d, *_ in got) <= leak.PAIRS
    assert all((length == 40).all() and (at == 0).all() for _, _, length, at in got)
    assert time.time() - began < 5 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300_000
    # documents and items that differ but share the passage
    items = leak.Items([(i, f"x{i} {words} y{i}") for i in range(300)], 12)
    ids = np.array([items.number[f"w{i}"] for i in range(40)], np.int32)
    docs = [np.concatenate([[items.number[f"x{i}"]], ids, [0]]).astype(np.int32) for i in range(200)]
    pairs = {(int(d), int(i)): int(n) for x in leak.find(docs, items, 12) for d, i, n in zip(*x[:3])}
    assert len(pairs) == 60_000 and all(n == (41 if d == i else 40) for (d, i), n in pairs.items())


def test_suffix_array_is_sorted():
    rnd = np.random.default_rng(4)
    w = np.append(rnd.integers(1, 3, 300), 0).astype(np.int32)
    starts = leak.whole_windows(w, 5)
    a, _ = leak.suffix_array(w, starts, 512)
    keys = [tuple(w[i:]) for i in a]
    assert keys == sorted(keys) and sorted(a) == list(starts)


def test_forward_backward_against_enumeration():
    from itertools import product

    rnd = np.random.default_rng(5)
    scores, change = rnd.normal(size=(2, 4, 3)), np.exp(rnd.normal(size=(3, 3)))
    lengths = np.array([4, 2])
    p = langid.forward_backward(scores, lengths, change)
    for c, n in enumerate(lengths):
        want = np.zeros((n, 3))
        for path in product(range(3), repeat=int(n)):
            x = np.exp(sum(scores[c, t, s] for t, s in enumerate(path))) * np.prod([change[a, b] for a, b in zip(path, path[1:])])
            for t, s in enumerate(path):
                want[t, s] += x
        assert np.allclose(p[c, :n], want / want.sum(1, keepdims=True)) and not p[c, n:].any()


def test_languages_on_held_out_samples(spark):
    s = spark.read.parquet("/root/testdata/sf0.001/lang_samples.parquet")
    rows = s.collect()
    train, test = [r for r in rows if r.sample_id % 4], [r for r in rows if r.sample_id % 4 == 0]
    t = spark.createDataFrame(train, s.schema)
    docs = [(i, r.text, r.lang) for i, r in enumerate(test)]
    other = {r.lang: r.text for r in test}
    docs += [(500, other["en"] + "\n\n" + other["ar"] + "\n12 ?", "EN"), (501, None, "en"), (502, "", "en"), (503, "12 !?\n..", None), (504, (other["fr"] + " ") * 500, "fr-CA"), (505, other["tr"], None)]
    got = {}
    for r in langid.languages(spark.createDataFrame(docs, "doc_id long, text string, lang string"), "doc_id", "text", "lang", t, "sample_id").collect():
        got[r.doc_id, r.line_no] = r
        assert 0 < r.confidence <= 1
    assert sum(got[i, 0].lang == r.lang for i, r in enumerate(test)) >= 0.95 * len(test)
    assert (got[500, 1].lang, got[500, 3].lang) == ("en", "ar") and (500, 2) not in got and (500, 4) not in got
    assert not {501, 502, 503} & {d for d, _ in got}
    assert got[504, 0].agrees and not got[505, 0].agrees
