import random

from pyspark.sql import functions as F

from spanloom.operators import pieces


def brute(segs, limit):
    segs = sorted(segs)
    if not segs or max(s[2] for s in segs) - segs[0][0] <= limit:
        return []
    length = lambda i, j: max(s[2] for s in segs[i : j + 1]) - segs[i][0]
    out, i, n = [], 0, len(segs)
    while True:
        j = i
        while j + 1 < n and length(i, j + 1) <= limit:
            j += 1
        out.append((len(out) + 1, segs[i][1], segs[j][1]))
        if j == n - 1:
            return out
        i = j if j > i and length(j, j + 1) <= limit else j + 1


def test_sequences_against_brute_force(spark):
    rnd = random.Random(3)
    rows = []
    for k in range(60):
        segs = []
        for i in range(rnd.randrange(0, 30)):
            lo = rnd.randrange(0, 300)
            segs.append((lo, i, lo + rnd.choice([0, 5, 20, 40, 130])))
        rows.append((k, segs))
    df = spark.createDataFrame(rows, "k int, p array<struct<lo:bigint,id:int,hi:bigint>>")
    got = {}
    for r in pieces.split_sequence(df, "k", F.col("p"), 100).collect():
        got.setdefault(r.k, []).append((r.piece_no, r.first_part, r.last_part))
    assert {k: sorted(v) for k, v in got.items()} == {k: b for k, s in rows if (b := brute(s, 100))}
    assert pieces.split_sequence(spark.createDataFrame([(1, None), (2, [])], df.schema), "k", F.col("p"), 100).count() == 0


def test_texts_keep_everything_within_the_limit(spark):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("ab cd. \n,؟") for _ in range(rnd.choice([1, 40, 99, 100, 101, 1000]))) for _ in range(40)]
    texts += ["x" * 1000, "", None, " " * 300, "a\n\n" * 200, "é" * 101, "word " * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for overlap in (0, 20):
        back = {}
        for r in sorted(pieces.split_text(df, "id", "text", 100, overlap).collect()):
            assert 1 <= len(r.piece) <= 100 and r.n_back <= overlap
            before = back.get(r.id, "")
            assert before.endswith(r.piece[: r.n_back])
            back[r.id] = before + r.piece[r.n_back :]
        assert back == {i: t for i, t in enumerate(texts) if t}


def test_an_early_boundary_goes_before_a_cut_inside_a_run(spark):
    texts = ["go to " + "x" * 97 + " end", "a b " + "y" * 250]
    got = sorted(pieces.split_text(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), "id", "text", 100).collect())
    assert [(r.id, r.piece) for r in got] == [(0, "go to "), (0, "x" * 97 + " "), (0, "end"), (1, "a b "), (1, "y" * 100), (1, "y" * 100), (1, "y" * 50)]


def test_strong_boundaries_first(spark):
    text = "a" * 60 + ".\n\n" + "b" * 20 + ". " + "c" * 40
    got = [r.piece for r in sorted(pieces.split_text(spark.createDataFrame([(1, text)], "id int, text string"), "id", "text", 100).collect())]
    assert got == ["a" * 60 + ".\n\n", "b" * 20 + ". " + "c" * 40]


def test_many_pieces_are_kept_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(pieces, "_BLOCK", 3)
    rnd = random.Random(5)
    rows = []
    for k in range(8):
        lo, segs = 0, []
        for i in range(rnd.choice([7, 60, 61, 62, 200])):
            lo += rnd.randrange(1, 60)
            segs.append((lo, i, lo + rnd.choice([5, 20, 40])))
        rows.append((k, segs))
    df = spark.createDataFrame(rows, "k int, p array<struct<lo:bigint,id:int,hi:bigint>>")
    got = {}
    for r in pieces.split_sequence(df, "k", F.col("p"), 100).collect():
        got.setdefault(r.k, []).append((r.piece_no, r.first_part, r.last_part))
    assert {k: sorted(v) for k, v in got.items()} == {k: brute(s, 100) for k, s in rows}
