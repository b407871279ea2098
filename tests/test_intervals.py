import random

from pyspark.sql import functions as F

from spanloom.operators import intervals


def brute(rows, touch):
    by = {}
    for k, lo, hi in rows:
        if lo is not None and hi is not None and lo <= hi:
            by.setdefault(k, []).append((lo, hi))
    out = set()
    for k, v in by.items():
        v.sort()
        periods = [list(v[0])]
        for lo, hi in v[1:]:
            if lo <= periods[-1][1] + touch:
                periods[-1][1] = max(periods[-1][1], hi)
            else:
                periods.append([lo, hi])
        out |= {(k, "period", a, b) for a, b in periods}
        out |= {(k, "gap", a[1] + touch, b[0] - touch) for a, b in zip(periods, periods[1:])}
    return out


def run(spark, rows, discrete, width):
    df = spark.createDataFrame([(k, a, b, "x", 1) for k, a, b in rows], "k string, lo long, hi long, kind string, shard int").withColumn("d", F.lit(discrete))
    got = intervals.merge_positions(df, ["k"], "lo", "hi", "d", width).select("k", "kind", "lo", "hi").collect()
    assert len(got) == len(set(got))
    return set(map(tuple, got))


def test_against_brute_force_in_many_shards(spark):
    rnd = random.Random(1)
    rows = []
    for k in ("a", "b", None):
        for _ in range(150):
            lo = rnd.randrange(-60, 400)
            rows.append((k, lo, lo + rnd.choice([0, 0, 1, 3, 9, 10, 25, 70]) - rnd.choice([0, 0, 0, 5])))
    rows += [("long", 0, 5000), ("long", 6000, 6001), ("long", 95, 105), ("edge", 0, 10), ("edge", 10, 20), ("edge", 30, 30), ("edge", 31, 40)]
    rows += [("nulls", None, 3), ("nulls", 3, None), ("twice", 5, 6), ("twice", 5, 6)]
    for touch in (0, 1):
        assert run(spark, rows, bool(touch), 10) == brute(rows, touch)


def test_coordinates_far_apart_stay_in_shards_of_their_own(spark):
    rows = [("a", -(10**15), -5), ("a", 10**15, 2 * 10**15), ("a", 3 * 10**15, 3 * 10**15), ("a", 10**14, 10**15), ("a", 5, 7)]
    rows += [("b", -(2**63), -(2**63) + 5), ("b", 2**63 - 9, 2**63 - 2), ("b", 0, 0)]
    assert run(spark, rows, False, 10) == brute(rows, 0)
    rnd = random.Random(3)  # epoch milliseconds over more than 10^5 shards, with intervals over many and over few
    rows = []
    for k in ("c", "d"):
        for _ in range(200):
            lo = 1_600_000_000_000 + rnd.randrange(100_000) * 60_000 + rnd.randrange(60_000)
            rows.append((k, lo, lo + rnd.choice([0, 5_000, 90_000, 40_000_000])))
    rows += [("c", 1_600_000_060_000, 1_600_000_120_000), ("c", 1_600_000_120_000, 1_600_000_120_000), ("d", 1_599_999_999_999, 1_599_999_999_999)]
    for touch in (0, 1):
        assert run(spark, rows, bool(touch), 60_000) == brute(rows, touch)


def test_points_and_boundaries(spark):
    rnd = random.Random(9)
    for w in (1, 2, 5):
        rows = [(k, lo := rnd.randrange(60), lo + rnd.choice([0, 0, 0, 1, 5, 12])) for k in "abcdefgh" for _ in range(6)]
        for touch in (0, 1):
            assert run(spark, rows, bool(touch), w) == brute(rows, touch)


def test_empty_input(spark):
    assert run(spark, [], False, 10) == set()


def test_whole_numbers_from_doubles(spark):
    df = spark.createDataFrame([(1.0004,), (float("nan"),), (float("inf"),), (None,)], "x double")
    assert [r[0] for r in df.select(intervals.whole(F.col("x"), 1000)).collect()] == [1000, None, None, None]
