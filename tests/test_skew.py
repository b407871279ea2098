import math
import random
from collections import Counter

from spanloom.operators import skew


def test_profile_against_brute_force(spark):
    rnd = random.Random(2)
    rows = [("hot" if rnd.random() < 0.7 else rnd.choice(["a", "b", None]), rnd.choice([None, 1, 2, 2, 3, 50, 1000, rnd.randrange(500)])) for _ in range(3000)] + [("none", None)]
    got = {r[0]: r for r in skew.profile(spark.createDataFrame(rows, "k string, value int"), ["k"], "value").collect()}
    assert set(got) == {k for k, _ in rows}
    for k, r in got.items():
        v = sorted(x for q, x in rows if q == k and x is not None)
        assert (r.n_rows, r.n_values, r.n_distinct) == (sum(q == k for q, _ in rows), len(v), len(set(v)))
        if v:
            c = Counter(v)
            mode = min(c, key=lambda x: (-c[x], x))
            assert (r["mode"], r.mode_rows, r.low, r.high, r["quantile"]) == (mode, c[mode], v[0], v[-1], v[-(-len(v) // 2) - 1])
        else:
            assert r["mode"] is None and r["quantile"] is None


def test_distinct_counts_with_clashing_names_and_empty(spark):
    df = spark.createDataFrame([(1, "x", 5), (1, "x", 5), (1, None, 6), (2, "y", None)], "k0 int, weight string, value int")
    assert sorted(map(tuple, skew.distinct_counts(df, ["k0"], "weight").collect())) == [(1, 3, 1), (2, 1, 1)]
    assert skew.distinct_counts(df.limit(0), ["k0"], "weight").collect() == []


def test_outliers_and_a_hot_key_do_not_move_the_quantile(spark):
    rows = [("hot", float(i % 997)) for i in range(20_000)] + [("hot", 1e18), ("hot", -1e18), ("cold", 3.0)]
    df = spark.createDataFrame(rows, "k string, value double")
    for at in (0.0, 0.1, 0.5, 0.999, 1.0):
        got = {r[0]: r.quantile for r in skew.profile(df, ["k"], "value", at).collect()}
        v = sorted(x for k, x in rows if k == "hot")
        assert got == {"hot": v[max(1, math.ceil(len(v) * at)) - 1], "cold": 3.0}
