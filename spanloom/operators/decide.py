"""From raw spans to verified matches: scoring, disjoint selection, ambiguity, tiers.

Defined results: ties of the selection go to the earlier span in the order
given; a span with a null bound is never selected; a competitor is a span of
another passage over about the same words with about the same score.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.config import Config
from spanloom.functions import scores


def greedy_disjoint(spans: DataFrame, key: str, lo: str, hi: str, rank: Sequence[Column], row_id: str, carry: Sequence[str] = ()) -> DataFrame:
    """The spans taken when each key's spans are tried in order of ``rank`` (ascending) and kept if they overlap none kept before.

    Columns: the key, ``row_id``, ``carry``. The fold depends on the order, but
    spans clash only inside a run of overlapping ones: a key is cut at the
    places that no span crosses, and each part is folded by itself.
    """
    row = F.struct(F.col(lo).cast("long").alias("lo"), F.col(hi).cast("long").alias("hi"), F.struct(row_id, *carry).alias("row"))
    item = F.struct(*[r.alias(f"r{i}") for i, r in enumerate(rank)], row.alias("x"))
    valid = spans.where(F.col(lo) <= F.col(hi))
    taken = F.array().cast(f"array<{valid.select(row.alias('x')).schema['x'].dataType.simpleString()}>")

    def step(s: Column, e: Column) -> Column:
        clash = F.exists(s, lambda t: (t["lo"] <= e["x"]["hi"]) & (e["x"]["lo"] <= t["hi"]))
        return F.when(clash, s).otherwise(F.array_append(s, e["x"]))

    by = Window.partitionBy("_k").orderBy("_lo", "_hi")
    part = F.sum("_fresh").over(by.rowsBetween(Window.unboundedPreceding, 0))
    fresh = F.coalesce(F.col("_lo") > F.max("_hi").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True)).cast("int")
    placed = valid.select(F.col(key).alias("_k"), F.col(lo).alias("_lo"), F.col(hi).alias("_hi"), item.alias("_item"))
    placed = placed.withColumn("_fresh", fresh).withColumn("_part", part)
    per = placed.groupBy("_k", "_part").agg(F.array_sort(F.collect_list("_item")).alias("a"))
    return per.select(F.col("_k").alias(key), F.explode(F.aggregate("a", taken, step)).alias("t")).select(key, "t.row.*")


def competitors(chosen: DataFrame, raw: DataFrame, key: str, same_span: float, delta: float, bucket: int = 32, carry: Sequence[str] = (), own: Sequence[str] = (), how: str = "inner") -> DataFrame:
    """Pairs (id, other) of a chosen span and a raw one of another passage over about the same words, with the columns ``own`` of the chosen and ``carry`` of the raw one.

    Both have the key, id, verse_id, lo, hi, score. An equi-join on the
    key and a bucket of places: spans that share 60 % have starts that are
    apart by less than the longer one's length, so each chosen span visits the
    buckets its own length reaches. With ``how`` left, a chosen span has a row
    with a null ``other`` for each of its buckets that holds no competitor.
    """
    reach = F.ceil((F.col("hi") - F.col("lo") + 1) * F.lit((1 - same_span) / same_span + 0.01)).cast("int")
    c = chosen.select(key, F.col("id"), F.col("verse_id").alias("v"), F.col("lo").alias("lo"), F.col("hi").alias("hi"), F.col("score").alias("s"), F.struct(F.lit(0).alias("_"), *own).alias("own_"))
    c = c.withColumn("b", F.explode(F.sequence(F.floor((F.col("lo") - reach) / bucket).cast("int"), F.floor((F.col("lo") + reach) / bucket).cast("int"))))
    r = raw.select(F.col(key).alias("_k"), F.col("id").alias("other"), F.col("verse_id").alias("rv"), F.col("lo").alias("rlo"), F.col("hi").alias("rhi"), F.col("score").alias("rs"), F.floor(F.col("lo") / bucket).cast("int").alias("_b"), *carry)
    near = (F.col("rv") != F.col("v")) & (F.abs(F.col("rs") - F.col("s")) <= delta) & (F.col("rlo") <= F.col("hi")) & (F.col("lo") <= F.col("rhi"))
    near = near & (scores.jaccard(F.col("lo"), F.col("hi"), F.col("rlo"), F.col("rhi")) >= same_span)
    return c.join(r, (F.col(key) == F.col("_k")) & (F.col("b") == F.col("_b")) & near, how).select(key, "id", "other", *carry, *[F.col("own_")[x].alias(x) for x in own])


def decide(raw: DataFrame, passages: DataFrame, primary: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Verified spans: RAW's columns, id, group_no, primary_no, confidence, status.

    ``primary`` has doc and primary_no. Rejected spans are still there.
    """
    scored = raw.join(passages.select("verse_id", "group_no"), "verse_id").join(primary.select("doc", "primary_no"), "doc", "left")
    own = F.coalesce(F.col("group_no") == F.col("primary_no"), F.lit(False))
    scored = scored.withColumn("own", own).withColumn("conf", F.when(own, F.least(F.lit(1.0), F.col("conf") + cfg.primary_boost)).otherwise(F.col("conf")))
    scored = scored.withColumn("id", F.struct("first_seed", "verse_id", "word_start")).withColumn("lo", F.col("word_start")).withColumn("hi", F.col("word_end"))
    rank = [-F.col("conf"), -F.col("matched"), -F.col("score"), F.col("first_seed"), F.col("verse_id"), F.col("word_start")]
    kept = greedy_disjoint(scored, "doc", "lo", "hi", rank, "id", [c for c in scored.columns if c not in ("doc", "id")])
    mine = [c for c in kept.columns if c not in ("doc", "id")]
    rivals = competitors(kept, scored.withColumn("rival_own", F.col("own")), "doc", cfg.same_span, cfg.ambiguity_delta, carry=["rival_own"], own=mine, how="left")
    out = rivals.groupBy("doc", "id").agg(F.max("rival_own").alias("rival_own"), F.first(F.struct(*mine)).alias("x")).select("doc", "id", "rival_own", "x.*")
    unclear = F.col("rival_own").isNotNull() & ~(F.col("own") & ~F.col("rival_own"))
    conf = F.when(unclear, F.greatest(F.lit(0.0), F.col("conf") - cfg.ambiguity_penalty)).otherwise(F.col("conf"))
    out = out.withColumn("c", conf)
    return out.withColumn("status", scores.status(F.col("c"), F.col("matched"), cfg.accept, cfg.review, cfg.min_standalone)).withColumn("confidence", scores.half_even(F.col("c"), 4)).drop("c", "conf", "lo", "hi", "own", "rival_own")
