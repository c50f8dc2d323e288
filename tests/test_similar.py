"""The least similarity of a group against brute force, and of a group too large for all pairs."""

import random
from itertools import combinations

from pyspark.sql import functions as F

from daybook.operators import similar

ROW = "g string, h int, t array<string>"


def jaccard(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def test_least_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(similar, "SETS_A_PART", 3)
    rng = random.Random(8)
    groups = {}
    for g in range(40):
        core = rng.sample("abcdefghij", rng.randint(0, 6))
        groups[f"g{g}"] = [sorted({*core, *rng.sample("jklmnopq", rng.randint(0, 3))}) if rng.random() > 0.02 else [] for _ in range(rng.randint(1, 14))]
    groups["same"], groups["none"], groups["null"] = [["a", "b"]] * 3, [[], []], [None, ["a"]]
    rows = [(g, 1, t) for g, ts in groups.items() for t in ts] + [(None, 1, ["a"]), (None, 1, ["b"])]
    got = {r.g: (r.n, round(r.least, 9)) for r in similar.least_similarity(spark.createDataFrame(rows, ROW), ["g", "h"]).collect()}
    want = {g: (len(ts), round(min(jaccard(set(a or []), set(b or [])) for a, b in combinations(ts, 2)), 9)) for g, ts in groups.items() if len(ts) > 1}
    assert got == want
    assert similar.least_similarity(spark.createDataFrame([], ROW), ["g", "h"]).count() == 0


def test_a_group_of_a_hundred_thousand(spark):
    # every title holds a common core and three of sixty words, so no two are disjoint
    rows = spark.range(100_000).select(F.lit("g").alias("g"), F.concat(F.array(*[F.lit(w) for w in "stuvwxyz"]), F.transform(F.array(F.lit(1), F.lit(60), F.lit(3600)), lambda k: F.concat(F.lit("w"), (F.floor(F.col("id") / k) % 60).cast("string")))).alias("t"))
    found = similar.least_similarity(rows, ["g"]).first()
    assert (found.n, found.least) == (100_000, 8 / 14)
