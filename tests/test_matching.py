"""Best matches over the inverted index against brute force."""

import random

from daybook.operators import matching


def test_best_matches_equal_brute_force(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(12)]
    name = lambda most: " ".join(rng.sample(vocabulary, rng.randint(0, most)) + ["hall"] * rng.randint(0, 1))
    gazetteer = [(i, name(4), rng.randint(0, 2)) for i in range(150)] + [(900 + i, "hall", 0) for i in range(3)]
    targets = [(f"t{i}", name(5)) for i in range(120)] + [("odd", "zzz hall"), ("none", "zzz"), ("blank", "")]
    got = {r.target: (r.candidate, r.tier, round(r.score, 9), r.tied) for r in matching.best_matches(spark.createDataFrame(targets, "target string, name string"), spark.createDataFrame(gazetteer, "candidate long, name string, tier int")).collect()}
    want = {}
    for t, words in targets:
        x = set(words.split())
        scored = [(len(x & set(n.split())) / len(x | set(n.split())), tier, c) for c, n, tier in gazetteer if x & set(n.split())]
        if scored:
            top = max(s for s, _, _ in scored)
            tier, c = min((tier, c) for s, tier, c in scored if s == top)
            want[t] = (c, tier, round(top, 9), sum(s == top for s, _, _ in scored) > 1)
    assert got == want


def test_tiers_are_tried_on_a_row_for_each_target(spark, monkeypatch):
    parts = spark.createDataFrame([(i, f"w{i % 5} hall", "open", 45.0, -92.0, False) for i in range(200)], "candidate long, name string, tier string, lat double, lon double, closed boolean")
    targets = spark.createDataFrame([("a", "w1 hall", True), ("b", "w2", True)], "target string, name string, is_local boolean")
    kept, sizes = matching.kept, []
    monkeypatch.setattr(matching, "kept", lambda df, kind: sizes.append(df.count()) or kept(df, kind))
    found = {r.target: (r.candidate, r.score, r.tied) for r in matching.tiered_matches(targets, parts, [("open", True, (40.0, -95.0, 50.0, -90.0))]).collect()}
    assert found == {"a": (1, 1.0, True), "b": (2, 0.5, True)} and sizes == [2]
