"""Explanations of lost rows against brute force, titles of more words than two shared ones decide included."""

import random

from daybook.operators import diff
from daybook.operators.dedupe import TITLE_VETO

ROW = "uid long, ord long, title string, instant long, place_id long, sources array<string>, fuzzy string"


def test_explanations_equal_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"word{i}" for i in range(30)]
    rows = [(i, rng.randint(0, 10**6), " ".join(rng.sample(vocabulary, rng.choice([0, 1, 2, 3, 6, 7, 8, 12]))), rng.randint(0, 1), rng.choice([0, 1, None]), rng.choice([["a"], ["b", "c"], ["a", "c"], []]), rng.choice(["k1", f"k{i}", None])) for i in range(160)]
    lost, after = rows[:60], rows[60:]
    got = {r.lost_uid: (r.kept_uid, r.why) for r in diff.explanations(spark.createDataFrame(lost, ROW), spark.createDataFrame(after, ROW)).collect()}

    def jaccard(x, y):
        x, y = set(x.split()), set(y.split())
        return len(x & y) / len(x | y) if x and y else 0.0

    want = {}
    for uid, _, title, instant, place, sources, fuzzy in lost:
        here = [(o, u) for u, o, t, i, p, s, _ in after if place is not None and (p, i) == (place, instant) and set(s) & set(sources) and jaccard(t, title) >= TITLE_VETO]
        keyed = [(o, u) for u, o, _, _, _, _, f in after if f is not None and f == fuzzy]
        if here or keyed:
            want[uid] = (min(here or keyed)[1], "place" if here else "key")
    assert got == want and {w for _, w in want.values()} == {"place", "key"}
    # every short title is met through one or two words, so those must be enough for the largest of them
    assert 2 / (2 * diff.SHORT - 2) >= TITLE_VETO
