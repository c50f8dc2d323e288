"""Source divergence against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np

from daybook.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_docs, top):
    groups, langs, docs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = TERM.findall((text or "").translate(LOWER))
        groups[lang or "", source or ""].update(terms)
        langs[lang or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = set()
    for (lang, source), counts in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]

        def share(c, t, kept=kept):
            return 1 + 10**9 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * len(kept))

        pairs = [(other, sum(abs(share(counts, t) - share(c, t)) for t in kept)) for (la, other), c in groups.items() if la == lang and other != source]
        for rank, (item, value) in enumerate(sorted(pairs, key=lambda x: (-x[1], x[0].encode())), 1):
            out.add((lang, source, "pair", item, value, rank))
        terms = [(t, share(counts, t) - share(langs[lang], t)) for t in kept if counts[t]]
        for rank, (item, value) in enumerate(sorted((x for x in terms if x[1] > 0), key=lambda x: (-x[1], x[0].encode()))[:top], 1):
            out.add((lang, source, "term", item, value, rank))
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, t, la, s, 1, 2) for i, (la, s, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n long, term int")


def invented(seed, sources=9):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéü漢") for _ in range(rng.randint(1, 3))) for _ in range(50)]
    rows = []
    for _ in range(260):
        source = f"s{min(rng.randint(0, sources), rng.randint(0, sources))}"
        rows.append((rng.choice(["en", "en", "fr"]), source, " ".join(rng.choice(words[: 50 - int(source[1:])]) for _ in range(rng.randint(0, 30)))))
    rows += [("xx", "lonely", "none here is kept"), ("xx", "other", None), ("yy", "single", "a"), (None, None, "A1b A1b É"), (None, "s", ""), ("en", "", "a " * 5000), *rows[:20]]
    return rows


def test_audit_equals_brute_force(spark):
    rows = invented(3)
    docs = table(spark, rows)
    for min_docs, top, chunk, held in ((5, 4, 8, 30), (1, 50, 1 << 13, 10**6), (10**6, 5, 8, 30)):
        found = divergence.audit(docs, min_docs, top, held, chunk)
        assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
        got = [tuple(r) for r in found.collect()]
        assert len(got) == len(set(got)) and set(got) == brute(rows, min_docs, top)


def test_many_blocks_settle_every_pair_once(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", 3)  # six blocks, an even number of rounds
    rows = [("en", f"s{i % 17}", f"w{i % 5} w{i % 7} w{i % 3}") for i in range(150)]
    got = [tuple(r) for r in divergence.audit(table(spark, rows), 2, 3).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, 2, 3)


def test_blocks_stay_in_their_partitions(spark):
    nothing = bytearray(divergence.pack(np.zeros(0, int), np.zeros(0, int)))
    vectors = divergence.resident(spark.createDataFrame([("en", "a", 0, 1, 1, 0, nothing, 0)], "lang string, source string, chunk long, total long, kept long, terms long, vector binary, block int"), "lang", "chunk", "block")
    plan = divergence.tournament(vectors, vectors.drop("block"), 2, 5)._jdf.queryExecution().executedPlan().toString()
    # of the two sides of each of the two meetings only the travelling one is shuffled
    assert plan.count("FlatMapCoGroupsInArrow") == plan.count("Exchange hashpartitioning") == 2


def test_empty_table(spark):
    assert divergence.audit(table(spark, [("en", "s", "a")]).limit(0)).count() == 0


def test_vectors_and_shares():
    places, counts = np.array([7, 0, 300]), np.array([1, 2**40, 3])
    at, n = divergence.unpack(divergence.pack(places, counts))
    assert at.tolist() == [0, 7, 300] and n.tolist() == [2**40, 1, 3]
    assert [x.size for x in divergence.unpack(divergence.pack(np.zeros(0, int), np.zeros(0, int)))] == [0, 0]
    for count, total, kept in ((0, 0, 1), (5, 7, 3), (10**12 + 7, 9 * 10**14 + 1, 10**7)):
        assert divergence.shares(count, total, kept) == 1 + 10**9 * (count + 5) // (total + 5 * kept)
        assert int(divergence.shares(np.int64(count), np.int64(total), np.int64(kept))) == 1 + 10**9 * (count + 5) // (total + 5 * kept)
    assert divergence.terms_of("A1bÉ_漢-Z".encode()) == ["a".encode(), "bÉ".encode(), "漢".encode(), b"z"]
