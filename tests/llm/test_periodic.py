"""Periodic runs against brute force."""

import hashlib
import random
import zlib
from fractions import Fraction

from daybook.llm import periodic

DOC = "doc_id long, text string, runs string, n_runs int"


def brute(words, min_exponent=4, min_length=6):
    found, n = set(), len(words)
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_length, min_exponent * q) and not any((i, length, d) in found for d in range(1, q)):
                found.add((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def repetitive(rng):
    letters = "abcde"[: rng.randint(1, 5)]
    words = [rng.choice(letters) for _ in range(rng.randint(0, 80))]
    for _ in range(rng.randint(0, 3)):
        stretch = [rng.choice(letters) for _ in range(rng.randint(1, 9))]
        at = rng.randint(0, len(words))
        words[at:at] = (stretch * 12)[: rng.randint(len(stretch), 8 * len(stretch))]
    return words


def test_refinement_finds_every_run():
    rng = random.Random(11)
    for _ in range(120):
        texts = [[w.encode() for w in repetitive(rng)] for _ in range(rng.randint(0, 8))]
        for exponent, length in ((4, 6), (2, 2), (3, 5)):
            assert [[tuple(r) for r in rs] for rs in periodic.find_runs(texts, exponent, length)] == [brute(t, exponent, length) for t in texts]


def test_fibonacci_words_and_one_word():
    a, b = ["a"], ["a", "b"]
    while len(b) < 900:
        a, b = b, b + a
    words = [w.encode() for w in b]
    assert [tuple(r) for r in periodic.find_runs([words], 2, 2)[0]] == brute(words, 2, 2)
    assert [tuple(r) for r in periodic.find_runs([[b"a"] * 200_000])[0]] == [(0, 200_000, 1)]


def test_digests_and_collapsed_texts(spark):
    rng = random.Random(4)
    texts = [None, "", " \n\t ", "one", "x " * 5, "x " * 6, " a a " * 9, "漢 字 " * 4 + "end", *(" ".join(repetitive(rng)) for _ in range(60))]
    texts += texts[:12]  # repeated texts
    docs = spark.createDataFrame([(i, t, "mine", 7) for i, t in enumerate(texts)] + [(3, "one", "mine", 7)], DOC)
    rows = {r.doc_id: r for r in periodic.digests(docs, periodic.periodic_tenth, slice_words=40).collect()}
    for i, t in enumerate(texts):
        words = [w for w in (t or "").translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
        h, n = zlib.crc32(str(i).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        runs = brute(words)
        gone = {k for s, length, q in runs for k in range(s + q, s + length)}
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        want = (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2])
        want += (hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(), hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in gone).encode()).hexdigest())
        assert tuple(rows[i])[1:] == want, t
    assert any(r.n_runs for r in rows.values()) and periodic.digests(docs).count() == len(texts) + 1
    listed = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic.runs(docs).collect()}
    cut = periodic.collapsed(docs)
    assert cut.columns == docs.columns
    for r in cut.collect():
        words = [w.decode() for w in periodic.words_of(None, (texts[r.doc_id] or "").encode())]
        assert listed[r.doc_id] == brute(words) and (r.runs, r.n_runs) == ("mine", 7)
        if not listed[r.doc_id]:
            assert r.text == texts[r.doc_id]
        else:
            assert brute(r.text.split(" ")) != listed[r.doc_id] and len(r.text.split(" ")) < len(words)
    empty = docs.limit(0)
    assert periodic.digests(empty).count() == periodic.runs(empty).count() == periodic.collapsed(empty).count() == 0


def test_planted_documents_repeat(spark):
    # a document whose checksum is divisible by ten ends in copies of a stretch of its words
    chosen = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0 and zlib.crc32(str(i).encode()) // 10 % 40 < 5 and zlib.crc32(str(i).encode()) // 10 % 8 > 3)
    words = [f"w{k}" for k in range(40)]
    out = periodic.periodic_tenth(chosen, " ".join(words).encode())
    assert len(out) == 40 and brute(out)
    assert periodic.periodic_tenth(None, b"a b") == [b"a", b"b"]
