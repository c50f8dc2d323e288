"""Small fixtures against brute force, round trips and held-out rows."""

import base64
import bisect
import hashlib
import random
import time
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from daybook.llm import bpe, decontam, graph, htmltext, imatch, langid, linedup, sharding, simhash, substring, warc
from daybook.llm.queries import tokenizer_files

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, start=0):
    return spark.createDataFrame([(start + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOC)


def invented(n, seed=1, words=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    return [" ".join(rng.choice(vocabulary) for _ in range(words)) for _ in range(n)]


ODD = [None, "", " \n\t ", "Word", "a\nb\na", "Ünïcödé ñ 漢字 😀 text", "x" * 3000]


# encoding


def test_bpe_matches_library_and_round_trips(spark):
    files = tokenizer_files()
    texts = [*ODD, *invented(20), "it's   spaced\n\n out'll " * 9000]
    rows = {r.doc_id: r for r in bpe.decode(bpe.encode(docs(spark, texts), *files, piece_chars=500), *files).collect()}
    encoding = bpe.load_encoding(*files)
    for i, t in enumerate(texts):
        assert np.frombuffer(rows[i].ids, "<u4").tolist() == encoding.encode_ordinary(t or "")
        assert bytes(rows[i].decoded) == (t or "").encode() and rows[i].n_tokens * 4 == len(rows[i].ids)
    unpacked = bpe.token_arrays(bpe.encode(docs(spark, texts[:6]), *files)).collect()
    assert all(r.token_ids == encoding.encode_ordinary(texts[r.doc_id] or "") for r in unpacked)


def test_bpe_empty_table(spark):
    assert bpe.round_trip_digests(docs(spark, []), *tokenizer_files()).count() == 0


# near copies


def brute_fingerprint(text, width=3):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] if len(w) > width else [b" ".join(w)] if w else []
    h = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(nodes), 2):
        if linked(a, b):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("paired", [32, 1])
def test_simhash_equals_brute_force(spark, monkeypatch, paired):
    monkeypatch.setattr(simhash, "PAIRED_BUCKET", paired)
    base = invented(12, words=120)
    near = [" ".join(w if j != k else "changed" for j, w in enumerate(t.split())) for t in base[:8] for k in range(0, 120, 17)]
    texts = [*ODD, *base, *near, base[0]]
    found = {r.doc_id: r for r in simhash.cluster(simhash.fingerprints(docs(spark, texts))).collect()}
    fps = {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    assert {i: r.fp % 2**64 for i, r in found.items()} == fps
    assert {i: r.component_id for i, r in found.items()} == components(fps, lambda a, b: bin(fps[a] ^ fps[b]).count("1") <= 2)


def test_near_copies_leave_one_of_each_group(spark):
    base = invented(6, seed=4, words=200)
    near = [t.replace(t.split()[100], "changed", 1) for t in base]
    kept = sorted(r.doc_id for r in simhash.without_copies(docs(spark, base + near + base)).collect())
    assert kept == list(range(6))
    odd = simhash.without_copies(docs(spark, ODD)).columns
    assert odd == ["doc_id", "text", "lang", "source", "n_chars"]


def wide_node(doc, bits):
    n = len(bits) // simhash.WIDE_BLOCK_BITS
    blocks = bits[: n * simhash.WIDE_BLOCK_BITS].reshape(n, -1) @ (1 << np.arange(simhash.WIDE_BLOCK_BITS))
    return doc, np.packbits(bits, bitorder="little").view("<i8").tolist(), blocks.tolist()


@pytest.mark.parametrize("part", [1024, 7])
def test_wide_pairs_meet_in_large_buckets(spark, monkeypatch, part):
    monkeypatch.setattr(simhash, "SALTED_PART", part, raising=False)
    rng = np.random.default_rng(5)
    rows = rng.integers(0, 2, (80, 1024), dtype=np.uint8)
    rows[:, :20] = rows[0, :20]
    for i in (*range(20, 30), *range(41, 60)):  # chains of near copies that share the first block only
        rows[i] = rows[i - 1]
        rows[i, 20:1020].reshape(50, 20)[np.arange(50), rng.integers(0, 20, 50)] ^= 1
    nodes = spark.createDataFrame([wide_node(i, r) for i, r in enumerate(rows)], "doc long, fp array<long>, blocks array<int>")
    found = {r.node: r.root for r in graph.connected_components(simhash.wide_edges(nodes, 60)).collect()}
    want = components(range(80), lambda a, b: (rows[a] != rows[b]).sum() <= 60)
    assert {i: found.get(i, i) for i in range(80)} == want


def test_near_copies_at_the_similarity_asked_for_go_and_others_stay(spark):
    words = lambda name, n: " ".join(f"{name}w{i}" for i in range(n))
    # 200 shingles of one word each: 178 shared ones are a Jaccard similarity of 0.802, 176 one of 0.786
    rows = [(2 * i + k, words(f"p{i}x", n) + " " + words(f"p{i}y{k}", 200 - n)) for i in range(60) for n in [178 if i < 40 else 176] for k in (0, 1)]
    table = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], DOC)
    gone = {r.doc_id for r in simhash.copies(table, width=1).collect()}
    assert len(gone & set(range(1, 80, 2))) >= 37 and not gone & set(range(80, 120))


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(50)]
    got = {r.node: r.root for r in graph.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 151))
    assert graph.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


# lines


def test_line_dedup_equals_brute_force(spark):
    lines = invented(25, seed=2, words=9)
    near = [" ".join(w for j, w in enumerate(x.split()) if j != 3) for x in lines[:12]]
    rng = random.Random(3)
    texts = [*ODD, *["\n".join(rng.choice(lines + near + ["", "the"]) for _ in range(5)) for _ in range(30)]]
    occurrences = [((d, i), frozenset(x.lower().split())) for d, t in enumerate(texts) if t is not None for i, x in enumerate(t.split("\n")) if x.split()]
    gone = {}
    for n, (at, w) in enumerate(occurrences):
        if any(5 * len(w & v) >= 4 * len(w | v) for _, v in occurrences[:n]):
            gone.setdefault(at[0], []).append(at[1])
    rows = {r.doc_id: r for r in linedup.report(docs(spark, texts)).collect()}
    assert {d: r.removed_lines for d, r in rows.items()} == {d: ",".join(map(str, gone.get(d, []))) for d in range(len(texts))}
    kept = {r.doc_id: r.text for r in linedup.without_repeats(docs(spark, texts)).collect()}
    assert kept == {d: t if d not in gone else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]) for d, t in enumerate(texts)}


def test_lines_at_one_position_of_repeated_ids_are_linked_and_stay(spark):
    given = spark.createDataFrame([(1, "a b c d e f g h i j"), (1, "a b c d e f g h i k"), (2, "a b c d e f g h i j")], "doc_id long, text string")
    rows = sorted((r.doc_id, r.n_links, r.removed_lines) for r in linedup.report(given).collect())
    assert rows == [(1, 2, ""), (1, 2, ""), (2, 1, "0")]
    assert sorted(r.text for r in linedup.without_repeats(given).collect()) == ["", "a b c d e f g h i j", "a b c d e f g h i k"]


def test_line_dedup_of_an_empty_table(spark):
    assert linedup.report(docs(spark, [])).count() == 0


# archives


def test_warc_round_trip(spark):
    html = ["<p>a</p>", None, "", "<p>a</p>", "é\r\n\r\nWARC/1.1\r\n", "<p>a</p>", "b"]
    pages = spark.createDataFrame([(i * 3, f"http://x/{i}" if i else None, h) for i, h in enumerate(html)], "page_id long, url string, html string")
    rows = {r.page_id: r for r in warc.round_trip(pages).collect()}
    for i, h in enumerate(html):
        raw, first = (h or "").encode(), next(k for k, x in enumerate(html) if (x or "") == (h or ""))
        r = rows[i * 3]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        assert (r.record_type, r.refers_to) == (("response", None) if first == i else ("revisit", first * 3))
    assert {r.record_type for r in warc.round_trip(pages, min_bytes=100).collect()} == {"response"}
    assert warc.round_trip(pages.limit(0)).count() == 0


# fingerprints


def test_random_fingerprints_are_no_rows():
    # a random pair differs in half of the bits, with a deviation of half the root of their number
    n = 64 * simhash.SKETCH_WORDS
    assert n / 2 - simhash.sketch_limit(simhash.wide_limit(0.8)) >= 5 * n**0.5 / 2


def test_ranges_are_places_and_plans_do_not_grow(spark):
    rng = random.Random(9)
    ends = [imatch.NO_ID, imatch.NO_ID + 1, 2**63 - 1]
    for n in (0, 1, 750):
        bounds = sorted({*rng.sample(range(-500, 5000), n), *(ends if n == 750 else [])})
        keys = [*ends, *range(-600, 5100, 7), *bounds]
        df = imatch.with_range(spark.createDataFrame([(k,) for k in keys], "k long"), F.col("k"), bounds, "part")
        assert all(r.part == bisect.bisect_right(bounds, r.k) for r in df.collect())
        # the optimiser writes a chain of columns out into one expression
        assert df._jdf.queryExecution().analyzed().toString().count("Project") == 1
    assert imatch.with_range(spark.range(1), F.col("id"), [imatch.NO_ID], "part").first().part == 1


def test_imatch_contract_and_likeness(spark):
    texts = [*invented(40, seed=6, words=80), *ODD]
    texts[5] = texts[4]
    rows = {r.doc_id: r for r in imatch.fingerprints(docs(spark, texts), range_bytes=2000).collect()}
    n = len(texts)
    assert len(rows) == n
    for i, t in enumerate(texts):
        a, b = t or "", texts[(i - 1) % n] or ""
        half = len(a) // 2
        edited = a[: len(a) - half] + b[:half]
        assert rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and rows[i].n_chars == len(a)
        assert 0 <= rows[i].near_next <= 1
    assert rows[4].fingerprint == rows[5].fingerprint and rows[5].near_next == 1.0
    mean = lambda c: np.mean([getattr(rows[i], c) for i in range(10, 40)])
    assert mean("near_edited") > mean("near_next")


def test_imatch_of_one_document_and_none(spark):
    assert imatch.fingerprints(docs(spark, [])).count() == 0
    one = imatch.fingerprints(docs(spark, ["alpha beta"])).first()
    assert one.near_next == 1.0


def test_imatch_keeps_the_likeness_of_a_hot_group(spark):
    base = invented(1, seed=12, words=80)[0].split()
    hot = [" ".join(f"own{i}" if j == 2 * i else w for j, w in enumerate(base)) for i in range(30)]
    rows = {r.doc_id: r for r in imatch.fingerprints(docs(spark, [*invented(60, seed=13, words=80), *hot])).collect()}
    assert np.mean([rows[i].near_next for i in range(61, 90)]) > 0.5 and np.mean([rows[i].near_edited for i in range(61, 90)]) > 0.3  # half of the terms stay


# sharding


def test_shards_are_exact_and_gapless(spark):
    texts = [*invented(500, words=5), *ODD]
    rows = sharding.shard_documents(docs(spark, texts), 24).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1 and len(by) == 24
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert all(r.size == len((texts[r.doc_id] or "").encode()) + 8 for r in rows)


def test_shards_with_many_blocks_and_no_rows(spark):
    many = spark.range(3000).select(F.col("id").alias("doc_id"))
    rows = sharding.shuffle_into_shards(many, 7, block_rows=50).collect()
    slots = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(7)}
    assert all(v == list(range(len(v))) for v in slots.values()) and sorted(map(len, slots.values())) == [428] * 3 + [429] * 4
    assert sharding.shard_documents(docs(spark, []), 24).count() == 0


def test_communication_matrix_sums():
    m = sharding.communication_matrix([10, 0, 25, 5], [13, 13, 14], seed=1)
    assert m.sum(axis=1).tolist() == [10, 0, 25, 5] and m.sum(axis=0).tolist() == [13, 13, 14] and (m >= 0).all()


# language


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    e, t = rng.normal(size=(1, 4, 3)), rng.normal(size=(3, 3))
    want = np.zeros((4, 3))
    total = 0.0
    for path in np.ndindex(3, 3, 3, 3):
        p = np.exp(sum(e[0, i, y] for i, y in enumerate(path)) + sum(t[a, b] for a, b in zip(path, path[1:], strict=False)))
        total += p
        for i, y in enumerate(path):
            want[i, y] += p
    assert np.allclose(langid.marginals(e, t, np.ones((1, 4), bool))[0], want / total)


def test_language_id_on_held_out_rows(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(table, rows_per_label=80)
    seen = langid.predict(table.select("doc_id", "text", "lang"), model, keep=["lang"]).filter(langid.is_held_out(F.col("doc_id")))
    assert seen.filter("lang = lang_pred").count() >= 0.97 * seen.count()
    odd = {r.doc_id: r for r in langid.predict(docs(spark, [None, "", "12 34", "the and of"]), model).collect()}
    assert [odd[i].lang_pred for i in range(3)] == ["und"] * 3 and odd[3].lang_pred == "en"
    assert langid.fit(docs(spark, [])).labels == []


# pages


def test_extraction_of_pages_with_known_text():
    w = htmltext.default_weights()
    page = """<html><head><title>t t</title><style>p{}</style></head><body><header><div class="logo">Site name here</div><nav><ul><li><a href=/>Home</a></li><li><a href=/b>About us</a></li></ul></nav></header>
    <div class="cookie notice"><p>We use cookies on this site to serve you better every day</p></div><article><h1>A title &amp; more</h1><p>First  paragraph of the <b>article</b> with\n enough words to count.</p><div class="ad">Buy now and save a lot of money today</div>
    <p>Second&nbsp;paragraph with more words in it<br>and a break.</p><script>var x = "<p>no</p>";</script></article><section class="comments"><p>Nice post, I liked it very much indeed</p></section><footer>&copy; 2024 all rights reserved by the site</footer></body></html>"""
    assert htmltext.extract(page, w) == "A title & more\n\nFirst paragraph of the article with enough words to count.\n\nSecond paragraph with more words in it and a break."
    assert htmltext.extract(None, w) == "" and htmltext.extract("<nav><a>x</a></nav>", w) == "" and htmltext.extract("<p", w) == ""


def test_short_blocks_at_the_ends_of_an_article_stay():
    w = htmltext.default_weights()
    page = "<nav><a href=/>Home</a></nav><article><p>Three short words</p><div class='promo ad'>Buy now and save a lot of money on things</div><p>" + "Some words of the article. " * 20 + "</p><p>The end</p></article><footer>Site</footer>"
    assert htmltext.extract(page, w).split("\n\n") == ["Three short words", " ".join(["Some words of the article."] * 20), "The end"]


@pytest.mark.parametrize("piece", ["<a title=\"x y ", "<div><b>", "<a b='c' d=\"", "<!-", "<x" , "</p", "<p class='", "<div class=a1 id=b2><x-{i}>"])
def test_hostile_pages_take_time_in_proportion(piece):
    w = htmltext.default_weights()
    page = "<article><p>Some words to keep here</p></article>" + "".join(piece.replace("{i}", str(i)) for i in range(100_000))
    began = time.process_time()
    text = htmltext.extract(page, w)
    assert time.process_time() - began < 20 and text.startswith("Some words to keep here")


def test_extraction_of_nulls_repeated_rows_and_no_rows(spark):
    given = spark.createDataFrame([(1, None, "<article><p>one two three</p></article>"), (1, None, "<article><p>one two three</p></article>"), (2, "u", None), (None, "u", "")], "page_id long, url string, html string")
    rows = sorted((r.page_id or 0, r.text, r.n_chars) for r in htmltext.main_text(given).collect())
    assert rows == [(0, "", 0), (1, "one two three", 13), (1, "one two three", 13), (2, "", 0)]
    assert htmltext.main_text(given.limit(0)).count() == 0


def test_best_region_equals_enumeration():
    rng = random.Random(0)
    for _ in range(50):
        s = [rng.randint(-5, 5) for _ in range(12)]
        a, b = htmltext.best_region(s)
        assert sum(s[a:b]) == max([0, *(sum(s[i:j]) for i in range(12) for j in range(i + 1, 13))])


# benchmark


def test_decontamination_equals_brute_force(spark):
    items = [*invented(4, seed=9, words=25), "short item here", "", None]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    clean = invented(10, seed=10)
    texts = [*ODD, *clean, clean[0] + " " + items[0].upper() + "! " + clean[1], "x, short ITEM here.", items[1][:40], " ".join(items[2].split()[3:14])]
    for size in (1_000_000, 200):
        rows = {r.doc_id: r for r in decontam.find(docs(spark, texts), benchmark, slice_bytes=size).collect()}
        for d, t in enumerate(texts):
            words = decontam.words_with_offsets(t)[0]
            hit, which = set(), []
            for k, item in enumerate(items):
                wins = decontam.item_windows(item, 10)
                spots = [(i, len(w)) for w in wins for i in range(len(words)) if tuple(words[i : i + len(w)]) == w]
                if spots:
                    which.append(k)
                hit |= {i + j for i, n in spots for j in range(n)}
            assert (rows[d].n_words, rows[d].n_hit, rows[d].item_ids) == (len(words), len(hit), which)
    for size in (1_000_000, 200):
        kept = {r.doc_id for r in decontam.clean(docs(spark, texts), benchmark, slice_bytes=size).collect()}
        assert kept == {d for d in rows if rows[d].n_hit == 0}


# substrings


def test_chunks_cover_texts_and_resist_insertions():
    text = " ".join(invented(1, words=800))
    a = substring.chunk_ends(text.encode())
    b = substring.chunk_ends(("inserted " + text).encode())
    assert a[-1] == len(text) and a == sorted(set(a))
    assert len(set(a) & {x - 9 for x in b}) > 0.9 * len(a)
    assert substring.chunk_ends(b"") == [] and substring.chunk_ends("é".encode() * 400)[-1] == 800


def test_gear_hash_equals_brute_force():
    data = np.frombuffer(b"some bytes to hash, long enough for a window", dtype=np.uint8)
    want = [sum(int(substring.GEAR[data[i - k]]) << k for k in range(min(16, i + 1))) % 2**32 for i in range(len(data))]
    assert substring.gear_hashes(data).tolist() == want


def test_repeated_passages_are_found_and_cut(spark):
    fill, passage = invented(30, seed=12, words=150), invented(1, seed=13, words=55)[0]
    texts = [f"{t} {passage} tail" if i in (3, 17) else t for i, t in enumerate(fill)] + ODD
    rows = substring.passages(docs(spark, texts)).collect()
    within = [r for r in rows if r.doc_id == r.first_doc_id]
    rows = [r for r in rows if r.doc_id != r.first_doc_id]
    assert {r.doc_id for r in within} == {36} and [(r.doc_id, r.first_doc_id) for r in rows] == [(17, 3)]
    cut = {r.doc_id: r.text for r in substring.without_repeats(docs(spark, texts)).collect()}
    assert cut[3] == texts[3] and len(cut[17]) == len(texts[17]) - rows[0].n_bytes and all(cut[i] == texts[i] for i in cut if i not in (17, 36))
    assert substring.passages(docs(spark, [])).count() == 0


# the pipeline


def test_pipeline_stages_keep_columns(spark):
    import corpus_pipeline

    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "line dedup", "SimHash near-dedup", "benchmark decontamination", "byte-level BPE"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table, "/root/testdata/sf0.001")
        assert out.columns == table.columns and out.dtypes == table.dtypes, name
    assert stage(spark, table.limit(0), "/root/testdata/sf0.001").count() == 0


@pytest.mark.parametrize("crowd", [16, 4])
def test_links_in_groups_of_near_equal_lines_equal_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(linedup, "CROWD", crowd)
    rng = random.Random(8)
    base = [[f"b{k}word{i}" for i in range(30)] for k in range(3)]
    base[2] = base[1][:26] + [f"other{i}" for i in range(4)]  # two groups that are near each other
    texts = []
    for i in range(150):
        words = list(base[i % 3])
        for j in range(rng.choice([0, 1, 1, 2, 2, 3, 5])):
            words[rng.randrange(30)] = rng.choice([f"odd{i}x{j}", f"shared{rng.randrange(5)}"])
        texts.append(" ".join(words) + f"\nalone{i} line of its own")
    found = {r.doc_id: (r.n_links, r.removed) for r in linedup.decisions(docs(spark, texts)).collect()}
    lines = [[frozenset(x.split()) for x in t.split("\n")] for t in texts]
    alike = lambda x, y: len(x & y) * 5 >= len(x | y) * 4
    different = {s for x in lines for s in x}
    links = {s: sum(alike(s, t) for t in different if t != s) for s in different}
    flat = [(d, k, s) for d, x in enumerate(lines) for k, s in enumerate(x)]
    gone = {(d, k) for n, (d, k, s) in enumerate(flat) if any(alike(s, t) for _, _, t in flat[:n])}
    assert found == {d: (sum(links[s] for s in x), [k for k in range(2) if (d, k) in gone]) for d, x in enumerate(lines)}


def test_line_dedup_keeps_columns_whatever_their_names(spark):
    given = docs(spark, ["a b c\nd e f", "a b c"]).withColumnsRenamed({"lang": "removed", "source": "cut_doc", "n_chars": "given_0"})
    out = linedup.without_repeats(given)
    assert out.columns == given.columns and sorted(r.text for r in out.collect()) == ["", "a b c\nd e f"]


def test_clashing_names_and_ties_of_other_operators(spark):
    given = docs(spark, ["one two three four five six"] * 3 + [None]).withColumnsRenamed({"lang": "gone", "source": "cuts", "n_chars": "given_0"})
    assert simhash.without_copies(given).columns == given.columns
    assert substring.without_repeats(given).columns == given.columns
    shards = sharding.shuffle_into_shards(given.withColumnsRenamed({"gone": "block", "cuts": "number"}), 2)
    assert shards.columns == ["doc_id", "text", "block", "number", "given_0", "shard", "slot"] and sorted((r.shard, r.slot) for r in shards.collect()) == [(0, 0), (0, 1), (1, 0), (1, 1)]


def test_ratio_of_uniforms_has_the_library_law():
    rng = np.random.default_rng(4)
    own = [sharding.hypergeometric_by_ratio(rng, 60, 140, 50) for _ in range(4000)]
    theirs = rng.hypergeometric(60, 140, 50, 4000)
    assert abs(np.mean(own) - 15) < 0.2 and abs(np.std(own) - np.std(theirs)) < 0.2 and min(own) >= 0 and max(own) <= 50
    assert abs(sharding.hypergeometric_by_ratio(rng, 4 * 10**9, 6 * 10**9, 10**6) - 400_000) < 5_000


def test_far_fingerprints_of_one_block_make_no_pairs(spark, monkeypatch):
    rng = np.random.default_rng(8)
    bits = rng.integers(0, 2, (31, 1024)).astype(np.uint8)
    bits[:, :20] = 1
    bits[30] = bits[29]
    bits[30, rng.choice(np.arange(20, 1024), 150, replace=False)] ^= 1
    rows = [(i, np.packbits(b, bitorder="little").view("<i8").tolist(), simhash.wide_blocks(b).tolist()) for i, b in enumerate(bits)]
    nodes, within, seen = spark.createDataFrame(rows, "doc long, fp array<long>, blocks array<int>"), simhash.within, []
    monkeypatch.setattr(simhash, "within", lambda pairs, *rest: seen.append(pairs.count()) or within(pairs, *rest))
    assert [(r.src, r.dst) for r in simhash.wide_edges(nodes, simhash.wide_limit(0.8)).collect()] == [(29, 30)]
    # all 465 pairs share a block; few of them are as near in the first words
    assert seen[0] <= 40


def test_pairs_of_one_group_leave_the_join_only_if_they_match(spark):
    rng = random.Random(9)
    base = [f"word{i}" for i in range(60)]
    texts = []
    for i in range(120):
        words = list(base)
        for j in rng.sample(range(60), rng.choice([1, 2, 4, 5, 6])):
            words[j] = f"odd{i}x{j}" if rng.random() < 0.5 else f"shared{rng.randrange(5)}"
        texts.append(" ".join(words))
    prepared = linedup.prepare(docs(spark, texts))
    grouped = linedup.groups(prepared)
    placed = prepared.sets.drop("finer").join(grouped.drop("first"), "h", "left").fillna(0, ["c", "v"])
    pairs = linedup.candidates(linedup.postings(placed), 4, 5).join(grouped.select(F.col("h").alias("a")), "a").join(grouped.select(F.col("h").alias("b")), "b")
    assert grouped.count() == prepared.sets.count() and 0 < pairs.count() == prepared.verified(pairs).count()


def test_blocks_of_wide_fingerprints_are_not_joined_with_their_sizes(spark, monkeypatch):
    plans, stored = [], simhash.stored
    monkeypatch.setattr(simhash, "stored", lambda df: (plans.append((df.columns, df._jdf.queryExecution().optimizedPlan().toString())), stored(df))[1])
    assert simhash.copies(docs(spark, [" ".join(f"w{i}" for i in range(80)) + f" end{k}" for k in range(3)])).count() == 2
    filed = [plan for columns, plan in plans if "drawn" in columns]
    assert len(filed) == simhash.ROUNDS and not any("Join" in plan for plan in filed)
