"""The registered queries of the text operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import bpe, decontam, divergence, htmltext, imatch, langid, linedup, periodic, sharding, simhash, substring, toxicity, warc
from daybook.llm.common import table


def tokenizer_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linedup.report(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), min_bytes=0)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), *tokenizer_files())


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.cluster(simhash.fingerprints(table(spark, sf_dir, "documents"), width=3), max_bits=2)
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), n_shards=24)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = docs.select("doc_id", "text", langid.is_held_out(F.col("doc_id")).alias("held_out"))
    return langid.predict(held_out, langid.fit(docs), keep=["held_out"]).select("doc_id", "held_out", "lang_pred", "score")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.main_text(table(spark, sf_dir, "pages"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digests(decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.passages(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(table(spark, sf_dir, "documents"), periodic.periodic_tenth)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.predict(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", toxicity.is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_line_dedup, op2_warc, op3_bpe, op4_simhash, op5_imatch, op6_sharding, op7_language_id, op8_html_extraction, op9_decontamination, op10_substring_dedup, op11_periodic_runs, op12_source_divergence, op13_toxicity)
}

# SQL twins, for what SQL can say

_DIGITS = "sha1(p)"
_GROUP = "('0x' || substr(d, 5 * i + 1, 5))::INTEGER"
_BASE32 = f"""array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({_GROUP} >> s) & 31) + 1, 1)), '')), '')"""
_WARC = f"""WITH h AS (SELECT page_id, octet_length(p) AS payload_bytes, {_BASE32} AS payload_digest FROM (SELECT page_id, p, {_DIGITS} AS d FROM (SELECT page_id, encode(coalesce(html, '')) AS p FROM pages))),
f AS (SELECT payload_digest, min(page_id) AS first FROM h GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM h JOIN f USING (payload_digest)"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_DECONTAMINATION = f"""WITH b AS (SELECT item_id, w FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b)),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
lens AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN win ON dw.t = win.t AND dw.n = win.n),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY 1)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

_LINE_DEDUP = r"""WITH l AS (SELECT doc_id, i, list_sort(list_distinct(list_filter(string_split_regex(lower(line), '[\x20\x09-\x0D]+'), lambda x: x <> ''))) AS w FROM
  (SELECT doc_id, unnest(range(len(a))) AS i, unnest(a) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents))),
o AS (SELECT doc_id, i, w FROM l WHERE len(w) > 0),
s AS (SELECT row_number() OVER () AS k, w, len(w) AS n, first FROM (SELECT w, min({'d': doc_id, 'i': i}) AS first FROM o GROUP BY 1)),
t AS (SELECT k, n, unnest(w) AS x FROM s), r AS (SELECT x, count(*) AS c FROM t GROUP BY 1),
p AS (SELECT k, n, x FROM (SELECT t.k, t.n, t.x, row_number() OVER (PARTITION BY t.k ORDER BY r.c, t.x) AS pos FROM t JOIN r USING (x)) WHERE pos <= n - CAST(ceil(n * 4 / 5.0) AS INTEGER) + 1),
c AS (SELECT DISTINCT a.k AS ka, b.k AS kb FROM p a JOIN p b ON a.x = b.x AND a.k < b.k AND a.n * 5 >= b.n * 4 AND b.n * 5 >= a.n * 4),
m AS (SELECT ka, kb FROM c JOIN s a ON a.k = ka JOIN s b ON b.k = kb WHERE len(list_intersect(a.w, b.w)) * 9 >= (a.n + b.n) * 4),
e AS (SELECT ka AS k, kb AS other FROM m UNION ALL SELECT kb, ka FROM m),
g AS (SELECT e.k, count(*) AS links, min(z.first) AS near FROM e JOIN s z ON z.k = e.other GROUP BY 1),
f AS (SELECT s.w, coalesce(links, 0) AS links, least(first, coalesce(near, first)) AS keep FROM s LEFT JOIN g USING (k)),
q AS (SELECT doc_id, count(*) AS n_lines, sum(links)::BIGINT AS n_links, list_sort(list_filter(list(CASE WHEN {'d': doc_id, 'i': i} > keep THEN i END), lambda x: x IS NOT NULL)) AS gone FROM o JOIN f USING (w) GROUP BY 1)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_links, 0) AS n_links, coalesce(len(gone), 0) AS n_removed, coalesce(array_to_string(gone, ','), '') AS removed_lines FROM documents d LEFT JOIN q USING (doc_id)"""

# the checksum of a doc_id's digits, bit by bit
_CRC32 = "xor(4294967295, list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT), lambda c, d: list_reduce(range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, d)), 4294967295::BIGINT))"
# a stretch of places at which the word one period on is the same; of equal stretches that of the least period is a run
_PERIODIC_RUNS = rf"""WITH o AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ 	-
]+'), lambda x: x <> '') AS w, {_CRC32} AS h FROM documents),
g AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) ELSE 0 END AS a, 3 + (h // 10) % 8 AS e FROM o),
d AS (SELECT doc_id, n, CASE WHEN planted THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // e) END]) ELSE w END AS w FROM g),
x AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS word FROM d),
m AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM x JOIN x y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
s AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS part FROM m) GROUP BY doc_id, q, part),
r AS (SELECT doc_id, start, length, min(q) AS period FROM s WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
b AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length::DECIMAL(38, 18) / period DESC, start, period) = 1),
t AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM r GROUP BY 1),
z AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM x ANTI JOIN z USING (doc_id, i) GROUP BY 1)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, (1000 * length) // period AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN t USING (doc_id) LEFT JOIN b USING (doc_id) LEFT JOIN k USING (doc_id)"""

_TERMS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
_DIVERGENCE = f"""WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_TERMS} AS w FROM documents),
k AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM d) GROUP BY 1, 2 HAVING count(*) >= 30),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY 1),
c AS (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(w) AS term FROM d) SEMI JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
gn AS (SELECT lang, source, any_value(v) AS v, coalesce(sum(n), 0) AS total FROM g JOIN v USING (lang) LEFT JOIN c USING (lang, source) GROUP BY 1, 2),
p AS (SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (total + 5 * v) AS p FROM gn JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS q FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY 1, 2) JOIN v USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
f AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM f) WHERE part = 'pair' OR rank <= 50"""

ORACLES: dict[str, str] = {"op1_line_dedup": _LINE_DEDUP, "op2_warc": _WARC, "op9_decontamination": _DECONTAMINATION, "op11_periodic_runs": _PERIODIC_RUNS, "op12_source_divergence": _DIVERGENCE}
