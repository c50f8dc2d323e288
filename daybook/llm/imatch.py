"""I-Match document fingerprints over randomised lexicon subsets, in DataFrame functions only.

Lexicon: terms whose share of documents lies in the band ``[LOW, HIGH]`` (equally,
whose inverse document frequency lies between two values), counted over all
documents. Since the shares of all terms add up to the mean number of distinct
terms of a document, at most that mean divided by ``LOW`` terms are in the band
or above it, however large the corpus; only those are broadcast.

In a group of copies or near copies of over ``HIGH`` of all documents, most terms
are above the band. A text of whose terms not below the band less than ``LEAST``
are in it is hashed over those in up to ``COMMON`` of the documents too, and if
these are as few, over the still more common ones; a text of terms below the band
only is hashed over these.

Each of 32 randomisations deals these terms into nested subsets, every one a
random half of the one before, 13 times at most. A document's hash under a randomisation is taken
over its sorted distinct terms in the smallest of those subsets that holds any
of them, so that short and long documents both keep a term or two. The
fingerprint is the 32 hashes in hex; the likeness of two fingerprints is the
share of equal ones.

Neighbours: documents are dealt into ranges of doc_id with one shuffle of the
texts; a range also gets a copy of the document that follows its last one, so
the next document is found within the range and no task sees all documents.

Defined results: null text counts as empty; a text without any term is
hashed as a whole, so equal texts have likeness 1 and others 0; repeated doc_ids
follow each other by text; a null doc_id comes last; with one document the next
is itself; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import cut_lineage

LOW, HIGH = 0.001, 0.1
#: Texts with less than this share of terms in the band are hashed by more common terms too, at first by those in at most that share of the documents.
LEAST, COMMON = 0.25, 0.5
DRAWS = 32
WORDS = DRAWS // 4
TOP_BITS = sum(1 << (15 * j + 14) for j in range(4))
RANGE_BYTES = 8 << 20
MAX_RANGES = 4096
NO_ID = -(1 << 63)


def distinct_terms(text: Column) -> Column:
    return F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+"))


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """``h, tier, depth0 .. depth7``: hash of each term not below the band, 0 in it and 1 or 2 above it, and how many halvings of each draw keep it."""
    n_docs = docs.count()
    terms = docs.select(F.explode(distinct_terms(F.coalesce("text", F.lit("")))).alias("term")).filter("term != ''")
    held = terms.select(F.xxhash64("term").alias("h")).groupBy("h").count().filter(F.col("count") >= low * n_docs)
    tier = F.when(F.col("count") <= high * n_docs, 0).when(F.col("count") <= COMMON * n_docs, 1).otherwise(2)
    return held.select("h", tier.alias("tier"), *[_depths(F.col("h"), w).alias(f"depth{w}") for w in range(WORDS)])


def telling_terms(words: DataFrame, terms: DataFrame, *keys: str) -> DataFrame:
    """``keys, h, depth0 .. depth7`` of the terms that each text is hashed over; terms below the band, which ``terms`` lacks, are the last tier."""
    text = Window.partitionBy(*keys)
    tiers = words.join(F.broadcast(terms.select("h", "tier")), "h", "left").select(*keys, "h", F.coalesce("tier", F.lit(3)).alias("tier"))
    counted = tiers.withColumns({f"n{t}": F.count_if(F.col("tier") <= t).over(text) for t in range(3)})
    last = F.when(F.col("n2") == 0, 3).when(F.col("n0") >= LEAST * F.col("n2"), 0).when(F.col("n1") >= LEAST * F.col("n2"), 1).otherwise(2)
    depths = [F.coalesce(f"depth{w}", _depths(F.col("h"), w)).alias(f"depth{w}") for w in range(WORDS)]
    return counted.filter(F.col("tier") <= last).select(*keys, "h").join(F.broadcast(terms.drop("tier")), "h", "left").select(*keys, "h", *depths)


def _depths(h: Column, word: int) -> Column:
    """Four draws of a halving count from 0 to 13, in fields of 15 bits: a count of n sets the lowest n + 1 of the field."""
    parts = []
    for j in range(4):
        bits = F.xxhash64(h, F.lit(4 * word + j)).bitwiseAND(F.lit(0x1FFF))
        # the number of leading zeros of 13 random bits
        level = F.lit(13) - F.when(bits == 0, F.lit(0)).otherwise(F.floor(F.log2(bits.cast("double"))).cast("int") + 1)
        filled = F.call_function("shiftleft", F.lit(2).cast("long"), level.cast("int")) - 1
        parts.append(F.shiftleft(filled, 15 * j))
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def deepest_terms(terms: DataFrame, *keys: str) -> DataFrame:
    """``keys, h, draws`` of the terms that stand in the smallest held subset of a draw.

    The depths of all terms of a text are joined by OR, field by field; a term is
    among the deepest of a draw if its field equals the joined one. No list of a
    text's terms is built; some tens of terms a text are left, however long it is.
    """
    text = Window.partitionBy(*keys)
    held = terms.withColumns({f"held{w}": F.bit_or(f"depth{w}").over(text) for w in range(WORDS)})
    # a field's top bit, which no depth sets, stays after the subtraction only if the fields are equal
    equal = [(F.lit(TOP_BITS) - F.col(f"depth{w}").bitwiseXOR(F.col(f"held{w}"))).bitwiseAND(F.lit(TOP_BITS)) for w in range(WORDS)]
    draws = reduce(lambda a, b: a.bitwiseOR(b), [F.shiftrightunsigned(x, w) for w, x in enumerate(equal)])
    return held.select(*keys, "h", draws.alias("draws")).filter("draws != 0")


def _hashes(terms: Column) -> Column:
    """The 32 hashes, in hex, of an array of structs ``h, draws`` sorted by h; null if it is empty."""
    hashes = [_digits(F.xxhash64(_kept(terms, 1 << (15 * (i % 4) + 14 - i // 4)))) for i in range(DRAWS)]
    return F.when(F.size(terms) > 0, F.concat(*hashes))


def _kept(terms: Column, bit: int) -> Column:
    return F.transform(F.filter(terms, lambda x: x["draws"].bitwiseAND(F.lit(bit).cast("long")) != 0), lambda x: x["h"])


def _digits(h: Column) -> Column:
    return F.lower(F.lpad(F.hex(h.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))


def likeness(a: Column, b: Column) -> Column:
    same = [(F.substring(a, 8 * i + 1, 8) == F.substring(b, 8 * i + 1, 8)).cast("int") for i in range(DRAWS)]
    return reduce(lambda x, y: x + y, same) / F.lit(float(DRAWS))


def with_range(rows: DataFrame, key: Column, bounds: list[int], name: str) -> DataFrame:
    """``rows`` with the number of the sorted bounds that are at most ``key``: the key's place among them.

    It is one expression that names no other column than the key's: a chain of steps, each of which names the one before
    more than once, is written out by the optimiser, and grows with the bounds. Nor has it lambdas: plans with lambdas are
    never taken as equal, and the shuffle of the texts could not be used twice.
    """
    always = sum(b <= NO_ID for b in bounds)
    # a bound is at most the key if the number before it is below it
    below = F.split(F.lit(",".join(str(b - 1) for b in bounds[always:])), ",").cast("array<bigint>") if len(bounds) > always else F.array().cast("array<bigint>")
    place = F.array_position(F.sort_array(F.concat(below, F.array(key))), key)
    return rows.withColumn(name, (F.coalesce(place, F.lit(1)) + (always - 1)).cast("int"))


def with_next(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``part, place, copy, doc_id, text, next_text``; rows with ``copy`` repeat the first document of the range below."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    key = F.coalesce("doc_id", F.lit(NO_ID))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_ranges = max(1, min(MAX_RANGES, -(-size // range_bytes)))
    bounds: list[int] = []
    if n_ranges > 1:
        shares = [i / n_ranges for i in range(1, n_ranges)]
        bounds = sorted(set(rows.agg(F.percentile_approx(key, shares, max(10_000, 20 * n_ranges))).first()[0]))
    placed = with_range(rows, key, bounds, "part")
    # parts are not null, so that no filter on one use of the rows makes their shuffle another; at most MAX_RANGES rows: the largest document of each range
    tops = sorted(placed.groupBy("part").agg(F.max(key).alias("top")).collect())
    follows = [(top, tops[(i + 1) % len(tops)][0], i + 1 == len(tops)) for i, (_, top) in enumerate(tops)]
    borders = docs.sparkSession.createDataFrame(follows or [(0, 0, False)], "top long, below int, wraps boolean").limit(len(follows))
    copies = rows.join(F.broadcast(borders), key == F.col("top")).select("doc_id", "text", F.coalesce("below", F.lit(0)).alias("part"), F.lit(True).alias("copy"))
    both = placed.select("doc_id", "text", "part", F.lit(False).alias("copy")).union(copies)
    order = Window.partitionBy("part").orderBy("copy", F.desc_nulls_last("doc_id"), "text")
    return both.withColumns({"place": F.row_number().over(order), "next_text": F.lead("text").over(order)})


def fingerprints(docs: DataFrame, low: float = LOW, high: float = HIGH, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Per document the contract's columns."""
    terms = cut_lineage(lexicon(docs.select("text"), low, high))
    rows = with_next(docs, range_bytes)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - half), F.substr("next_text", F.lit(1), half))
    rows = rows.select("part", "place", "copy", "doc_id", "text", F.when(~F.col("copy"), edited).alias("edited"))
    base = rows.select(
        "part", "place", "copy", "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        *[F.repeat(_digits(F.xxhash64(F.lower(c))), DRAWS).alias(f"whole_{c}") for c in ("text", "edited")],
    )
    held = rows.select("part", "place", F.explode(F.array(F.struct(F.lit(0).alias("k"), F.col("text").alias("t")), F.struct(F.lit(1).alias("k"), F.col("edited").alias("t")))).alias("v"))
    words = held.select("part", "place", F.col("v.k").alias("k"), F.explode(distinct_terms(F.col("v.t"))).alias("term")).filter("term != ''")
    told_by = telling_terms(words.select("part", "place", "k", F.xxhash64("term").alias("h")), terms, "part", "place", "k")
    entry = F.struct("h", "draws")
    lists = deepest_terms(told_by, "part", "place", "k").groupBy("part", "place").agg(*[F.array_sort(F.collect_list(F.when(F.col("k") == k, entry))).alias(f"terms{k}") for k in (0, 1)])
    prints = lists.select("part", "place", _hashes(F.col("terms0")).alias("print0"), _hashes(F.col("terms1")).alias("print1"))
    joined = base.join(prints, ["part", "place"], "left")
    named = joined.select("part", "place", "copy", "doc_id", "n_chars", "edited_sha256", F.coalesce("print0", "whole_text").alias("fingerprint"), F.coalesce("print1", "whole_edited").alias("edited_fingerprint"))
    following = F.lead("fingerprint").over(Window.partitionBy("part").orderBy("place"))
    out = named.withColumn("next_fingerprint", following).filter("NOT copy")
    return out.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
