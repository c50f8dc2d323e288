"""SimHash near-duplicate detection by pigeonhole blocks.

Fingerprint: words of the ASCII-lower-cased text, shingles of ``width`` words
with repeats, one XXH64 (seed 42) per shingle; a bit is set if it is set in
over half of the hashes. Two fingerprints link if they differ in at most
``max_bits`` bits.

Pigeonhole: 64 bits are split into ``n_blocks`` blocks; if at most ``max_bits``
bits differ, at least ``n_blocks - max_bits`` whole blocks are equal, so close
pairs share a key for some choice of that many blocks. Distinct fingerprints
are joined on those keys and the Hamming distance of each pair is verified.

A bucket with many fingerprints is not paired off: its members are split anew
on the bits outside the key. Each member is filed under itself and under every
fingerprint one outside bit away; members filed together differ in two bits at
most, and members that differ in two bits meet in the fingerprint between them.
A file has at most 65 members, so linking all to its smallest member makes a
linear number of edges and loses no component. This needs ``max_bits`` = 2; for
other limits buckets are split by further blocks and joined in salted parts.

Wide fingerprints, for similarities far below that of two bits: ``without_copies``
takes 1,024 bits from each shingle's hash, and files a fingerprint under 102 blocks
of 20 bits: 51 runs of bits, and 51 that take every 51st bit. The share of differing
bits tells the angle between two documents, so a Jaccard similarity of 0.8 stands for
155 bits on average. Pairs that share a block and differ by no more than some
deviations above that are candidates, and the Jaccard similarity of their shingle
sets is verified. Guaranteed to share a block are pairs that differ in 50 bits at
most; README has the measured share of others. Members of small buckets are paired; members of large ones meet
two of them, the first and one drawn by a hash of the block, and then every member
that no chain of verified edges joins to them yet, in salted parts. No candidate is left out: a pair that never
meets is in one component already.

Defined results: null or blank text has fingerprint zero and links like any
other; fewer words than ``width`` form one shingle; equal texts have equal
fingerprints; rows with one doc_id and different texts keep their own
fingerprints; a null doc_id is never the smallest of its group unless all are.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from daybook.llm.common import arrow_map, cut_lineage, drop_stored, plain_names, stored
from daybook.llm.graph import connected_components

SEED = 42
WIDE_WORDS = 16
WIDE_BLOCK_BITS = 20
#: Standard deviations above the mean distance that candidates may have; all of them are verified.
DEVIATIONS = 8
#: Words of a wide fingerprint that are compared before a pair becomes a row. Random pairs differ in half of their bits, the
#: limit for four words is some five deviations below that; for two it was two, and the rows grew with the square of the documents.
SKETCH_WORDS = 4
#: Turns in which blocks of wide fingerprints are filed; what a turn files is deleted at its end.
ROUNDS = 4
#: Buckets of more distinct fingerprints than this are split, not paired off.
PAIRED_BUCKET = 32
#: Members of a salted part of a large bucket of wide fingerprints.
SALTED_PART = 1024


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 of every shingle of the text, in order, repeats included."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    return np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64)


def majority_bits(hashes: np.ndarray) -> int:
    """The fingerprint, as a signed 64-bit integer."""
    if not len(hashes):
        return 0
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    on = (bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(on, bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``doc_id, fp``."""
    schema = StructType([StructField("doc_id", LongType()), StructField("fp", LongType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = [majority_bits(shingle_hashes(t.as_py(), width)) for t in batch.column(1)]
        return pa.record_batch([batch.column(0), pa.array(fps, pa.int64())], names=schema.names)

    return arrow_map(df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, schema)


def wide_words(hashes: np.ndarray) -> np.ndarray:
    """``WIDE_WORDS`` independent 64-bit words for each hash, by a mixing function."""
    x = hashes[:, None] + np.arange(1, WIDE_WORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def wide_majority(hashes: np.ndarray) -> np.ndarray:
    """The bits of the wide fingerprint; sums are held in bytes over runs of 255 shingles."""
    counts = np.zeros(64 * WIDE_WORDS, dtype=np.int64)
    for a in range(0, len(hashes), 255):
        words = np.ascontiguousarray(wide_words(hashes[a : a + 255]).astype("<u8"))
        counts += np.unpackbits(words.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    return (counts * 2 > len(hashes)).astype(np.uint8)


def wide_blocks(bits: np.ndarray) -> np.ndarray:
    """The bits in blocks, by runs and by strides: a block of one kind has at most one bit in common with one of the other."""
    n = len(bits) // WIDE_BLOCK_BITS
    used = bits[: n * WIDE_BLOCK_BITS]
    return np.concatenate((used.reshape(n, -1), used.reshape(-1, n).T)) @ (1 << np.arange(WIDE_BLOCK_BITS))


def wide_fingerprints(df: DataFrame, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``doc_id, fp`` (16 longs) and ``blocks`` (102 numbers of 20 bits)."""
    schema = StructType([StructField("doc_id", LongType()), StructField("fp", ArrayType(LongType())), StructField("blocks", ArrayType(IntegerType()))])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bits = [wide_majority(shingle_hashes(t.as_py(), width)) for t in batch.column(1)]
        fps = [np.packbits(b, bitorder="little").view("<i8").tolist() for b in bits]
        blocks = [wide_blocks(b).tolist() for b in bits]
        return pa.record_batch([batch.column(0), pa.array(fps, pa.list_(pa.int64())), pa.array(blocks, pa.list_(pa.int32()))], names=schema.names)

    return arrow_map(df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, schema)


def wide_limit(similarity: float) -> int:
    """Differing bits that two documents whose shingle sets have this Jaccard similarity stay within: the mean and ``DEVIATIONS``."""
    n, share = 64 * WIDE_WORDS, math.acos(2 * similarity / (1 + similarity)) / math.pi
    return int(n * share + DEVIATIONS * math.sqrt(n * share * (1 - share)))


def sketch_limit(limit: int) -> int:
    """Differing bits of ``SKETCH_WORDS`` words that go with ``limit`` in all of them: their share and ``DEVIATIONS``.

    The share is that of which ``limit`` is ``DEVIATIONS`` above the mean.
    """
    n, m = 64 * WIDE_WORDS, 64 * SKETCH_WORDS
    # limit = n p + DEVIATIONS sqrt(n p (1 - p)), solved for p
    mean, over = limit / n, DEVIATIONS**2 / n
    share = (2 * mean + over - math.sqrt(max(0.0, (2 * mean + over) ** 2 - 4 * (1 + over) * mean**2))) / (2 * (1 + over))
    return int(m * share + DEVIATIONS * math.sqrt(m * share * (1 - share)))


def alike(pairs: DataFrame, docs: DataFrame, width: int, similarity: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ``pairs`` of doc_ids whose sets of shingles have this Jaccard similarity at least."""
    pairs = cut_lineage(pairs)
    wanted = pairs.select(F.col("src").alias("doc")).union(pairs.select("dst")).distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).join(wanted, "doc", "left_semi")
    schema = StructType([StructField("doc", LongType()), StructField("shingles", ArrayType(LongType()))])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [np.unique(shingle_hashes(t.as_py(), width)).view("<i8") for t in batch.column(1)]
        return pa.record_batch([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=schema.names)

    sets = stored(arrow_map(texts, run, schema))
    x, y = (sets.select(F.col("doc").alias(c), F.col("shingles").alias(f"of_{c}")) for c in ("src", "dst"))
    shared = F.size(F.array_intersect("of_src", "of_dst"))
    enough = shared >= similarity * (F.size("of_src") + F.size("of_dst") - shared) - 1e-9
    return pairs.join(x, "src").join(y, "dst").filter(enough).select("src", "dst").distinct()


def wide_edges(nodes: DataFrame, limit: int, verify: Callable[[DataFrame], DataFrame] = lambda pairs: pairs) -> DataFrame:
    """Verified edges ``src, dst`` between rows ``doc, fp, blocks`` of distinct fingerprints.

    Their components are those of all pairs that share a block and are within the limit and pass ``verify``. Blocks are
    filed in ``ROUNDS`` turns, each of which leaves only its pairs. ``SKETCH_WORDS`` words of the fingerprints ride along, and a
    pair becomes a row only if they are as near, with as many deviations, as the limit asks of the whole ones.
    """
    n_blocks, sketch = 2 * (64 * WIDE_WORDS // WIDE_BLOCK_BITS), [f"s{i}" for i in range(SKETCH_WORDS)]
    step, found, crowds = -(-n_blocks // ROUNDS), [], []
    for start in range(0, n_blocks, step):
        blocks = F.posexplode(F.slice("blocks", start + 1, step)).alias("part", "key")
        # words that hold none of the runs of this turn, which agree in any case
        at = 0 if start else WIDE_WORDS - SKETCH_WORDS
        filed = nodes.select("doc", *[F.get("fp", at + i).alias(s) for i, s in enumerate(sketch)], blocks).withColumn("part", F.col("part") + start)
        drawn = F.min(F.struct(F.xxhash64("doc", "part").alias("order"), "doc"))
        bucket = Window.partitionBy("part", "key")
        held = stored(filed.select("part", "key", "doc", *sketch, F.count("*").over(bucket).alias("size"), F.min("doc").over(bucket).alias("first"), drawn.over(bucket)["doc"].alias("drawn")).filter("size > 1"))
        few, many = held.filter(F.col("size") <= PAIRED_BUCKET), held.filter(F.col("size") > PAIRED_BUCKET)
        x, y = (few.select("part", "key", F.col("doc").alias(end), *[F.col(s).alias(f"{s}_{end}") for s in sketch]) for end in ("src", "dst"))
        bits = reduce(lambda p, q: p + q, [distance(F.col(f"{s}_src"), F.col(f"{s}_dst")) for s in sketch])
        near = (F.col("src") < F.col("dst")) & (bits <= sketch_limit(limit))
        pairs = x.join(y, (x["part"] == y["part"]) & (x["key"] == y["key"]) & near).select("src", "dst")
        stars = many.select(F.explode(F.array("first", "drawn")).alias("x"), "doc").filter("x != doc").select(F.least("x", "doc").alias("src"), F.greatest("x", "doc").alias("dst"))
        found.append(stored(pairs.union(stars).distinct()))
        crowds.append(stored(many.select("part", "key", "doc", "size")))
        drop_stored(held)
    many = reduce(DataFrame.union, crowds)
    met = verify(within(reduce(DataFrame.union, found).distinct(), nodes, limit))
    if many.isEmpty():
        return met
    met = cut_lineage(met)
    return met.union(verify(within(unmet(many, connected_components(met)), nodes, limit)))


def within(pairs: DataFrame, nodes: DataFrame, limit: int) -> DataFrame:
    """The ``pairs`` whose fingerprints differ in at most ``limit`` bits."""
    x, y = nodes.select(F.col("doc").alias("src"), F.col("fp").alias("fp_a")), nodes.select(F.col("doc").alias("dst"), F.col("fp").alias("fp_b"))
    bits = reduce(lambda p, q: p + q, [distance(F.get("fp_a", i), F.get("fp_b", i)) for i in range(WIDE_WORDS)])
    return pairs.join(x, "src").join(y, "dst").filter(bits <= limit).select("src", "dst")


def unmet(many: DataFrame, roots: DataFrame) -> DataFrame:
    """All pairs ``src, dst`` of members of one bucket that are in different components.

    Members outside a bucket's largest component meet all its members, in parts of
    some ``SALTED_PART``; those inside it need not meet each other.
    """
    salts = F.ceil(F.col("size") / SALTED_PART).cast("int")
    rooted = cut_lineage(many.join(roots, F.col("doc") == F.col("node"), "left").select("part", "key", "doc", salts.alias("salts"), F.coalesce("root", "doc").alias("root")))
    counts = rooted.groupBy("part", "key", "root").agg(F.count("*").alias("n"))
    mains = counts.groupBy("part", "key").agg(F.max(F.struct("n", "root"))["root"].alias("main"), F.count("*").alias("roots")).filter("roots > 1").drop("roots")
    left = rooted.join(mains, ["part", "key"])
    x = left.filter("root != main").select("part", "key", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("salts") - 1).cast("long"))).alias("salt"), F.col("doc").alias("a"), F.col("root").alias("root_a"))
    y = left.select("part", "key", F.pmod(F.xxhash64("doc"), F.col("salts").cast("long")).alias("salt"), F.col("doc").alias("b"), F.col("root").alias("root_b"), "main")
    apart = x.join(y, ["part", "key", "salt"]).filter((F.col("root_a") != F.col("root_b")) & ((F.col("root_b") == F.col("main")) | (F.col("a") < F.col("b"))))
    return apart.select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).distinct()


def copies(df: DataFrame, width: int = 5, min_similarity: float = 0.8, **columns: str) -> DataFrame:
    """``doc_id, root`` of the documents that are near copies of an earlier one, the root of their group."""
    fps = stored(wide_fingerprints(df, width, **columns).filter("doc_id IS NOT NULL"))
    nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("doc"), F.first("blocks").alias("blocks")))
    roots = connected_components(wide_edges(nodes, wide_limit(min_similarity), lambda pairs: alike(pairs, df, width, min_similarity, **columns)))
    placed = nodes.select("fp", "doc").join(roots, F.col("doc") == F.col("node"), "left").select("fp", F.coalesce("root", "doc").alias("root"))
    return fps.select("doc_id", "fp").join(placed, "fp").filter("doc_id != root").select("doc_id", "root").distinct()


def without_copies(docs: DataFrame, width: int = 5, min_similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without near copies: the smallest doc_id of each group stays; rows without doc_id stay."""
    gone = copies(docs, width, min_similarity, id_col=id_col, text_col=text_col).select(F.col("doc_id").alias("gone"))
    plain, names = plain_names(docs)
    return plain.join(gone.hint("shuffle_hash"), F.col(names[id_col]).cast("long") == F.col("gone"), "left_anti").toDF(*names)


def block_masks(n_blocks: int) -> list[int]:
    """Masks of ``n_blocks`` blocks of nearly equal width that make up 64 bits."""
    edges = [64 * i // n_blocks for i in range(n_blocks + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def close_edges(fps: DataFrame, max_bits: int = 2, n_blocks: int = 4) -> DataFrame:
    """Verified edges ``src, dst`` between distinct fingerprints; their components are those of all links.

    fps: one row for each distinct fingerprint, column ``fp``.
    """
    if not 0 <= max_bits < n_blocks:
        raise ValueError("there must be more blocks than bits that may differ")
    masks = [signed(sum(c)) for c in combinations(block_masks(n_blocks), n_blocks - max_bits)]
    filed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("part", "key"))
    sizes = filed.groupBy("part", "key").agg(F.count("*").alias("size")).filter("size > 1")
    held = cut_lineage(filed.join(sizes, ["part", "key"]))
    few, many = held.filter(F.col("size") <= PAIRED_BUCKET), held.filter(F.col("size") > PAIRED_BUCKET)
    a, b = few.select("part", "key", F.col("fp").alias("src")), few.select("part", "key", F.col("fp").alias("dst"))
    pairs = a.join(b, ["part", "key"]).filter((F.col("src") < F.col("dst")) & (distance(F.col("src"), F.col("dst")) <= max_bits)).select("src", "dst")
    if max_bits == 2:
        return pairs.union(split_buckets(many, masks))
    salted = many.withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(16)))
    x = salted.select("part", "key", "salt", F.col("fp").alias("src"))
    y = many.select("part", "key", F.explode(F.sequence(F.lit(0), F.lit(15))).cast("long").alias("salt"), F.col("fp").alias("dst"))
    return pairs.union(x.join(y, ["part", "key", "salt"]).filter((F.col("src") < F.col("dst")) & (distance(F.col("src"), F.col("dst")) <= max_bits)).select("src", "dst"))


def split_buckets(many: DataFrame, masks: list[int]) -> DataFrame:
    """Star edges within large buckets, for two differing bits at most."""
    bits = F.array(*[F.lit(0).cast("long")] + [F.lit(signed(1 << i)) for i in range(64)])
    outside = F.array(*[F.lit(m) for m in masks])
    flips = F.filter(bits, lambda b: b.bitwiseAND(F.get(outside, F.col("part"))) == 0)
    members = many.select("part", "fp", F.explode(F.transform(flips, lambda b: F.col("fp").bitwiseXOR(b))).alias("near"))
    least = members.groupBy("part", "near").agg(F.min("fp").alias("src"), F.count("*").alias("n")).filter("n > 1").drop("n")
    linked = members.join(least, ["part", "near"]).filter(F.col("src") != F.col("fp"))
    return linked.filter(distance(F.col("src"), F.col("fp")) <= 2).select("src", F.col("fp").alias("dst")).distinct()


def cluster(fps: DataFrame, max_bits: int = 2, n_blocks: int = 4) -> DataFrame:
    """``doc_id, fp, component_id`` for rows ``doc_id, fp``; component_id is the smallest doc_id reachable."""
    fps = cut_lineage(fps)
    firsts = fps.groupBy("fp").agg(F.min("doc_id").alias("first_doc"))
    edges = close_edges(firsts.select("fp"), max_bits, n_blocks)
    labels = connected_components(edges)
    known = firsts.join(labels.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = known.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    by_fp = known.join(least, "root").select("fp", "component_id")
    return fps.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
