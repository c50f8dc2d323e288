"""Source divergence audit: how far the sources of a language are from each other, and by which terms.

Each language keeps the terms of at least ``min_docs`` of its documents. A group
(language, source) gives each kept term a share in parts of a thousand million,
smoothed and in whole numbers; two groups differ by the sum of the differences
of their shares, and a group's terms rank by how far their share is above the
language's.

The vocabulary, in order of UTF-8, is cut into chunks of ``CHUNK`` terms; a
group's counts in a chunk are one compressed vector, so no row grows with the
data. Sources are dealt into blocks by hash. Blocks stay in their partitions (a
bucketed table in the shared folder) while the others' vectors
travel: in round r of a round-robin tournament block b meets block r - b, one of
the two at home, and both directions are evaluated there; in the round in which
a block would meet itself, its own groups meet each other and the language's
vector, and a heap for each group keeps the terms that rank first. As many rounds
as blocks settle every pair once; sums over chunks and the heads of the heaps
are merged by ordinary aggregation.

Counting keeps a bounded number of terms in a Python worker and adds up by
group and term in one shuffle; a term's documents are added up over a language
in another, of one row a group and term.

Defined results: null text, lang and source are empty; every occurring group has
rows for all other sources of its language, also without terms (value 0 if the
language keeps none); a repeated document row counts again; ties rank by UTF-8;
an empty table gives an empty result; a text of any length counts whole; other
columns are not read.
"""

from __future__ import annotations

import heapq
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import drop_stored, new_path, stored

MIN_DOCS, TOP_TERMS = 30, 50
#: Terms of a language in one vector.
CHUNK = 1 << 13
#: Different terms of groups that a Python worker counts before it hands them on.
HELD_TERMS = 400_000
#: Blocks (and rounds) of few sources, and sources a block of many.
FEW_BLOCKS, BLOCK_SOURCES = 5, 256
SCALE_STEPS, SCALE_STEP = 3, 1000

#: Bytes of UTF-8 that belong to terms, A-Z in lower case; all others as blanks.
_TERM_BYTES = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
COUNTS = "lang string, source string, term string, n long, docs long"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


def _count(batches: Iterator[pa.RecordBatch], held_terms: int) -> Iterator[pa.RecordBatch]:
    occurrences: dict[tuple[str, str], Counter] = {}
    documents: dict[tuple[str, str], Counter] = {}

    def settle() -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in occurrences.items():
            docs = documents[lang, source]
            size = len(counts)
            columns = [pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()), pa.array(counts.keys(), pa.binary()).cast(pa.string())]
            yield pa.record_batch([*columns, pa.array(counts.values(), pa.int64()), pa.array([docs[t] for t in counts], pa.int64())], names=["lang", "source", "term", "n", "docs"])
        occurrences.clear()
        documents.clear()

    size = 0
    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()), strict=True):
            terms = terms_of(text.as_py())
            counts = occurrences.setdefault((lang, source), Counter())
            before = len(counts)
            counts.update(terms)
            documents.setdefault((lang, source), Counter()).update(set(terms))
            size += len(counts) - before
            if size >= held_terms:
                yield from settle()
                size = 0
    yield from settle()


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS, held_terms: int = HELD_TERMS) -> DataFrame:
    """``lang, source, term, n`` of the terms that their language keeps; ``docs`` has ``lang, source, text`` without nulls."""
    counts = docs.select("lang", "source", "text").mapInArrow(lambda batches: _count(batches, held_terms), COUNTS)
    by_group = counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_lang = F.sum("docs").over(Window.partitionBy("lang", "term"))
    return by_group.withColumn("of_lang", of_lang).filter(F.col("of_lang") >= min_docs).select("lang", "source", "term", "n")


def shares(count, total, kept):
    """1 + floor(10^9 (count + 5) / (total + 5 kept)) in whole numbers below 2^63, by long division."""
    over, rest, out = total + 5 * kept, count + 5, 0
    for _ in range(SCALE_STEPS):
        rest = rest * SCALE_STEP
        out, rest = out * SCALE_STEP + rest // over, rest % over
    return out + 1


def pack(places: np.ndarray, counts: np.ndarray) -> bytes:
    """A chunk's terms that occur and their counts: steps between places, counts as narrow as they fit, compressed."""
    order = np.argsort(places)
    places, counts = places[order], counts[order]
    width = next(w for w in (1, 2, 4, 8) if not len(counts) or int(counts.max()) < 1 << (8 * w - 1))
    steps = np.diff(places, prepend=0).astype("<u2")
    return zlib.compress(bytes([width]) + steps.tobytes() + counts.astype(f"<i{width}").tobytes(), 1)


def unpack(vector: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(vector)
    n = (len(raw) - 1) // (2 + raw[0])
    return np.cumsum(np.frombuffer(raw, "<u2", n, 1), dtype=np.int64), np.frombuffer(raw, f"<i{raw[0]}", n, 1 + 2 * n).astype(np.int64)


class Side:
    """The shares of several groups in a chunk, over ``places``; in the terms beyond those each has its ``blank`` share."""

    def __init__(self, rows: list[dict], vectors: list[tuple[np.ndarray, np.ndarray]], places: np.ndarray):
        self.names = [r["source"] for r in rows]
        self.counts = np.zeros((len(rows), len(places)), np.int64)
        for i, (at, n) in enumerate(vectors):
            self.counts[i, np.searchsorted(places, at)] = n
        total, kept = (np.array([r[k] for r in rows], np.int64) for k in ("total", "kept"))
        none = kept == 0
        self.shares = shares(self.counts, (total + none)[:, None], kept[:, None])
        self.blank = shares(np.zeros(len(rows), np.int64), total + none, kept)


def apart(a: Side, i: int, b: Side, beyond: int) -> np.ndarray:
    """How far group ``i`` of ``a`` is from each of ``b`` in the chunk."""
    return np.abs(b.shares - a.shares[i]).sum(axis=1) + np.abs(b.blank - a.blank[i]) * beyond


FOUND = "lang string, source string, other string, term_id long, value long"


def meet(home: pa.Table, visitors: pa.Table, top: int, chunk_terms: int) -> pa.Table:
    """One meeting in one chunk: a home block's groups with another's, or with each other and their language."""
    here, there = home.to_pylist(), visitors.to_pylist()
    found: list[tuple[str, str | None, int | None, int]] = []
    if here and there:
        lang, first_id = here[0]["lang"], here[0]["chunk"] * chunk_terms
        vectors, others = [unpack(r["vector"]) for r in here], [unpack(r["vector"]) for r in there]
        places = np.unique(np.concatenate([at for at, _ in vectors + others]))
        beyond = here[0]["terms"] - len(places)
        own = Side(here, vectors, places)
        alone = there[0]["source"] is None
        guests = Side(there, others, places)
        for i, name in enumerate(own.names):
            met = own if alone else guests
            for other, value in zip(met.names, apart(own, i, met, beyond).tolist(), strict=True):
                if other != name:
                    found.append((name, other, None, value))
                    if not alone:
                        found.append((other, name, None, value))
            if alone:
                over = own.shares[i] - guests.shares[0]
                at = np.flatnonzero((own.counts[i] > 0) & (over > 0))
                heap = heapq.nsmallest(top, zip((-over[at]).tolist(), places[at].tolist(), strict=True))
                found.extend((name, None, first_id + place, -f) for f, place in heap)
    else:
        lang = ""
    columns = list(zip(*found, strict=True)) or [(), (), (), ()]
    kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
    return pa.table([pa.array([lang] * len(found), pa.string()), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["lang", "source", "other", "term_id", "value"])


def stays(block: Column, other: Column, blocks: int) -> Column:
    """Whether ``block`` is at home when it meets ``other``: each is for about half of those it meets."""
    ahead, behind = F.pmod(other - block, F.lit(blocks)), F.pmod(block - other, F.lit(blocks))
    return (ahead < behind) | ((ahead == behind) & (block < other))


def tournament(vectors: DataFrame, languages: DataFrame, blocks: int, top: int, chunk_terms: int = CHUNK) -> DataFrame:
    """What all rounds find; ``vectors`` by (lang, chunk, block) and in partitions by these, ``languages`` by (lang, chunk)."""
    keys = ("lang", "chunk", "block")
    rounds = []
    for r in range(blocks):
        opponent = F.pmod(F.lit(r) - F.col("block"), F.lit(blocks))
        travelling = vectors.filter((opponent != F.col("block")) & stays(opponent, F.col("block"), blocks)).withColumn("block", opponent.cast("int"))
        alone = F.array(*[F.lit(b) for b in range(blocks) if 2 * b % blocks == r]).cast("array<int>")
        visitors = travelling.unionByName(languages.withColumn("block", F.explode(alone)))
        rounds.append(vectors.groupBy(*keys).cogroup(visitors.groupBy(*keys)).applyInArrow(lambda home, away: meet(home, away, top, chunk_terms), FOUND))
    return reduce(DataFrame.unionByName, rounds)


def _packed(df: DataFrame) -> DataFrame:
    """``lang, source, chunk, total, kept, terms, counts`` with the counts as a vector."""
    schema = "lang string, source string, chunk long, total long, kept long, terms long, vector binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):
                part = batch.slice(begin, 64)
                vectors = []
                for row in part.column(6):
                    flat = row.values if row.is_valid else None
                    places, counts = (flat.field(k).to_numpy(zero_copy_only=False) if flat is not None else np.zeros(0, np.int64) for k in (0, 1))
                    vectors.append(pack(places, counts))
                yield pa.record_batch([*part.columns[:6], pa.array(vectors, pa.binary())], names=["lang", "source", "chunk", "total", "kept", "terms", "vector"])

    return df.mapInArrow(run, schema)


def resident(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` as a bucketed table in the shared folder: a scan of it is in partitions by the keys, without a shuffle."""
    spark, name = df.sparkSession, f"daybook_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(parts, *keys).write.option("path", new_path(spark, "buckets")).bucketBy(parts, *keys).saveAsTable(name)
    return spark.table(name)


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``id`` from 0 on without gaps, in order of ``at``, a number by partition and row; one count a partition goes to the driver."""
    part = F.shiftright("at", 33)
    sizes = sorted(tuple(r) for r in rows.groupBy(part.alias("part")).count().collect())
    first = [(part_, sum(n for _, n in sizes[:i])) for i, (part_, _) in enumerate(sizes)]
    offsets = rows.sparkSession.createDataFrame(first, "part long, first long")
    return rows.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn("id", F.col("first") + F.col("at") - F.shiftleft("part", 33)).drop("part", "first", "at")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, held_terms: int = HELD_TERMS, chunk_terms: int = CHUNK) -> DataFrame:
    """``lang, source, part, item, value, rank``: per group its distance from each other source (``pair``) and its ``top`` terms (``term``).

    ``chunk_terms``, the terms of a vector, is a power of two up to 2^16.
    """
    spark = docs.sparkSession
    rows = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    groups = stored(rows.select("lang", "source").distinct())
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0]
    if most is None:
        return spark.createDataFrame([], "lang string, source string, part string, item string, value long, rank int")
    blocks = max(min(most, FEW_BLOCKS), -(-most // BLOCK_SOURCES))
    kept = stored(kept_counts(rows, min_docs, held_terms))
    ordered = kept.groupBy("lang", "term").agg(F.sum("n").alias("n")).orderBy("lang", "term")
    sorted_terms = stored(ordered.select("lang", "term", "n", F.monotonically_increasing_id().alias("at")))
    terms = numbered(sorted_terms)
    chunk, place = F.expr(f"id div {chunk_terms}"), (F.col("id") % chunk_terms).cast("int")
    counts = F.collect_list(F.struct(F.col("place"), F.col("n"))).alias("counts")
    of_lang = terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n").alias("lang_total"))
    # a chunk of no terms for each language, so that every group takes part
    chunks = terms.groupBy("lang", chunk.alias("chunk")).agg(F.count("*").alias("terms")).unionByName(groups.select("lang", F.lit(-1).cast("long").alias("chunk"), F.lit(0).cast("long").alias("terms")).distinct())
    chunks = chunks.join(of_lang, "lang", "left").fillna(0, ["kept", "lang_total"])
    of_group = groups.join(kept.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").fillna(0, ["total"])
    sparse = kept.join(terms.select("lang", "term", "id"), ["lang", "term"]).select("lang", "source", chunk.alias("chunk"), place.alias("place"), "n").groupBy("lang", "source", "chunk").agg(counts)
    dense = of_group.join(chunks, "lang").join(sparse, ["lang", "source", "chunk"], "left")
    vectors = _packed(dense.select("lang", "source", "chunk", "total", "kept", "terms", "counts")).withColumn("block", F.pmod(F.xxhash64("source"), F.lit(blocks)).cast("int"))
    vectors = resident(vectors, "lang", "chunk", "block")
    whole = terms.groupBy("lang", chunk.alias("chunk")).agg(F.collect_list(F.struct(place.alias("place"), F.col("n"))).alias("counts"))
    languages = _packed(chunks.join(whole, ["lang", "chunk"], "left").select("lang", F.lit(None).cast("string").alias("source"), "chunk", F.col("lang_total").alias("total"), "kept", "terms", "counts"))
    languages = stored(languages)
    found = stored(tournament(vectors, languages, blocks, top, chunk_terms))
    pairs = found.filter("other IS NOT NULL").groupBy("lang", "source", F.col("other").alias("item")).agg(F.sum("value").alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    heads = found.filter("other IS NULL").withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term_id"))).filter(F.col("rank") <= top)
    named = heads.join(terms.select("id", F.col("term").alias("item")), F.col("term_id") == F.col("id"))
    columns = ("lang", "source", "part", "item", "value", "rank")
    report = stored(pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(named.withColumn("part", F.lit("term")).select(*columns)))
    drop_stored(groups, kept, sorted_terms, vectors, languages, found)
    return report
