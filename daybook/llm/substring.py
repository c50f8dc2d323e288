"""Substring dedup by content-defined chunking with a gear rolling hash.

A byte's gear hash is the sum of a table entry for each of the last 16 bytes,
shifted by age. A chunk ends where the hash has zeros under a mask (and the next
byte starts a character), at ``MIN_BYTES`` at least and ``MAX_BYTES`` at most, so
boundaries depend on near-by content and an insertion moves only the chunks
around it. Chunks are compared by a 128-bit digest. The first occurrence of a
chunk, by document and position, stays; later ones are repeats.

Repeats of one document that touch are joined into runs; a run of fewer than
``min_run`` bytes is left alone, so common short phrases are no passages. A
passage that recurs loses at most the chunks cut at its two ends.

A digest that a third of all chunks share is counted by partial aggregation
and its rows are joined with one row, in parts where they are many.

Defined results: null and empty texts have no chunks; rows with one doc_id count
as one document (their chunks repeat each other only by position); a null doc_id
comes last; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from daybook.llm.common import plain_names, stored

MIN_BYTES = 24
MAX_BYTES = 256
#: Zeros asked for under the mask, on bits that depend on the last 10 to 15 bytes.
MASK = np.uint32(0b11111 << 10)
MIN_RUN = 100
GEAR = np.frombuffer(b"".join(hashlib.sha256(bytes([i])).digest()[:4] for i in range(256)), dtype="<u4").copy()
CHUNK = StructType([StructField("doc_id", LongType()), StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("digest", BinaryType())])


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The gear hash at every byte, over a window of 16 bytes, by doubling."""
    h = GEAR[data]
    for shift in (1, 2, 4, 8):
        older = np.zeros_like(h)
        older[shift:] = h[:-shift] << np.uint32(shift)
        h = h + older
    return h


def chunk_ends(raw: bytes) -> list[int]:
    """Ends of the chunks of a text, the last at its end."""
    n = len(raw)
    if not n:
        return []
    data = np.frombuffer(raw, dtype=np.uint8)
    starts_char = np.ones(n + 1, dtype=bool)
    starts_char[:n] = (data & 0xC0) != 0x80
    natural = (np.flatnonzero(((gear_hashes(data) & MASK) == 0) & starts_char[1:]) + 1).tolist()
    ends, last = [], 0
    for cut in [*natural, n]:
        while cut - last > MAX_BYTES:
            last += MAX_BYTES
            while not starts_char[last]:
                last -= 1
            ends.append(last)
        if cut - last >= MIN_BYTES or (cut == n and cut > last):
            ends.append(cut)
            last = cut
    return ends


def chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per chunk: ``doc_id, start, end`` (bytes of the UTF-8 text) and ``digest``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, starts, ends, digests = [], [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw, a = (text.as_py() or "").encode(), 0
                for b in chunk_ends(raw):
                    ids.append(key)
                    starts.append(a)
                    ends.append(b)
                    digests.append(hashlib.blake2b(raw[a:b], digest_size=16).digest())
                    a = b
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(digests, pa.binary())], names=CHUNK.names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, CHUNK)


def repeats(table: DataFrame) -> DataFrame:
    """Later occurrences of chunks: ``doc_id, start, end, first_doc_id`` with the document of the first."""
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "start")
    firsts = table.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    later = table.join(firsts, "digest").filter(order > F.col("first"))
    return later.select("doc_id", "start", "end", F.col("first.doc_id").alias("first_doc_id"))


def passages(docs: DataFrame, min_run: int = MIN_RUN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per repeated run: ``doc_id, start_byte, end_byte, n_bytes, n_chunks, first_doc_id``.

    ``first_doc_id`` holds the first occurrence of the run's first chunk.
    """
    later = repeats(stored(chunks(docs, id_col, text_col)))
    order = Window.partitionBy("doc_id").orderBy("start", "end", "first_doc_id")
    begins = F.when(F.lag("end").over(order) == F.col("start"), 0).otherwise(1)
    runs = later.withColumn("begins", begins).withColumn("run", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # sorted by document and run already: the first chunk of a run is told by its start
    flat = runs.groupBy("doc_id", "run").agg(
        F.min("start").alias("start_byte"), F.max("end").alias("end_byte"), F.count("*").cast("int").alias("n_chunks"), F.max(F.when(F.col("begins") == 1, F.col("first_doc_id"))).alias("first_doc_id")
    )
    return flat.withColumn("n_bytes", F.col("end_byte") - F.col("start_byte")).filter(F.col("n_bytes") >= min_run).select("doc_id", "start_byte", "end_byte", "n_bytes", "n_chunks", "first_doc_id")


def without_repeats(docs: DataFrame, min_run: int = MIN_RUN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated runs cut out of the text column; all rows and columns stay."""
    cuts = passages(docs, min_run, id_col, text_col).groupBy(F.col("doc_id").alias("cut_doc")).agg(F.array_sort(F.collect_list(F.struct("start_byte", "end_byte"))).alias("cuts"))
    plain, names = plain_names(docs)
    joined = plain.join(cuts, F.col(names[id_col]).cast("long").eqNullSafe(F.col("cut_doc")), "left")
    text = F.col(names[text_col])
    raw = F.encode(text, "UTF-8")
    edges = F.concat(F.array(F.lit(0)), F.flatten(F.transform("cuts", lambda c: F.array(c["start_byte"], c["end_byte"]))), F.array(F.octet_length(raw)))
    kept = F.transform(F.sequence(F.lit(0), (F.size(edges) / 2 - 1).cast("int")), lambda i: F.decode(F.substr(raw, F.get(edges, i * 2) + 1, F.get(edges, i * 2 + 1) - F.get(edges, i * 2)), "UTF-8"))
    cut = F.when(F.col("cuts").isNull(), text).otherwise(F.array_join(kept, ""))
    return joined.select(*[(cut if c == text_col else F.col(x)).alias(c) for c, x in names.items()])
