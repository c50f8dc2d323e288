"""Benchmark decontamination with one Aho-Corasick automaton.

Texts are normalised by lower-casing A-Z and taking runs of letters, digits and
non-ASCII characters as words. The automaton holds every window of ``window``
consecutive words of a benchmark item (the whole item if it has fewer), joined
and bracketed by spaces; a document is scanned once and each occurrence marks
its words, whose offsets in the original text are kept.

The automaton is held by every Python worker and its windows go out in a broadcast.
A benchmark of more than ``slice_bytes`` of text is dealt into slices, each with an
automaton of its own; the documents are read once a slice, only the rows that it
hits are written, and neither driver nor worker holds more than one slice.

Defined results: null or wordless texts have no words and no hits; items
without words never occur; equal windows of several items count for each;
a repeated document row gets a row each; other columns are not read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from daybook.llm.common import arrow_map, kept_by_worker, stored

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WINDOW = 10
#: Bytes of benchmark text whose windows are in one automaton; some 40 MB of a worker and as much of the driver a megabyte.
SLICE_BYTES = 8 << 20


def lowered(text: str | None) -> str:
    """A-Z in lower case: what that means for bytes of UTF-8, whose other characters hold no such byte."""
    return (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(lowered(text))


def words_with_offsets(text: str | None) -> tuple[list[str], list[int], list[int]]:
    """Normalised words with their start and end in the original (lower-casing keeps every offset)."""
    found = [(m.group(), m.start(), m.end()) for m in WORD.finditer(lowered(text))]
    return [w for w, _, _ in found], [a for _, a, _ in found], [b for _, _, b in found]


def item_windows(text: str | None, window: int) -> set[tuple[str, ...]]:
    words = words_of(text)
    if not words:
        return set()
    if len(words) <= window:
        return {tuple(words)}
    return {tuple(words[i : i + window]) for i in range(len(words) - window + 1)}


def build_automaton(windows: dict[tuple[str, ...], list[int]]):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for words, items in windows.items():
        automaton.add_word(f" {' '.join(words)} ", (len(words), items))
    automaton.make_automaton()
    return automaton


def scan(words: list[str], automaton) -> tuple[list[tuple[int, int]], set[int]]:
    """Word spans covered by any occurrence, merged, and the items that occur."""
    if not words or not len(automaton):
        return [], set()
    occurring = list(automaton.iter(f" {' '.join(words)} "))
    if not occurring:
        return [], set()
    # a word's place by the blank after it
    at, ends = 0, {}
    for i, w in enumerate(words):
        at += len(w) + 1
        ends[at] = i
    spans, items = [], set()
    for end, (n, ids) in occurring:
        last = ends[end]
        spans.append((last - n + 1, last + 1))
        items.update(ids)
    return merge_spans(spans), items


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def slices(benchmark: DataFrame, window: int, slice_bytes: int) -> list[dict[tuple[str, ...], list[int]]]:
    """The windows of the benchmark and their items; one dictionary at a time, each of items of some ``slice_bytes`` of text."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // slice_bytes))
    for k in range(n):
        windows: dict[tuple[str, ...], list[int]] = {}
        part = rows if n == 1 else rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        for item, text in part.toLocalIterator():
            for w in item_windows(text, window):
                windows.setdefault(w, []).append(item)
        yield windows


def scanner(docs: DataFrame, windows: dict[tuple[str, ...], list[int]]) -> Callable[[], object]:
    """What gives a worker its automaton of the windows."""
    key, shared = f"automaton {uuid.uuid4().hex}", docs.sparkSession.sparkContext.broadcast(windows)
    return lambda: kept_by_worker(key, lambda: build_automaton(shared.value))


SPAN = StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])
FOUND = StructType([
    StructField("doc_id", LongType()), StructField("n_words", LongType()), StructField("n_hit", LongType()),
    StructField("item_ids", ArrayType(LongType())), StructField("hit_spans", ArrayType(SPAN)), StructField("contaminated", BooleanType()),
])
FOUND_ARROW = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.bool_()]


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slice_bytes: int = SLICE_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, item_ids, hit_spans, contaminated``.

    ``hit_spans`` are character spans ``start, end`` of the original text.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    keyed, hits, before = rows.withColumn("of", F.xxhash64("text")), None, None
    for windows in slices(benchmark, window, slice_bytes):
        if before is not None:
            part = stored(_hits(keyed, before))
            hits = part if hits is None else hits.union(part)
        before = scanner(docs, windows)
    if hits is None:
        automaton = before
        return arrow_map(rows, lambda batch: _found(batch, automaton()), FOUND)
    # what a slice hits is small; a document's hits meet by its id and its text
    hits = hits.union(_hits(keyed, before))
    merged = hits.groupBy("doc_id", "of").agg(F.flatten(F.collect_set("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    joined = keyed.alias("x").join(merged.alias("y"), F.expr("x.doc_id <=> y.doc_id AND x.of = y.of"), "left").select("x.doc_id", "x.text", "y.spans", "y.items")
    return arrow_map(joined, _merged, FOUND)


def _row(text: str | None, n_words: int, spans: list[tuple[int, int]], items: list) -> tuple:
    if not spans:
        return n_words, 0, items, [], False
    _, starts, ends = words_with_offsets(text)
    return n_words, sum(b - a for a, b in spans), items, [{"start": starts[a], "end": ends[b - 1]} for a, b in spans], True


def _batch(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    return pa.record_batch([ids, *[pa.array(c, t) for c, t in zip(columns, FOUND_ARROW[1:], strict=True)]], names=FOUND.names)


def _found(batch: pa.RecordBatch, automaton) -> pa.RecordBatch:
    rows = []
    for text in batch.column(1):
        raw = text.as_py()
        words = words_of(raw)
        spans, items = scan(words, automaton)
        rows.append(_row(raw, len(words), spans, sorted(items, key=lambda v: (v is None, v))))
    return _batch(batch.column(0), rows)


PAIR = StructType([StructField("a", IntegerType()), StructField("b", IntegerType())])
WORD_SPANS = StructType([StructField("doc_id", LongType()), StructField("of", LongType()), StructField("spans", ArrayType(PAIR)), StructField("items", ArrayType(LongType()))])


def _hits(keyed: DataFrame, automaton: Callable[[], object]) -> DataFrame:
    return arrow_map(keyed, lambda batch: _word_spans(batch, automaton()), WORD_SPANS)


def _word_spans(batch: pa.RecordBatch, automaton) -> pa.RecordBatch:
    """The rows that one slice hits, with spans of words."""
    found = [scan(words_of(text.as_py()), automaton) for text in batch.column(1)]
    hit = pa.array([bool(spans) for spans, _ in found], pa.bool_())
    spans = pa.array([[{"a": a, "b": b} for a, b in spans] for spans, _ in found], pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))
    items = pa.array([list(items) for _, items in found], pa.list_(pa.int64()))
    return pa.record_batch([batch.column(0), batch.column(2), spans, items], names=WORD_SPANS.names).filter(hit)


def _merged(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = []
    for text, spans, items in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
        raw = text.as_py()
        rows.append(_row(raw, len(words_of(raw)), merge_spans([(s["a"], s["b"]) for s in spans or []]), items or []))
    return _batch(batch.column(0), rows)


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns of ``find``'s rows."""
    as_text = F.array_join(F.array_sort(F.transform(F.col("item_ids"), lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(as_text, 256).alias("items_sha256"), "contaminated")


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slice_bytes: int = SLICE_BYTES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs; all columns stay."""
    found = None
    for windows in slices(benchmark, window, slice_bytes):
        if found is not None:
            docs = stored(found)
        found = _without(docs, scanner(docs, windows), text_col)
    return found


def _without(docs: DataFrame, automaton: Callable[[], object], text_col: str) -> DataFrame:
    at = docs.columns.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array([not scan(words_of(t.as_py()), automaton())[0] for t in batch.column(at)], pa.bool_()))

    return arrow_map(docs, run, docs.schema)
