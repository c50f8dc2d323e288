"""Periodic runs of words: maximal repetitions, found by Crochemore's partition refinement.

A run is a stretch of consecutive words with smallest period ``q`` that no
neighbouring word extends, of at least ``min_exponent`` periods and
``min_length`` words. Classes of positions at which equal factors of length
``p`` begin are refined from ``p`` to ``p + 1``: the members of a class part by
the class that follows them, and of the parts of a class only the smaller ones
(all but a largest) refine their neighbours in the next step, so a text of n
words costs O(n log n). Within a class members are linked in order of position;
neighbours at distance ``p`` mark a square whose root is no power, and a stretch
of such places is one run.

The steps are numpy operations over a slice of whole documents at once (some
``SLICE_WORDS`` words, one document at least); positions of different documents
are in different classes. Spark deals the documents; there is no shuffle. Rows of an Arrow batch come out in
order of length.

Defined results: null, empty and blank texts have no words and no runs; equal
texts have equal results; a repeated row gets a row each; an empty table gives
an empty result; a text of any length is one document of a slice; other columns
are not read by ``runs`` and ``digests`` and are kept by ``collapsed``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

MIN_EXPONENT, MIN_LENGTH = 4, 6
#: Words that are refined together in a Python worker, of at least one document.
SLICE_WORDS = 1_000_000

Words = list[bytes]


class Run(NamedTuple):
    start: int
    length: int
    period: int


def words_of(doc_id: int | None, text: bytes | None) -> Words:
    """Runs of anything but ASCII white space."""
    return (text or b"").split()


def starts_of(flags: np.ndarray) -> np.ndarray:
    """Places at which a value differs from the one before it; the first among them."""
    return np.concatenate(((0,), flags.nonzero()[0] + 1))


def sizes_of(starts: np.ndarray, end: int) -> np.ndarray:
    """Lengths of the stretches that begin at ``starts``, the last of which ends at ``end``."""
    return np.concatenate((starts[1:], (end,))) - starts


def ranges(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The whole numbers of all ranges, one after another."""
    ends = length.cumsum()
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - length), length)


class Partition:
    """Positions classed by the equal factors that begin at them; each class is a stretch of ``members``."""

    def __init__(self, classes: np.ndarray, cap: np.ndarray):
        n = len(classes)
        self.classes, self.cap = classes, cap
        self.members = np.argsort(classes, kind="stable").astype(np.int32)
        self.place = np.empty(n, np.int32)
        self.place[self.members] = np.arange(n, dtype=np.int32)
        of = classes[self.members]
        first = starts_of(of[1:] != of[:-1])
        self.count = len(first)
        self.first, self.size = np.zeros(n + 1, np.int32), np.zeros(n + 1, np.int32)
        self.first[of[first]], self.size[of[first]] = first, sizes_of(first, n)
        self.after, self.before = np.full(n, -1, np.int32), np.full(n, -1, np.int32)
        same = of[1:] == of[:-1]
        self.after[self.members[:-1][same]], self.before[self.members[1:][same]] = self.members[1:][same], self.members[:-1][same]
        self.moved = np.zeros(n, bool)
        #: By distance: positions whose next member stood so far off when it was set.
        self.waiting: dict[int, list[np.ndarray]] = defaultdict(list)
        self.wait((self.after >= 0).nonzero()[0], 1)

    def wait(self, at: np.ndarray, length: int) -> None:
        distance = self.after[at] - at
        keep = (distance >= length) & (distance <= self.cap[at])
        at, distance = at[keep], distance[keep]
        if len(at):
            order = np.argsort(distance, kind="stable")
            at, distance = at[order], distance[order]
            first = starts_of(distance[1:] != distance[:-1])
            for d, a, e in zip(distance[first].tolist(), first.tolist(), [*first[1:].tolist(), len(at)], strict=True):
                self.waiting[d].append(at[a:e])

    def squares(self, length: int) -> np.ndarray:
        """Positions, in order, at which a square of that period begins, once classes are those of factors of that length."""
        if length not in self.waiting:
            return np.empty(0, np.int32)
        at = np.concatenate(self.waiting.pop(length))
        at = np.sort(at[self.after[at] == at + length])
        return at[starts_of(at[1:] != at[:-1])] if len(at) else at

    def refine(self, small: np.ndarray, length: int) -> np.ndarray:
        """From factors of ``length - 1`` words to ``length``; takes and returns the positions in the smaller parts."""
        follow = np.sort(small[self.cap[small] >= length])
        at = follow - 1
        keep = (at >= 0) & (self.size[self.classes[at]] > 1)
        at, follow = at[keep], self.classes[follow[keep]]
        if not len(at):
            return at
        key = self.classes[at].astype(np.int64) << 32 | follow
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        group = starts_of(key[1:] != key[:-1])
        group_size, group_of = sizes_of(group, len(at)), key[group] >> 32
        parent = starts_of(group_of[1:] != group_of[:-1])
        groups, of = sizes_of(parent, len(group)), group_of[parent]
        rest = self.size[of] - np.add.reduceat(group_size, parent)
        split = (rest > 0) | (groups > 1)
        if not split.all():
            of_group = split.repeat(groups)
            at, group_size = at[of_group.repeat(group_size)], group_size[of_group]
            of, rest, groups = of[split], rest[split], groups[split]
            if not len(at):
                return at
        return self._part(at, group_size, of, rest, groups, length)

    def _part(self, at: np.ndarray, group_size: np.ndarray, of: np.ndarray, rest: np.ndarray, groups: np.ndarray, length: int) -> np.ndarray:
        """Make each group of ``at`` (by class, group, position) a class of its own; ``rest`` stay where they were."""
        parent = groups.cumsum() - groups
        parent_of = np.arange(len(of)).repeat(groups)
        moving = np.add.reduceat(group_size, parent)
        # a largest group of each class
        largest = np.lexsort((-group_size, parent_of))[parent]
        gone = rest == 0
        fresh = np.ones(len(group_size), bool)
        fresh[largest[gone]] = False
        names = fresh.cumsum() + (self.count - 1)
        self.count = int(names[-1]) + 1
        names[largest[gone]] = of[gone]
        self._unlink(at, of.repeat(moving), length)
        # a class's moving members take its last places, group by group
        base = self.first[of] + rest
        slots = ranges(base, moving)
        left = self.place[at]
        left = left[left < base.repeat(moving)]
        self.moved[at] = True
        staying = self.members[slots]
        staying = staying[~self.moved[staying]]
        self.moved[at] = False
        self.members[left], self.place[staying] = staying, left
        self.members[slots], self.place[at] = at, slots
        group = group_size.cumsum() - group_size
        self.size[of] = rest
        self.first[names], self.size[names] = slots[group], group_size
        self.classes[at] = names.repeat(group_size)
        self._link(at, group, length)
        # of the parts of a class, all but a largest one
        by_rest = rest >= group_size[largest]
        small = np.ones(len(group_size), bool)
        small[largest[~by_rest]] = False
        remain = ~by_rest & (rest > 0)
        return np.concatenate((at[small.repeat(group_size)], self.members[ranges(self.first[of[remain]], rest[remain])]))

    def _unlink(self, at: np.ndarray, of: np.ndarray, length: int) -> None:
        """Take ``at`` out of their classes' chains: what stands before a stretch of them is followed by what stands after it."""
        self.moved[at] = True
        before, after = self.before[at], self.after[at]
        # an index of -1 reads the last position, which is an end mark and never moves
        begins, ends = ~self.moved[before], ~self.moved[after]
        self.moved[at] = False
        of = of.astype(np.int64) << 32
        begin, end = np.sort(of[begins] | at[begins]) & 0xFFFFFFFF, np.sort(of[ends] | at[ends]) & 0xFFFFFFFF
        before, after = self.before[begin], self.after[end]
        self.before[after[after >= 0]], self.after[before[before >= 0]] = before[after >= 0], after[before >= 0]
        self.wait(before[(before >= 0) & (after >= 0)], length)

    def _link(self, at: np.ndarray, group: np.ndarray, length: int) -> None:
        after, before = np.full(len(at), -1, np.int32), np.full(len(at), -1, np.int32)
        after[:-1], before[1:] = at[1:], at[:-1]
        after[group[1:] - 1] = -1
        before[group] = -1
        changed = (after != self.after[at]) & (after >= 0)
        self.after[at], self.before[at] = after, before
        self.wait(at[changed], length)


def find_runs(texts: list[Words], min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> list[list[Run]]:
    """Each text's runs by start, then period."""
    found: list[list[Run]] = [[] for _ in texts]
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths + 1)  # an end mark stands behind each text
    first = ends - lengths - 1
    classes, used = np.empty(int(ends[-1]) if len(ends) else 0, np.int32), 0
    for a, e, words in zip(first.tolist(), ends.tolist(), texts, strict=True):
        names: dict[bytes, int] = {}
        for w in words:
            if w not in names:
                names[w] = used + len(names)
        classes[a : e - 1] = [names[w] for w in words]
        used += len(names) + 1
        classes[e - 1] = used - 1
    if not len(classes):
        return found
    cap = np.repeat(lengths // min_exponent, lengths + 1).astype(np.int32)
    parts = Partition(classes, cap)
    small, length = np.arange(len(classes), dtype=np.int32), 1
    while True:
        at = parts.squares(length)
        if len(at):
            begin = starts_of(at[1:] - at[:-1] != 1)
            for a, places in zip(at[begin].tolist(), sizes_of(begin, len(at)).tolist(), strict=True):
                size = places - 1 + 2 * length
                if size >= max(min_length, min_exponent * length):
                    doc = int(np.searchsorted(ends, a, side="right"))
                    found[doc].append(Run(a - int(first[doc]), size, length))
        if not parts.waiting:
            break
        # once no class parts any more, classes are what they are for all lengths to come
        length = length + 1 if len(small) else min(parts.waiting)
        if len(small):
            small = parts.refine(small, length)
    for runs in found:
        runs.sort(key=lambda r: (r.start, r.period))
    return found


def strongest(runs: list[Run]) -> Run | None:
    """That of the greatest exponent; of equal ones the first, then that of the smaller period."""
    return min(runs, key=lambda r: (-Fraction(r.length, r.period), r.start, r.period), default=None)


def without_repeats(words: Words, runs: list[Run]) -> Words:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    for r in runs:
        drop[r.start + r.period] += 1
        drop[r.start + r.length] -= 1
    return [w for w, d in zip(words, np.cumsum(drop).tolist(), strict=False) if not d]


def _map(df: DataFrame, schema: StructType, words: Callable[[int | None, bytes | None], Words], make: Callable, id_at: int, text_at: int, min_exponent: int, min_length: int, slice_words: int) -> DataFrame:
    """``make(batch, texts, runs)`` over slices of whole rows of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # a slice takes as many steps as its longest text needs: texts of like length go together
            batch = batch.take(pc.sort_indices(pc.fill_null(pc.binary_length(batch.column(text_at)), 0)))
            begin, texts, size = 0, [], 0
            ids = batch.column(id_at)
            for i, text in enumerate(batch.column(text_at).cast(pa.binary())):
                texts.append(words(ids[i].as_py(), text.as_py()))
                size += len(texts[-1])
                if size >= slice_words or i + 1 == batch.num_rows:
                    yield make(batch.slice(begin, len(texts)), texts, find_runs(texts, min_exponent, min_length))
                    begin, texts, size = i + 1, [], 0

    return df.mapInArrow(run, schema)


RUNS = ArrayType(StructType([StructField(n, LongType()) for n in Run._fields]))


def runs(docs: DataFrame, min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH, slice_words: int = SLICE_WORDS) -> DataFrame:
    """Per document: ``doc_id`` and its ``runs`` (start, length, period; words numbered from 0) by start, then period."""
    schema = StructType([StructField("doc_id", LongType()), StructField("runs", RUNS)])
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in Run._fields]))

    def make(batch: pa.RecordBatch, texts: list[Words], found: list[list[Run]]) -> pa.RecordBatch:
        return pa.record_batch([batch.column(0), pa.array([[r._asdict() for r in rs] for rs in found], kind)], names=schema.names)

    return _map(docs.select(F.col("doc_id").cast("long"), "text"), schema, words_of, make, 0, 1, min_exponent, min_length, slice_words)


def collapsed(docs: DataFrame, min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH, slice_words: int = SLICE_WORDS) -> DataFrame:
    """``docs`` with each text's runs cut to their first period. A text without runs stays as it is, white space included."""
    text_at = docs.columns.index("text")

    def make(batch: pa.RecordBatch, texts: list[Words], found: list[list[Run]]) -> pa.RecordBatch:
        old = batch.column(text_at).to_pylist()
        new = [b" ".join(without_repeats(t, rs)).decode() if rs else o for o, t, rs in zip(old, texts, found, strict=True)]
        return batch.set_column(text_at, batch.schema.field(text_at), pa.array(new, batch.schema.field(text_at).type))

    return _map(docs, docs.schema, words_of, make, text_at, text_at, min_exponent, min_length, slice_words)


DIGESTS = StructType([StructField(n, LongType()) for n in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli")] + [StructField(n, StringType()) for n in ("runs_sha256", "collapsed_sha256")])


def digests(docs: DataFrame, words: Callable[[int | None, bytes | None], Words] = words_of, min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH, slice_words: int = SLICE_WORDS) -> DataFrame:
    """Per document: the number of runs, the strongest one, and digests of all runs and of the words that are left.

    ``words`` makes the words of a doc_id and a text in UTF-8.
    """

    def make(batch: pa.RecordBatch, texts: list[Words], found: list[list[Run]]) -> pa.RecordBatch:
        best = [strongest(rs) for rs in found]
        listed = [hashlib.sha256("".join(f"{r.start},{r.length},{r.period}\n" for r in rs).encode()).hexdigest() for rs in found]
        kept = [hashlib.sha256(b" ".join(without_repeats(t, rs))).hexdigest() for t, rs in zip(texts, found, strict=True)]
        whole = lambda of: pa.array([of(b) if b else None for b in best], pa.int64())
        columns = [batch.column(0), pa.array([len(rs) for rs in found], pa.int64()), whole(lambda b: b.start), whole(lambda b: b.length), whole(lambda b: b.period), whole(lambda b: 1000 * b.length // b.period)]
        return pa.record_batch([*columns, pa.array(listed), pa.array(kept)], names=DIGESTS.names)

    return _map(docs.select(F.col("doc_id").cast("long"), "text"), DIGESTS, words, make, 0, 1, min_exponent, min_length, slice_words)


def periodic_tenth(doc_id: int | None, text: bytes | None) -> Words:
    """A text's words; of documents chosen by the checksum of their ids the end repeats a stretch of words."""
    words = words_of(doc_id, text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    stretch = words[a : a + p]
    return words[:a] + (stretch * ((n - a) // p + 1))[: n - a]
