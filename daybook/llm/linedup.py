"""Line dedup by an exact set-similarity join, in DataFrame functions only.

A line is the set of its lower-cased words. Two lines match if the Jaccard
similarity of their sets is ``num/den`` or more. A line is removed if a line
before it, by document and line number, matches it, itself removed or not; so
the first line of every chain of matches stays.

Method: words are ordered from rare to frequent; two matching sets share a word
in their prefixes of ``size - ceil(size * num/den) + 1`` words. Prefixes are
joined on the word; pairs whose sizes differ too much (length filter), whose
place of the shared word leaves too few words to share (positional filter), or
whose 64-bit parity maps differ in too many places (each differing bit is a
word that only one has) are dropped, and the Jaccard similarity of the rest is
verified on the whole sets.

Rarity is the count, over all lines, of one of 2^16 counters to which words are
hashed, on a scale of 127 steps, then the word's hash: the counters are a table
of fixed size whatever the corpus, and any order that all lines share gives the
exact result. Words are compared by 56-bit hashes.

Lines with equal sets are joined once, by their first occurrence. A line that a
third of all documents hold is one row of the join; its occurrences meet one row
of results. Links are counted between different sets.

Groups of near-equal sets, whose pairs grow with the square, are counted without a
row for each pair: where two sets of a group differ from its middle in so few words
that they must match, their links are counted by that number of words. Only
the other pairs are joined and verified, so every link counts and none counts twice.
What is left of one group is a row for each link that is not certain: the words by which
sets differ from the middle ride along, and other pairs do not leave the join.

Sets are told apart by 64-bit hashes: among n different sets some n^2 / 2^65 pairs
are taken for equal. The rarity counters fill up in a corpus of more than 2^16 words;
frequent words still come last then, and only the order among rare ones is by chance.

Defined results: null and empty texts have no lines; blank lines never match and
stay; rows with one doc_id share their line positions; a null doc_id is last;
all columns of ``docs`` stay, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import drop_stored, plain_names, stored

COUNTER_BITS = 16
COUNTERS = 1 << COUNTER_BITS
HASH_MASK = (1 << 56) - 1
#: Low bits of a key that the join of prefixes leaves out; what is left keeps the order of keys.
JOIN_SHIFT = 23
#: Near-equal sets from which on a group counts its certain links together.
CROWD = 16
#: A set joins a group if it is apart from its middle by so many times the words by which two matching sets may be.
REACH = 1.5
#: Words from which on a set has a finer parity map: a map of 64 bits says little of more.
LONG_SET = 80
OTHER_SPACE = "\t\x0b\x0c\r"


def plain_spaces(text: Column) -> Column:
    """``text`` with other white space than newlines as single spaces; few texts hold any, and only those meet a regular expression."""
    others = reduce(lambda x, y: x | y, [F.contains(text, F.lit(ch)) for ch in OTHER_SPACE])
    return F.when(others, F.regexp_replace(text, f"[{OTHER_SPACE}]", " ")).otherwise(text)


def spots(docs: DataFrame) -> DataFrame:
    """``doc_id, line_no, line`` of every line with words of rows ``doc_id, text``, in lower case."""
    split = docs.select("doc_id", F.posexplode(F.split(F.lower(plain_spaces(F.col("text"))), "\n")).alias("line_no", "line"))
    # said of the line, not of its words: a filter on the words would find them twice
    return split.filter(F.btrim("line") != "")


def rarity_codes(docs: DataFrame) -> bytes:
    """For each counter a code from 0 (counted once at most) to 127, ordered by count of word occurrences."""
    words = F.split(F.replace(F.lower(plain_spaces(F.col("text"))), F.lit("\n"), F.lit(" ")), " ")
    hashed = docs.select(F.explode(words).alias("w")).select(F.xxhash64("w").bitwiseAND(F.lit(COUNTERS - 1)).alias("slot"))
    codes = bytearray(COUNTERS)
    for slot, n in hashed.groupBy("slot").count().toLocalIterator():
        codes[slot] = min(127, math.ceil(4 * math.log2(n)))
    return bytes(codes)


def word_keys(line: Column, codes: bytes) -> Column:
    """Sorted keys of the distinct words of a line from ``spots``, rare words first: the code in the upper 7 bits (below the sign), the hash below.

    Lambdas are interpreted, so they only hash and look up; distinct and sort stand outside, where they are compiled for longs.
    """
    lookup = F.split(F.lit(",".join(map(str, codes))), ",").cast("array<tinyint>")

    def key(h: Column) -> Column:
        code = F.coalesce(F.get(lookup, h.bitwiseAND(F.lit(COUNTERS - 1)).cast("int")), F.lit(0).cast("tinyint"))
        return F.shiftleft(code.cast("long"), 56).bitwiseOR(h.bitwiseAND(F.lit(HASH_MASK)))

    hashed = F.transform(F.split(line, " "), lambda w: F.xxhash64(w))
    return F.sort_array(F.array_remove(F.array_distinct(F.transform(hashed, key)), key(F.xxhash64(F.lit("")))))


def records(spotted: DataFrame, codes: bytes) -> DataFrame:
    """``doc_id, line_no, h, size, keys`` of rows of ``spots``; h stands for the set."""
    keyed = spotted.select("doc_id", "line_no", word_keys(F.col("line"), codes).alias("keys"))
    return keyed.select("doc_id", "line_no", F.xxhash64("keys").alias("h"), F.size("keys").alias("size"), "keys")


def parity_map(keys: Column) -> Column:
    return F.aggregate(keys, F.lit(0).cast("long"), lambda a, k: a.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), k.bitwiseAND(F.lit(63)).cast("int"))))


def finer_parity_map(keys: Column) -> Column:
    """Four parity maps, each of the words with two more bits alike."""
    return F.array(*[parity_map(F.filter(keys, lambda k: F.shiftright(k, 6).bitwiseAND(F.lit(3)) == j)) for j in range(4)])


def position() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "line_no")


def postings(sets: DataFrame) -> DataFrame:
    """A row per set and word of its prefix that is counted twice or more; words are told by fewer bits here.

    Rows of sets in groups have the words ``before`` theirs, so that their pairs are found at the first word shared only.
    """
    counted = F.filter("prefix", lambda k: F.shiftright(k, 56) > 0)
    told = sets.withColumn("words", F.transform(counted, lambda k: F.shiftright(k, JOIN_SHIFT)))
    # words that are not counted come first in a prefix
    skipped = F.size("prefix") - F.size("words")
    at_words = told.select("h", "size", "parity", "c", "v", "finer", "apart", "words", skipped.alias("skipped"), F.posexplode("words").alias("i", "word"))
    before = F.when(F.col("c") != 0, F.slice("words", F.lit(1), F.col("i")))
    return at_words.select("h", "size", "parity", "c", "v", "finer", "apart", (F.col("skipped") + F.col("i")).alias("at"), "word", before.alias("before"))


def candidates(held: DataFrame, num: int, den: int) -> DataFrame:
    """Distinct pairs ``a < b`` of sets that pass all filters and whose match is not certain by their group; those of one group match.

    The words of a prefix ascend, so a pair that shares an earlier word has met there, with the earlier place that the
    positional filter asks for; words told alike by mistake only make that filter milder.
    """
    x, y = (held.select("word", *[F.col(k).alias(f"{k}_{side}") for k in ("h", "size", "parity", "at", "c", "v", "finer", "before", "apart")]) for side in "ab")
    both = F.col("size_a") + F.col("size_b")
    length = (F.col("size_a") * den >= F.col("size_b") * num) & (F.col("size_b") * den >= F.col("size_a") * num)
    rest = F.least(F.col("size_a") - F.col("at_a"), F.col("size_b") - F.col("at_b"))
    positional = rest * (num + den) >= both * num
    few = lambda bits: bits * (num + den) <= both * (den - num)
    parity = few(F.bit_count(F.col("parity_a").bitwiseXOR(F.col("parity_b"))))
    finer = few(reduce(lambda p, q: p + q, [F.bit_count(F.get("finer_a", i).bitwiseXOR(F.get("finer_b", i))) for i in range(4)]))
    v, alike = F.col("v_a") + F.col("v_b"), F.size(F.array_intersect("apart_a", "apart_b"))
    open_ = (F.col("c_a") == 0) | (F.col("c_a") != F.col("c_b")) | ((v > 0) & (v <= 2 * (num + den) * alike))
    first = ~F.coalesce(F.arrays_overlap("before_a", "before_b"), F.lit(False))
    return x.join(y, "word").filter((F.col("h_a") < F.col("h_b")) & length & parity & positional & open_ & F.coalesce(finer, F.lit(True)) & first).select(F.col("h_a").alias("a"), F.col("h_b").alias("b")).distinct()


def among(rows: DataFrame, wanted: DataFrame, n_wanted: int, *columns: str) -> DataFrame:
    """The rows whose ``columns`` may be in ``wanted``, by a broadcast bit map of 16 bits for each, 2 MB at most."""
    n_bits = 1 << max(15, min(24, (16 * n_wanted).bit_length()))
    spot = F.pmod(F.xxhash64(*columns), F.lit(n_bits)) + 1
    bits = wanted.select(spot.alias("s")).groupBy(F.bitmap_bucket_number("s").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("bits"))
    at = F.bitmap_bit_position(spot)
    byte = F.conv(F.hex(F.substr("bits", (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    marked = rows.join(F.broadcast(bits), F.bitmap_bucket_number(spot) == F.col("bucket"))
    return marked.filter(F.pmod(F.floor(byte / F.pow(F.lit(2.0), at.bitwiseAND(F.lit(7)).cast("double"))), F.lit(2)) == 1).drop("bucket", "bits")


@dataclass(frozen=True)
class Prepared:
    """Occurrences ``doc_id, line_no, h``; ``sets`` (``h, first, size, parity, finer, prefix, n``); and what finds whole sets again."""

    occurrences: DataFrame
    sets: DataFrame
    docs: DataFrame
    codes: bytes
    num: int
    den: int

    def whole(self, wanted: DataFrame) -> DataFrame:
        """``h, first, keys`` of the sets in ``wanted`` (column ``h``), read again from their first lines."""
        places = stored(wanted.select("h").distinct().join(self.sets.select("h", "first"), "h").select("h", "first", F.col("first.doc_id").alias("doc_id"), F.col("first.line_no").alias("line_no")))
        n = places.count()
        lines = among(spots(among(self.docs, places, n, "doc_id")), places, n, "doc_id", "line_no")
        near = records(lines, self.codes).select("h", "doc_id", "line_no", "keys")
        at_first = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.line_no") == F.col("line_no"))
        return stored(near.join(places.select("h", "first"), "h").filter(at_first).select("h", "first", "keys").dropDuplicates(["h"]))

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Of the pairs ``a, b`` those that match on their whole sets; ``a_later, b_later``: whose first line is the later."""
        num, den = self.num, self.den
        whole = self.whole(pairs.select(F.explode(F.array("a", "b")).alias("h")))
        x, y = [whole.select(F.col("h").alias(c), F.col("first").alias(f"first_{c}"), F.col("keys").alias(f"keys_{c}")) for c in "ab"]
        shared = F.size(F.array_intersect("keys_a", "keys_b"))
        both = pairs.join(x, "a").join(y, "b").filter(shared * (num + den) >= (F.size("keys_a") + F.size("keys_b")) * num)
        return stored(both.select("a", "b", (F.col("first_b") < F.col("first_a")).alias("a_later"), (F.col("first_a") < F.col("first_b")).alias("b_later")))


def prepare(docs: DataFrame, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text") -> Prepared:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    codes = rarity_codes(rows)
    full = records(spots(rows), codes)
    prefix = F.slice("keys", F.lit(1), F.col("size") - F.ceil(F.col("size") * num / den).cast("int") + 1)
    finer = F.when(F.col("size") >= LONG_SET, finer_parity_map(F.col("keys")))
    found = stored(full.select("doc_id", "line_no", "h", "size", parity_map(F.col("keys")).alias("parity"), finer.alias("finer"), prefix.alias("prefix")))
    # size, maps and prefix follow from h: they ride along with the first position
    least = found.groupBy("h").agg(F.min(F.struct(position().alias("first"), "size", "parity", "finer", "prefix")).alias("x"), F.count("*").alias("n"))
    sets = stored(least.select("h", "x.*", "n"))
    occurrences = stored(found.select("doc_id", "line_no", "h"))
    drop_stored(found)
    return Prepared(occurrences, sets, rows, codes, num, den)


def anchors(prefix: Column) -> Column:
    """For each of three orders at random, the first of a prefix's words that are counted often."""
    often = F.filter(prefix, lambda w: F.shiftright(w, 56) >= math.ceil(4 * math.log2(CROWD)))

    def first(k: int) -> Column:
        return F.array_min(F.transform(often, lambda w: F.xxhash64(w, F.lit(k))))

    return F.array_distinct(F.array(*map(first, range(3))))


def groups(prepared: Prepared) -> DataFrame:
    """``h, first, c, finer, v, apart``: sets in groups of ``CROWD`` or more near-equal ones; c stands for the words that most sets of the group hold.

    apart are the words that only one of the set and those words has, and v is ``(num + den) * d - (den - num) * size``, d
    their number: as two sets of a group differ in the sum of their d at most, they match for certain if their v add up
    to 0 or less, and otherwise if the sum is at most ``2 * (num + den)`` for each word that both are apart by.

    How sets come to their group is by estimates on parity maps and changes no result: sets with an
    anchor in common vote on each bit; the one nearest to the majority is the anchor's middle, and a set takes that of
    its middles which most sets are near to. Then all sets that share a word of their prefix with the middle of a large group
    and may be within ``REACH`` of it join the group. Groups with the same common words are one.
    """
    sets, num, den = prepared.sets, prepared.num, prepared.den
    # kept, as it is read for the counts and for the rows
    marked = stored(sets.select("h", "size", "parity", anchors(F.col("prefix")).alias("anchors")))
    tagged = marked.select("h", "size", "parity", F.explode("anchors").alias("anchor")).filter("anchor IS NOT NULL")
    crowded = tagged.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") >= CROWD).select("anchor")
    tagged = stored(tagged.join(crowded, "anchor"))
    drop_stored(marked)
    bit = lambda i: F.lit(1 << i if i < 63 else -(1 << 63))
    votes = tagged.groupBy("anchor").agg(*[F.sum(F.when(F.col("parity").bitwiseAND(bit(i)) != 0, 1).otherwise(-1)).alias(f"b{i}") for i in range(64)])
    majority = votes.select("anchor", reduce(lambda x, y: x.bitwiseOR(y), [F.when(F.col(f"b{i}") > 0, bit(i)).otherwise(F.lit(0)) for i in range(64)]).alias("majority"))
    apart = F.bit_count(F.col("parity").bitwiseXOR(F.col("majority")))
    near = stored(tagged.join(majority, "anchor").select("anchor", "h", "size", "parity", apart.alias("apart")).filter(F.col("apart") * (num + den) <= 2 * (den - num) * F.col("size")))
    middles = near.groupBy("anchor").agg(F.min(F.struct("apart", "h", "size", "parity")).alias("m"), F.count("*").alias("weight")).filter(F.col("weight") >= CROWD)
    middles = middles.select("anchor", "weight", F.col("m.h").alias("c"), F.col("m.size").alias("c_size"), F.col("m.parity").alias("c_parity"))
    likely = F.bit_count(F.col("parity").bitwiseXOR(F.col("c_parity"))) * (num + den) <= (den - num) * (F.col("size") + F.col("c_size"))
    chosen = stored(near.join(middles, "anchor").filter(likely).groupBy("h").agg(F.max(F.struct("weight", "c")).alias("x")).select("h", "x.c"))
    # a middle may itself be nearer to a larger group: its sets follow it
    follow = chosen.select(F.col("h").alias("c"), F.col("c").alias("to"))
    led = chosen.join(follow, "c", "left").select("h", F.coalesce("to", "c").alias("c"))
    large = led.groupBy("c").agg(F.count("*").alias("weight")).filter(F.col("weight") >= CROWD)
    centres = stored(sets.withColumnRenamed("h", "c").join(large, "c").select("c", "weight", *[F.col(k).alias(f"c_{k}") for k in ("size", "parity", "finer")], F.explode("prefix").alias("word")))
    shared = among(sets.select("h", "size", "parity", "finer", F.explode("prefix").alias("word")), centres, centres.count(), "word").join(centres, "word")
    both = F.col("size") + F.col("c_size")
    reached = lambda apart: apart * (num + den) <= REACH * (den - num) * both
    finely = reached(reduce(lambda p, q: p + q, [F.bit_count(F.get("finer", i).bitwiseXOR(F.get("c_finer", i))) for i in range(4)]))
    may = reached(F.abs(F.col("size") - F.col("c_size"))) & reached(F.bit_count(F.col("parity").bitwiseXOR(F.col("c_parity")))) & F.coalesce(finely, F.lit(True))
    joined = stored(shared.filter(may).groupBy("h").agg(F.max(F.struct(likely.alias("likely"), "weight", "c")).alias("x")).select("h", "x.c"))
    members = joined.join(joined.groupBy("c").agg(F.count("*").alias("n")).filter(F.col("n") >= CROWD), "c")
    whole = prepared.whole(members)
    met = stored(members.join(whole, "h"))
    common = met.select("c", "n", F.explode("keys").alias("word")).groupBy("c", "n", "word").count().filter(2 * F.col("count") > F.col("n"))
    middle = common.groupBy("c").agg(F.array_sort(F.collect_list("word")).alias("words"))
    apart = F.concat(F.array_except("keys", "words"), F.array_except("words", "keys"))
    placed = met.join(middle, "c").select("h", "first", "words", "keys", apart.alias("apart")).filter(F.size("apart") * (num + den) <= REACH * (den - num) * (F.size("keys") + F.size("words")))
    v = (num + den) * F.size("apart") - (den - num) * F.size("keys")
    out = stored(placed.select("h", "first", F.xxhash64("words").alias("c"), finer_parity_map(F.col("keys")).alias("finer"), v.alias("v"), "apart"))
    drop_stored(tagged, near, chosen, centres, joined, whole, met)
    return out


def certain(grouped: DataFrame) -> DataFrame:
    """``h, n_links, later`` of sets in groups, by the links that are certain: counted by ``c, v``, without a row for each."""
    points = grouped.groupBy("c", "v").agg(F.count("*").alias("m"), F.min("first").alias("earliest"))
    rows = points.select("c", F.inline(F.array(
        F.struct(F.col("v").alias("x"), F.lit(0).alias("asks"), "v", "m", "earliest"),
        F.struct((-F.col("v")).alias("x"), F.lit(1).alias("asks"), "v", F.lit(0).cast("long").alias("m"), F.lit(None).cast(grouped.schema["first"].dataType).alias("earliest")),
    )))
    upto = Window.partitionBy("c").orderBy("x", "asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = rows.withColumns({"n_near": F.sum("m").over(upto), "leader": F.min("earliest").over(upto)}).filter("asks = 1").select("c", "v", "n_near", "leader")
    own = F.when(F.col("v") <= 0, 1).otherwise(0)
    return grouped.join(reached, ["c", "v"]).select("h", (F.col("n_near") - own).alias("n_links"), F.coalesce(F.col("leader") < F.col("first"), F.lit(False)).alias("later"))


def fates(prepared: Prepared) -> DataFrame:
    """``h, n_links, later`` of every set that matches another: with how many, and whether one of them is earlier."""
    grouped = groups(prepared)
    in_group = grouped.select("h", "c", "v", F.col("finer").alias("of_member"), "apart")
    placed = prepared.sets.join(in_group, "h", "left").select("h", "size", "parity", "prefix", F.coalesce("of_member", "finer").alias("finer"), F.coalesce("c", F.lit(0)).alias("c"), F.coalesce("v", F.lit(0)).alias("v"), "apart")
    pairs = stored(candidates(postings(placed), prepared.num, prepared.den))
    found = prepared.verified(pairs)
    drop_stored(pairs)
    one = F.lit(1).cast("long").alias("n_links")
    ends = found.select(F.col("a").alias("h"), one, F.col("a_later").alias("later")).union(found.select("b", one, "b_later"))
    return ends.union(certain(grouped)).groupBy("h").agg(F.sum("n_links").alias("n_links"), F.max("later").alias("later")).filter("n_links > 0")


def decisions(docs: DataFrame, num: int = 4, den: int = 5, **columns: str) -> DataFrame:
    """Per document with words: ``doc_id, n_lines, n_links, removed`` (line numbers, ascending)."""
    prepared = prepare(docs, num, den, **columns)
    fate = prepared.sets.select("h", "first", "n").join(fates(prepared), "h", "left").filter("n > 1 OR n_links > 0").select("h", "first", F.coalesce("later", F.lit(False)).alias("later"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    seen = prepared.occurrences.join(fate, "h", "left")
    gone = F.coalesce(F.col("later") | (position() > F.col("first")), F.lit(False))
    removed = F.array_sort(F.collect_list(F.when(gone, F.col("line_no"))))
    return seen.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.coalesce(F.sum("n_links"), F.lit(0)).alias("n_links"), removed.alias("removed"))


def report(docs: DataFrame, num: int = 4, den: int = 5) -> DataFrame:
    """A row per document: lines with words, links to lines of other words, lines removed."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    found = decisions(docs, num, den).withColumnRenamed("doc_id", "d")
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("d")), "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return joined.select(
        "doc_id", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.size(removed).cast("long").alias("n_removed"), F.array_join(removed.cast("array<string>"), ",").alias("removed_lines"),
    )


def without_repeats(docs: DataFrame, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the removed lines cut out of the text column; all rows and columns stay."""
    found = decisions(docs, num, den, id_col=id_col, text_col=text_col).filter(F.size("removed") > 0)
    plain, names = plain_names(docs)
    text = F.col(names[text_col])
    joined = plain.join(found.select(F.col("doc_id").alias("cut_doc"), "removed"), F.col(names[id_col]).cast("long").eqNullSafe(F.col("cut_doc")), "left")
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains("removed", i)), "\n")
    cut = F.when(F.col("removed").isNull(), text).otherwise(kept)
    return joined.select(*[(cut if c == text_col else F.col(x)).alias(c) for c, x in names.items()])
