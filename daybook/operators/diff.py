"""Before/after comparison of two event sets keyed by uid."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions import text as T
from daybook.operators.dedupe import TITLE_VETO
from daybook.operators.similar import least_similarity
from daybook.sources.shared import kept

#: Words of titles that are alike by two shared words at most: 2 / (2 * SHORT - 2) is no less than TITLE_VETO.
SHORT = 7


def lost_and_gained(before: DataFrame, after: DataFrame) -> tuple[DataFrame, DataFrame]:
    return before.join(after, "uid", "left_anti"), after.join(before, "uid", "left_anti")


def renamed(lost: DataFrame, gained: DataFrame) -> DataFrame:
    """Lost rows with a gained twin of the same title and instant: a change of uid, no loss."""
    a = lost.select(F.col("uid").alias("old_uid"), "title", "instant")
    b = gained.select(F.col("uid").alias("new_uid"), "title", "instant")
    return a.join(b, ["title", "instant"])


def _shared(words: Column) -> Column:
    """What two titles may share, as text: each word, and each two words in order."""
    return F.concat(words, F.flatten(F.transform(words, lambda w, i: F.transform(F.slice(words, i + 2, SHORT), lambda v: F.concat_ws(" ", w, v)))))


def explanations(lost: DataFrame, after: DataFrame) -> DataFrame:
    """For each lost row the first surviving row that credits one of its sources and is like it, or shares its fuzzy key.

    Of surviving rows of one place, time and source only the first with each word, or two words, and number of words
    counts: two titles of up to ``SHORT`` words are alike if and only if one or two shared words are enough for their
    sizes. Only titles of more words meet each row of their place and time.
    """
    words = F.array_sort(T.title_tokens(F.col("title")))
    a = kept(lost.select(F.col("uid").alias("lost_uid"), "place_id", "instant", words.alias("lost_words"), F.col("sources").alias("lost_sources"), F.col("fuzzy").alias("lost_fuzzy")), "lost")
    b = kept(after.select(F.struct(F.col("ord").alias("kept_ord"), F.col("uid").alias("kept_uid")).alias("kept"), "place_id", "instant", words.alias("words"), "sources", "fuzzy"), "surviving")
    is_short = lambda c: F.coalesce(F.size(c) <= SHORT, F.lit(False))
    here = ["place_id", "instant", "source", "shared"]
    x = a.filter(is_short("lost_words")).select("lost_uid", "place_id", "instant", F.explode(F.array_distinct("lost_sources")).alias("source"), F.size("lost_words").alias("n_lost"), "lost_words")
    x = x.withColumn("shared", F.explode(_shared(F.col("lost_words")))).drop("lost_words")
    y = b.filter(is_short("words")).select("kept", "place_id", "instant", F.explode(F.array_distinct("sources")).alias("source"), F.size("words").alias("n_kept"), "words")
    firsts = y.withColumn("shared", F.explode(_shared(F.col("words")))).groupBy(*here, "n_kept").agg(F.min("kept").alias("kept"))
    n_shared = F.when(F.contains("shared", F.lit(" ")), 2).otherwise(1)
    by_words = x.join(firsts, here).filter(n_shared / (F.col("n_lost") + F.col("n_kept") - n_shared) >= TITLE_VETO).select("lost_uid", "kept")
    pairs = [a.filter(~is_short("lost_words")).join(b, ["place_id", "instant"]), a.filter(is_short("lost_words")).join(b.filter(~is_short("words")), ["place_id", "instant"])]
    alike = F.arrays_overlap("lost_sources", "sources") & (T.jaccard(F.col("lost_words"), F.col("words")) >= TITLE_VETO)
    by_place = reduce(DataFrame.union, [p.filter(alike).select("lost_uid", "kept") for p in pairs], by_words).groupBy("lost_uid").agg(F.min("kept").alias("at_place"))
    of_key = b.groupBy("fuzzy").agg(F.min("kept").alias("kept"))
    by_key = a.join(of_key, F.col("lost_fuzzy") == F.col("fuzzy")).groupBy("lost_uid").agg(F.min("kept").alias("of_key"))
    why = F.when(F.col("at_place").isNotNull(), "place").otherwise("key")
    return by_place.join(by_key, "lost_uid", "full").select("lost_uid", F.coalesce("at_place", "of_key")["kept_uid"].alias("kept_uid"), why.alias("why"))


def changed_fields(before: DataFrame, after: DataFrame, fields: list[str]) -> DataFrame:
    """``uid, field, old, new`` of every field that differs, nulls compared as values."""
    a = before.select("uid", *[F.col(f).cast("string").alias(f"a_{f}") for f in fields])
    b = after.select("uid", *[F.col(f).cast("string").alias(f"b_{f}") for f in fields])
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"a_{f}").alias("old"), F.col(f"b_{f}").alias("new")) for f in fields])
    return a.join(b, "uid").select("uid", F.inline(F.filter(rows, lambda r: ~r["old"].eqNullSafe(r["new"]))))


def risk_groups(events: DataFrame) -> DataFrame:
    """Provisional places with several rows at one instant: number of rows, least similarity, whether sources differ."""
    rows = events.filter(F.startswith(F.col("place_id"), F.lit("~"))).select("place_id", "instant", "uid", "source", T.title_tokens(F.col("title")).alias("t"))
    sizes = rows.groupBy("place_id", "instant").agg((F.countDistinct("source") > 1).alias("cross_source"))
    return least_similarity(rows, ["place_id", "instant"]).join(sizes, ["place_id", "instant"])


def is_failing(counts: dict[str, int], most_merges: int = 20) -> bool:
    return counts.get("unexplained", 0) > 0 or counts.get("gained", 0) > 0 or counts.get("renamed", 0) > 0 or counts.get("merged", 0) > most_merges
