"""Entity matching: tiered best match over an inverted index of words, containment pairs, segment joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions import text as T
from daybook.sources.shared import kept

#: Below this a match is weak, and later gazetteers are tried.
STRONG = 0.5


def tokens(name):
    return F.array_distinct(F.filter(F.split(T.venue_key(name), " "), lambda w: w != ""))


def is_acronym(short, long_tokens):
    """2 to 6 letters that stand in the initials of the other name."""
    initials = F.array_join(F.transform(long_tokens, lambda w: F.substring(w, 1, 1)), "")
    return short.rlike("^[a-z]{2,6}$") & F.contains(initials, short)


def best_matches(targets: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """``target, candidate, tier, score, tied`` per target: largest Jaccard of words over all candidates that share one.

    targets: ``target, name``; gazetteer: ``candidate, name, tier``. Scores of all tiers compete; an equal best score
    anywhere is a tie, of which the first by tier and candidate is given.

    Names of equal words are one. Words go by rarity in the gazetteer, so what two names share is met at its rarest word
    first; there a candidate is opened only if the words left in both could still reach a score that some candidate is
    known to have: at first that of the shortest name with one of the target's words, then the best one that shares its
    rarest word. A word that most names hold is the last of each and opens almost none.
    """
    ask = targets.select("target", F.array_sort(tokens(F.col("name"))).alias("tx"))
    give = gazetteer.select("candidate", "tier", F.array_sort(tokens(F.col("name"))).alias("ty")).groupBy("ty").agg(F.min(F.struct("tier", "candidate")).alias("first"), F.count("*").alias("alike"))
    give = kept(give.filter(F.size("ty") > 0), "names")
    words = give.select("ty", F.explode("ty").alias("w"))
    known = words.groupBy("w").agg(F.count("*").alias("df"), F.min(F.size("ty")).alias("shortest"))
    by_rarity = lambda side: Window.partitionBy(side).orderBy("df", "w")
    y = words.join(known.drop("shortest"), "w").withColumn("at_y", F.row_number().over(by_rarity("ty"))).select("w", "ty", "at_y")
    x = ask.select("tx").distinct().withColumn("w", F.explode("tx")).join(known, "w").withColumn("at_x", F.row_number().over(by_rarity("tx")))
    whole = Window.partitionBy("tx")
    x = kept(x.withColumns({"known": F.count("*").over(whole), "floor": F.max(1 / (F.size("tx") + F.col("shortest") - 1)).over(whole)}).select("tx", "w", "at_x", "known", "floor"), "asked")

    def opened(side: DataFrame) -> DataFrame:
        left = F.least(F.col("known") - F.col("at_x") + 1, F.size("ty") - F.col("at_y") + 1)
        pairs = side.join(y, "w").filter(left >= (F.size("tx") + F.size("ty") - left) * F.col("floor") - 1e-9).select("tx", "ty").distinct()
        return pairs.withColumn("score", T.jaccard(F.col("tx"), F.col("ty")))

    rarest = kept(opened(x.filter("at_x = 1")), "opened")
    better = x.filter("at_x > 1").join(rarest.groupBy("tx").agg(F.max("score").alias("best")), "tx", "left").withColumn("floor", F.greatest("floor", "best"))
    scored = rarest.unionByName(opened(better)).distinct()
    top = scored.withColumn("top", F.max("score").over(whole)).filter("score = top").join(give, "ty")
    best = top.groupBy("tx", "score").agg(F.min("first").alias("first"), F.sum("alike").alias("n_top"))
    return ask.join(best, "tx").select("target", F.col("first.candidate").alias("candidate"), F.col("first.tier").alias("tier"), "score", (F.col("n_top") > 1).alias("tied"))


def tiered_matches(targets: DataFrame, gazetteer: DataFrame, tiers: list[tuple[str, bool, tuple[float, float, float, float]]]) -> DataFrame:
    """``target, candidate, tier, score, tied`` by gazetteers in turn, of those that have any match.

    targets: ``target, name, is_local``; gazetteer: ``candidate, name, tier, lat, lon, closed``. ``tiers`` lists the
    gazetteers by name, whether each serves local targets only, and its box (south, west, north, east). A later one is
    tried while the best score is below ``STRONG`` and wins by a larger score only; an equal score in any tier tried is
    a tie. An acronym scores 0.9. A winner outside its tier's box is dropped, and the target starts afresh with the next
    tier. Closed candidates never compete; of equal ones the first by id wins.
    """
    a = targets.select("target", "is_local", tokens(F.col("name")).alias("ta"), T.venue_key(F.col("name")).alias("short"))
    open_ = gazetteer.filter(~F.coalesce("closed", F.lit(False)))
    b = open_.select("candidate", "tier", "lat", "lon", tokens(F.col("name")).alias("tb")).withColumn("initials", F.array_join(F.transform("tb", lambda w: F.left(w, F.lit(1))), ""))
    # a pair is met at the first word that both have
    by_word = a.withColumn("w", F.explode("ta")).join(b.withColumn("w", F.explode("tb")), "w").filter(F.col("w") == F.get(F.array_intersect("ta", "tb"), 0)).drop("w")
    # an acronym stands in the initials of a name: its windows of two to six letters are the key
    windows = F.explode(F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(2), F.lit(6)), lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.length("initials") - n + 1, F.lit(1))), lambda i: F.substr("initials", i, n))))))
    by_initials = a.filter(F.col("short").rlike("^[a-z]{2,6}$")).join(b.withColumn("short", windows), "short").filter(~F.arrays_overlap("ta", "tb")).select(*by_word.columns)
    both = F.size(F.array_intersect("ta", "tb"))
    jaccard = both / (F.size("ta") + F.size("tb") - both)
    score = F.greatest(jaccard, F.when(is_acronym(F.col("short"), F.col("tb")), 0.9).otherwise(0.0))
    scored = by_word.union(by_initials).select("target", "tier", "candidate", "lat", "lon", score.alias("top"))
    # a row for each target, tier and score: the best of each tier is all that the turns below read
    offers = scored.groupBy("target", "tier", "top").agg(F.min(F.struct("candidate", "lat", "lon")).alias("x"), F.count_distinct(F.struct("candidate", "lat", "lon")).alias("n_top"))
    best = offers.groupBy("target", "tier").agg(F.max(F.struct("top", "x", "n_top")).alias("best"))
    best = kept(best.select("target", "tier", "best.top", "best.x", "best.n_top"), "offers")
    held = targets.select("target", F.coalesce("is_local", F.lit(False)).alias("is_local")).withColumns({"candidate": F.lit(None).cast(gazetteer.schema["candidate"].dataType), "best_tier": F.lit(None).cast("string"), "best": F.lit(0.0), "n_best": F.lit(0).cast("long")})
    for name, local_only, (south, west, north, east) in tiers:
        offer = best.filter(F.col("tier") == name).select("target", "top", "x", "n_top")
        met = held.join(offer, "target", "left")
        tried = (F.col("best") < STRONG) & F.col("top").isNotNull() & (F.col("is_local") | F.lit(not local_only))
        better = F.coalesce(tried & (F.col("top") > F.col("best")), F.lit(False))
        level = F.coalesce(tried & (F.col("top") == F.col("best")), F.lit(False))
        outside = better & ~F.coalesce(F.col("x.lat").between(south, north) & F.col("x.lon").between(west, east), F.lit(False))
        held = met.select(
            "target", "is_local", F.when(outside, F.lit(None)).when(better, F.col("x.candidate")).otherwise(F.col("candidate")).alias("candidate"), F.when(outside, F.lit(None)).when(better, F.lit(name)).otherwise(F.col("best_tier")).alias("best_tier"),
            F.when(outside, 0.0).when(better, F.col("top")).otherwise(F.col("best")).alias("best"), F.when(outside, 0).when(better, F.col("n_top")).when(level, F.col("n_best") + F.col("n_top")).otherwise(F.col("n_best")).cast("long").alias("n_best"),
        )
    return held.filter("candidate IS NOT NULL").select("target", "candidate", F.col("best_tier").alias("tier"), F.col("best").alias("score"), (F.col("n_best") > 1).alias("tied"))


def verdict(score, tied):
    return F.when(score.isNull(), "none").when((score >= STRONG) & ~tied, "strong").otherwise("weak")


def containment_pairs(ids: DataFrame) -> DataFrame:
    """Pairs of ``id`` whose words are equal, or contained with two words at least in the smaller."""
    t = ids.select("id", tokens(F.col("id")).alias("t")).filter(F.size("t") > 0)
    # the rarest word of the smaller set is in the larger one
    freq = t.select(F.explode("t").alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    words = t.withColumn("w", F.explode("t")).join(freq, "w")
    rare = words.groupBy("id").agg(F.min(F.struct("n", "w")).alias("r")).select("id", F.col("r.w").alias("w"))
    small = t.join(rare, "id").select(F.col("id").alias("a"), F.col("t").alias("ta"), "w")
    large = words.select(F.col("id").alias("b"), F.col("t").alias("tb"), "w")
    inside = (F.size(F.array_except("ta", "tb")) == 0) & ((F.size("ta") >= 2) | (F.size("ta") == F.size("tb")))
    found = small.join(large, "w").filter((F.col("a") != F.col("b")) & inside)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def segment_matches(left: DataFrame, right: DataFrame) -> DataFrame:
    """``left_id, right_ids, how``: exact join on the normalised whole name, else on any part between slashes."""
    names = right.select("right_id", T.join_norm(F.col("name")).alias("k")).distinct()
    whole = left.select("left_id", T.join_norm(F.col("name")).alias("k"), F.lit(0).alias("how"))
    parts = left.select("left_id", F.explode(F.split("name", "/")).alias("p")).select("left_id", T.join_norm(F.col("p")).alias("k"), F.lit(1).alias("how"))
    hits = whole.union(parts).join(names, "k").withColumn("least", F.min("how").over(Window.partitionBy("left_id"))).filter("how = least")
    sets = hits.groupBy("left_id").agg(F.array_sort(F.collect_set("right_id")).alias("right_ids"), F.min("how").alias("how"))
    return left.select("left_id").join(sets, "left_id", "left").withColumn("how", F.when(F.col("how") == 0, "whole").when(F.col("how") == 1, "segment").otherwise("none"))


def spelling_clusters(venues: DataFrame) -> DataFrame:
    """``key, n, variants`` (spelling to count) for rows ``venue``."""
    keyed = venues.groupBy(T.venue_key(F.col("venue")).alias("key"), "venue").agg(F.count("*").alias("n"))
    return keyed.groupBy("key").agg(F.sum("n").alias("n"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("venue", "n")))).alias("variants"))
