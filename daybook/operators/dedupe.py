"""Cross-source dedupe: two passes, with refusals, by relational steps.

Input rows: ``ord`` (first-seen order), ``source, title, confidence, room, place_id,
venue, instant, day`` and ``also`` (array of source names). No step gathers a group in
an array unless it holds one row per source at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions import text as T
from daybook.functions.timex import confidence_rank
from daybook.operators.similar import least_similarity
from daybook.sources.shared import kept

TITLE_VETO = 0.15


def merge(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the best-ranked first-seen row, with the other sources in ``also``."""
    order = Window.partitionBy(*keys).orderBy(F.desc(confidence_rank(F.col("confidence"))), "ord")
    ranked = df.withColumns({"at": F.row_number().over(order), "lead_source": F.first("source").over(order)})
    own = F.transform("also", lambda x, i: F.struct(F.col("at").alias("a"), (i + 1).alias("b"), x.alias("name")))
    names = F.concat(F.array(F.struct(F.col("at").alias("a"), F.lit(0).alias("b"), F.col("source").alias("name"))), own)
    listed = ranked.select(*keys, "lead_source", F.explode(names).alias("x")).filter(F.col("x.name") != F.col("lead_source"))
    firsts = listed.groupBy(*keys, F.col("x.name").alias("name")).agg(F.min(F.struct("x.a", "x.b")).alias("p"))
    also = firsts.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "name"))), lambda s: s["name"]).alias("merged_also"))
    best = ranked.filter("at = 1").drop("at", "lead_source", "also")
    same = None
    for k in keys:
        clause = best[k].eqNullSafe(also[k])
        same = clause if same is None else same & clause
    return best.join(also, same, "left").select(*[best[c] for c in best.columns], F.coalesce("merged_also", F.array().cast("array<string>")).alias("also"))


def pass_one(df: DataFrame) -> DataFrame:
    """Rows of one place and instant become one, unless a refusal holds: then all of the group stay as they were."""
    group = ["place_id", "instant"]
    placed = df.filter("place_id IS NOT NULL")
    # read by every step below
    folded = kept(merge(placed, [*group, "source", "title"]), "folded")
    shape = folded.groupBy(*group).agg(F.count("*").alias("n"), F.countDistinct("source").alias("n_sources"), F.countDistinct("room").alias("n_rooms"))
    sound = shape.filter("n = n_sources AND n_rooms <= 1").select(*group)
    alone = folded.join(sound, group)
    unlike = least_similarity(alone.select(*group, T.title_tokens(F.col("title")).alias("t")), group).filter(F.col("least") < TITLE_VETO).select(*group)
    agreed = kept(sound.join(unlike, group, "left_anti"), "agreed")
    firsts = Window.partitionBy(*group)
    merged = merge(alone.join(agreed, group), group)
    # a merged group stands where its first member stood
    seats = placed.groupBy(*group).agg(F.min("ord").alias("seat"))
    refused = placed.join(agreed, group, "left_anti").withColumn("seat", F.min("ord").over(firsts))
    merged = merged.join(seats, group)
    free = df.filter("place_id IS NULL").withColumn("seat", F.lit(-1).cast("long"))
    every = free.unionByName(merged.select(free.columns)).unionByName(refused.select(free.columns))
    return every.withColumn("pass_order", F.struct((F.col("seat") >= 0).alias("placed"), "seat", F.col("ord").alias("within"))).drop("seat")


def split_series(df: DataFrame, key: Column) -> DataFrame:
    """``key`` and, where a source has several instants under it, the instant too."""
    keyed = df.withColumn("key", key)
    per_source = keyed.groupBy("key", "source").agg(F.countDistinct("instant").alias("n"))
    series = per_source.groupBy("key").agg((F.max("n") > 1).alias("is_series"))
    return keyed.join(series, "key").withColumn("split", F.when(F.col("is_series"), F.col("instant"))).drop("is_series")


def pass_two(df: DataFrame) -> DataFrame:
    """Rows of one fuzzy key become one; series are split by instant first."""
    keyed = split_series(df, T.fuzzy_key(F.col("day"), F.col("title"), F.col("venue")))
    numbered = keyed.withColumnRenamed("ord", "source_ord")
    placed = numbered.withColumn("ord", F.col("pass_order"))
    return merge(placed, ["key", "split"]).drop("ord", "pass_order").withColumnRenamed("source_ord", "ord")


def dedupe(df: DataFrame) -> DataFrame:
    return pass_two(kept(pass_one(df), "pass-one"))
