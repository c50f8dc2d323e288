"""The least similarity of any two rows of a group, without comparing all of them.

One minus the Jaccard similarity of sets is a metric. Similarities to a few
pivots bound that of any two sets: s(x, y) >= s(x, p) + s(p, y) - 1; so do the
words that all sets of a group hold. The pivots' own similarities give a least
one to beat, and only sets that could beat it with any other are compared, in
parts of bounded size. Where neither bound decides, those sets are compared in
pairs all the same: the result is exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions import text as T
from daybook.sources.shared import kept

PIVOTS = 3
#: Undecided sets of a group that one task compares with the others.
SETS_A_PART = 1000
SLACK = 1e-9


def least_similarity(rows: DataFrame, keys: list[str], words: str = "t") -> DataFrame:
    """``keys, n, least`` of groups of two rows at least: the least Jaccard similarity of the word arrays of any two.

    Equal sets count once; an empty or null set is unlike all (0). Null keys are no group.
    """
    named = F.array_sort(F.array_distinct(F.coalesce(words, F.array().cast("array<string>"))))
    present = reduce(lambda a, k: a & F.col(k).isNotNull(), keys, F.lit(True))
    sets = kept(rows.filter(present).groupBy(*keys, named.alias("set")).agg(F.count("*").alias("rows")), "sets")
    shape = sets.groupBy(*keys).agg(F.sum("rows").alias("n"), F.count("*").alias("sets"), F.min(F.size("set")).alias("smallest")).filter("n > 1")
    plain = shape.filter("sets = 1 OR smallest = 0").select(*keys, "n", F.when(F.col("smallest") == 0, 0.0).otherwise(1.0).alias("least"))
    several = shape.filter("sets > 1 AND smallest > 0").select(*keys, "n")
    measured = sets.join(several.select(*keys), keys).select(*keys, "set")
    nearest: Column = F.size("set").cast("double")
    for k in range(PIVOTS):
        # the smallest set, then each time one that is far from all pivots before
        pivot = measured.groupBy(*keys).agg(F.min(F.struct(nearest.alias("near"), F.col("set").alias("set"))).alias("p")).select(*keys, F.col("p.set").alias("pivot"))
        measured = kept(measured.join(pivot, keys).withColumn(f"s{k}", T.jaccard(F.col("set"), F.col("pivot"))).drop("pivot"), "measured")
        nearest = F.greatest(*[F.col(f"s{i}") for i in range(k + 1)]) if k else F.col("s0")
    to = [f"s{k}" for k in range(PIVOTS)]
    far = measured.groupBy(*keys).agg(*[F.min(s).alias(f"far_{s}") for s in to], F.count("*").alias("sets"), F.max(F.size("set")).alias("largest")).withColumn("found", F.least(*[f"far_{s}" for s in to]))
    # words that all sets hold are in every intersection
    common = measured.select(*keys, F.explode("set").alias("word")).groupBy(*keys, "word").agg(F.count("*").alias("holders")).join(far.select(*keys, "sets"), keys).filter("holders = sets").groupBy(*keys).agg(F.count("*").alias("core"))
    bounded = measured.join(far.join(common, keys, "left").fillna(0, ["core"]), keys)
    at_least = F.col("core") / (F.size("set") + F.col("largest") - F.col("core"))
    undecided = bounded.filter(reduce(lambda a, s: a & (F.col(s) + F.col(f"far_{s}") < 1 + F.col("found") - SLACK), to, at_least < F.col("found") - SLACK))
    sizes = undecided.groupBy(*keys).agg(F.ceil(F.count("*") / SETS_A_PART).cast("int").alias("parts"))
    dealt = undecided.join(sizes, keys)
    x = dealt.select(*keys, "found", F.col("set").alias("x"), *[F.col(s).alias(f"x_{s}") for s in to], F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    y = dealt.select(*keys, F.col("set").alias("y"), *[F.col(s).alias(f"y_{s}") for s in to], F.pmod(F.hash("set"), F.col("parts")).alias("part"))
    could = reduce(lambda a, s: a & (F.col(f"x_{s}") + F.col(f"y_{s}") < 1 + F.col("found") - SLACK), to, F.col("x") < F.col("y"))
    compared = x.join(y, [*keys, "part"]).filter(could).groupBy(*keys).agg(F.min(T.jaccard(F.col("x"), F.col("y"))).alias("compared"))
    decided = several.join(far.select(*keys, "found"), keys).join(compared, keys, "left").select(*keys, "n", F.least("found", F.coalesce("compared", "found")).alias("least"))
    return plain.unionByName(decided)
