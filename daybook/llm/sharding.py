"""Uniform shuffle into shards of exact size by a communication matrix.

Rows are numbered and dealt by a hash of the number into source blocks. The number of
rows that each source block sends to each target block is drawn from the
multivariate hypergeometric law, so the matrix is distributed as that of a
uniform permutation with the given target sizes. Each source block orders its
rows by a random key, sends the first so many to the first target block, and so on; each target
block orders what it has received by another key. A shard is a run of target blocks, so its
size is exact (counts of any two shards are at most one apart), and the slot of
a row, its place in the shard, is the block's offset plus its place in the block.

Only block counts and the matrix reach the driver: at most ``MAX_BLOCKS`` blocks, however many rows; blocks
of a larger table are larger, and are ordered by Spark's sort, which spills. The random keys are hashes of a row's
number, so every executor makes the same order again; the numbers lie in the shared folder.

Defined results: null text has no bytes; an empty table gives no rows; repeated
rows take a slot each; with fewer rows than shards some shards are empty; all
columns stay, whatever their names (``shuffle_into_shards`` adds ``shard`` and ``slot`` behind them).
"""

from __future__ import annotations

from math import lgamma, log, sqrt

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import beside, plain_names, stored

#: Rows of a block, as long as there are fewer than ``MAX_BLOCKS`` blocks.
BLOCK_ROWS = 1 << 14
MAX_BLOCKS = 2048
#: Numpy's sampler takes counts below 10^9.
LIBRARY_RANGE = 900_000_000


def shard_sizes(n_rows: int, n_shards: int) -> list[int]:
    return [n_rows // n_shards + (s < n_rows % n_shards) for s in range(n_shards)]


def split_evenly(n: int, parts: int) -> list[int]:
    return [n // parts + (k < n % parts) for k in range(parts)]


def communication_matrix(sources: list[int], targets: list[int], seed: int) -> np.ndarray:
    """Rows from each source to each target; row sums are ``sources``, column sums ``targets``."""
    rng = np.random.default_rng(seed)
    left = np.array(targets, dtype=np.int64)
    out = np.zeros((len(sources), len(targets)), dtype=np.int64)
    for i, n in enumerate(sources):
        out[i] = draw(rng, left, n)
        left -= out[i]
    return out


def draw(rng: np.random.Generator, left: np.ndarray, n: int) -> np.ndarray:
    """One multivariate hypergeometric draw, by halving the targets."""
    if len(left) == 1:
        return np.array([n], dtype=np.int64)
    half = len(left) // 2
    a, b = int(left[:half].sum()), int(left[half:].sum())
    first = hypergeometric(rng, a, b, n)
    return np.concatenate([draw(rng, left[:half], first), draw(rng, left[half:], n - first)])


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Of ``n`` drawn from ``good + bad`` without return, the number of good ones."""
    if good == 0 or n == 0:
        return 0
    if bad == 0:
        return n
    if max(good, bad) < LIBRARY_RANGE:
        return int(rng.hypergeometric(good, bad, n))
    return hypergeometric_by_ratio(rng, good, bad, n)


def hypergeometric_by_ratio(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """The same law for large counts, by the ratio of uniforms: points under the root of the law around its mode, drawn until one is accepted."""
    total = good + bad
    mode = (n + 1) * (good + 1) // (total + 2)
    low, high = max(0, n - bad), min(n, good)

    def height(k: int) -> float:
        return -(lgamma(k + 1) + lgamma(good - k + 1) + lgamma(n - k + 1) + lgamma(bad - n + k + 1))

    top, mean = height(mode), n * good / total + 0.5
    spread = sqrt(n * good / total * (bad / total) * ((total - n) / max(1, total - 1)) + 0.5)
    # fixed values of the ratio of uniforms: sqrt(8 / e) and 3 - 2 sqrt(3 / e)
    width = 1.7155277699214135 * spread + 0.8989161620588988
    while True:
        u, v = rng.random(), rng.random()
        k = int(np.floor(mean + width * (v - 0.5) / u)) if u > 0 else low - 1
        if low <= k <= high and 2 * log(u) <= height(k) - top:
            return k


def shuffle_into_shards(df: DataFrame, n_shards: int, seed: int = 17, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` with columns ``shard`` and ``slot``; given columns of these names are ``shard_given`` and ``slot_given``. Rows should be narrow: they move twice."""
    spark = df.sparkSession
    plain, names = plain_names(df)
    # the numbers hold still: the rows they number lie in the shared folder
    numbered = stored(plain.withColumn("number", F.monotonically_increasing_id()))
    coarse = F.pmod(F.xxhash64("number", F.lit(seed)), F.lit(MAX_BLOCKS))
    counts = dict(numbered.groupBy(coarse.alias("block")).count().collect())
    n_rows = sum(counts.values())
    n_blocks = 1
    while n_blocks < MAX_BLOCKS and n_rows > n_blocks * block_rows:
        n_blocks *= 2
    sources = [0] * n_blocks
    for block, n in counts.items():
        sources[block % n_blocks] += n
    targets, places = [], []
    for shard, size in enumerate(shard_sizes(n_rows, n_shards)):
        offset = 0
        for part in split_evenly(size, max(1, n_blocks // n_shards)):
            places.append((len(targets), shard, offset))
            targets.append(part)
            offset += part
    ends = np.cumsum(communication_matrix(sources, targets, seed), axis=1)
    sent = spark.createDataFrame([(k, row.tolist()) for k, row in enumerate(ends)], "block long, ends array<bigint>")
    received = spark.createDataFrame(places, "target int, shard int, offset long")
    key = lambda turn: F.xxhash64("number", F.lit(seed), F.lit(turn))
    order = lambda block, turn: F.row_number().over(Window.partitionBy(block).orderBy(key(turn), "number")) - 1
    dealt = numbered.withColumn("block", coarse % n_blocks).withColumn("place", order("block", 1)).join(F.broadcast(sent), "block")
    dealt = _searched(dealt, len(targets)).withColumn("place", order("target", 2)).join(F.broadcast(received), "target")
    return dealt.select(*[F.col(x).alias(beside(c, ("shard", "slot"), names)) for c, x in names.items()], "shard", (F.col("offset") + F.col("place")).cast("long").alias("slot"))


def _searched(dealt: DataFrame, n: int) -> DataFrame:
    """``target``: how many of the n sorted ``ends`` are at most ``place``, by binary search."""
    found = dealt.withColumn("target", F.lit(0))
    for step in reversed(range(n.bit_length())):
        on = F.col("target") + (1 << step)
        found = found.withColumn("target", F.when((on <= n) & (F.get("ends", F.least(on, F.lit(n)) - 1) <= F.col("place")), on).otherwise(F.col("target")))
    return found.drop("ends")


def shard_documents(docs: DataFrame, n_shards: int, seed: int = 17, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = shuffle_into_shards(narrow, n_shards, seed)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
