"""Problem 9: sources mixed to target shares of the total size.

Records of a source fall into blocks by a hash. The quota of a source is a number of whole blocks, in
a keyed permutation drawn anew for each repeat, and one block that is cut at a record. A splitting
tree divides the block quotas of all sources among the output shards: each node draws how many blocks
of each source go left from the multivariate hypergeometric distribution, so every shard is a fair
sample of the mix and all draws are disjoint. Within its shard each record gets a shuffled position,
by one range sort over all shards, so that no task holds a whole one.

Only sums by block reach the driver. The number of shards follows from the records, that of blocks from
both; a quota is met to the record whatever the size of the blocks.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaunu.session import materialize

#: Blocks of a source: so many, or several for each shard where there are more shards.
BLOCKS, BLOCKS_A_SHARD = 4096, 4
#: Records in a shard, unless the number of shards is given; and the least number of shards.
ROWS_A_SHARD, LEAST_SHARDS = 1_000_000, 16


def split(quotas: np.ndarray, shards: int, random: np.random.Generator) -> np.ndarray:
    """Block counts by shard and source that add up to ``quotas``, by recursive hypergeometric draws."""
    if shards == 1:
        return quotas[None, :]
    left = shards // 2
    total = int(quotas.sum())
    take = total * left // shards
    drawn = random.multivariate_hypergeometric(quotas, take, method="marginals") if total else quotas * 0
    return np.concatenate([split(drawn, left, random), split(quotas - drawn, shards - left, random)])


def plan(sizes: dict[str, dict[int, int]], targets: dict[str, tuple[float, int]], total: float | None, shards: int, seed: int) -> tuple[list[tuple], float]:
    """The draws ``source, block, repeat, shard, most`` (``most``: tokens of a cut block, else null) and the total.

    ``sizes`` has the tokens of each block. Without ``total``, the largest at which every source that
    has records reaches its share within its repeats.
    """
    random = np.random.default_rng(seed)
    have = {s: sum(b.values()) for s, b in sizes.items()}
    live = [s for s in sorted(targets) if have.get(s, 0) > 0 and targets[s][0] > 0 and targets[s][1] > 0]
    if not live:
        return [], 0.0
    reach = min(have[s] * targets[s][1] / targets[s][0] for s in live)
    total = reach if total is None else float(total)
    sequences, quotas = [], []
    for source in live:
        share, repeats = targets[source]
        quota = min(total * share, have[source] * repeats) * (1 + 1e-12)
        draws, left, repeat = [], quota, 0
        while left >= 1 and repeat < repeats:
            for block in random.permutation(sorted(sizes[source])):
                size = sizes[source][int(block)]
                if left < 1:
                    break
                draws.append((source, int(block), repeat, None if size <= left else int(left)))
                left -= min(size, left)
            repeat += 1
        sequences.append(draws)
        quotas.append(len(draws))
    counts = split(np.array(quotas, dtype=np.int64), shards, random)
    out = []
    for at, draws in enumerate(sequences):
        ends = np.cumsum(counts[:, at])
        out += [(s, b, r, int(np.searchsorted(ends, i, side="right")), m) for i, (s, b, r, m) in enumerate(draws)]
    return out, total


def mix(sized: DataFrame, targets: DataFrame, total: float | None = None, shards: int | None = None, block_rows: int = 64, seed: int = 7) -> DataFrame:
    """``doc_id, source, n_tokens, repeat, shard, position`` of each record drawn, once for each repeat.

    ``sized`` has ``doc_id, source, n_tokens``. Records without tokens or of a null or unnamed source
    are never drawn. A source named twice has the sum of its shares and the larger cap; a null share
    or cap counts as 0. A share over the caps is filled as far as they reach. Equal rows of ``sized``
    stand for one record each. With nothing to draw the result is empty.
    """
    rows = (
        targets.where(F.col("source").isNotNull())
        .groupBy("source")
        .agg(F.sum(F.coalesce("target_share", F.lit(0.0))).alias("share"), F.max(F.coalesce("max_repeats", F.lit(0))).alias("cap"))
        .collect()
    )  # the targets are written by hand: a row a source
    wanted = {r.source: (r.share, r.cap) for r in rows}
    spark = sized.sparkSession
    named = spark.createDataFrame([(s,) for s in wanted], "source string")
    kept = sized.select("doc_id", "source", F.col("n_tokens").cast("long")).where("n_tokens > 0")
    kept = materialize(kept.join(named, "source", "left_semi"))
    counts = {r.source: r.n for r in kept.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
    shards = shards or max(LEAST_SHARDS, math.ceil(sum(counts.values()) / ROWS_A_SHARD))
    blocks = [(s, min(max(BLOCKS, BLOCKS_A_SHARD * shards), max(1, math.ceil(n / block_rows)))) for s, n in counts.items()]
    of_source = spark.createDataFrame(blocks, "source string, n_blocks long")
    placed = kept.join(of_source, "source").withColumn(
        "block", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.col("n_blocks"))
    )
    sizes: dict[str, dict[int, int]] = {}
    for r in placed.groupBy("source", "block").agg(F.sum("n_tokens").alias("n")).toLocalIterator():
        sizes.setdefault(r.source, {})[r.block] = r.n
    draws, _ = plan(sizes, wanted, total, shards, seed)
    drawn = spark.createDataFrame(draws, "source string, block long, repeat int, shard int, most long")
    taken = placed.join(drawn, ["source", "block"]).drop("block", "n_blocks")
    order = F.xxhash64("doc_id", "repeat", F.lit(seed + 1))
    whole = taken.where("most is null").drop("most")
    running = F.sum("n_tokens").over(Window.partitionBy("source", "repeat").orderBy(order, "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    edge = taken.where("most is not null").withColumn("running", running)
    cut = edge.where("running - n_tokens / 2 <= most").drop("most", "running")  # the record on the edge if half of it fits
    return _positions(whole.unionByName(cut), order)


def _positions(rows: DataFrame, order: Column) -> DataFrame:
    """``position`` from 1 of each row in its shard: its place in its partition of the sorted rows, after the shard's rows in those before."""
    sorted_rows = rows.withColumn("_order", order).orderBy("shard", "_order", "doc_id", "repeat").drop("_order")
    placed = materialize(sorted_rows.withColumn("_at", F.monotonically_increasing_id()))
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit(2**33 - 1))
    placed = placed.withColumns({"_part": part, "_place": place})
    runs = placed.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    earlier = F.sum("_n").over(Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = runs.select("shard", "_part", (F.coalesce(earlier, F.lit(0)) - F.col("_first") + 1).alias("_start"))  # a row for each shard and partition it lies in
    return placed.join(starts, ["shard", "_part"]).withColumn("position", (F.col("_place") + F.col("_start")).cast("int")).drop("_part", "_place", "_at", "_start")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """``source, target_share, actual_share, n_tokens, n_records, most_repeats`` of each target."""
    by = mixed.groupBy("source").agg(
        F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_records"), (F.max("repeat") + 1).alias("most_repeats")
    )
    total = by.agg(F.sum("n_tokens").alias("all_tokens"))
    return (
        targets.join(by, "source", "left")
        .crossJoin(F.broadcast(total))  # one row
        .select(
            "source", "target_share",
            (F.coalesce("n_tokens", F.lit(0)) / F.col("all_tokens")).alias("actual_share"),
            F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"), F.coalesce("n_records", F.lit(0)).alias("n_records"),
            F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"),
        )
    )
