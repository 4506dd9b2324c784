"""Per-key aggregation that stays even when a few keys hold most rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def heavy_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """Keys that hold more than ``share`` of all rows, with their row counts.

    The count combines on the map side, so a hot key costs one row per task. At most
    ``1 / share`` keys can qualify, which bounds the size of what is broadcast later.
    """
    counts = df.groupBy(F.col(key).alias("heavy_key")).agg(F.count(F.lit(1)).alias("heavy_rows"))
    total = counts.agg(F.sum("heavy_rows").alias("all_rows"))
    return (
        counts.join(F.broadcast(total), F.col("heavy_rows") > share * F.col("all_rows"))
        .select("heavy_key", "heavy_rows")
    )


def salted_aggregate(
    df: DataFrame,
    key: str,
    sums: dict[str, Column | str],
    rows_as: str = "n_rows",
    share: float = 0.01,
    salts: int = 32,
) -> DataFrame:
    """Two-stage salted aggregation: ``key, n_rows`` and one sum for each entry of ``sums``.

    Rows of a heavy key (over ``share`` of all rows) are spread over ``salts`` partial groups; the
    partials of each key are then merged. Other keys have one salt only. The salt is a hash of the
    row's place, not ``rand()``, so a recomputed task salts its rows as before.

    Null keys form one group of their own. A sum skips nulls and is null when all its values are.
    An empty table gives no rows. Columns of ``df`` that are not named play no part.
    """
    values = {name: (F.col(v) if isinstance(v, str) else v) for name, v in sums.items()}
    slim = df.select(F.col(key).alias("_key"), *[v.alias(f"_v{i}") for i, v in enumerate(values.values())])
    heavy = heavy_keys(slim, "_key", share)
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts))
    salted = slim.join(F.broadcast(heavy), F.col("_key").eqNullSafe(F.col("heavy_key")), "left").withColumn(
        "_salt", F.when(F.col("heavy_rows").isNotNull(), place).otherwise(F.lit(0).cast("long"))
    )
    partial = salted.groupBy("_key", "_salt").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(f"_v{i}").alias(f"_s{i}") for i in range(len(values))]
    )
    return (
        partial.groupBy("_key")
        .agg(F.sum("_n").alias(rows_as), *[F.sum(f"_s{i}").alias(name) for i, name in enumerate(values)])
        .withColumnRenamed("_key", key)
    )


def keys_above(totals: DataFrame, key: str, share: float, rows_as: str = "n_rows") -> DataFrame:
    """Non-null keys of :func:`salted_aggregate` with more than ``share`` of all rows, null keys counted in the total."""
    total = totals.agg(F.sum(rows_as).alias("all_rows"))
    return (
        totals.join(F.broadcast(total), F.col(rows_as) > share * F.col("all_rows"))
        .where(F.col(key).isNotNull())
        .select(key)
    )
