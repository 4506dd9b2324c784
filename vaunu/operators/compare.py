"""Side-by-side comparison: lines, shares, differences to the least, applicable differences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def lines(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``key, line, amount`` of each positive amount, one row for each column."""
    stacked = ", ".join(f"'{c}', cast(`{c}` as double)" for c in columns)
    return rows.selectExpr(f"`{key}`", f"stack({len(columns)}, {stacked}) as (line, amount)").where("amount > 0")


def shares(rows: DataFrame, key: str) -> DataFrame:
    """``share`` and running ``until`` of each line of a key, largest first, then by name."""
    group = Window.partitionBy(key)
    order = group.orderBy(F.desc("amount"), "line").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("amount").over(group)
    return rows.select(key, "line", "amount", (F.col("amount") / total).alias("share"), (F.sum("amount").over(order) / total).alias("until"))


def compare(rows: DataFrame, sets: str, total: str) -> DataFrame:
    """``delta`` to the least and ``ratio`` to the greatest total of a set, and whether it is the least."""
    group = Window.partitionBy(sets)
    least, most = F.min(total).over(group), F.max(total).over(group)
    return rows.withColumns({"delta": F.col(total) - least, "ratio": F.col(total) / F.nullif(most, F.lit(0)), "is_least": F.col(total) == least})


def latest(rows: DataFrame, key: str, order: str, most: int = 10) -> DataFrame:
    """The last row of each key, and of these the ``most`` latest: upsert into a list of bounded length."""
    kept = rows.groupBy(key).agg(F.max(F.struct(order, *[c for c in rows.columns if c not in (key, order)])).alias("_row")).select(key, "_row.*")
    return kept.orderBy(F.desc(order), key).limit(most)


def differing_assumptions(rows: DataFrame, sets: str, columns: list[str]) -> DataFrame:
    """``sets, assumption, n_known, n_values`` where at least two rows know the assumption and disagree."""
    stacked = ", ".join(f"'{c}', cast(`{c}` as string)" for c in columns)
    long = rows.selectExpr(f"`{sets}`", f"stack({len(columns)}, {stacked}) as (assumption, value)").where("value is not null")
    return long.groupBy(sets, "assumption").agg(F.count(F.lit(1)).alias("n_known"), F.count_distinct("value").alias("n_values")).where("n_known >= 2 and n_values >= 2")


def rate_lookup(rows: DataFrame, rates: DataFrame, method: str, level: str, top: int, default: float) -> DataFrame:
    """``rate`` by method and level, levels above ``top`` taken as ``top``; ``default`` where there is none.

    ``rates`` (``method, level, rate``) has ``top + 1`` rows a method, so it is small.
    """
    at = F.least(F.lit(top), F.floor(F.col(level) + 0.5).cast("int"))
    keyed = rows.withColumn("_method", F.when(F.col(method) == "nedc", "nedc").otherwise("wltp")).withColumn("_level", at)
    table = rates.select(F.col("method").alias("_method"), F.col("level").alias("_level"), "rate")
    return keyed.join(table, ["_method", "_level"], "left").withColumn("rate", F.coalesce("rate", F.lit(default))).drop("_method", "_level")
