"""Official consumption records for catalogue items by a ranked lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def canonical(column: Column) -> Column:
    """Capital letters and figures only."""
    return F.regexp_replace(F.upper(F.coalesce(column, F.lit(""))), "[^A-Z0-9]", "")


def approvals(items: DataFrame) -> DataFrame:
    """``item_no, place, approval``: an item's own approval first, then those of its records, each once."""
    listed = F.concat(F.array("type_approval"), F.coalesce(F.col("source_records")["type_approval"], F.array().cast("array<string>")))
    distinct = F.array_distinct(F.filter(F.transform(listed, lambda a: F.upper(F.trim(a))), lambda a: a.isNotNull() & (a != "")))
    return items.select("item_no", F.posexplode(distinct).alias("place", "approval"))


def penalty(approval_item: dict[str, Column], candidate: dict[str, Column]) -> Column:
    """25 for another variant, 50 for another version, and the differences of emission and power up to 100 each."""

    def differs(a: Column, b: Column, points: int) -> Column:
        return F.when((a != "") & (b != "") & (a != b), points).otherwise(0)

    def gap(a: Column, b: Column) -> Column:
        return F.when((a > 0) & (b > 0), F.least(F.lit(100.0), F.abs(a - b))).otherwise(0.0)

    return (
        differs(approval_item["variant"], candidate["variant"], 25)
        + differs(approval_item["version"], candidate["version"], 50)
        + gap(approval_item["co2"], candidate["co2"])
        + gap(approval_item["power"], candidate["power"])
    )


def enrich(items: DataFrame, candidates: DataFrame) -> DataFrame:
    """``item_no, cand_id, place, score``: the best usable candidate of the first approval that has any.

    Usable candidates have a fuel or an electric consumption. Among those of one approval the least
    penalty wins, then the first. Items without one are not in the result. Both sides meet by an
    equi-join on the approval; the choice is an aggregate with map-side combining, not a window.
    """
    usable = candidates.where(F.col("fc").isNotNull() | F.col("z_wh_km").isNotNull()).select(
        F.upper(F.trim("tan")).alias("approval"), "cand_id", canonical(F.col("va")).alias("c_variant"), canonical(F.col("ve")).alias("c_version"),
        F.col("ewltp_g_km").alias("c_co2"), F.col("ep_kw").alias("c_power"),
    )
    facts = items.select(
        "item_no", canonical(F.col("variant_code")).alias("variant"), canonical(F.col("version_code")).alias("version"), F.col("co2").cast("double").alias("co2"),
        F.regexp_extract("variant", r", ([0-9.]+) kW", 1).try_cast("double").alias("power"),
    )
    pairs = approvals(items).join(usable, "approval").join(facts, "item_no")
    score = penalty({k: F.col(k) for k in ("variant", "version", "co2", "power")}, {k: F.col(f"c_{k}") for k in ("variant", "version", "co2", "power")})
    best = pairs.groupBy("item_no").agg(F.min(F.struct("place", score.alias("score"), "cand_id")).alias("b"))
    return best.select("item_no", "b.cand_id", "b.place", "b.score")


def consumption(items: DataFrame, candidates: DataFrame) -> DataFrame:
    """Items with the consumption of their candidate: fuel unless electric, electricity for electric and plug-in."""
    found = enrich(items, candidates).join(candidates.select("cand_id", "fc", "z_wh_km", "report_year"), "cand_id")
    kind = F.col("powertrain")
    return items.join(found, "item_no", "left").withColumns(
        {
            "fuel_consumption": F.when((kind != "electric") & F.col("fc").isNotNull(), F.bround("fc", 1)).otherwise(F.col("fuel_consumption")),
            "electric_consumption": F.when(kind.isin("electric", "phev") & F.col("z_wh_km").isNotNull(), F.bround(F.col("z_wh_km") / 10, 1)).otherwise(F.col("electric_consumption")),
        }
    )
