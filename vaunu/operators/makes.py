"""One make for all its spellings, decided on distinct spellings only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaunu.functions import rules
from vaunu.functions import text as T


def resolve_makes(items: DataFrame, trusted: int = rules.TRUSTED_TOTAL) -> DataFrame:
    """``brand, make``: the single make of each distinct normalized ``brand``.

    ``items`` has ``brand, registered_count, pos``. A composite goes to its first word if that is a make
    of its own with ``trusted`` registrations; then to the longest trusted make it begins with; makes
    that differ only by signs are one. The heaviest spelling names the make. All steps group or equi-join
    distinct spellings; a prefix is found by joining the spelling's own prefixes.
    """
    names = items.where(F.col("brand").isNotNull()).groupBy("brand").agg(F.sum(F.coalesce("registered_count", F.lit(0))).alias("w"), F.min("pos").alias("pos"))
    names = names.withColumn("key", F.lower("brand"))
    keys = names.groupBy("key").agg(F.sum("w").alias("freq"), F.min(F.struct(F.length("brand"), "pos", "brand"))["brand"].alias("display"))
    first = F.when(F.col("key").rlike(r"[, \-/–]"), T.make_token(F.col("key")))
    heads = keys.select(F.col("key").alias("head"), F.col("freq").alias("head_freq"), F.col("display").alias("head_display"))
    collapsed = keys.withColumn("first", first).join(
        heads, (F.col("first") == F.col("head")) & (F.col("first") != F.col("key")) & (F.col("head_freq") >= trusted), "left"
    )
    shown = collapsed.select("key", F.coalesce("head_display", "display").alias("shown"))
    spelled = names.join(shown, "key").withColumn("stage", T.make_key(F.col("shown")))
    stages = spelled.groupBy("stage").agg(F.sum("w").alias("total"))
    words = F.split("stage", " ")
    prefixes = stages.select(
        "stage", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1))), lambda n: F.array_join(F.slice(words, 1, n), " "))).alias("prefix")
    ).where("prefix != stage")
    bases = stages.where(F.col("total") >= trusted).select(F.col("stage").alias("prefix"))
    longest = prefixes.join(bases, "prefix").groupBy("stage").agg(F.max(F.struct(F.length("prefix"), "prefix"))["prefix"].alias("base"))
    based = spelled.join(longest, "stage", "left").withColumn("folded", F.regexp_replace(F.coalesce("base", "stage"), "[^0-9a-z]+", ""))
    weights = based.groupBy("folded", "shown").agg(F.sum("w").alias("w"))
    best = weights.groupBy("folded").agg(F.min(F.struct(-F.col("w"), F.lower("shown"), F.length("shown"), "shown"))["shown"].alias("make"))
    return based.join(best, "folded").select("brand", "make")
