"""Data-quality reports over the catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaunu.functions import rules
from vaunu.functions import text as T
from vaunu.operators.index import count_of


def rare_makes(report: DataFrame, below: int = rules.MIN_MAKE_TOTAL) -> DataFrame:
    """The rows of :func:`make_report` with fewer registrations, fewest first."""
    return report.where(F.col("registrations") < below).orderBy("registrations", F.lower("brand"), "brand")


def make_report(items: DataFrame, in_picker: DataFrame | None = None) -> DataFrame:
    """``brand, registrations, rows, models, first_year, status`` of each make."""
    start, _ = T.year_span(F.col("years"))
    table = items.where(F.col("brand").isNotNull()).groupBy("brand").agg(
        F.sum(count_of()).alias("registrations"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct("model").alias("n_models"), F.min(start).alias("first_year")
    )
    plain = F.lower(T.clean(F.col("brand")))
    flags = F.array(
        F.when(plain.isin(rules.HIDDEN_BRANDS), "curated-hidden"), F.when(plain.isin(rules.BRAND_PLACEHOLDERS), "placeholder"),
        F.when(F.col("registrations") < rules.MIN_MAKE_TOTAL, "below-threshold"),
    )
    table = table.withColumn("status", F.array_join(F.array_compact(flags), ","))
    if in_picker is not None:
        seen = in_picker.select("brand").distinct().withColumn("_seen", F.lit(True))
        table = table.join(seen, "brand", "left").withColumn("status", F.when((F.col("status") == "") & F.col("_seen").isNull(), "not-in-picker").otherwise(F.col("status"))).drop("_seen")
    return table


def model_report(items: DataFrame) -> DataFrame:
    """Counts of each pair: registrations, rows, variants, types, designations, first and last year."""
    start, end = T.year_span(F.col("years"))
    return items.where(F.col("brand").isNotNull() & F.col("model").isNotNull()).groupBy("brand", "model").agg(
        F.sum(count_of()).alias("registrations"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct("variant").alias("n_variants"),
        F.count_distinct("vehicle_type").alias("n_types"), F.count_if(T.is_designation(F.col("model"), F.col("variant"))).alias("n_designations"), F.min(start).alias("first_year"), F.max(end).alias("last_year"),
    )


def count_bucket(total: Column) -> Column:
    return F.when(total < 2, "1").when(total < 10, "2-9").when(total < 100, "10-99").when(total < 1000, "100-999").otherwise("1000+")


def decade(year: Column) -> Column:
    return F.coalesce((F.floor(year / 10) * 10).cast("string"), F.lit("none"))


def bucket_matrix(stats: DataFrame) -> DataFrame:
    """``bucket, decade, n_models, registrations`` with totals (``all``) over rows, columns and both."""
    cells = stats.select(count_bucket(F.col("registrations")).alias("bucket"), decade(F.col("newest_year")).alias("decade"), "registrations")
    cube = cells.cube("bucket", "decade").agg(F.count(F.lit(1)).alias("n_models"), F.sum("registrations").alias("registrations"))
    return cube.select(F.coalesce("bucket", F.lit("all")).alias("bucket"), F.coalesce("decade", F.lit("all")).alias("decade"), "n_models", "registrations")


def pivot_matrix(stats: DataFrame) -> DataFrame:
    """The cells of :func:`bucket_matrix` with a column for each decade."""
    return bucket_matrix(stats).groupBy("bucket").pivot("decade").agg(F.sum("n_models"))


def label_groups(items: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Groups of several rows with one label: ``keys, n_rows`` and ``differing``, the fields with several values (null is one).

    A field differs if its least and greatest values do: one aggregate, combined on the map side.
    """
    values = {f: F.coalesce(F.col(f).cast("string"), F.lit("\x00")) for f in fields}
    aggs = [(F.min(v) != F.max(v)).alias(f"_{f}") for f, v in values.items()]
    groups = items.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *aggs).where("n_rows > 1")
    differing = F.array_join(F.array_compact(F.array(*[F.when(F.col(f"_{f}"), f) for f in fields])), ",")
    return groups.select(*keys, "n_rows", differing.alias("differing"))


def noise_samples(items: DataFrame, patterns: dict[str, str], column: str = "variant", most: int = 6) -> DataFrame:
    """``pattern, sample``: the first ``most`` distinct texts that match each pattern, in code-point order."""
    out = None
    for name, pattern in patterns.items():
        hits = items.where(F.col(column).rlike(pattern)).select(F.lit(name).alias("pattern"), F.col(column).alias("sample")).distinct().orderBy("sample").limit(most)
        out = hits if out is None else out.unionByName(hits)
    return out


def legacy_label(items: DataFrame) -> DataFrame:
    """``item_no`` and the label without body: a bracketed detail stripped off the variant, missing parts empty."""
    parts = [F.coalesce(c, F.lit("")).alias(c) for c in ("brand", "model", "powertrain", "years", "vehicle_type")]
    return items.select("item_no", *parts, T.strip_detail(F.col("variant")).alias("variant"))


def group_histogram(groups: DataFrame) -> DataFrame:
    """``n_rows, n_groups``: how many groups have each size."""
    return groups.groupBy("n_rows").agg(F.count(F.lit(1)).alias("n_groups"))


def field_frequency(groups: DataFrame) -> DataFrame:
    """``field, n_groups``: in how many groups each field differs."""
    named = groups.where("differing != ''").select(F.explode(F.split("differing", ",")).alias("field"))
    return named.groupBy("field").agg(F.count(F.lit(1)).alias("n_groups"))


def prefix_pairs(names: DataFrame, gap: int = 3) -> DataFrame:
    """``brand, short_key, long_key`` where one model key begins another of the make and is 1 to ``gap`` shorter.

    An equi-join on the key's own shorter prefixes; no comparison of all pairs of a make.
    """
    keys = names.where(F.col("brand").isNotNull() & F.col("model").isNotNull()).select("brand", T.fold(F.col("model")).alias("key")).where("length(key) >= 2").distinct()
    prefixes = keys.where("length(key) > 2").select(
        "brand", F.col("key").alias("long_key"),
        F.explode(F.transform(F.sequence(F.lit(1), F.least(F.lit(gap), F.length("key") - 2)), lambda n: F.substring("key", F.lit(1), F.length("key") - n))).alias("short_key"),
    )
    return prefixes.join(keys.withColumnRenamed("key", "short_key"), ["brand", "short_key"]).select("brand", "short_key", "long_key")


def noise_counts(items: DataFrame, patterns: dict[str, str], column: str = "variant") -> DataFrame:
    """``pattern, hits, share``: rows whose text matches each pattern; one scan."""
    counts = items.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(column).rlike(p)).alias(name) for name, p in patterns.items()])
    stacked = ", ".join(f"'{name}', `{name}`" for name in patterns)
    return counts.selectExpr("n", f"stack({len(patterns)}, {stacked}) as (pattern, hits)").select("pattern", "hits", (F.col("hits") / F.col("n")).alias("share"))


def series_groups(items: DataFrame) -> DataFrame:
    """``brand, series_key, n_names``: models of a make that share a series key."""
    names = items.where(F.col("brand").isNotNull() & F.col("model").isNotNull()).select("brand", "model").distinct()
    keyed = names.withColumn("series_key", T.series_key(F.col("brand"), F.col("model")))
    return keyed.groupBy("brand", "series_key").agg(F.count(F.lit(1)).alias("n_names")).where("n_names > 1")
