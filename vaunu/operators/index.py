"""The picker: visibility rules, index, availability, facets and invariants."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaunu.functions import rules
from vaunu.functions import text as T


def count_of(column: str = "registered_count") -> Column:
    return F.coalesce(F.col(column), F.lit(0)).cast("long")


def model_statistics(items: DataFrame) -> DataFrame:
    """``brand, model, registrations, newest_year``."""
    _, end = T.year_span(F.col("years"))
    return items.groupBy("brand", "model").agg(F.sum(count_of()).alias("registrations"), F.max(end).alias("newest_year"))


def is_kept(make: Column, model: Column) -> Column:
    kept = [f"{m}\x00{k}" for m, k in rules.KEPT_MODELS]
    return F.concat(F.lower(T.clean(make)), F.lit("\x00"), T.fold(T.strip_exact_make(make, T.clean(model)))).isin(kept)


def hide_reason(
    make: Column,
    model: Column,
    make_total: Column,
    model_total: Column,
    newest: Column,
    hidden_models: list[tuple[str, str]] = (),
    min_make: int = rules.MIN_MAKE_TOTAL,
    min_model: int = rules.MIN_MODEL_TOTAL,
    min_year: int = rules.MIN_MODEL_YEAR,
) -> Column:
    """Why a pair is not offered, the first reason that holds; ``''`` where it is. A threshold of 0 is off."""
    plain = F.lower(T.clean(make))
    pair = F.concat(plain, F.lit("\x00"), T.model_key(make, model))
    curated = pair.isin([f"{m}\x00{k}" for m, k in hidden_models]) if hidden_models else F.lit(False)
    old = newest.isNull() | (newest < min_year)
    return (
        F.when(F.lit(min_make > 0) & (make_total < min_make), "rare-brand")
        .when(plain.isin(rules.HIDDEN_BRANDS), "curated-hidden-brand")
        .when(plain.isin(rules.BRAND_PLACEHOLDERS), "placeholder-brand")
        .when(curated, "curated-hidden")
        .when(is_kept(make, model), "")
        .when(T.is_unknown(make, model), "unknown")
        .when(T.is_technical(model), "technical")
        .when(F.lit(min_model > 0) & (model_total < min_model) & old, "rare+old")
        .otherwise("")
    )


def hide_reasons(items: DataFrame) -> DataFrame:
    """``brand, model, registrations, newest_year, reason``; decided once for each pair."""
    named = items.where(F.col("brand").isNotNull() & F.col("model").isNotNull())
    stats = model_statistics(named)
    makes = named.groupBy("brand").agg(F.sum(count_of()).alias("make_total"))
    c = F.col
    return stats.join(makes, "brand").withColumn("reason", hide_reason(c("brand"), c("model"), c("make_total"), c("registrations"), c("newest_year"))).drop("make_total")


def selectable(items: DataFrame) -> DataFrame:
    """``brand, model, vehicle_type, powertrain`` of what the picker offers, each once.

    Rows whose model is only a designation are skipped unless the pair is kept; the rest of the pair stays.
    """
    offered = hide_reasons(items).where("reason = ''").select("brand", "model")
    shown = items.join(offered, ["brand", "model"], "left_semi").select("brand", "model", "vehicle_type", "powertrain", "variant").distinct()
    plain = shown.where(~T.is_designation(F.col("model"), F.col("variant")) | is_kept(F.col("brand"), F.col("model")))
    return plain.where(F.col("vehicle_type").isNotNull()).select("brand", "model", "vehicle_type", "powertrain").distinct()


def index_rows(offered: DataFrame) -> DataFrame:
    """``brand, model, vehicle_type, powertrains`` with the codes sorted; rows without a code have an empty list."""
    return offered.groupBy("brand", "model", "vehicle_type").agg(F.array_sort(F.collect_set("powertrain")).alias("powertrains"))


def availability(offered: DataFrame) -> DataFrame:
    """``brand, vehicle_type, powertrains``: the codes of each make and type."""
    return offered.groupBy("brand", "vehicle_type").agg(F.array_sort(F.collect_set("powertrain")).alias("powertrains"))


def availability_map(offered: DataFrame) -> DataFrame:
    """``brand, kinds`` with a map from vehicle type to codes."""
    return availability(offered).groupBy("brand").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("vehicle_type", "powertrains")))).alias("kinds"))


def known_codes(column: Column) -> Column:
    """The known codes of a set, in the order of the list of powertrains."""
    return F.array_intersect(F.array(*map(F.lit, rules.POWERTRAINS)), column)


def import_index(items: DataFrame) -> DataFrame:
    """The index of an imported catalogue: nothing is hidden, a missing type is a passenger car, unknown codes are dropped."""
    kind = F.coalesce("vehicle_type", F.lit("passenger")).alias("vehicle_type")
    rows = items.where(F.col("brand").isNotNull() & F.col("model").isNotNull())
    return rows.groupBy("brand", "model", kind).agg(known_codes(F.collect_set("powertrain")).alias("powertrains"))


def index_availability(index: DataFrame) -> DataFrame:
    """``brand, vehicle_type, powertrains`` rebuilt from the rows of an index; types without a known code have no row."""
    flat = index.select("brand", F.coalesce("vehicle_type", F.lit("passenger")).alias("vehicle_type"), F.explode("powertrains").alias("code"))
    return flat.where(F.col("code").isin(rules.POWERTRAINS)).groupBy("brand", "vehicle_type").agg(known_codes(F.collect_set("code")).alias("powertrains"))


def brand_types(index: DataFrame) -> DataFrame:
    """``brand, vehicle_types`` of each make, sorted."""
    return index.groupBy("brand").agg(F.array_sort(F.collect_set(F.coalesce("vehicle_type", F.lit("passenger")))).alias("vehicle_types"))


def index_types(index: DataFrame) -> list[str]:
    """The types an index holds, ``passenger`` where it holds none; there are as many as the list of types has."""
    found = [r.vehicle_type for r in index.select("vehicle_type").where("vehicle_type is not null").distinct().orderBy("vehicle_type").collect()]
    return found or ["passenger"]


def facet_models(index: DataFrame, brand: str, vehicle_type: str = "", powertrain: str = "") -> DataFrame:
    """``model, sort_key`` of a make; a row without codes passes any fuel, an unknown fuel filters nothing."""
    rows = index.where(F.col("brand") == brand)
    if vehicle_type:
        rows = rows.where(F.col("vehicle_type") == vehicle_type)
    if powertrain in rules.POWERTRAINS:
        rows = rows.where((F.size("powertrains") == 0) | F.array_contains("powertrains", powertrain))
    return rows.select("model").distinct().withColumn("sort_key", T.natural_key(F.col("model")))


def facet_filters(flat: DataFrame, vehicle_type: str = "", powertrain: str = "") -> DataFrame:
    """``facet, value`` offered next: makes by type and fuel, fuels by type only, types by fuel only.

    ``flat`` has ``brand, vehicle_type, powertrain``. Where nothing tells the fuels of any make, nothing is filtered.
    """
    if flat.where("powertrain is not null").isEmpty():
        vehicle_type = powertrain = ""
    of_type = flat.where(F.col("vehicle_type") == vehicle_type) if vehicle_type else flat
    of_fuel = flat.where(F.col("powertrain") == powertrain) if powertrain in rules.POWERTRAINS else flat
    both = of_type.where(F.col("powertrain") == powertrain) if powertrain in rules.POWERTRAINS else of_type

    def facet(name: str, rows: DataFrame, column: str) -> DataFrame:
        return rows.where(F.col(column).isNotNull()).select(F.lit(name).alias("facet"), F.col(column).alias("value")).distinct()

    return facet("brand", both, "brand").unionByName(facet("powertrain", of_type, "powertrain")).unionByName(facet("vehicle_type", of_fuel, "vehicle_type"))


def facet_versions(items: DataFrame, brand: str, model: str, vehicle_type: str = "", powertrain: str = "") -> DataFrame:
    """Items of a model; a missing type is a passenger car, an unknown one has none. A sharded table is pruned to one shard."""
    rows = items.where((F.col("brand") == brand) & (F.col("model") == model))
    if "shard" in items.columns:
        rows = rows.where(F.col("shard").cast("string") == hashlib.sha256(f"{brand}\0{model}".encode()).hexdigest()[:2])
    if vehicle_type and vehicle_type not in rules.VEHICLE_TYPES:
        return rows.limit(0)
    if vehicle_type:
        rows = rows.where(F.coalesce("vehicle_type", F.lit("passenger")) == vehicle_type)
    if powertrain:
        rows = rows.where(F.col("powertrain") == powertrain)
    return rows


def version_label(kind: Column, variant: Column, body: Column, years: Column, vehicle_type: Column | None = None) -> Column:
    """The parts of a version's label that there are, with dots between; the type where versions of several are listed."""
    shown = (kind, variant, body, years) if vehicle_type is None else (kind, variant, body, years, vehicle_type)
    parts = F.array(*[F.nullif(p, F.lit("")) for p in shown])
    return F.array_join(F.array_compact(parts), " · ")


def model_shard(make: Column, model: Column) -> Column:
    """Two hex digits that place a model in one of 256 shards."""
    return F.substring(F.sha2(F.concat(F.coalesce(make, F.lit("")), F.lit("\x00"), F.coalesce(model, F.lit(""))), 256), 1, 2)


def violations(items: DataFrame) -> DataFrame:
    """One row of counts that must all be 0 for a finished catalogue: ``duplicate_ids, bracketed, door_codes, cm3, body_codes, bad_types``."""
    c = F.col
    repeated = items.groupBy("id").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_ids"))
    flags = items.agg(
        F.count_if(c("variant").rlike(r"\[[^\]]*\]\s*$")).alias("bracketed"),
        F.count_if(c("variant").rlike(r"(?i)(^|\s)\d+\s*ov(\s|,|$)")).alias("door_codes"),
        F.count_if(c("variant").rlike(r"(?i)\d+\s*cm3")).alias("cm3"),
        F.count_if(c("variant").rlike(r"\s\([A-Z]{1,2}\)")).alias("body_codes"),
        F.count_if(~c("vehicle_type").isin(rules.VEHICLE_TYPES)).alias("bad_types"),
    )
    return repeated.crossJoin(F.broadcast(flags))  # one row each


def check_catalog(items: DataFrame, registrations: int | None = None) -> None:
    """Raise on any violation, or if the sum of registrations is not that given."""
    row = violations(items).first().asDict()
    bad = {k: v for k, v in row.items() if v}
    if registrations is not None:
        total = items.agg(F.sum(count_of())).first()[0] or 0
        if total != registrations:
            bad["registrations"] = total - registrations
    if bad:
        raise ValueError(f"catalogue violates {bad}")


def index_differences(index: DataFrame, expected: DataFrame) -> DataFrame:
    """``side, brand, model, vehicle_type`` of rows in only one of index and expectation."""
    keys = ["brand", "model", "vehicle_type"]
    missing = expected.select(*keys).subtract(index.select(*keys)).withColumn("side", F.lit("missing"))
    extra = index.select(*keys).subtract(expected.select(*keys)).withColumn("side", F.lit("unexpected"))
    return missing.unionByName(extra)
