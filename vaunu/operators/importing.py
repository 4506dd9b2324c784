"""Lines typed by administrators, sanitized into catalogue items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaunu.functions import rules
from vaunu.functions import text as T

REQUIRED = ["id", "brand", "model", "powertrain"]
#: What stands in for a missing column.
TEXT_DEFAULTS = {"vehicle_type": "passenger", "vehicle_class": "M1", "tax_measurement": "wltp", "mass_source": "administrator"}
NUMBER_DEFAULTS = {"fuel_consumption": 0.0, "electric_consumption": 0.0, "co2": 0.0, "mass": 0.0, "service_cost": 360.0, "registered_count": 0.0}


def leading_number(column: Column) -> Column:
    """The number a text begins with (``12abc`` is 12), at least 0; 0 without one."""
    text = F.trim(F.replace(F.coalesce(column.cast("string"), F.lit("")), F.lit(","), F.lit(".")))
    found = F.regexp_extract(text, r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?", 0)
    return F.greatest(F.lit(0.0), F.coalesce(found.try_cast("double"), F.lit(0.0)))


def sanitize(lines: DataFrame) -> DataFrame:
    """Valid lines with cleaned texts, numbers and defaults; columns that are absent get their default.

    A line needs an id (other than ``0``), brand, model and a known powertrain, type and class. Repeated
    ids stay; :func:`vaunu.operators.compare.latest` keeps the last.
    """
    have = set(lines.columns)
    c = F.col
    texts = {n: T.or_whole(T.clean(c(n)), F.lit(d)) if n in have else F.lit(d) for n, d in TEXT_DEFAULTS.items()}
    numbers = {n: F.when(T.clean(c(n).cast("string")) == "", d).otherwise(leading_number(c(n))) if n in have else F.lit(d) for n, d in NUMBER_DEFAULTS.items()}
    variant = T.or_whole(T.clean(c("variant")), T.clean(c("model"))) if "variant" in have else T.clean(c("model"))
    keep = [c(n) for n in lines.columns if n not in {*REQUIRED, *TEXT_DEFAULTS, *NUMBER_DEFAULTS, "variant"}]
    out = lines.select(
        F.regexp_replace(F.lower(F.coalesce("id", F.lit(""))), "[^a-z0-9_-]", "").alias("id"), T.clean(c("brand")).alias("brand"), T.clean(c("model")).alias("model"),
        variant.alias("variant"), F.lower(T.clean(c("powertrain"))).alias("powertrain"), *[e.alias(n) for n, e in {**texts, **numbers}.items()], *keep,
    )
    return out.where(
        ~c("id").isin("", "0") & ~c("brand").isin("", "0") & ~c("model").isin("", "0") & c("powertrain").isin(rules.POWERTRAINS)
        & c("vehicle_type").isin(rules.VEHICLE_TYPES) & c("vehicle_class").isin(rules.SUPPORTED_CLASSES)
    )
