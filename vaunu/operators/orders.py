"""Total orders of catalogue, index and lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaunu.functions.formats import folded_case
from vaunu.functions.text import natural_key


def catalogue_order(items: DataFrame) -> DataFrame:
    """By rank (missing is 0), make, model, powertrain, variant and years, whatever the case; ties by ``id``."""
    c = F.col
    return items.orderBy(F.coalesce("source_rank", F.lit(0)), folded_case(c("brand")), folded_case(c("model")), "powertrain", folded_case(c("variant")), F.coalesce("years", F.lit("")), "id")


def index_order(index: DataFrame) -> DataFrame:
    return index.orderBy(folded_case(F.col("brand")), folded_case(F.col("model")), "vehicle_type", "brand", "model")


def makes_in_order(index: DataFrame) -> DataFrame:
    """``brand`` of each make, whatever the case."""
    return index.select("brand").distinct().orderBy(folded_case(F.col("brand")), "brand")


def natural_order(rows: DataFrame, *columns: str) -> DataFrame:
    """Figures by value, letters whatever the case, then as written."""
    return rows.orderBy(*[natural_key(F.col(c)) for c in columns], *columns)


def collated(rows: DataFrame, column: str, collation: str = "fi_CI_AI") -> DataFrame:
    """By a language's own order, without regard to case and accents; ties as written."""
    return rows.orderBy(F.collate(F.col(column), collation), column)
