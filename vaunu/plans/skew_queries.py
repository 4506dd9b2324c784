"""Queries of problem 3: a few keys hold most records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vaunu.operators.skew import keys_above, salted_aggregate
from vaunu.session import table


def p3_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return salted_aggregate(
        table(spark, sf_dir, "vehicle_items"), "brand", {"registered_count": "registered_count"}
    )


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys_above(p3_totals(spark, sf_dir), "brand", 0.02)


QUERIES = {"p3_found": p3_found, "p3_totals": p3_totals}

SQL = {
    "p3_found": """
        SELECT brand FROM vehicle_items WHERE brand IS NOT NULL GROUP BY brand
        HAVING count(*) > 0.02 * (SELECT count(*) FROM vehicle_items)""",
    "p3_totals": """
        SELECT brand, count(*) AS n_rows, CAST(sum(registered_count) AS BIGINT) AS registered_count
        FROM vehicle_items GROUP BY brand""",
}
