from pathlib import Path

import duckdb
import pytest

import __spark_entry__

SOME = ["q_register_scan", "q_vehicle_type", "q_excluded_counts", "q_make_resolve", "q_merge", "q_enrich_ranked", "q_model_stats", "q_duplicates", "q_prefix_pairs", "q_invariants", "p3_found", "p3_totals"]


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for file in Path(sf).glob("*.parquet"):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def test_every_statement_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.parametrize("name", SOME)
def test_query_equals_sql(spark, sf, duck, name):
    frame = __spark_entry__.queries()[name](spark, sf)
    result = duck.sql(__spark_entry__.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(names)

    def rows(table, columns):
        order = sorted(range(len(columns)), key=lambda i: columns[i])
        return sorted((tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in table), key=repr)

    assert rows(frame.collect(), frame.columns) == rows(result.fetchall(), names)
