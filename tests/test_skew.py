from collections import Counter

from vaunu.operators.skew import keys_above, salted_aggregate


def totals(rows):
    n, s = Counter(), {}
    for k, v in rows:
        n[k] += 1
        if v is not None:
            s[k] = s.get(k, 0) + v
    return {(k, n[k], s.get(k)) for k in n}


def test_salted_equals_plain(spark):
    rows = [("a", 1)] * 500 + [("b", None)] * 3 + [(None, 7)] * 400 + [(f"k{i}", i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(7)
    got = {tuple(r) for r in salted_aggregate(df, "k", {"total": "v"}).collect()}
    assert got == totals(rows)


def test_empty_and_clashing_names(spark):
    df = spark.createDataFrame([], "k string, v long, heavy_key int, _salt int")
    assert salted_aggregate(df, "k", {"total": "v"}).collect() == []
    df = spark.createDataFrame([("a", 1, 5, 6)], "k string, v long, heavy_key int, _salt int")
    assert [tuple(r) for r in salted_aggregate(df, "k", {"total": "v"}).collect()] == [("a", 1, 1)]


def test_keys_above_counts_null_rows(spark):
    rows = [("a", 1)] * 3 + [("b", 1)] * 5 + [(None, 1)] * 92
    t = salted_aggregate(spark.createDataFrame(rows, "k string, v long"), "k", {"total": "v"})
    assert [r.k for r in keys_above(t, "k", 0.03).collect()] == ["b"]
