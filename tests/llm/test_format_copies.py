import re
from collections import defaultdict

from vaunu.llm.format_copies import PART, canonical_parts, collapse, format_copies
from pyspark.sql import functions as F

COLS = "item_no long, model string, variant string, mass int, note string, note2 double"


def brute(rows):
    def key(t):
        return None if t is None else sorted(p.replace(",", ".") for p in re.findall(r"[0-9]+(?:[.,][0-9]+)*|[^\W\d_]+", t.lower()))

    groups = defaultdict(list)
    for no, m, v, *rest in rows:
        groups[str((key(m), key(v), rest[0], rest[2]))].append(no)
    return {(min(g), n) for g in groups.values() for n in g if n != min(g)}


def test_copies_equal_brute_force_with_a_hot_group(spark):
    rows = [(i, "Tila 20", "Usva 2.6, 3ov" if i % 2 else "3 OV / usva 2,6", 5, str(i), 0.0) for i in range(600)]
    rows += [(1000 + i, f"M {i % 50}", None if i % 3 else "", i % 2, "x", float("nan")) for i in range(300)]
    rows += [(5000, "Tila 20", "Usva 26, 3ov", 5, None, 0.0), (5001, "Tila 2.0", "Usva 2.6, 3ov", 5, None, -0.0)]
    rows += [(5002, "Tila 20", "Usva 2.6, 3ov", None, None, 0.0)]
    df = spark.createDataFrame(rows, COLS).repartition(5)
    got = {tuple(r) for r in format_copies(df, "item_no", ["model", "variant"], ["note"]).collect()}
    assert got == brute([(*r[:5], str(r[5]).replace("-0.0", "0.0")) for r in rows])
    whole = collapse(df, "item_no", ["model", "variant"], ["note"])
    assert whole.agg(F.sum("n_copies")).first()[0] == len(rows)
    assert {r.item_no: r.n_copies for r in whole.collect()}[0] == 600


def test_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([], "item_no long, model string, key string, hash int")
    assert format_copies(df, "item_no", ["model"], []).collect() == []
    df = spark.createDataFrame([(2, "A-b", "k", 1), (1, "b a", "k", 1), (3, "b a", "K", 1)], df.schema)
    assert [tuple(r) for r in format_copies(df, "item_no", ["model"], []).collect()] == [(1, 2)]


def test_parts(spark):
    texts = ["3ov  (AA)", "(aa) 3 OV", "1,5", "1.5", "1 5", "Ä ö", "ö Ä!", None, "", "ab " * 50_000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.p for r in df.orderBy("i").select(canonical_parts(F.col("t")).alias("p")).collect()]
    assert got[0] == got[1] and got[2] == got[3] != got[4] and got[5] == got[6] and got[7] is None and got[8] == ""
    assert len(got[9]) == 3 * 50_000 - 1 and PART


def test_white_space_between_letters(spark):
    rows = [(1, "GasBrix 10"), (2, "brix-10 gas"), (3, "Gas Brix 10"), (4, "GASBRIX/10"), (5, "Gas Brix 1 0"), (6, None)]
    df = spark.createDataFrame(rows, "item_no long, model string")
    assert {tuple(r) for r in format_copies(df, "item_no", ["model"], []).collect()} == {(1, 3), (1, 4), (1, 2)}
