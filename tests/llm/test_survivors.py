import random
from datetime import datetime

from vaunu.llm.survivors import align, ballot, elect, field_winners, progressive, survivors, text_consensus
from pyspark.sql import functions as F

SCHEMA = (
    "item_no long, id string, brand string, model string, variant string, co2 int, source_rank int, "
    "registered_count long, updated_at timestamp, source_records array<struct<id:string>>, key string, value int"
)


def row(no, id="a", co2=None, rank=1, count=None, day=1, records=None, model="M"):
    return (no, id, "B", model, None, co2, rank, count, datetime(2024, 1, day), records and [(r,) for r in records], "k", 1)


def test_winners(spark):
    rows = [
        row(1, co2=0, rank=1, count=5, day=1, records=["x", "x", None]),
        row(2, co2=100, rank=3, count=None, day=9, records=["x", "y"]),
        row(3, co2=90, rank=2, count=7, day=3, records=["z", "y"]),
        row(4, "b"), row(5, "b", day=2), row(6, "c"), row(7, None), row(8, None),
    ]
    got = {r.id: tuple(r)[1:5] for r in field_winners(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {"a": (3, 3, 3, 2), "b": (2, None, None, 5)}


def test_survivors_and_empty(spark):
    rows = [row(1, model="Tila  60"), row(2, model="Tila 60"), row(3, model="TILA 60"), row(4, "b")]
    got = survivors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.id, r.model, r.brand, r.variant) for r in got] == [("a", "Tila 60", "B", None)]
    assert survivors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_align():
    assert align([{"a": 1}, {"b": 1}, {"c": 1}], "a x b c".split()) == (2, [0, -2, 1, 2])
    assert align([{"a": 1}], ["A"]) == (1, [0]) and align([{"a": 1}], []) == (2, []) and align([], ["a"]) == (2, [-1])


def test_progressive_alignment_shares_new_columns():
    """The second spelling's new column is met by the third, which is aligned with the profile, not with the centre."""
    votes = progressive("a b", [("a b", 3.0), ("a x b", 1.0), ("a X y b", 1.0)])
    assert {v[:3] for v in votes if v[0] == 2} == {(2, 0, "x"), (2, 0, "X"), (2, 1, "y")}
    assert sum(w for _, _, t, w in votes if t == "a") == 5.0
    assert progressive("a", [("a", 1.0)]) == [(1, 0, "a", 1.0)]


def test_elect_is_exact(spark):
    """Elected values against brute force: rows of one group with random values and trust."""
    rng = random.Random(5)
    rows = [(k, f, ["list", *{rng.choice("pqrs") for _ in range(rng.randint(0, 4))}] if f == "records" else [f"{f}={rng.randint(1, 3)}"], rng.randint(1, 3), no)
            for no, (k, f) in enumerate((k, f) for k in "abcdef" for f in ("co2", "records") for _ in range(6))]
    got = {(r.key, r.field): r.no for r in elect(spark.createDataFrame(rows, "key string, field string, tokens array<string>, trust long, no long")).collect()}
    want = {}
    for key, field, tokens, trust, no in rows:
        want.setdefault((key, field), []).append((-len(tokens) if field == "records" else 0, trust, no))
    assert got == {k: min(v)[2] for k, v in want.items()}


def test_consensus_of_a_hot_group(spark):
    rows = [("g", f"Usva 1.6 Sedan{'' if i % 3 else ' x' + str(i)}") for i in range(3000)] + [("g", None), ("g", " "), ("h", None)]
    df = spark.createDataFrame(rows, "k string, v string")
    assert [tuple(r) for r in text_consensus(df, "k", "v", F.lit(1)).collect()] == [("g", "Usva 1.6 Sedan")]


def test_ballot_sums_weights_and_carries_the_most_trusted_row():
    votes = ballot(["co2=90"], [(["co2=90"], 1, 7), (["co2=100"], 2, 3), (["co2=80"], 2, 1)])
    assert sorted(votes) == [("1 0", "co2=100", 2, 3), ("1 0", "co2=80", 2, 1), ("1 0", "co2=90", 1, 7)]
    votes = ballot(["a", "b"], [(["a", "b"], 5, 2), (["b", "c"], 4, 9), (["c"], 6, 1)])
    assert sorted(votes) == [("a", "a", 5, 2), ("b", "b", 4, 9), ("c", "c", 4, 9)]
    many = [([f"x={i}"], i, i) for i in range(2000)]  # more rows than a double has bits
    assert min(ballot(["x=0"], many), key=lambda v: v[2:]) == ("1 0", "x=0", 0, 0)


def test_winners_come_from_the_votes(spark):
    """The plan of the winners runs the operator, and a hot group of many blocks agrees with the order of trust."""
    rng = random.Random(2)
    rows = [row(i, co2=rng.randint(0, 500), rank=rng.randint(1, 3), count=rng.randint(1, 400), day=rng.randint(1, 28), records=rng.sample([f"r{k}" for k in range(300)], rng.randint(1, 60))) for i in range(1500)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = field_winners(df)
    assert "MapInPandas" in got._jdf.queryExecution().toString()
    want = [min((r for r in rows if r[5] > 0), key=lambda r: (r[6], r[0]))[0], min(rows, key=lambda r: (-r[8].toordinal(), r[0]))[0],
            min(rows, key=lambda r: (-len({x[0] for x in r[9]}), -r[8].toordinal(), r[0]))[0]]
    assert [tuple(r) for r in got.collect()] == [("a", 1500, *want)]
