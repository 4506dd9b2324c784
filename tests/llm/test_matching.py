import random

from pyspark.sql import functions as F

from vaunu.llm.matching import FEATURES, candidate_features, item_features, match, neighbours

ITEMS = "item_no long, type_approval string, variant_code string, version_code string, brand string, model string, variant string, powertrain string, co2 int, mass int, id string"
CANDS = "cand_id long, tan string, va string, ve string, mk string, cn string, ft string, ewltp_g_km double, m_kg double, ep_kw double, id string"


def item(no, serial="111111", va="AB12CD", ve="XY34ZW99", co2=150, mass=1500, kw=100, brand="Tila"):
    return (no, f"e5*2007/46*{serial}*23", va, ve, brand, "M 90", f"Usva 1.6, {kw} kW", "petrol", co2, mass, "x")


def cand(no, serial="111111", va="ab12cd", ve="XY34ZW99", co2=150.0, mass=1500.0, kw=100.0, mk="TILA Oy", tan=None):
    return (no, tan or (serial and f"E5*{serial}"), va, ve, mk, "M90", "PETROL", co2, mass, kw, "x")


def run(spark, items, cands):
    i, c = spark.createDataFrame(items, ITEMS), spark.createDataFrame(cands, CANDS)
    return {r.cand_id: r.item_no for r in match(item_features(i), candidate_features(c)).collect()}


def test_match(spark):
    items = [item(1), item(2, va="QQQQ11", ve="WWWW22", co2=170, mass=1600, kw=120), item(3, "222222", "KK55LL", "TT66UU77"), item(4)]
    cands = [
        cand(101), cand(102, va="A812CD", ve=None), cand(103, va=None, ve=None, mass=1605.0, co2=169.0, kw=119.6), cand(104, None, "KK55LL", "TT66UU7"),
        cand(105, va="ZZ99ZZ", ve="PP88PP88"), cand(106, va=None, ve=None, serial=None, co2=None, mass=1.0, kw=None, mk=None), cand(107),
    ]
    assert run(spark, items, cands) == {101: 1, 102: 1, 103: 2, 104: 3, 107: 1}
    assert run(spark, [], cands) == {} and run(spark, items, []) == {}


def test_neighbours_across_partitions(spark):
    random.seed(1)
    items = [item(i, f"{i % 40:06d}", f"V{i:05d}", f"E{i:07d}", mass=1000 + i) for i in range(2000)]
    cands = [cand(10_000 + i, f"{i % 40:06d}", f"V{i:05d}", None, mass=1000.0 + i) for i in range(0, 2000, 7)]
    left = item_features(spark.createDataFrame(items, ITEMS)).select("id", *FEATURES)
    right = candidate_features(spark.createDataFrame(cands, CANDS)).select("id", *FEATURES)
    got = {(r.left_id, r.right_id) for r in neighbours(left, right).collect()}
    assert {(i, 10_000 + i) for i in range(0, 2000, 7)} <= got


def test_hot_record(spark):
    items = [item(i) for i in range(1, 3000)] + [item(5000, va="AB12CE", ve="XY34ZX11", co2=190, mass=1900, kw=140)]
    got = run(spark, items, [cand(9001, va="AB12CE", ve=None, co2=190.0, mass=1900.0, kw=140.0), cand(9002)])
    assert got == {9001: 5000, 9002: 1} and F is not None


def test_hot_codes_of_different_rows(spark):
    """One variant code in all rows, far more than a window; other attributes tell the rows apart."""
    n = 600
    items = [item(i, f"{100000 + i % 7}", "HOT123", f"R{i * 7919 % 100003:06d}", 100 + i % 90, 1200 + i * 37 % 900, 60 + i * 13 % 120) for i in range(1, n + 1)]
    exact = [cand(10_000 + i, f"{100000 + i % 7}", "HOT123", f"R{i * 7919 % 100003:06d}", 101.0 + i % 90, 1210.0 + i * 37 % 900, 60.0 + i * 13 % 120) for i in range(1, n, 5)]
    left, right = item_features(spark.createDataFrame(items, ITEMS)), candidate_features(spark.createDataFrame(exact, CANDS))
    # without version code, approval and maker, the variant code and figures have to do
    bare = [cand(c[0] + 5000, None, "HOT123", None, *c[7:10], mk=None) for c in exact]
    assert {r.cand_id: r.item_no for r in match(left, right).collect()} == {c[0]: c[0] - 10_000 for c in exact}
    got = {(r.left_id, r.right_id) for r in neighbours(left, candidate_features(spark.createDataFrame(bare, CANDS))).collect()}
    assert {(c[0] - 15_000, c[0]) for c in bare} <= got


def test_hot_approval_and_maker(spark):
    """One approval, maker and power with many rows a kilogram; only co2 and mass are known besides."""
    items = [item(i, "111111", None, f"R{i * 7919 % 100003:06d}", 100 + i % 97, 1500 + i % 30) for i in range(1, 1501)]
    cands = [cand(10_000 + i, "111111", None, None, 100.0 + i % 97, 1515.0 + i % 30, 100.0) for i in range(1, 1500, 11)]
    cands += [cand(20_000 + i, None, None, None, 102.0 + i % 97, 1519.0 + i % 30, 100.0) for i in range(1, 1500, 11)]
    left, right = item_features(spark.createDataFrame(items, ITEMS)), candidate_features(spark.createDataFrame(cands, CANDS))
    got = {(r.left_id, r.right_id) for r in neighbours(left.select("id", *FEATURES), right.select("id", *FEATURES)).collect()}
    assert {(c[0] % 10_000, c[0]) for c in cands} <= got
