from pyspark.sql import functions as F

from vaunu.functions import classify as C
from vaunu.functions import text as T

c = F.col


def run(spark, rows, expression):
    """The value of an expression over rows of up to four texts a, b, c, d."""
    wide = [(i, *r, *[None] * (4 - len(r))) for i, r in enumerate(rows)]
    df = spark.createDataFrame(wide, "i int, a string, b string, c string, d string")
    return [r.x for r in df.select("i", expression.alias("x")).orderBy("i").collect()]


def single():
  return [
    (T.clean(c("a")), [("  a  b\t", "a b"), (None, ""), ("", "")]),
    (T.fold(c("a")), [("Citroën C-4", "citroenc4"), ("Ｆ１ ß²™", "f1ss2tm"), ("Ø½", "12"), (None, ""), ("Golf Ⅱ", "golfii"), ("㎏ ⑫", "kg12")]),
    (T.make_key(c("a")), [("De_Lorean-X  é", "de lorean x é"), ("(SLO)", "slo"), ("Ｆｉａｔ e\u0301", "fiat é"), ("STRASSE Straße", "strasse strasse")]),
    (T.make_token(c("a")), [("Mercedes-Benz", "Mercedes"), ("Alfa Romeo", "Alfa"), ("", "")]),
    (T.normalize_make(c("a")), [
        ("Mb-Dethleffs", "Mercedes-Benz-Dethleffs"), ("Bürstner GmbH", "Bürstner"), ("Vw", "Volkswagen"), ("BWW", "BMW"), ("mercedes", "Mercedes-Benz"),
        ("Tri Oy Ab", "Tri"), ("Tri Oy Ab Ltd Gmbh Inc Srl (fi)", "Tri"), ("Oy", "Oy"), ("Adria (SLO)", "Adria"), ("Karma Automotive Llc", "Karma"), ("Mercedes Benz", "Mercedes-Benz"),
    ]),
    (T.strip_engine_words(c("a")), [("CLIO (E-Tech Hybrid)", "CLIO"), ("A6 50 TFSI e", "A6 50"), ("Hybrid", "Hybrid"), ("Golf SÄHKÖ", "Golf"), ("CNG-Technik", "CNG-Technik"), ("Caddy CNG", "Caddy")]),
    (T.strip_body_words(c("a")), [("Astra Sports Tourer", "Astra"), ("Kombi", "Kombi"), ("TT Coupe", "TT Coupe")]),
    (T.strip_detail(c("a")), [("2.0 [CO₂ 120; x]", "2.0"), ("a [b] c", "a [b] c")]),
    (T.variant_base(c("a")), [("2.0 TDI, 66 kW (e1*2)", "2.0 TDI"), ("2.0, 66,5 kW", "2.0")]),
    (T.clean_variant(c("a")), [
        ("INSIGHT Viistoperä (AB) 4ov 1339cm3, 65 kW", "INSIGHT 1.3, 65 kW"), ("Farmari (AC) 5ov", ""), ("X 1995cm3", "X 2"), ("Y 1,9 1898cm3", "Y 1.9"),
        ("", ""), ("5D PASSAT 1.9TDI-3B/271, 66 kW", "PASSAT 1.9TDI, 66 kW"), ("D-4D 950cm3", "D-4D 0.9"), ("Z 1350cm3", "Z 1.4"), ("Z 1250cm3", "Z 1.2"),
    ]),
    (T.strip_code_letter(c("a")), [("2 A, 140 kW", "2, 140 kW"), ("A-2D", "A-2D")]),
    (T.numeric(c("a")), [("1,5", 1.5), ("1d", 0.0), (None, 0.0), (" 7 ", 7.0), ("x", 0.0), ("1_000", 0.0)]),
    (T.first_year(c("a")), [("12.3.2004", 2004), ("20040312", 2004), ("", None), (None, None)]),
    (T.years_label(*T.year_span(c("a"))), [("9999–0", "Tuntematon"), ("2020–2024", "2020–2024"), ("2005-2005", "2005"), ("2027", "Tuntematon"), (None, "Tuntematon")]),
    (T.natural_key(c("a")) < T.natural_key(F.lit("Golf 10")), [("golf 9", True), ("golf 11", False), ("Fiat 500", True), ("golf " + "9" * 25, False)]),
    (T.is_technical(c("a")), [("112 CDI", True), ("C 220 Cdi", False), ("911", False), ("4ov 1.9", True), ("VIISTOPERÄ", True)]),
    (C.body_label(c("a")), [("ac", "Farmari"), ("ZZ", ""), (None, "")]),
    (C.power_source(c("a")), [("02", "diesel"), ("99", "petrol"), (None, "petrol")]),
]
def pairs():
  return [
    (T.strip_make(c("a"), c("b")), [
        ("Porsche", "PORCHE 928", "928"), ("Land Rover", "LANDROVER DEFENDER 130", "DEFENDER 130"), ("Ford", "Ford Transit", "Transit"),
        ("Mazda", "MAZDA2 HYBRID", "MAZDA2 HYBRID"), ("Ford", "Fordson Estate Car 83W", "Fordson Estate Car 83W"), ("Volvo", "VOLVO(S)", "VOLVO(S)"), ("Ford", "Ford", "Ford"),
        ("Volkswagen", "VW PASSAT", "PASSAT"), ("Mercedes-Benz", "MB C 220", "C 220"), ("MB", "M-B E200", "E200"), ("Bmw", "M 550d", "M 550d"), ("Acbus", "MB Sprinter", "MB Sprinter"),
        ("Adria", "ADRIATIK Coral S 660 SL", "Coral S 660 SL"), ("Ford", "Fordd " + "w " * 149 + "end", "w " * 149 + "end"),
    ]),
    (T.normalize_model(c("a"), c("b")), [("Volkswagen", "VOLKSWAGEN PASSAT", "Passat"), ("Bmw", "X5", "X5")]),
    (T.series_key(c("a"), c("b")), [("BMW", "3-sarja", "3"), ("BMW", "3er Reihe", "3"), ("BMW", "3ER", "3"), ("Toyota", "RAV 4 Hybrid", "rav4"), ("Toyota", "Land Cruiser (150 Series)", "landcruiser150")]),
    (T.strip_model_from_variant(c("a"), c("b")), [("INSIGHT", "Insight 1.3, 65 kW", "1.3, 65 kW"), ("Golf", "Golfer 2", "Golfer 2"), ("Golf", "Golf", "Golf")]),
    (T.visible_variant(c("a"), c("b")), [("2.0 (e1*x) a", "e1*x", "2.0 a"), ("2.0", None, "2.0")]),
    (T.is_designation(c("a"), c("b")), [("4ov 1898cm3 A", "4ov 1898cm3 A, 120 kW", True), ("Golf", "Golf 2.0", False), ("", "", False)]),
    (T.is_unknown(c("a"), c("b")), [("Ford", "Electric", True), ("Ford", "FORD", True), ("Ford", "Muu", True), ("Ford", "Focus", False), ("Mercedes-Benz", "MB", True), ("Adria", "Adriatik", True), ("Ford", "MB", False)]),
]


def check(spark, table, width):
    wrong = []
    for expression, cases in table:
        for case, got in zip(cases, run(spark, [x[:width] for x in cases], expression)):
            if got != case[width]:
                wrong.append((case, got))
    assert not wrong


def test_single(spark):
    check(spark, single(), 1)


def test_pairs(spark):
    check(spark, pairs(), 2)


def test_vehicle_type(spark):
    cases = [
        ("M1", "SA", "", "motorhome"), ("N1", "BB", "", "van"), ("N1", "BA", "", "light_truck"), ("M2", "CA", "", "minibus"), ("M3", "CA", "", "bus"),
        ("M1", "", "29", "motorhome"), ("M1", "", "21, 29", "motorhome"), ("M1", "", "42", "bus"), ("M1", "SC", None, "special"), ("m1", "be", "", "pickup"),
    ]
    assert run(spark, [x[:3] for x in cases], C.vehicle_type(c("a"), c("b"), c("c"))) == [x[3] for x in cases]


def test_powertrain(spark):
    cases = [("04", "true", "01", "electric"), ("01", "true", "01", "phev"), ("02", "TRUE", "02", "hybrid"), ("02", None, None, "diesel"), ("Diesel", "", "", None)]
    assert run(spark, [x[:3] for x in cases], C.powertrain(c("a"), c("b"), c("c"))) == [x[3] for x in cases]


def test_emission_and_estimates(spark):
    picked = C.emission((c("a"), "wltp"), (c("b"), "nedc"))
    assert [tuple(x) for x in run(spark, [("0", "120,5"), ("99", "1"), (None, "")], picked)] == [(120, "nedc"), (99, "wltp"), (0, "wltp")]
    assert run(spark, [("diesel",), ("petrol",), ("hybrid",), ("phev",), ("electric",)], C.fuel_estimate(c("a"), F.lit(0))) == [6.2, 6.8, 5.0, 2.2, 0.0]
    assert run(spark, [("electric",), ("phev",), ("petrol",)], C.electricity_estimate(c("a"), F.lit(1800))) == [21.0, 19.5, 0.0]
    masses = [(kind, m) for kind in ("electric", "phev") for m in range(400, 3000, 7)] + [("electric", 783), ("phev", 1230)]
    rows = spark.createDataFrame(masses, "a string, m int").select(C.electricity_estimate(c("a"), c("m")).alias("x")).collect()
    assert [r.x for r in rows] == [round(max(15, min(26, 11 + m / 180)), 1) if k == "electric" else round(max(16, min(24, 10.5 + m / 200)), 1) for k, m in masses]
    known, source = C.mass_fallback(c("a").cast("int"), c("b").cast("int"), c("c").cast("int"))
    assert run(spark, [("0", "5", "6"), (None, None, "6"), ("1", "2", "3"), (None, None, None)], F.concat_ws(":", known, source)) == [
        "5:technical_fallback", "6:curb_mass_fallback", "1:road_traffic", "0:unknown",
    ]
