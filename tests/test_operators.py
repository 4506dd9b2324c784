import pytest
from pyspark.sql import functions as F

from vaunu.functions import formats, text as T
from vaunu.operators import compare, enrich, guards, importing, index, makes, merge, models, orders, pairs, register, reports

ITEM = (
    "item_no long, id string, brand string, model string, variant string, years string, powertrain string, vehicle_type string, vehicle_class string, vehicle_group string, "
    "body_type string, co2 int, source_rank int, registered_count long, type_approval string, variant_code string, version_code string, "
    "source_records array<struct<id:string,type_approval:string>>"
)


def item(no, brand="Fiat", model="Ducato", variant="2.3, 100 kW", count=1, rank=1, **more):
    row = {
        "item_no": no, "id": f"i{no}", "brand": brand, "model": model, "variant": variant, "years": "2022", "powertrain": "diesel", "vehicle_type": "passenger", "vehicle_class": "M1",
        "vehicle_group": "", "body_type": "AC", "co2": 150, "source_rank": rank, "registered_count": count, "type_approval": "", "variant_code": "", "version_code": "", "source_records": None,
    }
    return tuple((row | more).values())


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), ITEM)


def test_resolve_makes(spark):
    rows = [("Mercedes-Benz", 500, 1), ("Mercedes-Benz-Dethleffs", 5, 2), ("De Lorean", 3, 3), ("DeLorean", 9, 4), ("Fiat", 200, 5), ("FIAT", 1, 6), ("Fiat-Pössl", 2, 7), ("Alfa Romeo", 50, 8), (None, 1, 9)]
    got = {r.brand: r.make for r in makes.resolve_makes(spark.createDataFrame(rows, "brand string, registered_count long, pos long")).collect()}
    assert got == {
        "Mercedes-Benz": "Mercedes-Benz", "Mercedes-Benz-Dethleffs": "Mercedes-Benz", "De Lorean": "DeLorean", "DeLorean": "DeLorean", "Fiat": "Fiat", "FIAT": "Fiat",
        "Fiat-Pössl": "Fiat", "Alfa Romeo": "Alfa Romeo",
    }


def test_model_names(spark):
    rows = [("BMW", "3", 1), ("BMW", "3-sarja", 1), ("BMW", "3er Reihe", 1), ("BMW", "3ER", 1), ("Skoda", "Ostavia", 2), ("Skoda", "OCTAVIA", 5), ("Toyota", "RAV 4 Hybrid", 1), ("Toyota", "Rav4", 3)]
    df = spark.createDataFrame(rows, "make string, model string, registered_count long")
    got = {(r.make, r.model): r.shown for r in models.model_names(df).collect()}
    assert {got["BMW", m] for m in ("3", "3-sarja", "3er Reihe", "3ER")} == {"3"}
    assert got["Skoda", "Ostavia"] == got["Skoda", "OCTAVIA"] == "Octavia"
    assert got["Toyota", "RAV 4 Hybrid"] == got["Toyota", "Rav4"] == "Rav4"


def test_merge_keeps_counts_and_lineage(spark):
    rows = [item(1, count=2, rank=4, co2=250), item(2, count=3, rank=2, co2=260), item(3, variant="2.8, 100 kW", count=7)]
    for order in (rows, rows[::-1]):
        got = {r.item_no: r for r in merge.normalize_catalog(frame(spark, *order)).collect()}
        assert set(got) == {2, 3} and got[2].merged_count == 5 and got[2].co2 == 260 and [x.id for x in got[2].lineage] == ["i1", "i2"] and got[2].lineage[0].body_type == "AC" and got[2].lineage[0].road_mass == 0
        assert got[3].lineage is None and got[3].merged_count == 7
    nameless = merge.normalize_catalog(frame(spark, *rows, item(4, brand=None, model=None, count=11))).agg(F.sum("merged_count")).first()
    assert nameless[0] == 23
    assert merge.normalize_catalog(frame(spark)).collect() == []


def test_enrich_takes_the_first_approval_then_the_least_penalty(spark):
    records = [("r1", "E1*A"), ("r2", "E1*B")]
    rows = [item(1, type_approval="", source_records=records, variant_code="V-1", co2=100), item(2, type_approval="E9"), item(3, type_approval=None)]
    candidates = spark.createDataFrame(
        [(10, "e1*b", "V1", None, 5.0, None, 100.0, None, 2020), (11, "e1*a", "X", None, 6.0, None, 100.0, None, 2020), (12, "e1*a ", "v1", None, None, 150.0, 103.0, None, 2021),
         (13, "e1*a", "V1", None, None, None, 100.0, None, 2020), (14, None, None, None, 1.0, None, None, None, 2020)],
        "cand_id long, tan string, va string, ve string, fc double, z_wh_km double, ewltp_g_km double, ep_kw double, report_year int",
    )
    assert [tuple(r) for r in enrich.enrich(frame(spark, *rows), candidates).collect()] == [(1, 12, 0, 3.0)]
    assert enrich.enrich(frame(spark), candidates).collect() == []


def test_picker(spark):
    rows = [
        item(1, "Toyota", "Corolla", count=5, powertrain="petrol"), item(2, "Toyota", "Corolla", count=5, powertrain="hybrid"), item(3, "Toyota", "Corolla", powertrain="diesel", vehicle_type="van"),
        item(4, "Volvo", "240", years="1985"), item(5, "Volvo", "V70", count=9), item(6, "Ferrari", "296 GTB", years="2023", count=1), item(7, "Ferrari", "Muu", count=3),
        item(8, "Lone", "Star"), item(9, "Umesläp", "X", count=5), item(10, "Faw", "E-HS9", variant="E-HS9, 400 kW", count=4), item(11, "Volvo", "4ov 1898cm3 A", variant="4ov 1898cm3 A, 120 kW", count=9),
    ]
    df = frame(spark, *rows)
    reasons = {(r.brand, r.model): r.reason for r in index.hide_reasons(df).collect()}
    assert reasons["Volvo", "240"] == "rare+old" and reasons["Ferrari", "296 GTB"] == "" and reasons["Ferrari", "Muu"] == "unknown"
    assert reasons["Lone", "Star"] == "rare-brand" and reasons["Umesläp", "X"] == "curated-hidden-brand" and reasons["Faw", "E-HS9"] == ""
    offered = index.selectable(df)
    kinds = {r.brand: {k: list(v) for k, v in r.kinds.items()} for r in index.availability_map(offered).collect()}
    assert kinds["Toyota"] == {"passenger": ["hybrid", "petrol"], "van": ["diesel"]} and set(kinds) == {"Toyota", "Volvo", "Ferrari", "Faw"}
    table = index.index_rows(offered)
    assert [r.model for r in index.facet_models(table, "Volvo").collect()] == ["V70"]
    assert {(r.facet, r.value) for r in index.facet_filters(offered, "van", "diesel").collect()} == {("brand", "Toyota"), ("powertrain", "diesel"), ("vehicle_type", "van"), ("vehicle_type", "passenger")}
    assert index.index_differences(table.limit(0), table).count() == table.count()
    bad = index.violations(df).first()
    assert bad.cm3 == 1 and bad.duplicate_ids == 0
    try:
        index.check_catalog(df)
        raise AssertionError("must raise")
    except ValueError as error:
        assert "cm3" in str(error)
    index.check_catalog(df.where("item_no < 4"), 11)


def test_reports(spark):
    df = frame(spark, item(1, model="Golf"), item(2, model="Golf", co2=99), item(3, model="Golf 2", count=20), item(4, model="Golf TDI"), item(5, brand=None))
    assert {(r.short_key, r.long_key) for r in reports.prefix_pairs(df).collect()} == {("golf", "golf2"), ("golf", "golftdi")}
    groups = reports.label_groups(df.where("brand is not null"), ["brand", "model"], ["co2", "years"])
    assert [tuple(r) for r in groups.collect()] == [("Fiat", "Golf", 2, "co2")]
    assert [tuple(r) for r in reports.field_frequency(groups).collect()] == [("co2", 1)] and reports.group_histogram(groups).collect()[0].n_groups == 1
    assert [(r.model, r.in_picker) for r in pairs.engine_report(df, df.limit(0)).collect()] == [("Golf TDI", False)]
    assert {r.brand: r.status for r in reports.make_report(df, df.limit(0)).collect()} == {"Fiat": "not-in-picker"}
    assert "all" in reports.pivot_matrix(index.model_statistics(df)).columns


def test_global_rank_over_many_partitions(spark):
    df = spark.range(5000).select(F.pmod(F.hash("id"), F.lit(100_003)).alias("x"), "id").repartition(13)
    got = register.global_rank(df, [F.asc("x"), F.asc("id")], "rank").orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 5001)) and got == sorted(got, key=lambda r: (r.x, r.id))


def test_compare(spark):
    df = spark.createDataFrame([(1, "s", 10.0, 30.0, None), (2, "s", 20.0, 0.0, "a"), (3, "s", 5.0, 1.0, "b")], "car int, sets string, fuel double, tax double, plan string")
    shares = {(r.car, r.line): (r.share, r.until) for r in compare.shares(compare.lines(df, "car", ["fuel", "tax"]), "car").collect()}
    assert shares[1, "tax"] == (0.75, 0.75) and shares[1, "fuel"] == (0.25, 1.0) and (2, "tax") not in shares
    assert {r.car: (r.delta, r.is_least) for r in compare.compare(df, "sets", "fuel").collect()} == {1: (5.0, False), 2: (15.0, False), 3: (0.0, True)}
    assert [tuple(r) for r in compare.differing_assumptions(df, "sets", ["plan"]).collect()] == [("s", "plan", 2, 2)]
    assert [r.car for r in compare.latest(df.select("sets", "car"), "sets", "car").collect()] == [3]
    rates = spark.createDataFrame([("wltp", i, float(i)) for i in range(401)], "method string, level int, rate double")
    cars = spark.createDataFrame([(1, "x", 900.0), (2, "nedc", 5.0), (3, None, 7.5)], "car int, m string, level double")
    assert {r.car: r.rate for r in compare.rate_lookup(cars, rates, "m", "level", 400, 1.5).collect()} == {1: 400.0, 2: 1.5, 3: 8.0}


def test_sanitize(spark):
    rows = [("Ab 1!", " Fiat ", "Punto", "PETROL", "12abc", None), ("0", "a", "b", "petrol", "1", "2"), ("x", "a", "b", "steam", "1", "2"), ("y", "a", None, "diesel", "1", "2"), ("z", "a", "b", "diesel", "abc", "-5")]
    got = importing.sanitize(spark.createDataFrame(rows, "id string, brand string, model string, powertrain string, mass string, service_cost string")).collect()
    assert [(r.id, r.brand, r.variant, r.powertrain, r.mass, r.service_cost, r.vehicle_type) for r in got] == [
        ("ab1", "Fiat", "Punto", "petrol", 12.0, 360.0, "passenger"), ("z", "a", "b", "diesel", 0.0, 0.0, "passenger"),
    ]
    assert T is not None


def test_pair_reports_and_gates(spark):
    df = frame(
        spark, item(1, "Volvo", "V70", count=9), item(2, "Volvo", "240", years="1985"), item(3, "Volvo", "X 1", variant="X-1, 9 kW", count=9), item(4, "VOLVO", "V 90", years="1980", count=5),
        item(5, "Volvo", "Amazon", years="1970", count=3),
    )
    offered = index.selectable(df).where("model != 'V70'")
    got = {r.model: (r.reason, r.status) for r in pairs.pair_report(df, offered, "volvo").collect()}
    assert got["240"] == ("rare+old", "hidden:rare+old") and got["X 1"] == ("designation", "hidden:designation") and got["V70"] == ("", "not-in-picker") and got["Amazon"][1] == "old"
    assert [r.registrations for r in pairs.pair_report(df, offered).collect()] == [1, 3, 5, 9, 9]
    assert {r.reason: r.n_pairs for r in pairs.hide_histogram(df, offered).collect()} == {"rare+old": 1, "designation": 1, "other": 1}
    assert pairs.reasons(df, rare_and_old=False).where("model = '240'").first().reason == ""
    matrix = {(r.bucket, r.decade): (r.kept, r.hidden) for r in pairs.rare_and_old_matrix(df).collect()}
    assert matrix["1", "1980"] == (0, 1) and matrix["2-9", "1970"] == (1, 0)
    stages = {r.stage: (r.n_rows, r.registrations, r.n_makes, r.n_models) for r in pairs.before_after(df, df.limit(0)).collect()}
    assert stages == {"before": (5, 27, 2, 5), "after": (0, 0, 0, 0)}
    pairs.gate(df.limit(0), "nothing")
    with pytest.raises(ValueError, match="worded: a / Golf Kombi"):
        pairs.gate(pairs.body_worded(spark.createDataFrame([("a", "Golf Kombi"), ("a", "Golf")], "brand string, model string")), "worded")


def test_index_guards(spark):
    offered = spark.createDataFrame([("A", "m", "van", "petrol"), ("A", "m", "van", "diesel"), ("b", "n", "bus", "diesel")], "brand string, model string, vehicle_type string, powertrain string")
    table = index.index_rows(offered)
    guards.check_index(table, offered, orders.makes_in_order(table), index.availability(offered))
    bad = table.where("brand = 'A'").unionByName(spark.createDataFrame([("A", "x TDI", "ship", ["steam"]), ("A", "x TDI", "ship", ["steam"]), ("A", "y Kombi", "van", [])], table.schema))
    found = {r.rule: r.n_rows for r in guards.index_violations(bad, offered, bad.select("brand").distinct(), index.availability(offered)).collect()}
    assert found == {
        "listed twice": 1, "missing": 1, "unexpected": 3, "other codes": 0, "no code": 1, "unknown code": 2, "engine word": 1, "body word": 1, "unknown type": 2, "makes differ": 1,
        "availability differs": 0,
    }
    with pytest.raises(ValueError):
        guards.check_index(bad, offered)
    with pytest.raises(ValueError):
        guards.check_index(table.limit(0), offered.limit(0))


def test_unique_labels_and_lock(spark, tmp_path):
    df = frame(spark, item(1), item(2), item(3, variant="x"), item(4, variant="2.3, 100 kW #9")).withColumn("body_label", F.lit(""))
    got = {r.item_no: r.variant for r in guards.unique_labels(df).collect()}
    assert got == {1: "2.3, 100 kW", 2: "2.3, 100 kW #2", 3: "x", 4: "2.3, 100 kW #9"}
    lock = str(tmp_path / "a" / "lock")
    with guards.build_lock(lock):
        with pytest.raises(RuntimeError), guards.build_lock(lock):
            pass
    with guards.build_lock(lock):
        pass


def test_orders_and_import_index(spark):
    df = frame(spark, item(1, "b", rank=2), item(2, "B", model="z", rank=1), item(3, "a", rank=1), item(4, "a", rank=None, powertrain="steam", vehicle_type=None))
    assert [r.item_no for r in orders.catalogue_order(df).collect()] == [4, 3, 2, 1]
    names = spark.createDataFrame([("Ärla",), ("coupe",), ("Coupé b",), ("Coupé",), ("Golf 10",), ("Golf 9",)], "n string")
    assert [r.n for r in orders.natural_order(names.where("n like 'G%'"), "n").collect()] == ["Golf 9", "Golf 10"]
    assert [r.n for r in orders.collated(names.where("n ilike 'c%'"), "n").collect()][-1] == "Coupé b"
    table = index.import_index(df)
    assert {(r.brand, r.vehicle_type): r.powertrains for r in table.where("brand = 'a'").collect()} == {("a", "passenger"): ["diesel"]}
    assert index.index_types(table) == ["passenger"] and index.index_types(table.limit(0)) == ["passenger"]
    assert {r.brand: r.vehicle_types for r in index.brand_types(table).collect()}["B"] == ["passenger"]


def test_formats(spark):
    row = spark.range(1).select(
        formats.filled(F.lit("%s of %2$s, %s %% %9$s"), F.lit("a"), F.lit(2)).alias("a"), formats.escaped(F.lit("<a href='x'>\"&")).alias("b"), formats.number_text(F.lit(-1234567.5)).alias("c"),
        formats.euro_text(F.lit(1234.5), 2).alias("d"), formats.start_year(F.lit("2004–2009")).alias("e"), formats.start_year(F.lit("1800")).alias("f"),
        (formats.folded_case(F.lit("Straße")) == formats.folded_case(F.lit("STRASSE"))).alias("g"),
    ).first()
    assert tuple(row) == ("a of 2, 2 %% ", "&lt;a href=&#039;x&#039;&gt;&quot;&amp;", "−1\u00a0234\u00a0568", "1\u00a0234,50\u00a0€", 2004, 0, True)
