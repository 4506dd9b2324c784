import json
import shutil
import zipfile

import pytest

from vaunu.operators import index, register
from tests.test_operators import frame, item
from vaunu.sources import files

HEADER = "ajoneuvoluokka;merkkiSelvakielinen;kaupallinenNimi;kayttovoima;WLTP_Co2;ensirekisterointipvm"
LINES = ['M1;Fiat;"Ducato; long";02;120;2020-01-05', "N1;Ford;FORD Transit;01;;1999", "M1;Citroën;C4;04;0;", "L3;Moto;X;01;1;2000"]


def test_register_csv_and_zip(spark, tmp_path):
    text = "\r\n".join([HEADER, *LINES]) + "\r\n"
    (tmp_path / "r.csv").write_bytes(text.encode("iso-8859-1"))
    with zipfile.ZipFile(tmp_path / "r.zip", "w") as archive:
        archive.writestr("data.csv", text.encode("iso-8859-1"))
    plain, zipped = files.read_register(spark, str(tmp_path / "r.csv")), files.read_register_zip(spark, str(tmp_path / "r.zip"), lines=2)
    assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, zipped.collect()), key=str) and plain.columns == files.REGISTER
    items = register.catalog_items(register.ranked_configurations(register.register_view(plain.selectExpr("monotonically_increasing_id() as row_no", "*"))))
    got = {r.brand: (r.model, r.powertrain, r.co2, r.years, r.source_rank) for r in items.collect()}
    assert got == {"Fiat": ("Ducato; long", "diesel", 120, "2020", 2), "Ford": ("Transit", "petrol", 0, "1999", 3), "Citroën": ("C4", "electric", 0, "Tuntematon", 1)}


def test_shards(spark, tmp_path):
    rows = [(i, f"B{i % 5}", f"M{i % 7}") for i in range(100)] + [(500, "Toyota", "Rav4")]
    df = spark.createDataFrame(rows, "item_no long, brand string, model string")
    files.write_shards(df, str(tmp_path / "p"))
    files.write_json_shards(df, str(tmp_path / "j"))
    assert (tmp_path / "p" / "shard=31").is_dir()
    assert [r.item_no for r in files.read_shard(spark, str(tmp_path / "p"), "Toyota", "Rav4").collect()] == [500]
    back = spark.read.json(str(tmp_path / "j")).select("item_no", "brand", "model")
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "00.json").write_text(json.dumps([{"id": "x"}, {"id": "y"}]))
    assert sorted(r.id for r in files.read_json_shards(spark, str(tmp_path / "a")).collect()) == ["x", "y"]


def test_candidate_cache(spark, tmp_path):
    line = {"approvals": ["E1", "E2"], "candidates": [{"TAN": "e1", "Va": "v", "Fc": 5.5, "Year": 2020}]}
    (tmp_path / "c.jsonl").write_text(json.dumps(line) + "\n{broken\n")
    done, found = files.read_candidate_cache(spark, str(tmp_path / "c.jsonl"))
    assert sorted(r.approval for r in done.collect()) == ["E1", "E2"] and [(r.approval, r.Fc) for r in found.collect()] == [("E1", 5.5)]
    wanted = spark.createDataFrame([("E2",), ("E3",)], "approval string")
    assert [r.approval for r in files.pending_approvals(wanted, done).collect()] == ["E3"]


def test_admin_csv(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('ID,Brand,Model!,powertrain\na,Fiat,"Du,cato",petrol\nb,Fiat,X\nc,,Y,petrol\nd,Ford,"Z\nz",diesel\n')
    assert [(r.id, r.model) for r in files.read_admin_csv(spark, str(path)).collect()] == [("a", "Du,cato"), ("d", "Z\nz")]
    with pytest.raises(ValueError):
        files.read_admin_csv(spark, str(path), most_rows=1)
    with pytest.raises(ValueError):
        files.read_admin_csv(spark, str(path), most_bytes=10)


def test_rates_from_html(spark):
    pairs = [(i, i + 0.5) for i in range(12)]
    rows = "".join("<tr>" + "".join(f"<td>{a}</td><td>x</td><td><b>{str(r).replace('.', ',')}</b>&nbsp;</td>" for a, r in pairs[i : i + 2]) + "</tr>" for i in range(0, 12, 2))
    page = f"<h2>Other</h2><table><tr><td>9</td></tr></table><h2>Rates</h2><p/><table><tr><th>a</th></tr>{rows}</table>"
    pages = spark.createDataFrame([(page,)], "html string")
    assert sorted(map(tuple, files.rates_from_html(pages, "Rates", top=11).collect())) == pairs
    with pytest.raises(ValueError):
        files.rates_from_html(pages, "Rates", top=12)


def test_index_report_and_table(spark, tmp_path):
    offered = spark.createDataFrame([("A", "m", "van", "petrol"), ("A", "m", "van", "diesel")], "brand string, model string, vehicle_type string, powertrain string")
    files.write_index(index.index_rows(offered), index.availability(offered), str(tmp_path / "i"), 7)
    table, kinds, count = files.read_index(spark, str(tmp_path / "i"))
    assert [tuple(r) for r in table.collect()] == [("A", "m", "van", ["diesel", "petrol"])] == [tuple(r) for r in table.collect()] and count == 7 and kinds.count() == 1
    shutil.rmtree(tmp_path / "i" / "availability")
    assert [tuple(r) for r in files.read_index(spark, str(tmp_path / "i"))[1].collect()] == [("A", "van", ["petrol", "diesel"])]
    files.write_report(offered, str(tmp_path / "r"))
    assert spark.read.csv(str(tmp_path / "r"), header=True).count() == 2
    path = str(tmp_path / "t")
    assert files.replace_table(offered, path, "1") and not files.replace_table(offered, path, "1") and files.replace_table(offered, path, "2")
    assert files.replace_table(offered, path, "x", "imported") and not files.replace_table(offered, path, "3")
    assert files.read_catalogue(spark, path).count() == 2 and files.read_meta(spark, path)["source"] == "imported" and files.read_catalogue(spark, path + "x") is None
    assert len(files.uninstall(spark, [path, path + "x"], ["meta"], ["items-"])) == 2 and not files.exists(spark, f"{path}/meta")
    files.write_rates(spark.createDataFrame([("wltp", 1, 2.5), ("nedc", 1, 3.5)], "method string, level int, rate double"), str(tmp_path / "rates"))
    assert spark.read.parquet(str(tmp_path / "rates")).count() == 2
    assert files.settings({"a": "1,5", "b": "-3", "c": "x", "z": 9}, {"a": 1.0, "b": 2.0, "c": 3.0, "d": 4.0}) == {"a": 1.5, "b": 0.0, "c": 0.0, "d": 4.0}


def test_write_catalogue(spark, tmp_path):
    rows = [item(i, model=m, variant=v, count=n) for i, (m, v, n) in enumerate([("Ducato", "2.3, 100 kW", 5), ("Ducato", "2.3, 100 kW", 4), ("Punto", "1.2, 50 kW", 3), ("Punto Kombi", "1.4, 60 kW", 8)])]
    written, table = files.write_catalogue(frame(spark, *rows), str(tmp_path / "c"))
    assert sum(r.registered_count for r in written.collect()) == 20 and {r.model for r in table.collect()} == {"Ducato", "Punto"}
    assert spark.read.parquet(str(tmp_path / "c" / "shards")).count() == 3 and files.read_index(spark, str(tmp_path / "c" / "index"))[2] == 3
