"""Readers and writers: register extract, shards, caches, tables in HTML, reports."""

from __future__ import annotations

import io
import re
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaunu.operators.guards import check_index, unique_labels
from vaunu.operators.index import availability, check_catalog, count_of, index_availability, index_rows, model_shard, selectable
from vaunu.operators.merge import normalize_catalog
from vaunu.operators.orders import index_order
from vaunu.session import materialize

REGISTER = (
    "ajoneuvoluokka merkkiselvakielinen kaupallinennimi mallimerkinta kayttovoima tieliiksuursallkokmassa teknsuursallkokmassa omamassa tyyppihyvaksyntanro variantti "
    "versio korityyppi ajoneuvoryhma istumapaikkojenlkm ensirekisterointipvm suurinnettoteho sahkohybridi sahkohybridinluokka wltp2_co2 wltp_co2 nedc2_co2 nedc_co2"
).split()


def _register_columns(table: DataFrame) -> DataFrame:
    named = {c.lower(): c for c in table.columns}
    return table.select(*[F.col(f"`{named[c]}`").cast("string").alias(c) if c in named else F.lit(None).cast("string").alias(c) for c in REGISTER])


def read_register(spark: SparkSession, path: str) -> DataFrame:
    """A register extract (semicolons, ISO-8859-1) as texts; columns it lacks are null, others are not read."""
    table = spark.read.csv(path, sep=";", header=True, encoding="ISO-8859-1", inferSchema=False)
    return _register_columns(table)


def read_register_zip(spark: SparkSession, path: str, lines: int = 50_000) -> DataFrame:
    """The first member of ZIP archives of one layout, unpacked line by line where it is read and parsed afterwards.

    Each archive is unpacked by one task that holds its compressed bytes; extract very large ones first.
    """

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as archive, archive.open(archive.namelist()[0]) as raw:
                    text, header, rows = io.TextIOWrapper(raw, encoding="iso-8859-1"), None, []
                    for line in text:
                        line = line.rstrip("\r\n")
                        if header is None:
                            header = line
                            continue
                        rows.append((header, line))
                        if len(rows) == lines:
                            yield pd.DataFrame(rows, columns=["header", "line"])
                            rows = []
                    yield pd.DataFrame(rows, columns=["header", "line"])

    pairs = spark.read.format("binaryFile").load(path).select("content").mapInPandas(unpack, "header string, line string")
    header = pairs.select("header").first()
    names = [n.strip().strip('"').lower() for n in header.header.split(";")] if header else []
    schema = ", ".join(f"`{n}` string" if n and n not in names[:i] else f"`_c{i}` string" for i, n in enumerate(names)) or "`_c0` string"
    table = pairs.select(F.from_csv("line", schema, {"sep": ";", "mode": "PERMISSIVE"}).alias("r")).select("r.*")
    return _register_columns(table)


def write_shards(items: DataFrame, path: str) -> None:
    """Items by shard as Parquet, replacing what is there; a point read prunes to one folder."""
    items.withColumn("shard", model_shard(F.col("brand"), F.col("model"))).repartition("shard").write.mode("overwrite").partitionBy("shard").parquet(path)


def write_json_shards(items: DataFrame, path: str) -> None:
    """The same as gzipped JSON for exchange."""
    shards = items.withColumn("shard", model_shard(F.col("brand"), F.col("model"))).repartition("shard")
    shards.write.mode("overwrite").partitionBy("shard").option("compression", "gzip").json(path)


def read_json_shards(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All shards; files of one JSON array each, or of one object a line."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_shard(spark: SparkSession, path: str, brand: str, model: str) -> DataFrame:
    """The items of one model, from its shard only."""
    shard = spark.range(1).select(model_shard(F.lit(brand), F.lit(model)).alias("s")).first().s
    return spark.read.parquet(path).where((F.col("shard").cast("string") == shard) & (F.col("brand") == brand) & (F.col("model") == model))


CACHE = "approvals array<string>, candidates array<struct<TAN:string,Va:string,Ve:string,Mk:string,Cn:string,Ft:string,Fc:double,`Z (Wh/km)`:double,`Ewltp (g/km)`:double,`M (kg)`:double,`Ep (KW)`:double,Year:int>>"


def read_candidate_cache(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Completed approvals, and candidates by ``approval``; lines that are no JSON are skipped."""
    lines = spark.read.schema(CACHE).json(path, mode="DROPMALFORMED")
    done = lines.select(F.explode("approvals").alias("approval")).distinct()
    found = lines.select(F.explode("candidates").alias("c")).select(F.upper("c.TAN").alias("approval"), "c.*")
    return done, found


def append_candidate_cache(lines: DataFrame, path: str) -> None:
    lines.write.mode("append").json(path)


def pending_approvals(wanted: DataFrame, done: DataFrame) -> DataFrame:
    return wanted.join(done, "approval", "left_anti")


def read_admin_csv(spark: SparkSession, path: str, most_rows: int = 250_000, most_bytes: int = 20 * 1024 * 1024) -> DataFrame:
    """A typed CSV: header names cleaned, rows of another width or without a required column skipped; larger files are refused."""
    if file_size(spark, path) > most_bytes:
        raise ValueError("the file is too large")
    head = spark.read.csv(path, header=False, multiLine=True, escape='"').first()
    if head is None:
        raise ValueError("the file is empty")
    names = [re.sub(r"[^a-z0-9_]", "", (h or "").lower().strip().lstrip("\ufeff")) for h in head]
    schema = ", ".join(f"`{n}` string" if n and n not in names[:i] else f"`_c{i}` string" for i, n in enumerate(names))
    # cells may hold line breaks, so the reader splits the rows
    parsed = spark.read.csv(path, schema=schema + ", _bad string", header=True, multiLine=True, escape='"', enforceSchema=True, columnNameOfCorruptRecord="_bad", mode="PERMISSIVE")
    good = parsed.where(F.col("_bad").isNull()).drop("_bad")
    for column in ("id", "brand", "model", "powertrain"):
        good = good.where(F.trim(F.coalesce(column, F.lit(""))) != "") if column in names else good.limit(0)
    if good.limit(most_rows + 1).count() > most_rows:
        raise ValueError("too many rows")
    return good


def rates_from_html(pages: DataFrame, heading: str, top: int = 400) -> DataFrame:
    """``level, rate`` of the first table after a heading: rows of six cells are two pairs; all levels from 0 to ``top`` must be there.

    ``pages`` has one ``html`` each.
    """
    table = F.regexp_extract("html", "(?s)" + re.escape(heading) + r".*?(<table.*?</table>)", 1)
    rows = pages.select(F.explode(F.regexp_extract_all(table, F.lit(r"(?s)<tr.*?</tr>"), F.lit(0))).alias("tr"))
    cells = F.transform(
        F.regexp_extract_all("tr", F.lit(r"(?s)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)),
        lambda c: F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", ""), "&nbsp;| ", " "), r"\s+", " ")),
    )
    six = rows.select(cells.alias("c")).where((F.size("c") == 6) & F.get("c", F.lit(0)).rlike(r"^\d"))
    pairs = six.selectExpr("stack(2, c[0], c[2], c[3], c[5]) as (level, rate)")
    number = F.regexp_replace(F.replace("rate", F.lit(","), F.lit(".")), r"[^0-9.]", "").try_cast("double")
    found = pairs.select(F.regexp_extract("level", r"(\d+)", 1).try_cast("int").alias("level"), number.alias("rate")).where("level is not null")
    check = found.agg(F.count_distinct("level"), F.count(F.lit(1)), F.min("level"), F.max("level")).first()
    if tuple(check) != (top + 1, top + 1, 0, top):
        raise ValueError(f"the table has other levels than 0 to {top}: {tuple(check)}")
    return found


def write_index(index: DataFrame, availability: DataFrame, path: str, count: int | None = None) -> None:
    """The picker's index as lines of JSON in order: ``models``, ``availability`` a make and type, and ``meta`` with the counts.

    No row holds more than one model or one make's type, so the index may be of any size.
    """
    index_order(index).write.mode("overwrite").json(f"{path}/models")
    availability.orderBy("brand", "vehicle_type").write.mode("overwrite").json(f"{path}/availability")
    meta = index.agg(F.count(F.lit(1)).alias("n_models"), F.lit(count).cast("long").alias("count"))
    meta.coalesce(1).write.mode("overwrite").json(f"{path}/meta")  # one row


def read_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, int]:
    """``index, availability, count`` as :func:`write_index` wrote them; an availability that is missing is rebuilt from the rows."""
    index = spark.read.schema("brand string, model string, vehicle_type string, powertrains array<string>").json(f"{path}/models")
    if exists(spark, f"{path}/availability"):
        kinds = spark.read.schema("brand string, vehicle_type string, powertrains array<string>").json(f"{path}/availability")
    else:
        kinds = index_availability(index)
    meta = spark.read.schema("n_models long, count long").json(f"{path}/meta").first() if exists(spark, f"{path}/meta") else None
    return index, kinds, int(meta["count"] or 0) if meta else 0


def write_rates(rates: DataFrame, path: str) -> None:
    """A table ``method, level, rate``, one row for each pair, in order."""
    if not rates.groupBy("method", "level").count().where("count > 1").isEmpty():
        raise ValueError("a level has several rates")
    rates.select("method", "level", "rate").orderBy("method", "level").coalesce(1).write.mode("overwrite").parquet(path)  # a few hundred levels


def settings(given: dict[str, object], defaults: dict[str, float]) -> dict[str, float]:
    """Known settings only, as numbers of at least 0 with comma or point; those not given have their default."""
    out = {}
    for name, default in defaults.items():
        if given.get(name) is None:
            out[name] = default
        else:
            found = re.match(r"\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?", str(given[name]).replace(",", "."))
            out[name] = max(0.0, float(found[0])) if found else 0.0
    return out


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _files(spark, path)
    return files.exists(place)


def file_size(spark: SparkSession, path: str) -> int:
    """Bytes under a path on any file system."""
    files, place = _files(spark, path)
    return files.getContentSummary(place).getLength()


def uninstall(spark: SparkSession, roots: list[str], names: list[str], prefixes: list[str] = ()) -> list[str]:
    """Delete the named entries, and those that begin with a prefix, under each root; what was deleted."""
    gone = []
    for root in roots:
        files, place = _files(spark, root)
        if not files.exists(place):
            continue
        for status in files.listStatus(place):
            name = status.getPath().getName()
            if name in names or any(name.startswith(p) for p in prefixes):
                files.delete(status.getPath(), True)
                gone.append(f"{root}/{name}")
    return gone


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").csv(path, header=True)


def read_meta(spark: SparkSession, path: str) -> dict[str, str]:
    """Source, version and folder of the catalogue in force; a table that isn't there is an unnamed custom one."""
    if not exists(spark, f"{path}/meta"):
        return {"source": "custom", "version": "", "items": ""}
    return spark.read.schema("source string, version string, items string").json(f"{path}/meta").first().asDict()


def read_catalogue(spark: SparkSession, path: str) -> DataFrame | None:
    meta = read_meta(spark, path)
    return spark.read.parquet(f"{path}/{meta['items']}") if meta["items"] else None


def replace_table(items: DataFrame, path: str, version: str, source: str = "bundled") -> bool:
    """Replace a catalogue; a bundled one never replaces an imported one or one of the same version.

    The items go to a new folder and the meta row, written last, names it: a reader sees the old catalogue
    or the new one, never a mixture. Errors of reading are raised, not taken for a missing catalogue.
    """
    spark = items.sparkSession
    meta = read_meta(spark, path)
    if meta["items"] and source == "bundled" and (meta["source"] != "bundled" or meta["version"] == version):
        return False
    folder = f"items-{uuid.uuid4().hex}"
    items.write.parquet(f"{path}/{folder}")
    fresh, kept = f"{path}/meta-{folder}", f"{path}/meta"
    spark.createDataFrame([(source, version, folder)], "source string, version string, items string").coalesce(1).write.json(fresh)
    files, place = _files(spark, kept)
    files.delete(place, True)
    files.rename(_files(spark, fresh)[1], place)
    if meta["items"]:
        old, at = _files(spark, f"{path}/{meta['items']}")
        old.delete(at, True)
    return True


def write_catalogue(raw: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Normalize, check and write a catalogue: shards, then the index; ``items, index`` as written.

    Raises before anything is written if the sum of registrations changed or a guard is broken.
    """
    total = raw.agg(F.sum(count_of())).first()[0] or 0
    items = materialize(unique_labels(normalize_catalog(raw).withColumn("registered_count", F.col("merged_count"))))
    check_catalog(items, total)
    offered = materialize(selectable(items))
    index = index_rows(offered)
    kinds = availability(offered)
    check_index(index, offered, index.select("brand").distinct(), kinds)
    write_shards(items, f"{path}/shards")
    write_index(index, kinds, f"{path}/index", items.count())
    return items, index
