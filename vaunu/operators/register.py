"""From raw register rows to ranked configurations and catalogue items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaunu.functions import classify, rules
from vaunu.functions import text as T
from vaunu.session import materialize

KEY = [
    "vehicle_class", "body_type", "seats", "brand", "model", "designation", "commercial_name", "type_approval", "variant_code", "version_code", "powertrain",
    "co2", "tax_measurement", "tax_power_source", "road_mass", "technical_mass", "curb_mass", "power", "vehicle_group",
]


def _whole(column: str) -> Column:
    return F.bround(T.numeric(F.col(column))).cast("int")


def register_view(rows: DataFrame, strip_makes: bool = True) -> DataFrame:
    """Typed, cleaned and classified register rows; nothing is filtered yet.

    Only named columns are read. ``strip_makes`` takes a repeated make off the model.
    """
    c = F.col
    picked = classify.emission((c("wltp2_co2"), "wltp"), (c("wltp_co2"), "wltp"), (c("nedc2_co2"), "nedc"), (c("nedc_co2"), "nedc"))
    view = rows.select(
        "row_no",
        F.upper(T.clean(c("ajoneuvoluokka"))).alias("vehicle_class"),
        F.upper(T.clean(c("korityyppi"))).alias("body_type"),
        _whole("istumapaikkojenlkm").alias("seats"),
        T.clean(c("merkkiselvakielinen")).alias("brand"),
        T.or_whole(T.clean(c("kaupallinennimi")), T.clean(c("mallimerkinta"))).alias("model"),
        T.clean(c("mallimerkinta")).alias("designation"),
        T.clean(c("kaupallinennimi")).alias("commercial_name"),
        T.clean(c("tyyppihyvaksyntanro")).alias("type_approval"),
        T.clean(c("variantti")).alias("variant_code"),
        T.clean(c("versio")).alias("version_code"),
        classify.powertrain(c("kayttovoima"), c("sahkohybridi"), c("sahkohybridinluokka")).alias("powertrain"),
        T.clean(c("kayttovoima")).alias("fuel_code"),
        picked.alias("_picked"),
        classify.power_source(c("kayttovoima")).alias("tax_power_source"),
        _whole("tieliiksuursallkokmassa").alias("road_mass"),
        _whole("teknsuursallkokmassa").alias("technical_mass"),
        _whole("omamassa").alias("curb_mass"),
        F.bround(T.numeric(c("suurinnettoteho")), 1).alias("power"),
        T.clean(c("ajoneuvoryhma")).alias("vehicle_group"),
        T.first_year(c("ensirekisterointipvm")).alias("first_year"),
    )
    view = view.withColumns({"co2": c("_picked.co2"), "tax_measurement": c("_picked.method")}).drop("_picked")
    if not strip_makes:
        return view
    # the long expression sees each distinct pair once
    pairs = view.select("brand", "model").distinct()
    named = pairs.withColumn("_name", T.normalize_model(c("brand"), c("model")))
    return view.join(named, ["brand", "model"]).withColumn("model", c("_name")).drop("_name")


def supported(view: DataFrame) -> DataFrame:
    """Rows of a supported class with make, model and a known powertrain."""
    return view.where(F.col("vehicle_class").isin(rules.SUPPORTED_CLASSES) & (F.col("brand") != "") & (F.col("model") != "") & F.col("powertrain").isNotNull())


def excluded_counts(view: DataFrame) -> DataFrame:
    """``vehicle_class, reason, n_rows`` of rows that :func:`supported` drops within the supported classes."""
    reason = F.when((F.col("brand") == "") | (F.col("model") == ""), "missing_make_model").when(
        F.col("powertrain").isNull(), F.concat(F.lit("unsupported_fuel_"), T.or_whole(F.col("fuel_code"), F.lit("blank")))
    )
    return (
        view.where(F.col("vehicle_class").isin(rules.SUPPORTED_CLASSES))
        .withColumn("reason", reason)
        .where(F.col("reason").isNotNull())
        .groupBy("vehicle_class", "reason")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def included_counts(view: DataFrame) -> DataFrame:
    """``vehicle_class, n_rows, missing_road_mass`` of the supported rows."""
    return supported(view).groupBy("vehicle_class").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("road_mass") <= 0).alias("missing_road_mass"))


def configurations(view: DataFrame) -> DataFrame:
    """One row for each configuration: its key, registrations, first and last year (unknown years don't count)."""
    return (
        supported(view)
        .groupBy(*KEY)
        .agg(F.count(F.lit(1)).alias("registered_count"), F.min("first_year").alias("year_from"), F.max("first_year").alias("year_to"))
    )


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Positions from 1 in a total order, without a task that sees all rows.

    The sorted rows are written once; a row's position is its place in its partition after the rows of
    the partitions before, of which there is one count each.
    """
    placed = materialize(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit(2**33 - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", before.alias("_before"))  # one row a partition
    return placed.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + place + 1).drop("_part", "_before", "_at")


def ranked_configurations(view: DataFrame) -> DataFrame:
    """Configurations with ``source_rank``: most registrations first, then by key."""
    order = [F.desc("registered_count"), *[F.asc(k) for k in KEY]]
    return global_rank(configurations(view), order, "source_rank")


def catalog_items(ranked: DataFrame) -> DataFrame:
    """Catalogue items of ranked configurations, with label, estimates, mass fallback and a stable id."""
    c = F.col
    power = F.when(c("power") > 0, F.concat(F.lit(", "), F.regexp_replace(c("power").cast("string"), r"\.0$", ""), F.lit(" kW"))).otherwise("")
    approval = F.when(c("type_approval") != "", F.concat(F.lit(" ("), c("type_approval"), F.lit(")"))).otherwise("")
    name = T.normalize_model(c("brand"), T.or_whole(c("designation"), T.or_whole(c("commercial_name"), c("model"))))
    mass, source = classify.mass_fallback(c("road_mass"), c("technical_mass"), c("curb_mass"))
    return ranked.select(
        F.concat(F.lit("item-"), F.substring(F.sha2(F.to_json(F.struct(*KEY)), 256), 1, 20)).alias("id"),
        F.when(F.upper("brand") == c("brand"), F.regexp_replace(F.initcap(F.regexp_replace("brand", r"([^\p{L}])", "$1 ")), r"([^\p{L}]) ", "$1")).otherwise(c("brand")).alias("brand"),
        "model", F.concat(name, power, approval).alias("variant"), classify.vehicle_type(c("vehicle_class"), c("body_type"), c("vehicle_group")).alias("vehicle_type"),
        "vehicle_group", "vehicle_class", "body_type", "seats", T.years_label(c("year_from"), c("year_to")).alias("years"), "powertrain",
        classify.fuel_estimate(c("powertrain"), c("co2")).alias("fuel_consumption"), classify.electricity_estimate(c("powertrain"), mass).alias("electric_consumption"),
        "co2", mass.alias("mass"), c("road_mass").alias("tax_mass"), source.alias("mass_source"), "road_mass", "technical_mass", "curb_mass", "tax_measurement",
        "tax_power_source", "source_rank", "registered_count", "type_approval", "variant_code", "version_code",
    )
