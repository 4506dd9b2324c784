"""Reports over pairs of make and model, and the gates that fail on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaunu.functions import rules
from vaunu.functions import text as T
from vaunu.functions.formats import folded_case
from vaunu.operators.index import count_of, hide_reason
from vaunu.operators.reports import model_report


def is_rare(total: Column) -> Column:
    return total < rules.MIN_MODEL_TOTAL


def is_obsolete(newest: Column) -> Column:
    return newest.isNull() | (newest < rules.MIN_MODEL_YEAR)


def reasons(items: DataFrame, rare_and_old: bool = True) -> DataFrame:
    """:func:`model_report` with ``reason``, why the picker doesn't offer a pair.

    After the picker's own reasons comes ``designation``, where every row of the pair is only a technical
    designation. Without ``rare_and_old`` that reason isn't looked at.
    """
    c = F.col
    table = model_report(items)
    makes = items.where(c("brand").isNotNull() & c("model").isNotNull()).groupBy("brand").agg(F.sum(count_of()).alias("_total"))
    own = hide_reason(c("brand"), c("model"), c("_total"), c("registrations"), c("last_year"))
    own = own if rare_and_old else F.when(own == "rare+old", "").otherwise(own)
    all_named = F.when((c("n_rows") > 0) & (c("n_designations") >= c("n_rows")), "designation").otherwise("")
    return table.join(makes, "brand").withColumn("_own", own).withColumn("reason", F.when(c("_own") != "", c("_own")).otherwise(all_named)).drop("_total", "_own")


def pair_report(items: DataFrame, in_picker: DataFrame, brand: str | None = None, hidden_only: bool = False) -> DataFrame:
    """:func:`reasons` with ``status``: ``hidden:<reason>``, or any of ``rare``, ``old``, ``not-in-picker``; fewest registrations first.

    ``brand`` is compared without regard to case.
    """
    c = F.col
    table = reasons(items)
    if brand is not None:
        table = table.where(folded_case(c("brand")) == folded_case(F.lit(brand)))
    if hidden_only:
        table = table.where("reason != ''")
    seen = in_picker.select("brand", "model").distinct().withColumn("_seen", F.lit(True))
    flags = F.array(F.when(is_rare(c("registrations")), "rare"), F.when(is_obsolete(c("last_year")), "old"), F.when(c("_seen").isNull(), "not-in-picker"))
    status = F.when(c("reason") != "", F.concat(F.lit("hidden:"), "reason")).otherwise(F.array_join(F.array_compact(flags), ","))
    return table.join(seen, ["brand", "model"], "left").withColumn("status", status).drop("_seen").orderBy("registrations", folded_case(c("brand")), folded_case(c("model")))


def hide_histogram(items: DataFrame, selectable: DataFrame) -> DataFrame:
    """``reason, n_pairs`` of the pairs that ``selectable`` lacks; ``other`` where no reason is found."""
    rest = reasons(items).join(selectable.select("brand", "model").distinct(), ["brand", "model"], "left_anti")
    return rest.groupBy(F.when(F.col("reason") == "", "other").otherwise(F.col("reason")).alias("reason")).agg(F.count(F.lit(1)).alias("n_pairs"))


def rare_and_old_matrix(items: DataFrame) -> DataFrame:
    """``bucket, decade, kept, hidden`` of pairs without another reason: what the rare and old rule hides."""
    from vaunu.operators.reports import count_bucket, decade

    pairs = reasons(items, rare_and_old=False).where("reason = ''")
    gone = is_rare(F.col("registrations")) & is_obsolete(F.col("last_year"))
    return pairs.groupBy(count_bucket(F.col("registrations")).alias("bucket"), decade(F.col("last_year")).alias("decade")).agg(
        F.count_if(~gone).alias("kept"), F.count_if(gone).alias("hidden")
    )


def totals(items: DataFrame) -> DataFrame:
    """One row: ``n_rows, registrations, n_makes, n_models``. Distinct values are counted after they are combined on the map side."""
    pairs = items.groupBy("brand", "model").agg(F.count(F.lit(1)).alias("n"), F.sum(count_of()).alias("r"))
    makes = pairs.groupBy("brand").agg(F.sum("n").alias("n"), F.sum("r").alias("r"), F.count(F.lit(1)).alias("m"))
    return makes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum("r"), F.lit(0)).alias("registrations"), F.count(F.lit(1)).alias("n_makes"), F.coalesce(F.sum("m"), F.lit(0)).alias("n_models"))


def before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """``stage`` and :func:`totals` of a catalogue before and after its normalization."""
    return totals(before).withColumn("stage", F.lit("before")).unionByName(totals(after).withColumn("stage", F.lit("after")))


def make_collapses(resolved: DataFrame) -> DataFrame:
    """``brand, make`` where a make became another; ``resolved`` as from :func:`vaunu.operators.makes.resolve_makes`."""
    return resolved.where("brand != make").distinct()


def build_summary(items: DataFrame) -> DataFrame:
    """``measure, name, amount``: rows of each powertrain, registrations of each class, and the totals."""
    whole = totals(items).selectExpr("stack(4, 'n_rows', n_rows, 'registrations', registrations, 'n_makes', n_makes, 'n_models', n_models) as (name, amount)")
    fuels = items.groupBy(F.col("powertrain").alias("name")).agg(F.count(F.lit(1)).alias("amount")).withColumn("measure", F.lit("powertrain"))
    classes = items.groupBy(F.col("vehicle_class").alias("name")).agg(F.sum(count_of()).alias("amount")).withColumn("measure", F.lit("class"))
    return whole.withColumn("measure", F.lit("total")).unionByName(fuels).unionByName(classes)


def engine_report(items: DataFrame, in_picker: DataFrame) -> DataFrame:
    """``brand, model, registrations, in_picker`` of models that still carry engine wording, most registrations first."""
    named = items.where(T.matches(F.col("model"), rules.ENGINE_WORDS)).groupBy("brand", "model").agg(F.sum(count_of()).alias("registrations"))
    seen = in_picker.select("brand", "model").distinct().withColumn("in_picker", F.lit(True))
    out = named.join(seen, ["brand", "model"], "left").withColumn("in_picker", F.coalesce("in_picker", F.lit(False)))
    return out.orderBy(F.desc("registrations"), folded_case(F.col("brand")), folded_case(F.col("model")))


def body_worded(offered: DataFrame) -> DataFrame:
    """``brand, model`` of offered models that still carry a body word."""
    pairs = offered.select("brand", "model").distinct()
    return pairs.where(T.strip_body_words(F.col("model")) != F.col("model"))


def gate(findings: DataFrame, what: str, shown: int = 20) -> None:
    """Raise with a few examples if a report that must be empty isn't."""
    rows = findings.limit(shown).collect()
    if rows:
        raise ValueError(f"{what}: " + "; ".join(" / ".join(map(str, r)) for r in rows))
