"""Rows that read the same to a user, merged without losing registrations or lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaunu.functions import classify
from vaunu.functions import text as T
from vaunu.operators.makes import resolve_makes
from vaunu.operators.models import model_names
from vaunu.session import materialize

LABEL = ["brand", "model", "powertrain", "variant", "years", "vehicle_type", "body_label"]


RECORD = {
    "id": "string", "type_approval": "string", "variant_code": "string", "version_code": "string", "eea_type_approval": "string", "vehicle_class": "string",
    "body_type": "string", "road_mass": "int", "technical_mass": "int", "curb_mass": "int", "tax_mass": "int",
}


def source_record(items: DataFrame) -> Column:
    """The record of a row itself; a missing text is empty, a missing number 0."""
    have = set(items.columns)
    return F.struct(*[F.coalesce(F.col(n).cast(k) if n in have else F.lit(None).cast(k), F.lit("" if k == "string" else 0).cast(k)).alias(n) for n, k in RECORD.items()])


def provenance(items: DataFrame) -> Column:
    """A row's own source records, or the record of the row itself."""
    if "source_records" not in items.columns:
        return F.array(source_record(items))
    have = set(items.schema["source_records"].dataType.elementType.names)
    none = {n: F.lit("" if k == "string" else 0).cast(k) for n, k in RECORD.items()}
    records = F.transform("source_records", lambda r: F.struct(*[(r[n].cast(k) if n in have else none[n]).alias(n) for n, k in RECORD.items()]))
    return F.when(F.size("source_records") > 0, records).otherwise(F.array(source_record(items)))


def merge_rows(items: DataFrame, pos: str = "item_no", rank: str = "source_rank") -> DataFrame:
    """One row for each label: the lowest rank (missing is 0, then ``pos``) gives its columns, counts add up.

    ``lineage`` holds each record id of the group once, sorted, with the fields of its most trusted record;
    records without an id are left out. It is null where the row stands alone and had none. The full row
    is fetched by its ``pos`` after the aggregate, so the shuffle carries keys only.
    """
    had = F.coalesce(F.size("source_records") > 0, F.lit(False)) if "source_records" in items.columns else F.lit(False)
    slim = items.select(*LABEL, F.col(pos).alias("_pos"), F.coalesce(rank, F.lit(0)).alias("_rank"), F.coalesce("registered_count", F.lit(0)).alias("_n"), had.alias("_had"))
    groups = slim.groupBy(*LABEL).agg(F.min(F.struct("_rank", "_pos"))["_pos"].alias(pos), F.sum("_n").alias("merged_count"), F.count(F.lit(1)).alias("n_merged"), F.bool_or("_had").alias("_had"))
    records = items.select(*LABEL, F.struct(F.coalesce(rank, F.lit(0)).alias("rank"), F.col(pos).alias("pos")).alias("_at"), F.explode(provenance(items)).alias("_r")).where("_r.id != ''")
    each = records.groupBy(*LABEL, F.col("_r.id").alias("_id")).agg(F.min(F.struct("_at", "_r"))["_r"].alias("_r"))
    lists = each.groupBy(*LABEL).agg(F.array_sort(F.collect_list("_r")).alias("_all"))
    on = F.lit(True)
    for name in LABEL:
        on = on & F.col(f"g.{name}").eqNullSafe(F.col(f"l.{name}"))
    lineage = F.when((F.col("n_merged") > 1) | F.col("_had"), F.coalesce("_all", F.array().cast("array<struct<" + ",".join(f"{n}:{k}" for n, k in RECORD.items()) + ">>")))
    kept = groups.alias("g").join(lists.alias("l"), on, "left").select(pos, "merged_count", "n_merged", lineage.alias("lineage"))
    return items.join(kept, pos)


def label_columns(items: DataFrame) -> DataFrame:
    """``items`` with normalized make, model, variant, years, vehicle type and body label.

    Makes and models are decided on their distinct spellings; these tables are written once and joined.
    """
    c = F.col
    spelled = items.groupBy("brand").agg(F.sum(F.coalesce("registered_count", F.lit(0))).alias("registered_count"), F.min("item_no").alias("pos"))
    normal = materialize(spelled.withColumn("normal", T.normalize_make(c("brand"))))
    resolved = resolve_makes(normal.select(c("normal").alias("brand"), "registered_count", "pos")).withColumnRenamed("brand", "normal")
    makes = materialize(normal.join(resolved, "normal").select("brand", "make"))
    with_make = items.join(makes, "brand")
    names = materialize(model_names(with_make.select("make", "model", "registered_count")))
    named = with_make.join(names, ["make", "model"]).withColumns({"brand": c("make"), "model": c("shown")}).drop("make", "shown")
    start, end = T.year_span(c("years"))

    def variant(shown: Column) -> Column:
        short = T.strip_code_letter(T.clean_variant(T.strip_model_from_variant(c("model"), shown)))
        return F.when(T.is_designation(c("model"), shown), shown).otherwise(short)

    shown = T.clean_variant(T.visible_variant(T.strip_detail(c("variant")), c("type_approval")))
    return named.withColumns(
        {
            "years": T.years_label(start, end),
            "vehicle_type": classify.vehicle_type(F.coalesce("vehicle_class", F.lit("M1")), c("body_type"), c("vehicle_group")),
            "body_label": classify.body_label(c("body_type")),
            "variant": T.let(shown, variant),
        }
    )


def normalize_catalog(items: DataFrame) -> DataFrame:
    """The whole normalization: labels, then the merge; a null make or model counts as empty. The sum of ``merged_count`` is that of ``registered_count``."""
    return merge_rows(materialize(label_columns(items.fillna("", ["brand", "model"]))))
