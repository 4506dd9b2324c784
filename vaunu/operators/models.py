"""One spelling for each model of a make."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaunu.functions import rules
from vaunu.functions import text as T
from vaunu.session import materialize


def fix_model(make: Column, model: Column, fixes: dict | None = None) -> Column:
    """A curated correction of a model's spelling (``fixes``: by make in small letters, then by model key), else the model."""
    table = {f"{m}\x00{k}": v for m, found in (rules.MODEL_FIXES if fixes is None else fixes).items() for k, v in found.items()}
    if not table:
        return model
    key = F.concat(F.lower(T.clean(make)), F.lit("\x00"), T.model_key(make, model))
    return F.coalesce(F.try_element_at(F.from_json(F.lit(json.dumps(table)), "map<string,string>"), key), model)


def display_models(pairs: DataFrame) -> DataFrame:
    """``group, display`` for rows ``group, name, weight``: the spelling shown for each group.

    Names with different keys: unquoted, shortest, not all small, heaviest. Names with one key: mixed
    case, without underscore, heaviest, shortest. The name itself breaks the last ties.
    """
    names = pairs.groupBy("group", "name").agg(F.sum("weight").alias("w"))
    n = F.col("name")
    apart = F.struct(n.rlike("[\"']"), F.length(n), (F.lower(n) == n) & n.rlike(r"\p{L}"), -F.col("w"), F.lower(n), n)
    alike = F.struct((F.upper(n) == n) & n.rlike("[A-Za-z]"), F.contains(n, F.lit("_")), -F.col("w"), F.length(n), F.lower(n), n)
    chosen = names.groupBy("group").agg(
        F.count_distinct(T.fold(n)).alias("keys"), F.min(apart.withField("name", n))["name"].alias("shortest"), F.min(alike.withField("name", n))["name"].alias("usual")
    )
    single = F.when(F.col("shortest").rlike(r"^\p{Ll}$"), F.upper("shortest")).otherwise(F.col("shortest"))
    return chosen.select("group", F.when(F.col("keys") > 1, single).otherwise(F.col("usual")).alias("display"))


def model_names(items: DataFrame, fixes: dict | None = None) -> DataFrame:
    """``make, model, shown``: the shown spelling of each distinct pair of ``items`` (``make, model, registered_count``)."""
    c = F.col
    pairs = items.groupBy("make", "model").agg(F.sum(F.coalesce("registered_count", F.lit(0))).alias("weight"))
    # written between the steps: the plans of long nested texts grow faster than their length
    fixed = materialize(pairs.withColumn("fixed", fix_model(c("make"), T.clean(c("model")), fixes)))
    named = materialize(fixed.withColumn("stripped", T.strip_make(c("make"), c("fixed"))))
    named = named.withColumn("name", T.strip_body_words(T.strip_engine_words(c("stripped"))))
    named = materialize(named.withColumns({"own": T.normalize_model(c("make"), c("fixed")), "group": T.normalize_model(c("make"), c("name"))}))
    make = T.make_key(c("make"))
    keyed = materialize(named.withColumns({"own": F.concat_ws("\x00", make, T.bare_series(c("own"))), "group": F.concat_ws("\x00", make, T.bare_series(c("group")))}))
    shown = display_models(keyed.select("group", "name", "weight"))
    return keyed.join(shown.withColumnRenamed("group", "own"), "own", "left").select("make", "model", F.coalesce("display", "fixed").alias("shown"))
