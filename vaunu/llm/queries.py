"""Queries of the problems tagged llm, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaunu.llm import bpe, format_copies, lookalikes, matching, mixing, pii, reference_map, spellings, survivors
from vaunu.session import table

#: A key for tests and demonstrations; a real run passes its own secret.
SURROGATE_KEY = b"not a secret"
COPY_IGNORES = ["id", "source_rank", "source_records", "updated_at", "loaded_at"]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spellings.same_maker_pairs(table(spark, sf_dir, "brand_entries"))


def p1_makers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spellings.makers(table(spark, sf_dir, "brand_entries"))


def _disguised(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "ref_models")
    also = known.select(F.col("brand").alias("value")).unionByName(known.select(F.col("model").alias("value")))
    return lookalikes.disguised(table(spark, sf_dir, "vehicle_items"), "item_no", ["brand", "model"], also)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _disguised(spark, sf_dir).select("item_no", "field")


def p2_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _disguised(spark, sf_dir)


def p4_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.match(
        matching.item_features(table(spark, sf_dir, "vehicle_items")),
        matching.candidate_features(table(spark, sf_dir, "eea_candidates")),
    )


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p4_matched(spark, sf_dir).select("item_no", "cand_id")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_copies.format_copies(table(spark, sf_dir, "vehicle_items"), "item_no", ["model", "variant"], COPY_IGNORES)


def p5_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = format_copies.collapse(table(spark, sf_dir, "vehicle_items"), "item_no", ["model", "variant"], COPY_IGNORES)
    return whole.select("item_no", "brand", "model", "variant", "n_copies")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference_map.map_entries(table(spark, sf_dir, "admin_entries"), table(spark, sf_dir, "ref_models"))


def p6_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reference_map.matches(table(spark, sf_dir, "admin_entries"), table(spark, sf_dir, "ref_models"))
    return found.select("entry_no", F.explode("found").alias("f")).select("entry_no", "f.ref_id", "f.edits", "f.turned")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors.field_winners(table(spark, sf_dir, "vehicle_items")).select("id", "co2_no", "count_no", "records_no")


def p7_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors.survivors(table(spark, sf_dir, "vehicle_items")).select(
        "id", "n_rows", "brand", "model", "variant", "co2", "registered_count",
        F.coalesce(F.size("source_records"), F.lit(0)).alias("n_records"),
    )


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = bpe.token_counts(table(spark, sf_dir, "documents"), ["doc_id", "source"])
    return mixing.mix(sized, table(spark, sf_dir, "mix_targets"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shares(p9_mix(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found_pieces(table(spark, sf_dir, "documents"), SURROGATE_KEY)


def p10_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pieces(table(spark, sf_dir, "documents"), SURROGATE_KEY)
    return found.groupBy("kind", "entity", "surrogate_entity").agg(F.count_distinct("doc_id").alias("n_docs"))


def p10_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.redacted(table(spark, sf_dir, "documents"))


def p10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.redacted(table(spark, sf_dir, "documents"), key=SURROGATE_KEY)


QUERIES = {
    "p1_found": p1_found,
    "p1_makers": p1_makers,
    "p2_found": p2_found,
    "p2_unified": p2_unified,
    "p4_found": p4_found,
    "p4_matched": p4_matched,
    "p5_found": p5_found,
    "p5_collapsed": p5_collapsed,
    "p6_found": p6_found,
    "p6_matches": p6_matches,
    "p7_found": p7_found,
    "p7_survivors": p7_survivors,
    "p8_ids": p8_ids,
    "p9_mix": p9_mix,
    "p9_shares": p9_shares,
    "p10_found": p10_found,
    "p10_entities": p10_entities,
    "p10_redacted": p10_redacted,
    "p10_surrogates": p10_surrogates,
}

_EXACT = (
    "brand, years, powertrain, vehicle_type, vehicle_class, vehicle_group, body_type, seats, fuel_consumption, electric_consumption, co2, mass, road_mass, technical_mass, "
    "curb_mass, tax_mass, mass_source, tax_measurement, tax_power_source, service_cost, service_interval_km, service_interval_months, consumption_source, service_source, "
    "registered_count, type_approval, variant_code, version_code"
)


def _parts_sql(x: str) -> str:
    pattern = r"[0-9]+(?:[.,][0-9]+)*|[^0-9\s\x{85}\p{Z}\p{P}$+<=>^`|~]+"
    return f"[replace(q, ',', '.') FOR q IN regexp_extract_all(lower(upper({x})), '{pattern}')]"


def _joined_sql(parts: str) -> str:
    return f"regexp_replace(regexp_replace(array_to_string({parts}, ' '), '([^0-9 ]) ', '\\1', 'g'), ' ([^0-9 ])', '\\1', 'g')"


SQL = {
    "p5_found": f"""
        WITH p AS (SELECT *, {_parts_sql('model')} AS pm, {_parts_sql('variant')} AS pv FROM vehicle_items),
        k AS (SELECT *, array_to_string(list_sort(pm), ' ') AS cm, {_joined_sql('pm')} AS jm, array_to_string(list_sort(pv), ' ') AS cv, {_joined_sql('pv')} AS jv FROM p),
        fm AS (SELECT jm, arg_max(cm, {{'a': length(cm), 'b': cm}}) AS fine FROM k WHERE model IS NOT NULL GROUP BY jm),
        fv AS (SELECT jv, arg_max(cv, {{'a': length(cv), 'b': cv}}) AS fine FROM k WHERE variant IS NOT NULL GROUP BY jv),
        g AS (SELECT k.item_no, min(k.item_no) OVER (PARTITION BY CASE WHEN model IS NULL THEN NULL ELSE fm.fine END, model IS NULL,
                CASE WHEN variant IS NULL THEN NULL ELSE fv.fine END, variant IS NULL, {_EXACT}) AS first_no
              FROM k LEFT JOIN fm ON k.jm = fm.jm LEFT JOIN fv ON k.jv = fv.jv)
        SELECT first_no, item_no AS copy_no FROM g WHERE first_no <> item_no""",
    "p7_found": """
        WITH v AS (SELECT *, len(list_distinct([r.id FOR r IN source_records IF r.id IS NOT NULL])) AS n_ids FROM vehicle_items
                   WHERE id IS NOT NULL)
        SELECT id,
               arg_min(item_no, {'a': source_rank, 'b': item_no}) FILTER (co2 > 0) AS co2_no,
               arg_min(item_no, {'a': -epoch_us(updated_at), 'b': item_no}) FILTER (registered_count IS NOT NULL) AS count_no,
               arg_min(item_no, {'a': -coalesce(n_ids, 0), 'b': -epoch_us(updated_at), 'c': item_no}) AS records_no
        FROM v GROUP BY id HAVING count(*) > 1""",
}
