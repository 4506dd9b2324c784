"""Queries of the catalogue operators over the whole test tables, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaunu.functions import classify, rules
from vaunu.functions import text as T
from vaunu.functions import formats
from vaunu.operators import compare, enrich, guards, importing, index, makes, merge, models, orders, pairs, register, reports
from vaunu.plans import sql
from vaunu.session import table

QUERIES: dict = {}
SQL: dict[str, str] = {}
NOISE = {"door_codes": r"(?i)[0-9]+ *ov", "cm3": r"(?i)[0-9]+ *cm3", "body_codes": r"\([A-Z]{2}\)", "power": r"(?i), [0-9.,]+ *kW", "approvals": r"(?i)e[0-9]+\*"}
FIELDS = ["fuel_consumption", "electric_consumption", "co2", "mass", "tax_measurement", "tax_power_source", "consumption_source", "vehicle_class", "body_type", "seats", "tax_mass", "mass_source"]
COSTS = ["service_cost", "service_interval_km", "service_interval_months", "mass"]


def query(statement: str | None = None):
    """Register a query under its name, with its SQL."""

    def add(function):
        QUERIES[function.__name__] = function
        if statement:
            SQL[function.__name__] = statement
        return function

    return add


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "vehicle_items")


def view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return register.register_view(table(spark, sf_dir, "register_rows"), strip_makes=False)


# ---------------------------------------------------------------- register


@query(f"WITH {sql.REGISTER} SELECT row_no, vehicle_class, brand, model, powertrain, first_year FROM supported")
def q_register_scan(spark, sf_dir):
    return register.supported(view(spark, sf_dir)).select("row_no", "vehicle_class", "brand", "model", "powertrain", "first_year")


@query(f"WITH {sql.REGISTER} SELECT {sql.vehicle_type('vehicle_class', 'body_type', 'vehicle_group')} AS vehicle_type, count(*) AS n_rows FROM register GROUP BY 1")
def q_vehicle_type(spark, sf_dir):
    kind = classify.vehicle_type(F.col("vehicle_class"), F.col("body_type"), F.col("vehicle_group"))
    return view(spark, sf_dir).groupBy(kind.alias("vehicle_type")).agg(F.count(F.lit(1)).alias("n_rows"))


_KEY = ", ".join(register.KEY)


@query(f"""WITH {sql.REGISTER} SELECT {_KEY}, count(*) AS registered_count, min(first_year) AS year_from, max(first_year) AS year_to,
    row_number() OVER (ORDER BY count(*) DESC, {_KEY}) AS source_rank FROM supported GROUP BY {_KEY}""")
def q_configurations(spark, sf_dir):
    return register.ranked_configurations(view(spark, sf_dir))


@query(f"""WITH {sql.REGISTER} SELECT vehicle_class, CASE WHEN brand = '' OR model = '' THEN 'missing_make_model'
    ELSE 'unsupported_fuel_' || coalesce(nullif(fuel_code, ''), 'blank') END AS reason, count(*) AS n_rows FROM register
    WHERE vehicle_class IN {sql.listed(rules.SUPPORTED_CLASSES)} AND (brand = '' OR model = '' OR powertrain IS NULL) GROUP BY 1, 2""")
def q_excluded_counts(spark, sf_dir):
    return register.excluded_counts(view(spark, sf_dir))


@query(f"""WITH {sql.REGISTER} SELECT vehicle_class, count(*) AS n_rows, count(*) FILTER (road_mass <= 0) AS missing_road_mass FROM supported GROUP BY 1""")
def q_included_counts(spark, sf_dir):
    return register.included_counts(view(spark, sf_dir))


@query(f"WITH {sql.REGISTER} SELECT row_no, co2, tax_measurement, tax_power_source FROM register")
def q_co2_pick(spark, sf_dir):
    return view(spark, sf_dir).select("row_no", "co2", "tax_measurement", "tax_power_source")


_MASS = "CASE WHEN road_mass <> 0 THEN road_mass WHEN technical_mass <> 0 THEN technical_mass ELSE curb_mass END"


@query(f"""WITH {sql.REGISTER}, m AS (SELECT *, {_MASS} AS mass FROM supported)
    SELECT row_no, mass, CASE WHEN road_mass > 0 THEN 'road_traffic' WHEN technical_mass > 0 THEN 'technical_fallback' WHEN curb_mass > 0 THEN 'curb_mass_fallback'
           ELSE 'unknown' END AS mass_source,
      CASE powertrain WHEN 'diesel' THEN CASE WHEN co2 <> 0 THEN round_even(co2 / 26.4::DOUBLE, 1) ELSE 6.2 END
        WHEN 'petrol' THEN CASE WHEN co2 <> 0 THEN round_even(co2 / 23.92::DOUBLE, 1) ELSE 6.8 END
        WHEN 'hybrid' THEN CASE WHEN co2 <> 0 THEN round_even(co2 / 23.92::DOUBLE, 1) ELSE 5.0 END
        WHEN 'phev' THEN round_even(greatest(2.2, co2 / 23.92::DOUBLE), 1) ELSE 0.0 END::DOUBLE AS fuel_estimate,
      CASE powertrain WHEN 'electric' THEN CAST(printf('%.1f', greatest(15.0::DOUBLE, least(26.0::DOUBLE, 11.0::DOUBLE + mass / 180::DOUBLE))) AS DOUBLE)
        WHEN 'phev' THEN CAST(printf('%.1f', greatest(16.0::DOUBLE, least(24.0::DOUBLE, 10.5::DOUBLE + mass / 200::DOUBLE))) AS DOUBLE) ELSE 0.0 END::DOUBLE AS electricity_estimate FROM m""")
def q_estimates(spark, sf_dir):
    mass, source = classify.mass_fallback(F.col("road_mass"), F.col("technical_mass"), F.col("curb_mass"))
    rows = register.supported(view(spark, sf_dir))
    return rows.select("row_no", mass.alias("mass"), source.alias("mass_source"), classify.fuel_estimate(F.col("powertrain"), F.col("co2")).alias("fuel_estimate"), classify.electricity_estimate(F.col("powertrain"), mass).alias("electricity_estimate"))


@query()
def q_catalog_items(spark, sf_dir):
    stripped = register.register_view(table(spark, sf_dir, "register_rows"))
    return register.catalog_items(register.ranked_configurations(stripped))


# ---------------------------------------------------------------- makes and models

_MAKES = """WITH n AS (SELECT brand, CAST(sum(coalesce(registered_count, 0)) AS BIGINT) AS w, min(item_no) AS pos, lower(brand) AS key FROM vehicle_items
      WHERE brand IS NOT NULL GROUP BY brand),
    k AS (SELECT key, sum(w) AS freq, arg_min(brand, {'a': length(brand), 'b': pos}) AS display FROM n GROUP BY key),
    c AS (SELECT k.key, coalesce(h.display, k.display) AS shown FROM k LEFT JOIN k h ON regexp_matches(k.key, '[, \\-/–]')
          AND h.key = regexp_split_to_array(%(clean)s, '[,\\s\\-/–]+')[1] AND h.key <> k.key AND h.freq >= 100),
    s AS (SELECT n.brand, n.w, c.shown, %(key)s AS stage FROM n JOIN c USING (key)),
    t AS (SELECT stage, sum(w) AS total FROM s GROUP BY stage),
    b AS (SELECT a.stage, arg_max(p.stage, length(p.stage)) AS base FROM t a JOIN t p ON p.total >= 100 AND starts_with(a.stage, p.stage || ' ') GROUP BY a.stage),
    f AS (SELECT s.*, regexp_replace(coalesce(b.base, s.stage), '[^0-9a-z]+', '', 'g') AS folded FROM s LEFT JOIN b USING (stage)),
    w AS (SELECT folded, shown, sum(w) AS w FROM f GROUP BY 1, 2),
    m AS (SELECT folded, arg_min(shown, {'a': -w, 'b': lower(shown), 'c': length(shown), 'd': shown}) AS make FROM w GROUP BY folded)
    SELECT f.brand, m.make FROM f JOIN m USING (folded)""" % {"clean": sql.clean("k.key"), "key": sql.make_key("c.shown")}


@query(_MAKES)
def q_make_resolve(spark, sf_dir):
    return makes.resolve_makes(items(spark, sf_dir).select("brand", "registered_count", F.col("item_no").alias("pos")))


@query(f"""WITH d AS (SELECT DISTINCT brand FROM admin_entries WHERE brand IS NOT NULL), c AS (SELECT brand, {sql.clean('brand')} AS v FROM d)
    SELECT brand, {sql.normal_make('v')} AS make FROM c""")
def q_make_normalize(spark, sf_dir):
    rows = table(spark, sf_dir, "admin_entries").where(F.col("brand").isNotNull()).select("brand").distinct()
    return rows.select("brand", T.normalize_make(F.col("brand")).alias("make"))


@query(f"SELECT DISTINCT model, {sql.fold('model')} AS model_fold FROM vehicle_items WHERE model IS NOT NULL")
def q_model_fold(spark, sf_dir):
    return items(spark, sf_dir).where(F.col("model").isNotNull()).select("model").distinct().select("model", T.fold(F.col("model")).alias("model_fold"))


@query()
def q_model_key(spark, sf_dir):
    pairs = items(spark, sf_dir).where(F.col("brand").isNotNull() & F.col("model").isNotNull()).select("brand", "model").distinct()
    return pairs.select("brand", "model", T.model_key(F.col("brand"), F.col("model")).alias("model_key"))


@query(f"""WITH p AS (SELECT brand || '|' || {sql.fold('model')} AS grp, model AS name, CAST(sum(coalesce(registered_count, 0)) AS BIGINT) AS w FROM vehicle_items
      WHERE brand IS NOT NULL AND model IS NOT NULL GROUP BY 1, 2)
    SELECT grp AS "group", arg_min(name, {{'a': upper(name) = name AND regexp_matches(name, '[A-Za-z]'), 'b': contains(name, '_'), 'c': -w, 'd': length(name), 'e': lower(name), 'f': name}}) AS display
    FROM p GROUP BY grp""")
def q_model_display(spark, sf_dir):
    rows = items(spark, sf_dir).where(F.col("brand").isNotNull() & F.col("model").isNotNull())
    group = F.concat_ws("|", "brand", T.fold(F.col("model")))
    return models.display_models(rows.select(group.alias("group"), F.col("model").alias("name"), F.coalesce("registered_count", F.lit(0)).alias("weight")))


@query()
def q_model_names(spark, sf_dir):
    rows = items(spark, sf_dir).where(F.col("brand").isNotNull() & F.col("model").isNotNull())
    return models.model_names(rows.select(F.col("brand").alias("make"), "model", "registered_count"))


@query()
def q_fuzzy_prefix(spark, sf_dir):
    rows = table(spark, sf_dir, "admin_entries").where(F.col("brand").isNotNull() & F.col("model").isNotNull()).select("brand", T.clean(F.col("model")).alias("model")).distinct()
    return rows.withColumn("rest", T.strip_mistyped_make(F.col("brand"), F.col("model"))).where("rest != model")


@query()
def q_variant_clean(spark, sf_dir):
    distinct = items(spark, sf_dir).where(F.col("variant").isNotNull()).select("variant", "type_approval").distinct()
    return distinct.select("variant", "type_approval", T.clean_variant(T.visible_variant(T.strip_detail(F.col("variant")), F.col("type_approval"))).alias("label"))


# ---------------------------------------------------------------- merge and enrichment


def _labelled(spark, sf_dir) -> DataFrame:
    start, end = T.year_span(F.col("years"))
    return items(spark, sf_dir).withColumns({"years": T.years_label(start, end), "body_label": classify.body_label(F.col("body_type"))})


_LABELLED = f"""l AS (SELECT * REPLACE (CASE WHEN {sql.year_from('years')} IS NULL THEN 'Tuntematon' WHEN {sql.year_from('years')} = {sql.year_to('years')}
    THEN CAST({sql.year_from('years')} AS VARCHAR) ELSE {sql.year_from('years')} || '–' || {sql.year_to('years')} END AS years), {sql.body_label('body_type')} AS body_label FROM vehicle_items)"""


@query(f"""WITH {_LABELLED} SELECT arg_min(item_no, {{'a': coalesce(source_rank, 0), 'b': item_no}}) AS item_no, CAST(sum(coalesce(registered_count, 0)) AS BIGINT) AS merged_count,
    count(*) AS n_merged FROM l GROUP BY brand, model, powertrain, variant, years, vehicle_type, body_label""")
def q_merge(spark, sf_dir):
    merged = merge.merge_rows(_labelled(spark, sf_dir).fillna({"brand": "", "model": "", "variant": "", "vehicle_type": "", "powertrain": ""}))
    return merged.select("item_no", "merged_count", "n_merged")


@query()
def q_normalize_catalog(spark, sf_dir):
    whole = merge.normalize_catalog(items(spark, sf_dir))
    return whole.select("item_no", *merge.LABEL, "merged_count", "n_merged", F.size(F.coalesce("lineage", F.array())).alias("n_lineage"))


_CANON = "regexp_replace(upper(coalesce({0}, '')), '[^A-Z0-9]', '', 'g')"


_RANKED = f"""a AS (SELECT item_no, unnest(list_concat([type_approval], coalesce([r.type_approval FOR r IN source_records], []))) AS approval,
      generate_subscripts(list_concat([type_approval], coalesce([r.type_approval FOR r IN source_records], [])), 1) AS p FROM vehicle_items),
    o AS (SELECT item_no, upper(trim(approval)) AS approval, min(p) AS p FROM a WHERE trim(coalesce(approval, '')) <> '' GROUP BY 1, 2),
    r AS (SELECT item_no, approval, CAST(row_number() OVER (PARTITION BY item_no ORDER BY p) - 1 AS INTEGER) AS place FROM o),
    c AS (SELECT upper(trim(tan)) AS approval, cand_id, {_CANON.format('va')} AS cv, {_CANON.format('ve')} AS cs, ewltp_g_km AS cc, ep_kw AS cp FROM eea_candidates
      WHERE (fc IS NOT NULL OR z_wh_km IS NOT NULL) AND tan IS NOT NULL),
    f AS (SELECT item_no, {_CANON.format('variant_code')} AS v, {_CANON.format('version_code')} AS s, CAST(co2 AS DOUBLE) AS co2,
      TRY_CAST(nullif(regexp_extract(variant, ', ([0-9.]+) kW', 1), '') AS DOUBLE) AS kw FROM vehicle_items),
    x AS (SELECT item_no, place, cand_id, (CASE WHEN v <> '' AND cv <> '' AND v <> cv THEN 25 ELSE 0 END) + (CASE WHEN s <> '' AND cs <> '' AND s <> cs THEN 50 ELSE 0 END)
      + (CASE WHEN co2 > 0 AND cc > 0 THEN least(100.0, abs(co2 - cc)) ELSE 0 END) + (CASE WHEN kw > 0 AND cp > 0 THEN least(100.0, abs(kw - cp)) ELSE 0 END) AS score
      FROM r JOIN c USING (approval) JOIN f USING (item_no)),
    e AS (SELECT item_no, cand_id, place, CAST(score AS DOUBLE) AS score FROM x QUALIFY row_number() OVER (PARTITION BY item_no ORDER BY place, score, cand_id) = 1)"""


@query(f"WITH {_RANKED} SELECT * FROM e")
def q_enrich_ranked(spark, sf_dir):
    return enrich.enrich(items(spark, sf_dir), table(spark, sf_dir, "eea_candidates"))


@query(f"""WITH {_RANKED}
    SELECT v.item_no, CASE WHEN powertrain <> 'electric' AND fc IS NOT NULL THEN round_even(fc, 1) ELSE fuel_consumption END AS fuel_consumption,
      CASE WHEN powertrain IN ('electric', 'phev') AND z_wh_km IS NOT NULL THEN round_even(z_wh_km / 10::DOUBLE, 1) ELSE electric_consumption END AS electric_consumption, report_year
    FROM vehicle_items v LEFT JOIN (SELECT e.item_no, fc, z_wh_km, report_year FROM e JOIN eea_candidates USING (cand_id)) USING (item_no)""")
def q_consumption(spark, sf_dir):
    return enrich.consumption(items(spark, sf_dir), table(spark, sf_dir, "eea_candidates")).select("item_no", "fuel_consumption", "electric_consumption", "report_year")


# ---------------------------------------------------------------- picker

_STATS = f"""s AS (SELECT brand, model, CAST(sum(coalesce(registered_count, 0)) AS BIGINT) AS registrations, max({sql.year_to('years')}) AS newest_year FROM vehicle_items
    WHERE brand IS NOT NULL AND model IS NOT NULL GROUP BY brand, model)"""


@query(f"WITH {_STATS} SELECT * FROM s")
def q_model_stats(spark, sf_dir):
    return index.model_statistics(items(spark, sf_dir).where(F.col("brand").isNotNull() & F.col("model").isNotNull()))


_ALIAS_KEYS = {m: sorted({"".join(c for c in a.lower() if c.isalnum()) for a in names}) for m, names in rules.MODEL_MAKES.items()}
_IS_ALIAS = " OR ".join(f"(own_make = {sql.quoted(m)} AND key IN {sql.listed(keys)})" for m, keys in _ALIAS_KEYS.items())
_KEPT = " OR ".join(f"(lower({sql.clean('brand')}) = {sql.quoted(m)} AND key = {sql.quoted(k)})" for m, k in rules.KEPT_MODELS)
_REASON = f"""CASE WHEN make_total < 2 THEN 'rare-brand' WHEN lower({sql.clean('brand')}) IN {sql.listed(rules.HIDDEN_BRANDS)} THEN 'curated-hidden-brand'
    WHEN lower({sql.clean('brand')}) IN {sql.listed(rules.BRAND_PLACEHOLDERS)} THEN 'placeholder-brand' WHEN {_KEPT} THEN ''
    WHEN key = '' OR key IN {sql.listed(rules.UNKNOWN_MODELS)} OR regexp_full_match({sql.clean('model')}, '(?i)(?:{sql.ENGINE_NAME})') OR key = {sql.fold('brand')} OR {_IS_ALIAS} THEN 'unknown'
    WHEN regexp_matches({sql.clean('model')}, {sql.quoted('(?i)' + rules.TECHNICAL)}) THEN 'technical'
    WHEN registrations < 2 AND (newest_year IS NULL OR newest_year < 1990) THEN 'rare+old' ELSE '' END"""
_REASONS = f"""{_STATS}, m AS (SELECT brand, sum(registrations) AS make_total FROM s GROUP BY brand),
    h AS (SELECT s.*, {_REASON} AS reason FROM (SELECT s.*, m.make_total, {sql.fold('s.model')} AS key, {sql.normal_make(sql.clean('s.brand'))} AS own_make FROM s JOIN m USING (brand)) s)"""


@query(f"WITH {_REASONS} SELECT brand, model, registrations, newest_year, reason FROM h")
def q_hide_reason(spark, sf_dir):
    return index.hide_reasons(items(spark, sf_dir))


_DESIGNATION = f"({sql.fold('model')} <> '' AND {sql.fold('model')} = {sql.fold(sql.variant_base('variant'))})"
_OFFERED = f"""{_REASONS}, o AS (SELECT DISTINCT brand, model, vehicle_type, powertrain FROM vehicle_items v SEMI JOIN (SELECT brand, model FROM h WHERE reason = '') g USING (brand, model)
    WHERE vehicle_type IS NOT NULL AND NOT {_DESIGNATION})"""


def _offered(spark, sf_dir) -> DataFrame:
    return index.selectable(items(spark, sf_dir))


@query(f"""WITH {_OFFERED} SELECT brand, model, vehicle_type, coalesce(string_agg(powertrain, ',' ORDER BY powertrain), '') AS powertrains FROM o GROUP BY 1, 2, 3""")
def q_index(spark, sf_dir):
    return index.index_rows(_offered(spark, sf_dir)).withColumn("powertrains", F.array_join("powertrains", ","))


@query(f"""WITH {_OFFERED}, d AS (SELECT DISTINCT brand, vehicle_type, powertrain FROM o)
    SELECT brand, vehicle_type, coalesce(string_agg(powertrain, ',' ORDER BY powertrain), '') AS powertrains FROM d GROUP BY 1, 2""")
def q_availability(spark, sf_dir):
    return index.availability(_offered(spark, sf_dir)).withColumn("powertrains", F.array_join("powertrains", ","))


@query(f"WITH {_OFFERED} SELECT brand, model, vehicle_type, powertrain FROM o")
def q_selectable(spark, sf_dir):
    return index.selectable(items(spark, sf_dir))


_CODES = "array_to_string([p FOR p IN {0} IF list_contains({1}, p)], ',')".format(str(rules.POWERTRAINS), "{0}")
_IMPORTED = f"""i AS (SELECT brand, model, coalesce(vehicle_type, 'passenger') AS vehicle_type, {_CODES.format("list(DISTINCT powertrain) FILTER (powertrain IS NOT NULL)")} AS powertrains
    FROM vehicle_items WHERE brand IS NOT NULL AND model IS NOT NULL GROUP BY 1, 2, 3)"""


def _imported(spark, sf_dir) -> DataFrame:
    return index.import_index(items(spark, sf_dir))


@query(f"WITH {_IMPORTED} SELECT brand, model, vehicle_type, coalesce(powertrains, '') AS powertrains FROM i")
def q_import_index(spark, sf_dir):
    return _imported(spark, sf_dir).withColumn("powertrains", F.array_join("powertrains", ","))


@query(f"""WITH {_IMPORTED}, c AS (SELECT brand, vehicle_type, unnest(string_split(powertrains, ',')) AS code FROM i WHERE powertrains <> '')
    SELECT brand, vehicle_type, {_CODES.format("list(DISTINCT code)")} AS powertrains FROM c GROUP BY 1, 2""")
def q_index_availability(spark, sf_dir):
    return index.index_availability(_imported(spark, sf_dir)).withColumn("powertrains", F.array_join("powertrains", ","))


@query(f"WITH {_IMPORTED} SELECT brand, string_agg(DISTINCT vehicle_type, ',' ORDER BY vehicle_type) AS vehicle_types FROM i GROUP BY 1")
def q_brand_types(spark, sf_dir):
    return index.brand_types(_imported(spark, sf_dir)).withColumn("vehicle_types", F.array_join("vehicle_types", ","))


@query(f"""WITH {_OFFERED}, x AS (SELECT brand, model, vehicle_type, {_CODES.format("list(DISTINCT powertrain) FILTER (powertrain IS NOT NULL)")} AS codes FROM o GROUP BY 1, 2, 3), {_IMPORTED}
    SELECT 'unexpected' AS rule, count(*) AS n_rows FROM i ANTI JOIN x USING (brand, model, vehicle_type)
    UNION ALL SELECT 'missing', count(*) FROM x ANTI JOIN i USING (brand, model, vehicle_type)
    UNION ALL SELECT 'other codes', count(*) FROM i JOIN x USING (brand, model, vehicle_type) WHERE i.powertrains <> x.codes
    UNION ALL SELECT 'no code', count(*) FROM i WHERE coalesce(powertrains, '') = ''
    UNION ALL SELECT 'unknown type', count(*) FROM i WHERE vehicle_type NOT IN {sql.listed(rules.VEHICLE_TYPES)}
    UNION ALL SELECT 'listed twice', count(*) FROM (SELECT 1 FROM i GROUP BY brand, model, vehicle_type HAVING count(*) > 1)
    UNION ALL SELECT 'makes differ', count(*) FROM (SELECT DISTINCT brand FROM i) ANTI JOIN (SELECT DISTINCT brand FROM x) USING (brand)""")
def q_index_violations(spark, sf_dir):
    given = _imported(spark, sf_dir)
    in_order = index.index_rows(_offered(spark, sf_dir)).withColumn("powertrains", index.known_codes(F.col("powertrains")))
    flat = in_order.select("brand", "model", "vehicle_type", F.explode_outer("powertrains").alias("powertrain"))
    found = guards.index_violations(given.withColumn("powertrains", F.array_sort("powertrains")), flat, given.select("brand").distinct())
    return found.where(F.col("rule").isin("unexpected", "missing", "other codes", "no code", "unknown type", "listed twice", "makes differ"))


@query(f"WITH {_OFFERED} SELECT DISTINCT model FROM o WHERE brand = 'Lulbria' AND vehicle_type = 'passenger' AND powertrain = 'petrol'")
def q_facet_models(spark, sf_dir):
    return index.facet_models(index.index_rows(_offered(spark, sf_dir)), "Lulbria", "passenger", "petrol").select("model")


@query(f"""WITH {_OFFERED} SELECT DISTINCT 'brand' AS facet, brand AS value FROM o WHERE vehicle_type = 'van' AND powertrain = 'diesel'
    UNION ALL SELECT DISTINCT 'powertrain', powertrain FROM o WHERE vehicle_type = 'van' AND powertrain IS NOT NULL
    UNION ALL SELECT DISTINCT 'vehicle_type', vehicle_type FROM o WHERE powertrain = 'diesel'""")
def q_facet_filters(spark, sf_dir):
    return index.facet_filters(_offered(spark, sf_dir), "van", "diesel")


@query(f"""SELECT item_no, array_to_string([x FOR x IN [powertrain, variant, {sql.body_label('body_type')}, years] IF x IS NOT NULL AND x <> ''], ' · ') AS label FROM vehicle_items
    WHERE brand = 'Lulbria' AND model = 'Truhufel' AND coalesce(vehicle_type, 'passenger') = 'passenger'""")
def q_facet_versions(spark, sf_dir):
    rows = index.facet_versions(items(spark, sf_dir), "Lulbria", "Truhufel", "passenger")
    return rows.select("item_no", index.version_label(F.col("powertrain"), F.col("variant"), classify.body_label(F.col("body_type")), F.col("years")).alias("label"))


@query("SELECT item_no, substring(sha256(coalesce(brand, '') || chr(0) || coalesce(model, '')), 1, 2) AS shard FROM vehicle_items")
def q_shard_hash(spark, sf_dir):
    return items(spark, sf_dir).select("item_no", index.model_shard(F.col("brand"), F.col("model")).alias("shard"))


@query(f"""SELECT (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM vehicle_items GROUP BY id)) AS duplicate_ids,
    count(*) FILTER (regexp_matches(variant, '\\[[^\\]]*\\]\\s*$')) AS bracketed, count(*) FILTER (regexp_matches(variant, '(?i)(^|\\s)\\d+\\s*ov(\\s|,|$)')) AS door_codes,
    count(*) FILTER (regexp_matches(variant, '(?i)\\d+\\s*cm3')) AS cm3, count(*) FILTER (regexp_matches(variant, '\\s\\([A-Z]{{1,2}}\\)')) AS body_codes,
    count(*) FILTER (vehicle_type NOT IN {sql.listed(rules.VEHICLE_TYPES)}) AS bad_types FROM vehicle_items""")
def q_invariants(spark, sf_dir):
    return index.violations(items(spark, sf_dir))


@query("""SELECT 'missing' AS side, brand, model, vehicle_type FROM (SELECT brand, model, vehicle_type FROM vehicle_items WHERE source_rank = 1 EXCEPT
    SELECT brand, model, vehicle_type FROM vehicle_items WHERE source_rank = 2) UNION ALL SELECT 'unexpected', brand, model, vehicle_type FROM
    (SELECT brand, model, vehicle_type FROM vehicle_items WHERE source_rank = 2 EXCEPT SELECT brand, model, vehicle_type FROM vehicle_items WHERE source_rank = 1)""")
def q_set_diff(spark, sf_dir):
    rows = items(spark, sf_dir)
    return index.index_differences(rows.where("source_rank = 2"), rows.where("source_rank = 1"))


@query("""SELECT 'in_list' AS side, count(*) AS n_rows FROM vehicle_items v WHERE EXISTS (SELECT 1 FROM ref_models r WHERE r.brand = v.brand AND r.model = v.model)
    UNION ALL SELECT 'not_in_list', count(*) FROM vehicle_items v WHERE NOT EXISTS (SELECT 1 FROM ref_models r WHERE r.brand = v.brand AND r.model = v.model)""")
def q_semi_anti(spark, sf_dir):
    rows, known = items(spark, sf_dir).select("brand", "model"), table(spark, sf_dir, "ref_models")
    sides = [("in_list", "left_semi"), ("not_in_list", "left_anti")]
    counts = [rows.join(known, ["brand", "model"], how).agg(F.lit(name).alias("side"), F.count(F.lit(1)).alias("n_rows")) for name, how in sides]
    return counts[0].unionByName(counts[1])


# ---------------------------------------------------------------- reports


@query(f"""WITH {_OFFERED}, t AS (SELECT brand, CAST(sum(coalesce(registered_count, 0)) AS BIGINT) AS registrations, count(*) AS n_rows, count(DISTINCT model) AS n_models,
      min({sql.year_from('years')}) AS first_year FROM vehicle_items WHERE brand IS NOT NULL GROUP BY brand),
    u AS (SELECT *, array_to_string([x FOR x IN [CASE WHEN lower({sql.clean('brand')}) IN {sql.listed(rules.HIDDEN_BRANDS)} THEN 'curated-hidden' END,
      CASE WHEN lower({sql.clean('brand')}) IN {sql.listed(rules.BRAND_PLACEHOLDERS)} THEN 'placeholder' END, CASE WHEN registrations < 2 THEN 'below-threshold' END] IF x IS NOT NULL], ',') AS st FROM t)
    SELECT brand, registrations, n_rows, n_models, first_year, CASE WHEN st = '' AND brand NOT IN (SELECT brand FROM o) THEN 'not-in-picker' ELSE st END AS status FROM u""")
def q_report_makes(spark, sf_dir):
    return reports.make_report(items(spark, sf_dir), _offered(spark, sf_dir))


@query(f"""SELECT brand, model, CAST(sum(coalesce(registered_count, 0)) AS BIGINT) AS registrations, count(*) AS n_rows, count(DISTINCT variant) AS n_variants,
    count(DISTINCT vehicle_type) AS n_types, count(*) FILTER ({_DESIGNATION}) AS n_designations, min({sql.year_from('years')}) AS first_year,
    max({sql.year_to('years')}) AS last_year FROM vehicle_items WHERE brand IS NOT NULL AND model IS NOT NULL GROUP BY 1, 2""")
def q_report_models(spark, sf_dir):
    return reports.model_report(items(spark, sf_dir))


@query(f"""WITH {_STATS}, c AS (SELECT CASE WHEN registrations < 2 THEN '1' WHEN registrations < 10 THEN '2-9' WHEN registrations < 100 THEN '10-99' WHEN registrations < 1000
      THEN '100-999' ELSE '1000+' END AS bucket, coalesce(CAST(newest_year // 10 * 10 AS VARCHAR), 'none') AS decade, registrations FROM s)
    SELECT coalesce(bucket, 'all') AS bucket, coalesce(decade, 'all') AS decade, count(*) AS n_models, CAST(sum(registrations) AS BIGINT) AS registrations FROM c
    GROUP BY CUBE (bucket, decade)""")
def q_bucket_matrix(spark, sf_dir):
    return reports.bucket_matrix(q_model_stats(spark, sf_dir))


_GROUPS = f"""WITH g AS (SELECT brand, model, variant, years, count(*) AS n_rows, {', '.join(f"count(DISTINCT coalesce(CAST({f} AS VARCHAR), chr(1))) AS d_{f}" for f in FIELDS)}
    FROM vehicle_items GROUP BY brand, model, variant, years HAVING count(*) > 1),
    l AS (SELECT brand, model, variant, years, n_rows, array_to_string([x FOR x IN [{', '.join(f"CASE WHEN d_{f} > 1 THEN '{f}' END" for f in FIELDS)}] IF x IS NOT NULL], ',') AS differing FROM g)"""


def _groups(spark, sf_dir) -> DataFrame:
    return reports.label_groups(items(spark, sf_dir), ["brand", "model", "variant", "years"], FIELDS)


@query(f"{_GROUPS} SELECT * FROM l")
def q_duplicates(spark, sf_dir):
    return _groups(spark, sf_dir)


@query(f"{_GROUPS} SELECT n_rows, count(*) AS n_groups FROM l GROUP BY 1")
def q_group_histogram(spark, sf_dir):
    return reports.group_histogram(_groups(spark, sf_dir))


@query(f"{_GROUPS} SELECT field, count(*) AS n_groups FROM (SELECT unnest(string_split(differing, ',')) AS field FROM l WHERE differing <> '') GROUP BY 1")
def q_differing_fields(spark, sf_dir):
    return reports.field_frequency(_groups(spark, sf_dir))


@query(f"""WITH k AS (SELECT DISTINCT brand, {sql.fold('model')} AS key FROM vehicle_items WHERE brand IS NOT NULL AND model IS NOT NULL)
    SELECT a.brand, a.key AS short_key, b.key AS long_key FROM k a JOIN k b ON a.brand = b.brand AND starts_with(b.key, a.key) AND length(b.key) - length(a.key) BETWEEN 1 AND 3
    WHERE length(a.key) >= 2""")
def q_prefix_pairs(spark, sf_dir):
    return reports.prefix_pairs(items(spark, sf_dir))


@query("SELECT item_no, registered_count FROM vehicle_items WHERE registered_count IS NOT NULL ORDER BY registered_count DESC, item_no LIMIT 25")
def q_topk(spark, sf_dir):
    return items(spark, sf_dir).where(F.col("registered_count").isNotNull()).select("item_no", "registered_count").orderBy(F.desc("registered_count"), "item_no").limit(25)


@query(" UNION ALL ".join(f"SELECT '{n}' AS pattern, count(*) FILTER (regexp_matches(variant, {sql.quoted(p)})) AS hits, count(*) FILTER (regexp_matches(variant, {sql.quoted(p)})) / count(*)::DOUBLE AS share FROM vehicle_items" for n, p in NOISE.items()))
def q_noise_counts(spark, sf_dir):
    return reports.noise_counts(items(spark, sf_dir), NOISE)


_ENGINE_TEXT = rules.ENGINE_WORDS.replace("cng(?!-)|lpg(?!-)|", "")
_ENGINE_NAMED = f"(regexp_matches(model, {sql.quoted('(?i)' + _ENGINE_TEXT)}) OR regexp_matches(model, '(?i)\\b(?:cng|lpg)(?:[^-0-9a-z_]|$)'))"


@query(f"""WITH {_OFFERED}, n AS (SELECT brand, model, CAST(sum(coalesce(registered_count, 0)) AS BIGINT) AS registrations FROM admin_entries WHERE {_ENGINE_NAMED} GROUP BY 1, 2)
    SELECT brand, model, registrations, brand IS NOT NULL AND EXISTS (SELECT 1 FROM o WHERE o.brand = n.brand AND o.model = n.model) AS in_picker FROM n""")
def q_engine_names(spark, sf_dir):
    return pairs.engine_report(table(spark, sf_dir, "admin_entries"), _offered(spark, sf_dir))


_PAIRS = f"""{_OFFERED}, d AS (SELECT brand, model, CAST(sum(coalesce(registered_count, 0)) AS BIGINT) AS registrations, count(*) AS n_rows, count(DISTINCT variant) AS n_variants,
    count(DISTINCT vehicle_type) AS n_types, count(*) FILTER ({_DESIGNATION}) AS n_designations, min({sql.year_from('years')}) AS first_year, max({sql.year_to('years')}) AS last_year
    FROM vehicle_items WHERE brand IS NOT NULL AND model IS NOT NULL GROUP BY 1, 2),
    w AS (SELECT d.*, CASE WHEN h.reason = '' AND n_designations >= n_rows THEN 'designation' ELSE h.reason END AS reason,
      EXISTS (SELECT 1 FROM o WHERE o.brand = d.brand AND o.model = d.model) AS seen FROM d JOIN h USING (brand, model))"""


@query(f"""WITH {_PAIRS} SELECT * EXCLUDE (seen), CASE WHEN reason <> '' THEN 'hidden:' || reason ELSE array_to_string([x FOR x IN [CASE WHEN registrations < 2 THEN 'rare' END,
    CASE WHEN last_year IS NULL OR last_year < 1990 THEN 'old' END, CASE WHEN NOT seen THEN 'not-in-picker' END] IF x IS NOT NULL], ',') END AS status FROM w""")
def q_pair_report(spark, sf_dir):
    return pairs.pair_report(items(spark, sf_dir), _offered(spark, sf_dir))


@query(f"WITH {_PAIRS} SELECT CASE WHEN reason = '' THEN 'other' ELSE reason END AS reason, count(*) AS n_pairs FROM w WHERE NOT seen GROUP BY 1")
def q_hide_histogram(spark, sf_dir):
    return pairs.hide_histogram(items(spark, sf_dir), _offered(spark, sf_dir))


@query(f"""WITH {_PAIRS}, k AS (SELECT w.*, CASE WHEN h.reason = 'rare+old' THEN (CASE WHEN n_designations >= n_rows THEN 'designation' ELSE '' END) ELSE w.reason END AS other
      FROM w JOIN h USING (brand, model)),
    c AS (SELECT CASE WHEN registrations < 2 THEN '1' WHEN registrations < 10 THEN '2-9' WHEN registrations < 100 THEN '10-99' WHEN registrations < 1000 THEN '100-999' ELSE '1000+' END AS bucket,
      coalesce(CAST(last_year // 10 * 10 AS VARCHAR), 'none') AS decade, registrations < 2 AND (last_year IS NULL OR last_year < 1990) AS gone FROM k WHERE other = '')
    SELECT bucket, decade, count(*) FILTER (NOT gone) AS kept, count(*) FILTER (gone) AS hidden FROM c GROUP BY 1, 2""")
def q_rare_and_old(spark, sf_dir):
    return pairs.rare_and_old_matrix(items(spark, sf_dir))


_TOTALS = """SELECT '{0}' AS stage, count(*) AS n_rows, CAST(coalesce(sum(coalesce(registered_count, 0)), 0) AS BIGINT) AS registrations,
    count(DISTINCT coalesce(brand, chr(1))) AS n_makes, count(DISTINCT (coalesce(brand, chr(1)), coalesce(model, chr(1)))) AS n_models FROM {1}"""


@query(_TOTALS.format("before", "register_rows").replace("registered_count", "1").replace("brand", "merkkiselvakielinen").replace("model,", "kaupallinennimi,") + " UNION ALL " + _TOTALS.format("after", "vehicle_items"))
def q_before_after(spark, sf_dir):
    before = table(spark, sf_dir, "register_rows").select(F.col("merkkiselvakielinen").alias("brand"), F.col("kaupallinennimi").alias("model"), F.lit(1).alias("registered_count"))
    return pairs.before_after(before, items(spark, sf_dir))


@query(f"WITH r AS ({_MAKES}) SELECT DISTINCT brand, make FROM r WHERE brand <> make")
def q_make_collapses(spark, sf_dir):
    return pairs.make_collapses(q_make_resolve(spark, sf_dir))


@query(f"""
    WITH t AS ({_TOTALS.format('x', 'vehicle_items')})
    SELECT 'total' AS measure, 'n_rows' AS name, n_rows AS amount FROM t UNION ALL SELECT 'total', 'registrations', registrations FROM t UNION ALL SELECT 'total', 'n_makes', n_makes FROM t
    UNION ALL SELECT 'total', 'n_models', n_models FROM t UNION ALL SELECT 'powertrain', powertrain, count(*) FROM vehicle_items GROUP BY 2
    UNION ALL SELECT 'class', vehicle_class, CAST(sum(coalesce(registered_count, 0)) AS BIGINT) FROM vehicle_items GROUP BY 2""")
def q_build_summary(spark, sf_dir):
    return pairs.build_summary(items(spark, sf_dir))


@query(" UNION ALL ".join(f"(SELECT DISTINCT '{n}' AS pattern, variant AS sample FROM vehicle_items WHERE regexp_matches(variant, {sql.quoted(p)}) ORDER BY variant LIMIT 6)" for n, p in NOISE.items()))
def q_noise_samples(spark, sf_dir):
    return reports.noise_samples(items(spark, sf_dir), NOISE)


@query("""SELECT item_no, coalesce(brand, '') AS brand, coalesce(model, '') AS model, coalesce(powertrain, '') AS powertrain, coalesce(years, '') AS years,
    coalesce(vehicle_type, '') AS vehicle_type, trim(regexp_replace(coalesce(variant, ''), '\\s*\\[[^\\]]*\\]\\s*$', '')) AS variant FROM vehicle_items""")
def q_legacy_labels(spark, sf_dir):
    return reports.legacy_label(items(spark, sf_dir))


@query(f"""WITH {_LABELLED}, f AS (SELECT *, row_number() OVER (PARTITION BY brand, model, powertrain, variant, years, vehicle_type, body_label ORDER BY item_no) AS nth FROM l)
    SELECT item_no, CASE WHEN nth > 1 THEN string_split(variant, ' #')[1] || ' #' || nth ELSE variant END AS variant FROM f""")
def q_unique_labels(spark, sf_dir):
    return guards.unique_labels(_labelled(spark, sf_dir)).select("item_no", "variant")


_LOWER = "replace(lower(upper({0})), 'ß', 'ss')"


@query(f"""SELECT item_no, row_number() OVER (ORDER BY coalesce(source_rank, 0), {_LOWER.format('brand')} NULLS FIRST, {_LOWER.format('model')} NULLS FIRST, powertrain NULLS FIRST,
    {_LOWER.format('variant')} NULLS FIRST, coalesce(years, ''), id NULLS FIRST, item_no) AS place FROM vehicle_items""")
def q_catalogue_order(spark, sf_dir):
    rows = items(spark, sf_dir)
    keys = [F.coalesce("source_rank", F.lit(0)), formats.folded_case(F.col("brand")), formats.folded_case(F.col("model")), F.col("powertrain"), formats.folded_case(F.col("variant")), F.coalesce("years", F.lit("")), F.col("id"), F.col("item_no")]
    return register.global_rank(rows.select("item_no", *[k.alias(f"k{i}") for i, k in enumerate(keys)]), [F.asc(f"k{i}") for i in range(len(keys))], "place").select("item_no", "place")


@query(f"WITH {_OFFERED} SELECT brand, row_number() OVER (ORDER BY {_LOWER.format('brand')}, brand) AS place FROM (SELECT DISTINCT brand FROM o)")
def q_makes_in_order(spark, sf_dir):
    made = orders.makes_in_order(_offered(spark, sf_dir)).withColumn("key", formats.folded_case(F.col("brand")))
    return register.global_rank(made, [F.asc("key"), F.asc("brand")], "place").select("brand", "place")


@query(f"SELECT item_no FROM vehicle_items WHERE {_LOWER.format('brand')} = {_LOWER.format(sql.quoted('LULBRIA'))}")
def q_casefold_filter(spark, sf_dir):
    return items(spark, sf_dir).where(formats.folded_case(F.col("brand")) == formats.folded_case(F.lit("LULBRIA"))).select("item_no")


@query("""SELECT item_no, 'Auto: ' || coalesce(brand, '') || ' (' || coalesce(model, '') || '), ' || coalesce(brand, '') || '%' AS title,
    replace(replace(replace(replace(replace(variant, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(39), '&#039;'), '"', '&quot;') AS html,
    replace(replace(printf('%,d', registered_count), '.', ','), ',', chr(160)) || chr(160) || '€' AS amount FROM vehicle_items""")
def q_formats(spark, sf_dir):
    title = formats.filled(F.lit("Auto: %s (%2$s), %1$s%"), F.col("brand"), F.col("model"))
    return items(spark, sf_dir).select("item_no", title.alias("title"), formats.escaped(F.col("variant")).alias("html"), formats.euro_text(F.col("registered_count")).alias("amount"))


@query("""WITH y AS (SELECT item_no, TRY_CAST(regexp_extract(coalesce(years, ''), '^([0-9]{4})([–-][0-9]{4})?$', 1) AS INTEGER) AS y FROM vehicle_items)
    SELECT item_no, CASE WHEN y BETWEEN 1886 AND 2026 THEN y ELSE 0 END AS start_year FROM y""")
def q_start_year(spark, sf_dir):
    return items(spark, sf_dir).select("item_no", formats.start_year(F.col("years")).alias("start_year"))


@query(f"""WITH {_LABELLED}, g AS (SELECT *, min({{'a': coalesce(source_rank, 0), 'b': item_no}}) OVER (PARTITION BY coalesce(brand, ''), coalesce(model, ''), coalesce(powertrain, ''), coalesce(variant, ''),
      years, coalesce(vehicle_type, ''), body_label).b AS kept, count(*) OVER (PARTITION BY coalesce(brand, ''), coalesce(model, ''), coalesce(powertrain, ''), coalesce(variant, ''), years,
      coalesce(vehicle_type, ''), body_label) AS n FROM l),
    r AS (SELECT kept, n, item_no, source_rank, len(source_records) > 0 AS had, CASE WHEN len(source_records) > 0 THEN [x.id FOR x IN source_records] ELSE [id] END AS ids FROM g),
    e AS (SELECT kept, unnest(ids) AS rid FROM r)
    SELECT kept AS item_no, string_agg(DISTINCT rid, ',' ORDER BY rid) AS record_ids FROM e WHERE rid <> '' AND kept IN (SELECT kept FROM r WHERE n > 1 OR had) GROUP BY 1""")
def q_lineage(spark, sf_dir):
    merged = merge.merge_rows(_labelled(spark, sf_dir).fillna({"brand": "", "model": "", "variant": "", "vehicle_type": "", "powertrain": ""}))
    return merged.where(F.size("lineage") > 0).select("item_no", F.array_join(F.array_sort(F.col("lineage")["id"]), ",").alias("record_ids"))


@query()
def q_series_groups(spark, sf_dir):
    return reports.series_groups(items(spark, sf_dir))


@query(f"SELECT DISTINCT model, {sql.natural_key('model')} AS sort_key FROM vehicle_items WHERE model IS NOT NULL")
def q_natural_sort(spark, sf_dir):
    rows = items(spark, sf_dir).where(F.col("model").isNotNull()).select("model").distinct()
    return rows.select("model", T.natural_key(F.col("model")).alias("sort_key"))


# ---------------------------------------------------------------- comparison and import

_LINES = " UNION ALL ".join(f"SELECT item_no, '{c}' AS line, CAST({c} AS DOUBLE) AS amount FROM vehicle_items WHERE {c} > 0" for c in COSTS)


@query(_LINES)
def q_cost_lines(spark, sf_dir):
    return compare.lines(items(spark, sf_dir), "item_no", COSTS)


@query(f"""WITH l AS ({_LINES}) SELECT item_no, line, amount, amount / sum(amount) OVER (PARTITION BY item_no) AS share,
    sum(amount) OVER (PARTITION BY item_no ORDER BY amount DESC, line ROWS UNBOUNDED PRECEDING) / sum(amount) OVER (PARTITION BY item_no) AS until FROM l""")
def q_cost_shares(spark, sf_dir):
    return compare.shares(q_cost_lines(spark, sf_dir), "item_no")


@query("""SELECT item_no, id, service_cost, service_cost - min(service_cost) OVER (PARTITION BY id) AS delta, service_cost / nullif(max(service_cost) OVER (PARTITION BY id), 0)::DOUBLE AS ratio,
    service_cost = min(service_cost) OVER (PARTITION BY id) AS is_least FROM vehicle_items""")
def q_comparison(spark, sf_dir):
    return compare.compare(items(spark, sf_dir).select("item_no", "id", "service_cost"), "id", "service_cost")


@query(" UNION ALL ".join(f"SELECT id, '{c}' AS assumption, count(*) AS n_known, count(DISTINCT {c}) AS n_values FROM vehicle_items WHERE {c} IS NOT NULL GROUP BY id HAVING count(*) >= 2 AND count(DISTINCT {c}) >= 2" for c in ("co2", "mass", "years", "powertrain")))
def q_assumption_diff(spark, sf_dir):
    return compare.differing_assumptions(items(spark, sf_dir), "id", ["co2", "mass", "years", "powertrain"])


@query("""SELECT id, item_no FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC, item_no DESC) AS r FROM vehicle_items) WHERE r = 1
    ORDER BY updated_at DESC, id LIMIT 10""")
def q_comparison_list(spark, sf_dir):
    return compare.latest(items(spark, sf_dir).select("id", "item_no", "updated_at"), "id", "updated_at").select("id", "item_no")


@query(f"""WITH r AS (SELECT 'wltp' AS method, CAST(i AS INTEGER) AS level, i * 1.5::DOUBLE AS rate FROM range(401) t(i))
    SELECT item_no, coalesce(rate, 0.5)::DOUBLE AS rate FROM vehicle_items v LEFT JOIN r ON r.method = CASE WHEN v.tax_measurement = 'nedc' THEN 'nedc' ELSE 'wltp' END AND r.level = least(400, v.co2)""")
def q_rate_lookup(spark, sf_dir):
    rates = spark.range(401).select(F.lit("wltp").alias("method"), F.col("id").cast("int").alias("level"), (F.col("id") * 1.5).alias("rate"))
    return compare.rate_lookup(items(spark, sf_dir), rates, "tax_measurement", "co2", 400, 0.5).select("item_no", "rate")


@query(f"""WITH c AS (SELECT entry_no, regexp_replace(lower(coalesce(id, '')), '[^a-z0-9_-]', '', 'g') AS id, {sql.clean('brand')} AS brand, {sql.clean('model')} AS model,
      lower({sql.clean('powertrain')}) AS powertrain, coalesce(fuel_consumption, 0.0) AS fuel_consumption, CAST(coalesce(mass, 0) AS DOUBLE) AS mass, CAST(coalesce(service_cost, 360) AS DOUBLE) AS service_cost
      FROM admin_entries)
    SELECT * FROM c WHERE id NOT IN ('', '0') AND brand NOT IN ('', '0') AND model NOT IN ('', '0') AND powertrain IN {sql.listed(rules.POWERTRAINS)}""")
def q_import_sanitized(spark, sf_dir):
    lines = importing.sanitize(table(spark, sf_dir, "admin_entries"))
    return lines.select("entry_no", "id", "brand", "model", "powertrain", "fuel_consumption", "mass", "service_cost")
