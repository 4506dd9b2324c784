"""Pieces of DuckDB SQL that several statements share; written on their own, not generated from the Spark plans."""

from __future__ import annotations

import unicodedata

from vaunu.functions import rules

NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
#: Nothing follows a whole name, so what must not follow a word plays no part there.
ENGINE_NAME = rules.ENGINE_WORDS.replace("(?!-)", "")

SPACES = r"[\s\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{000b}]+"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(values) -> str:
    return "(" + ", ".join(map(quoted, values)) + ")"


def clean(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{SPACES}', ' ', 'g'))"


def numeric(x: str) -> str:
    text = f"replace(coalesce({x}, ''), ',', '.')"
    return f"(CASE WHEN regexp_matches({text}, {quoted(NUMBER)}) THEN coalesce(TRY_CAST(trim({text}) AS DOUBLE), 0) ELSE 0 END)"


def whole(x: str) -> str:
    return f"CAST(round_even({numeric(x)}, 0) AS INTEGER)"


def _folded(ch: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", unicodedata.normalize("NFKD", ch).lower().replace("ß", "ss")) if c in "abcdefghijklmnopqrstuvwxyz0123456789")


def _keyed(ch: str) -> str:
    return unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", ch).casefold())


def _mapped(x: str, pieces: str, forms: dict[str, str]) -> str:
    table = "MAP {" + ", ".join(f"{quoted(k)}: {quoted(v)}" for k, v in forms.items()) + "}"
    return f"(CASE WHEN regexp_matches({x}, '[^\\x00-\\x7f]') THEN array_to_string([coalesce({table}[c], c) FOR c IN regexp_extract_all({x}, '{pieces}')], '') ELSE {x} END)"


_LETTERS = [chr(i) for i in [*range(0xA0, 0x3400), *range(0xA640, 0xAC00), *range(0xF900, 0x10000), *range(0x1D400, 0x1D800), *range(0x1F100, 0x1F200)]]
_FOLDS = {ch: _folded(ch) for ch in _LETTERS if _folded(ch)}
_KEYS = {ch: _keyed(ch) for ch in _LETTERS if _keyed(ch) != ch}
_KEYS |= {unicodedata.normalize("NFD", ch): _keyed(ch) for ch in map(chr, range(0xC0, 0x2000)) if len(unicodedata.normalize("NFD", ch)) == 2 and unicodedata.normalize("NFC", unicodedata.normalize("NFD", ch)) == ch}


def fold(x: str) -> str:
    text = f"coalesce({x}, '')"
    return f"regexp_replace(lower({_mapped(text, '(?s).', _FOLDS)}), '[^0-9a-z]+', '', 'g')"


def make_key(x: str) -> str:
    return f"trim(regexp_replace(lower({_mapped(clean(x), '(?s).' + chr(92) + 'pM?', _KEYS)}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


def normal_make(x: str) -> str:
    """Curated corrections, abbreviations written out, legal forms and country tags off the end; ``x`` is clean."""
    fixes = "MAP {" + ", ".join(f"{quoted(k)}: {quoted(v)}" for k, v in rules.BRAND_FIXES.items()) + "}"
    text = f"regexp_replace({x}, '(?i)(^|[^0-9a-z])m[\\s.\\-]*b($|[^0-9a-z])', '\\1Mercedes-Benz\\2', 'g')"
    text = f"replace(regexp_replace(regexp_replace({text}, '(?i)\\bmercedes[\\s\\-]*benz\\b', chr(1), 'g'), '(?i)\\bmercedes\\b', chr(1), 'g'), chr(1), 'Mercedes-Benz')"
    text = f"regexp_replace({text}, '(?i)(^|[^0-9a-z])vw($|[^0-9a-z])', '\\1Volkswagen\\2', 'g')"
    forms = "|".join(f.replace(".", "[.]") for f in sorted(rules.BRAND_SUFFIXES, key=lambda f: -len(f)))
    ends = rf"(?i)^(.+?)(?:[\s,\-]+(?:{forms})\s*[.]?[\s,.\-]*|[\s,;]*\([a-z]{{2,4}}\)[\s,;]*)+$"
    return f"coalesce({fixes}[lower({x})], nullif(trim(regexp_replace({text}, {quoted(ends)}, '\\1'), ' ,;-.'), ''), {text})"


def variant_base(x: str) -> str:
    text = f"trim(regexp_replace({clean(x)}, '\\s*\\[[^\\]]*\\]\\s*$', ''))"
    return f"trim(regexp_replace(regexp_replace({text}, '\\s*\\([^()]*\\)\\s*$', ''), '(?i),\\s*\\d+(?:[.,]\\d+)?\\s*kW\\s*$', ''))"


def natural_key(x: str) -> str:
    return (
        f"array_to_string([CASE WHEN regexp_matches(p, '^[0-9]') THEN lpad(CAST(length(regexp_replace(p, '^0+([0-9])', '\\1')) AS VARCHAR), 10, '0') || regexp_replace(p, '^0+([0-9])', '\\1')"
        f" ELSE p END FOR p IN regexp_extract_all(lower({x}), '[0-9]+|[^0-9]+')], '')"
    )


def year_from(x: str) -> str:
    return _years(x, "s")


def year_to(x: str) -> str:
    return _years(x, "e")


def _years(x: str, end: str) -> str:
    text = clean(x)
    start = f"TRY_CAST(regexp_extract({text}, '^([0-9]{{4}})', 1) AS INTEGER)"
    last = f"coalesce(TRY_CAST(nullif(regexp_extract({text}, '[–-]([0-9]{{4}})$', 1), '') AS INTEGER), {start})"
    fits = f"regexp_matches({text}, '^[0-9]{{4}}([–-][0-9]{{4}})?$') AND {start} >= 1886 AND {last} >= {start} AND {last} <= {rules.SOURCE_YEAR}"
    return f"(CASE WHEN {fits} THEN {start if end == 's' else last} END)"


def vehicle_type(kind: str, body: str, group: str) -> str:
    k, b = f"upper({clean(kind)})", f"upper({clean(body)})"

    def has(groups) -> str:
        return f"list_has_any(string_split_regex({clean(group)}, '[,\\s]+'), [{', '.join(map(quoted, groups))}])"

    return f"""(CASE WHEN {has(rules.MOTORHOME_GROUPS)} OR {b} = 'SA' THEN 'motorhome'
        WHEN {k} IN ('M2', 'M2G') OR {has(rules.MINIBUS_GROUPS)} THEN 'minibus'
        WHEN {k} IN ('M3', 'M3G') OR {has(rules.BUS_GROUPS)} OR {b} IN {listed(rules.BUS_BODIES)} THEN 'bus'
        WHEN {has(rules.SPECIAL_GROUPS)} OR {b} IN {listed(rules.SPECIAL_BODIES)} THEN 'special'
        WHEN {k} IN ('N1', 'N1G') AND {b} = 'BB' THEN 'van' WHEN {k} IN ('N1', 'N1G') AND {b} = 'BE' THEN 'pickup'
        WHEN {k} IN ('N1', 'N1G') THEN 'light_truck' WHEN {b} = 'BB' THEN 'van' WHEN {b} IN ('BA', 'BE') THEN 'pickup' ELSE 'passenger' END)"""


def powertrain() -> str:
    fuel, hybrid = clean("kayttovoima"), f"lower({clean('sahkohybridi')}) = 'true'"
    return f"""(CASE WHEN {fuel} = '04' THEN 'electric' WHEN {hybrid} AND {clean('sahkohybridinluokka')} = '01' THEN 'phev'
        WHEN {hybrid} THEN 'hybrid' WHEN {fuel} = '02' THEN 'diesel' WHEN {fuel} = '01' THEN 'petrol' END)"""


def body_label(x: str) -> str:
    cases = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in rules.BODY_LABELS.items())
    return f"(CASE upper({clean(x)}) {cases} ELSE '' END)"


REGISTER = f"""
    register AS (SELECT row_no, upper({clean('ajoneuvoluokka')}) AS vehicle_class, upper({clean('korityyppi')}) AS body_type, {whole('istumapaikkojenlkm')} AS seats,
        {clean('merkkiselvakielinen')} AS brand, coalesce(nullif({clean('kaupallinennimi')}, ''), {clean('mallimerkinta')}) AS model,
        {clean('mallimerkinta')} AS designation, {clean('kaupallinennimi')} AS commercial_name, {clean('tyyppihyvaksyntanro')} AS type_approval,
        {clean('variantti')} AS variant_code, {clean('versio')} AS version_code, {powertrain()} AS powertrain, {clean('kayttovoima')} AS fuel_code,
        CASE WHEN {numeric('wltp2_co2')} > 0 THEN {whole('wltp2_co2')} WHEN {numeric('wltp_co2')} > 0 THEN {whole('wltp_co2')}
             WHEN {numeric('nedc2_co2')} > 0 THEN {whole('nedc2_co2')} WHEN {numeric('nedc_co2')} > 0 THEN {whole('nedc_co2')} ELSE 0 END AS co2,
        CASE WHEN {numeric('wltp2_co2')} > 0 OR {numeric('wltp_co2')} > 0 THEN 'wltp' WHEN {numeric('nedc2_co2')} > 0 OR {numeric('nedc_co2')} > 0 THEN 'nedc'
             ELSE 'wltp' END AS tax_measurement,
        CASE {clean('kayttovoima')} WHEN '02' THEN 'diesel' WHEN '04' THEN 'electricity' ELSE 'petrol' END AS tax_power_source,
        {whole('tieliiksuursallkokmassa')} AS road_mass, {whole('teknsuursallkokmassa')} AS technical_mass, {whole('omamassa')} AS curb_mass,
        round_even({numeric('suurinnettoteho')}, 1) AS power, {clean('ajoneuvoryhma')} AS vehicle_group,
        TRY_CAST(nullif(regexp_extract(coalesce(ensirekisterointipvm, ''), '([0-9]{{4}})', 1), '') AS INTEGER) AS first_year FROM register_rows),
    supported AS (SELECT * FROM register WHERE vehicle_class IN {listed(rules.SUPPORTED_CLASSES)} AND brand <> '' AND model <> '' AND powertrain IS NOT NULL)"""
