"""Column expressions for texts and numbers: cleaning, identity keys, word stripping, lenient parsing."""

from __future__ import annotations

import functools
import operator
import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from vaunu.functions import rules


def _plain_forms() -> dict[str, str]:
    """The plain form (small ASCII letters and figures) of every character that has one and isn't it; built from the Unicode tables."""
    forms = {}
    for point in [*range(0x41, 0x5B), *range(0xA0, 0xAC00), *range(0xF900, 0x20000)]:
        ch = chr(point)
        parts = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c)).casefold()
        plain = "".join(c for c in parts if c.isascii() and c.isalnum())
        if plain:
            forms[ch] = plain
    return forms


def _key_forms() -> dict[str, str]:
    """What a character, or a letter with its combining mark, is in compatible composed form with case folded."""
    forms = {}
    for point in [*range(0x41, 0x5B), *range(0xA0, 0xAC00), *range(0xF900, 0x20000)]:
        ch = chr(point)
        new = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", ch).casefold())
        if new != ch:
            forms[ch] = new
        apart = unicodedata.normalize("NFD", ch)
        if len(apart) == 2 and unicodedata.combining(apart[1]) and unicodedata.normalize("NFC", apart) == ch:
            forms[apart] = new
    return forms


def _listed(forms: dict[str, str]) -> str:
    """The pairs of a map in one text, so that a plan carries one short literal for it."""
    return "".join(f"\x01{k}\x02{v}" for k, v in forms.items()) + "\x01"


_PLAIN, _KEYS = _plain_forms(), _key_forms()
FOLD_FROM, FOLD_TO = ("".join(x) for x in zip(*[(c, p) for c, p in _PLAIN.items() if len(p) == 1]))
#: Characters whose plain form is several letters.
FOLD_LONG = _listed({c: p for c, p in _PLAIN.items() if len(p) > 1})
KEY_FORMS = _listed(_KEYS)


def _mapped(column: Column, pieces: str, listed: str) -> Column:
    """Each piece of a text as its form; plain ASCII texts stay as they are."""

    def form(piece: Column) -> Column:
        rest = F.call_function("substring_index", F.lit(listed), F.concat(F.lit("\x01"), piece, F.lit("\x02")), F.lit(-1))
        return F.when(F.length(rest) == len(listed), piece).otherwise(F.substring_index(rest, "\x01", 1))

    found = F.transform(F.regexp_extract_all(column, F.lit(pieces), F.lit(0)), form)
    return F.when(column.rlike(r"[^\x00-\x7f]"), F.array_join(found, "")).otherwise(column)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, so that composed expressions stay small."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def clean(column: Column) -> Column:
    """White space of any kind collapsed to single spaces, ends trimmed; null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(column, F.lit("")), r"(?U)\s+", " "))


def replace(column: Column, pattern: str, new: str) -> Column:
    """All matches of a case-insensitive pattern with Unicode classes."""
    return F.regexp_replace(column, "(?iU)" + pattern, new)


def matches(column: Column, pattern: str) -> Column:
    return column.rlike("(?iU)" + pattern)


def fold(column: Column) -> Column:
    """Small ASCII letters and figures only: the identity of a name whatever its case, accents and separators."""
    long = _mapped(F.coalesce(column, F.lit("")), "(?s).", FOLD_LONG)
    return F.regexp_replace(F.translate(long, FOLD_FROM, FOLD_TO), "[^0-9a-z]+", "")


def make_key(column: Column) -> Column:
    """Small letters with accents, words divided by single spaces."""
    return F.trim(F.regexp_replace(F.lower(_mapped(clean(column), r"(?s).\p{M}?", KEY_FORMS)), r"[^\p{L}\p{N}]+", " "))


def make_token(column: Column) -> Column:
    """The first word of a make."""
    return F.get(F.split(clean(column), r"[,\s\-/–]+", 2), F.lit(0))


def _strip(column: Column, chars: str) -> Column:
    return F.btrim(column, F.lit(chars))


def or_whole(stripped: Column, whole: Column) -> Column:
    """``stripped``, or ``whole`` where nothing is left."""
    return F.coalesce(F.nullif(stripped, F.lit("")), whole)


_FORMS = "|".join(f.replace(".", r"\.") for f in sorted(rules.BRAND_SUFFIXES, key=len, reverse=True))
#: Everything up to the first of the legal forms and country tags a name ends in.
BEFORE_FORMS = rf"^(.+?)(?:[\s,\-]+(?:{_FORMS})(?:\s*\.)?[\s,.\-]*|[\s,;]*\([a-z]{{2,4}}\)[\s,;]*)+$"


def strip_legal_forms(column: Column) -> Column:
    """Legal forms and country tags off the end, as many as there are, never the whole name."""
    return let(clean(column), lambda v: or_whole(_strip(replace(v, BEFORE_FORMS, "$1"), " ,;-."), v))


def expand_makes(column: Column) -> Column:
    """Abbreviated makes written out."""
    value = replace(column, r"(?<![0-9a-z])m[\s.\-]*b(?![0-9a-z])", "Mercedes-Benz")
    value = replace(value, r"\bmercedes[\s\-]+benz\b", "Mercedes-Benz")
    value = replace(value, r"\bmercedes\b(?![\s\-]*benz)", "Mercedes-Benz")
    return replace(value, r"(?<![0-9a-z])vw(?![0-9a-z])", "Volkswagen")


def literal_map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def normalize_make(column: Column) -> Column:
    """Curated corrections first; else abbreviations written out and legal forms stripped."""
    return let(clean(column), lambda v: F.coalesce(F.try_element_at(literal_map(rules.BRAND_FIXES), F.lower(v)), strip_legal_forms(expand_makes(v))))


def strip_words(column: Column, pattern: str) -> Column:
    """A name without some words, never without all of them."""

    def without(whole: Column) -> Column:
        value = F.regexp_replace(replace(whole, pattern, " "), r"\(\s*\)", " ")
        return or_whole(_strip(F.regexp_replace(value, r"\s{2,}", " "), " -,/"), whole)

    return let(F.coalesce(column, F.lit("")), without)


def strip_engine_words(column: Column) -> Column:
    return strip_words(column, rules.ENGINE_WORDS)


def strip_body_words(column: Column) -> Column:
    return strip_words(column, rules.BODY_WORDS)


def strip_exact_make(make: Column, name: Column) -> Column:
    """A make written before a name, with any separator; a name that is the make alone becomes empty."""

    def without(value: Column, token: Column) -> Column:
        n = F.length(token)
        starts = (token != "") & F.upper(value).startswith(F.upper(token))
        following = F.substring(value, n + 1, F.lit(1)).isin(" ", "-", "/", "–", "—", ",", ".")
        return (
            F.when(starts & following, F.trim(F.substring(value, n + 2, F.length(value))))
            .when(starts & (F.length(value) == n), "")
            .otherwise(F.lit(None))
        )

    def both(value: Column) -> Column:
        return F.coalesce(let(clean(make), lambda t: without(value, t)), let(make_token(make), lambda t: without(value, t)), value)

    return let(name, both)


def is_more_make(make: Column, key: Column) -> Column:
    """The key is a curated further spelling of the make that models begin with."""
    hits = [(F.lower(clean(make)) == m) & key.isin(more) for m, more in rules.MORE_MAKES.items()]
    return functools.reduce(operator.or_, hits, F.lit(False))


def _spellings(full: str) -> str:
    """A pattern of what :func:`normalize_make` turns into a make."""
    fixes = [re.escape(k) for k, v in rules.BRAND_FIXES.items() if v == full]
    short = {"Mercedes-Benz": [r"mercedes(?:[\s\-]*benz)?", r"m[\s.\-]*b"], "Volkswagen": ["vw", "volkswagen"]}
    return rf"(?iU)^(?:(?:{'|'.join(short.get(full, [re.escape(full)]))})(?:[\s,\-]+(?:{_FORMS})(?:\s*\.)?[\s,.\-]*|[\s,;]*\([a-z]{{2,4}}\)[\s,;]*)*|{'|'.join(fixes) or '(?!)'})$"


OWN = {full: _spellings(full) for full in rules.MODEL_MAKES}


def strip_make_alias(make: Column, name: Column) -> Column:
    """An abbreviation of the row's own make before a name (``VW PASSAT``), the longest that fits; the rest must have a letter or figure."""

    def without(value: Column) -> Column:
        out = value
        for full, aliases in rules.MODEL_MAKES.items():
            before = "|".join(re.escape(a) for a in sorted(aliases, key=len, reverse=True))
            pattern = rf"(?i)^(?:{before})[ \-,./][ \-,/.]*(?=.*[0-9A-Za-z])(.*?)[ \-,/.]*$"
            out = F.when(clean(make).rlike(OWN[full]), F.regexp_replace(value, pattern, "$1")).otherwise(out)
        return out

    return let(name, without)


def strip_mistyped_make(make: Column, name: Column) -> Column:
    """A make of one to three words before a name, at most one edit off; a make with figures stays."""

    def head_is_make(head: Column, key: Column) -> Column:
        figures = head.startswith(key) & F.substring(head, F.length(key) + 1, F.length(head)).rlike("^[0-9]+$")
        return (F.length(key) >= 4) & (F.levenshtein(head, key) <= 1) & ~figures

    makes = F.array(fold(clean(make)), fold(make_token(make)))

    def without(words: Column, count: int) -> Column:
        head = fold(F.array_join(F.filter(F.slice(words, 1, count), lambda w: fold(w) != "and"), " "))
        rest = _strip(F.array_join(F.slice(words, count + 1, F.greatest(F.size(words), F.lit(1))), " "), " -,")
        hit = let(head, lambda h: (h != "") & (F.exists(makes, lambda k: head_is_make(h, k)) | is_more_make(make, h)))
        return F.when((F.size(words) > count) & hit, F.nullif(rest, F.lit("")))

    def whole(value: Column) -> Column:
        return let(F.split(clean(value), " "), lambda words: F.coalesce(without(words, 3), without(words, 2), without(words, 1), value))

    return let(name, whole)


def strip_make(make: Column, name: Column) -> Column:
    """A repeated make off the front of a name, never the whole name."""

    def without(whole: Column) -> Column:
        value = strip_exact_make(make, whole)
        value = strip_mistyped_make(make, value)
        value = strip_exact_make(make, value)
        value = strip_make_alias(make, value)
        return or_whole(value, whole)

    return let(clean(name), without)


def normalize_model(make: Column, name: Column) -> Column:
    """:func:`strip_make`, and a single word in capitals in title case."""
    return let(strip_make(make, name), lambda v: F.when(v.rlike(r"^\p{Lu}+$"), F.initcap(v)).otherwise(v))


def model_key(make: Column, name: Column) -> Column:
    return fold(normalize_model(make, name))


def series_key(make: Column, name: Column) -> Column:
    """The identity of a model without engine, body and series words: ``3-sarja`` is ``3``."""
    return bare_series(normalize_model(make, name))


def bare_series(name: Column) -> Column:
    """:func:`series_key` of a name that :func:`normalize_model` has seen."""
    value = F.regexp_replace(name, "[¹²³]", "")
    value = strip_body_words(strip_engine_words(value))
    value = replace(value, r"\s*\(\s*(\d{1,3})\s+series\s*\)", " $1")
    value = replace(value, rules.SERIES_WORDS, " ")
    return fold(replace(value, r"\b(\d{1,3})er\b", "$1"))


# ---------------------------------------------------------------- variants


def strip_detail(column: Column) -> Column:
    """A bracketed suffix off the end of a variant."""
    return F.trim(F.regexp_replace(F.coalesce(column, F.lit("")), r"(?U)\s*\[[^\]]*\]\s*$", ""))


def variant_base(column: Column) -> Column:
    """A variant without bracketed details, approval and power."""
    value = F.regexp_replace(strip_detail(clean(column)), r"(?U)\s*\([^()]*\)\s*$", "")
    return F.trim(replace(value, r",\s*\d+(?:[.,]\d+)?\s*kW\s*$", ""))


def visible_variant(variant: Column, approval: Column) -> Column:
    """A variant without its type approval."""
    value = F.coalesce(variant, F.lit(""))
    shown = F.when(F.coalesce(approval, F.lit("")) != "", F.replace(value, F.concat(F.lit(" ("), approval, F.lit(")")), F.lit(""))).otherwise(value)
    return F.trim(F.regexp_replace(shown, r"\s{2,}", " "))


POWER = r"\s*,\s*\d+(?:[.,]\d+)?\s*kW\s*$"


def clean_variant(column: Column) -> Column:
    """A technical designation reduced to its engine: ``INSIGHT Viistoperä (AB) 4ov 1339cm3, 65 kW`` is ``INSIGHT 1.3, 65 kW``."""

    def engine(whole: Column) -> Column:
        value = F.when(matches(whole, POWER), F.regexp_replace(replace(whole, POWER, ""), r"[ ,\-/]+$", "")).otherwise(whole)
        value = F.regexp_replace(value, r"(?U)\s*\([A-Z]{1,2}\)", " ")
        value = replace(value, r"-[a-z0-9]{1,6}/[0-9]{2,4}\b|/[0-9]{2,4}\b|-\d{3,}\b|-[a-z]{2}\d{1,4}\b", " ")
        value = replace(value, r"(?:^|(?<=\s))\d+\s*ov(?=\s|,|$)|(?:^|(?<=\s))[2-6]d(?=\s|,|$|[A-Z])", " ")
        value = replace(replace(value, rules.VARIANT_BODY, " "), r"\b(?:automatic|automat|autom)\b", " ")
        value = let(value, lambda v: F.when(matches(v, r"\b\d[.,]\d\b"), replace(v, r"\d{3,4}\s*cm3", " ")).otherwise(_litres(v)))
        value = _strip(F.regexp_replace(value, r"\s{2,}", " "), " ,-/")
        power = F.trim(F.regexp_extract(whole, "(?iU)(" + POWER + ")", 1))
        value = F.regexp_replace(_strip(F.concat(value, power), " ,-/"), r"(\d),(\d)", "$1.$2")
        return _strip(F.regexp_replace(value, r"\s{2,}", " "), " ,-/")

    return let(clean(column), engine)


#: Displacements in the middle of two tenths whose binary value in litres lies above the middle.
TIES_UP = [n for n in range(150, 10_000, 100) if f"{n / 1000:.1f}" == f"{(n + 50) / 1000:.1f}"]


def _litres(column: Column) -> Column:
    """Each displacement in cubic centimetres as litres with one decimal, ties as in binary arithmetic."""
    pieces = F.split(column, r"(?iU)(?<![0-9])(?=\d{3,4}\s*cm3)|(?<=cm3)")

    def turn(piece: Column) -> Column:
        cm3 = F.regexp_extract(piece, r"(?iU)^(\d{3,4})\s*cm3$", 1).try_cast("int")
        tenths = F.floor((cm3 + 49) / 100) + cm3.isin(TIES_UP).cast("int")
        return F.coalesce(F.regexp_replace((tenths / 10).cast("string"), r"\.0$", ""), piece)

    return F.array_join(F.transform(pieces, turn), "")


def strip_model_from_variant(model: Column, variant: Column) -> Column:
    """A leading model name off a variant, never the whole variant."""

    def without(value: Column, name: Column) -> Column:
        following = F.substring(value, F.length(name) + 1, F.lit(1))
        starts = (name != "") & F.lower(value).startswith(F.lower(name)) & ~following.rlike(r"(?U)\w")
        rest = _strip(F.regexp_replace(F.substring(value, F.length(name) + 1, F.length(value)), r"\s{2,}", " "), " ,-/")
        return F.coalesce(F.when(starts, F.nullif(rest, F.lit(""))), value)

    return let(clean(variant), lambda v: let(clean(model), lambda m: without(v, m)))


def strip_code_letter(column: Column) -> Column:
    """A lone ``A`` after a figure."""
    value = F.regexp_replace(clean(column), r"(?iU)(?<=\d)\s+a\b", "")
    value = F.regexp_replace(F.regexp_replace(value, r"\s+,\s*", ", "), r"\s{2,}", " ")
    return _strip(value, " ,-/")


def is_designation(model: Column, variant: Column) -> Column:
    """The model is no more than the variant's technical designation."""
    return let(fold(model), lambda key: (key != "") & (key == fold(variant_base(variant))))


def is_unknown(make: Column, model: Column) -> Column:
    """A placeholder, engine words only, or the make again."""
    key, own = fold(clean(model)), fold(clean(make))
    alias = F.lit(False)
    for full, aliases in rules.MODEL_MAKES.items():
        keys = sorted({"".join(c for c in a.casefold() if c.isalnum()) for a in aliases})
        alias = alias | clean(make).rlike(OWN[full]) & key.isin(keys)
    return (key == "") | key.isin(rules.UNKNOWN_MODELS) | clean(model).rlike("(?iU)^(?:" + rules.ENGINE_WORDS + ")$") | ((own != "") & ((key == own) | alias | is_more_make(make, key)))


def is_technical(model: Column) -> Column:
    return matches(clean(model), rules.TECHNICAL)


# ---------------------------------------------------------------- numbers and years


NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def numeric(column: Column) -> Column:
    """A number with decimal comma or point, 0 for anything else."""
    text = F.replace(F.coalesce(column, F.lit("")), F.lit(","), F.lit("."))
    return F.when(text.rlike(NUMBER), F.coalesce(F.trim(text).try_cast("double"), F.lit(0.0))).otherwise(0.0)


def first_year(column: Column) -> Column:
    """The first four figures of a date text."""
    return F.regexp_extract(F.coalesce(column, F.lit("")), "([0-9]{4})", 1).try_cast("int")


def year_span(column: Column, source_year: int = rules.SOURCE_YEAR) -> tuple[Column, Column]:
    """First and last year of ``1998–2005`` or ``2005``; null where it is no possible span."""
    text = clean(column)
    fits = text.rlike("^[0-9]{4}([–-][0-9]{4})?$")
    start = F.regexp_extract(text, "^([0-9]{4})", 1).try_cast("int")
    end = F.coalesce(F.regexp_extract(text, "[–-]([0-9]{4})$", 1).try_cast("int"), start)
    valid = fits & (start >= 1886) & (end >= start) & (end <= source_year)
    return F.when(valid, start), F.when(valid, end)


def years_label(start: Column, end: Column) -> Column:
    return F.when(start.isNull() | end.isNull(), "Tuntematon").when(start == end, start.cast("string")).otherwise(F.concat(start.cast("string"), F.lit("–"), end.cast("string")))


def natural_key(column: Column) -> Column:
    """A sort key for which figures count by value, whatever the case: each run of figures has its length before it."""
    pieces = F.regexp_extract_all(F.lower(column), F.lit("[0-9]+|[^0-9]+"), F.lit(0))

    def keyed(piece: Column) -> Column:
        bare = F.regexp_replace(piece, "^0+(?=[0-9])", "")
        return F.when(piece.rlike("^[0-9]"), F.concat(F.lpad(F.length(bare).cast("string"), 10, "0"), bare)).otherwise(piece)

    return F.array_join(F.transform(pieces, keyed), "")
