"""Texts for display: placeholders, HTML, numbers; and comparison without regard to case."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vaunu.functions import rules

#: What stands for a sign in HTML.
HTML = {"&": "&amp;", "<": "&lt;", ">": "&gt;", "'": "&#039;", '"': "&quot;"}


def folded_case(column: Column) -> Column:
    """Small letters, with ``ß`` as ``ss``: two texts are the same but for case if these are equal."""
    return F.replace(F.lower(F.upper(column)), F.lit("ß"), F.lit("ss"))


def filled(template: Column, *values: Column) -> Column:
    """A text with ``%s`` replaced by the values in turn and ``%2$s`` by the second; a missing value is empty."""
    pieces = F.regexp_extract_all(template, F.lit(r"%[0-9]+\$s|%s|[^%]+|%"), F.lit(0))
    given = F.array(*[F.coalesce(v.cast("string"), F.lit("")) for v in values]) if values else F.array().cast("array<string>")

    def piece(p: Column, at: Column) -> Column:
        turn = F.size(F.filter(F.slice(pieces, 1, at + 1), lambda x: x == "%s")) - 1
        place = F.regexp_extract(p, r"^%([0-9]+)\$s$", 1).try_cast("int") - 1
        return F.when(p == "%s", F.coalesce(F.get(given, turn), F.lit(""))).when(place.isNotNull(), F.coalesce(F.get(given, place), F.lit(""))).otherwise(p)

    return F.array_join(F.transform(pieces, piece), "")


def escaped(column: Column) -> Column:
    """A text for HTML."""
    for sign, code in HTML.items():
        column = F.replace(column, F.lit(sign), F.lit(code))
    return column


def number_text(value: Column, decimals: int = 0) -> Column:
    """A number the Finnish way: thousands apart by a no-break space, a decimal comma, a true minus; halves away from zero."""
    rounded = F.round(F.abs(value.cast("double")), decimals)
    text = F.translate(F.format_number(rounded, decimals), ",.", " ,")
    return F.when((value < 0) & (rounded > 0), F.concat(F.lit("−"), text)).otherwise(text)


def euro_text(value: Column, decimals: int = 0) -> Column:
    return F.concat(number_text(value, decimals), F.lit(" €"))


def start_year(years: Column, as_of: int = rules.SOURCE_YEAR) -> Column:
    """The first year of ``2004–2009`` or ``2004``, 0 unless it lies between 1886 and ``as_of``."""
    found = F.regexp_extract(F.coalesce(years, F.lit("")), "^([0-9]{4})(?:[–-][0-9]{4})?$", 1).try_cast("int")
    return F.when(found.between(1886, as_of), found).otherwise(0)
