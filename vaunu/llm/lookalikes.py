"""Problem 2: text that looks the same but consists of other characters, brought to one form.

Only distinct values are examined. Width, style and ligature forms are folded, accents composed,
spaces and hyphens unified, invisible characters dropped. Look-alike letters are repaired by script:
a token of several scripts is spelled in one of them if every letter has a look-alike there and the
corpus vocabulary holds the result; a token wholly in another script only if all its letters have a
Latin look-alike and the Latin word is the more frequent one.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Letters of other scripts that are drawn like the Latin letter before them.
CYRILLIC = {
    "A": "А", "B": "В", "C": "С", "E": "Е", "H": "Н", "I": "ІӀ", "J": "Ј", "K": "К", "M": "М", "O": "О", "P": "Р", "Q": "Ԛ",
    "S": "Ѕ", "T": "Т", "V": "Ѵ", "W": "Ԝ", "X": "Х", "Y": "Ү", "a": "а", "c": "с", "d": "ԁ", "e": "е", "h": "һ", "i": "і",
    "j": "ј", "l": "ӏ", "o": "о", "p": "р", "q": "ԛ", "s": "ѕ", "v": "ѵ", "w": "ԝ", "x": "х", "y": "у",
    "ä": "ӓ", "ö": "ӧ", "ë": "ё", "ï": "ї", "Ä": "Ӓ", "Ö": "Ӧ", "Ë": "Ё", "Ï": "Ї",
}
GREEK = {
    "A": "Α", "B": "Β", "E": "Ε", "H": "Η", "I": "Ι", "K": "Κ", "M": "Μ", "N": "Ν", "O": "Ο", "P": "Ρ", "T": "Τ", "X": "Χ",
    "Y": "Υ", "Z": "Ζ", "a": "α", "i": "ι", "o": "ο", "p": "ρ", "u": "υ", "v": "ν", "ó": "ό", "ü": "ϋ", "Ï": "Ϊ",
}
ARMENIAN = {"O": "Օ", "S": "Տ", "U": "Ս", "L": "Լ", "h": "հ", "n": "ո", "o": "օ", "u": "ս", "q": "զ", "g": "ց"}
LISU = {
    "A": "ꓮ", "B": "ꓐ", "C": "ꓚ", "D": "ꓓ", "E": "ꓰ", "F": "ꓝ", "G": "ꓖ", "H": "ꓧ", "I": "ꓲ", "J": "ꓙ", "K": "ꓗ", "L": "ꓡ", "M": "ꓟ", "N": "ꓠ", "O": "ꓳ", "P": "ꓑ",
    "R": "ꓣ", "S": "ꓢ", "T": "ꓔ", "U": "ꓴ", "V": "ꓦ", "W": "ꓪ", "X": "ꓫ", "Y": "ꓬ", "Z": "ꓜ",
}
CHEROKEE = {
    "A": "Ꭺ", "B": "Ᏼ", "C": "Ꮯ", "D": "Ꭰ", "E": "Ꭼ", "G": "Ꮐ", "H": "Ꮋ", "J": "Ꭻ", "K": "Ꮶ", "L": "Ꮮ", "M": "Ꮇ", "P": "Ꮲ", "R": "Ꭱ", "S": "Ꮪ", "T": "Ꭲ", "V": "Ꮩ", "W": "Ꮃ",
    "Y": "Ꭹ", "Z": "Ꮓ",
}
#: Small capitals count as a script of their own: ``ᴏ`` is drawn like ``o``.
SMALL_CAPITAL = "LATIN LETTER SMALL CAPITAL "
SMALL = {ch.lower(): unicodedata.lookup(SMALL_CAPITAL + ch) for ch in "ABCDEFGHIJKLMNOPQRSTUVWYZ"}
#: Hyphens and spaces that a reader can't tell from the plain ones; invisible marks.
HYPHENS = "\u2010\u2011\ufe63\uff0d\u1806\u2043"
INVISIBLE = re.compile("[\xad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180e\u200b-\u200f\u202a-\u202e\u2060-\u2064\u2066-\u2069\ufe00-\ufe0f\ufeff]")
JOINERS = "\u200c\u200d"
#: Plain ASCII values are never changed, so only the others are looked at.
NOT_ASCII = r"[^\x00-\x7f]"
WORD = re.compile(r"[^\W\d_]+")

LATIN_OF = {other: latin for table in (CYRILLIC, GREEK, ARMENIAN, LISU, CHEROKEE, SMALL) for latin, others in table.items() for other in others}
TO_SCRIPT = {"CYRILLIC": {k: v[0] for k, v in CYRILLIC.items()}, "GREEK": GREEK, "ARMENIAN": ARMENIAN}


@lru_cache(1 << 16)
def script(ch: str) -> str:
    """The script of a letter by its character name, ``''`` of marks and others."""
    name = unicodedata.name(ch, "") if ch.isalpha() else ""
    return "SMALL" if name.startswith(SMALL_CAPITAL) else name.split(" ", 1)[0].split("-", 1)[0]


@lru_cache(1 << 16)
def folded(ch: str) -> str:
    """A wide, styled or joined form as its plain characters; signs a reader tells apart stay."""
    if ch in HYPHENS:
        return "-"
    form = unicodedata.decomposition(ch)
    kind = form[1 : form.index(">")] if form.startswith("<") else ""
    if unicodedata.category(ch) == "Zs":
        return " "
    if kind in ("wide", "narrow", "font", "noBreak") or kind == "compat" and all(c.isalpha() for c in unicodedata.normalize("NFKD", ch)):
        return unicodedata.normalize("NFKD", ch)
    return ch


def fold(value: str) -> str:
    """One form of a value, but for look-alike letters. Joiners stay where the script needs them."""

    def drop(found: re.Match) -> str:
        near = value[max(0, found.start() - 1) : found.start()] + value[found.end() : found.end() + 1]
        needs = found[0] in JOINERS and any(script(c) not in ("", "LATIN", "CYRILLIC", "GREEK", "ARMENIAN") for c in near)
        return found[0] if needs else ""

    if value.isascii():
        return value
    return unicodedata.normalize("NFC", "".join(map(folded, INVISIBLE.sub(drop, value))))


def to_latin(token: str) -> str | None:
    """The token in Latin letters, if each letter is Latin or looks like one."""
    out = []
    for ch in token:
        latin = ch if script(ch) == "LATIN" else LATIN_OF.get(ch)
        if latin is None:
            return None
        out.append(latin)
    return "".join(out)


def proposals(token: str) -> list[str]:
    """Spellings of a token in one script, the dominant script first."""
    scripts = Counter(s for s in map(script, token) if s)
    if not scripts or set(scripts) == {"LATIN"}:
        return []
    latin = to_latin(token)
    if len(scripts) == 1:
        return [latin] if latin else []
    out = []
    for name, _ in scripts.most_common():
        if name == "LATIN":
            spelled = latin
        else:
            table = TO_SCRIPT.get(name, {})
            spelled = None
            if latin or all(script(c) in (name, "LATIN") for c in token):
                letters = [c if script(c) == name else table.get(c if script(c) == "LATIN" else LATIN_OF.get(c)) for c in token]
                spelled = "".join(letters) if all(letters) else None
        if spelled:
            out.append(spelled)
    if latin and latin not in out:
        out.append(latin)
    return out


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Values in; their folded pieces in order, each token with what it may stand for."""
    for batch in batches:
        rows = []
        for value, n in zip(batch["value"], batch["n"]):
            text, end, pos = fold(value), 0, 0
            for found in WORD.finditer(text):
                if found.start() > end:
                    rows.append((value, n, pos, text[end : found.start()], None, None, False))
                options, mixed = proposals(found[0]), len({script(c) for c in found[0]} - {""}) > 1
                token = found[0].casefold()
                for rank, option in enumerate(options or [None]):
                    rows.append((value, n, pos + 1, found[0], option, token if not mixed else None, rank > 0))
                end, pos = found.end(), pos + 2
            rows.append((value, n, pos, text[end:], None, None, False))
        yield pd.DataFrame(rows, columns=["value", "n", "pos", "piece", "option", "token", "again"])


def unify(values: DataFrame, also: DataFrame | None = None) -> DataFrame:
    """``value, unified``: the one form of each distinct value of ``values`` (columns ``value``, ``n`` rows).

    ``also`` adds known words (column ``value``) to the vocabulary. Null values are left out; empty
    and long texts are treated as any other. Repairs that several spellings allow go to the dominant
    script first, then to the more frequent word.
    """
    pieces = values.where(F.col("value").isNotNull()).mapInPandas(
        _pieces, "value string, n long, pos int, piece string, option string, token string, again boolean"
    )
    words = pieces.where(F.col("token").isNotNull() & ~F.col("again")).groupBy("token").agg(F.sum("n").alias("seen"))
    if also is not None:
        known = also.select(F.explode(F.split(F.lower("value"), r"(?U)[\W\d_]+")).alias("token")).where("token != ''")
        words = words.unionByName(known.distinct().withColumn("seen", F.lit(1).cast("long"))).groupBy("token").agg(F.sum("seen").alias("seen"))
    options = pieces.where(F.col("option").isNotNull())
    own = words.withColumnsRenamed({"token": "own", "seen": "own_seen"})
    repairs = (
        options.select("piece", "option", "token", "again")
        .distinct()
        .join(words.withColumnRenamed("token", "word"), F.lower("option") == F.col("word"))
        .join(own, F.col("token") == F.col("own"), "left")
        .where(F.col("token").isNull() | (F.col("seen") > F.coalesce("own_seen", F.lit(0))))
        .groupBy("piece")
        .agg(F.min(F.struct("again", -F.col("seen"), "option"))["option"].alias("repaired"))
    )
    return (
        pieces.where(~F.col("again"))
        .join(repairs, "piece", "left")
        .groupBy("value")
        .agg(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("repaired", "piece").alias("text")))).alias("parts"))
        .select("value", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("unified"))
    )


def disguised(df: DataFrame, row: str, fields: list[str], also: DataFrame | None = None) -> DataFrame:
    """``row, field, value, unified`` of each value of ``fields`` that differs from its one form."""
    cells = df.select(
        F.col(row), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("cell")
    ).select(row, "cell.field", "cell.value")
    values = cells.where(F.col("value").isNotNull()).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    changed = unify(values, also).where(F.col("value") != F.col("unified"))
    return cells.where(F.col("value").rlike(NOT_ASCII)).join(changed, "value").select(row, "field", "value", "unified")
