"""Keyed surrogates for pieces of personal data: same type, script, letter case, format and, where known, gender.

Every piece is cut into words and numbers, and each of these goes through a keyed permutation of all
values of its pattern (a Feistel network on their numbering, walked until it lies in the domain). So
one entity has one surrogate in every document and every writing, and two entities never share one;
no table of the corpus is needed, and a document says nothing about another. :func:`clashes` checks it
on whole tables. Identity numbers keep valid dates, sex and check characters.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable
from functools import lru_cache

#: Letters that stand for each other; any other letter stays as it is.
CLASSES = ("aeiouy", "bcdfghjklmnpqrstvwxz", "àáâãäåæèéêëìíîïòóôõöøùúûüý", "çðñþ", "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "αεηιουω", "βγδζθκλμνξπρστφχψ")
CLASS_OF = {ch: (i, at) for i, letters in enumerate(CLASSES) for at, ch in enumerate(letters)}
CHUNK = 40
CHECK = "0123456789ABCDEFHJKLMNPRSTUVWXY"
DAYS, LEAP = 36525, 59  # of the years 2000 to 2099, and the place of 29 February 2000
FIRST = datetime.date(2000, 1, 1).toordinal()


def permute(n: int, size: int, key: bytes, tweak: str, alike: Callable[[int], object] | None = None) -> int:
    """The place of ``n`` in a keyed permutation of ``range(size)``; ``alike`` splits it into large parts that keep to themselves."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask, bare, part = (1 << half) - 1, hashlib.blake2b(tweak.encode("utf-8", "replace"), key=key[:64]), alike(n) if alike else None
    while True:
        left, right = n >> half, n & mask
        for step in range(6):
            mixed = bare.copy()
            mixed.update(step.to_bytes(1, "big") + right.to_bytes(half // 8 + 1, "big"))
            left, right = right, left ^ (int.from_bytes(mixed.digest(), "big") & mask)
        n = left << half | right
        if n < size and (alike is None or alike(n) == part):
            return n


@lru_cache(1 << 16)
def number(text: str, key: bytes, tweak: str) -> str:
    """Figures of the same length; the first is 0 only where it was."""
    if len(text) > CHUNK:
        return number(text[:CHUNK], key, tweak) + number(text[CHUNK:], key, tweak + text[:CHUNK])
    n, low, most = int(text), 10 ** (len(text) - 1) if len(text) > 1 else 0, 10 ** len(text)
    if n >= low:
        n = low + permute(n - low, most - low, key, f"{tweak} number {most}")
    elif n:
        n = 1 + permute(n - 1, low - 1, key, f"{tweak} zero number {most}")
    return f"{n:0{len(text)}d}"


@lru_cache(1 << 16)
def _letters(text: str, key: bytes, tweak: str) -> str:
    if len(text) > CHUNK:
        return _letters(text[:CHUNK], key, tweak) + _letters(text[CHUNK:], key, tweak + text[:CHUNK])
    places = [CLASS_OF.get(c, (c, 0)) for c in text]
    pattern, n, size = "".join(str(c) for c, _ in places), 0, 1
    for kind, at in places:
        radix = len(CLASSES[kind]) if isinstance(kind, int) else 1
        n, size = n * radix + at, size * radix
    if size == 1:
        return text
    n, out = permute(n, size, key, f"{tweak} letters {pattern}"), []
    for (kind, _), ch in zip(reversed(places), reversed(text)):
        if isinstance(kind, int):
            n, at = divmod(n, len(CLASSES[kind]))
            ch = CLASSES[kind][at]
        out.append(ch)
    return "".join(reversed(out))


def _cased(word: str, small: str) -> str:
    return "".join(s.upper() if w.isupper() else s for w, s in zip(word, small)) if len(word) == len(small) else small.upper() if word.isupper() else small.capitalize() if word[:1].isupper() else small


@lru_cache(64)
def following(names: tuple[str, ...], key: bytes) -> dict[str, str]:
    """Each name's successor in a keyed order, so that none becomes itself."""
    order = sorted(names, key=lambda n: permute(names.index(n), len(names), key, "given " + names[0]))
    return dict(zip(order, order[1:] + order[:1]))


@lru_cache(1 << 16)
def name_word(word: str, key: bytes, given: tuple[tuple[str, ...], ...]) -> str:
    """A word of a name: a listed given name becomes one of its list, which is of one gender; an initial another one."""
    small = word.lower()
    for names in given:
        if small in names:
            return _cased(word, following(names, key)[small])
    if len(word) == 1:
        return _cased(word, chr(97 + permute(ord(small) - 97, 26, key, "initial"))) if "a" <= small <= "z" else word
    if len(small) != len(word):
        return word
    while True:  # the listed names keep to themselves
        small = _letters(small, key, "name")
        if not any(small in names for names in given):
            return _cased(word, small)


def word(text: str, key: bytes, tweak: str) -> str:
    small = text.lower()
    return _cased(text, _letters(small, key, tweak)) if len(small) == len(text) else text


def _date(digits: str, year_at: int, month_at: int, day_at: int) -> int:
    y, m, d = (int(digits[i : i + 2]) for i in (year_at, month_at, day_at))
    return datetime.date(2000 + y, m, d).toordinal() - FIRST


def _person(day: int, serial: int, short: bool, key: bytes, tweak: str) -> tuple[datetime.date, int]:
    """Another day of the century and number of the same sex; a ``short`` century lacks the 29 February of its first year."""
    sex, tweak = serial % 2, f"{tweak} {serial % 2}"
    if short and day == LEAP:
        return datetime.date.fromordinal(FIRST + day), permute(serial // 2, 500, key, tweak) * 2 + sex
    days = DAYS - short
    n = permute((day - (short and day > LEAP)) * 500 + serial // 2, days * 500, key, tweak)
    day = n // 500 + (short and n // 500 >= LEAP)
    return datetime.date.fromordinal(FIRST + day), n % 500 * 2 + sex


def finnish(found: str, key: bytes) -> str:
    """Another valid date of the century, a number of the same sex, and its check character."""
    mark = found[6]
    born, serial = _person(_date(found, 4, 2, 0), int(found[7:10]), mark in "-UVWXYuvwxy+", key, "finnish")
    head = born.strftime("%d%m%y")
    return f"{head}{mark}{serial:03d}" + (str.lower if found[-1].islower() else str.upper)(CHECK[int(f"{head}{serial:03d}") % 31])


def swedish(found: str, key: bytes) -> str:
    """As :func:`finnish`, with the century as written; coordination numbers stay such."""
    date, serial = re.sub(r"\D", "", found)[:-4], int(found[-4:-1])
    ten = date[-6:]
    plus = 60 if int(ten[4:]) > 60 else 0
    day, century = _date(f"{ten[:4]}{int(ten[4:]) - plus:02d}", 0, 2, 4), date[:-6]
    born, serial = _person(day, serial, century != "20", key, f"swedish {plus}")
    nine = f"{born:%y%m}{born.day + plus:02d}{serial:03d}"
    total = sum(sum(divmod(int(c) * (2 - i % 2), 10)) for i, c in enumerate(nine))
    return f"{century}{nine[:6]}{found[len(date) : -4]}{nine[6:]}{-total % 10}"


def social(found: str, key: bytes) -> str:
    def alike(n: int) -> bool:
        area = n // 10**6
        return area in (0, 666) or area >= 900 or n // 10**4 % 100 == 0 or n % 10**4 == 0

    text = f"{permute(int(found.replace('-', '')), 10**9, key, 'social', alike):09d}"
    return f"{text[:3]}-{text[3:5]}-{text[5:]}"


def insurance(found: str, key: bytes) -> str:
    bare = found.replace(" ", "").upper()

    def letters(n: int) -> tuple[str, str, int]:
        n, last = divmod(n, 4)
        n, six = divmod(n, 10**6)
        return chr(65 + n // 26) + chr(65 + n % 26), "ABCD"[last], six

    def alike(n: int) -> bool:
        head = letters(n)[0]
        return head[0] in "DFIQUV" or head[1] in "DFIOQUV" or head in ("BG", "GB", "KN", "NK", "NT", "TN", "ZZ")

    n = (((ord(bare[0]) - 65) * 26 + ord(bare[1]) - 65) * 10**6 + int(bare[2:8])) * 4 + "ABCD".index(bare[8])
    head, last, six = letters(permute(n, 26 * 26 * 10**6 * 4, key, "insurance", alike))
    fresh = iter(f"{head}{six:06d}{last}")
    return "".join(c if c == " " else _cased(c, next(fresh).lower()) if c.isalpha() else next(fresh) for c in found)


def phone(found: str, key: bytes) -> str:
    """Other last seven figures, so that a number has one surrogate with and without its country."""
    fresh = iter(f"{permute(int(''.join(c for c in found if c.isdigit())[-7:]), 10**7, key, 'phone'):07d}")
    skip = sum(c.isdigit() for c in found) - 7
    out = []
    for c in found:
        if c.isdigit():
            skip -= 1
            c = c if skip >= 0 else next(fresh)
        out.append(c)
    return "".join(out)


def clashes(pieces):
    """``kind, surrogate, entities`` of surrogates that stand for several entities: none, whatever the table.

    ``pieces`` has ``kind, entity, surrogate_entity``; the count combines on the map side.
    """
    from pyspark.sql import functions as F

    distinct = pieces.select("kind", "entity", "surrogate_entity").distinct()
    return distinct.groupBy("kind", F.col("surrogate_entity").alias("surrogate")).agg(F.count(F.lit(1)).alias("entities")).where("entities > 1")
