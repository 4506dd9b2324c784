"""Problem 1: variant spellings of names typed by people, linked.

A typed name is read as a first name (nicknames and initials known), a trade, a legal form, and the
family name of one or two parts. Family names form a metric space: the distance of two is the sum of
the Damerau-Levenshtein distances of their parts (unrestricted, which is a metric; a swap of neighbours
is one edit), in the better order. Radius joins run in cells: the pivots are the parts that occur, and
a name lies in the cells of its own parts. Two names within radius 2 or 3 have a pair of parts at
distance 1 or less, so by the triangle inequality it is enough to replicate each name to the pivots
within 1 of its parts; the pivots near each other are found through their deletions. In a cell only distinct spellings meet, whose number a ball of that radius bounds, however
many rows they have; a tree by distance finds the exact neighbours there.

Names linked this way form families; in a family, the first names and trades tell the makers apart.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaunu.llm.lookalikes import fold
from vaunu.session import materialize, spread

RADIUS = 2
REACH = range(-RADIUS, RADIUS + 1)
#: Short forms of first names.
NICKNAMES = {
    "alexander": "alex sasha sandy", "anthony": "tony toni", "charles": "charlie chuck", "edward": "ed eddie ted ned", "elizabeth": "betty liz lizzie beth",
    "francisco": "paco pancho", "friedrich": "fritz fredi", "giuseppe": "beppe pino", "heinrich": "heiner heinz", "johannes": "hannes jussi",
    "katherine": "kate kathy katie", "margaret": "maggie peggy meg", "matthias": "matti matze", "michael": "mick mike micky", "richard": "dick rick ricky",
    "robert": "bob bobby rob robbie", "theodor": "theo", "william": "bill billy will willy", "james": "jim jimmy", "john": "jack johnny",
}
#: Trades of vehicle makers, with written-out words and short forms without a point.
TRADES = {
    "automobili": "", "caravans": "cvns", "coachworks": "cwks", "conversions": "", "fahrzeugbau": "fzgb", "karosseri": "", "motor company": "motor co",
    "reisemobile": "r mobile", "special vehicles": "spec vehicles", "trailers": "trlrs trl",
}
FORMS = [(trade, form.split()) for trade, short in TRADES.items() for form in [trade, *([short] if short in ("motor co", "r mobile", "spec vehicles") else short.split())]]
#: Legal forms, and what is typed where there is no name.
LEGAL = re.compile(r"(?<!\w)(oyj?|ab|ag|gmbh|ltd|inc|llc|kft|a/s|s\.?\s?r\.?\s?l|s\.?\s?p\.?\s?a|d\.?\s?o\.?\s?o)(?!\w)\.?")
NO_NAME = {"tuntematon", "muu merkki", "muu", "unknown", "none", "ei tiedossa", "ei merkkia", "other", "n a", "testi", "xx"}
FULL_OF = {short: full for full, shorts in NICKNAMES.items() for short in [full, *shorts.split()]}


def plain(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", fold(text).casefold()) if not unicodedata.combining(c))


def _vowels(word: str) -> str:
    """``ae``, ``oe`` and ``ue`` count as the accented vowel they may stand for."""
    return re.sub("(?<=[aou])e", "", word)


def _trade_at(words: list[tuple[str, bool]], i: int) -> tuple[str, int] | None:
    """The trade that begins at word ``i`` and how many words it takes; a word with a point may be cut short."""
    for trade, parts in FORMS:
        if parts[0][0] != words[i][0][0] or i + len(parts) > len(words):
            continue
        ok = all(word == part or dotted and len(word) >= 2 and part.startswith(word) for (word, dotted), part in zip(words[i : i + len(parts)], parts))
        if ok and (len(parts) > 1 or len(words[i][0]) >= 3):
            return trade, len(parts)
    return None


@lru_cache(1 << 16)
def read(text: str) -> tuple[str, str, str, str] | None:
    """``first, trade, a, b`` of a typed name, or None without one.

    ``first`` is a full first name, an initial or ``''``; ``a`` and ``b`` are the parts of the family
    name in alphabetical order, ``b`` is ``''`` if they are written as one word, and a part that was
    cut short keeps its point.
    """
    flat = LEGAL.sub(" ", plain(re.sub(r"(?<=[^\W\d_A-Z])(?=[A-Z][a-zß-ÿ])", "-", text) if not text.isupper() else text))
    words = [(m[1], bool(m[2])) for m in re.finditer(r"([^\W_]+)(\.?)", flat)]
    if not words or " ".join(w for w, _ in words) in NO_NAME:
        return None
    trade = ""
    for i in range(len(words)):
        found = _trade_at(words, i)
        if found:
            trade = found[0]
            del words[i : i + found[1]]
            break
    first = ""
    for i, (word, dotted) in enumerate(words):
        if len(words) > 1 and (word in FULL_OF and len(words) > 1 or len(word) == 1):
            first = FULL_OF.get(word, word)
            del words[i]
            break
    parts = [_vowels(w) + "." * d for w, d in words if not (len(words) > 2 and len(w) == 1)]
    if parts and all(p.endswith(".") for p in parts):
        parts = [p.rstrip(".") for p in parts]
    if not any(len(p) > 1 for p in parts):
        return None
    if len(parts) > 2:
        parts = [parts[0], "".join(p.rstrip(".") for p in parts[1:])]
    parts = sorted(parts)
    return first, trade, parts[0], parts[1] if len(parts) > 1 else ""


def edits(a: str, b: str, most: int) -> int:
    """Unrestricted Damerau-Levenshtein distance, ``most + 1`` if it is above ``most``."""
    if a == b:
        return 0
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return most + 1
    far = n + m
    rows = [[far] * (m + 2), [far, *range(m + 1)]]
    seen: dict[str, int] = {}
    for i in range(1, n + 1):
        x, last, above, row = a[i - 1], 0, rows[i], [far, i]
        for j in range(1, m + 1):
            k, at = seen.get(b[j - 1], 0), last
            if x == b[j - 1]:
                cost, last = above[j], j
            else:
                cost = above[j] + 1
            swap = rows[k][at] + (i - k - 1) + 1 + (j - at - 1)
            row.append(min(cost, above[j + 1] + 1, row[j] + 1, swap))
        seen[x] = i
        rows.append(row)
    return min(rows[-1][-1], most + 1)


@lru_cache(1 << 16)
def letters(text: str) -> int:
    """The set of letters in a text, a bit for each of 64 classes."""
    bits = 0
    for ch in text:
        bits |= 1 << (ord(ch) & 63)
    return bits


def _part(a: str, b: str, most: int) -> int:
    """Distance of two parts; one that was cut short is compared with as much of the other."""
    if a.endswith(".") and not b.endswith("."):
        a, b = b, a
    if b.endswith(".") and not a.endswith("."):
        cut = b[:-1]
        return edits(a[: len(cut)], cut, most) if len(cut) < len(a) else most + 1
    return edits(a, b, most)


def distance(x: tuple[str, str], y: tuple[str, str], most: int = RADIUS) -> int:
    """The distance of two family names, ``most + 1`` if it is above ``most``."""
    if x[1] and y[1]:
        straight = _part(x[0], y[0], most)
        if straight <= most:
            straight += _part(x[1], y[1], most)
        turned = _part(x[0], y[1], most)
        if turned <= most:
            turned += _part(x[1], y[0], most)
        return min(straight, turned, most + 1)
    return min(edits(x[0] + x[1], y[0] + y[1], most), edits(x[1] + x[0], y[0] + y[1], most), edits(x[0] + x[1], y[1] + y[0], most))


def _cut(name: tuple[str, str]) -> bool:
    return name[0].endswith(".") or name[1].endswith(".")


#: Names of a cell up to which comparing sets of letters costs less than a tree, and above which a cell is divided.
CELL = 256


def near(names: list[tuple[str, str]], others: list[str] | None = None) -> list[tuple[int, int, int]]:
    """All pairs ``i, j, distance`` of a cell within the radius: exact, by a tree of distances if it is large.

    A node's children are kept by their distance to it; the triangle inequality rules out those whose
    distance differs from the searched name's by more than the radius. Names that were cut short or are
    written as one word have no true distance to the others, so they are compared one by one; two that
    were cut short only count if nothing contradicts. ``others`` has the other parts of names with one in common.
    """
    out, whole = [], [i for i, n in enumerate(names) if n[1] and not _cut(n)]
    far, sets = 60, [letters(t) for t in others or [a + b for a, b in names]]

    def alike(i: int, others: list[int]) -> list[int]:
        own = sets[i]  # an edit puts at most one letter out and one in
        return [j for j in others if (own ^ sets[j]).bit_count() <= 2 * RADIUS]

    if len(whole) <= CELL:
        for k, i in enumerate(whole):
            out += [(i, j, d) for j in alike(i, whole[:k]) if (d := distance(names[i], names[j])) <= RADIUS]
    else:
        children: dict[int, dict[int, int]] = {whole[0]: {}}
        for i in whole[1:]:
            at = whole[0]
            while True:
                d = distance(names[i], names[at], far)
                below = children[at].get(d)
                if below is None:
                    break
                at = below
            place, todo = (at, d), [whole[0]]
            while todo:
                at = todo.pop()
                d = distance(names[i], names[at], far)
                if d <= RADIUS:
                    out.append((i, at, d))
                todo += [c for e, c in children[at].items() if abs(e - d) <= RADIUS]
            children[place[0]][place[1]] = i
            children[i] = {}
    joined = [i for i, n in enumerate(names) if not n[1] and not _cut(n)]
    for k, i in enumerate(joined):
        out += [(i, j, d) for j in alike(i, [*whole, *joined[:k]]) if (d := distance(names[i], names[j])) <= RADIUS]
    cut = [i for i, n in enumerate(names) if _cut(n)]
    for k, i in enumerate(cut):
        full = [*whole, *joined]
        if others:
            size, own = len(others[i]) - 1, letters(others[i][:-1])
            full = [j for j in whole if (own ^ letters(others[j][:size])).bit_count() <= 2 * RADIUS]
        out += [(i, j, d) for j in full if (d := distance(names[i], names[j])) <= RADIUS]
        out += [(i, j, 0) for j in cut[:k] if distance(names[i], names[j], 0) == 0]
    return out


def within_one(a: str, b: str) -> bool:
    """``edits(a, b, 1) <= 1``, without a table."""
    if a == b:
        return True
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    if len(a) < len(b):
        return a[i:] == b[i + 1 :]
    return a[i + 1 :] == b[i + 1 :] or a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :]


def visits(home: list[tuple[str, str, str]], guests: list[tuple[str, str, str]]) -> list[tuple[int, int, int]]:
    """``guest, home, distance`` of those within the radius; both are ``a, b, other``.

    ``other`` is the part that did not lead to the cell. A guest's leading part is at distance 1 to the
    pivot, which is the leading part of those at home, so the other parts are at distance 1 at most.
    """
    out, sets = [], [letters(o) for _, _, o in home]
    for i, (a, b, other) in enumerate(guests):
        if other.endswith("."):
            most, half = len(other) - 1, (len(other) - 1) // 2
            left, right = other[:half], other[half + 1 : most]  # an edit or a swap that keeps the length spares one of them
            fits = [j for j, (_, _, o) in enumerate(home) if (o[:half] == left or o[half + 1 : most] == right) and within_one(o[:most], other[:most])]
        else:
            own = letters(other)
            fits = [j for j, s in enumerate(sets) if (own ^ s).bit_count() <= 2 and within_one(other, home[j][2])]
        out += [(i, j, d) for j in fits if (d := distance((a, b), home[j][:2])) <= RADIUS]
    return out


LINKS = "x string, y string, d int, y_rows long, x_cut boolean, y_cut boolean"


def _cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by cell in; the links of each cell out. A cell may go on in the next batch."""
    at, cell = None, []

    def links() -> list[tuple]:
        home = [m for m in cell if not m[5]]
        out = []
        if len(home) > 1:
            out += [(home[i], home[j], d) for i, j, d in near([m[1:3] for m in home], [m[3] for m in home])]
        whole = [m for m in home if m[2] and not _cut(m[1:3])]
        guests = [m for m in cell if m[5]]
        if whole and guests:
            paired = [m for m in guests if m[2]]
            out += [(paired[i], whole[j], d) for i, j, d in visits([m[1:4] for m in whole], [m[1:4] for m in paired])]
        for m in guests:
            if not m[2]:  # one word: it has a distance to all at home
                own = letters(m[1])
                alike = [h for h in home if (own ^ letters(h[1] + h[2])).bit_count() <= 2 * RADIUS]
                out += [(h, m, d) if _cut(h[1:3]) else (m, h, d) for h in alike if (d := distance(m[1:3], h[1:3])) <= RADIUS]
        return [(x[0], y[0], d, y[4], _cut(x[1:3]), _cut(y[1:3])) for x, y, d in out if x[0] != y[0]]

    for batch in batches:
        out: list[tuple] = []
        for c, *member in zip(batch["cell"], batch["name"], batch["a"], batch["b"], batch["other"], batch["n"], batch["guest"]):
            if c != at:
                if len(cell) > 1:
                    out += links()
                at, cell = c, []
            cell.append(tuple(member))
        yield pd.DataFrame(out, columns=["x", "y", "d", "y_rows", "x_cut", "y_cut"])
    yield pd.DataFrame(links() if len(cell) > 1 else [], columns=["x", "y", "d", "y_rows", "x_cut", "y_cut"])


def _compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of names in; those within the radius out, two that were cut short only without a contradiction."""
    for batch in batches:
        out = []
        for x, xa, xb, y, ya, yb, n in zip(*(batch[c] for c in ("x", "xa", "xb", "y", "ya", "yb", "n"))):
            cut = _cut((xa, xb)), _cut((ya, yb))
            most = 0 if all(cut) else RADIUS
            if (d := distance((xa, xb), (ya, yb), most)) <= most:
                out.append((x, y, d, n, *cut))
        yield pd.DataFrame(out, columns=["x", "y", "d", "y_rows", "x_cut", "y_cut"])


def _stretches(text: Column, reach: range) -> Column:
    """Strings of which one of ``reach`` 0 is shared by any text at most ``RADIUS`` edits away among its own of reach ``-RADIUS`` to ``RADIUS``.

    Of three stretches of a text, a letter apart, so many edits leave one whole, moved by as many letters.
    """
    size, out = F.length(text), []
    for longer in reach:
        m = size + longer
        g = F.greatest(F.floor((m - 2) / 3), F.lit(0)).cast("int")
        starts = [("a", F.lit(1)), ("c", F.greatest(size - g + 1, F.lit(1))), *[("b", F.greatest(g + 2 + s, F.lit(1))) for s in reach]]
        out += [F.concat(m.cast("string"), F.lit(sign), F.substring(text, at, g)) for sign, at in starts]
    return F.array_distinct(F.array(*out))


#: Letters up to which all ways to leave two out are few enough.
FEW = 24


def shorter(text: str) -> set[str]:
    """A text and all that it becomes without one of its letters: texts one edit apart share one, which costs either a letter at most."""
    return {text, *(text[:i] + text[i + 1 :] for i in range(len(text)))}


def _keyed(parts: DataFrame) -> DataFrame:
    """``part, key`` with the keys of :func:`shorter`."""

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                yield pd.DataFrame([(p, k) for p in batch["part"][at : at + 1000] for k in shorter(p)], columns=["part", "key"])

    return parts.mapInPandas(keys, "part string, key string")


def _close(wanted: DataFrame, known: DataFrame) -> DataFrame:
    """``part, pivot``: for each wanted part the pivots at distance 1, found by the keys that they share."""
    pivots = _keyed(known).withColumnRenamed("part", "pivot")
    one = (F.levenshtein("part", "pivot", 1) >= 0) | (F.array_sort(F.split("part", "")) == F.array_sort(F.split("pivot", "")))
    return _keyed(wanted).join(pivots, "key").where((F.col("part") != F.col("pivot")) & one).select("part", "pivot").distinct()


def _keys(text: Column, edits_apart: int) -> Column:
    """Strings of which two texts share one if they are that many edits apart.

    For two edits long texts have stretches instead, and those about as long as ``FEW`` have both.
    """
    once = F.udf(lambda t: sorted(shorter(t)), "array<string>")
    twice = F.udf(lambda t: sorted({k for s in shorter(t) for k in shorter(s)}) if len(t) <= FEW else [], "array<string>")
    if edits_apart == 1:
        return once(text)
    long = F.when(F.length(text) >= FEW - RADIUS, _stretches(text, REACH)).otherwise(F.array().cast("array<string>"))
    return F.concat(twice(text), long)


MEMBER = ["name", "a", "b", "other", "n"]


def _members(names: DataFrame) -> DataFrame:
    """``part`` and the columns of ``MEMBER`` for each part of the names of two parts that was not cut short."""
    sides = [F.struct(F.col(p).alias("part"), F.col(o).alias("other")) for p, o in (("a", "b"), ("b", "a"))]
    two = names.where("b != ''").select("name", "a", "b", "n", F.explode(F.array_distinct(F.array(*sides))).alias("side"))
    return two.select("side.part", "name", "a", "b", "side.other", "n").where("not endswith(part, '.')")


def _pieces(names: DataFrame, longest: int) -> DataFrame:
    """``part`` and ``MEMBER`` for the pieces of names in one word, at each place where it may be two parts.

    Two letters swapped across that place are swapped back as well. No part has more than ``longest`` letters.
    """
    size, most = F.length("a"), longest + 1
    places = F.filter(F.sequence(F.greatest(size - most, F.lit(1)), F.greatest(F.least(size - 1, F.lit(most)), size - most, F.lit(1))), lambda s: (s < size) & (s <= most))
    swapped = lambda s: F.concat(F.substring("a", F.lit(1), s - 1), F.substring("a", s + 1, F.lit(1)), F.substring("a", s, F.lit(1)), F.substring("a", s + 2, size))
    cuts = lambda t, s: F.array(F.substring(t, F.lit(1), s), F.substring(t, s + 1, size))
    parts = F.flatten(F.transform(places, lambda s: F.concat(cuts(F.col("a"), s), cuts(swapped(s), s))))
    one = names.where("b = '' and not endswith(a, '.')")
    return one.select(F.explode(F.array_distinct(parts)).alias("part"), "name", "a", "b", F.lit(None).cast("string").alias("other"), "n")


def _placed(names: DataFrame) -> DataFrame:
    """``cell, guest`` and the columns of ``MEMBER``.

    A name is at home in the cells of its own parts, and a guest of the pivots at distance 1 of one of
    them. Two names within the radius either have a part in common and meet at home, or have two pairs of
    parts at distance 1, and then it is enough that either is a guest by one part, the longer, which has
    fewer near. A cell of more than ``CELL`` names is divided: by strings that other parts within reach
    share, and for names without a true distance into shares.
    """
    members = materialize(_members(names))
    known = members.select("part").distinct()
    longest = members.agg(F.max(F.length("part")).alias("most")).first()["most"] or 0
    pieces = _pieces(names, longest)
    guests = members.where("endswith(other, '.') or length(part) > length(other) or length(part) = length(other) and part >= other").unionByName(pieces)
    guests = materialize(guests)
    near_by = _close(guests.select("part").distinct(), known)
    one_word = guests.where("b = ''").join(known, "part", "left_semi")
    away = guests.join(near_by, "part").select(F.col("pivot").alias("part"), *MEMBER).unionByName(one_word).withColumn("guest", F.lit(True))
    sizes = members.groupBy("part").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > CELL)
    every = materialize(members.withColumn("guest", F.lit(False)).unionByName(away))
    hot = materialize(sizes.withColumn("shares", F.ceil(F.col("size") / CELL)).select("part", "shares"))
    if hot.isEmpty():
        return every.withColumnRenamed("part", "cell")
    calm = every.join(hot, "part", "left_anti").withColumnRenamed("part", "cell")
    crowd = every.join(hot, "part")
    exact = "b != '' and not endswith(other, '.')"
    shared = crowd.where(exact).withColumn("key", F.explode(F.when(F.col("guest"), _keys(F.col("other"), 1)).otherwise(_keys(F.col("other"), 2))))
    own = F.array(F.pmod(F.xxhash64("name"), F.col("shares")))
    spread_out = crowd.where(f"not guest or not ({exact})").withColumn("key", F.explode(F.when(F.expr(exact), own).otherwise(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1))))
    split = [d.withColumn("cell", F.concat_ws(sign, "part", "key")).select(calm.columns) for d, sign in ((shared, "|"), (spread_out, "#"))]
    return calm.unionByName(split[0]).unionByName(split[1])


def _one_word(names: DataFrame) -> DataFrame:
    """Candidates among names in one word."""
    one = names.where("b = '' and not endswith(a, '.')")
    home = one.select(F.col("name").alias("y"), F.col("a").alias("ya"), F.col("b").alias("yb"), "n", F.explode(_stretches(F.col("a"), range(1))).alias("key"))
    probe = one.select(F.col("name").alias("x"), F.col("a").alias("xa"), F.col("b").alias("xb"), F.explode(_stretches(F.col("a"), REACH)).alias("key"))
    near_by = probe.join(home, "key").where((F.col("x") < F.col("y")) & (F.levenshtein("xa", "ya", 2 * RADIUS) >= 0))
    return near_by.select("x", "xa", "xb", "y", "ya", "yb", "n").distinct()


def _both_cut(names: DataFrame) -> DataFrame:
    """Candidates among names cut short in different parts, which share no whole part: by how both parts begin."""
    bare = [F.replace(p, F.lit("."), F.lit("")) for p in ("a", "b")]
    cut = names.where("endswith(a, '.') or endswith(b, '.')")
    sizes = [F.sequence(F.lit(1), F.least(F.length(p), F.lit(3))) for p in bare]
    pair = lambda i, j: F.array_sort(F.array(F.substring(bare[0], F.lit(1), i), F.substring(bare[1], F.lit(1), j)))
    begins = F.array_distinct(F.flatten(F.transform(sizes[0], lambda i: F.transform(sizes[1], lambda j: pair(i, j)))))
    home = cut.select(F.col("name").alias("y"), F.col("a").alias("ya"), F.col("b").alias("yb"), "n", pair(F.lit(3), F.lit(3)).alias("key"))
    probe = cut.select(F.col("name").alias("x"), F.col("a").alias("xa"), F.col("b").alias("xb"), F.explode(begins).alias("key"))
    return probe.join(home, "key").where("x != y").select("x", "xa", "xb", "y", "ya", "yb", "n").distinct()


def _two_apart(names: DataFrame, links: DataFrame) -> DataFrame:
    """Candidates of names cut short that have no whole name within 1: those with their beginning whose other part is 2 edits away."""
    placed = links.where("x_cut and not y_cut and d < 2").select(F.col("x").alias("name"))
    members = _members(names)
    lost = members.where("endswith(other, '.')").join(placed, "name", "left_anti")
    lost = materialize(lost.withColumn("begin", F.expr("substring(other, 1, length(other) - 1)")).withColumn("size", F.least(F.length("begin"), F.lit(4))))
    sizes = [r["size"] for r in lost.select("size").distinct().collect()]  # 1 to 4
    probe = lost.select(F.col("name").alias("x"), F.col("a").alias("xa"), F.col("b").alias("xb"), "part", "begin", F.expr("substring(begin, 1, 4)").alias("key"))
    starts = F.explode(F.array_distinct(F.array(*[F.substring("other", 1, n) for n in sizes] or [F.lit("")])))
    home = members.where("not endswith(other, '.')").select(F.col("name").alias("y"), F.col("a").alias("ya"), F.col("b").alias("yb"), "n", F.col("part").alias("pivot"), "other", starts.alias("key"))
    reach = (F.abs(F.length("part") - F.length("pivot")) <= RADIUS) & (F.levenshtein("part", "pivot", 2 * RADIUS) >= 0)
    return probe.join(home, "key").where("startswith(other, begin)").where(reach).select("x", "xa", "xb", "y", "ya", "yb", "n").distinct()


def linked(names: DataFrame) -> DataFrame:
    """``x, y, d, y_rows, x_cut, y_cut``: all pairs of the distinct ``name, a, b, n`` within the radius."""
    shape = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = _placed(names).select("cell", *MEMBER, "guest").repartition(shape, "cell").sortWithinPartitions("cell", "name")
    met = materialize(cells.mapInPandas(_cells, LINKS))
    pairs = _one_word(names).unionByName(_both_cut(names)).unionByName(_two_apart(names, met))
    return met.unionByName(pairs.mapInPandas(_compared, LINKS)).distinct()


def _families(names: DataFrame, links: DataFrame) -> DataFrame:
    """``name, family``: the smallest name that links lead to.

    Names that were cut short join their nearest whole name only; those without any join each other.
    """
    best = links.where("x_cut and not y_cut").groupBy("x").agg(F.min(F.struct("d", -F.col("y_rows"), "y"))["y"].alias("y"))
    best = materialize(best)
    stranded = links.where("x_cut and y_cut").select("x", "y").join(best.select("x"), "x", "left_anti").join(best.select(F.col("x").alias("y")), "y", "left_anti")
    firm = links.where("not x_cut").select("x", "y").unionByName(stranded.select("x", "y"))
    edges = materialize(firm.unionByName(firm.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    labels = materialize(names.select("name", F.col("name").alias("family")))
    while True:
        seen = edges.join(labels.withColumnRenamed("name", "y"), "y").groupBy("x").agg(F.min("family").alias("least"))
        hooked = labels.join(seen, labels.name == seen.x, "left").select("name", "family", F.least("family", F.coalesce("least", "family")).alias("new"))
        hooked = materialize(hooked)
        if hooked.where("new != family").isEmpty():
            break
        up = hooked.select(F.col("name").alias("up"), F.col("new").alias("above"))
        labels = materialize(hooked.join(up, F.col("new") == F.col("up")).select("name", F.col("above").alias("family")))
    leaves = best.join(labels.withColumnRenamed("name", "y"), "y").select("x", F.col("family").alias("joined"))
    return labels.join(leaves, labels.name == leaves.x, "left").select("name", F.coalesce("joined", "family").alias("family"))


def _agree(a: str, b: str) -> bool:
    return not a or not b or a == b or min(len(a), len(b)) == 1 and a[0] == b[0]


def tell_apart(found: list[tuple[str, str, int]]) -> list[int]:
    """The maker, as a number within its family, of each ``first, trade, rows``.

    The most explicit come first; one that leaves something open joins the maker that it agrees with
    and that has most rows. Initials agree with the names they begin.
    """
    order = sorted(range(len(found)), key=lambda i: (-((len(found[i][0]) > 1) * 2 + (found[i][1] != "") * 2 + (len(found[i][0]) == 1)), -found[i][2], found[i]))
    makers: list[list] = []
    out = [0] * len(found)
    for i in order:
        first, trade, n = found[i]
        fits = [m for m in range(len(makers)) if _agree(makers[m][0], first) and _agree(makers[m][1], trade) and (not trade or not makers[m][1] or trade == makers[m][1])]
        if fits:
            m = max(fits, key=lambda m: (makers[m][2], -m))
            makers[m] = [max(makers[m][0], first, key=len), makers[m][1] or trade, makers[m][2] + n]
        else:
            m = len(makers)
            makers.append([first, trade, n])
        out[i] = m
    return out


def _makers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for family, found in zip(batch["family"], batch["found"]):
            each = [(f["first"], f["trade"], int(f["n"])) for f in found]
            rows += [(family, f, t, m) for (f, t, _), m in zip(each, tell_apart(each))]
        yield pd.DataFrame(rows, columns=["family", "first", "trade", "maker"])


def makers(entries: DataFrame, row: str = "entry_id", text: str = "brand") -> DataFrame:
    """``row, family, maker``: entries that name the same maker agree in the last two.

    Entries without a name (null, blank, placeholders) are left out. Very long texts are read whole;
    such a name is near others only if it differs by as few letters. An empty table gives no rows.
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(i, *r) for i, t in zip(batch["row"], batch["text"]) if (r := read(t))]
            yield pd.DataFrame(rows, columns=["row", "first", "trade", "a", "b"])

    slim = entries.select(F.col(row).cast("long").alias("row"), F.col(text).alias("text")).where(F.trim("text") != "")
    read_rows = spread(slim, "row").mapInPandas(parse, "row long, first string, trade string, a string, b string")
    read_rows = materialize(read_rows.withColumn("name", F.concat_ws("-", "a", "b")))
    names = materialize(read_rows.groupBy("name", "a", "b").agg(F.count(F.lit(1)).alias("n")))
    families = materialize(_families(names.select("name"), materialize(linked(names))))
    placed = read_rows.join(families, "name").select("row", "family", "first", "trade")
    kinds = placed.groupBy("family", "first", "trade").agg(F.count(F.lit(1)).alias("n"))
    # a family has few first names and trades, however many rows
    found = kinds.groupBy("family").agg(F.collect_list(F.struct("first", "trade", "n")).alias("found"))
    told = found.mapInPandas(_makers, "family string, first string, trade string, maker int")
    return placed.join(told, ["family", "first", "trade"]).select(F.col("row").alias(row), "family", "maker")


#: Rows of a maker that one task pairs with a share of its rows.
SHARE = 2048


def same_maker_pairs(entries: DataFrame, row: str = "entry_id", text: str = "brand") -> DataFrame:
    """``entry_a, entry_b``: all pairs of rows that name the same maker, ``entry_a < entry_b``.

    A maker of many rows is salted: one side lies in shares of about ``SHARE`` rows, the other goes to each.
    """
    known = materialize(makers(entries, row, text))
    maker = ["family", "maker"]
    sizes = known.groupBy(*maker).agg(F.count(F.lit(1)).alias("n"))
    hot = materialize(sizes.where(F.col("n") > SHARE).select(*maker, F.ceil(F.col("n") / SHARE).alias("shares")))
    shared = known.join(hot, maker, "left").withColumn("shares", F.coalesce("shares", F.lit(1).cast("long")))
    a = shared.select(F.col(row).alias("entry_a"), *maker, F.pmod(F.xxhash64(row), F.col("shares")).alias("share"))
    b = shared.select(F.col(row).alias("entry_b"), *maker, F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share"))
    return a.join(b, [*maker, "share"]).where("entry_a < entry_b").select("entry_a", "entry_b")
