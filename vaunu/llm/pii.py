"""Problem 10: personal information inside free text, found and replaced.

Patterns find emails (plain or disguised), identity numbers (dates and check digits verified), phone
numbers, street addresses and names; later kinds only look where earlier ones found nothing. A name
is a given name beside a family name, an initial before one, or two capitalised words where the text
itself presents a person: after a cue (``Terveisin``, ``Mr``), beside an email address that holds both
words, or directly beside a phone or identity number. Given names are those listed and those the
corpus teaches (:func:`lexicon`): words that stand first after cues. A word that distinct texts mostly
use elsewhere than in such places is no family name, unless a cue stands before it; how often a name
is repeated never counts against it, and no count is compared with the size of the corpus.

Replacement is by typed placeholders that number the entities of a document, or by surrogates
(:mod:`vaunu.llm.surrogates`): keyed values of the same type, script, letter case, format and gender,
one for an entity in all documents, and none for two entities.
"""

from __future__ import annotations

import datetime
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaunu.llm import surrogates
from vaunu.session import materialize

UP, LOW = "A-ZÀ-ÖØ-Þ", "a-zß-öø-ÿ"
#: Given names by gender, and words before a name.
WOMEN = (
    "Aino Alice Anna Birgit Clara Elsa Emma Greta Harriet Helmi Ingrid Karin Liisa Märta Päivi Saara Sofia Ute Venla Maria Eva Kaisa Johanna Hanna Laura "
    "Sari Tiina Minna Anneli Kristina Astrid Sigrid Linnea Ulla Inga Petra Sabine Monika Ursula Heike Claudia Julia Lena Mary Emily Jane Sarah Charlotte Olivia"
).split()
MEN = (
    "Anders Brian Daniel Dieter Eero George Gustav Hans Jörg Jürgen Kaarlo Lars Nils Oliver Otso Pekka Tuomas Väinö Wolfgang Mikko Juha Matti Antti Jari Timo "
    "Kari Heikki Erik Johan Karl Per Sven Olof Björn Peter Thomas Klaus Uwe Stefan Heinz Werner Michael David James John William Robert Harry Jack"
).split()
BEFORE = (
    "Terveisin Regards Hälsningar Gruß Grüße Kysy Mr Mrs Ms Miss Dr Frau Herr Fru Herra Rouva Asian Handled Ask Bearbeitet Vorbesitzer Mail Tel Call Hei Hi Moi "
    "Hej Hallo Dear Ystävällisin Mvh Yhteys Edellinen Förra The"
).split()
CUES = (
    r"Terveisin|Regards,|Hälsningar|Gruß,|Grüße,|Kysy:|Asian hoiti|Handled by|Ask for|owner was|omistaja oli|ägaren var|Vorbesitzer war|Bearbeitet von|sköttes av|"
    r"Mr|Mrs|Ms|Frau|Herr"
)
#: Words that present a person in other languages or forms of address; these don't overrule the corpus.
PRESENTS = (
    r"Best regards|Kind regards|Warm regards|Sincerely|Yours truly|Yours faithfully|Many thanks|Mit freundlichen Grüßen|Med vänliga hälsningar|Ystävällisin terveisin|"
    r"Cordialement|Saludos|Cordiali saluti|[Mm]y name is|[Nn]imeni on|[Ii]ch heiße|[Mm]ein Name ist|[Jj]ag heter|[Mm]itt namn är|[Jj]e m'appelle|[Mm]e llamo|[Mm]i chiamo|"
    r"Dr\.?|Prof\.?|Sir|Mr\.|Mrs\.|Ms\.|Mme|Mlle|Monsieur|Madame|Señora?|Signora?|Sr\.|Sra\.|Customer|Asiakas|Kunde|Owner|Omistaja|Ägare|Halter|Seller|Myyjä|Säljare|Verkäufer|"
    r"Driver|Kuljettaja|Signed|Allekirjoitti|Contact person|Yhteyshenkilö|Kontaktperson|Ansprechpartner"
)
#: How streets end or begin.
STREETS = "katu|tie|polku|kuja|raitti|kaari|väylä|gatan|vägen|gränd|stigen|straße|strasse|str\\.|weg|gasse|allee|platz"
ROADS = "Street|Road|Avenue|Lane|Close|Drive|Way|Terrace|Court|Place|Rise|Hill|Gardens|Walk|Crescent|Square|Row|Mews|Grove|Green|View|St|Rd|Ave|Ln"

AT = r"(?:@| ?[(\[{] ?at ?[)\]}] ?)"
DOT = r"(?:\.| ?[(\[{] ?dot ?[)\]}] ?)"
# possessive quantifiers and the look-behinds keep the patterns linear in very long texts
EMAIL = re.compile(rf"(?<![\w%+'-])[\w%+'-]++(?:{DOT}[\w%+'-]++)*+{AT}[\w-]++(?:{DOT}[\w-]++)++", re.I)
FINNISH = re.compile(r"(?<![\w*/.-])(\d{6})([-+A-FU-Y])(\d{3})([0-9A-FHJ-NPR-Y])(?![\w*]|[-/]\d)", re.I)
SWEDISH = re.compile(r"(?<![\w*/.-])((?:19|20)?\d{6})([-+]?)(\d{4})(?![\w*]|[-/]\d)")
SOCIAL = re.compile(r"(?<![\w*/.-])\d{3}-\d{2}-\d{4}(?![\w*]|[-/]\d)")
INSURANCE = re.compile(r"(?<![\w*/.-])[A-Za-z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-Da-d](?!\w)")
PHONE = re.compile(
    r"(?<![\w*/.+-])(?:"
    r"(?:\+|00)[1-9]\d{0,2}(?:[ .-]{0,3}\(0?\d{1,4}\))?(?:(?:[ .-]{0,3}|/)\d{2,}+){1,5}"
    r"|\(0?\d{2,4}\)(?:(?:[ .-]{0,3}|/)\d{2,}+){1,4}"
    r"|0\d{1,4}(?:(?: ?[.-] ?| |/)\d{2,}+){1,4}"
    r"|0\d{8,10}"
    r"|[2-9]\d{2}([.-])\d{3}\1\d{4}"
    r")(?![\w*]|[-/]\d)"
)
FLAT = r"(?:,? (?:as\.|lgh|Wohnung|Whg\.?|flat|apt\.?) ?\d{1,4}| [A-H] ?\d{1,3}(?!\d)| [A-H](?= *(?:[,;|/\t\r\n]|\.?$)))"
HOUSE = rf"\d{{1,4}}[a-zA-Z]?(?:/\d{{1,3}}[a-z]?)?{FLAT}?(?!\w)"
ADDRESS = re.compile(
    rf"(?<![\w-])(?:(?:(?:An der|An den|Am|Auf der|Auf dem|Zum|Zur|Im|In der) [{UP}][\w-]+|[{UP}][\w-]*(?i:{STREETS})|[{UP}][{LOW}-]+ (?:Straße|Allee|Weg|Gasse|katu|tie)) {HOUSE}"
    rf"|(?:Flat \d{{1,4}}[A-Za-z]?,? )?(?:\d{{1,4}}/)?\d{{1,4}}[A-Za-z]? (?:[{UP}][\w'-]+ ){{1,3}}(?:{ROADS})(?![\w]))"
)
FAMILY = rf"[{UP}][{LOW}]+(?:-[{UP}][{LOW}]+)?|[{UP}]{{3,}}(?:-[{UP}]{{2,}})?"
_given = "|".join(sorted({*WOMEN, *MEN}, key=len, reverse=True))
GIVEN = re.compile(rf"(?<![\w@.+-])(?:(?:{_given})(?:-(?:{_given}))?|(?:{_given.upper()})(?:-(?:{_given.upper()}))?)(?![\w@+])")
AFTER = re.compile(rf" (?:[{UP}]\. )?({FAMILY})(?![\w@])")
LEFT = re.compile(rf"(?<![\w@.-])({FAMILY})(,?) $")
INITIAL = re.compile(rf"(?<![\w@.-])[{UP}]\. ?({FAMILY})(?![\w@])")
CUED = re.compile(rf"(?<!\w)(?:{CUES}) ({FAMILY}),? ({FAMILY})(?![\w@])")
PRESENTED = re.compile(rf"(?=[A-ZÄmnij])(?<!\w)(?:{PRESENTS})[,:]?\s{{1,3}}({FAMILY}),? (?:[{UP}]\. )?({FAMILY})(?![\w@])")
PAIR = re.compile(rf"(?=[{UP}])(?<![\w@.+-])(?=({FAMILY})(,?) (?:[{UP}]\. )?({FAMILY})(?![\w@]))")
#: What may stand between a name and the number beside it.
BESIDE = re.compile(r"[ \t]*[,:;|/(\[–-]?[ \t]*(?:(?:puh|tel|phone|ph|mob|Puh|Tel|Phone|Mob|hetu|pnr)\b[.:]?[ \t]*)?")
CUE = re.compile(rf"(?<!\w)(?:{CUES}) $")
LONGEST_CUE = 1 + max(map(len, CUES.split("|")))
CAPITAL = re.compile(rf"(?<![\w-])[{UP}][\w]+(?:-[{UP}]\w+)?")


def _is_date(day: int, month: int, year: int) -> bool:
    try:
        datetime.date(year, month, day)
        return True
    except ValueError:
        return False


def is_finnish(date: str, number: str, check: str) -> bool:
    d, m, y = int(date[:2]), int(date[2:4]), int(date[4:])
    return _is_date(d, m, 2000 + y) and "0123456789ABCDEFHJKLMNPRSTUVWXY"[int(date + number) % 31] == check


def is_swedish(date: str, number: str) -> bool:
    ten = date[-6:] + number
    total = sum(sum(divmod(int(c) * (2 - i % 2), 10)) for i, c in enumerate(ten))
    day = int(ten[4:6])
    return total % 10 == 0 and _is_date(day - 60 if day > 60 else day, int(ten[2:4]), 2000 + int(ten[:2]))


def _digits(text: str) -> str:
    return re.sub(r"\D", "", text)


def find(text: str, common: frozenset[str] = frozenset(), given: frozenset[str] = frozenset()) -> list[tuple[int, int, str]]:
    """``start, end, kind`` of each piece of personal data, in order, without overlaps.

    ``common`` are words that are no family names, ``given`` further given names, both in the writing of the text.
    """
    spans: list[tuple[int, int, str]] = []
    rest = text

    def take(start: int, end: int, kind: str) -> None:
        nonlocal rest
        spans.append((start, end, kind))
        rest = rest[:start] + "\x00" * (end - start) + rest[end:]

    for m in EMAIL.finditer(rest):
        take(m.start(), m.end(), "email")
    for m in FINNISH.finditer(rest):
        if is_finnish(m[1], m[3], m[4].upper()):
            take(m.start(), m.end(), "identity")
    for m in SWEDISH.finditer(rest):
        if (m[2] or len(m[1]) == 8) and is_swedish(m[1], m[3]):
            take(m.start(), m.end(), "identity")
    for pattern in (SOCIAL, INSURANCE):
        for m in pattern.finditer(rest):
            take(m.start(), m.end(), "identity")
    for m in PHONE.finditer(rest):
        if 9 <= len(_digits(m[0])) <= 15:
            take(m.start(), m.end(), "phone")
    for m in ADDRESS.finditer(rest):
        take(m.start(), m.end(), "address")
    contacts = [(a, b, kind) for a, b, kind in spans if kind != "address"]

    def family(word: str, cued: bool = False) -> bool:
        return len(word) >= 3 and word.capitalize() not in _GIVEN_SET and (cued or word not in common) and word not in _BEFORE_SET

    def is_cued(start: int) -> bool:
        return CUE.search(rest, max(0, start - LONGEST_CUE), start) is not None

    for m in GIVEN.finditer(rest):
        if "\x00" in rest[m.start() : m.end()]:
            continue
        line = rest.rfind("\n", 0, m.start()) + 1
        left = LEFT.search(rest, _back(rest, m.start(), line), m.start())
        right = AFTER.match(rest, m.end())
        if left and not (family(left[1], left[2] != "" and is_cued(left.start())) and (left[1].isupper() == m[0].isupper())):
            left = None
        if right and not (family(right[1], is_cued(m.start())) and (right[1].isupper() == m[0].isupper())):
            right = None
        if left and (left[2] or not right):
            take(left.start(), m.end(), "name")
        elif right:
            take(m.start(), right.end(), "name")
    for m in INITIAL.finditer(rest):
        if family(m[1], is_cued(m.start())):
            take(m.start(), m.end(), "name")
    for m in CUED.finditer(rest):
        if family(m[1], True) and family(m[2], True):
            take(m.start(1), m.end(2), "name")
    for m in PRESENTED.finditer(rest):
        if family(m[1]) and family(m[2]):
            take(m.start(1), m.end(2), "name")
    if given or contacts:
        starts = {a: kind for a, _, kind in contacts}
        mails = [re.sub(r"[^a-z]", "", _ascii(re.split(AT, text[a:b])[0])) for a, b, kind in contacts if kind == "email"]
        for m in PAIR.finditer(rest):
            one, comma, two, end = m[1], m[2], m[3], m.end(3)
            if "\x00" in rest[m.start() : end] or one.isupper() != two.isupper():
                continue
            if not comma and one in given and family(two) or comma and two in given and family(one):
                take(m.start(), end, "name")
            elif family(one) and family(two):
                begins = BESIDE.match(rest, end).end()
                beside = starts.get(begins) in ("phone", "identity") and begins > end
                named = any(_ascii(one) in mail and _ascii(two) in mail for mail in mails)
                if beside or named:
                    take(m.start(), end, "name")
    return sorted(spans)


def _back(text: str, start: int, line: int) -> int:
    """The beginning of the two words before ``start``, in its line."""
    at = text.rfind(" ", line, max(line, start - 1))
    return max(line, text.rfind(" ", line, max(line, at)) if at > line else line)


def _ascii(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", word.lower()) if not unicodedata.combining(c))


_GIVEN_SET = frozenset([*WOMEN, *MEN])
_BEFORE_SET = frozenset([*BEFORE, *(w.upper() for w in BEFORE)])


def _is_given(word: str) -> bool:
    parts = word.split("-")
    return all(p in _GIVEN_SET for p in parts) or all(p in _UPPER_SET for p in parts)


_UPPER_SET = frozenset(w.upper() for w in _GIVEN_SET)
_FAMILY = re.compile(FAMILY)
_LINK = re.compile(rf" (?:[{UP}]\. )?|, ")
_INITIAL_BEFORE = re.compile(rf"(?<![\w@.-])[{UP}]\. ?$")
_PRESENTS_BEFORE = re.compile(rf"(?<!\w)(?:{PRESENTS})[,:]?\s{{1,3}}$")
_LONGEST = 4 + max(map(len, f"{CUES}|{PRESENTS}".split("|")))


def uses(text: str) -> tuple[dict[str, list], set[tuple[str, str]]]:
    """``word: [first, named, bare, other, before, given]`` of each capitalised word of a text, and its pairs of such words.

    ``first``: it stands first after a cue. ``named``: as a family name beside a given name, an initial or
    a cue. ``bare``: before the given name ``given`` alone, where greetings stand too. ``other``: anywhere
    else. ``before``: directly before another.
    """
    tokens = [(m.start(), m.end(), m[0]) for m in CAPITAL.finditer(text)]
    words: dict[str, list] = {}
    pairs: set[tuple[str, str]] = set()
    shaped = [_FAMILY.fullmatch(w) is not None and text[e : e + 1] != "@" and text[s - 1 : s] not in ("@", ".", "+") for s, e, w in tokens]
    gaps = [text[a[1] : b[0]] for a, b in zip(tokens, tokens[1:])]
    gaps = [g if len(g) <= 5 and _LINK.fullmatch(g) else "" for g in gaps] + [""]
    given = [_is_given(w) for _, _, w in tokens]
    cued = [text[s - 1 : s] == " " and CUE.search(text, max(0, s - LONGEST_CUE), s) is not None for s, _, _ in tokens]
    for i, (start, _, word) in enumerate(tokens):
        seen = words.setdefault(word, [0, 0, 0, 0, 0, None])
        after = gaps[i] and shaped[i + 1]
        if not shaped[i]:
            seen[3] = 1
            continue
        if after and gaps[i] != ", ":
            seen[4] = 1
            pairs.add((word, tokens[i + 1][2]))
        first = after and not given[i] and (cued[i] or _PRESENTS_BEFORE.search(text, max(0, start - _LONGEST), start) is not None)
        if first:
            seen[0] = 1
        back = gaps[i - 1] if i else ""
        if (
            back and back != ", " and given[i - 1]
            or gaps[i] == ", " and given[i + 1]
            or text[start - 1 : start] in (" ", ".") and _INITIAL_BEFORE.search(text, max(0, start - 4), start)
            or cued[i]
            or back in (" ", ", ") and shaped[i - 1] and cued[i - 1]
        ):
            seen[1] = 1
        elif gaps[i] == " " and given[i + 1] and not (gaps[i + 1] and gaps[i + 1] != ", " and shaped[i + 2]):
            seen[2], seen[5] = 1, tokens[i + 1][2].upper().split("-")[0]
        elif not first:
            seen[3] = 1
    return words, pairs


READ = "key string, words array<string>, word string, two string, texts long, firsts long, sure long, bare long, rest long, before long, givens array<string>"


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each text's words, and their uses summed over the texts of a batch."""
    columns = [c.split(" ")[0] for c in READ.split(", ")]
    for batch in batches:
        rows: list[tuple] = []
        counts: dict[str, list] = {}
        couples: dict[tuple[str, str], int] = {}
        for key, text in zip(batch["key"], batch["text"]):
            words, pairs = uses(text)
            rows.append((key, list(words), None, None, None, None, None, None, None, None, None))
            for word, (first, named, bare, other, before, given) in words.items():
                sums = counts.setdefault(word, [0, 0, 0, 0, 0, 0, set()])
                for i, n in enumerate((1, first, named, bare and not named, other, before)):
                    sums[i] += n
                if given:
                    sums[6].add(given)
            for pair in pairs:
                couples[pair] = couples.get(pair, 0) + 1
        rows += [(None, None, word, None, *sums[:6], sorted(sums[6])) for word, sums in counts.items()]
        rows += [(None, None, one, two, n, None, None, None, None, None, None) for (one, two), n in couples.items()]
        frame = pd.DataFrame(rows, columns=columns)
        yield frame.astype({c: "Int64" for c in ("texts", "firsts", "sure", "bare", "rest", "before")})


def lexicon(read: DataFrame, few: int = 3) -> DataFrame:
    """``word, common, given`` of the words the corpus tells something about, from the uses in distinct texts.

    * ``given``: a word that isn't listed but stands first after a cue in two texts at least, and before
      another capitalised word in half of all its texts.
    * ``common``: a word used elsewhere than as a family name in two texts at least, and in more texts
      than as one. A text that has both ways counts for both. Before a given name alone a word counts
      as a family name if it stands so before ``few`` given names at most, else as a greeting.

    Counts combine in each batch and on the map side; nothing reaches the driver.
    """
    sums = [F.sum(c).alias(c) for c in ("texts", "firsts", "sure", "bare", "rest", "before")]
    counts = read.where("word is not null and two is null").groupBy("word").agg(*sums, F.size(F.array_distinct(F.flatten(F.collect_set("givens")))).alias("givens"))
    counts = materialize(counts)
    listed = [*_GIVEN_SET, *_UPPER_SET, *_BEFORE_SET]
    given = counts.where((F.col("firsts") >= 2) & (F.col("before") * 2 >= F.col("texts")) & ~F.col("word").isin(listed)).select(F.col("word").alias("one"))
    more = read.where("two is not null").select(F.col("word").alias("one"), "two", "texts").join(given, "one").groupBy(F.col("two").alias("word")).agg(F.sum("texts").alias("more"))
    marked = counts.join(more, "word", "left").join(given.select(F.col("one").alias("word"), F.lit(True).alias("given")), "word", "left")
    is_name, more_of = F.col("givens") <= few, F.coalesce("more", F.lit(0))
    as_name = F.col("sure") + F.when(is_name, F.col("bare")).otherwise(0) + more_of
    other = F.col("rest") + F.when(is_name, 0).otherwise(F.col("bare")) - more_of
    flags = marked.select("word", ((other >= 2) & (other > as_name) & ~F.col("word").isin(listed)).alias("common"), F.coalesce("given", F.lit(False)).alias("given"))
    return materialize(flags.where("common or given"))


def prepared(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``key, text, common, given`` of each distinct text, and ``doc, key`` of each row.

    Reposts are read once, however many rows hold one text; the words that the lexicon knows come to
    each text by joins.
    """
    slim = docs.select(F.col(doc).cast("long").alias("doc"), F.col(text).alias("text")).withColumn("key", F.sha2("text", 256))
    spark = docs.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    texts = materialize(slim.where(F.col("text") != "").groupBy("key").agg(F.min("text").alias("text")).repartition(tasks, "key"))
    read = materialize(texts.repartition(tasks, "key").mapInPandas(_read, READ))
    words = read.where("key is not null").select("key", F.explode("words").alias("word")).join(lexicon(read), "word")
    sets = words.groupBy("key").agg(F.collect_list(F.when(F.col("common"), F.col("word"))).alias("common"), F.collect_list(F.when(F.col("given"), F.col("word"))).alias("given"))
    return texts.repartition(tasks, "key").join(sets, "key", "left"), slim.select("doc", "key")


# ---------------------------------------------------------------- replacement


def entity(kind: str, found: str) -> str:
    """What all writings of one entity have in common, for coreference."""
    if kind == "email":
        return re.sub(r"\s", "", re.sub(DOT, ".", re.sub(AT, "@", found.lower(), flags=re.I), flags=re.I))
    if kind == "phone":
        digits = _digits(found)
        return re.sub(r"^00", "", digits) if digits.startswith("00") or found.startswith("+") else digits
    if kind == "name":
        return " ".join(sorted(re.findall(r"[^\W\d_]+", found.casefold())))
    return re.sub(r"[\W_]", "", found.casefold())


GIVEN_NAMES = (tuple(w.lower() for w in WOMEN), tuple(w.lower() for w in MEN))
#: Words of an address that stay: kinds of roads and flats, and what stands before a street's name.
STAYS = frozenset([*ROADS.split("|"), "as", "lgh", "Wohnung", "Whg", "flat", "Flat", "apt", "An", "Am", "Auf", "Zum", "Zur", "Im", "In", "der", "dem", "den", "Straße", "Allee", "Weg", "Gasse", "katu", "tie"])
_STREET_END = re.compile(rf"(?i)(?:{STREETS})$")


def surrogate(kind: str, found: str, key: bytes) -> str:
    """A keyed value of the same type and format; see :mod:`vaunu.llm.surrogates`."""
    if kind == "name":
        return re.sub(r"[^\W\d_]+", lambda m: surrogates.name_word(m[0], key, GIVEN_NAMES), found)
    if kind == "email":
        local, at, host = re.match(rf"(.*?)({AT})(.*)$", found, re.I | re.S).groups()
        label = re.match(r"[\w-]+", host)[0]
        return _mail_part(local, key) + at + _mail_part(label, key) + host[len(label) :]
    if kind == "address":
        return re.sub(r"[^\W\d_]+|\d+", lambda m: _address_word(m[0], key), found)
    if kind == "phone":
        return surrogates.phone(found, key)
    parts = FINNISH.fullmatch(found)
    if parts and is_finnish(parts[1], parts[3], parts[4].upper()):
        return surrogates.finnish(found, key)
    if SOCIAL.fullmatch(found):
        return surrogates.social(found, key)
    return surrogates.insurance(found, key) if INSURANCE.fullmatch(found) else surrogates.swedish(found, key)


def _mail_part(text: str, key: bytes) -> str:
    """Words as in names, so that an address goes on fitting its owner; the words of ``at`` and ``dot`` stay."""
    split = re.split(f"({DOT})", text, flags=re.I)
    return "".join(p if i % 2 else re.sub(r"[^\W\d_]+|\d+", lambda m: surrogates.number(m[0], key, "mail") if m[0].isdigit() else surrogates.name_word(m[0], key, GIVEN_NAMES), p) for i, p in enumerate(split))


def _address_word(word: str, key: bytes) -> str:
    if word.isdigit():
        return surrogates.number(word, key, "house")
    if word in STAYS or len(word) == 1:
        return word
    end = _STREET_END.search(word)
    stem = word[: end.start()] if end else word
    return surrogates.word(stem, key, "street " + (end[0].lower() if end else "")) + (end[0] if end else "")


def replace(text: str, common: frozenset[str] = frozenset(), key: bytes | None = None, given: frozenset[str] = frozenset()) -> str:
    """The text with placeholders (``[NAME_1]``), or with surrogates where there is a key."""
    out, end, known, number = [], 0, {}, {}
    for start, stop, kind in find(text, common, given):
        found = text[start:stop]
        if key is None:
            who = (kind, entity(kind, found))
            if who not in known:
                number[kind] = number.get(kind, 0) + 1
                known[who] = f"[{kind.upper()}_{number[kind]}]"
            new = known[who]
        else:
            new = surrogate(kind, found, key)
        out += [text[end:start], new]
        end = stop
    return "".join([*out, text[end:]])


def _some(words: object) -> frozenset[str]:
    return frozenset(words if words is not None else ())


def pieces(docs: DataFrame, key: bytes, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc, kind, found, surrogate, entity, surrogate_entity``: each distinct piece in a text, exactly as
    written, without punctuation around it, and what replaces it.

    Null and empty texts have none; whole texts are searched, whatever their length. Rows with equal
    texts have equal pieces, repeated rows repeated ones. An empty table gives no rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, t, common, given in zip(batch["key"], batch["text"], batch["common"], batch["given"]):
                for kind, piece in sorted({(kind, t[a:b]) for a, b, kind in find(t, _some(common), _some(given))}):
                    new = surrogate(kind, piece, key)
                    rows.append((k, kind, piece, new, entity(kind, piece), entity(kind, new)))
            yield pd.DataFrame(rows, columns=["key", "kind", "found", "surrogate", "entity", "surrogate_entity"])

    texts, rows = prepared(docs, doc, text)
    found = texts.mapInPandas(run, "key string, kind string, found string, surrogate string, entity string, surrogate_entity string")
    return rows.join(found, "key").drop("key").withColumnRenamed("doc", doc)


def found_pieces(docs: DataFrame, key: bytes, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc, kind, found`` of :func:`pieces`."""
    return pieces(docs, key, doc, text).select(doc, "kind", "found")


def redacted(docs: DataFrame, key: bytes | None = None, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc, text`` with each piece replaced: by typed placeholders, or with ``key`` by surrogates. Null stays null."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            new = [replace(t, _some(c), key, _some(g)) for t, c, g in zip(batch["text"], batch["common"], batch["given"])]
            yield pd.DataFrame({"key": batch["key"], "new": pd.Series(new, dtype=object)})

    texts, rows = prepared(docs, doc, text)
    changed = texts.mapInPandas(run, "key string, new string")
    none = F.sha2(F.lit(""), 256)
    out = rows.join(changed, "key", "left").select("doc", F.when(F.col("key") == none, F.lit("")).otherwise(F.col("new")).alias("text"))
    return out.withColumnsRenamed({"doc": doc, "text": text})
