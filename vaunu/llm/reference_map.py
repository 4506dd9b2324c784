"""Problem 6: freely typed values mapped to the entries of a canonical list.

The list's makers lie in a trie with alias paths (transliterated vowels, words in other order, initials,
initial with last word), the models of each maker in tries of their own. A Levenshtein automaton, its
states the rows of edit costs, walks a trie and returns all entries within a distance that depends on
the length; neighbours swapped count as one edit. Figures must agree exactly. A text that ends in a
point may also be the beginning of a path. Lines are mapped where they lie, without a shuffle; a list
longer than ``MOST_REFERENCES`` is searched in blocks of whole makers, of which the best result counts.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaunu.llm.lookalikes import fold, to_latin
from vaunu.session import spread

#: So much of the list goes to every task at once.
MOST_REFERENCES = 100_000
#: Words that say nothing of the maker, and of the model.
LEGAL = {"oy", "oyj", "ab", "ag", "as", "inc", "ltd", "kft", "srl", "spa", "doo", "gmbh", "llc", "co", "corp", "sa", "bv", "nv"}
BODY = {
    "4x4", "awd", "van", "combi", "kombi", "sedan", "epower", "hybrid", "farmari", "diesel", "bensiini", "petrol", "coupe", "automaatti",
    "manuaali", "aut", "man", "2ov", "3ov", "4ov", "5ov", "wagon", "estate", "hatchback", "sähkö", "electric", "phev", "tdi", "tsi", "cdi",
}
LETTERS = {"ä": "ae", "ö": "oe", "ü": "ue", "å": "aa", "æ": "ae", "ø": "oe", "ß": "ss"}


@lru_cache(1 << 16)
def plain(text: str) -> str:
    """Small letters and figures only, without accents, signs and look-alikes."""
    text = fold(text)
    text = (to_latin(text) or text) if not text.isascii() else text
    text = "".join(c for c in unicodedata.normalize("NFKD", text.casefold()) if c.isalnum())
    return text.replace("ø", "o").replace("æ", "ae")


def spelled(text: str) -> str:
    """As :func:`plain`, with accented vowels written out."""
    return plain("".join(LETTERS.get(c, c) for c in fold(text).casefold()))


def figures(text: str) -> str:
    return re.sub(r"\D", "", text)


MOST_EDITS = 3
#: A text may be so much shorter than its words are by themselves.
SLACK = 40


def budget(length: int) -> int:
    """Edits allowed for a text of so many letters."""
    return 0 if length <= 3 else 1 if length <= 5 else 2 if length <= 14 else MOST_EDITS


class Trie:
    """Entries under paths; ``search`` gives those within a distance, ``begins`` those under a beginning."""

    def __init__(self) -> None:
        self.root: dict = {}
        self.longest = 0

    def add(self, path: str, entry: int) -> None:
        node, self.longest = self.root, max(self.longest, len(path))
        for ch in path:
            node = node.setdefault(ch, {})
        node.setdefault("", set()).add(entry)

    def begins(self, path: str) -> set[int]:
        node = self.root
        for ch in path:
            node = node.get(ch)
            if node is None:
                return set()
        out, todo = set(), [node]
        while todo:
            for ch, below in todo.pop().items():
                if ch:
                    todo.append(below)
                else:
                    out |= below
        return out

    def search(self, text: str, most: int) -> dict[int, int]:
        """Each entry within ``most`` edits and its least distance.

        A state of the automaton is a row of edit costs, of which only the band within ``most`` of the
        depth can still lead to a match.
        """
        out: dict[int, int] = {}
        n, far = len(text), most + 1
        if n > self.longest + most:
            return out
        first = [j if j <= most else far for j in range(n + 1)]
        todo = [(self.root, 0, "", first, first)]
        while todo:
            node, depth, last, row, above = todo.pop()
            low, high = max(1, depth + 1 - most), min(n, depth + 1 + most)
            for ch, below in node.items():
                if not ch:
                    if abs(n - depth) <= most and row[n] <= most:
                        for entry in below:
                            out[entry] = min(out.get(entry, most), row[n])
                    continue
                if low > high + 1:
                    continue
                new = [far] * (n + 1)
                if depth < most:
                    new[0] = depth + 1
                least = new[0]
                for j in range(low, high + 1):
                    seen = text[j - 1]
                    cost = row[j - 1] if seen == ch else row[j - 1] + 1
                    if new[j - 1] < cost:
                        cost = min(cost, new[j - 1] + 1)
                    if row[j] < cost:
                        cost = min(cost, row[j] + 1)
                    if depth and j > 1 and seen == last and text[j - 2] == ch and above[j - 2] < cost:
                        cost = min(cost, above[j - 2] + 1)
                    if cost > far:
                        cost = far
                    new[j] = cost
                    if cost < least:
                        least = cost
                # a state without cost within reach can only live on by a swap with the next letter
                if least <= most or min(row) < most:
                    todo.append((below, depth + 1, ch, new, row))
        return out


class Mapper:
    """The searchable list of ``(ref_id, brand, model)``."""

    def __init__(self, references: list[tuple[int, str, str]]):
        self.makers: list[str] = sorted({b for _, b, _ in references})
        self.maker_trie = Trie()
        self.model_tries = [Trie() for _ in self.makers]
        self.figures = {}
        self.prefixes: list[set[str]] = []
        number = {m: i for i, m in enumerate(self.makers)}
        for i, maker in enumerate(self.makers):
            parts = [w for w in re.split(r"[^\w]+", fold(maker)) if w]
            paths = {plain(maker), spelled(maker)}
            if len(parts) > 1:
                turned = " ".join(parts[1:] + parts[:1])
                paths |= {plain(turned), spelled(turned), plain("".join(p[0] for p in parts))}
                paths |= {plain(parts[0][0] + parts[-1]), spelled(parts[0][0] + parts[-1])}
            for path in paths:
                self.maker_trie.add(path, i)
            self.prefixes.append(paths)
        for ref_id, maker, model in references:
            for path in {plain(model), spelled(model)}:
                self.model_tries[number[maker]].add(path, ref_id)
            self.figures[ref_id] = figures(plain(model))
        self.find_makers = lru_cache(1 << 16)(self._find_makers)
        self.map = lru_cache(1 << 16)(self._map)

    def _find_makers(self, text: str) -> dict[int, int]:
        """Makers that a text may mean, with the distance."""
        words = text.split()
        while len(words) > 1 and plain(words[-1]) in LEGAL:
            words.pop()
        text = " ".join(words)
        key = plain(text)
        if not key:
            return {}
        out = self.maker_trie.search(key, budget(len(key)))
        if text.rstrip(" ,;").endswith(".") and len(key) >= 3:
            for maker in self.maker_trie.begins(key):
                out[maker] = 0
        return out

    def _find_models(self, maker: int, typed: str, text: str) -> dict[int, int]:
        """Models of a maker that a text may mean, with the distance."""
        words = text.split()
        end = len(words)
        ends = [end]
        while end > 1 and plain(words[end - 1]) in BODY:
            end -= 1
            ends.append(end)
        # letters and figures before each word: what is longer than any path and its maker can't match
        before = list(itertools.accumulate((len(plain(w)) for w in words), initial=0))
        longest = self.model_tries[maker].longest + MOST_EDITS
        heads = {h for h in (*self.prefixes[maker], plain(typed)) if len(h) > 1}
        starts, letters = [], 0  # after a mistyped maker before the model
        for i in range(1, len(words)):
            letters += 0 if plain(words[i - 1]) in LEGAL else len(plain(words[i - 1]))
            if letters > self.maker_trie.longest + MOST_EDITS:
                break
            if maker in self.find_makers(" ".join(words[:i])):
                starts.append(i)
        out: dict[int, int] = {}
        for end in ends:
            keys: dict[str, int] = {}
            if before[end] <= longest + max(map(len, heads), default=0) + SLACK:
                whole = plain(" ".join(words[:end]))
                keys = {whole: 0} | {whole[len(h) :]: 0 for h in heads if whole.startswith(h) and len(whole) > len(h)}
            keys |= {plain(" ".join(words[i:end])): 0 for i in starts if i < end and before[end] - before[i] <= longest + SLACK}
            for key in keys:
                letters = len(key) - len(figures(key))
                for ref_id, distance in self.model_tries[maker].search(key, budget(letters)).items():
                    if self.figures[ref_id] == figures(key):
                        out[ref_id] = min(out.get(ref_id, 99), distance)
            if out:
                break
        return out

    def _map(self, brand: str, model: str) -> tuple[tuple[int, int, int], ...]:
        """``edits, turned, ref_id`` of all entries within distance, the best first; columns as named unless those give an exact match."""
        best: dict[int, tuple[int, int, int]] = {}
        for turned, (maker_text, model_text) in enumerate(((brand, model), (model, brand))):
            if any(edits == 0 for edits, _, _ in best.values()):
                break
            for maker, first in self.find_makers(maker_text).items():
                for ref_id, second in self._find_models(maker, maker_text, model_text).items():
                    found = (first + second, turned, ref_id)
                    best[ref_id] = min(best.get(ref_id, found), found)
        return tuple(sorted(best.values()))


@lru_cache(2)
def _mapper(references: tuple) -> Mapper:
    return Mapper(list(references))


def matches(entries: DataFrame, references: DataFrame, row: str = "entry_no", most: int = MOST_REFERENCES) -> DataFrame:
    """``row, found``: of each entry whose brand and model are both not null and not blank, all entries of
    the list within distance as ``edits, turned, ref_id``, the best first.

    Fewest edits win, then columns as named before turned ones, then the smallest id. References with a
    null column are ignored. Texts are searched whole, of whatever length. Repeated entries give equal
    results. The list is canonical and small; above ``most`` entries it is searched block by block.
    """
    known = references.select("ref_id", "brand", "model").dropna()
    blocks = max(1, -(-known.count() // most))
    filled = entries.where((F.regexp_replace("brand", r"(?U)\s", "") != "") & (F.regexp_replace("model", r"(?U)\s", "") != ""))
    slim = spread(filled.select(F.col(row).cast("long").alias("row"), "brand", "model"), "row")

    def searched(block: int) -> DataFrame:
        rows = known.where(F.pmod(F.xxhash64("brand"), F.lit(blocks)) == block).toLocalIterator()
        shared = entries.sparkSession.sparkContext.broadcast(tuple(sorted(tuple(r) for r in rows)))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            mapper = _mapper(shared.value)
            for batch in batches:
                found = [[{"edits": e, "turned": t, "ref_id": r} for e, t, r in mapper.map(b, m)] for b, m in zip(batch["brand"], batch["model"])]
                yield pd.DataFrame({"row": batch["row"], "found": pd.Series(found, dtype=object)})

        return slim.mapInPandas(run, "row long, found array<struct<edits:int,turned:int,ref_id:long>>")

    out = searched(0)
    for block in range(1, blocks):
        out = out.unionByName(searched(block))
    if blocks > 1:
        out = out.groupBy("row").agg(F.array_sort(F.flatten(F.collect_list("found"))).alias("found"))
    return out.withColumnRenamed("row", row)


def map_entries(entries: DataFrame, references: DataFrame, row: str = "entry_no", most: int = MOST_REFERENCES) -> DataFrame:
    """``ref_id, row``: the best of :func:`matches`, 0 is unmatched. An empty list leaves every entry unmatched."""
    best = F.coalesce(F.get("found", F.lit(0))["ref_id"], F.lit(0)).alias("ref_id")
    return matches(entries, references, row, most).select(best, row)
