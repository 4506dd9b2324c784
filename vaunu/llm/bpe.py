"""Problem 8: the whole corpus encoded with a public byte-level BPE tokenizer.

Merge replay: the distinct words of a block of texts lie in one array of symbols. An inverted index
from token pair to the places where it stands is built once; merges are then applied in rank order,
each to all its places in all words at a time, and only the touched neighbours enter the index again.
A pair with a merged token can only have a later rank, so one pass over the ranks is enough, and the
result is that of merging each word alone. Blocks need nothing of each other: no shuffle, no vocabulary
of the corpus in one place.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaunu.session import spread

#: Folder of the public vocabulary files; a parameter of every function that needs one.
TOKENIZERS = "/opt/tokenizers"
#: Fixed value: how this tokenizer cuts text into words before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words kept between blocks of a task; only repeated work depends on it.
KEPT_WORDS = 500_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: printable bytes themselves, the others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Replay:
    """The merges of one vocabulary: ``pairs`` maps two ids to the rank and id of their merge."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, letters = model["vocab"], byte_letters()
        self.of_byte = [0] * 256
        for letter, byte in letters.items():
            self.of_byte[byte] = vocab[letter]
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.by_rank = list(self.pairs)

    def encode(self, words: list[str]) -> list[list[int]]:
        """The ids of each word of a block."""
        symbols: list[int] = []
        starts = []
        for word in words:
            starts.append(len(symbols))
            symbols.extend(self.of_byte[b] for b in word.encode("utf-8", "replace"))
            symbols.append(-1)  # end of the word
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        pairs, places, waiting = self.pairs, {}, []

        def enter(place: int, a: int, b: int) -> None:
            found = pairs.get((a, b))
            if found is not None:
                at = places.get(found[0])
                if at is None:
                    places[found[0]] = [place]
                    heapq.heappush(waiting, found[0])
                else:
                    at.append(place)

        for i in range(len(symbols) - 1):
            enter(i, symbols[i], symbols[i + 1])
        while waiting:
            rank = heapq.heappop(waiting)
            a, b = self.by_rank[rank]
            new = pairs[a, b][1]
            for p in sorted(places.pop(rank)):
                if symbols[p] != a:
                    continue
                q = after[p]
                if q >= len(symbols) or symbols[q] != b:
                    continue
                symbols[p], symbols[q] = new, -2
                r = after[q]
                after[p] = r
                if r < len(symbols):
                    before[r] = p
                    if symbols[r] >= 0:
                        enter(p, new, symbols[r])
                left = before[p]
                if left >= 0 and symbols[left] >= 0:
                    enter(left, symbols[left], new)
        out = []
        for start in starts:
            ids, at = [], start
            while symbols[at] != -1:
                ids.append(symbols[at])
                at = after[at]
            out.append(ids)
        return out


@lru_cache(2)
def _replay(path: str) -> Replay:
    return Replay(path)


_WORDS = regex.compile(PATTERN)


def _blocks(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[pa.RecordBatch, list[list[list[int]]]]]:
    replay, known = _replay(path), {}
    for batch in batches:
        texts = [_WORDS.findall(t) if t else [] for t in batch.column(batch.num_columns - 1).to_pylist()]
        fresh = list({w for words in texts for w in words if w not in known})
        if len(known) + len(fresh) > KEPT_WORDS:
            known.clear()
            fresh = list({w for words in texts for w in words})
        known.update(zip(fresh, replay.encode(fresh)))
        yield batch, [[known[w] for w in words] for words in texts]


def encode(df: DataFrame, doc: str = "doc_id", text: str = "text", vocabulary: str = f"{TOKENIZERS}/byte_bpe_50k.json") -> DataFrame:
    """``doc, ids``: the token ids of each row's whole text, without special tokens.

    Null, as well as empty, text gives an empty list. Strings that look like special tokens are
    ordinary text; a lone surrogate counts as ``?``. Rows with equal text give equal lists. Any other
    column is ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, docs in _blocks(batches, vocabulary):
            flat = [i for words in docs for ids in words for i in ids]
            ends = np.cumsum([0, *[sum(map(len, words)) for words in docs]])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=[doc, "ids"])

    slim = df.select(F.col(doc), F.col(text).alias("_text"))
    kind = slim.schema[doc].dataType.simpleString()
    return spread(slim, doc).mapInArrow(run, f"`{doc}` {kind}, ids array<int>")


def token_counts(df: DataFrame, keep: list[str], text: str = "text", vocabulary: str = f"{TOKENIZERS}/byte_bpe_50k.json") -> DataFrame:
    """The columns ``keep`` and ``n_tokens``, the length of each row's ids; 0 for null and empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, docs in _blocks(batches, vocabulary):
            sizes = pa.array([sum(map(len, words)) for words in docs], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], sizes], names=[*keep, "n_tokens"])

    slim = df.select(*keep, F.col(text).alias("_text"))
    kinds = ", ".join(f"`{c}` {slim.schema[c].dataType.simpleString()}" for c in keep)
    return spread(slim, keep[0]).mapInArrow(run, f"{kinds}, n_tokens long")
