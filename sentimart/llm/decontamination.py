"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit checks.

Finds, in every document, passages within ``MAX_EDITS`` (a share of the item's
words) word edits of a benchmark item. Words are compared in lower case
(A-Z) and without punctuation at their ends.

Embedding. A CGK walk goes along a window of words: at each step it emits the
word under it, and moves on by one or stays, as a random bit of (step, word)
says. Two windows of small edit distance fall into step again after an edit,
so their walks emit the same words at most steps: edit distance becomes
Hamming distance. An item contributes each of its windows. Their size goes by
the item's words (``SIZES``): the shorter the item, the shorter its windows, so
that some of them hold no edit; an item too short for any edit has a window
whose walk cannot leave it.

Search. Bit sampling keeps ``SAMPLED`` steps of a walk as the bucket's key;
``REPEATS`` independent walks and samples reach the target recall (measured in
the tests). Every window of every document is looked up, all of a batch's
positions walking at once as arrays.

Check. A bucket hit names an item and a place. Of those, a place needs as many
words in common with the item as the distance allows, and then the exact edit
distance of the item to the best passage there decides.

The items are the query set: they go to the tasks in blocks of about
``BLOCK_WORDS`` words, one after the other; a block's matches are written
before the next one is collected, so driver and tasks hold one block's index
for any benchmark. Documents are handled in one pass per block, without a
shuffle.

Defined results: a null text or item is empty; an item without words matches
nothing; repeated rows and items give repeated results; null ids are kept; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentimart.llm.common import text_of, words, written

#: An item counts as leaked if so large a share of its words, at most, is edited.
MAX_EDITS = 0.2
#: Window sizes in words, by the least words of an item; steps of a walk for each word of a window (one step for a window of 0).
SIZES, STEPS = {1: 0, 2: 1, 4: 2, 8: 3, 12: 6, 24: 12}, 2  # 32 steps at most
#: Sampled steps of a walk, and independent walks.
SAMPLED, REPEATS = 4, 4
#: Benchmark words in a block of items, at most (about 100 bytes each in a task).
BLOCK_WORDS = 200_000
#: Words that walk together (so few that the arrays stay in cache), and words of a batch of texts.
WALK, CHUNK = 1 << 15, 1 << 18
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def tokens(raw: bytes) -> np.ndarray:
    """64-bit hashes of the compared words of a text."""
    return np.array([xxhash.xxh3_64_intdigest(w) for x in raw.lower().split() if (w := x.strip(PUNCTUATION))], np.uint64)


def buckets(t: np.ndarray, size: int, repeat: int, sampled: int = SAMPLED) -> np.ndarray:
    """The bucket key of the window at each position of ``t`` (padded at its end)."""
    rng = np.random.default_rng([size, repeat])
    steps, n = max(1, STEPS * size), len(t)
    chosen = set(rng.choice(steps, min(sampled, steps), replace=False).tolist())
    salt = np.uint64(int(rng.integers(1 << 63)) * 2 + 1)
    padded = np.r_[t, np.zeros(steps, np.uint64)]
    bits = ((padded ^ (padded >> np.uint64(31))) * salt >> np.uint64(32)).astype(np.uint32)  # a word's moves, a bit a step
    at, key = np.arange(n, dtype=np.int32), np.full(n, salt, np.uint64)
    for step in range(max(chosen) + 1):
        if step in chosen:
            key ^= padded[at]
            key *= _ODD
            key ^= key >> np.uint64(29)
        at += (bits >> np.uint32(step) & np.uint32(1)).view(np.int32)[at]
    return key


class Index:
    """The items' windows by bucket, and the items themselves."""

    def __init__(self, items: list[tuple[int | None, bytes]], sampled: int = SAMPLED, repeats: int = REPEATS):
        self.ids, self.tokens = [i for i, _ in items], [tokens(raw) for _, raw in items]
        self.words = [t.tolist() for t in self.tokens]
        self.sampled = sampled
        self.tables: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, dict]] = {}
        by_size = defaultdict(list)
        for i, t in enumerate(self.tokens):
            if len(t):
                by_size[SIZES[max(n for n in SIZES if n <= len(t))]].append(i)
        for size, group in by_size.items():
            for repeat in range(repeats):
                at: dict[int, list[tuple[int, int]]] = defaultdict(list)
                for i in group:
                    for offset, key in enumerate(buckets(self.tokens[i], size, repeat, sampled).tolist()[:len(self.tokens[i]) - size + 1]):
                        at[key].append((i, offset))
                bits = np.zeros(1 << 20, bool)
                bits[np.array(list(at), np.uint64) >> np.uint64(44)] = True
                self.tables[size, repeat] = bits, at

    def matches(self, texts: list[bytes]) -> list[list[tuple]]:
        """Of each text ``[(item_id, edits, item_words, start, end)]``; ``start`` and ``end`` count compared words."""
        out: list[list[tuple]] = [[] for _ in texts]
        held, sizes, first = [], 0, 0
        for n, raw in enumerate(texts):
            held.append(tokens(raw))
            sizes += len(held[-1])
            if sizes >= CHUNK or n == len(texts) - 1:
                self._search(held, out, first)
                held, sizes, first = [], 0, n + 1
        return out

    def _search(self, held: list[np.ndarray], out: list[list[tuple]], first: int) -> None:
        ends = np.cumsum([len(t) for t in held])
        every = np.concatenate(held)
        places: dict[int, set[tuple[int, int]]] = defaultdict(set)
        for part in range(0, len(every), WALK):
            piece = every[part:part + WALK + STEPS * max(SIZES.values())]  # a walk goes on into the next piece
            for (size, repeat), (bits, at) in self.tables.items():
                keys = buckets(piece, size, repeat, self.sampled)[:WALK]
                for p in np.flatnonzero(bits[keys >> np.uint64(44)]).tolist():
                    for item, offset in at.get(int(keys[p]), ()):
                        doc = int(np.searchsorted(ends, p + part, "right"))
                        places[doc].add((item, p + part - int(ends[doc] - len(held[doc])) - offset))
        for doc, found in places.items():
            out[first + doc] = self._checked(held[doc], found)

    def _checked(self, text: np.ndarray, places: set[tuple[int, int]]) -> list[tuple]:
        best: dict[int, tuple] = {}
        for item, start in sorted(places):
            own = self.tokens[item]
            most = int(MAX_EDITS * len(own))
            low, high = max(0, start - most), min(len(text), start + len(own) + most)
            if item in best and best[item][2] <= low + most and best[item][3] >= high - most:
                continue  # the same place by another window
            region = text[low:high]
            there = set(region.tolist())
            if sum(w in there for w in self.words[item]) < len(own) - most:
                continue
            edits, a, b = passage(own, region)
            if edits <= most and (item not in best or edits < best[item][0]):
                best[item] = edits, len(own), low + a, low + b
        return [(self.ids[i], *x) for i, x in sorted(best.items())]


def _ends(item: np.ndarray, region: np.ndarray) -> np.ndarray:
    """At each end in ``region``, the least edit distance of ``item`` to a part that ends there."""
    along = np.arange(len(region) + 1)
    row = np.zeros(len(region) + 1, np.int64)
    for x in item:
        new = row + 1
        np.minimum(new[1:], row[:-1] + (region != x), out=new[1:])
        row = np.minimum.accumulate(new - along) + along  # insertions: one more for each step to the right
    return row


def passage(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """The least edit distance of ``item`` to a part of ``region``, and that part's start and end."""
    row = _ends(item, region)
    end = int(row.argmin())
    back = _ends(item[::-1], region[:end][::-1])
    return int(row[end]), end - int(back.argmin()), end


def n_blocks(items: DataFrame, block_words: int = BLOCK_WORDS) -> int:
    total, longest = items.agg(F.sum(F.size(words("text"))), F.max(F.size(words("text")))).first()
    return max(1, -(-(total or 0) // max(block_words - (longest or 0), block_words // 2)))


def blocks(items: DataFrame, block_words: int = BLOCK_WORDS):
    """The items in lists of bounded size."""
    n = n_blocks(items, block_words)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        yield [(r.item_id, bytes(r.raw)) for r in items.where(part == k).select("item_id", text_of("text").cast("binary").alias("raw"))
               .orderBy("item_id", "raw").collect()]


MATCH = "array<struct<item_id:bigint,edits:bigint,item_words:bigint,start:bigint,end:bigint>>"


def _matches(text: str | Column, items: list, **options) -> Column:
    index = Index(items, **options)

    @F.pandas_udf(MATCH)
    def find(raw: pd.Series) -> pd.Series:
        names = ("item_id", "edits", "item_words", "start", "end")
        return pd.Series([[dict(zip(names, m, strict=True)) for m in found] for found in index.matches(list(raw))], dtype=object)

    return find(text_of(text).cast("binary"))


def leaks(docs: DataFrame, items: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(doc_id, item_id, edits, item_words, start, end)``: a row for each leaked item of each document."""
    found = None
    for last, block in _in_turn(items, block_words):
        part = docs.select("doc_id", F.explode(_matches("text", block)).alias("x")).select("doc_id", "x.*")
        if found is not None or not last:
            part = written(part)
        found = part if found is None else found.unionByName(part)
    return found


def clean(docs: DataFrame, items: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` that leak no item, all columns."""
    for last, block in _in_turn(items, block_words):
        docs = docs.where(F.size(_matches("text", block)) == 0)
        if not last:
            docs = written(docs)
    return docs


def _in_turn(items: DataFrame, block_words: int):
    """``(is it the last, block)``; a block is collected when the one before it has had its pass."""
    n = n_blocks(items, block_words)
    for k, block in enumerate(blocks(items, block_words), 1):
        yield k == n, block
