"""Phrase and modifier scoring (ENR-14): entries of several words, boosters and
contrast clauses, beside the negation of :mod:`sentimart.operators.scoring`.

* Entries of one to several tokens form a trie. All tokens of a batch are one
  flat array; the trie is walked from every token at once, a depth a step, and
  only walks still alive go on. The longest entry at a token counts, unless it
  overlaps a longer one, or one as long that begins before it.
* Boosters up to three tokens before an entry strengthen (or weaken) it, each
  by its amount at 100, 95 or 90 % with growing distance.
* Negators up to three tokens before it turn it around (-0.74).
* In a text with a contrast word ("but"), what comes before the first one
  counts half and what comes after it one and a half times.

Sums are whole numbers (units of 1e-9), so they do not depend on order. Entry
tables are collected after a check of their number. Defined results: an entry
given twice counts with its greatest valence; empty entries are left out; a null
or empty text scores 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentimart.functions.text import tokens
from sentimart.operators import scoring as SCO

UNIT_BOOSTED = 10**9
DAMPING_PCT = (100, 95, 90)
# Words of degree with the amount that they add, and contrast words.
BOOSTERS = [("very", 0.293), ("really", 0.293), ("extremely", 0.293), ("so", 0.293), ("most", 0.293), ("totally", 0.293),
            ("slightly", -0.293), ("barely", -0.293), ("hardly", -0.293), ("somewhat", -0.293), ("almost", -0.293)]
CONTRAST = ["but", "however", "mais", "aber", "pero"]
MAX_ENTRIES = SCO.MAX_LOCAL_ENTRIES


class Trie:
    """Entries as states and arcs: ``keys`` are sorted (state, word) pairs as numbers, ``after`` the states they lead to."""

    def __init__(self, entries: dict[str, int]):
        split = {tuple(e.split(" ")): v for e, v in entries.items() if e.strip()}
        self.words = sorted({w for e in split for w in e})
        number, states = {w: i for i, w in enumerate(self.words)}, {(): 0}
        for e in split:
            for k in range(1, len(e) + 1):
                states.setdefault(e[:k], len(states))
        arcs = sorted((states[e[:-1]] * len(self.words) + number[e[-1]], s) for e, s in states.items() if e)
        self.keys, self.after = (np.array(x, np.int64) for x in (zip(*arcs, strict=True) if arcs else ((), ())))
        self.depth = max(map(len, split), default=0)
        self.entry, self.valence = np.zeros(len(states), bool), np.zeros(len(states), np.int64)
        for e, v in split.items():
            self.entry[states[e]], self.valence[states[e]] = True, v

    def longest(self, t: SCO.Tokens) -> tuple[np.ndarray, np.ndarray]:
        """At each token the length of the longest entry that begins there (0: none), and its valence."""
        word = t.places(self.words)
        length, valence = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)
        at, state = np.arange(len(word)), np.zeros(len(word), np.int64)
        for k in range(self.depth):
            ok = at + k < len(word)
            at, state = at[ok], state[ok]
            ok = (t.text[at] == t.text[at + k]) & (word[at + k] >= 0)
            at, state = at[ok], state[ok]
            key = state * len(self.words) + word[at + k]
            place = np.searchsorted(self.keys, key)
            ok = place < len(self.keys)
            ok[ok] = self.keys[place[ok]] == key[ok]
            at, state = at[ok], self.after[place[ok]]
            is_entry = self.entry[state]
            length[at[is_entry]], valence[at[is_entry]] = k + 1, self.valence[state[is_entry]]
        return length, valence


def undisputed(t: SCO.Tokens, length: np.ndarray, most: int) -> np.ndarray:
    """Entries that overlap none longer, nor one as long that begins before."""
    keep = length > 0
    first = np.flatnonzero(keep)
    for step in range(1, most):
        a = first[first + step < len(length)]
        b = a + step
        meet = (length[b] > 0) & (t.text[a] == t.text[b]) & (step < length[a])
        a, b = a[meet], b[meet]
        keep[a[length[b] > length[a]]] = False
        keep[b[length[b] <= length[a]]] = False
    return keep


def sums_column(text_col: str, entries: dict[str, int], boosters: dict[str, int], contrast: list[str]) -> Column:
    """The integer sums of one text, as a struct."""
    trie, words = Trie(entries), list(boosters)
    amount = np.array([*boosters.values(), 0], np.int64)

    def sums(lists: pa.Array) -> pa.Array:
        t = SCO.Tokens(lists)
        length, valence = trie.longest(t)
        v = np.where(undisputed(t, length, trie.depth), valence, 0)
        boost = amount[t.places(words)]
        boost = sum(t.before(boost, k) * pct for k, pct in enumerate(DAMPING_PCT, 1))
        v = np.where(v != 0, v * 100 + np.sign(v) * boost, 0) * np.where(t.negated(), SCO.NEGATION_SCALE_PCT, 100)
        turn = t.places(contrast) >= 0
        upto = np.cumsum(turn)
        behind = upto - np.repeat(np.concatenate([[0], upto])[t.offsets[:-1]], t.sizes)  # contrast words so far, in the text
        some = np.repeat(t.total(turn) > 0, t.sizes)
        first = turn & (behind == 1)
        return t.sums(v * np.where(~some | first, 100, np.where(behind == 0, 50, 150)), UNIT_BOOSTED, length)

    @F.arrow_udf(SCO.SUMS)
    def batch_sums(lists: pa.Array) -> pa.Array:
        return SCO.sliced(sums)(lists)

    return batch_sums(tokens(text_col))


def bounded(table: DataFrame, key: str, most: int = MAX_ENTRIES) -> dict[str, int]:
    """``key`` -> valence in units of 1e-3; an error beyond ``most``."""
    found = SCO.local_lexicon(table.withColumnRenamed(key, "token"), most)
    if found is None:
        raise ValueError(f"more than {most} entries")
    return found


def phrase_scores(df: DataFrame, id_cols: list[str], text_col: str, entries: DataFrame, boosters: DataFrame,
                  contrast: list[str] = CONTRAST, most: int = MAX_ENTRIES) -> DataFrame:
    """Scores per text from ``entries(entry, valence)``, words of an entry joined by one space, and ``boosters(token, valence)``."""
    sums = sums_column(text_col, bounded(entries, "entry", most), bounded(boosters, "token", most), contrast)
    return df.select(*id_cols, sums.alias("_sums")).select(*id_cols, *SCO._scores("_sums", UNIT_BOOSTED))


def booster_table(spark) -> DataFrame:
    return spark.createDataFrame(BOOSTERS, "token string, valence double")
