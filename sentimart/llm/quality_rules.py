"""Quality rules: a threshold table compiled into one Spark projection.

Each rule of the table names a ratio and its bounds. :func:`measured` computes
the counts the ratios need and :func:`judged` compiles the table into columns:
expressions on each row alone, with no user function and no shuffle.

Repeated three-word windows are found inside the row: window hashes with their
positions are sorted, equal neighbours mark the repeated windows, and the
sorted positions give the words they cover. That is O(n log n) for a text of
any length. Windows count as equal if the 64-bit hashes of their words are.

Defined results: a null text has no words; a text without words has ratio 0
everywhere and fails the length rule; repeated rows get the same verdict; an
empty table gives an empty result; an input column named like an output column
is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentimart.llm.common import WHITESPACE, let, text_of, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
SYMBOLS = r"[#*$%&|<>]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÜ", "abcdefghijklmnopqrstuvwxyzü"
#: Common function words of the languages of the corpus, lower case; counted in any case, without what stands around them.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "not",
    "he", "his", "are", "this", "at", "from", "have", "or", "an", "they", "which", "you", "we",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht",
    "ein", "eine", "als", "auch",
    "le", "la", "les", "de", "des", "et", "en", "un", "une", "du", "dans", "que", "qui", "est", "pour", "pas", "au",
    "sur", "par", "avec",
    "el", "los", "las", "y", "con", "del", "se", "por", "para", "su", "al", "no", "una", "lo", "como",
)


def _any_of(words: Sequence[str]) -> str:
    """A pattern of whole words, those of one first letter together."""
    by_letter: dict[str, list[str]] = {}
    for w in sorted(set(words), key=lambda w: (-len(w), w)):
        by_letter.setdefault(w[0], []).append(w[1:])
    return r"(?<!\p{L})(?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in sorted(by_letter.items())) + r")(?!\p{L})"


class Rule(NamedTuple):
    """A text passes if ``low <= ratio <= high``."""

    name: str
    ratio: str
    low: float
    high: float


RULES = (
    Rule("mean_word_chars", "word_chars / n_words", 2.0, 15.0),
    Rule("symbol_ratio", "n_symbols / n_words", 0.0, 0.2),
    Rule("stop_word_ratio", "n_stop_words / n_words", 0.05, 1.0),
    Rule("dup_line_ratio", "n_dup_lines / n_lines", 0.0, 0.3),
)


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_stop_words, n_repeat_words."""
    whole = text_of(text)
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    found = df.withColumn("_words", words(text)).withColumn("_lines", lines)
    return found.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.regexp_replace(whole, WHITESPACE, "")).cast("long"),
        "n_symbols": (F.length(whole) - F.length(F.regexp_replace(whole, SYMBOLS, ""))).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_stop_words": F.regexp_count(F.translate(whole, UPPER, LOWER), F.lit(_any_of(STOP_WORDS))).cast("long"),
        "n_repeat_words": _repeated(F.col("_words")).cast("long"),
    }).drop("_words", "_lines")


def _repeated(tokens: Column, n: int = WINDOW) -> Column:
    """Words inside windows of ``n`` words that occur twice or more in ``tokens``."""
    hashes = F.transform(tokens, lambda w: F.xxhash64(w))

    def windows(h: Column) -> Column:
        at = F.when(F.size(h) >= n, F.sequence(F.lit(0), F.size(h) - n)).otherwise(F.array().cast("array<int>"))
        return F.sort_array(F.transform(at, lambda i: F.struct(
            F.xxhash64(*[F.get(h, i + k) for k in range(n)]).alias("k"), i.alias("p"))))

    def marks(s: Column) -> Column:
        return F.sort_array(F.transform(
            F.filter(s, lambda x, i: (F.get(s, i - 1)["k"] == x["k"]) | F.coalesce(F.get(s, i + 1)["k"] == x["k"], F.lit(False))),
            lambda x: x["p"]))

    def covered(p: Column) -> Column:
        gaps = F.transform(p, lambda x, i: F.least(F.lit(n), F.coalesce(F.get(p, i + 1) - x, F.lit(n))))
        return F.aggregate(gaps, F.lit(0), lambda a, g: a + g)

    return let(hashes, lambda h: let(windows(h), lambda s: let(marks(s), covered)))


def judged(df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``df`` with the measures, each rule's ratio, ``base_failed`` and ``kept``."""
    out = measured(df, text)
    out = out.withColumns({r.name: F.coalesce(F.expr(f"try_divide({r.ratio.replace(' / ', ', ')})"), F.lit(0.0)) for r in rules})
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    passed = F.lit(True)
    for r in rules:
        passed = passed & F.col(r.name).between(r.low, r.high)
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & passed)
