"""Tokenising and negation marks as array expressions (in-row, no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters of any script form a token; everything else separates tokens, so
# accented and non-Latin letters stay inside words. (Java regex syntax.)
TOKEN_SPLIT = r"[^\p{L}]+"
NEGATION_WINDOW = 3


def tokens(text) -> Column:
    """Lower-cased letter runs of the whole text, empty pieces removed
    (``array_remove`` is a codegen'd builtin, no lambda)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.lower(F.coalesce(c, F.lit(""))), TOKEN_SPLIT), "")


def previous(toks: str, k: int) -> Column:
    """For every token, the token ``k`` positions before it (NULL for the
    first ``k``): the array shifted right — slice/concat/array_repeat are
    codegen'd builtins, linear in the text length, no lambdas."""
    return F.expr(f"slice(concat(array_repeat(CAST(NULL AS STRING), {k}), {toks}), 1, size({toks}))")


def negated_by(prev_cols: list[str], negators: list[str]) -> Column:
    """Is any of the previous-token columns a negator? (NULL counts as no)"""
    cond = None
    for c in prev_cols:
        x = F.col(c).isin(negators)
        cond = x if cond is None else (cond | x)
    return F.coalesce(cond, F.lit(False))
