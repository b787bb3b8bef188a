"""Lexicon text scorer (ENR-14), re-aimed from a per-row library call in the
producers to Spark jobs.

Row-local form (the default): tokens are an array expression, and an
Arrow-batched function with the lexicon (bounded: checked first) scores each
text where it lies: all tokens of a batch are one flat array, looked up and
summed at once. One scan, no exchange, and the same function scores a stream.
A token that the lexicon has more than once counts with its greatest valence.
:mod:`sentimart.operators.phrases` adds multi-word entries, boosters and
contrast clauses. Relational form, for a lexicon too large to ship:

    tokens zipped with the 3 previous tokens -> explode
      -> LEFT JOIN lexicon, keeping hits plus one row per text
      -> GROUP BY text id (partial aggregation collapses each text map-side)

Scores follow the published rule-based method: a negated valence is scaled
by -0.74; compound = s / sqrt(s^2 + 15) over the valence sum s; pos / neg /
neu are the shares of (v + 1), |v - 1| and neutral-token counts. Valences are
summed as integers (units of 1e-5), so results do not depend on summation
order or form. Equality with any particular library is not claimed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentimart.functions.numeric import half_up
from sentimart.functions.text import NEGATION_WINDOW, negated_by, previous, tokens
from sentimart.operators.joins import bounded_broadcast

# A small multilingual (token, valence) lexicon and negators.
LEXICON = [
    ("good", 1.9), ("great", 3.1), ("best", 3.2), ("love", 3.2), ("happy", 2.7),
    ("strong", 2.3), ("gain", 2.4), ("gains", 2.4), ("up", 0.6), ("buy", 0.9),
    ("win", 2.8), ("bull", 1.5), ("bullish", 2.1), ("moon", 1.8), ("profit", 2.1),
    ("bad", -2.5), ("terrible", -2.1), ("worst", -3.1), ("hate", -2.7), ("sad", -2.1),
    ("weak", -1.9), ("loss", -1.3), ("crash", -1.7), ("falling", -1.1), ("selling", -0.4),
    ("sell", -0.6), ("fear", -2.2), ("bear", -1.2), ("bearish", -2.0), ("scam", -2.9),
    ("bon", 1.9), ("bonne", 1.9), ("excellent", 3.0), ("mauvais", -2.5), ("peur", -2.2),
    ("gut", 1.9), ("schlecht", -2.5), ("angst", -2.2), ("gewinn", 2.3), ("verlust", -1.3),
    ("bueno", 1.9), ("buena", 1.9), ("malo", -2.5), ("mala", -2.5), ("miedo", -2.2),
    ("crisis", -3.1), ("success", 2.7), ("problem", -1.7), ("risk", -1.1), ("safe", 1.9),
]
NEGATORS = ["not", "no", "never", "none", "nobody", "cannot", "without",
            "pas", "jamais", "sans", "nicht", "kein", "keine", "nie", "nunca", "sin"]
NEGATION_SCALE_PCT = -74     # a negated valence is scaled by -0.74
ALPHA = 15.0                 # compound normalisation constant
UNIT = 100000                # integer valence units (1e-5)

SCORE_COLUMNS = ["sentiment_pos", "sentiment_neg", "sentiment_neu", "sentiment_compound"]


def lexicon_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON, "token string, valence double")


#: Lexicon entries that a scoring task holds, at most (about 100 bytes each).
MAX_LOCAL_ENTRIES = 500_000


def unambiguous(lexicon: DataFrame) -> DataFrame:
    """``(token, v)``, a row for each token: its greatest valence, in units of 1e-3."""
    return lexicon.groupBy("token").agg(F.max(F.round(F.col("valence") * 1000).cast("bigint")).alias("v"))


def local_lexicon(lexicon: DataFrame, most: int = MAX_LOCAL_ENTRIES) -> dict[str, int] | None:
    """token -> valence in units of 1e-3; None if there are more than ``most``."""
    rows = unambiguous(lexicon).limit(most + 1).collect()
    return {r.token: r.v for r in rows} if len(rows) <= most else None


#: Tokens that a scoring task looks up at once, but for a longer text (each takes some 100 bytes while it does).
SLICE_TOKENS = 200_000


def sliced(sums):
    """``sums`` (token lists -> SUMS of each) over a batch of any size, some texts at a time, so that a task's
    memory does not grow with the batch."""
    def parts(lists: pa.Array) -> pa.Array:
        ends = lists.offsets.to_numpy()
        out, low = [], 0
        while low < len(lists):
            high = max(int(np.searchsorted(ends, ends[low] + SLICE_TOKENS, "right")) - 1, low + 1)
            out.append(sums(lists.slice(low, high - low)))
            low = high
        return pa.concat_arrays(out) if out else sums(lists)
    return parts


SUMS = "s_u long, pos_u long, neg_u long, n_scored long, n_tokens long"


class Tokens:
    """The tokens of a batch of texts as one flat array."""

    def __init__(self, lists: pa.Array):
        self.values = lists.flatten()
        self.offsets = lists.offsets.to_numpy().astype(np.int64)
        self.offsets = self.offsets - self.offsets[0]
        self.sizes = np.diff(self.offsets)
        self.text = np.repeat(np.arange(len(self.sizes)), self.sizes)

    def places(self, words) -> np.ndarray:
        """Of each token its place in ``words`` (-1: not there)."""
        return pc.index_in(self.values, pa.array(words, pa.string())).fill_null(-1).to_numpy().astype(np.int64)

    def before(self, x: np.ndarray, k: int) -> np.ndarray:
        """``x`` of the token ``k`` places before each, 0 where the text has none."""
        out = np.zeros_like(x)
        same = self.text[k:] == self.text[:-k] if k < len(x) else np.zeros(0, bool)
        out[k:][same] = x[:-k][same] if k < len(x) else 0
        return out

    def negated(self) -> np.ndarray:
        """Is one of the NEGATION_WINDOW tokens before each a negator?"""
        found = self.places(NEGATORS) >= 0
        return np.logical_or.reduce([self.before(found, k) for k in range(1, NEGATION_WINDOW + 1)])

    def total(self, x: np.ndarray) -> np.ndarray:
        """Sums of ``x`` by text; whole numbers, so exact."""
        upto = np.concatenate([[0], np.cumsum(x, dtype=np.int64)])
        return upto[self.offsets[1:]] - upto[self.offsets[:-1]]

    def sums(self, v: np.ndarray, unit: int, tokens_of: np.ndarray | int = 1) -> pa.StructArray:
        """Columns SUMS from the valence at each token, which stands for ``tokens_of`` tokens."""
        columns = [v, np.where(v > 0, v + unit, 0), np.where(v < 0, v - unit, 0), (v != 0) * tokens_of]
        return pa.StructArray.from_arrays([pa.array(x) for x in [*map(self.total, columns), self.sizes]],
                                          [c.split()[0] for c in SUMS.split(", ")])


def sums_column(text_col: str, lexicon: dict[str, int]) -> Column:
    """The integer sums of one text, as a struct; needs nothing but the row."""
    words, valence = list(lexicon), np.array([*lexicon.values(), 0], np.int64)

    def sums(lists: pa.Array) -> pa.Array:
        t = Tokens(lists)
        v = valence[t.places(words)]  # -1, not found, is the last: 0
        return t.sums(v * np.where(t.negated(), NEGATION_SCALE_PCT, 100), UNIT)

    @F.arrow_udf(SUMS)
    def batch_sums(lists: pa.Array) -> pa.Array:
        return sliced(sums)(lists)

    return batch_sums(tokens(text_col))


def _scores(sums: str = "", unit: int = UNIT) -> list[Column]:
    """The scores from the integer sums (columns, or fields of ``sums``) in units of 1 / ``unit``."""
    f = lambda c: F.col(f"{sums}.{c}" if sums else c)
    s = f("s_u").cast("double") / F.lit(float(unit))
    neutral = (f("n_tokens") - f("n_scored")).cast("double")
    total = (f("pos_u") - f("neg_u")).cast("double") / F.lit(float(unit)) + neutral
    share = lambda x: F.when(total > 0, half_up(F.abs(x / total), 3)).otherwise(F.lit(0.0))
    return [
        share(f("pos_u").cast("double") / F.lit(float(unit))).alias("sentiment_pos"),
        share(f("neg_u").cast("double") / F.lit(float(unit))).alias("sentiment_neg"),
        share(neutral).alias("sentiment_neu"),
        half_up(s / F.sqrt(s * s + F.lit(ALPHA)), 4).alias("sentiment_compound"),
        f("n_tokens").alias("n_tokens"),
    ]


def attach_scores(df: DataFrame, id_cols: list[str], text_col: str,
                  lexicon: DataFrame | None = None, max_local: int = MAX_LOCAL_ENTRIES) -> DataFrame:
    """``df`` with the scores of ``text_col`` (batch or stream). A lexicon
    beyond ``max_local`` entries goes by the relational form, on ``id_cols``."""
    lexicon = lexicon if lexicon is not None else lexicon_table(df.sparkSession)
    held = local_lexicon(lexicon, max_local)
    if held is None:
        return df.join(relational_scores(df, id_cols, text_col, lexicon).drop("n_tokens"), on=id_cols, how="left")
    there = df.withColumn("_sums", sums_column(text_col, held))
    return there.select(*df.columns, *_scores("_sums")[:-1])


def score_texts(df: DataFrame, id_cols: list[str], text_col: str,
                lexicon: DataFrame | None = None, max_local: int = MAX_LOCAL_ENTRIES) -> DataFrame:
    """Scores per text: (id_cols..., sentiment_pos/neg/neu/compound, n_tokens)."""
    lexicon = lexicon if lexicon is not None else lexicon_table(df.sparkSession)
    held = local_lexicon(lexicon, max_local)
    if held is None:
        return relational_scores(df, id_cols, text_col, lexicon)
    return df.select(*id_cols, sums_column(text_col, held).alias("_sums")).select(*id_cols, *_scores("_sums"))


def relational_scores(df: DataFrame, id_cols: list[str], text_col: str,
                      lexicon: DataFrame | None = None, max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """The relational form of :func:`score_texts`.

    ``id_cols`` must identify a row. Every input row yields one output row
    (an empty text has no tokens and scores 0). One scan, one tokenising
    pass and one shuffle of a single partial row per text and task.
    """
    spark = df.sparkSession
    lex = lexicon if lexicon is not None else lexicon_table(spark)
    lex = unambiguous(lex).select(F.col("token").alias("lex_token"), F.col("v").alias("v_milli"))
    toks = df.select(*id_cols, tokens(text_col).alias("toks"))
    prev = [f"p{k}" for k in range(1, NEGATION_WINDOW + 1)]
    marked = toks.select(*id_cols, F.size("toks").alias("n_tok"),
                         F.arrays_zip(F.col("toks").alias("token"),
                                      *[previous("toks", k).alias(p) for k, p in enumerate(prev, 1)]).alias("z"))
    # posexplode_outer: a plain explode makes the optimiser infer size(z) > 0
    # and push it below the projections, re-evaluating the tokenising per
    # reference; outer also keeps texts without tokens (one NULL row).
    exploded = marked.select(*id_cols, "n_tok", F.posexplode_outer("z").alias("pos", "t")).select(
        *id_cols, "n_tok", "pos", F.col("t.token").alias("token"), *[F.col(f"t.{p}").alias(p) for p in prev])
    j = exploded.join(bounded_broadcast(lex, max_broadcast_rows),
                      exploded["token"] == F.col("lex_token"), "left")
    # keep lexicon hits plus one row per text (its first token) that carries
    # the in-row token count: the aggregate sees ~(texts + hits) rows, and
    # negation is decided for hits only
    j = j.filter(F.col("lex_token").isNotNull() | (F.coalesce(F.col("pos"), F.lit(0)) == 0))
    j = j.withColumn("neg", negated_by(prev, NEGATORS))
    v = (F.coalesce(F.col("v_milli"), F.lit(0))
         * F.when(F.col("neg"), F.lit(NEGATION_SCALE_PCT)).otherwise(F.lit(100)))
    g = j.select(*id_cols, "n_tok", v.alias("v")).groupBy(*id_cols).agg(
        F.sum("v").alias("s_u"),
        F.sum(F.when(F.col("v") > 0, F.col("v") + UNIT).otherwise(0)).alias("pos_u"),
        F.sum(F.when(F.col("v") < 0, F.col("v") - UNIT).otherwise(0)).alias("neg_u"),
        F.count_if(F.col("v") != 0).alias("n_scored"),
        F.max("n_tok").cast("bigint").alias("n_tokens"),
    )
    return g.select(*id_cols, *_scores())
