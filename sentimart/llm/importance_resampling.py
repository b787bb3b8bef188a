"""Quality classifier by importance resampling of hashed n-gram models.

Two bag-of-n-grams models over hashed words and word pairs are counted: one of
the raw corpus (every document) and one of the target, the labelled documents
of good quality. A document's log-weight is the mean over its n-grams of
log p_target - log p_raw, times ``EFFECTIVE`` (the log importance of a text of
so many n-grams; without it, length would outweigh quality). Documents are
sampled without replacement in proportion to their weights: Gumbel noise is
added to the log-weights and the top k stay.

k is fitted: half of the labelled sample trains the target model, and the
other half shows the log-weight that ``KEEP`` of the good documents reach; k is
the number of documents in the corpus that reach it.

Toxic documents are judged by their strongest n-grams, as a few words in a long
text hardly move its mean. A second ratio of hashed n-grams (lower case, no
ASCII punctuation; by the share of texts that have them) is that of the
labelled toxic rows to the target rows of the fit. Only n-grams that are
significantly more frequent in toxic texts count (``CHANCE`` such n-grams at
most are expected by chance). A document's toxicity is the sum of its
``STRONGEST`` largest log-ratios; documents above the toxicity that ``KEEP`` of
the other half of the good documents stay within are toxic, and k and the top
k are taken among the rest.

Raw counts cover all documents. Labelled rows are a bounded sample by hash
(``LABELLED``); the models have 2 * ``BUCKETS`` entries whatever the corpus. The
top k is found without collecting scores: they are range-partitioned, and the
k-th score is the threshold (equal scores at it all stay).

Defined results: a null text is empty; a text without words has log-weight 0;
without labelled good documents nothing is rejected, and without enough toxic
ones for a significant n-gram nothing is toxic; a document labelled twice
has the worse label; null ids are scored like any other and have no label;
repeated rows get equal scores; an empty table gives an empty result; an input
column named like an output column is replaced.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentimart.llm.common import ranked, text_of, written

#: Buckets of words, and again of word pairs.
BUCKETS = 1 << 16
#: Pseudo-count of a bucket, in counts of the target model.
SMOOTHING = 5.0
EFFECTIVE = 200.0
KEEP = 0.998
#: Labelled documents used at most, by hash of their ids.
LABELLED = 40_000
SEED = 7
#: Toxic n-grams expected by chance at most, and how many of a document's strongest are summed.
CHANCE, STRONGEST = 1.0, 3
#: n-grams counted at once.
BLOCK = 1 << 20


_SHIFT = np.uint64(64 - (BUCKETS.bit_length() - 1))
#: Lower case, and ASCII punctuation as spaces.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words, and of the word pairs, of a text."""
    tokens = raw.split()
    a = np.fromiter(map(zlib.crc32, tokens), np.uint64, len(tokens))
    one = a * np.uint64(0x9E3779B97F4A7C15)
    return one, (one[:-1] + a[1:]) * np.uint64(0xBF58476D1CE4E5B9)


def ngrams(raw: bytes) -> np.ndarray:
    """Buckets of the words and word pairs of a text."""
    one, two = hashes(raw)
    return np.concatenate([one >> _SHIFT, (two >> _SHIFT) + np.uint64(BUCKETS)]).astype(np.int64)


def compared(raw: bytes) -> np.ndarray:
    """The distinct n-grams of a text that its toxicity is judged by, as 64-bit hashes in order."""
    return np.unique(np.concatenate(hashes(raw.translate(_LETTERS))))


def sampled(labels: DataFrame, most: int = LABELLED) -> DataFrame:
    """``(doc_id, quality, toxic)``: a bounded sample of the labelled documents."""
    one = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    return one.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(most)


def good_of(sample: DataFrame) -> DataFrame:
    return sample.where("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id", (F.xxhash64("doc_id") % 2 == 0).alias("fits"))


def labelled(labels: DataFrame, most: int = LABELLED) -> DataFrame:
    """``(doc_id, fits)`` of the good documents among a bounded sample of labels; half of them fit the model."""
    return good_of(sampled(labels, most))


def counted(docs: DataFrame, good: DataFrame) -> np.ndarray:
    """``[raw, target]`` counts of all buckets. ``good`` is bounded by LABELLED."""
    fit = good.where("fits").select(F.col("doc_id").alias("_good"))
    rows = docs.select("doc_id", text_of("text").cast("binary").alias("raw")).join(
        F.broadcast(fit), F.col("doc_id") == F.col("_good"), "left").select("raw", F.col("_good").isNotNull().alias("target"))
    size = 2 * BUCKETS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, held = np.zeros((2, size), np.int64), ([], [])
        for batch in batches:
            for own, target in zip(batch["raw"], batch["target"].to_pylist(), strict=True):
                for which in (0, 1) if target else (0,):
                    held[which].append(ngrams(own.as_py()))
                    if sum(map(len, held[which])) > BLOCK or len(held[which]) > 2000:
                        totals[which] += np.bincount(np.concatenate(held[which]), minlength=size)
                        held[which].clear()
        for which in (0, 1):
            if held[which]:
                totals[which] += np.bincount(np.concatenate(held[which]), minlength=size)
        some = np.flatnonzero(totals[0])
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (some, totals[0][some], totals[1][some])], names=["bucket", "raw", "target"])

    sums = rows.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    got = sums.toPandas()  # 2 * BUCKETS rows at most
    out = np.zeros((2, size))
    out[:, got["bucket"].to_numpy()] = got[["raw", "target"]].to_numpy().T
    return out


def log_ratios(counts: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """log p_target - log p_raw of each bucket, by kind of n-gram; raw counts are scaled to the target's before smoothing."""
    out = np.zeros(counts.shape[1])
    for part in (slice(0, BUCKETS), slice(BUCKETS, None)):
        raw, target = counts[:, part]
        if target.sum():
            out[part] = np.log(target + smoothing) - np.log(raw * (target.sum() / raw.sum()) + smoothing)
    return out.astype(np.float32)


class Markers(NamedTuple):
    """Hashes of the n-grams that tell toxic texts, in order, and their log p_toxic - log p_target."""

    keys: np.ndarray
    ratios: np.ndarray


def _texts_with(rows: DataFrame, among: np.ndarray | None = None) -> DataFrame:
    """``(key, n)``: in how many of the texts ``raw`` an n-gram is; those of ``among`` (in order) only."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [compared(x.as_py()) for x in batch["raw"]]
            if among is not None:
                held = [np.intersect1d(x, among, assume_unique=True) for x in held]
            keys, n = np.unique(np.concatenate([np.empty(0, np.uint64), *held]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])

    return rows.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def markers(docs: DataFrame, sample: DataFrame) -> Markers:
    """The n-grams that toxic rows of ``sample`` have significantly more often than the target rows of the fit."""
    marked = sample.where("toxic = 1").select("doc_id", F.lit(True).alias("bad")).unionByName(
        good_of(sample).where("fits").select("doc_id", F.lit(False).alias("bad"))).withColumnRenamed("doc_id", "_marked")
    rows = written(docs.select("doc_id", text_of("text").cast("binary").alias("raw")).join(
        F.broadcast(marked), F.col("doc_id") == F.col("_marked")).select("raw", "bad"))
    bad, clean = rows.where("bad"), rows.where("not bad")
    n, m = bad.count(), clean.count()
    none = Markers(np.empty(0, np.uint64), np.empty(0))
    if not n or not m:
        return none
    seen = written(_texts_with(bad))
    p = n / (n + m)
    chance = math.log(max(seen.count(), 1) / CHANCE)
    found = seen.where(F.col("n") >= max(2, math.ceil(chance / -math.log(p)))).toPandas()  # fewer would not do even if no clean text had it
    order = np.argsort(keys := found["key"].to_numpy(np.int64).view(np.uint64))
    keys, t = keys[order], found["n"].to_numpy(np.float64)[order]
    if not len(keys):
        return none
    got, c = _texts_with(clean, keys).toPandas(), np.zeros(len(keys))
    c[np.searchsorted(keys, got["key"].to_numpy(np.int64).view(np.uint64))] = got["n"]
    share = t / (t + c)
    with np.errstate(divide="ignore", invalid="ignore"):
        tail = (t + c) * (share * np.log(share / p) + np.where(c > 0, (1 - share) * np.log((1 - share) / (1 - p)), 0))  # Hoeffding
    some = (share > p) & (tail >= chance)
    ratios = np.log((t + 0.5) / (n + 1)) - np.log((c + 0.5) / (m + 1))
    return Markers(keys[some], ratios[some])


def weighed(text: str | Column, ratios: np.ndarray, marks: Markers) -> Column:
    """``log_weight`` and ``toxicity`` of a text, as a struct."""
    table, keys, strengths = ratios, marks.keys, marks.ratios
    flags = np.zeros(BUCKETS, bool)
    flags[keys >> _SHIFT] = True

    def toxicity(raw: bytes) -> float:
        found = np.concatenate(hashes(raw.translate(_LETTERS)))
        found = np.unique(found[flags[found >> _SHIFT]])
        at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
        return float(np.sort(strengths[at[keys[at] == found]])[-STRONGEST:].sum())

    @F.pandas_udf("log_weight double, toxicity double")
    def weigh(raw: pd.Series) -> pd.DataFrame:
        weights = []
        for x in raw:
            found = ngrams(x)
            weights.append(EFFECTIVE * float(table[found].mean(dtype=np.float64)) if len(found) else 0.0)
        return pd.DataFrame({"log_weight": weights, "toxicity": [toxicity(x) if len(keys) else 0.0 for x in raw]}, dtype="float64")

    both = weigh(text_of(text).cast("binary"))
    return F.struct(F.round(both["log_weight"], 9).alias("log_weight"), F.round(both["toxicity"], 9).alias("toxicity"))


def gumbel(seed: int = SEED) -> Column:
    """Gumbel noise of a row, from its id and text."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


class Sampler(NamedTuple):
    """What a fit gives: the n-gram ratios, toxic n-grams, the score that the top k reach, the largest toxicity, and all scores."""

    ratios: np.ndarray
    marks: Markers
    threshold: float
    most_toxic: float
    scores: DataFrame


def fitted(docs: DataFrame, labels: DataFrame, keep: float = KEEP, most: int = LABELLED) -> Sampler | None:
    """The sampler of ``docs``; None if no good document is labelled. ``scores`` has a row per document."""
    sample = written(sampled(labels, most))
    good = written(good_of(sample))
    ratios, marks = log_ratios(counted(docs, good)), markers(docs, sample)
    scores = written(docs.select("doc_id", weighed("text", ratios, marks).alias("x"), gumbel().alias("noise")).select("doc_id", "x.*", "noise")
                     .withColumn("score", F.col("log_weight") + F.col("noise")), release=True)
    held = scores.join(F.broadcast(good.where("not fits")), "doc_id")
    cut, most_toxic = held.agg(F.percentile("log_weight", F.lit(1 - keep)), F.expr(f"percentile_disc({keep}) WITHIN GROUP (ORDER BY toxicity)")).first()
    if cut is None:
        return None
    pool = scores.where(F.col("toxicity") <= most_toxic)
    k = pool.where(F.col("log_weight") >= cut).count()
    if not k:
        return Sampler(ratios, marks, float("inf"), most_toxic, scores)
    order = ranked(pool.select("score"), [F.col("score").desc()], "place")
    return Sampler(ratios, marks, order.where(F.col("place") == k - 1).first()["score"], most_toxic, scores)


def judged(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``(doc_id, log_weight, score, kept, toxic)`` of every row of ``docs``; ``kept`` is the verdict on quality alone."""
    found = fitted(docs, labels, **options)
    if found is None:
        return docs.select("doc_id", F.lit(0.0).alias("log_weight"), F.lit(0.0).alias("score"), F.lit(True).alias("kept"), F.lit(False).alias("toxic"))
    return found.scores.select("doc_id", "log_weight", "score", (F.col("score") >= found.threshold).alias("kept"),
                               (F.col("toxicity") > found.most_toxic).alias("toxic"))


def accepted(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the sampler takes and that are not toxic, all columns. Scores again rather than shuffle texts."""
    found = fitted(docs, labels, **options)
    if found is None:
        return docs
    x = weighed("text", found.ratios, found.marks)
    return docs.where((x["log_weight"] + gumbel() >= found.threshold) & (x["toxicity"] <= found.most_toxic))
