"""Substring dedup: repeats of ``LENGTH`` words or more, by seed and extend.

A window is LENGTH consecutive words of one document. It is a repeat if the
same words also start in a document with a smaller doc_id; all words that
repeats cover are removed, the windows being judged on the input.

Seed. Each document's word K-grams are hashed and winnowed: every window
elects the least of the K-grams inside it as its anchor, so equal windows have
equal anchors, and one anchor stands for a run of neighbouring windows
(a window has SPAN K-grams, so about 2 / (SPAN + 1) anchors fall on a word).
Documents are joined on anchors: each anchor's least and greatest doc_id show
whether another document has it, and only occurrences of those are seeds.

Extend. A seed is extended both ways over all words of its run. Seeds of one
anchor whose extensions agree are one branch, and a branch is worth its least
doc_id. Where that is the least of the anchor, the whole run is a repeat in
every other document of the branch, as no document before it has the anchor.
Other branches shrink: their windows, and those of the anchor in its least
document (which has all that its branches hold), are grouped word for word, and
a window's least doc_id decides. Neighbouring repeats join to maximal repeats.

Extensions and windows are compared by 95-bit hashes of their words' 64-bit
hashes.

No step pairs documents up: groups are reduced to a least and a greatest
doc_id (with map-side partial aggregation), and the joins back are on single
keys, which adaptive execution splits where a passage is very common. Steps
are written to the shared folder; shuffle files of finished steps are let go.

Defined results: a null text has no words; documents of fewer than LENGTH
words lose nothing; a row with null doc_id is neither removed from nor a
source; rows that repeat a doc_id don't remove from each other; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentimart.llm.common import text_of, written

LENGTH = 13
#: Words of an anchor.
K = 8
#: Windows looked at at once; positions inside a block take as many bits.
BLOCK_BITS = 20
#: A run of windows is one number: its first window, and how many.
RUN_BITS = 8
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
#: The second polynomial of a span; both bases are odd.
_BASE2, _MIX2 = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x94D049BB133111EB)


def hashed(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


def spans(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(64 bits, 31 bits)`` of the words from ``starts`` up to ``ends``: polynomials by sums of prefixes, scaled to the start."""
    out = []
    for base, own in ((_BASE, hashes), (_BASE2, (hashes ^ (hashes >> np.uint64(31))) * _MIX2)):
        powers = np.cumprod(np.r_[np.uint64(1), np.full(len(own), base)])
        inverse = np.cumprod(np.r_[np.uint64(1), np.full(len(own), np.uint64(pow(int(base), -1, 1 << 64)))])
        sums = np.r_[np.uint64(0), np.cumsum(own * inverse[:-1])]
        out.append(_mixed((sums[ends] - sums[starts]) * powers[starts]))
    return out[0].view(np.int64), (out[1] >> np.uint64(33)).astype(np.int32)


def runs(hashes: np.ndarray, length: int = LENGTH, k: int = K) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per block ``(anchor, first window, windows)`` of the runs of windows that elect one anchor, of a text's word hashes."""
    span, windows = length - k + 1, len(hashes) - length + 1
    for start in range(0, windows, (1 << BLOCK_BITS) - length):
        part = hashes[start:start + (1 << BLOCK_BITS) - 1]
        grams = _mixed(_grams(part, k))
        # Least hash first, then position: both in one number.
        least = (grams >> np.uint64(BLOCK_BITS) << np.uint64(BLOCK_BITS)) | np.arange(len(grams), dtype=np.uint64)
        done = 1
        while done < span:
            step = min(done, span - done)
            least = np.minimum(least[:-step], least[step:])
            done += step
        elected = (least & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)
        if start + (1 << BLOCK_BITS) - length < windows:  # the rest belongs to the next block
            elected = elected[:(1 << BLOCK_BITS) - length]
        first = np.flatnonzero(np.r_[True, elected[1:] != elected[:-1]])
        yield grams[elected[first]].view(np.int64), first + start, np.diff(np.r_[first, len(elected)])


def _grams(part: np.ndarray, k: int) -> np.ndarray:
    """The polynomial hash of every ``k`` neighbours, by doubling."""
    if k == 1:
        return part.copy()
    half = _grams(part, k // 2)
    n, step = len(part) - k + 1, k // 2
    power = np.uint64(pow(int(_BASE), step, 1 << 64))
    out = half[:n] * power + half[step:step + n]
    return out * _BASE + part[k - 1:] if k % 2 else out


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), t) for x, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def seeds(docs: DataFrame, length: int = LENGTH, k: int = K, extended: bool = False) -> DataFrame:
    """``(anchor, doc_id)`` of all anchors of ``docs(doc_id, version, raw)``.

    If ``extended`` also ``version``, the run, and the hash ``hi``, ``lo`` of all words that the run's windows cover.
    """
    schema = pa.schema([("anchor", pa.int64()), ("doc_id", pa.int64())])
    if extended:
        schema = pa.schema([*schema, ("version", pa.int64()), ("run", pa.int64()), ("hi", pa.int64()), ("lo", pa.int32())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            for doc_id, version, raw in zip(batch["doc_id"].to_pylist(), batch["version"].to_pylist(), batch["raw"], strict=True):
                tokens = raw.as_py().split()
                if len(tokens) < length:
                    continue
                hashes = hashed(tokens)
                for anchor, first, n in runs(hashes, length, k):
                    row = anchor, np.full(len(anchor), doc_id)
                    if extended:
                        low = int(first[0])
                        there = hashes[low:int(first[-1] + n[-1]) + length - 1]
                        row += np.full(len(anchor), version), first << RUN_BITS | n, *spans(there, first - low, first - low + n + length - 1)
                    out.append(row)
                    held += len(anchor)
                if held > 1 << 17:
                    yield _batch(out, schema)
                    out, held = [], 0
            if out:
                yield _batch(out, schema)

    return docs.mapInArrow(find, "anchor long, doc_id long" + (", version long, run long, hi long, lo int" if extended else ""))


def _windows(docs: DataFrame, length: int) -> DataFrame:
    """``(hi, lo, doc_id, version, at)`` of every window in ``runs`` of ``docs(doc_id, version, raw, runs)``."""
    schema = pa.schema([("hi", pa.int64()), ("lo", pa.int32()), *[(c, pa.int64()) for c in ("doc_id", "version", "at")]])

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, version, raw, found in zip(batch["doc_id"].to_pylist(), batch["version"].to_pylist(), batch["raw"], batch["runs"], strict=True):
                hashes = hashed(raw.as_py().split())
                found = np.unique(found.values.to_numpy(zero_copy_only=False))
                first, n = found >> RUN_BITS, found & ((1 << RUN_BITS) - 1)
                at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
                row = *spans(hashes, at, at + length), np.full(len(at), doc_id), np.full(len(at), version), at
                for low in range(0, len(at), 1 << 18):
                    yield _batch([tuple(x[low:low + (1 << 18)] for x in row)], schema)

    return docs.mapInArrow(shrink, "hi long, lo int, doc_id long, version long, at long")


def repeats(docs: DataFrame, length: int = LENGTH, k: int = K) -> DataFrame:
    """``(doc_id, version, runs)``: the windows of each document that start in one of smaller doc_id, as runs.

    ``docs(doc_id, version, raw)``; ``version`` tells texts of one doc_id apart.
    """
    if not 0 < k <= length or length - k + 1 >= 1 << RUN_BITS:
        raise ValueError("k must be from 1 to length, and near it")
    docs = docs.where("doc_id is not null")
    two = [F.min("doc_id").alias("least"), F.max("doc_id").alias("greatest")]
    shared = written(seeds(docs, length, k).groupBy("anchor").agg(*two).where("least < greatest").select("anchor", "least"), release=True)
    found = written(seeds(docs, length, k, extended=True).join(shared, "anchor"), release=True)
    # Branches that do not hold for the least document of their anchor.
    branch = ["anchor", "hi", "lo"]
    split = written(found.groupBy(*branch).agg(F.min("doc_id").alias("first"), F.min("least").alias("least")).where("first > least").select(*branch), release=True)
    asked = found.join(split.withColumn("open", F.lit(True)), branch, "left").where("doc_id > least").select(
        "doc_id", "version", "run", F.col("open").isNotNull().alias("open"))
    asked = written(asked, release=True)
    sources = found.where("doc_id = least").join(split.select("anchor").distinct(), "anchor", "left_semi").select("doc_id", "version", "run")
    opened = asked.where("open").drop("open").unionByName(sources).groupBy("doc_id", "version").agg(F.collect_set("run").alias("runs"))
    windows = written(_windows(docs.join(opened, ["doc_id", "version"]), length), release=True)
    first = written(windows.groupBy("hi", "lo").agg(*two).where("least < greatest").select("hi", "lo", "least"), release=True)
    late = windows.join(first, ["hi", "lo"]).where("doc_id > least").select("doc_id", "version", (F.shiftleft("at", RUN_BITS) + 1).alias("run"))
    late = late.unionByName(asked.where("not open").drop("open"))
    return written(late.groupBy("doc_id", "version").agg(F.collect_set("run").alias("runs")), release=True)


def versioned(docs: DataFrame) -> DataFrame:
    raw = text_of("text")
    return docs.select("doc_id", F.xxhash64(raw).alias("version"), raw.cast("binary").alias("raw"))


def covered(n: int, found: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Of ``n`` words, which ones the windows of the runs ``found`` cover."""
    first, windows = found >> RUN_BITS, found & ((1 << RUN_BITS) - 1)
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, first, 1)
    np.add.at(edges, first + windows + length - 1, -1)
    return np.cumsum(edges[:-1]) > 0


def kept_words(raw: bytes, found, length: int = LENGTH) -> tuple[int, int, bytes]:
    tokens = raw.split()
    if found is None or not len(found):
        return len(tokens), 0, b" ".join(tokens)
    gone = covered(len(tokens), np.asarray(found, np.int64), length)
    return len(tokens), int(gone.sum()), b" ".join([t for t, g in zip(tokens, gone.tolist(), strict=True) if not g])


def deduplicated(docs: DataFrame, length: int = LENGTH, k: int = K, digest: bool = False) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)`` of every row; ``kept_sha256`` for ``kept`` if ``digest``."""
    marked = versioned(docs)
    there = marked.join(repeats(marked, length, k), ["doc_id", "version"], "left")
    name = "kept_sha256" if digest else "kept"

    @F.pandas_udf(f"n_words long, n_removed long, {name} string")
    def cut(raw: pd.Series, found: pd.Series) -> pd.DataFrame:
        rows = [kept_words(r, x, length) for r, x in zip(raw, found, strict=True)]
        return pd.DataFrame([(n, gone, hashlib.sha256(kept).hexdigest() if digest else kept.decode()) for n, gone, kept in rows],
                            columns=["n_words", "n_removed", name])

    return there.select("doc_id", cut("raw", "runs").alias("x")).select("doc_id", "x.*")
