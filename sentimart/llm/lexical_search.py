"""Ranked lexical search: the best documents of each item, by presence masks.

Items are taken in blocks of bounded size. For a block, the documents are read
once and reduced to postings of the block's terms (term numbers and their
frequencies, and the document's length), written as a table; N, L and the
document frequencies are grouped sums over all documents. Each term then has an
integer weight, and each document an integer length norm.

Scoring goes over groups of DOCS documents. Every term has a bitmap of the
documents that hold it; the bitmaps of an item's terms, turned over, give each
document's mask of matched terms, and documents of one mask form a class. A
mask's maximum score is the sum over its terms of weight times the term's
highest impact in the group. Classes are evaluated by descending maximum; once
the k-th score so far lies above the next maximum, no later class can enter and
the item is finished. What is left, at most k rows an item and group, meets in a
ranking that Spark limits before its shuffle.

A document outside a group's best k is outside the item's best k, so results
are exact. No document is paired with an item outside the classes evaluated.

Defined results: a null or empty text has no terms and counts for nothing;
equal scores go by doc_id, null last; a repeated row is a document of its own;
rows that repeat an item_id are one item with the terms of all its texts (so
are rows of null item_id); an item without terms in any document has no rows;
empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentimart.llm.common import blocks_by_weight, text_of, written

K = 10
#: Documents whose postings and bitmaps are held at once in a task.
DOCS = 16_384
#: Term occurrences (over items) of a block: what the driver and each Python worker hold.
BLOCK_TERMS = 500_000
#: Classes evaluated at first; each next step takes twice as many.
FIRST = 32

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
#: What each byte of a text becomes: a term's byte (A-Z lower-cased) or a space.
BYTES = bytes(0x20 if b in _SEPARATORS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))

RESULT = "item_id long, doc_id long, score long"


def terms(raw: bytes) -> list[bytes]:
    """The terms of a UTF-8 text; bytes beyond ASCII belong to terms."""
    return raw.translate(BYTES).split()


def item_terms(items: DataFrame) -> DataFrame:
    """``(item_id, term)``, each once."""
    lower = F.translate(text_of("text"), ascii_uppercase, ascii_lowercase)
    return items.select(F.col("item_id").cast("long"), F.explode(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))).alias("term")).distinct()


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``(doc_id, n, term, tf)`` of documents with terms: arrays of the vocabulary's terms and frequencies."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("term", pa.list_(pa.int32())), ("tf", pa.list_(pa.int64()))])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.keys()
        for batch in batches:
            rows = []
            for doc_id, raw in zip(batch["doc_id"].to_pylist(), batch["raw"], strict=True):
                if said := terms(raw.as_py()):
                    count = Counter(said)
                    hits = sorted((vocabulary[t], count[t]) for t in known & count.keys())
                    rows.append((doc_id, len(said), [t for t, _ in hits], [f for _, f in hits]))
            columns = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

    raw = text_of("text").cast("binary").alias("raw")
    return docs.select(F.col("doc_id").cast("long"), raw).mapInArrow(find, "doc_id long, n long, term array<int>, tf array<long>")


def weights(posted: DataFrame, size: int) -> tuple[np.ndarray, int, int]:
    """The weight of each term number (0 where no document holds it), N and L."""
    n, total = posted.agg(F.count(F.lit(1)), F.sum("n")).first()
    df = posted.select(F.explode("term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(n).cast("double") + 2) / (2 * F.col("df").cast("double") + 1))).alias("w")
    out = np.zeros(size, np.int64)
    for term, w in df.select("term", weight).collect():  # one row a term of the block
        out[term] = w
    return out, n, total or 0


class Group:
    """Postings of some documents, by term."""

    def __init__(self, norm: np.ndarray, lengths: np.ndarray, term: np.ndarray, tf: np.ndarray, weight: np.ndarray):
        self.docs = len(norm)
        doc = np.repeat(np.arange(self.docs), lengths)
        order = np.argsort(term, kind="stable")  # documents ascend within a term
        self.doc, found = doc[order], term[order]
        tf = tf[order]
        self.score = weight[found] * (1_000_000_000 * tf // (1000 * tf + 8 * norm[self.doc]))
        edges = np.flatnonzero(np.diff(found, prepend=-1))
        self.span = dict(zip(found[edges].tolist(), zip(edges.tolist(), np.append(edges[1:], len(found)).tolist(), strict=True), strict=True))
        self.most = {t: int(self.score[a:b].max()) for t, (a, b) in self.span.items()}

    def masks(self, here: list[int]) -> np.ndarray:
        """Per document the mask of the terms ``here`` that it holds, in whole 64-bit words."""
        out = np.zeros((self.docs, -(-len(here) // 64) * 8), np.uint8)
        for start in range(0, len(here), 64):
            bitmaps = np.zeros((64, self.docs), np.uint8)
            for row, t in zip(bitmaps, here[start:start + 64], strict=False):
                a, b = self.span[t]
                row[self.doc[a:b]] = 1
            out[:, start // 8:start // 8 + 8] = np.packbits(bitmaps, axis=0).T
        return out

    def best(self, item: list[int], doc_id: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the ``k`` best documents for an item's terms, unordered; ``doc_id`` breaks ties."""
        here = [t for t in item if t in self.span]
        if not here:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        masks = self.masks(here)
        as_one = masks.view(np.uint64 if masks.shape[1] == 8 else np.dtype((np.void, masks.shape[1]))).ravel()
        _, first, class_of = np.unique(as_one, return_index=True, return_inverse=True)
        most = np.array([self.most[t] for t in here], np.int64)
        held = masks[first]
        bound = np.zeros(len(first), np.int64)
        for start in range(0, len(here), 64):
            bits = np.unpackbits(held[:, start // 8:start // 8 + 8], axis=1, count=min(64, len(here) - start))
            bound += bits @ most[start:start + 64]
        order = np.argsort(-bound, kind="stable")
        by_class = np.argsort(class_of, kind="stable")
        ends = np.cumsum(np.bincount(class_of, minlength=len(first)))
        at, scores, done, step = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, FIRST
        while done < len(order) and bound[order[done]] > 0 and (len(scores) < k or bound[order[done]] >= scores.min()):
            classes = order[done:done + step]
            docs = np.sort(np.concatenate([by_class[ends[c - 1] if c else 0:ends[c]] for c in classes]))
            sums = np.zeros(len(docs), np.int64)
            for t in here:
                a, b = self.span[t]
                place = np.searchsorted(self.doc[a:b], docs)
                hit = (place < b - a) & (self.doc[a:b][np.minimum(place, b - a - 1)] == docs)
                sums[hit] += self.score[a:b][place[hit]]
            at, scores = np.concatenate([at, docs[sums > 0]]), np.concatenate([scores, sums[sums > 0]])
            keep = np.lexsort((doc_id[at], -scores))[:k]
            at, scores, done, step = at[keep], scores[keep], done + step, 2 * step
        return at, scores


def scored(posted: DataFrame, items: dict, weight: np.ndarray, n: int, total: int, k: int, group: int) -> DataFrame:
    """``(item_id, doc_id, score)``: the best ``k`` of each group of documents for each item."""
    schema = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
    last = np.iinfo(np.int64).max  # null doc_id: behind all

    def search(held: pa.Table) -> pa.RecordBatch:
        ids, norm, lists, tf = (held[c].combine_chunks() for c in ("doc_id", "norm", "term", "tf"))
        order = ids.fill_null(last).to_numpy()
        some = Group(norm.to_numpy(), np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy().astype(np.int64),
                     tf.flatten().to_numpy(), weight)
        out: list[list] = [[], [], []]
        for item, numbers in items.items():
            at, scores = some.best(numbers, order, k)
            out[0] += [item] * len(at)
            out[1].append(at)
            out[2].append(scores)
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), ids.take(pa.array(np.concatenate(out[1]))),
                                           pa.array(np.concatenate(out[2]))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            while batch.num_rows:
                held.append(batch.slice(0, group - rows))
                rows += held[-1].num_rows
                batch = batch.slice(held[-1].num_rows)
                if rows == group:
                    yield search(pa.Table.from_batches(held))
                    held, rows = [], 0
        if rows:
            yield search(pa.Table.from_batches(held))

    norm = F.expr(f"10 + (90 * n * {n}L) div {max(total, 1)}L").alias("norm")
    return posted.where(F.size("term") > 0).select("doc_id", norm, "term", "tf").mapInArrow(run, RESULT)


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = K, group: int = DOCS, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of each item, rank from 1."""
    wanted = written(item_terms(items).groupBy("item_id").agg(F.collect_list("term").alias("terms")))
    found = None
    for block in blocks_by_weight(wanted, F.size("terms"), block_terms):
        rows = block.collect()  # at most block_terms terms, or one item
        vocabulary = {t: i for i, t in enumerate(sorted({t.encode() for r in rows for t in r.terms}))}
        numbers = {r.item_id: sorted(vocabulary[t.encode()] for t in r.terms) for r in rows}
        posted = written(postings(docs, vocabulary))
        part = written(scored(posted, numbers, *weights(posted, len(vocabulary)), k, group))
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], RESULT)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
