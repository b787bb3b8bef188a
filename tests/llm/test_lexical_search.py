"""Ranked lexical search against plain Python scores of every document."""

import math
import random
import re
from collections import Counter

import pytest

import brute  # noqa: F401  (puts this folder's helpers on the path)
from sentimart.llm import lexical_search as S
from sentimart.llm.common import blocks_by_weight, written
from sentimart.llm.oracle import ORACLE_SQL
from sentimart.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))


def slow(docs, items, k=10):
    counts = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, total = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, words in wanted.items():
        found = []
        for i, c in counts:
            m = 10 + 90 * c.total() * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in words if t in c)
            if s > 0:
                found.append((-s, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def compare(spark, docs, items, **options):
    frame = spark.createDataFrame([(i, t, 1, "clash") for i, t in docs], "doc_id long, text string, n int, term string")
    asked = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, doc_id string")
    got = S.ranked_documents(frame, asked, **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == slow(docs, items, options.get("k", 10))


def corpus(seed, n, vocabulary, longest=40):
    rng = random.Random(seed)
    words = [rng.choice(["w", "É", "Z", "ß9", "日"]) + str(i) for i in range(vocabulary)]
    draw = lambda size: rng.choice([" ", "-", "\n", "_"]).join(words[int(vocabulary * rng.random() ** 3)] for _ in range(size))
    return [(i, draw(rng.randint(0, longest))) for i in range(n)], [(k, draw(rng.randint(0, 12))) for k in range(12)]


@pytest.mark.parametrize("vocabulary, group", [(3, 7), (30, 64), (400, 16_384)])
def test_random(spark, vocabulary, group):
    docs, items = corpus(vocabulary, 300, vocabulary)
    compare(spark, docs, items, group=group)


def test_many_terms_and_blocks(spark):
    docs, items = corpus(5, 200, 600, longest=300)
    items += [(50, " ".join(t for _, t in docs[:40])), (51, " ".join(t for _, t in docs[60:80]))]
    compare(spark, docs, items, group=50, block_terms=40, k=3)


def test_odd_rows(spark):
    docs = [(None, "a b"), (None, "a b"), (3, None), (4, ""), (5, "..,;"), (6, "A B c"), (6, "a b C"), (7, "a b c"), (8, "a " * 50_000 + "b"), (9, "É é")]
    items = [(1, "a"), (1, "B"), (2, None), (3, "unknown"), (None, "c"), (None, "é"), (4, "")]
    compare(spark, docs, items)
    compare(spark, [], items)
    compare(spark, docs, [])
    compare(spark, [(1, None)], items)


def test_ties_by_doc_id(spark):
    docs = [(i, "same words here") for i in range(500, 0, -1)] + [(1000 + i, f"other{i}") for i in range(600)]
    compare(spark, docs, [(1, "same words"), (2, "here other3")], group=64)


def test_later_classes_are_left_alone():
    """Classes whose maximum lies under the k-th score are not evaluated."""
    import numpy as np
    rng = random.Random(1)
    rows = [sorted(rng.sample(range(12), rng.randint(1, 4))) for _ in range(3000)]
    weight = np.array([2**t for t in range(12)], np.int64)
    flat = np.array([t for r in rows for t in r], np.int64)
    group = S.Group(np.full(3000, 50, np.int64), np.array(list(map(len, rows))), flat, np.ones(len(flat), np.int64), weight)
    asked = []
    find = np.searchsorted
    try:
        np.searchsorted = lambda a, v: (asked.append(len(v)), find(a, v))[1]
        at, scores = group.best(list(range(12)), np.arange(3000), 10)
    finally:
        np.searchsorted = find
    impact = 10**9 // (1000 + 8 * 50)
    want = sorted(((-sum(2**t for t in r) * impact, i) for i, r in enumerate(rows)))[:10]
    assert sorted(zip((-scores).tolist(), at.tolist(), strict=True)) == want
    assert sum(asked) / 12 < 1000


def test_blocks_hold_every_row(spark):
    df = written(spark.range(500).selectExpr("id", "id % 7 + 1 AS size").unionByName(spark.createDataFrame([(1000, 900)], "id long, size long")))
    parts = [sorted(tuple(r) for r in b.collect()) for b in blocks_by_weight(df, df["size"], 60)]
    assert sorted(r for p in parts for r in p) == sorted(tuple(r) for r in df.collect())
    assert all(len(p) == 1 or sum(s for _, s in p) <= 60 for p in parts) and len(parts) > 30


def test_query_equals_sql(spark, duck):
    got = sorted(tuple(r) for r in QUERIES["op12_lexical_search"](spark, SMALL).collect())
    assert got == sorted(duck.execute(ORACLE_SQL["op12_lexical_search"]).fetchall())
