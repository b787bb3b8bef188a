"""Substring dedup against a dictionary of all windows."""

import random

import numpy as np
import pytest

import brute
from sentimart.llm import substring_dedup as S

DOCS = "doc_id long, text string, version string, raw string"


def slow(rows, n=13):
    first = {}
    split = [(i, brute.words(t)) for i, t in rows]
    for i, w in split:
        for a in range(len(w) - n + 1):
            if i is not None:
                key = tuple(w[a:a + n])
                first[key] = min(i, first.get(key, i))
    out = []
    for i, w in split:
        gone = set()
        for a in range(len(w) - n + 1):
            if i is not None and first[tuple(w[a:a + n])] < i:
                gone |= set(range(a, a + n))
        out.append((str(i), len(w), len(gone), " ".join(x for a, x in enumerate(w) if a not in gone)))
    return sorted(out)


def compare(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], DOCS)
    got = S.deduplicated(docs, **options).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in got) == slow(rows, options.get("length", 13))
    digests = S.deduplicated(docs, digest=True, **options).collect()
    assert sorted((str(r.doc_id), r.kept_sha256) for r in digests) == sorted((i, brute.sha(k)) for i, _, _, k in slow(rows, options.get("length", 13)))


def texts(rng, n, vocabulary):
    words = [f"w{i}" for i in range(vocabulary)]
    passages = [[rng.choice(words) for _ in range(rng.randint(5, 60))] for _ in range(12)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 6)):
            p = list(rng.choice(passages)) if rng.random() < 0.6 else [rng.choice(words) for _ in range(rng.randint(1, 40))]
            if rng.random() < 0.3 and p:
                p[rng.randrange(len(p))] = rng.choice(words)
            parts += p
        out.append(rng.choice([" ", "\n", "\t \x0b"]).join(parts))
    return out


@pytest.mark.parametrize("vocabulary", [2, 400])
def test_random_texts(spark, vocabulary):
    rng = random.Random(vocabulary)
    compare(spark, list(enumerate(texts(rng, 90, vocabulary))))


def test_odd_rows(spark):
    rng = random.Random(9)
    long = " ".join(f"v{rng.randrange(500)}" for _ in range(3000))
    twelve, thirteen = " ".join("abcdefghijkl"), " ".join("abcdefghijklm")
    rows = [(1, None), (2, ""), (3, twelve), (4, twelve), (5, thirteen), (6, thirteen), (6, thirteen), (6, "x " + thirteen), (None, thirteen),
            (7, long), (8, long[200:]), (0, "q " * 30), (9, "q " * 30), (10, "q " * 13 + "é b"), (11, "Q " * 30)]
    compare(spark, rows)


def test_other_lengths_and_blocks(spark, monkeypatch):
    compare(spark, list(enumerate(texts(random.Random(4), 40, 50))), length=5, k=2)


def test_runs_cover_each_window_once_across_blocks(monkeypatch):
    monkeypatch.setattr(S, "BLOCK_BITS", 6)
    rng = random.Random(2)
    tokens = [str(rng.randrange(30)).encode() for _ in range(700)]
    found = list(S.runs(S.hashed(tokens)))
    seen = [w for _, first, n in found for a, m in zip(first.tolist(), n.tolist()) for w in range(a, a + m)]
    assert seen == list(range(700 - 12))
    anchor = {}
    for h, first, n in found:
        for x, a, m in zip(h.tolist(), first.tolist(), n.tolist()):
            for w in range(a, a + m):
                assert anchor.setdefault(tuple(tokens[w:w + 13]), x) == x


def test_spans_tell_words_apart():
    """Equal words have equal hashes wherever they stand; the sums of prefixes wrap around."""
    rng = random.Random(5)
    tokens = [rng.choice([b"a", b"b"]) for _ in range(4000)]
    starts = np.array([rng.randrange(3900) for _ in range(3000)])
    ends = starts + np.array([rng.randint(1, 18) for _ in range(3000)])
    keys = {}
    for s, e, *key in zip(starts.tolist(), ends.tolist(), *(x.tolist() for x in S.spans(S.hashed(tokens), starts, ends))):
        assert keys.setdefault(tuple(tokens[s:e]), key) == key
    assert len({tuple(x) for x in keys.values()}) == len(keys)
    assert len({x[0] for x in keys.values()}) == len(keys)


def test_branches_shrink(spark, monkeypatch):
    """One anchor in three contexts: whole extensions agree for some, only a window or two for others."""
    middle = "m0 m1 m2 m3 m4 m5 m6 m7 m8 m9 m10 m11 m12 m13"
    rows = [(9, f"a b c d e f {middle} x y z u v w"), (3, f"a b c d e f {middle} 1 2 3 4 5 6"), (5, f"7 8 9 10 11 12 {middle} x y z u v w"),
            (7, f"a b c d e f {middle} x y z u v w"), (8, f"{middle}"), (4, f"q q q c d e f {middle} x y r r r")]
    compare(spark, rows)
    calls = []
    whole = S._windows
    monkeypatch.setattr(S, "_windows", lambda docs, length: calls.append(docs) or whole(docs, length))
    long = " ".join(f"t{i}" for i in range(400))
    compare(spark, [(i, long) for i in range(6)])  # copies agree as a whole: no window is looked at
    assert calls and all(c.count() == 0 for c in calls)


def test_empty(spark):
    assert S.deduplicated(spark.createDataFrame([], DOCS)).count() == 0
