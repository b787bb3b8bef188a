"""SimHash classes against a brute force over all pairs."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from sentimart.llm import simhash_dedup as S
from sentimart.llm.common import components

SCHEMA = "doc_id long, text string, extra string"


def slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_classes(rows):
    """rows: (doc_id, unsigned fingerprint) -> smallest doc_id reachable, by all pairs."""
    left, out = list(range(len(rows))), {}
    while left:
        group, todo = set(), [left[0]]
        while todo:
            i = todo.pop()
            if i in group:
                continue
            group.add(i)
            todo += [j for j in left if j not in group and (rows[i][1] ^ rows[j][1]).bit_count() <= 3]
        ids = [rows[i][0] for i in group if rows[i][0] is not None]
        out.update({i: min(ids, default=None) for i in group})
        left = [i for i in left if i not in group]
    return out


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_and_classes(spark):
    base = "The quick brown fox jumps over a lazy dog while many other animals look on " * 8
    texts = [base, base + "today", base.upper(), None, "", " \t\n", "one", "One", "two words", "Ünïcode ÀB c d", base + "x y",
             base, "alpha\x0bbeta\x0cgamma\x85delta\xa0eps zeta eta"]
    rows = [(i, t, "e") for i, t in enumerate(texts)] + [(None, "one", "e"), (None, "nobody has this", "e"), (0, base, "e")]
    got = S.classes(spark.createDataFrame(rows, SCHEMA)).collect()
    marked = [(r[0], slow_fingerprint(r[1])) for r in rows]
    want = slow_classes(marked)
    assert sorted(map(str, [(r.doc_id, r.fp, r.component_id) for r in got])) == sorted(
        map(str, [(marked[i][0], signed(marked[i][1]), want[i]) for i in range(len(rows))]))


@pytest.mark.parametrize("bucket", [0, 2, 64])
def test_links_lose_nothing(spark, bucket):
    rng = random.Random(bucket)
    fps = {rng.getrandbits(64) for _ in range(40)}
    for centre in list(fps)[:4]:
        for _ in range(30):
            near = centre
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 4, 6])):
                near ^= 1 << b
            fps.add(near)
    rows = [(i, fp) for i, fp in enumerate(sorted(fps))]
    edges = S.links(spark.createDataFrame([(signed(fp),) for _, fp in rows], "fp long"), bucket)
    back = {signed(fp): i for i, fp in rows}
    pairs = [(back[r.u], back[r.v]) for r in edges.distinct().collect()]
    assert all((rows[i][1] ^ rows[j][1]).bit_count() <= 3 for i, j in pairs)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in pairs:
        i, j = find(i), find(j)
        root[max(i, j)] = min(i, j)
    assert {i: find(i) for i in range(len(rows))} == slow_classes(rows)


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 90), (90, 95), (7, 7)] + [(200, 201)] * 3
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 90, 90: 90, 95: 90, 200: 200, 201: 200}


def test_deduplicated_keeps_one_row_and_all_columns(spark):
    rows = [(3, "a b c d", "x"), (1, "a b c d", "y"), (1, "a b c d", "z"), (None, "a b c d", "n"), (9, "far off text here", "q")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit(1.5))
    got = S.deduplicated(docs)
    assert got.columns == docs.columns
    assert sorted((str(r.doc_id), r.extra) for r in got.collect()) == [("1", "y"), ("9", "q"), ("None", "n")]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert S.classes(empty).count() == 0
    assert S.deduplicated(empty).count() == 0
