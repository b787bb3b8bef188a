"""The mode over an open value set: bounded partials, exact result."""

import random
from collections import Counter

import pytest

from sentimart.operators import mode as M


@pytest.mark.parametrize("seed, k", [(1, 1), (2, 3), (3, 50)])
def test_equals_counting_everything(spark, seed, k):
    rng = random.Random(seed)
    rows = [(b, f"g{int(9 * rng.random() ** 3)}", rng.choice(["hot"] * 6 + [f"v{int(40 * rng.random() ** 2)}", None])) for b in range(4) for _ in range(400)]
    rows += [(0, "only null", None), (1, "spread", "a"), (2, "spread", "b"), (3, "spread", "b")]
    rows += [(b, "tail", f"t{b}{i}") for b in range(4) for i in range(30) for _ in range(2)] + [(b, "tail", "z") for b in range(4)]  # z is in no summary
    df = spark.createDataFrame(rows, "b int, g string, v string")
    parts = None
    for b in range(4):
        p = M.summaries(df.where(f"b = {b}"), ["g"], "v", k).selectExpr("*", f"{b} AS part")
        assert all(r["count"] <= k for r in p.groupBy("g").count().collect())  # bounded
        parts = p if parts is None else parts.unionByName(p)
    want = {}
    for g in {g for _, g, v in rows if v}:
        c = Counter(v for _, x, v in rows if x == g and v)
        want[g] = min((-n, v) for v, n in c.items())
    got = {r.g: (-r.n, r.value) for r in M.mode_of(df, parts, ["g"], "v", "part").collect()}
    assert got == want and got["tail"] == (-4, "z")
    can = {r.g for r in M.contenders(parts, ["g"], "part").where("value is null").collect()}
    assert "tail" in can if k < 30 else "tail" not in can
    if k == 3:
        assert "g0" not in can  # a clear winner: the second pass looks at listed values only
