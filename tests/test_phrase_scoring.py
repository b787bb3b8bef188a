"""Phrase, booster and contrast rules against a plain per-token version."""

import random

import pyarrow as pa
import pytest

from sentimart.operators import phrases as PH
from sentimart.operators import scoring as SCO

U = PH.UNIT_BOOSTED


def slow(toks, entries, boosters, contrast):
    """The sums of one text by the rules, token by token."""
    best = {}
    for i in range(len(toks)):
        for k in range(1, 5):
            e = " ".join(toks[i:i + k])
            if i + k <= len(toks) and e in entries:
                best[i] = (k, entries[e])
    beaten = {i for i, (k, _) in best.items() for j, (m, _) in best.items()
              if i != j and j < i + k and i < j + m and (m > k or m == k and j < i)}
    turn = next((i for i, t in enumerate(toks) if t in contrast), None)
    s = pos = neg = n = 0
    for i, (k, v) in best.items():
        if i in beaten or v == 0:
            continue
        b = sum(boosters.get(toks[i - d], 0) * pct for d, pct in ((1, 100), (2, 95), (3, 90)) if i - d >= 0)
        v = (v * 100 + (b if v > 0 else -b)) * (-74 if any(t in SCO.NEGATORS for t in toks[max(i - 3, 0):i]) else 100)
        v *= 100 if turn is None or i == turn else 50 if i < turn else 150
        if v:
            s, n = s + v, n + k
            pos, neg = (pos + v + U, neg) if v > 0 else (pos, neg + v - U)
    return s, pos, neg, n, len(toks)


@pytest.mark.parametrize("seed", range(6))
def test_random_batches(seed):
    rng = random.Random(seed)
    words = ["a", "b", "c", "d", "not", "very", "but"]
    entries = {" ".join(rng.choices(words, k=rng.randint(1, 4))): rng.randint(-30, 30) * 100 for _ in range(25)}
    boosters, contrast = {"very": 293, "d": -293}, {"but"}
    texts = [rng.choices(words, k=rng.choice([0, 1, 2, 5, 40])) for _ in range(200)]
    trie = PH.Trie(entries)
    lists = pa.array(texts, pa.list_(pa.string()))
    for part in (lists, lists.slice(50, 100)):
        t = SCO.Tokens(part)
        length, _ = trie.longest(t)
        want = [slow(x, entries, boosters, contrast) for x in part.to_pylist()]
        assert len(length) == sum(map(len, part.to_pylist()))
        assert _run(entries, boosters, ["but"], part) == want


def _run(entries, boosters, contrast, lists):
    """What the column's function computes, without a session."""
    held = {}
    with pytest.MonkeyPatch.context() as m:
        m.setattr(PH.F, "arrow_udf", lambda schema: lambda f: (held.setdefault("f", f), lambda c: None)[1])
        m.setattr(PH, "tokens", lambda c: c)
        PH.sums_column("x", entries, boosters, contrast)
    return [tuple(r.values()) for r in held["f"](lists).to_pylist()]


def test_rules_one_by_one():
    e = {"good": 1900, "not good": -2000, "good news today": 1000, "bad": -2500}
    run = lambda text, **o: _run(e, o.get("b", {}), o.get("c", []), pa.array([text.split()], pa.list_(pa.string())))[0]
    assert run("good")[:1] == (1900 * 10**6,)
    assert run("not good x")[0] == -2000 * 10**6                          # the longer entry, not a negated word
    assert run("not good news today")[0] == 1000 * 100 * -74 * 100        # a longer one beats it, and is negated
    assert run("very very good", b={"very": 293})[0] == (190000 + 293 * 195) * 10**4
    assert run("very bad", b={"very": 293})[0] == -(250000 + 293 * 100) * 10**4
    assert run("good but bad", c=["but"])[0] == (1900 * 50 - 2500 * 150) * 10**4
    assert run("a b")[:] == (0, 0, 0, 0, 2) and run("") == (0, 0, 0, 0, 0)


def test_a_token_given_twice_scores_alike_in_both_forms(spark):
    lex = spark.createDataFrame([("good", 1.0), ("good", 2.0), ("bad", -2.0), ("bad", -1.0)], "token string, valence double")
    df = spark.createDataFrame([(1, "good day"), (2, "bad day"), (3, None)], "id long, text string")
    local = sorted(map(tuple, SCO.score_texts(df, ["id"], "text", lex).collect()))
    assert local == sorted(map(tuple, SCO.score_texts(df, ["id"], "text", lex, max_local=1).collect()))
    assert local[0][4] == 0.4588 and local[1][4] == -0.25


def test_entry_tables_are_bounded(spark):
    df = spark.createDataFrame([(1, "good")], "id long, text string")
    e = spark.createDataFrame([("good", 1.0), ("so good", 2.0), ("  ", 9.0)], "entry string, valence double")
    with pytest.raises(ValueError, match="entries"):
        PH.phrase_scores(df, ["id"], "text", e, PH.booster_table(spark), most=2)
    assert PH.phrase_scores(df, ["id"], "text", e, PH.booster_table(spark)).first()["sentiment_compound"] == 0.25
