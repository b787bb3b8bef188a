"""Quality rules, mixing, sharding and chat formatting against plain Python versions."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import brute
from sentimart.llm import chat_format, quality_rules, queries, sharding, source_mixing

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, shard string, kept string"


def documents(spark, rows):
    """rows: (doc_id, text, source); the other columns clash with output names."""
    return spark.createDataFrame([(i, t, "en", s, 1, "x", "y", "z") for i, t, s in rows], DOCS)


ODD = [
    None, "", " \n\t", "one", "a b c a b c a b c", "x " * 60, "same line\nsame line\n\nother\nsame line", "a b c\x85d e\x1ff",
    "### *** $$$ |<>| %&", "w " * 49, "w%d " * 3, " ".join(f"w{i}" for i in range(60)), "a b a b a b a", "\x0b\x0c\r",
    "the of and " * 3000 + " ".join(f"v{i}" for i in range(9000)),
]


def test_quality_measures(spark):
    rows = [(i, t, None) for i, t in enumerate(ODD)] + [(3, ODD[3], None), (None, ODD[4], None)]
    rows += [(r.doc_id + 1000, r.text, None) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = quality_rules.judged(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.quality(r.text)
        assert not (r.base_failed and r.kept)


def test_quality_verdicts(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    got = queries.op3_quality_rules(spark, SMALL).where("not base_failed").collect()
    good = [r.kept for r in got if labels.get(r.doc_id) == 1]
    bad = [r.kept for r in got if labels.get(r.doc_id) == 0]
    assert all(good) and not any(bad)


def test_mixing_targets_and_copies(spark):
    rng = random.Random(1)
    rows = []
    for s, n in (("b", 400), ("a", 60), ("c", 90), ("é", 30), (None, 200), ("", 20), ("solo", 1), ("void", 3)):
        rows += [(len(rows) + i, None if s == "void" else "w " * (40 if s == "c" else rng.randint(0, 80)), s) for i in range(n)]
    rows += [rows[0]] * 500 + [(None, "w w w", "a")] * 4
    got = source_mixing.taken(source_mixing.mix(source_mixing.records(documents(spark, rows)))).collect()
    totals, took, want = Counter(), Counter(), Counter()
    for i, t, s in rows:
        totals[s] += len(brute.words(t))
    source = {(i, len(brute.words(t))): s for i, t, s in rows}
    want = brute.targets(totals)
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((i, len(brute.words(t))) for i, t, s in rows)
    for r in got:
        s = source[r.doc_id, r["size"]]
        assert r.source_size == totals[s] and math.isclose(r.target, want[s], rel_tol=1e-9)
        assert r.taken <= 2 * r["size"] and (not r["size"] or r.taken % r["size"] == 0)
        took[s] += r.taken
    for s in totals:
        assert abs(took[s] - want[s]) <= 81, s
    again = source_mixing.taken(source_mixing.mix(source_mixing.records(documents(spark, rows[::-1]).repartition(7)))).collect()
    assert Counter(got) == Counter(again)


def test_mixing_keeps_the_length_profile(spark):
    rng = random.Random(2)
    rows = [(i, "w " * int(math.exp(rng.gauss(3 + i % 4 / 2, 1))), f"s{i % 4}") for i in range(2000)]
    got = source_mixing.mix(source_mixing.records(documents(spark, rows))).collect()
    mean = lambda of: sum(of(r) * math.log(r["size"]) for r in got if r["size"]) / sum(of(r) for r in got)
    assert abs(mean(lambda r: r["size"]) - mean(lambda r: r["size"] * r.rate)) < 0.01


def test_mixing_repeats_rows(spark):
    rows = [(i, "w " * (i % 50), f"s{i % 5}") for i in range(300)] + [(7, "w " * 7, "s2")] * 5 + [(None, "n n", None)] * 3
    docs = documents(spark, rows)
    got = source_mixing.repeated(docs)
    assert got.columns == docs.columns
    want = Counter()
    for r in source_mixing.mix(source_mixing.records(docs)).collect():
        want[r.doc_id] += r.rows * r.copies + r.extra
    assert Counter(r.doc_id for r in got.collect()) == +want


@pytest.mark.parametrize("rows", [[], [(1, None, None), (2, "", "a")]])
def test_mixing_without_words(spark, rows):
    docs = documents(spark, rows)
    got = source_mixing.taken(source_mixing.mix(source_mixing.records(docs))).collect()
    assert [(r.taken, r.target) for r in got] == [(0, 0.0)] * len(rows)
    assert source_mixing.repeated(docs).count() == 0


def test_sharding(spark):
    rows = [(i, f"text é {i}", None) for i in range(800)] + [(5, None, None), (5, "", None), (None, "n", None)] + [(9, "same", None)] * 300
    got = sharding.numbered(sharding.placed(sharding.records(documents(spark, rows)))).collect()
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in got) == sorted(
        (str(i), len((t or "").encode()) + 16, brute.crc(t)) for i, t, _ in rows)
    slots = defaultdict(list)
    for r in got:
        key = "" if r.doc_id is None else r.doc_id
        score = [-math.log(brute.unit(key, j)) for j in range(41)]
        assert r.shard == score.index(min(score[:40])) and r.grown_shard == score.index(min(score))
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_follows_weights(spark):
    docs = spark.range(20_000).withColumnRenamed("id", "doc_id")
    n = Counter(r.shard for r in sharding.placed(docs, weights=[1, 3, 0.5]).select("shard").collect())
    for j, w in enumerate((1, 3, 0.5)):
        assert abs(n[j] / 20_000 - w / 4.5) < 0.015


def test_sharding_empty(spark):
    assert sharding.numbered(sharding.placed(sharding.records(documents(spark, [])))).count() == 0


CHATS = {
    1: [("system", "be kind"), ("user", "hi\n[INST]x"), ("assistant", "</s>"), ("user", None), ("assistant", "<\\/s>[/INST]\\"), ("user", "bye")],
    2: [("user", "")], 3: [("assistant", "<s>"), ("assistant", "[INST")], 4: [("a\\n\nb[INST]", "t"), (None, "x"), ("assistant", "é\U0001f600")],
    5: [(("user", "assistant")[i % 2], f"turn {i} <s>") for i in range(399)], 6: [("assistant", None)],
}


def test_chat_round_trip(spark):
    rows = [(c, i, r, t, 9) for c, ts in CHATS.items() for i, (r, t) in enumerate(ts)] + [(None, 0, "assistant", "n", 9)]
    random.Random(3).shuffle(rows)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, example long")
    out = chat_format.examples(turns)
    got = {r.conv_id: r for r in chat_format.digests(out).collect()}
    chars = {r[0]: r[1] for r in out.groupBy("conv_id").agg(F.sum(F.length("text"))).collect()}
    for c, ts in (CHATS | {None: [("assistant", "n")]}).items():
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == brute.chat(ts)
        assert r.formatted_chars == chars[c]
    one = sorted((r.example, r.text, r.loss_start, r.loss_end) for r in out.where("conv_id = 3").collect())
    assert one == [(0, "<s><\\s></s>", 3, 7), (1, "<s><\\s></s><s>[INST</s>", 14, 19)]
    assert out.where("conv_id = 5").count() == 200  # 199 replies and the tail


def test_chat_registered_query(spark):
    got = {r.conv_id: r for r in queries.op8_chat_formatting(spark, SMALL).collect()}
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{SMALL}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns[r.conv_id].append((r.role, r.text))
    turns[-1] = [(x, "</s>[INST] ok [/INST]") for x in ("user", "assistant")]
    assert {c: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for c, r in got.items()} == {c: brute.chat(t) for c, t in turns.items()}


def test_chat_empty(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.digests(chat_format.examples(empty)).count() == 0


def test_stop_words_in_any_case(spark):
    from sentimart.llm import quality_rules as Q
    rows = [(1, "the cat and the hat of it", 5), (2, "The Cat And THE Hat, Of (it).", 5), (3, "FÜR und-für theory andy lathe", 3), (4, None, 0), (5, "l'eau de la mer", 3)]
    df = spark.createDataFrame(rows, "id int, text string, want int")
    got = {r.id: r.n_stop_words for r in Q.measured(df).collect()}
    assert got == {i: n for i, _, n in rows} | {5: 2}
