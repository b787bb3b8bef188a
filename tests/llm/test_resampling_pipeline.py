"""Importance resampling against plain Python, and the pipeline's stages."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sentimart.llm import importance_resampling as R
from sentimart.llm import simhash_dedup

SMALL, MEDIUM, LARGE = "/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, fits int"
LABELS = "doc_id long, quality int, toxic int"
M = (1 << 64) - 1


def slow_ngrams(text):
    a = [zlib.crc32(w) for w in (text or "").encode().split()]
    one = [x * 0x9E3779B97F4A7C15 & M for x in a]
    two = [((x + y) & M) * 0xBF58476D1CE4E5B9 & M for x, y in zip(one, a[1:])]
    return [x >> 48 for x in one] + [(x >> 48) + 65536 for x in two]


def corpus(rng, n):
    words, junk = [f"w{i}" for i in range(300)], [f"$$${i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        rows.append((i, " ".join(rng.choice(junk if bad and rng.random() < 0.7 else words) for _ in range(rng.randint(20, 200))), "en", "s", 1, "clash", 2))
        if i % 2:
            labels.append((i, int(not bad), 0))
    return rows, labels


def test_weights_and_top_k(spark):
    rows, labels = corpus(random.Random(1), 300)
    labels += [(1, 0, 0), (None, 1, 0), (3, None, None), (7, 1, 1)]  # the worse label counts, null is none
    rows += [rows[4], (None, rows[6][1], "en", "s", 1, "c", 2), (900, None, "en", "s", 1, "c", 2), (901, " \n", "en", "s", 1, "c", 2)]
    docs, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    got = R.judged(docs, marks).collect()
    fit = {r.doc_id for r in R.labelled(marks).collect() if r.fits}
    good = {r.doc_id for r in R.labelled(marks).collect()}
    assert good == {i for i, q, t in labels if i is not None and q and i not in (1, 7)}
    raw, target = Counter(), Counter()
    for i, t, *_ in rows:
        raw.update(slow_ngrams(t))
        if i in fit:
            target.update(slow_ngrams(t))
    total = {kind: (sum(n for b, n in raw.items() if (b >= 65536) == kind), sum(n for b, n in target.items() if (b >= 65536) == kind)) for kind in (False, True)}

    def weight(t):
        found = slow_ngrams(t)
        parts = [math.log(target[b] + 5) - math.log(raw[b] * total[b >= 65536][1] / total[b >= 65536][0] + 5) for b in found]
        return 200 * sum(parts) / len(parts) if parts else 0.0

    text = {i: t for i, t, *_ in rows}
    assert len(got) == len(rows)
    for r in got:
        assert math.isclose(r.log_weight, weight(text[r.doc_id]), rel_tol=1e-4, abs_tol=1e-3)
    held = sorted(r.log_weight for r in got if r.doc_id in good - fit)
    cut = np.quantile(held, 0.002)
    k = sum(r.log_weight >= cut for r in got)
    order = sorted((r.score for r in got), reverse=True)
    assert all(r.kept == (r.score >= order[k - 1]) for r in got)
    kept = R.accepted(docs, marks)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got if r.kept)


def test_noise_is_gumbel(spark):
    noise = [r.g for r in spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")).select(R.gumbel().alias("g")).collect()]
    assert abs(np.mean(noise) - 0.5772) < 0.03 and abs(np.var(noise) - math.pi ** 2 / 6) < 0.08


def slow_compared(text):
    tokens = re.findall(rb"[a-z0-9\x80-\xff]+", (text or "").encode().lower())
    a = [zlib.crc32(w) for w in tokens]
    one = [x * 0x9E3779B97F4A7C15 & M for x in a]
    return {*one, *(((x + y) & M) * 0xBF58476D1CE4E5B9 & M for x, y in zip(one, a[1:]))}


def test_toxicity_by_hand(spark):
    rng = random.Random(12)
    plain = [f"w{i}" for i in range(40)]
    rows, labels = [], []
    for i in range(400):
        text = [rng.choice(plain) for _ in range(30)]
        toxic = i % 4 == 0
        if toxic or i % 57 == 0:
            text.insert(rng.randrange(30), rng.choice(["Vile!", "vile", "rotten,", "é-foul"]))
        rows.append((i, " ".join(text), "en", "s", 1, "c", 2))
        if i % 3:
            labels.append((i, 1, int(toxic)))
    rows += [(500, None, "en", "s", 1, "c", 2), rows[4], (None, rows[8][1], "en", "s", 1, "c", 2)]
    docs, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    fit = {r.doc_id: r.fits for r in R.labelled(marks).collect()}
    bad = [slow_compared(t) for i, t, *_ in rows if (i, 1, 1) in labels]
    clean = [slow_compared(t) for i, t, *_ in rows if fit.get(i)]
    t, c = Counter(x for d in bad for x in d), Counter(x for d in clean for x in d)
    n, m = len(bad), len(clean)
    p, chance, strength = n / (n + m), math.log(len(t)), {}
    for key, x in t.items():
        y = c[key]
        q = x / (x + y)
        tail = (x + y) * (q * math.log(q / p) + ((1 - q) * math.log((1 - q) / (1 - p)) if y else 0))
        if x >= 2 and q > p and tail >= chance:
            strength[key] = math.log((x + 0.5) / (n + 1)) - math.log((y + 0.5) / (m + 1))
    assert strength
    slow = {text: sum(sorted(strength[x] for x in slow_compared(text) if x in strength)[-3:]) for text in {t for _, t, *_ in rows}}
    held = sorted(slow[text] for i, text, *_ in rows if fit.get(i) is False)
    most = held[math.ceil(0.998 * len(held)) - 1]
    model = R.fitted(docs, marks)
    assert sorted(model.marks.keys.tolist()) == sorted(strength) and math.isclose(model.most_toxic, most, abs_tol=1e-6)
    text = {i: t for i, t, *_ in rows}
    for r in model.scores.collect():
        assert math.isclose(r.toxicity, slow[text[r.doc_id]], abs_tol=1e-6)
    assert Counter(r.toxic for r in R.judged(docs, marks).collect()) == Counter(slow[t] > most + 1e-7 for _, t, *_ in rows)


def test_held_out_accuracy(spark):
    """Labels hidden from the fit: clean documents stay, low quality goes."""
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    shown, hidden = labels.where("doc_id % 2 = 0"), {r.doc_id: r.quality for r in labels.where("doc_id % 2 = 1").collect()}
    got = {r.doc_id: r.kept for r in R.judged(spark.read.parquet(f"{MEDIUM}/documents.parquet"), shown).collect()}
    good, bad = ([got[i] for i, q in hidden.items() if q == which] for which in (1, 0))
    assert np.mean(good) > 0.96 and np.mean(bad) < 0.25  # 200 labels: the cut is the least of about 85


def test_held_out_toxic(spark):
    """Labels hidden from the fit: documents with a few toxic words go, clean ones stay."""
    labels = spark.read.parquet(f"{LARGE}/labels.parquet")
    shown, hidden = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1 and quality = 1").collect()
    kept = {r.doc_id for r in R.accepted(spark.read.parquet(f"{LARGE}/documents.parquet"), shown).select("doc_id").collect()}
    clean, toxic = ([r.doc_id in kept for r in hidden if r.toxic == which] for which in (0, 1))
    print(f"toxic recall {1 - np.mean(toxic):.3f} of {len(toxic)}, clean loss {1 - np.mean(clean):.4f} of {len(clean)}")
    assert np.mean(toxic) < 0.2 and np.mean(clean) > 0.985


@pytest.mark.parametrize("labels", [[], [(1, 0, 0)]])
def test_nothing_labelled_good(spark, labels):
    docs = spark.createDataFrame(corpus(random.Random(2), 20)[0], DOCS)
    marks = spark.createDataFrame(labels, LABELS)
    assert all(r.kept for r in R.judged(docs, marks).collect()) and R.accepted(docs, marks).count() == 20


def test_empty_documents(spark):
    empty, marks = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, 1, 0)], LABELS)
    assert R.judged(empty, marks).count() == 0 and R.accepted(empty, marks).count() == 0


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    columns = docs.columns
    kept = docs
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before, kept = kept, stage(spark, kept, MEDIUM).cache()
        counts.append(kept.count())
        if name != "sharding":
            assert kept.columns == columns
        if name == "simhash_dedup":
            classes = {r.component_id for r in simhash_dedup.classes(before).collect()}
            assert {r.doc_id for r in kept.collect()} == classes and counts[-1] == len(classes)
        if name == "decontamination":
            items = [r.text for r in spark.read.parquet(f"{MEDIUM}/benchmark.parquet").collect()]
            leaked = {r.doc_id for r in before.collect() if any(i in r.text for i in items)}
            assert leaked and not leaked & {r.doc_id for r in kept.collect()}
        if name == "mixing":
            took = sum(len(r.text.split()) for r in kept.collect())
            whole = sum(len(r.text.split()) for r in before.collect())
            assert abs(took / whole - 1.5) < 0.05
    assert counts[0] > counts[1] > counts[2] > counts[3] and counts[4] == counts[5]
    assert set(kept.columns) == {*columns, "shard"}
    got = corpus_pipeline.run(spark, MEDIUM)
    assert Counter(got.select("doc_id", "shard").collect()) == Counter(kept.select("doc_id", "shard").collect())


def test_stages_on_odd_rows(spark):
    """Nulls in every column, ties, repeated rows and no rows at all."""
    odd = [(None, None, None, None, None), (1, None, "en", "a", 0), (2, "", None, None, 0), (2, "", None, None, 0), (3, "word " * 300, "en", "a", None),
           (3, "word " * 300, "en", "a", None), (None, "some words here", "en", "b", 1), (4, "é " * 100, "fr", "", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SMALL)
            docs.collect()
        assert set(docs.columns) == {"doc_id", "text", "lang", "source", "n_chars", "shard"}
