"""What keeps tasks small on large tables: landed file sets, native seen-key state, sliced scoring, one normalising pass."""

import os

import numpy as np
import pyarrow as pa
from conftest import SMALL
from pyspark.sql import functions as F
from test_streaming import _land, _msg

from sentimart import queries_stream as Q
from sentimart.operators import scoring as SCO
from sentimart.plans import producers as PR
from sentimart.session import run_folder
from sentimart.streaming import jobs as J


def _landed(where):
    """(chunk, time, size) of the files, in the order a stream takes them."""
    at = where.removeprefix("file:")
    found = [(c, f"{at}/{c}/{f}") for c in os.listdir(at) if c.startswith("chunk=") for f in os.listdir(f"{at}/{c}") if f.startswith("part-")]
    return sorted(((os.path.getmtime(f), c) for c, f in found))


def test_chunks_land_as_equal_file_sets_in_order(spark, monkeypatch):
    monkeypatch.setattr(Q, "FILE_RECORDS", 50)
    chunk = F.when(F.col("id") < 200, 0).when(F.col("id") < 203, 1).when(F.col("id") < 300, Q.LATER).cast("long")
    lines = spark.range(310).select(chunk.alias("chunk"), F.col("id").cast("string").alias("value"))
    for ordered in (True, False):
        where = f"{run_folder(spark, 'sets')}/landing"
        Q.land_chunks(lines, where, ordered)
        files = [c for _, c in _landed(where)]
        assert Q.file_set(spark, where) == 4
        assert sorted(int(r.value) for r in spark.read.text(where).collect()) == list(range(310))
        if ordered:
            assert files == [c for c in ("chunk=0", "chunk=1", f"chunk={Q.LATER}", "chunk=__HIVE_DEFAULT_PARTITION__") for _ in range(4)]


def test_seen_keys_are_native_state(spark):
    root = run_folder(spark, "native")
    where, paths = f"{root}/landing", J.StreamPaths(root)
    _land(where, "a.json", [_msg(1, "2024-01-01T00:00:00Z"), _msg(1, "2024-01-01T00:00:00Z"), "{broken"])
    q = J.start_stream(spark, "message", J.read_topic(spark, "message", folder=where), paths, available_now=True)
    J.await_all(spark, [q])
    assert {s["operatorName"] for p in q.recentProgress for s in p["stateOperators"]} == {"dedupe"}
    assert [J.layer_table(spark, paths, "message", x).count() for x in ("bronze", "silver", "quarantine")] == [2, 1, 1]


def test_scoring_takes_some_texts_at_a_time(monkeypatch):
    monkeypatch.setattr(SCO, "SLICE_TOKENS", 5)
    texts = [[], ["a"] * 3, ["b"] * 2, ["c"] * 9, [], ["a", "b"]]
    lists, most = pa.array(texts, pa.list_(pa.string())), []

    def sums(part):
        t = SCO.Tokens(part)
        most.append(len(part))
        return t.sums(np.ones(len(t.values), np.int64), 1, 1)
    for part in (lists, lists.slice(1, 4), lists.slice(0, 0)):
        assert SCO.sliced(sums)(part).field("n_tokens").to_pylist() == [len(x) for x in part.to_pylist()]
    assert max(most) == 3 and len(most) > 4


def test_reconciliation_normalises_once_for_its_counts(spark, monkeypatch):
    calls = []
    normalise = PR.NORMALIZE["tick"]
    monkeypatch.setitem(PR.NORMALIZE, "tick", lambda landing, raw=False: calls.append(raw) or normalise(landing, raw=raw))
    t = "timestamp'2024-01-01'"
    landing = spark.sql(f"""select * from values (1L, {t}, '{{"data":{{"s":"a","c":"1"}}}}'), (2L, {t}, '{{"data":{{"s":"a","c":"x"}}}}'),
                            (3L, {t}, '{{torn'), (4L, {t}, '{{"data":{{"c":"1"}}}}') as t(offset, ingested_at, value)""")
    counts = PR.reconciliation(landing, "tick")
    assert tuple(counts.first()) == ("tick", 4, 1, 0, 0, 1, 2, 0)
    assert tuple(PR.reconciliation(landing.limit(0), "tick").first()) == ("tick", 0, 0, 0, 0, 0, 0, 0)
    # landed, rejects and their torn payloads; the counts of rows, listed and good read the table
    assert counts._jdf.queryExecution().optimizedPlan().toString().count("from_json") <= 4
    assert calls == [False, True, False, True]


def test_a_replay_in_file_sets_gives_the_same_rows(spark, monkeypatch):
    rows = []
    for records in (Q.FILE_RECORDS, 150):
        monkeypatch.setattr(Q, "FILE_RECORDS", records)
        rows.append(sorted(map(str, Q.q_stream_message_dedup(spark, SMALL).collect())))
    assert rows[0] == rows[1] and rows[0]
