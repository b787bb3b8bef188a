"""Records that drift: added, renamed and ill-typed fields, and what is no JSON."""

import json

from pyspark.sql import functions as F

from sentimart.session import run_folder
from sentimart.sources import drift as DR
from sentimart.streaming.sinks import LayerSpec, read_layer, write_layer


def test_drifting_records(spark):
    t = "2024-01-01T00:00:00Z"
    texts = [json.dumps({"symbol": "A", "price": 1.5, "ingested_at": t}), json.dumps({"symbol": "A", "price": "2.5", "ingested_at": ""}),
             json.dumps({"symbol": "A", "price": {"now": 3}, "depth": {"bids": [7, 8]}}), json.dumps({"sym": "B", "price": 4}), json.dumps({"price": 5}),
             "{torn", "[1]", "12", "null", "", None, '  {"symbol": "C"}']
    raw = spark.createDataFrame(list(enumerate(texts)), "offset long, value string")
    rows = DR.drift_records(raw, "tick", keep=["offset"])
    got = {r.offset: (r.status, r.symbol, r.price, r.quarantined_text) for r in rows.drop("doc").collect()}
    assert got == {0: ("record", "A", 1.5, None), 1: ("record", "A", 2.5, None), 2: ("record", "A", None, None), 3: ("incomplete", None, 4.0, None),
                   4: ("incomplete", None, 5.0, None), **{i: ("no json", None, None, texts[i]) for i in range(5, 11)}, 11: ("record", "C", None, None)}
    fixed = {r.offset: (r.status, r.symbol) for r in DR.repaired(rows, "tick", {"symbol": ["ticker", "sym"]}).drop("doc").collect()}
    assert fixed[3] == ("record", "B") and fixed[4] == ("incomplete", None) and fixed[0] == ("record", "A")
    assert sum(s == "no json" for s, _ in fixed.values()) == 6  # what is no JSON object, and nothing else


def test_a_field_added_mid_stream_needs_no_new_schema(spark):
    path = f"{run_folder(spark, 'drift')}/bronze"
    batch = lambda texts: DR.drift_records(spark.createDataFrame([(x,) for x in texts], "value string"), "tick")
    first = batch(['{"symbol":"A"}'])
    for epoch, rows in enumerate((first, batch(['{"symbol":"B","fees":{"maker":0.25}}', '{"symbol":"C","fees":{"maker":"0.5"}}']))):
        write_layer(rows, epoch, LayerSpec(path))
    got = read_layer(spark, path, first.schema).select("symbol", DR.field("$.fees.maker", "double").alias("maker"))
    assert {r.symbol: r.maker for r in got.collect()} == {"A": None, "B": 0.25, "C": 0.5}
    assert read_layer(spark, path, first.schema).filter(F.col("status") == "record").count() == 3
