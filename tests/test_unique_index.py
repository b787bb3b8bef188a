"""Uniqueness of a growing table: sketches name the dates that are read again."""

import datetime as dt
import random
from collections import Counter

import pytest

from sentimart.operators.unique_index import UniqueIndex

DAY = [dt.date(2024, 1, d) for d in range(1, 9)]


def table(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, "id string, day date").write.partitionBy("day").mode("overwrite").parquet(path)
    return spark.read.schema("id string, day date").parquet(path)


def slow(rows):
    return {k: n for k, n in Counter(i for i, _ in rows if i is not None).items() if n > 1}


def failing(index, spark):
    return {r.value: r.n_records for r in index.failures(spark).collect()}


def test_only_dates_that_meet_are_read(spark, tmp_path):
    rows = [(f"{d}-{i}", d) for d in DAY for i in range(300)] + [(None, DAY[0]), (None, DAY[5])]
    rows += [(f"{DAY[1]}-7", DAY[6]), (f"{DAY[1]}-7", DAY[6]), (f"{DAY[4]}-9", DAY[6]), (f"{DAY[7]}-1", DAY[7])]
    t, index = table(spark, tmp_path, rows), UniqueIndex(str(tmp_path / "index"), "id", "day", buckets=8)
    assert index.add(t, DAY[:6], "history") == [] and failing(index, spark) == {}
    assert index.add(t, [DAY[6]], "d7") == [DAY[1], DAY[4]]
    assert index.add(t, [DAY[7]], "d8") == []
    assert failing(index, spark) == slow(rows) and len(slow(rows)) == 3
    assert index.suspects(spark, [DAY[6]]).count() == 2  # one cell of each date, not the date
    assert index.add(t, [DAY[6]], "d7") == [DAY[1], DAY[4]]  # run again: the same
    assert failing(index, spark) == slow(rows) and index.cells(spark).count() == 8 * len(DAY)


@pytest.mark.parametrize("lg", [4, 12])
def test_random_tables(spark, tmp_path, lg):
    """Cells beyond what a sketch holds (lg 4) are asked all the same; one key holds a third of all rows."""
    rng = random.Random(lg)
    rows = [("hot" if rng.random() < 0.33 else f"k{rng.randrange(1500)}", rng.choice(DAY)) for _ in range(1200)]
    t, index = table(spark, tmp_path, rows), UniqueIndex(str(tmp_path / "index"), "id", "day", buckets=3, lg=lg)
    for d in DAY:
        index.add(t, [d], str(d))
    assert failing(index, spark) == slow(rows)


def test_late_rows_and_empty_dates(spark, tmp_path):
    rows = [("a", DAY[0]), ("b", DAY[1])]
    index = UniqueIndex(str(tmp_path / "index"), "id", "day")
    t = table(spark, tmp_path, rows)
    index.add(t, DAY[:2], "first")
    assert index.add(t, [DAY[3]], "none") == [] and failing(index, spark) == {}
    rows += [("b", DAY[0])]
    t = table(spark, tmp_path, rows)
    assert index.add(t, [DAY[0]], "late") == [DAY[1]]
    assert failing(index, spark) == {"b": 2}
