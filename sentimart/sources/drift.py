"""Drift-tolerant ingest (SNK-5, FLT-7): records as VARIANT beside their typed columns.

Every JSON value is kept whole in a VARIANT column, so a field that a source
adds is there to be read the day somebody asks for it, under any path and type,
without a new schema or a new read of the topic. Typed columns are read from it
leniently: a number sent as text is that number, a field of the wrong type NULL.

Only what is no JSON object is quarantined. An object that lacks a required key
is ``incomplete``: it is kept, and :func:`repaired` replays it with other names
under which sources send that key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentimart import schemas as SC
from sentimart.sources.landing import REQUIRED

DOC, STATUS = "doc", "status"
RECORD, INCOMPLETE, NO_JSON = "record", "incomplete", "no json"


def field(path: str, kind: str, doc: str | Column = DOC) -> Column:
    """The value at a JSON path as a type (DDL), NULL if it is not there or cannot be one."""
    return F.try_variant_get(F.col(doc) if isinstance(doc, str) else doc, path, kind)


def _typed(kind: str, names: dict[str, list[str]]) -> dict[str, Column]:
    out = {}
    for f in SC.WIRE[kind].fields:
        found = [field(f"$.{n}", f.dataType.simpleString()) for n in [f.name, *names.get(f.name, [])]]
        value = F.coalesce(*found)
        out[f.name] = F.try_to_timestamp(value) if f.name in SC.TIME_COLUMNS[kind] else value
    return out


def _status(kind: str) -> Column:
    lacking = F.lit(False)
    for c in REQUIRED[kind]:
        lacking = lacking | F.col(c).isNull()
    return F.when(F.col(DOC).isNull(), NO_JSON).when(lacking, INCOMPLETE).otherwise(RECORD)


def drift_records(raw: DataFrame, kind: str, keep: list[str] | None = None) -> DataFrame:
    """Typed columns, ``doc`` (the whole record), ``status`` and the text of what is no JSON object, for every raw value."""
    text = F.col("value").cast("string")
    # an object, or nothing: arrays, numbers and texts are JSON, but no records
    whole = F.when(F.startswith(F.ltrim(text), F.lit("{")), F.try_parse_json(text))
    rows = raw.select(*(keep or []), text.alias("_text"), whole.alias(DOC)).withColumns(_typed(kind, {})).withColumn(STATUS, _status(kind))
    return rows.withColumn("quarantined_text", F.when(F.col(STATUS) == NO_JSON, F.col("_text"))).drop("_text")


def repaired(rows: DataFrame, kind: str, names: dict[str, list[str]]) -> DataFrame:
    """``rows`` with the incomplete ones replayed: a column that is NULL is also sought under its other ``names``."""
    again = F.col(STATUS) == INCOMPLETE
    typed = _typed(kind, names)
    out = rows.withColumns({c: F.when(again, v).otherwise(F.col(c)) for c, v in typed.items()})
    return out.withColumn(STATUS, _status(kind))

