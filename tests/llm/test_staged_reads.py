"""Staged tables: how many rows are decoded at a time, and only meanwhile."""

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from tideline.llm import lines
from tideline.llm.common import READ_ROWS, staged


def test_rows_read_at_a_time_hold_for_one_stage(spark):
    def seen(parts):
        for part in parts:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().getLocalProperty(READ_ROWS)] * part.num_rows)], names=["rows"])

    before = spark.conf.get(READ_ROWS)
    rows = spark.range(3).mapInArrow(seen, "rows string")
    assert {r["rows"] for r in staged(rows, "read-rows", read_rows=77).collect()} == {"77"}
    assert spark.conf.get(READ_ROWS) == before


def test_line_hashes_decode_few_texts_at_a_time(spark, monkeypatch):
    asked, own = {}, lines.staged
    monkeypatch.setattr(lines, "staged", lambda df, name, **more: asked.update({name: more}) or own(df, name, **more))
    docs = spark.createDataFrame([(i, "a line that is longer than forty characters\nb") for i in range(6)], "doc_id long, text string")
    got = lines.dedup_lines(docs).agg(F.sum("__tl_dropped")).first()[0]
    assert got == 5
    assert asked["line-hashes"] == {"read_rows": lines.TEXT_ROWS} and lines.TEXT_ROWS < 4096
