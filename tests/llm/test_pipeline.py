"""Each stage of the corpus pipeline on its own input, and the whole run."""

import corpus_pipeline
from conftest import SF_SMALL
from pyspark.sql import functions as F

from tideline.llm import decontaminate, jaccard


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("size", F.lit(1)).withColumn("shingles", F.lit("x"))
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL).cache()
        assert out.columns == docs.columns and 0 < out.count() <= docs.count()
        docs = out
    assert decontaminate.leaks(docs, bench).count() == 0
    # what edits of one stage leave behind is not judged again by an earlier one
    assert jaccard.near_duplicates(docs, 5, 80).filter("doc_id <> component_id").count() == 0
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert set(docs.columns) | {"copy", "shard"} == set(mixed.columns)


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_SMALL).count() == 0


def test_near_duplicates_go_by_row(spark):
    import corpus_pipeline

    def say(kind, n=60):
        return " ".join(f"{kind}{i}" for i in range(n))

    rows = [
        (1, say("a")), (2, say("a")), (2, say("b")), (2, ""),  # 2: a copy, and two texts of its own
        (None, say("a")), (None, say("c")), (None, say("c")), (None, say("c", 58)), (None, say("d")), (None, None), (None, ""),
        (7, say("e")), (7, say("e")), (8, say("e", 59)),
    ]
    docs = spark.createDataFrame([(i, t, "s", 5, "k") for i, t in rows], "doc_id long, text string, source string, n_chars long, __tl_class string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted((str(r["doc_id"]), (r["text"] or "")[:2]) for r in kept.collect())
    assert got == sorted([("1", "a0"), ("2", "b0"), ("2", ""), ("None", "c0"), ("None", "d0"), ("None", ""), ("None", ""), ("7", "e0"), ("7", "e0")])
