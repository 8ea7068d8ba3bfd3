"""The corpus pipeline: documents -> clean, distinct, mixed documents.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir)
and returns the documents it keeps, with the columns of ``docs``.  The last
stage returns the mix: a row for each time it takes a document, with its pass
(``copy``) and output ``shard``.

Any column but doc_id, text and source may be missing or extra; n_chars, where
it is there, follows the text.  Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import decontaminate, jaccard, lines, mixing, toxicity
from tideline.llm.common import staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go (score 0.5 or more)."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).filter(F.col("__tl_score") < 0.5).drop("__tl_score")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 40 characters or more that 5 documents hold stay in one."""
    out = lines.dedup_lines(docs)
    if "n_chars" in docs.columns:
        changed = F.col("__tl_dropped") > 0
        out = out.withColumn("n_chars", F.when(changed, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of documents whose 5-word shingle sets have a Jaccard
    similarity of 0.8 or more, that with the smallest doc_id stays.  Rows of the
    class that share this doc_id stay together; another text under the doc_id of a
    copy stays, too.  Of a class without ids one row stays; empty texts stay."""
    classes = staged(jaccard.near_duplicates(docs, k=5, percent=80, keys=True), "classes")
    named = classes.filter(F.col("component_id").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("component_id")))
    unnamed = classes.filter(F.col("component_id").isNull() & F.col("__tl_class").isNotNull())
    first = unnamed.groupBy("__tl_class").agg(F.min("__tl_key").alias("first"), F.count("*").alias("rows")).filter("rows > 1")
    others = unnamed.join(first, "__tl_class").filter(F.col("__tl_key") != F.col("first"))
    lost = named.select("doc_id", "__tl_key").unionByName(others.select("doc_id", "__tl_key")).distinct().alias("l")
    keyed = docs.withColumn("__tl_key", F.xxhash64("text")).alias("d")
    left = keyed.join(lost, F.col("d.doc_id").cast("long").eqNullSafe(F.col("l.doc_id")) & (F.col("d.__tl_key") == F.col("l.__tl_key")), "left_anti")
    if first.isEmpty():
        return left.select(*docs.columns)
    same = left.join(first.select(F.col("first").alias("__tl_key"), F.lit(True).alias("__tl_same")), "__tl_key", "left").withColumn("__tl_same", F.col("__tl_same").isNotNull() & F.col("doc_id").isNull())
    one = same.filter("__tl_same").dropDuplicates(["__tl_key"])
    return same.filter("NOT __tl_same").unionByName(one).select(*docs.columns)


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources to their target weights."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard", drop_near_duplicates),
    ("decontaminate", decontaminate_documents),
    ("mix", mix_sources),
]

#: SQL can't express the classifier, the embedding or the permuted blocks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
