"""Mixing sources to target weights with a splitting tree.

* Targets: sources in code point order (null last) weigh 5, 2, 1, repeating,
  and share the size of all documents; a target stops at ``cap`` times its
  source's size and the excess goes to the others by weight.  The level at
  which nothing is in excess comes from one window over the sources.
* Blocks: the documents of a source are dealt by hash into blocks of about
  ``BLOCK_DOCS``.  A source is read in whole passes as often as its target
  holds its size, and one more pass takes blocks in a permuted order up to the
  target; of the one block on the border, documents in a permuted order as far
  as they fit.
* Splitting tree: the exact numbers of blocks drawn from each source are
  parted among the output shards.  A node of the tree draws what its left half
  gets by a multivariate hypergeometric distribution seeded by the node, so
  every shard walks from the root to its own leaf in its own task, and siblings
  agree without talking to each other.
* Each shard draws its quotas as disjoint runs of the permuted blocks and sorts
  its documents by a hash: the local shuffle.

All choices hang on hashes of doc_id, text and a seed, so reruns agree.  Null
texts have size 0; null sources are one source, the last; rows that share doc_id
and text are interchangeable, and where only some of them fit, the mix takes as
many.  An empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import staged

WEIGHTS = (5, 2, 1)
CAP = 3
BLOCK_DOCS = 1024
SHARD_BLOCKS = 64


def text_size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``(source, source_size, n_docs)`` -> with ``target`` (double).  One row
    for each source passes through the windows."""
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))).withColumn("weight", weight)
    most = F.col("source_size") * cap
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_ratio = Window.orderBy(most / F.col("weight"), "rank")
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum(most).over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) / F.sum("weight").over(
        by_ratio.rowsBetween(0, Window.unboundedFollowing)
    )
    levels = ranked.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    target = F.least(most.cast("double"), F.col("level") * F.col("weight"))
    return levels.select("source", "source_size", "n_docs", target.alias("target"))


def _halves(counts: np.ndarray, lo: int, hi: int, total: int, shards: int, seed: int) -> np.ndarray:
    """What the shards [lo, mid) draw of the blocks that [lo, hi) draws."""
    mid = (lo + hi) // 2
    first, middle = total * lo // shards, total * mid // shards
    rng = np.random.default_rng([seed, lo, hi])
    return rng.multivariate_hypergeometric(counts, middle - first, method="marginals")


def shard_quotas(counts: np.ndarray, shard: int, shards: int, seed: int) -> np.ndarray:
    """The leaf of one shard: blocks it draws from each source."""
    total = int(counts.sum())
    lo, hi = 0, shards
    while hi - lo > 1:
        left = _halves(counts, lo, hi, total, shards, seed)
        mid = (lo + hi) // 2
        counts, lo, hi = (left, lo, mid) if shard < mid else (counts - left, mid, hi)
    return counts


def _quota_rows(counts: np.ndarray, shards: int, seed: int):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for shard in part["id"]:
                quota = shard_quotas(counts, int(shard), shards, seed)
                yield pd.DataFrame({"at": np.arange(len(quota)), "shard": int(shard), "quota": quota})

    return run


def _fitting(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one border block, what the last pass takes: in a permuted order, as
    many of each group of equal documents as still fit the room."""
    rows = rows.sort_values(["turn", "f_id", "f_size", "f_key"], kind="stable")
    room, take = int(rows["p_room"].iloc[0]), []
    for size, n in zip(rows["f_size"], rows["f_rows"]):
        take.append(int(min(n, room // size)) if size else int(n))
        room -= size * take[-1]
    rows = rows.assign(f_take=np.array(take, dtype=np.int64)).rename(columns={"p_source": "f_source", "p_block": "f_block"})
    return rows[rows["f_take"] > 0][["f_source", "f_block", "f_id", "f_size", "f_key", "f_rows", "f_take"]]


EQUAL_ROWS = 4096  # rows of a group of equal documents that are numbered together


def _some_of_equals(rows: DataFrame) -> DataFrame:
    """Of documents whose group is taken in part, ``f_take`` of ``f_rows``: the rows
    of a large group are dealt into parts, of which each gives its share."""
    parts = F.greatest(F.floor(F.col("f_rows") / EQUAL_ROWS), F.lit(1))
    dealt = rows.withColumn("__tl_parts", parts).withColumn("__tl_part", F.pmod(F.monotonically_increasing_id(), F.col("__tl_parts")))
    share = F.floor(F.col("f_take") / F.col("__tl_parts")) + (F.col("__tl_part") < F.pmod("f_take", "__tl_parts")).cast("long")
    equal = Window.partitionBy("source", "f_block", "f_id", "f_size", "f_key", "__tl_part").orderBy(F.lit(0))
    return dealt.withColumn("f_fits", F.row_number().over(equal) <= share).drop("__tl_parts", "__tl_part")


def _hash(seed: int, *cols: Column) -> Column:
    return F.xxhash64(F.lit(seed), *cols)


def plan(docs: DataFrame, seed: int = 1, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``docs`` (doc_id, source, ``__tl_size``, further columns) with
    ``__tl_source_size``, ``__tl_target`` and ``__tl_draws``: one
    ``struct(pass, shard)`` for each time that the mix takes the document."""
    spark, columns = docs.sparkSession, [c for c in docs.columns if c != "__tl_key"]
    if "__tl_key" not in docs.columns:
        docs = docs.withColumn("__tl_key", F.xxhash64("text") if "text" in docs.columns else F.lit(0).cast("long"))
    sizes = docs.groupBy("source").agg(F.sum("__tl_size").alias("source_size"), F.count("*").alias("n_docs"))
    targets = source_targets(sizes, weights, cap)
    words = F.floor(F.col("target")).cast("long")
    sources = staged(
        targets.select(
            "*",
            F.ceil(F.col("n_docs") / BLOCK_DOCS).cast("long").alias("n_blocks"),
            F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size")).cast("long")).otherwise(0).alias("passes"),
        ).withColumn("rest", F.when(F.col("source_size") > 0, words - F.col("passes") * F.col("source_size")).otherwise(0)),
        "mix-sources",
    )
    placed = docs.alias("d").join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).select(
        "d.*",
        F.col("s.source_size").alias("__tl_source_size"),
        F.col("s.target").alias("__tl_target"),
        F.pmod(_hash(seed, F.col("d.doc_id"), F.col("d.__tl_key")), F.col("s.n_blocks")).alias("__tl_block"),
    )
    blocks = placed.groupBy("source", "__tl_block").agg(F.sum("__tl_size").alias("words"))
    in_source = Window.partitionBy("source")
    permuted = in_source.orderBy(_hash(seed, F.col("pass"), F.col("block"), F.lit(2)), "block")
    before = F.coalesce(F.sum("words").over(permuted.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = (
        blocks.alias("b")
        .join(sources.alias("s"), F.col("b.source").eqNullSafe(F.col("s.source")))
        .select("b.source", F.col("b.__tl_block").alias("block"), "b.words", "s.passes", "s.rest")
    )
    last = rest.withColumn("pass", F.col("passes")).filter(F.col("rest") > 0).withColumn("room", F.col("rest") - before).filter(F.col("room") > 0)
    whole = rest.filter(F.col("passes") > 0).withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes") - 1)))
    units = staged(
        whole.withColumn("partial", F.lit(False)).unionByName(last.select(*rest.columns, "pass", (F.col("room") < F.col("words")).alias("partial"))).select("source", "block", "pass", "partial").withColumn(
            "pos", F.row_number().over(in_source.orderBy("pass", _hash(seed, F.col("pass"), F.col("block"), F.lit(2)), "block")) - 1
        ),
        "mix-units",
    )
    counts = units.groupBy("source").agg(F.count("*").alias("n")).orderBy(F.col("source").asc_nulls_last()).toPandas()  # one row a source
    total = int(counts["n"].sum())
    shards = max(1, -(-total // SHARD_BLOCKS))
    names = spark.createDataFrame([(i, None if s is None or s != s else s) for i, s in enumerate(counts["source"])], "at long, source string")
    upto = Window.partitionBy("at").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    quotas = (
        spark.range(shards)
        .mapInPandas(_quota_rows(counts["n"].to_numpy(dtype=np.int64), shards, seed), "at long, shard long, quota long")
        .withColumn("first", F.coalesce(F.sum("quota").over(upto), F.lit(0)))
        .filter("quota > 0")
        .withColumn("pos", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("quota") - 1)))
        .join(names, "at")
        .select(F.col("source").alias("q_source"), F.col("pos").alias("q_pos"), "shard")
    )
    drawn = (
        units.join(quotas, F.col("source").eqNullSafe(F.col("q_source")) & (F.col("pos") == F.col("q_pos")))
        .groupBy("source", "block")
        .agg(F.sort_array(F.collect_list(F.struct("pass", "shard", "partial"))).alias("__tl_draws"))
        .select(F.col("source").alias("u_source"), F.col("block").alias("u_block"), "__tl_draws")
    )
    joined = placed.join(drawn, F.col("source").eqNullSafe(F.col("u_source")) & (F.col("__tl_block") == F.col("u_block")), "left").drop("u_source", "u_block")
    partial = last.filter(F.col("room") < F.col("words")).select(F.col("source").alias("p_source"), F.col("block").alias("p_block"), F.col("room").alias("p_room"))
    border = staged(
        placed.join(partial, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("__tl_block") == F.col("p_block")))
        .groupBy("p_source", "p_block", "p_room", F.col("doc_id").alias("f_id"), F.col("__tl_size").alias("f_size"), F.col("__tl_key").alias("f_key"))
        .agg(F.count("*").alias("f_rows"))
        .withColumn("turn", _hash(seed, F.col("f_id"), F.col("f_key"), F.lit(3)))
        .groupBy("p_source", "p_block")
        .applyInPandas(_fitting, "f_source string, f_block long, f_id long, f_size long, f_key long, f_rows long, f_take long"),
        "mix-border",
    )
    marked = joined.join(
        border,
        F.col("source").eqNullSafe(F.col("f_source"))
        & (F.col("__tl_block") == F.col("f_block"))
        & F.col("doc_id").cast("long").eqNullSafe(F.col("f_id"))
        & (F.col("__tl_size") == F.col("f_size"))
        & (F.col("__tl_key") == F.col("f_key")),
        "left",
    ).withColumn("f_fits", F.col("f_take").isNotNull())
    in_part = F.col("f_take") < F.col("f_rows")
    if not border.filter(in_part).isEmpty():
        split = F.coalesce(in_part, F.lit(False))
        marked = marked.filter(~split).unionByName(_some_of_equals(marked.filter(split)))
    draws = F.transform(
        F.filter("__tl_draws", lambda x: ~x["partial"] | F.col("f_fits")),
        lambda x: F.struct(x["pass"].alias("pass"), x["shard"].alias("shard")),
    )
    drawn_docs = marked.withColumn("__tl_draws", F.coalesce(draws, F.array().cast("array<struct<pass:bigint,shard:bigint>>")))
    return drawn_docs.select(*columns, "__tl_source_size", "__tl_target", "__tl_draws")


def mix(docs: DataFrame, seed: int = 1, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The mix: a row of ``docs`` for each draw, with ``copy`` (its pass) and
    ``shard``; a shard's rows lie together, in a shuffled order."""
    sized = docs.withColumn("__tl_size", text_size(F.col("text")))
    drawn = plan(sized, seed, weights, cap).withColumn("__tl_draw", F.explode("__tl_draws"))
    return (
        drawn.withColumns({"copy": F.col("__tl_draw.pass"), "shard": F.col("__tl_draw.shard")})
        .drop("__tl_draw", "__tl_draws", "__tl_size", "__tl_source_size", "__tl_target")
        .repartition("shard")
        .sortWithinPartitions("shard", _hash(seed, F.col("shard"), F.col("copy"), F.col("doc_id")), "doc_id")
    )
