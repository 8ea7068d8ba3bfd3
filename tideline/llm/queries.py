"""The registered queries: each operator over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import codebooks, decontaminate, embeddings, html, jaccard, langid, lines, mixing, packing, search, secrets, toxicity, warc
from tideline.llm.common import fold, staged, table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base spans and linked weak candidates."""
    return secrets.scan(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as ARC, converted to WARC and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item: doc_id, item_id, place, edits."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document the mix takes."""
    docs = staged(table(spark, sf_dir, "documents").select("doc_id", "source", mixing.text_size(F.col("text")).alias("__tl_size"), F.xxhash64("text").alias("__tl_key")), "sizes")
    times = F.size("__tl_draws")
    return mixing.plan(docs).select(
        "doc_id",
        F.col("__tl_size").alias("size"),
        F.col("__tl_source_size").alias("source_size"),
        F.col("__tl_target").alias("target"),
        (F.col("__tl_size") * times).cast("long").alias("taken"),
        F.transform("__tl_draws", lambda x: x["shard"]).alias("shards"),
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, how many go, and a digest of the rest."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select(
        "doc_id",
        F.col("__tl_lines").alias("n_lines"),
        F.col("__tl_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    text = F.col("__tl_text")
    return html.extract(pages, html.train(pages)).select("page_id", "url", text.alias("text"), F.char_length(text).cast("long").alias("n_chars"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and classes of near-equal embeddings within a label."""
    return embeddings.link_vectors(table(spark, sf_dir, "embeddings"), 0.98)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), folds=5, held_out=0)
    return toxicity.score(docs, model).select(
        "doc_id",
        (fold(F.col("doc_id"), 5) == 0).alias("held_out"),
        F.col("__tl_score").alias("score"),
        (F.col("__tl_score") >= 0.5).cast("int").alias("predicted"),
    )


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose 4-word shingle sets have Jaccard >= 0.85."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=85)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    data = langid.dictionaries(docs, folds=4, held_out=2)
    return langid.classify(docs.select("doc_id", "text"), data).select(
        "doc_id",
        (fold(F.col("doc_id"), 4) == 2).alias("held_out"),
        F.col("__tl_lang").alias("lang_pred"),
        F.col("__tl_score").alias("score"),
        F.col("__tl_rejected").alias("rejected"),
    )


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of every sound vector, their errors and the codebooks' digest."""
    coded, books = codebooks.compress(table(spark, sf_dir, "embeddings"))
    return codebooks.label_errors(coded).select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def op12_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences along a Hilbert curve."""
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


STRIPPED = "trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINE_SQL = f"""
WITH lines AS (
  SELECT doc_id, i, x, {LOWER.format(STRIPPED)} AS k
  FROM (SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS x
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
), repeated AS (
  SELECT k, max(doc_id) AS last_id FROM lines WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT l.doc_id, l.i, l.x, r.k IS NOT NULL AND r.last_id <> l.doc_id AS gone FROM lines l LEFT JOIN repeated r USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

JACCARD_SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array({LOWER.format("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * o >= 85 * (a.n + b.n - o)
), reach AS (
  SELECT doc_id AS node, doc_id AS low FROM documents
  UNION
  SELECT l.y, r.low FROM reach r JOIN links l ON l.x = r.node WHERE r.low < l.y
), least AS (SELECT node, min(low) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM documents d JOIN least ON node = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""


# One vector, one row: part p of 16, its integers v.
CODES_SQL = """
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, label, p, q[p * (len(q) // 16) + 1:(p + 1) * (len(q) // 16)] AS v FROM kept, range(16) t(p)
), book0 AS MATERIALIZED (
  SELECT p, e, v FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < 64) USING (vec_id)
), {rounds}
book AS (SELECT * FROM book2), digest AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2
), coded AS (
  SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', best % 64), '' ORDER BY p) AS code, sum(best // 64)::BIGINT AS error FROM near2 GROUP BY vec_id
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM coded, digest
"""
# The nearest entry of each part as distance * 64 + index, then the entries' means.
CODES_NEAR = """near{i} AS MATERIALIZED (
  SELECT vec_id, label, a.p, a.v, min(list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * 64 + e) AS best
  FROM parts a JOIN book{i} b USING (p) GROUP BY ALL
),"""
CODES_MEAN = """mean{i} AS (
  SELECT p, e, list(m ORDER BY pos) AS v FROM (
    SELECT p, best % 64 AS e, pos, floor(sum(v[pos]) / count(*))::BIGINT AS m FROM near{i}, range(1, 65) t(pos) WHERE pos <= len(v) GROUP BY ALL
  ) GROUP BY ALL
), book{j} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{i} b LEFT JOIN mean{i} m ON b.p = m.p AND b.e = m.e),"""
CODES_SQL = CODES_SQL.format(rounds="".join(CODES_NEAR.format(i=i) + CODES_MEAN.format(i=i, j=i + 1) for i in range(2)) + CODES_NEAR.format(i=2))

TERMS = "regexp_extract_all(" + LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SEARCH_SQL = f"""
WITH bags AS MATERIALIZED (SELECT doc_id, {TERMS} AS w FROM documents
), sizes AS (SELECT doc_id, len(w) AS n FROM bags WHERE len(w) > 0
), total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes
), tfs AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM bags) GROUP BY ALL
), dfs AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM tfs, total GROUP BY term, docs
), asked AS (SELECT DISTINCT item_id, unnest({TERMS}) AS term FROM benchmark
), scores AS (
  SELECT item_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::BIGINT AS score
  FROM asked JOIN dfs USING (term) JOIN tfs USING (term) JOIN sizes USING (doc_id), total GROUP BY ALL
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 50
"""

COSINE_SQL = """
WITH RECURSIVE sound AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS x, b.vec_id AS y FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
  SELECT vec_id AS node, vec_id AS low FROM embeddings
  UNION
  SELECT l.y, r.low FROM reach r JOIN links l ON l.x = r.node WHERE r.low < l.y
), least AS (SELECT node, min(low) AS component_id FROM reach GROUP BY node)
SELECT vec_id, (SELECT count(*) FROM links WHERE x = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON node = vec_id
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [
        op1_secret_scan, op2_warc, op3_decontaminate, op4_mix, op5_line_dedup,
        op6_main_text, op7_embedding_dedup, op8_toxicity, op9_ngram_jaccard, op10_language_id,
        op11_vector_codes, op12_curve_packing, op13_ranked_search,
    ]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {
        "op5_line_dedup": LINE_SQL, "op7_embedding_dedup": COSINE_SQL, "op9_ngram_jaccard": JACCARD_SQL,
        "op11_vector_codes": CODES_SQL, "op13_ranked_search": SEARCH_SQL,
    }
