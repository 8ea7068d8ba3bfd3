"""Language identification by compression.

Each language has a dictionary: the texts of a bounded sample of its labelled
rows (``DOCS`` at most, by hash order, up to ``DICT_BYTES``), used by zstandard
as raw content.  Texts are lower-cased and what is no letter becomes a space, so
that layout does not count.  A text is cut into pieces of ``PIECE`` characters and each
piece is compressed with every dictionary; the language whose pieces take the
fewest bytes wins (of equals, the one with the most labelled rows).  Where the margin between the two best is narrow, the text
is compressed once more without a dictionary and the answer is ``rejected``
if no language saves as much as the margin asks; the least size still names it.

Null texts and texts without a letter are ``und`` with score 0.  The score is
the share of the best language in a soft maximum of the saved bytes, between
0 and 1.  With no labelled rows every text is ``und``.  Repeated rows get equal
results; a null doc_id counts as the empty text in the fold.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from tideline.llm.common import fold, slices

DOCS = 256  # labelled rows of a language that its dictionary is drawn from
DICT_BYTES = 112 << 10
DOC_CHARS = 600  # of one row, so that no row fills a dictionary
PIECE = 1024  # characters compressed at a time
LEVEL = 6
SHORT, SHORT_LEVEL = 256, 19  # characters up to which a text is compressed harder
MARGIN = 0.01  # of the bytes: narrower wins are marked as rejected
UNKNOWN = "und"
OTHER = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """The text in lower case, each run of other characters a space."""
    return f" {OTHER.sub(' ', text.lower()).strip()} "


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def samples(docs: DataFrame, folds: int, held_out: int) -> DataFrame:
    """(lang, text) of the first ``DOCS`` rows of each language by a hash of id and
    text.  A count of each language bounds the hashes that can be among the first,
    so the window sorts a few times ``DOCS`` rows of a language."""
    own = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id"), folds) != held_out))
    own = own.select("lang", "text", "doc_id", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)).alias("turn"))
    counts = own.groupBy("lang").agg(F.count("*").alias("held"), F.min("turn").alias("least"))
    # the least hash of a language stays in any case: equal rows share one, and may be all it has
    among = (F.col("turn") * F.col("held") <= F.lit(4 * DOCS * (1 << 30))) | (F.col("turn") == F.col("least"))
    likely = own.join(F.broadcast(counts), "lang").filter(among)
    first = F.row_number().over(Window.partitionBy("lang").orderBy("turn", "doc_id"))
    return likely.withColumn("rank", first).filter(F.col("rank") <= DOCS).select("lang", "held", "rank", F.substring("text", 1, DOC_CHARS).alias("text"))


def dictionaries(docs: DataFrame, folds: int = 4, held_out: int = 2) -> list[tuple[str, bytes]]:
    """(language, dictionary), the language with the most rows first."""
    texts: dict[tuple[int, str], list[tuple[int, str]]] = {}
    for row in samples(docs, folds, held_out).collect():  # at most DOCS short texts of each language
        texts.setdefault((-row["held"], row["lang"]), []).append((row["rank"], row["text"]))
    out = []
    for (_, lang), own in sorted(texts.items()):
        data = "".join(letters(t) for _, t in sorted(own) if has_letter(t)).encode("utf-8", "replace")
        if data:
            out.append((lang, data[:DICT_BYTES]))
    return out


class Classifier:
    def __init__(self, data: list[tuple[str, bytes]]):
        self.langs = [lang for lang, _ in data]
        self.coders, self.short = [], []
        for _, raw in data:
            for level, coders in ((LEVEL, self.coders), (SHORT_LEVEL, self.short)):
                known = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                known.precompute_compress(level=level)
                coders.append(self._coder(dict_data=known))
        self.plain = self._coder(level=LEVEL)

    @staticmethod
    def _coder(**how) -> zstandard.ZstdCompressor:
        return zstandard.ZstdCompressor(write_checksum=False, write_content_size=False, write_dict_id=False, **how)

    def classify(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected)."""
        if not text or not self.langs or not has_letter(text):
            return UNKNOWN, 0.0, True
        text = letters(text)
        pieces = [text[i : i + PIECE].encode("utf-8", "replace") for i in range(0, len(text), PIECE)]
        sizes = np.array([sum(len(c.compress(p)) for p in pieces) for c in (self.short if len(text) <= SHORT else self.coders)], dtype=float)
        best = int(np.argmin(sizes))
        share = np.exp(-np.clip((sizes - sizes[best]) / (0.02 * sizes[best] + 2), 0, 700))
        rest = np.delete(sizes, best)
        narrow = len(rest) > 0 and rest.min() - sizes[best] < MARGIN * sizes[best]
        rejected = bool(narrow and sum(len(self.plain.compress(p)) for p in pieces) - sizes[best] < MARGIN * sizes[best])
        return self.langs[best], float(share[best] / share.sum()), rejected


def classify(docs: DataFrame, data: list[tuple[str, bytes]]) -> DataFrame:
    """``docs`` with ``__tl_lang``, ``__tl_score``, ``__tl_rejected``."""
    names = [*docs.columns, "__tl_lang", "__tl_score", "__tl_rejected"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Classifier(data)
        for part in slices(parts):
            lang, score, rejected = [], [], []
            for text in part.column("text"):
                found = own.classify(text.as_py())
                lang.append(found[0])
                score.append(found[1])
                rejected.append(found[2])
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], names=names)

    more = [StructField("__tl_lang", StringType()), StructField("__tl_score", DoubleType()), StructField("__tl_rejected", BooleanType())]
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *more]))
