"""Packing: every id in one piece, no padding, neighbours alike."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.llm import packing
from tideline.llm.curve import hilbert, project

TEXTS = [
    "Hello, world! It's 42 degrees; don't panic... (really)", None, "", " \n\t ", "x", "Çà et là — naïve café étude ok next", "dog's. \"Quoted.\" end.",
    "a.b,c d", "mixed\x0bvertical\x0cfeed\x1cgroup", "<|endoftext|> and <|ENDOFTEXT|>.", "漢字かな交じり文。 한국어. ไทย", "İstanbul ŞIŞLI ΑΣ. ΑΣ", "word. word, WORD word!! wo.rd. ́x.", "éé, É. ñandú! ßtraße ŉ ŁÓDŹ; µ ſ ÿ ª º ǆ e\u0301. ì´",
    "🙂🙂. 1234567890.", "'s 't 're. ''", "z" * 5000, "lorem ipsum dolor " * 3000,
]


def ids_of(texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(packing.default_tokenizer())
    return [model.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_encoder_gives_the_ids_of_the_tokenizer():
    model = packing.Encoder(packing.default_tokenizer())
    for _ in range(2):  # the second time from memory
        assert [x.tolist() for x in model.ids(TEXTS)] == ids_of(TEXTS)
    assert model.ids([]) == []
    for limit in (1, 7, 100):  # long texts piece by piece
        assert [x.tolist() for x in model.ids(TEXTS, limit)] == ids_of(TEXTS)


def test_runs_are_encoded_once_whatever_their_case_and_marks():
    model = packing.Encoder(packing.default_tokenizer())
    bases, marks = [f"b{c}zz" for c in "aeiouéèžø"], [chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'"]
    words = [f(b) + m for b in bases for f in (str, str.title, str.upper) for m in ["", "...", *marks]]
    assert [x.tolist() for x in model.ids([" ".join(words)])] == ids_of([" ".join(words)])
    assert len(model.place) <= len(bases) + len(marks) + 2


def test_every_letter_and_mark_as_a_word():
    letters = [chr(c) for c in [*range(0x21, 0x7F), *range(0xA1, 0x250), 0x1E9E, 0x212A, 0x212B, 0x307, 0x338]]
    words = [w for c in letters for w in (c, f"x{c}", f"{c}x", f"X{c}Y.", f"{c}.", f"x{c}=", f"{c}\u0307", f"x{c}\u0338,")]
    model = packing.Encoder(packing.default_tokenizer())
    assert [x.tolist() for x in model.ids(words)] == ids_of(words)


def check(rows, want, length):
    """``rows`` of pack() hold the documents of ``want`` (id -> list of id lists)."""
    docs, sequences = {}, {}
    for r in rows:
        ids = np.frombuffer(r["ids"], dtype="<u4").tolist()
        assert len(ids) == r["length"] > 0
        docs.setdefault(r["doc_id"], []).append((r["start"], ids, r["doc_tokens"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], len(ids)))
    for doc_id, texts in want.items():
        assert sum(map(len, texts)) == sum(len(x[1]) for x in docs[doc_id])
        if len(texts) == 1:
            whole = []
            for start, ids, total in sorted(docs[doc_id]):
                assert start == len(whole) and total == len(texts[0])
                whole += ids
            assert whole == texts[0]
    assert set(docs) == set(want)
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at == length or (at < length and at & (at - 1) == 0)
    return sequences


@pytest.mark.parametrize("shard_chars", [1 << 23, 4000])
def test_every_id_lies_in_one_piece(spark, shard_chars):
    rows = list(enumerate(TEXTS)) + [(None, "no id"), (7, "same id, other text")] + [(100 + i, "copy of a copy " * 9) for i in range(300)]
    df = spark.createDataFrame([(i, t, "x", 3, 4) for i, t in rows], "doc_id long, text string, place string, shard int, length int").repartition(5)
    want = {}
    for (i, _), ids in zip(rows, ids_of([t for _, t in rows])):
        want.setdefault(i, []).append(ids + [packing.END])
    got = packing.pack(df, shard_chars=shard_chars).collect()
    sequences = check(got, want, packing.LENGTH)
    if shard_chars == 4000:
        assert len({s >> 32 for s in sequences}) > 5  # copies do not share a shard


def test_short_sequences_and_no_rows(spark):
    df = spark.createDataFrame([(i, f"text number {i}") for i in range(20)], "doc_id long, text string")
    check(packing.pack(df, length=8).collect(), {i: [x + [1]] for i, x in enumerate(ids_of([f"text number {i}" for i in range(20)]))}, 8)
    assert packing.pack(df.limit(0)).collect() == []


def test_curve_visits_neighbouring_cells():
    side = 8
    cells = np.stack(np.meshgrid(*[np.arange(side)] * 3, indexing="ij"), -1).reshape(-1, 3)
    u = (cells + 0.5) / side
    place = hilbert(np.log(u / (1 - u)) / 1.702, bits=3)
    assert sorted(place) == list(range(side**3))
    walk = cells[np.argsort(place)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_neighbours_on_the_curve_are_alike():
    rng = np.random.default_rng(0)
    topics = rng.integers(0, 2**63, (30, 200), dtype=np.uint64)
    topic = rng.integers(0, 30, 2000)
    place = hilbert(project([rng.choice(topics[t], 150) for t in topic]))
    order = np.argsort(place)
    assert (np.diff(topic[order]) == 0).mean() > 3 / 30  # 1 / 30 in a random order


def test_documents_of_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = packing.pack(docs).collect()
    check(got, {i: [x + [1]] for (i, _), x in zip(rows, ids_of([t for _, t in rows]))}, packing.LENGTH)
