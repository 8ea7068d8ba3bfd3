"""Samples of languages whose rows share ids and texts."""

from tideline.llm import langid


def test_rows_that_share_an_id_still_teach_their_language(spark):
    rows = [(2, f"das ist ein satz nummer {i} mit vielen worten", "de") for i in range(4000)]
    rows += [(2, "toujours la même phrase avec beaucoup de mots", "fr")] * 4000  # one text, one id
    rows += [(i, f"some sentence number {i} with many words", "en") for i in range(300)]
    docs = spark.createDataFrame([(i, t, lang, 1) for i, t, lang in rows], "doc_id long, text string, lang string, held int")
    data = dict(langid.dictionaries(docs, folds=4, held_out=2))
    assert set(data) == {"de", "fr", "en"} and all(len(d) > 1000 for d in data.values())
    assert langid.samples(docs, 4, 2).count() <= 3 * langid.DOCS
