"""Held-out accuracy of the compression classifier, and its defined cases."""

from pyspark.sql import functions as F

from rainfold.llm import language
from rainfold.llm.common import held_out
from tests.conftest import SF_MID
from tests.llm.data import awkward_rows, documents


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    out = held_out("doc_id", 4, 2)
    got = language.identify(docs, language.learn(docs, ~out)).join(docs, "doc_id").where(out).toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.95
    long = got[got.n_chars > 400]
    assert (long.lang == long.lang_pred).mean() > 0.98
    assert got.score.between(0, 1).all()
    wrong = got[got.lang != got.lang_pred]
    assert wrong.score.mean() < got[got.lang == got.lang_pred].score.mean()


def test_smallest_frame_wins_and_ties_go_to_the_first(spark):
    import zstandard as Z

    docs = documents(spark, awkward_rows(4, 80))
    books = language.learn(docs, F.lit(True))
    assert set(books) == {"en", "de", "fr"} and all(len(b) <= language.DICT_BYTES for b in books.values())
    packers = {k: Z.ZstdCompressor(level=language.LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False,
                                   dict_data=Z.ZstdCompressionDict(b, dict_type=Z.DICT_TYPE_RAWCONTENT)) for k, b in books.items()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in language.identify(docs, books).collect():
        text = texts[r["doc_id"]]
        if r["doc_id"] is None:
            continue
        if text is None or not language.LETTER.search(text):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            sizes = {k: len(p.compress(language.plain(text))) for k, p in packers.items()}
            assert r["lang_pred"] == min(sorted(sizes), key=sizes.get)


def test_undetermined_and_empty(spark):
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, "123 %% 🎉", "en", "a"), (4, "word", None, "a")]
    docs = documents(spark, rows)
    books = language.learn(docs.where("doc_id = 4"), F.lit(True))
    assert books == {}
    assert {(r["lang_pred"], r["score"]) for r in language.identify(docs, books).collect()} == {("und", 0.0)}
    assert language.identify(documents(spark, []), {}).count() == 0
    one = language.identify(docs, {"en": b"some words of text"}).where("doc_id = 4").collect()[0]
    assert one["lang_pred"] == "en" and 0 <= one["score"] <= 1
