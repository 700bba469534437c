import numpy as np
import pyarrow as pa
import pytest

from tillstream.llm import language_codes, queries


@pytest.mark.parametrize("n, apart", [(2, 1), (3, 2), (4, 4), (7, 32), (8, 10), (40, 15)])
def test_codewords_differ_in_many_bits(n, apart):
    code = language_codes.codewords(n)
    away = ((code[:, None] != code[None]).sum(2) + 1000 * np.eye(n, dtype=int)).min()
    assert away >= apart and np.array_equal(code, language_codes.codewords(n))


def test_wrong_bits_are_corrected():
    model = language_codes.Model(["a", "b", "c", "d"], np.ones((4, language_codes.BUCKETS)))
    for y in range(4):
        for wrong in range(model.code.shape[1]):
            margins = model.code[y].astype(float).copy()
            margins[wrong] *= -0.5
            best, score = model.decode(margins[None])
            assert best[0] == y and 0.5 < score[0] <= 1


def test_query_on_held_out_rows(text_spark):
    folder = "/root/testdata/sf0.01"
    lang = text_spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = queries.llm_queries()["op3_language_codes"](text_spark, folder).join(lang, "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows) > 100
    assert all(0 <= r.score <= 1 and r.ambiguous == (r.score < language_codes.CLEAR) for r in rows)


def test_odd_rows(text_spark):
    rows = [(None, None, "x"), (3, "", "en"), (3, "123 !!", None), (1, "the and of", "en"), (2, "der die das", "de"),
            (4, "漢" * 20_000, None), (1, "the and of", "en")]
    docs = text_spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = [(r.doc_id, r.lang_pred, r.score > 0) for r in language_codes.languages(docs).collect()]
    assert len(found) == 7 and found.count((3, "und", False)) == 2 and (None, "und", False) in found
    assert found.count((1, "en", True)) == 2 and (2, "de", True) in found
    assert all(r.lang_pred == "und" for r in language_codes.languages(docs.where("doc_id = 4")).collect())
    one = language_codes.languages(docs.where("doc_id = 1")).first()
    assert (one.lang_pred, one.score) == ("en", 1.0)
    assert language_codes.languages(docs.limit(0)).count() == 0


def test_neighbours_do_not_matter():
    """The n-grams and margins of a text are the same alone and within any batch."""
    rng = np.random.default_rng(5)
    model = language_codes.Model(["a", "b", "c"], rng.integers(0, 50, (3, language_codes.BUCKETS)))
    texts = ["one", "", "zwei", "trois mots", "é", None, "x" * 50, "one"]
    batch = model.margins(pa.array([t or "" for t in texts]))
    for i, t in enumerate(texts):
        assert np.allclose(batch[i], model.margins(pa.array([t or ""]))[0], rtol=0, atol=1e-9)
    assert (batch[0] == batch[-1]).all() and (batch[0] == model.margins(pa.array(["one", "other"]))[0]).all()
