import hashlib
import re

import public_tokenizers

import corpus_pipeline
from tillstream.llm import bpe_codec, nearest_toxic
from tests.llm.conftest import SMALL
from tests.llm.test_bpe_codec import library_once
from tests.llm.test_near_duplicates import brute as groups
from tests.llm.test_tiling import covered, tokens


def test_stages_against_plain_versions(text_spark, documents):
    docs, columns = documents, documents.columns
    for name, step in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = step(text_spark, docs, SMALL)
        after = {r.doc_id: r for r in docs.collect()}
        docs = text_spark.createDataFrame(list(after.values()), docs.schema)
        if name != "encoding":
            assert docs.columns == columns
        if name == "toxicity":
            labels = text_spark.read.parquet(f"{SMALL}/labels.parquet")
            scored = nearest_toxic.toxicity(documents, labels).collect()
            assert after.keys() == {r.doc_id for r in scored if not r.predicted}
        elif name == "near duplicates":
            want = {i for i, (n, root) in groups([(i, r.text) for i, r in before.items()]).items() if root == i}
            assert after.keys() == want
        elif name == "decontamination":
            items = [tokens(r.text) for r in text_spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
            gone = before.keys() - after.keys()
            assert gone and all(any(covered(item, tokens(before[i].text), 5) >= len(item) / 2 for item in items)
                                for i in sorted(gone)[:3])
            joined = {i: f" {' '.join(tokens(r.text))} " for i, r in after.items()}
            assert not any(f" {' '.join(item)} " in text for text in joined.values() for item in items)
        elif name == "personal data":
            assert after.keys() == before.keys()
            assert all(r.n_chars == len(r.text) for r in after.values())
            mail = re.compile(r"\S+@\S+\.com")
            assert not {m for r in before.values() for m in mail.findall(r.text)} & {
                m for r in after.values() for m in mail.findall(r.text)}
        else:
            library = library_once()
            decode = bpe_codec.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken")).decode
            for i, row in after.items():
                assert row.n_tokens == len(library.encode_ordinary(before[i].text))
                assert decode(bytes(row.ids)).decode() == before[i].text
                assert row.ids_sha256 == hashlib.sha256(bytes(row.ids)).hexdigest()


def test_run_gives_the_last_stage(text_spark):
    found = corpus_pipeline.run(text_spark, SMALL)
    assert found.columns == ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"] and found.count() > 100


def test_odd_and_empty_documents(text_spark, odd_rows):
    docs = odd_rows.selectExpr("doc_id", "text", "IDS AS lang", "CAST(NULL AS STRING) AS source", "CAST(score AS BIGINT) AS n_chars")
    # Seven different pairs of id and text; one of the two equal rows goes.
    for frame, rows in ((docs, 7), (docs.limit(0), 0)):
        for name, step in corpus_pipeline.STAGES:
            frame = step(text_spark, frame, SMALL)
        assert frame.count() == rows


def test_odd_rows_and_clashing_columns_pass_all_stages(text_spark, odd_rows):
    """Null and shared ids, equal rows, and columns with the names that operators give their results."""
    text = " ".join(f"clean{i}" for i in range(40))
    more = text_spark.createDataFrame(
        [(None, text, 1, "x"), (None, text.replace("clean1", "other1"), 1, "x"), (70, "one text of id seventy", 1, "x"), (70, "another text", 1, "x")],
        odd_rows.schema)
    docs = odd_rows.union(more).selectExpr("*", "0.5 AS predicted", "'e' AS Evidence", "7 AS n_replaced", "'k' AS row_key", "true AS is_toxic")
    for name, step in corpus_pipeline.STAGES:
        before, docs = docs, step(text_spark, docs, SMALL)
        if name != "encoding":
            assert docs.columns == before.columns
        docs = text_spark.createDataFrame(docs.collect(), docs.schema)
        if name == "near duplicates":
            assert sorted(r.text for r in docs.where("doc_id = 70").collect()) == ["another text", "one text of id seventy"]
            assert docs.where(f"doc_id IS NULL AND text LIKE '{text[:6]}%'").count() >= 1
    assert docs.where("doc_id = 70").count() == 2
