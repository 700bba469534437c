import hashlib
import statistics

from pyspark.sql import functions as F

from tillstream.llm import containment, queries
from tests.llm.conftest import SMALL


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 0))} or ({tuple(words)} if words else set())


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_query_against_the_definition(text_spark, documents):
    found = {r.doc_id: r for r in queries.llm_queries()["op2_containment"](text_spark, SMALL).collect()}
    rows = sorted(documents.select("doc_id", "text").collect(), reverse=True)
    assert len(found) == len(rows)
    errors, prints = [], {}
    for i, row in enumerate(rows):
        following, text = rows[(i + 1) % len(rows)].text or "", row.text or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        got = found[row.doc_id]
        assert got.n_chars == len(text)
        assert got.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, got.fingerprint) == got.fingerprint
        assert prints.setdefault(edited, got.edited_fingerprint) == got.edited_fingerprint
        errors += [abs(got.near_edited - likeness(shingles(text), shingles(edited))),
                   abs(got.near_next - likeness(shingles(text), shingles(following)))]
    assert statistics.mean(errors) < 0.03


def test_odd_rows(odd_rows):
    found = containment.edited_pairs(odd_rows).collect()
    assert len(found) == 8
    assert all((r.fingerprint == "") == (r.n_chars == 0) for r in found)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert containment.edited_pairs(odd_rows.limit(0)).count() == 0
    alone = containment.edited_pairs(odd_rows.where("doc_id = 5")).first()
    assert alone.near_next == 1.0 and alone.edited_sha256 == hashlib.sha256(b"123123").hexdigest()


def test_containment_of_unequal_documents_and_merging(text_spark):
    long = " ".join(f"w{i}" for i in range(4000))
    docs = text_spark.createDataFrame([(long, long[:4000], long[4000:])], "a string, b string, c string")
    for name in "abc":
        docs = containment.with_fingerprint(docs, name, f"f{name}")
    row = docs.select(
        containment.containment("fb", "fa").alias("inside"), containment.containment("fa", "fb").alias("share"),
        F.size(F.array_except("fa", containment.merged("fb", "fc"))).alias("lost"), F.size("fa").alias("kept")).first()
    assert row.inside > 0.98 and 0.1 < row.share < 0.3 and row.lost <= 5 and 800 < row.kept < 1200
