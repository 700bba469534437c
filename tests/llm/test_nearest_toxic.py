import zlib

import numpy as np

from tillstream.llm import nearest_toxic, queries
from tests.llm.conftest import SMALL


def test_nearest_against_brute_force():
    rng = np.random.default_rng(4)
    examples = []
    for _ in range(500):
        term = np.sort(rng.choice(30, rng.integers(1, 6), replace=False))
        weight = rng.choice([1.0, 2.0, 3.0], len(term))
        examples.append((term, weight / np.sqrt((weight ** 2).sum())))
    index = nearest_toxic.BlockMaxIndex(examples, 30)
    dense = np.zeros((500, 30))
    for i, (term, weight) in enumerate(examples):
        dense[i, term] = weight
    for q in range(60):
        cosine = np.round(dense @ dense[q], 9)
        cosine[q] = 0
        order = np.lexsort((np.arange(500), -cosine))[:15]
        order = order[cosine[order] > 0]
        ids, found = index.nearest(*examples[q], 15, without=q)
        assert ids.tolist() == order.tolist() and np.allclose(found, cosine[order])


def planted(text_spark, toxic_word="zork"):
    """Toxic texts hold one of two words; every text is padded with words of its own."""
    rows, labels = [], []
    for i in range(300):
        toxic = i % 6 == 0
        words = [f"w{(i * 37 + k * 11) % 90}" for k in range(40)] + [f"own{i}"]
        if toxic:
            words.insert(i % 40, toxic_word if i % 12 else "blarg")
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return (text_spark.createDataFrame(rows, "doc_id long, text string"),
            text_spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_planted_words_decide(text_spark):
    docs, labels = planted(text_spark)
    found = nearest_toxic.toxicity(docs, labels).collect()
    assert {r.doc_id for r in found if r.predicted} == {i for i in range(300) if i % 6 == 0}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert all(0 <= r.score <= 1 and (r.score >= 0.5) == (r.predicted == 1) for r in found)
    assert all(not r.held_out or r.doc_id not in {e.example for e in r.evidence} for r in found)


def test_labels_of_held_out_rows_are_not_learned(text_spark):
    docs, labels = planted(text_spark)
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    scores = [{r.doc_id: r.score for r in nearest_toxic.toxicity(docs, y).collect()} for y in (labels, turned)]
    assert scores[0] == scores[1]


def test_odd_rows(text_spark, odd_rows):
    docs, labels = planted(text_spark)
    odd_labels = labels.union(text_spark.createDataFrame([(1, None), (None, 1), (7, 1), (7, 0)], "doc_id long, toxic int"))
    model = nearest_toxic.fit(docs, odd_labels.where(~nearest_toxic.held_out()))
    found = nearest_toxic.scored(odd_rows.drop("score"), model).collect()
    assert len(found) == 8 and {r.score for r in found} == {model.free} and model.free < 0.1
    nothing = nearest_toxic.toxicity(odd_rows, labels.limit(0))
    assert {r.score for r in nothing.collect()} == {0.0}
    assert nearest_toxic.toxicity(odd_rows.limit(0), labels).count() == 0
    kept = nearest_toxic.not_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 250


def test_query_separates_held_out_rows(text_spark):
    found = queries.llm_queries()["op9_nearest_toxic"](text_spark, "/root/testdata/sf0.01")
    labels = text_spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "toxic")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    toxic, clean = ([r.score for r in rows if r.toxic == t] for t in (1, 0))
    wins = sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert wins > 0.75 and sum(r.predicted and not r.toxic for r in rows) <= 2


def test_empty_small_folder(text_spark):
    assert queries.llm_queries()["op9_nearest_toxic"](text_spark, SMALL).count() == 200


def test_all_words_and_examples_are_searched(text_spark):
    """Texts without a leaning word find their nearest examples by all words, as computed one by one."""
    docs, labels = planted(text_spark)
    model = nearest_toxic.fit(docs, labels.where(~nearest_toxic.held_out()))
    search = model.shared.value
    assert len(search.ids) == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(300))
    assert 0 < search.lean.sum() < 10 and len(search.idf) > 300
    own = text_spark.createDataFrame([(900, "w3 w14 w25 own7"), (901, "w80 w81")], "doc_id long, text string")
    found = {r.doc_id: r for r in nearest_toxic.scored(own, model).collect()}
    assert found[900].evidence[0].example == 7 and all(len(r.evidence) == 15 for r in found.values())
    assert found[900].score != found[901].score


def test_search_travels_whole(text_spark):
    import pickle

    docs, labels = planted(text_spark)
    search = nearest_toxic.fit(docs, labels.where(~nearest_toxic.held_out())).shared.value
    copy = pickle.loads(pickle.dumps(search))
    assert all(np.array_equal(getattr(search, k), getattr(copy, k))
               for k in ("hashes", "found", "idf", "lean", "ids", "toxic", "at", "terms", "counts"))


def test_blocks_of_common_terms_against_brute_force():
    """Terms in hundreds of examples go through blocks; many queries at once, some without examples of their own."""
    rng = np.random.default_rng(5)
    examples, n, terms = [], 3000, 400
    for i in range(n):
        share = 0.3 * np.where(np.arange(terms) % 4 == i % 4, 1.0, 0.1)
        share[:200] /= 20
        term = np.flatnonzero(rng.random(terms) < share)
        weight = np.log1p(rng.integers(1, 5, len(term)).astype(float))
        examples.append((term, weight / max(np.sqrt((weight ** 2).sum()), 1e-9)))
    examples[700:760] = [examples[3]] * 60
    index = nearest_toxic.BlockMaxIndex(examples, terms)
    assert index.blocks > 8 and 100 < (index.common >= 0).sum() < terms
    dense = np.zeros((n, terms))
    for i, (term, weight) in enumerate(examples):
        dense[i, term] = weight
    asked = list(range(0, n, 5)) + [700]
    without = [np.array([q, (q + 1) % n]) if q % 2 else -1 for q in asked]
    found = index.nearest_of([examples[q] for q in asked], 15, without)
    for q, gone, (ids, cosines) in zip(asked, without, found):
        cosine = np.round(dense @ dense[q], 9)
        if q % 2:
            cosine[gone] = 0
        order = np.lexsort((np.arange(n), -cosine))[:15]
        order = order[cosine[order] > 0]
        assert ids.tolist() == order.tolist() and np.allclose(cosines, cosine[order])
        alone = index.nearest(*examples[q], 15, gone)
        assert np.array_equal(alone[0], ids) and np.array_equal(alone[1], cosines)


def test_votes_and_scores_against_a_plain_version(text_spark):
    docs, labels = planted(text_spark)
    model = nearest_toxic.fit(docs, labels.where(~nearest_toxic.held_out()))
    search = model.shared.value

    def vectors(bounds, terms, counts, only=None):
        rows = np.zeros((len(bounds) - 1, len(search.hashes)))
        for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
            rows[i, terms[a:b]] = np.log1p(counts[a:b]) * np.log1p(len(search.ids) / search.found[terms[a:b]])
        if only is not None:
            rows[:, ~only] = 0
        return rows / np.maximum(np.sqrt((rows ** 2).sum(1, keepdims=True)), 1e-12)

    def vote(cosine):
        near = np.lexsort((np.arange(len(cosine)), -np.round(cosine, 9)))[:nearest_toxic.NEIGHBOURS]
        near = near[cosine[near] > 0]
        pull = 1 / (nearest_toxic.NEARNESS + 1 - np.minimum(cosine[near], 1))
        prior = nearest_toxic.PRIOR
        return (pull @ search.toxic[near] + prior * search.share) / (pull.sum() + prior)

    rows = docs.orderBy("doc_id").limit(60).toArrow()
    texts = list(nearest_toxic.counted_terms(rows["text"].combine_chunks(), search.table, len(search.hashes)))
    at = np.concatenate(([0], np.cumsum([len(t) for t, _ in texts])))
    asked = [at, *(np.concatenate([v[i] for v in texts]) for i in (0, 1))]
    kept = [search.at, search.terms, search.counts]
    pairs = [vectors(*asked, only) @ vectors(*kept, only).T for only in (None, search.lean)]
    odds = lambda p: np.log(np.clip(p, 1e-6, 1 - 1e-6) / (1 - np.clip(p, 1e-6, 1 - 1e-6)))
    scored = {r.doc_id: r for r in nearest_toxic.scored(docs, model).collect()}
    for i, doc_id in enumerate(rows["doc_id"].to_pylist()):
        first, second = vote(pairs[0][i]), vote(pairs[1][i]) if search.lean[texts[i][0]].any() else search.free
        plain = 1 / (1 + np.exp(-(model.curve @ [odds(first), odds(second), 1.0])))
        assert abs(scored[doc_id].score - plain) < 1e-9
        assert np.allclose([e.cosine for e in scored[doc_id].evidence], -np.sort(-pairs[0][i])[:15])


def test_driver_keeps_examples_packed(text_spark):
    """The driver holds no numbers of terms; they are unpacked where the index is built."""
    docs, labels = planted(text_spark)
    search = nearest_toxic.fit(docs, labels.where(~nearest_toxic.held_out())).shared.value
    assert not {"at", "terms", "counts"} & set(vars(search))
    assert search.packed.nbytes < (search.terms.nbytes + search.counts.nbytes) / 2
    texts = docs.where(~nearest_toxic.held_out()).orderBy("doc_id").toArrow()["text"].combine_chunks()
    plain = list(nearest_toxic.counted_terms(texts, search.table, len(search.hashes)))
    assert search.sizes.tolist() == [len(t) for t, _ in plain]
    assert np.array_equal(search.terms, np.concatenate([t for t, _ in plain]))
    assert np.array_equal(search.counts, np.concatenate([n for _, n in plain]))
    assert search.plain.tolist() == [not search.lean[t].any() for t, _ in plain]


def test_packed_terms_come_back():
    for terms, counts in (([], []), ([0], [1]), ([3, 70_000, 2**31 - 1], [1, 300, 70_000])):
        back = nearest_toxic._unpacked(len(terms), nearest_toxic._packed(np.array(terms, int), np.array(counts, int)))
        assert back.tolist() == [terms, counts]


def test_bounds_of_small_blocks():
    """The bounds that leave blocks out are those of 128 examples, not more."""
    n = 1000
    index = nearest_toxic.BlockMaxIndex([(np.array([0, 1 + i % 3]), np.array([0.6, 0.8])) for i in range(n)], 4)
    assert index.blocks == -(-n // 128) and all(cells.shape[1] == 128 for _, cells in index.dense)
    ids, cosines = index.nearest(np.array([2]), np.array([1.0]), 5)
    assert ids.tolist() == [1, 4, 7, 10, 13] and np.allclose(cosines, 0.8)


def test_terms_with_equal_first_bits_are_found():
    rng = np.random.default_rng(8)
    known = np.unique(rng.integers(0, 1 << 64, 500, np.uint64) >> np.uint64(24) | np.uint64(7 << 44))
    known = rng.permutation(np.append(known, rng.integers(0, 1 << 64, 500, np.uint64)))
    asked = np.concatenate((known[::2], rng.integers(0, 1 << 64, 300, np.uint64), known[:10] + np.uint64(1)))
    number = {h: i for i, h in enumerate(known.tolist())}
    places, found = nearest_toxic.TermTable(known).find(asked)
    assert dict(zip(places.tolist(), found.tolist())) == {
        i: number[h] for i, h in enumerate(asked.tolist()) if h in number}
    assert nearest_toxic.TermTable(known[:0]).find(asked)[0].size == 0
