import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tillstream.llm import lattice, queries
from tests.llm.conftest import SMALL

PATH = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def weigh(word, weights):
    """Sum over all segmentations, by plain recursion from the left."""
    text, reached = b" " + word, [1.0]
    for end in range(1, len(text) + 1):
        reached.append(sum(reached[i] * weights.get(text[i:end], 0.0) for i in range(end)))
    return reached[-1]


@pytest.fixture(scope="module")
def start():
    pairs = lattice.vocabulary(PATH)
    return [p for p, _ in pairs], np.array([w for _, w in pairs])


def test_forward_against_plain_recursion(start):
    pieces, weights = start
    assert pieces[0] == lattice.END and abs(weights.sum() - 1) < 1e-12
    table = dict(zip(pieces[1:], weights[1:]))
    some = [b"the", b"ation", "été".encode(), b"x", b"a\xff\x00b", b"therefore" * 3, b"</s>", b""]
    found = np.zeros(len(some))
    model = lattice.Lattice(pieces, weights)
    for rows, letters in lattice.by_length(pa.array(some, pa.binary())):
        found[rows] = model.log_probability(letters)
    assert np.allclose(found, [math.log(weigh(w, table)) for w in some])


def test_expected_counts_against_all_segmentations(start):
    pieces, weights = start
    model, table = lattice.Lattice(pieces, weights), dict(zip(pieces[1:], weights[1:]))
    place = {p: i for i, p in enumerate(pieces)}

    def ways(text):
        if not text:
            yield []
        for k in range(1, len(text) + 1):
            if text[:k] in table:
                yield from ([text[:k], *rest] for rest in ways(text[k:]))

    want, total = np.zeros(len(pieces)), weigh(b"then", table)
    for way in ways(b" then"):
        share = math.prod(table[p] for p in way) / total
        for p in way:
            want[place[p]] += 3 * share
    into = np.zeros(len(pieces))
    for _, letters in lattice.by_length(pa.array([b"then"], pa.binary())):
        model.expected(letters, np.array([3.0]), into)
    assert np.allclose(into, want)


def check(found, rows, train):
    counts = Counter()
    for i, text in rows:
        if train(i):
            counts.update(words(text))
            counts["\0end"] += 1
    total, kinds = sum(counts.values()), len(counts)
    for row, (i, text) in zip(found, rows):
        tokens = [*words(text), "\0end"]
        base = sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in tokens)
        assert row[:5] == (i, not train(i), len(tokens), sum(counts[t] > 0 for t in tokens), total)
        assert math.isclose(row.base_score, base, rel_tol=1e-9, abs_tol=1e-9) and row.score < 0


def test_query_against_the_definition(text_spark, documents):
    found = sorted(queries.llm_queries()["op10_lattice"](text_spark, SMALL).collect())
    rows = sorted(map(tuple, documents.select("doc_id", "text").collect()))
    check(found, rows, lambda i: zlib.crc32(str(i).encode()) % 7 != 2)


def test_joined_words_equal_hot_words(documents):
    """With hardly any hot words nearly all go through the join; nothing changes."""
    some = documents.where("doc_id < 40")
    a, b = (sorted(lattice.probabilities(some, PATH, rounds=1, hot=n).collect()) for n in (3, 10**6))
    for x, y in zip(a, b, strict=True):
        assert x[:5] == y[:5] and np.allclose(x[5:], y[5:])


def test_odd_rows(odd_rows):
    found = lattice.probabilities(odd_rows, PATH, rounds=1).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in found) == [
        (0, 1), (1, 27_001), (2, 1), (3, 1), (3, 2), (3, 2), (4, 2), (5, 3)]
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in found)
    assert lattice.probabilities(odd_rows.limit(0), PATH, rounds=1).count() == 0


def test_sources_are_found_in_all_training_documents(text_spark):
    """Against plain expectation maximisation over 5 000 texts; a source of a few texts is told apart as well."""
    draw, names = np.random.default_rng(3), "abcdefgh"
    texts = [" ".join(f"{names[i % 5]}{n}" for n in draw.integers(0, 9, 12)) for i in range(4_990)]
    texts += [" ".join(f"rare{n}" for n in draw.integers(0, 9, 12)) for _ in range(10)]
    docs = text_spark.createDataFrame([(t, i % 50 == 1) for i, t in enumerate(texts)], "text string, held_out boolean")
    sources, counts = lattice.find_sources(docs)
    learned = [words(t) for i, t in enumerate(texts) if i % 50 != 1]
    assert counts.count() == len(learned)

    spelled = sorted({w for t in learned for w in t})
    hashes = lattice.word_hashes(pa.array([w.encode() for w in spelled], pa.binary()))
    assert sorted(sources.markers.tolist()) == sorted(hashes.tolist())
    place = {h: i for i, h in enumerate(sources.markers.tolist())}
    at = {w: place[h] for w, h in zip(spelled, hashes.tolist())}
    rows = np.zeros((len(learned), len(at)))
    for i, text in enumerate(learned):
        for w in text:
            rows[i, at[w]] += 1
    # One more pass over all texts moves hardly anything: the distributions are those of all.
    fit = rows @ (sources.words.T / lattice._UNIT) + sources.weight / lattice._UNIT
    share = np.exp(fit - fit.max(1, keepdims=True))
    share /= share.sum(1, keepdims=True)
    uses = share.T @ rows + 0.05
    large = uses.sum(1) > 1000
    assert large.sum() == 5 and np.allclose(
        np.exp(sources.words[large] / lattice._UNIT), (uses / uses.sum(1, keepdims=True))[large], atol=1e-3)
    assert np.allclose(np.exp(sources.weight / lattice._UNIT), (share.sum(0) + 1) / (len(rows) + len(uses)), atol=1e-3)
    rare, others = set(fit[-10:].argmax(1)), set(fit[:-10].argmax(1))
    assert not rare & others and others == set(np.flatnonzero(large))
    assert lattice.document_counts(counts, sources).tolist() == np.bincount(fit.argmax(1), minlength=len(uses)).tolist()
