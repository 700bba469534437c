import random
import re
from itertools import combinations

from tillstream.llm import odd_sketches, queries
from tillstream.llm.components import components
from tests.llm.conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def check(found, rows):
    want = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want
    assert all(r.kept == (r.component_id == r.doc_id) for r in found)


def test_query_against_brute_force(text_spark, documents):
    found = queries.llm_queries()["op8_odd_sketches"](text_spark, SMALL).collect()
    check(found, [tuple(r) for r in documents.select("doc_id", "text").collect()])


def edited(rng, words, share):
    return [rng.choice("pqrstuv") * 4 if rng.random() < share else w for w in words]


def test_large_groups_in_small_blocks(text_spark, monkeypatch):
    """Groups whose members are near the limit, so that many pairs are tested and few link."""
    rng = random.Random(5)
    rows, bases = [], [[f"w{rng.randrange(4000)}" for _ in range(150)] for _ in range(3)]
    for i in range(240):
        rows.append((i, " ".join(edited(rng, bases[i % 3], rng.choice([0.01, 0.02, 0.03, 0.04])))))
    monkeypatch.setattr(odd_sketches, "BLOCK", 3000)
    docs = text_spark.createDataFrame(rows, "doc_id long, text string")
    check(odd_sketches.near_duplicates(docs).collect(), rows)


def test_odd_rows(odd_rows):
    found = sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept)
                   for r in odd_sketches.near_duplicates(odd_rows).collect() if r.doc_id is not None)
    assert found == [(1, 9, 1, True), (2, 0, 2, True), (3, 0, 3, True), (3, 1, 3, True), (3, 1, 3, True),
                     (4, 1, 4, True), (5, 1, 5, True)]
    kept = odd_sketches.one_of_each(odd_rows)
    assert kept.columns == odd_rows.columns and sorted((r.doc_id or 0, r.text or "")[:1] + ((r.text or "")[:4],) for r in kept.collect()) == [
        (0, ""), (1, "x y "), (2, ""), (3, ""), (3, "  \n "), (4, "wwww"), (5, "123 ")]
    assert odd_sketches.near_duplicates(odd_rows.limit(0)).count() == 0


def test_components_of_a_chain(text_spark):
    edges = [(i, i + 1) for i in range(100)] + [(500, 501), (501, 501), (None, 3)]
    found = components(text_spark.createDataFrame(edges, "a long, b long"), "a", "b")
    assert {r.a: r.label for r in found.collect()} == {**{i: 0 for i in range(101)}, 500: 500, 501: 500}
