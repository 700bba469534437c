import random
import re

from tillstream.llm import queries, tiling
from tests.llm.conftest import SMALL


def tokens(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def covered(item, doc, least):
    """Greedy string tiling as it is written down: the longest free match, again and again."""
    marked, taken, total = [0] * len(item), [0] * len(doc), 0
    while True:
        best, where = least - 1, []
        for d in range(len(doc)):
            for p in range(len(item)):
                n = 0
                while p + n < len(item) and d + n < len(doc) and item[p + n] == doc[d + n] and not marked[p + n] \
                        and not taken[d + n]:
                    n += 1
                if n > best:
                    best, where = n, [(d, p)]
                elif n == best and n >= least:
                    where.append((d, p))
        if best < least:
            return total
        for d, p in where:
            if not any(marked[p:p + best]) and not any(taken[d:d + best]):
                marked[p:p + best], taken[d:d + best] = [1] * best, [1] * best
                total += best


def brute(docs, items, share=0.5):
    found = []
    for i, text in docs:
        for j, passage in items:
            item = tokens(passage)
            if item and (n := covered(item, tokens(text), min(5, len(item)))) >= share * len(item):
                found.append((i, j, len(item), n))
    return sorted(found)


def result(df):
    return sorted((r.doc_id, r.item_id, r.n_words, r.n_covered) for r in df.collect())


def test_against_brute_force(text_spark, monkeypatch):
    rng = random.Random(3)
    items = [(i, " ".join(rng.choice("abcde") for _ in range(rng.randrange(14)))) for i in range(12)]
    items += [(99, None), (50, "x y z q r s t u v w"), (51, "k1 k2"), (51, "k1 k2")]
    docs = [(i, ". ".join(rng.choice("abcde") for _ in range(rng.randrange(80)))) for i in range(30)]
    docs += [(100, None), (101, ""), (102, "s t u v w, X Y Z Q R ... K1 k2"), (103, "k1"), (102, "K1, k2")]
    frames = (text_spark.createDataFrame(docs, "doc_id long, text string"),
              text_spark.createDataFrame(items, "item_id long, text string"))
    want = brute(docs, items)
    assert (102, 50, 10, 10) in want
    assert result(tiling.matched(*frames)) == want
    monkeypatch.setattr(tiling, "BLOCK_CHARS", 40)  # several blocks of items
    assert result(tiling.matched(*frames)) == want
    monkeypatch.setattr(tiling, "_SLICE", 7)  # several slices of seeds
    assert list(tiling._pairs(*_one(docs, items))) and result(tiling.matched(*frames)) == want


def _one(docs, items):
    import pyarrow as pa

    _, hashes, at = next(tiling.word_rows(pa.array([t for _, t in docs])))
    return tiling.Items([i for i, _ in items], [t or "" for _, t in items]), hashes, at, 0.5


def test_slices_give_the_same_tiles(monkeypatch):
    rng = random.Random(8)
    docs = [(0, " ".join(rng.choice("ab") for _ in range(300)))]
    items = [(0, " ".join(rng.choice("ab") for _ in range(40)))]
    whole = [(r, i, c, sorted(t)) for r, i, c, t in tiling._pairs(*_one(docs, items))]
    monkeypatch.setattr(tiling, "_SLICE", 9)
    assert [(r, i, c, sorted(t)) for r, i, c, t in tiling._pairs(*_one(docs, items))] == whole != []


def test_query_finds_the_passages(text_spark, documents):
    found = result(queries.llm_queries()["op5_tiling"](text_spark, SMALL))
    items = [tuple(r) for r in text_spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    whole = {(i, j) for i, t in docs for j, p in items
             if f" {' '.join(tokens(p))} " in f" {' '.join(tokens(t))} "}
    assert whole and whole <= {(i, j) for i, j, *_ in found}


def test_odd_rows(text_spark, odd_rows):
    bench = text_spark.createDataFrame([(1, "X y z a b c"), (2, ""), (None, "w" * 30_000)], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in tiling.matched(odd_rows, bench).collect()) == [(1, 1), (4, None)]
    left = tiling.decontaminated(odd_rows, bench)
    assert left.columns == odd_rows.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 2, 3, 3, 3, 5]
    assert tiling.decontaminated(odd_rows, bench.limit(0)).count() == 8
    assert tiling.matched(odd_rows.limit(0), bench).count() == 0
