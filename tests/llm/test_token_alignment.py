import hashlib
from collections import Counter

import public_tokenizers
import pytest

from tillstream.llm import queries, token_alignment
from tests.llm.conftest import SMALL

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def by_hand(rows):
    """The result, token by token, with the libraries alone."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_model = Tokenizer.from_file(A)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=B)
    alphabet = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(b): b for b in alphabet}
    chars |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in alphabet)}
    docs = []
    for doc_id, text in rows:
        if not text:
            docs.append((doc_id, [], [], [], []))
            continue
        a = a_model.encode(" " + text, add_special_tokens=False).ids
        b = b_model.encode(text)
        a_bytes = [bytes(chars[c] for c in a_model.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if b_model.is_byte(i) else p.replace("\u2581", " ").encode()
                   for i, p in ((i, b_model.id_to_piece(i)) for i in b)]
        if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            a = b = a_bytes = b_bytes = []
        links, groups, i, j, ends_a, ends_b = [], [], 0, 0, 0, 0
        own_a, own_b = [], []
        while i < len(a) and j < len(b):
            links.append((a[i], b[j]))
            end_a, end_b = ends_a + len(a_bytes[i]), ends_b + len(b_bytes[j])
            if end_a <= end_b:
                own_a.append(str(a[i]))
            if end_b <= end_a:
                own_b.append(str(b[j]))
            if end_a == end_b:
                groups.append(",".join(own_a) + "|" + ",".join(own_b))
                own_a, own_b = [], []
            if end_a <= end_b:
                i, ends_a = i + 1, end_a
            if end_b <= end_a:
                j, ends_b = j + 1, end_b
        docs.append((doc_id, a, b, links, groups))
    count = Counter(pair for *_, links, _ in docs for pair in set(links))
    most = Counter()
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    return [(doc_id, len(a), len(b), len(groups), len(links), sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "") for doc_id, a, b, links, groups in docs]


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("pairs", [1 << 22, 900])
def test_against_a_plain_version(text_spark, documents, pairs):
    found = token_alignment.aligned(documents, A, B, pairs)
    assert rows_of(found) == sorted(by_hand(map(tuple, documents.select("doc_id", "text").collect())))


def test_odd_rows(text_spark, odd_rows):
    more = text_spark.createDataFrame(
        [(9, "<|endoftext|> a<s>b", 1, "x"), (10, "caf\u00e9 \u6f22\u5b57 \U0001f600", 1, "x"), (11, "two  blanks \u2581 x", 1, "x"),
         (12, " lead\tand \u00a0 trail ", 1, "x")], odd_rows.schema)
    docs = odd_rows.union(more)
    want = by_hand(map(tuple, docs.select("doc_id", "text").collect()))
    assert rows_of(token_alignment.aligned(docs, A, B)) == sorted(want, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))
    assert token_alignment.aligned(odd_rows.limit(0), A, B).count() == 0


def test_query_runs_over_all(text_spark):
    found = queries.llm_queries()["op12_alignment"](text_spark, SMALL)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert found.count() == 200
