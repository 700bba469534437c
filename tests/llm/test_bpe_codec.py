import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import regex
from hypothesis import given, settings, strategies as st

from tillstream.llm import bpe_codec, queries
from tillstream.llm.pretokens import PreTokenEncoder, cut
from tests.llm.conftest import SMALL

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    import tiktoken

    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aZé1٣ \n\t'!stremvld—  😀"), max_size=30))
def test_cut_is_the_pattern(text):
    points = np.append(np.frombuffer(text.encode("utf-32-le"), np.uint32), np.uint32(0x110000))
    at = cut(points).tolist()
    assert [text[a:b] for a, b in zip(at, at[1:])] == regex.findall(public_tokenizers.PATTERN, text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_encoder_agrees_with_the_library(texts):
    library = library_once()
    found = bpe_codec.encoder(RANKS).encode(texts)
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [library.encode_ordinary(t) for t in texts]
    decode = bpe_codec.vocabulary(RANKS).decode
    assert [decode(f) for f in found] == [t.encode() for t in texts]


def library_once(cache={}):
    if not cache:
        import tiktoken

        with open(RANKS, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        cache["it"] = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return cache["it"]


def test_table_is_emptied_and_long_pre_tokens_stand_alone():
    calls = []

    def encode(pieces):
        calls.append(pieces)
        return [[len(p)] for p in pieces]

    encoder = PreTokenEncoder(encode, limit=3)
    for text, ids in (("ab cd", [2, 3]), ("ef gh ij", [2, 3, 3]), ("a" * 600 + " b", [600, 2]), ("", [])):
        found, bounds = encoder.texts([text, text])
        assert found.tolist() == ids * 2 and bounds.tolist() == [0, len(ids), 2 * len(ids)]
    assert len(encoder.slots) <= 3


def test_query_against_the_library(text_spark, documents, library):
    found = {r.doc_id: r for r in queries.llm_queries()["op1_bpe_codec"](text_spark, SMALL).collect()}
    rows = documents.select("doc_id", "text").collect()
    assert len(found) == len(rows)
    for row in rows:
        ids = np.array(library.encode_ordinary(row.text or ""), "<u4").tobytes()
        text = (row.text or "").encode()
        assert found[row.doc_id][1:] == (
            len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest())


def test_odd_rows(odd_rows, library):
    back = bpe_codec.decode(bpe_codec.encode(odd_rows, RANKS), RANKS)
    assert back.columns == ["doc_id", "text", "score", "ids", "decoded"]
    rows = back.collect()
    assert len(rows) == 8
    for row in rows:
        assert bytes(row.decoded).decode() == (row.text or "")
        assert np.frombuffer(bytes(row.ids), "<u4").tolist() == library.encode_ordinary(row.text or "")
    assert bpe_codec.encode(odd_rows.limit(0), RANKS).count() == 0


def test_unknown_ids_are_refused():
    with pytest.raises(ValueError, match="no such token"):
        bpe_codec.vocabulary(RANKS).decode(np.array([60_000], "<u4").tobytes())
