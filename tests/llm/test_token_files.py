import zlib

import numpy as np
import public_tokenizers

from tillstream.llm import queries, token_files
from tests.llm.conftest import SMALL

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def expected(rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(TOKENIZER)
    start = 0
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        yield doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_query_against_the_library(text_spark, documents):
    found = queries.llm_queries()["op7_token_files"](text_spark, SMALL).orderBy("start").collect()
    rows = sorted(map(tuple, documents.select("doc_id", "text").collect()))
    assert list(map(tuple, found)) == list(expected(rows))


def test_odd_rows_and_rare_characters(text_spark, odd_rows):
    rare = text_spark.createDataFrame([(9, "漢字 𰀀𰀁 a", 1, "x"), (8, "end<|endoftext|>of", 1, "x")], odd_rows.schema)
    rows = sorted(map(tuple, odd_rows.union(rare).select("doc_id", "text").collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    found = sorted(map(tuple, token_files.stored_tokens(odd_rows.union(rare), TOKENIZER).collect()),
                   key=lambda r: r[1])
    want = list(expected(rows))
    assert [f[0] for f in found] == [w[0] for w in want]
    assert sorted(f[2:] for f in found) == sorted(w[2:] for w in want)
    assert all(a[1] + a[2] == b[1] for a, b in zip(found, found[1:]))


def test_no_documents(odd_rows):
    assert token_files.stored_tokens(odd_rows.limit(0), TOKENIZER).count() == 0


def test_files_hold_the_ids(text_spark, odd_rows):
    manifest = token_files.write(odd_rows, token_files.new_folder(text_spark), TOKENIZER)
    assert not any(r.wide for r in manifest.collect())
    for row in token_files.read(manifest, with_ids=True).collect():
        assert len(row.ids) == row.n_tokens and row.ids[-1] == 0
