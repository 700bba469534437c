import re
from collections import Counter, defaultdict

import duckdb

from tillstream.llm import queries, source_audit
from tests.llm.conftest import SMALL

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def by_hand(rows, least=10, top=10):
    """The result, term by term."""
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        terms = re.findall("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+", lower)
        groups[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    made = []
    share = lambda n, total, v: 1 + 10**9 * (n + 2) // (total + 2 * v)
    apart = lambda p, q: (p - q) ** 2 // (p + q)
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= least]
        own = {s: {t: c[t] for t in kept} for (l, s), c in groups.items() if l == lang}
        p = {s: {t: share(n, sum(c.values()), len(kept)) for t, n in c.items()} for s, c in own.items()}
        total = {t: sum(c[t] for c in own.values()) for t in kept}
        q = {t: share(n, sum(total.values()), len(kept)) for t, n in total.items()}
        for s in own:
            pairs = [(sum(apart(p[s][t], p[o][t]) for t in kept), o) for o in own if o != s]
            terms = [(apart(p[s][t], q[t]), t) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, found, last in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                made += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:last])]
    return sorted(made)


def test_against_a_plain_version(text_spark, documents):
    rows = list(map(tuple, documents.select("text", "lang", "source").collect()))
    for least in (10, 2):
        found = source_audit.audit(documents, least)
        assert found.columns == COLUMNS and sorted(map(tuple, found.collect())) == by_hand(rows, least)


def test_query_against_its_sql(text_spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = db.execute(queries.llm_oracles()["op13_sources"]).fetchall()
    found = queries.llm_queries()["op13_sources"](text_spark, SMALL)
    assert sorted(map(tuple, found.collect())) == sorted(want) and want


def test_terms_in_several_chunks_of_a_document(text_spark):
    """Ten documents have x, nine have y, some of them in several chunks; the copies of a document count each."""
    rows = [(i, f"x, X. (x) {'y y, y.' if i < 9 else ''} Caf\u00c9-caf\u00c9", "en", f"s{i % 3}") for i in range(9)]
    rows += [(9, "x! x?", "en", "s0"), (9, None, None, None), (None, "", "en", "s7"), (1, "q", "de", "s1"), (1, "q", "de", "s2")]
    docs = text_spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs = docs.selectExpr("*", "1 AS value", "2 AS rank", "'z' AS Term").repartition(3)
    kept = {r.term for r in source_audit.kept_terms(docs).collect()}
    assert kept == {"x"}
    found = source_audit.audit(docs)
    assert sorted(map(tuple, found.collect())) == by_hand([(t, l, s) for _, t, l, s in rows])
    assert source_audit.audit(docs.limit(0)).count() == 0
