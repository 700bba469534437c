import re

import pytest
from pyspark.sql import functions as F

from tillstream.llm import queries, surrogates
from tests.llm.conftest import SMALL


def test_types_and_formats(text_spark):
    rows = [
        (1, "Mail und.34@mail7.example.com or UND.34@MAIL7.EXAMPLE.COM!! at 97.51.17.173 now."),
        (2, "call +1 (017) 555-7713, card 4539578763621486 x 9807915762804490."),
        (3, 'token = "73d74656391396c3efc1d06034ff67f14d7a089e" ends'),
        (4, "Mrs Anna Smith met Mr John Smith and Mr. SMITH; Herr Müller. госпожа Анна Иванова"),
        (5, "Licensed under CC BY-NC 4.0. Version 2.0. plain text, 1234 words of 12.5."),
        (6, "ssn 123-45-6789 iban DE89 3704 0044 0532 0130 00 mac 00:1A:2b:3c:4d:5e und.34@mail7.example.com"),
    ]
    docs = text_spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.text, r.n_replaced) for r in surrogates.pseudonymised(docs, "k").collect()}
    one, _ = found[1]
    mail = re.fullmatch(r"Mail ([a-z]{3}\.\d\d@[a-z]{4}\d\.[a-z]{7}\.com) or (\S+)!! at (\d+)\.(\d+)\.(\d+)\.(\d+) now\.", one)
    assert mail and mail[2] == mail[1].upper() and all(1 <= int(mail[i]) <= 254 for i in range(3, 7))
    assert found[6][0].endswith(mail[1]) and mail[1] != "und.34@mail7.example.com"
    assert re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4}, card \d{16} x \d{16}\.", found[2][0])
    card = found[2][0].split("card ")[1][:16]
    digits = [int(d) for d in reversed(card)]
    assert sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0
    assert re.fullmatch(r'token = "[0-9a-f]{40}" ends', found[3][0]) and "73d746" not in found[3][0]
    name = re.fullmatch(r"Mrs (\w+a) (\w+sen) met Mr (\w+o) (\w+) and Mr\. (\w+); Herr (\w+)\. госпожа (\w+а) (\w+енко)", found[4][0])
    assert name and name[2] == name[4] and name[5] == name[2].upper() and not {"Anna", "Smith", "John"} & set(name.groups())
    assert found[5] == (rows[4][1], 0) and found[6][1] == 4
    assert re.match(r"ssn \d{3}-\d\d-\d{4} iban DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d mac (..:){5}.. ", found[6][0])
    other = surrogates.pseudonymised(docs, "another key").where("doc_id = 1").first().text
    assert other != one


def test_query_leaves_nothing_and_changes_nothing_else(text_spark, documents):
    found = {r.doc_id: r for r in queries.llm_queries()["op4_surrogates"](text_spark, SMALL).collect()}
    seen = re.compile(r"\S+@\S+\.com|\d{16}|\(\d{3}\) \d{3}-\d{4}|\d+\.\d+\.\d+\.\d+|[0-9a-fA-F]{40}")
    for row in documents.select("doc_id", "text").collect():
        private, new = seen.findall(row.text), found[row.doc_id].text
        assert found[row.doc_id].n_replaced == len(private)
        assert not any(p in new for p in private) and (new == row.text) == (not private)
        assert len(new.split()) == len(row.text.split())


def test_collisions_are_drawn_again(text_spark, monkeypatch):
    """With few possible values nearly all first draws collide; all end up different and none real."""
    values = [("ssn", f"{i}") for i in range(10, 40)]
    frame = text_spark.createDataFrame(values, "kind string, value string")
    found = [(r.value, r.surrogate) for r in surrogates.surrogates(frame, "k").collect()]
    assert len({s for _, s in found}) == 30 and not {s for _, s in found} & {v for _, v in values}
    monkeypatch.setattr(surrogates, "MOST_DRAWS", 3)
    full = text_spark.createDataFrame([("ssn", str(i)) for i in range(10)], "kind string, value string")
    with pytest.raises(ValueError, match="too few"):
        surrogates.surrogates(full, "k")


def test_odd_rows(odd_rows):
    found = surrogates.pseudonymised(odd_rows, "k")
    assert found.columns == [*odd_rows.columns, "n_replaced"]
    assert sorted(map(repr, (r[:4] for r in found.collect()))) == sorted(map(repr, (r[:] for r in odd_rows.collect())))
    assert surrogates.pseudonymised(odd_rows.limit(0), "k").count() == 0


def test_no_python_in_the_plan(documents):
    plan = surrogates.pseudonymised(documents, "k")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_no_number_of_names_or_short_addresses_is_too_many(text_spark):
    """More family names than three syllables have values, and all addresses of one letter each."""
    names = [("name:family", f"family{i}") for i in range(4500)]
    mails = [("email", f"{a}@{b}.co") for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"]
    frame = text_spark.createDataFrame(names + mails, "kind string, value string")
    found = [(r.kind, r.surrogate) for r in surrogates.surrogates(frame, "k").collect()]
    assert len(set(found)) == len(names + mails) == len(found)
    assert not set(found) & set(mails) and all(s.endswith("sen" if k != "email" else ".co") for k, s in found)
    text = " ".join(m for _, m in mails) + " A@B.CO"
    docs = text_spark.createDataFrame([(1, text)], "doc_id long, text string")
    put = surrogates.pseudonymised(docs, "k").first().text.split()
    assert len(set(put[:-1])) == len(mails) and put[-1] == put[1].upper() and not set(put) & set(text.split())
    assert all(p.endswith(".co") and p.count("@") == 1 for p in put[:-1])
