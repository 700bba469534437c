import pytest

from tillstream.llm import queries, warc_derivatives as warc
from tests.llm.conftest import SMALL

PAGE = """<!DOCTYPE html><html lang="de"><head><title>A &amp; B</title><style>p{}</style><script>var t="</p>";</script></head>
<body><!-- no --><h1>A &amp; B</h1><p>one<b> two</b>
three<br>four</p><ul><li><a href="/x?a=1&amp;b=2">link</a></li><li><a href='y'>2</a></ul><table><tr><td>c1</td><td>c2</td></tr></table><script>end"""


def response(payload, head="HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Folded: a\r\n b", **more):
    block = f"{head}\r\n\r\n".encode() + payload
    headers = {"WARC-Type": "response", "WARC-Record-ID": "<urn:uuid:1>", "WARC-Target-URI": "http://a/",
               "WARC-Date": "2025-01-01T00:00:00Z", "Content-Length": str(len(block)), **more}
    return warc.serialised(headers, block)


def test_linked_records():
    meta, text = warc.derived(response(PAGE.encode()))
    assert text["block"].decode() == "A & B\none two three\nfour\nlink\n2\nc1 c2"
    assert (meta["refers_to"], text["refers_to"]) == ("<urn:uuid:1>",) * 2 and meta["record_id"] != text["record_id"]
    fields = [line.partition(": ")[::2] for line in meta["block"].decode().split("\r\n") if line]
    assert dict(fields[:-2]) == {
        "conversion": text["record_id"], "conversion-digest": text["block_digest"], "http-status": "HTTP/1.1 200 OK",
        "http-content-type": "text/html; charset=utf-8", "http-x-folded": "a b", "source-digest-valid": "yes",
        "title": "A & B", "language": "de"}
    assert fields[-2:] == [("outlink", "/x?a=1&b=2"), ("outlink", "y")]
    for made in (meta, text):
        assert made["block_digest"] == warc.digest(made["block"]) and made["date"] == "2025-01-01T00:00:00Z"
        assert made["source_digest"] == warc.digest(PAGE.encode()) and made["content_length"] == len(made["block"])
    assert warc.derived(response(PAGE.encode())) == [meta, text]


@pytest.mark.parametrize("record", [
    None, b"", b"WARC/1.1\r\n", b"junk", warc.serialised({"WARC-Type": "request", "Content-Length": "0"}, b""),
    response(b"x", **{"Content-Length": "99999"}), response(b"x", **{"Content-Length": "x"})])
def test_no_derivatives(record):
    assert warc.derived(record) == []


def test_charsets_and_wrong_digests():
    latin = response("é".encode("latin-1"), "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin-1",
                     **{"WARC-Payload-Digest": "sha1:WRONG"})
    meta, text = warc.derived(latin)
    assert text["block"].decode() == "é" and b"source-digest-valid: no" in meta["block"]
    assert text["source_digest"] == "sha1:WRONG"
    assert warc.derived(response(b"\xff", "HTTP/1.1 200\r\nContent-Type: x; charset=nope"))[1]["block"].decode() == "�"


def test_query_derives_two_records_of_each_page(text_spark):
    found = queries.llm_queries()["op6_warc_derivatives"](text_spark, SMALL).collect()
    pages = {r.page_id: r for r in text_spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    assert len(found) == 2 * len(pages) and len({r.record_id for r in found}) == len(found)
    for row in found:
        assert row.target_uri == pages[row.page_id].url and row.block_digest == warc.digest(bytes(row.block))
        assert row.source_digest == warc.digest(pages[row.page_id].html.encode())


def test_records_round_trip_and_odd_rows(text_spark):
    pages = text_spark.createDataFrame(
        [(None, None, None), (1, "http://a", "<p>x<script>b"), (1, "http://a", "<p>x<script>b"), (2, "u", "w" * 200_000)],
        "page_id long, url string, html string")
    made = warc.derivatives(warc.responses(pages, "2025-01-01T00:00:00Z"))
    rows = warc.as_records(made).collect()
    assert len(rows) == 8
    for row in rows:
        assert warc.parsed(bytes(row.record)) == (row.headers, bytes(row.block))
    clash = text_spark.createDataFrame([(1, b"junk", 5)], "headers int, record binary, page int")
    assert warc.derivatives(clash).columns[0] == "page" and warc.derivatives(clash).count() == 0
    assert warc.derivatives(clash.limit(0)).count() == 0


def test_elements_without_end_tags_hide_no_text():
    page = "<html><head><meta charset=x><title>T</title><style>s</style>{}<p>one</p><p>two</p>"
    for end in ("", "<body>", "</head><body>", "<!-- c --><body class=b>", "<link rel=a>"):
        assert warc.readable(page.format(end)) == "one\ntwo", end
    for name in ("svg", "noscript", "template"):
        assert warc.readable(f"<p>a</p><{name} x=1><p>b</p><{name}>c") == "a\nb\nc"
        assert warc.readable(f"<p>a</p><{name}>x</{name}><p>b</p>") == "a\nb"
    assert warc.readable("a<svg/>b<svg>x</svg>c") == "a b c"
    assert warc.readable("<p>a</p><script>b<p>c</p>") == "a"


def test_all_source_headers_and_digests_are_kept():
    block = (b"HTTP/1.1 200 OK\r\nSet-Cookie: a=1\r\nContent-Type: text/html\r\nset-cookie: b=2\r\n\r\n<p>x")
    head = ("warc-type: response\r\nWARC-RECORD-ID: <urn:uuid:7>\r\nwarc-ip-address: 10.0.0.1\r\n"
            "WARC-Concurrent-To: <urn:uuid:8>\r\nWARC-Concurrent-To: <urn:uuid:9>\r\n"
            f"WARC-Block-Digest: {warc.digest(block)}\r\nWarc-Payload-Digest: {warc.digest(b'<p>x')}\r\n"
            f"content-length: {len(block)}\r\n")
    meta, text = warc.derived(f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n")
    fields = [tuple(line.split(": ", 1)) for line in meta["block"].decode().split("\r\n") if line]
    assert [v for k, v in fields if k == "http-set-cookie"] == ["a=1", "b=2"]
    assert [f for f in fields if f[0].startswith("source-")] == [
        ("source-warc-ip-address", "10.0.0.1"), ("source-warc-concurrent-to", "<urn:uuid:8>"),
        ("source-warc-concurrent-to", "<urn:uuid:9>"), ("source-warc-block-digest", warc.digest(block)),
        ("source-digest-valid", "yes"), ("source-block-digest-valid", "yes")]
    for made in (meta, text):
        assert made["refers_to"] == "<urn:uuid:7>" and made["source_digest"] == warc.digest(b"<p>x")
        assert dict(made["headers"])["WARC-Source-Block-Digest"] == warc.digest(block)
    wrong = warc.derived(response(b"x", **{"WARC-Block-Digest": "sha1:NO"}))[0]
    assert b"source-block-digest-valid: no" in wrong["block"]


def test_charset_from_the_whole_head():
    late = b"<html><head><script>" + b"x" * 5000 + b"</script><meta charset=latin-1></head><body><p>\xe9"
    plain = "HTTP/1.1 200 OK\r\nContent-Type: text/html"
    assert warc.derived(response(late, plain))[1]["block"].decode() == "é"
    in_body = "<head></head><body><p>é &lt;meta charset=latin-1</p><meta charset=latin-1>".encode()
    assert warc.derived(response(in_body, plain))[1]["block"].decode() == "é <meta charset=latin-1"
    equiv = b"<META http-equiv=Content-Type content='text/html; charset=latin-1'><p>\xe9"
    assert warc.derived(response(equiv, plain))[1]["block"].decode() == "é"
