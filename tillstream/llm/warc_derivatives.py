"""Metadata and plain-text records derived from WARC response records.

A response record is parsed into its WARC headers, the HTTP head and the payload. Two records come of it:
`metadata` (application/warc-fields) with what the head, the title, the language and the links say, and
`conversion` (text/plain) with the readable text. Both refer to the response by its record id, keep its
target, date and payload digest, and have digests of their own blocks. Every header of the source stands
in the metadata, as often and in the order it came: HTTP headers as http-..., those of the WARC record
that no header of the derivative states as source-..., its block digest with a mark whether it holds. Names
of headers count in any case. Their ids are made from the source
id, so building them again gives the same records; the conversion's id stands in the metadata as well.

Defined results: null or malformed records, and records that are no responses, have no derivatives; an
empty payload has an empty conversion; a wrong source digest is kept and marked; unknown character sets
are read as UTF-8 with replacements; of a repeated header that may stand once, the first counts; repeated
records have repeated derivatives; an empty table has none. Columns of the input with the name of an output,
in any case, are left out.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillstream.llm.columns import fields, with_arrow

DERIVED = ("array<struct<warc_type: string, record_id: string, refers_to: string, target_uri: string, "
           "date: string, source_digest: string, block_digest: string, content_length: bigint, "
           "headers: map<string, string>, block: binary>>")
_NAMES = re.findall(r"(\w+):", DERIVED.partition("struct<")[2])

_OPEN = re.compile(r"<!--|<(script|style|noscript|template|svg|head)(?=[\s/>]|$)[^>]*>?", re.I)
_CLOSE = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "noscript", "template", "svg")}
# What can stand in a head; whatever else comes ends it.
_IN_HEAD = re.compile(
    r"\s+|<!--.*?-->|<(script|style|noscript|template|title|noframes)(?=[\s/>]).*?</\1\s*>"
    r"|<(?:meta|link|base|basefont|bgsound)(?=[\s/>])[^>]*>|</head\s*>", re.S | re.I)
_BLOCK = re.compile(
    r"<(?:/?(?:p|div|h[1-6]|ul|ol|li|dl|dt|dd|table|tr|article|section|header|footer|nav|aside|main|blockquote|pre"
    r"|form|figure|figcaption|address|hr)|br)\b[^>]*>", re.I)
_CELL = re.compile(r"</?t[dh]\b[^>]*>", re.I)
_TAG = re.compile(r"<[!/?]?[a-zA-Z][^>]*>|<![^>]*>")
_SPACES = re.compile(r"[^\S\n]+")
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([\w-]+)", re.I)
_LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_CHARSET = re.compile(rb"charset\s*=\s*[\"']?([\w-]+)", re.I)
_META_CHARSET = re.compile(rb"<meta\b[^>]*?\bcharset\s*=\s*[\"']?\s*([\w-]+)", re.I)
_HEAD_END = re.compile(rb"</head\s*>|<body[\s>]", re.I)
# Headers of a source that its derivatives' own headers state.
_STATED = {"warc-type", "warc-record-id", "warc-target-uri", "warc-date", "warc-payload-digest", "content-length"}


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def serialised(headers: dict[str, str], block: bytes) -> bytes:
    """A WARC/1.1 record."""
    head = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def _fields(head: bytes) -> tuple[str, list[tuple[str, str]]]:
    """The first line and the fields of a head, all in their order; folded lines go on the line before."""
    lines = re.sub(rb"\r?\n[ \t]+", b" ", head).decode("utf-8", "replace").replace("\r\n", "\n").split("\n")
    pairs = (line.partition(":") for line in lines[1:] if ":" in line)
    return lines[0], [(k.strip(), v.strip()) for k, _, v in pairs]


def _firsts(pairs: list[tuple[str, str]]) -> dict[str, str]:
    """The first value of each field, by its name in lower case."""
    return {k.lower(): v for k, v in reversed(pairs)}


def _split(data: bytes) -> tuple[bytes, bytes]:
    at = re.search(rb"\r?\n\r?\n", data)
    return (data[:at.start()], data[at.end():]) if at else (data, b"")


def fields_and_block(record: bytes) -> tuple[list[tuple[str, str]], bytes] | None:
    """All headers of a record in their order, and its block; None where it is malformed."""
    head, rest = _split(record)
    version, pairs = _fields(head)
    length = _firsts(pairs).get("content-length", "")
    if not version.startswith("WARC/") or not re.fullmatch("[0-9]+", length) or int(length) > len(rest):
        return None
    return pairs, rest[:int(length)]


def parsed(record: bytes) -> tuple[dict[str, str], bytes] | None:
    """Headers by name and block of a record, or None where it is malformed."""
    found = fields_and_block(record)
    return found and (dict(found[0]), found[1])


def _visible(page: str) -> str:
    """The page without its head, comments, scripts and other elements that are not shown.

    A head without an end tag ends at the first thing that can't stand in one. Of a noscript, template or
    svg without one, only the tag goes; a script, style or comment without one goes on to the end, as
    in HTML.
    """
    out, at, open_ended = [], 0, set()
    while found := _OPEN.search(page, at):
        out += [page[at:found.start()], " "]
        name = (found[1] or "").lower()
        at = found.end()
        if not name:
            end = page.find("-->", at)
            at = end + 3 if end >= 0 else len(page)
        elif name == "head":
            last = ""
            while not last.startswith("</") and (part := _IN_HEAD.match(page, at)):
                last, at = part[0], part.end()
        elif not (name == "svg" and found[0].endswith("/>")):
            end = None if name in open_ended else _CLOSE[name].search(page, at)
            if end:
                at = end.end()
            elif name in ("script", "style"):
                at = len(page)
            else:
                open_ended.add(name)
    return "".join(out) + page[at:]


def readable(page: str) -> str:
    """The text of a page: one line for each block, no markup, runs of blanks as one."""
    text = _visible(page)
    text = _CELL.sub("\t", _BLOCK.sub("\n", _SPACES.sub(" ", text.replace("\n", " "))))
    lines = (_SPACES.sub(" ", line).strip() for line in html.unescape(_TAG.sub("", text)).split("\n"))
    return "\n".join(line for line in lines if line)


def _decoded(payload: bytes, content_type: str) -> str:
    found = _CHARSET.search(content_type.encode())
    if not found:
        end = _HEAD_END.search(payload)
        found = _META_CHARSET.search(payload, 0, end.start() if end else len(payload))
    try:
        return payload.decode(found[1].decode() if found else "utf-8", "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def derived(record: bytes | None) -> list[dict]:
    """The metadata and the conversion record of a response."""
    found = fields_and_block(record) if record else None
    headers = _firsts(found[0]) if found else {}
    if headers.get("warc-type") != "response" or not headers.get("warc-record-id"):
        return []
    pairs, block = found
    head, payload = _split(block)
    status, http = _fields(head)
    source, own = headers["warc-record-id"], digest(payload)
    claimed = headers.get("warc-payload-digest", own)
    page = _decoded(payload, _firsts(http).get("content-type", ""))
    title, lang = _TITLE.search(page), _LANG.search(page)
    ids = {k: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{source}#{k}')}>" for k in ("metadata", "conversion")}
    text = readable(page).encode()
    about = [("conversion", ids["conversion"]), ("conversion-digest", digest(text)), ("http-status", status)]
    about += [(f"http-{k.lower()}", v) for k, v in http]
    about += [(f"source-{k.lower()}", v) for k, v in pairs if k.lower() not in _STATED]
    about += [("source-digest-valid", "yes" if claimed == own else "no")]
    if "warc-block-digest" in headers:
        about += [("source-block-digest-valid", "yes" if headers["warc-block-digest"] == digest(block) else "no")]
    about += [(k, _SPACES.sub(" ", html.unescape(m[1])).strip()) for k, m in (("title", title), ("language", lang)) if m]
    about += [("outlink", html.unescape("".join(m))) for m in _LINK.findall(page)]
    fields_block = "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in about).encode()
    out = []
    for kind, content, kind_of_content in (("metadata", fields_block, "application/warc-fields"),
                                           ("conversion", text, "text/plain; charset=utf-8")):
        made = {"WARC-Type": kind, "WARC-Record-ID": ids[kind], "WARC-Refers-To": source}
        kept = {"WARC-Target-URI": headers.get("warc-target-uri"), "WARC-Date": headers.get("warc-date"),
                "WARC-Refers-To-Date": headers.get("warc-date"), "WARC-Source-Payload-Digest": claimed,
                "WARC-Source-Block-Digest": headers.get("warc-block-digest")}
        made |= {k: v for k, v in kept.items() if v is not None}
        made |= {"WARC-Block-Digest": digest(content), "Content-Type": kind_of_content,
                 "Content-Length": str(len(content))}
        out.append(dict(zip(_NAMES, (
            kind, ids[kind], source, headers.get("warc-target-uri"), headers.get("warc-date"), claimed,
            made["WARC-Block-Digest"], len(content), list(made.items()), content))))
    return out


def responses(pages: DataFrame, date: str) -> DataFrame:
    """`record`, a response record for each page (page_id, url, html) as if fetched at `date`."""
    def prepare():
        def one(page_id, url, page) -> bytes:
            payload = (page or "").encode()
            block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                     b"Content-Length: %d\r\n\r\n" % len(payload)) + payload
            name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {url}")
            headers = {"WARC-Type": "response", "WARC-Record-ID": f"<urn:uuid:{name}>"}
            headers |= {"WARC-Target-URI": url} if url else {}
            headers |= {"WARC-Date": date, "WARC-Payload-Digest": digest(payload), "WARC-Block-Digest": digest(block),
                        "Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
            return serialised(headers, block)

        return lambda *columns: [pa.array([one(*row) for row in zip(*(c.to_pylist() for c in columns))], pa.binary())]

    return with_arrow(pages.select("page_id", "url", "html"), ["page_id", "url", "html"], fields(record="binary"),
                      prepare).select("page_id", "record")


def derivatives(records: DataFrame, record: str = "record") -> DataFrame:
    """A row for each derived record: the other columns of `records`, and the record's own."""
    kind = fields(derived=DERIVED)

    def prepare():
        from pyspark.sql.pandas.types import to_arrow_type

        arrow = to_arrow_type(kind["derived"].dataType)
        return lambda column: [pa.array([derived(r) for r in column.to_pylist()], arrow)]

    kept = [c for c in records.columns if c.lower() not in {n.lower() for n in (*_NAMES, record)}]
    found = with_arrow(records.select(*kept, record), [record], kind, prepare)
    return found.select(*kept, F.inline("derived"))


def as_records(made: DataFrame) -> DataFrame:
    """`made` with `record`, each derived record as WARC bytes."""
    head = F.array_join(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"], F.lit("\r\n"))), "")
    start = F.concat(F.lit("WARC/1.1\r\n"), head, F.lit("\r\n")).cast("binary")
    return made.withColumn("record", F.concat(start, "block", F.lit("\r\n\r\n").cast("binary")))
