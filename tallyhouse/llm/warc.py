"""WARC derivatives: a metadata record and a plain-text conversion record for every response, linked to it.

A derivative refers to its response by identifier, address and date. The metadata record holds the response's own
headers, lengths and digests with the title and links of the page; the conversion record holds the page's text.
Record identifiers follow from what a record refers to, so building again gives the same records, and a lost task
can be run anywhere. ``write`` makes WARC files out of records, and ``parse`` reads one back.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import read

VERSION = "WARC/1.1"
# The supplied pages have no time of capture.
NO_DATE = "1970-01-01T00:00:00Z"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the namespace of addresses

# Elements without text of the page, and elements that end a line.
_SILENT = frozenset("script style noscript template svg iframe object textarea select".split())
_LINE = frozenset(
    "address article aside blockquote body br caption dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hr html li main nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
_RUNS_ON = ("script", "style")  # without an end tag, these reach to the end of the page
_markup = re.compile(r"<(?:(!--)|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_comment = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))", re.S)
_rest_of_tag = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_mark_in_tag = re.compile(r"""[>"']""")
_closing = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in _SILENT}
_hides_on = re.compile(r"<!--|<(?:script|style)(?=[\s/]|\Z)", re.I)
_end_of_title = re.compile(r"</title\s*>", re.I)
_attribute = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_blanks = re.compile(r"[^\S\n]+")
_control = re.compile(r"[\x00-\x1f\x7f-\x9f\u2028\u2029]")


def _tag_end(page: str, at: int) -> int:
    """Where a tag ends whose name ends at ``at``: after the first > outside quotes; 0 if there is none.

    A quote without a second one is a character like others. Of these a page has two at most, so a page's tags are run
    through in one pass, however they are closed.
    """
    if found := _rest_of_tag.match(page, at):
        return found.end()
    while found := _mark_in_tag.search(page, at):
        if found[0] == ">":
            return found.end()
        at = page.find(found[0], found.end()) + 1 or found.end()
    return 0


def pieces(page: str) -> Iterator[tuple[int, int, str | None, int]]:
    """(first, last, what, end): the text ``page[first:last]``, and what stands from ``last`` to ``end``.

    That is a tag, by its name (a slash before it in an end tag), something hidden (a blank), a declaration (empty), or
    nothing (None, at the end of the page). Hidden are comments, and silent elements from their tag to their first end tag. A silent
    element without an end tag, and one closed in its own tag, hides its tag only; but script and style, which no
    tag closes by itself, hide the rest of the page if they have no end tag, and so does a comment without an end. A tag ends at
    the first > outside quotes; where quotes swallow the page, at the first > from there on.

    One pass: what was searched in vain to the end of the page is not searched again.
    """
    at, quoted, never_closed = 0, True, set()
    while found := _markup.search(page, at):
        start, name = found.start(), (found[3] or "").lower()
        if found[1]:
            end = _comment.match(page, start).end()
            yield at, start, " ", end
            at = end
            continue
        end = _tag_end(page, found.end()) if name and quoted else 0
        if not end:
            quoted = quoted and not name
            end = page.find(">", found.end()) + 1
        if not end:
            # No tag ends here any more: all else is text, up to what hides the rest.
            if hides := _hides_on.search(page, start):
                yield at, hides.start(), " ", len(page)
                return
            break
        what = found[2] + name if name else ""
        if name in _SILENT and not found[2]:
            what = " "
            if name not in never_closed and (page[end - 2] != "/" or name in _RUNS_ON):
                closing = _closing[name].search(page, end)
                closed = page.find(">", closing.end()) + 1 if closing else 0
                if closed:
                    end = closed
                elif name in _RUNS_ON:
                    end = len(page)
                else:
                    never_closed.add(name)
        yield at, start, what, end
        at = end
    yield at, len(page), None, len(page)


def page_text(page: str) -> str:
    """The text of a page: no markup, scripts or comments; entities resolved; a line for each block that has text.

    What stands inside noscript, template, svg, iframe, object, textarea and select elements is left out as well.
    """
    out = []
    for first, last, what, _ in pieces(page):
        out.append(page[first:last].replace("\n", " "))
        if what and what.removeprefix("/") in _LINE:
            out.append("\n")
        elif what == " ":
            out.append(" ")
    lines = (_blanks.sub(" ", line).strip() for line in html.unescape("".join(out)).split("\n"))
    return "\n".join(line for line in lines if line)


def page_facts(page: str) -> dict:
    """Title and links, in their order."""
    title, titled, links = None, 0, []
    for _, last, what, end in pieces(page):
        if what == "title" and not titled:
            titled = end
            if closed := _end_of_title.search(page, end):
                title = " ".join(html.unescape(page[end : closed.start()]).split())
        elif what == "a":
            attributes = ((m[1].lower(), m[2] or m[3] or m[4]) for m in _attribute.finditer(page, last + 2, end - 1))
            if href := next((value for name, value in attributes if name == "href" and value), None):
                links.append(html.unescape(href))
    return {"title": title, "links": links}


def header_value(value: str) -> str:
    """``value`` on one line: control characters and line ends as percent escapes of their UTF-8 bytes."""
    return _control.sub(lambda c: "".join(f"%{b:02X}" for b in c[0].encode("utf-8")), value)


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, chr(10).join(parts))}>"


RECORD = (
    "record_type string, record_id string, refers_to string, target_uri string, date string, content_type string, "
    "content_length long, block_digest string, source_payload_digest string, headers map<string,string>, block string"
)


def derivatives(key: int | None, source_id: str, uri: str | None, date: str, headers: dict[str, str], payload: str | None) -> list[tuple]:
    """The metadata record and the conversion record of one response."""
    page = payload or ""
    body = page.encode("utf-8")
    payload_digest, text = digest(body), page_text(page)
    facts = {
        "source": {
            "WARC-Record-ID": source_id,
            "WARC-Payload-Digest": payload_digest,
            "Content-Length": len(body),
            "headers": dict(sorted(headers.items())),
        },
        "page": page_facts(page),
    }
    out = []
    for kind, content_type, block in (
        ("metadata", "application/json", json.dumps(facts, ensure_ascii=False, separators=(",", ":"))),
        ("conversion", "text/plain; charset=utf-8", text),
    ):
        raw = block.encode("utf-8")
        own = record_id(kind, source_id)
        head = {
            "WARC-Type": kind,
            "WARC-Record-ID": own,
            "WARC-Date": date,
            "WARC-Refers-To": source_id,
            "WARC-Refers-To-Date": date,
            "WARC-Block-Digest": digest(raw),
            "Content-Type": content_type,
            "Content-Length": str(len(raw)),
        }
        if uri is not None:
            head |= {"WARC-Target-URI": uri, "WARC-Refers-To-Target-URI": uri}
        head = {name: header_value(value) for name, value in head.items()}
        out.append((key, kind, own, source_id, uri, date, content_type, len(raw), head["WARC-Block-Digest"], payload_digest, list(head.items()), block))
    return out


def build(responses: DataFrame) -> DataFrame:
    """Two records for every row of ``responses`` (key long, record_id, target_uri, date, headers map, payload).

    A null record_id is made from key, address and payload. Null or empty payloads give a metadata record without
    title and links and an empty conversion record; a null address is left out of the headers; a null date is the
    epoch; null headers are none. Repeated rows give repeated records with the same identifiers. Other columns are not
    read; an empty table gives no rows. A page takes time in proportion to its length, whatever its tags, quotes and elements
    leave open. Control characters and line ends in addresses, dates and identifiers stand percent-encoded in the record's
    headers, so that no value can begin a header of its own; the columns have them as they came.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), *[pa.string()] * 6, pa.int64(), pa.string(), pa.string(), pa.map_(pa.string(), pa.string()), pa.string()]
        names = ["key", *(part.split()[0] for part in RECORD.split(", "))]
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                rows = []
                for key, own, uri, date, headers, payload in zip(*(c.to_pylist() for c in part.columns)):
                    own = own or record_id("response", str(key), uri or "", digest((payload or "").encode("utf-8")))
                    rows += derivatives(key, own, uri, date or NO_DATE, dict(headers or ()), payload)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    columns = ["key", "record_id", "target_uri", "date", F.col("headers").cast("map<string,string>").alias("headers"), "payload"]
    return responses.select(*columns).mapInArrow(made, f"key long, {RECORD}")


def record_text(headers: Column, block: Column) -> Column:
    """A record without the two line ends that follow it: version, headers in their order, an empty line, the block."""
    head = F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return F.concat(F.lit(VERSION + "\r\n"), F.array_join(head, "\r\n"), F.lit("\r\n\r\n"), block)


def write(records: DataFrame, path: str) -> None:
    """WARC files of ``records`` in a folder, one for each partition."""
    records.select(record_text(F.col("headers"), F.col("block"))).write.option("lineSep", "\r\n\r\n").text(path)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a WARC file."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode("utf-8").split("\r\n")
        if version != VERSION:
            raise ValueError(f"not a record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines)
        size = int(headers["Content-Length"])
        yield headers, data[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The derivatives of every page; key is its page_id."""
    pages = read(spark, folder, "pages")
    text = lambda: F.lit(None).cast("string")
    responses = pages.select(
        F.col("page_id").alias("key"),
        text().alias("record_id"),
        F.col("url").alias("target_uri"),
        text().alias("date"),
        F.create_map(F.lit("Content-Type"), F.lit("text/html; charset=utf-8")).alias("headers"),
        F.col("html").alias("payload"),
    )
    return build(responses).withColumnRenamed("key", "page_id")
