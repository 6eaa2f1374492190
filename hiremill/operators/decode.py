"""Page decoding: MIME archive to HTML, HTML to listing fields."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from email import message_from_bytes, policy
from functools import lru_cache
from html import unescape
from html.entities import html5
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiremill.functions.text import last_path_segment, normalize_newlines, or_empty
from hiremill.schemas import BRONZE

# HTML elements without content, and elements whose text is not shown.
VOID = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split()
)
HIDDEN = frozenset("script style template rt rp".split())


@dataclass(frozen=True)
class Selector:
    """First element with this tag and/or attribute value; reads its text, or ``read``'s attribute."""

    tag: str | None = None
    attr: str | None = None
    value: str | None = None
    read: str | None = None

    def matches(self, tag: str, attrs: dict[str, str]) -> bool:
        return (self.tag is None or self.tag == tag) and (self.attr is None or attrs.get(self.attr) == self.value)


def meta(name: str, attr: str = "property") -> Selector:
    """``content`` of the first ``<meta {attr}={name}>``."""
    return Selector("meta", attr, name, "content")


# The layout of a saved job page.
JOB_PAGE = {
    "url": meta("og:url"),
    "description": Selector(attr="data-automation", value="jobAdDetails"),
    "job_title": Selector(attr="data-automation", value="job-detail-title"),
    "company": Selector(attr="data-automation", value="advertiser-name"),
}


class _FieldReader(HTMLParser):
    """One forward pass over a page that keeps the text of the selected elements only."""

    def __init__(self, spec: dict[str, Selector]):
        super().__init__(convert_charrefs=False)
        self.waiting = dict(spec)
        self.open: list[str] = []
        self.reading: dict[str, int] = {}
        self.pieces: dict[str, list[str]] = {}
        self.found: dict[str, str | None] = {}
        self.node: list[str] = []

    def read(self, page: str) -> dict[str, str | None]:
        self.feed(page)
        self.close()
        self.end_node()
        return self.found | {name: " ".join(parts) for name, parts in self.pieces.items()}

    def end_node(self) -> None:
        text = "".join(self.node).strip()
        self.node.clear()
        if text and not HIDDEN.intersection(self.open):
            for name in self.reading:
                self.pieces[name].append(text)

    def close_to(self, depth: int) -> None:
        del self.open[depth:]
        self.reading = {name: d for name, d in self.reading.items() if d < depth}

    def handle_starttag(self, tag, attrs):
        self.end_node()
        values = {name: value or "" for name, value in attrs}
        for name in [n for n, s in self.waiting.items() if s.matches(tag, values)]:
            attribute = self.waiting.pop(name).read
            if attribute:
                content = values.get(attribute)
                self.found[name] = content.strip() if content else None
            else:
                self.pieces[name] = []
                self.reading[name] = len(self.open)
        self.open.append(tag)
        if tag in VOID:
            self.close_to(len(self.open) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.close_to(len(self.open) - 1)

    def handle_endtag(self, tag):
        self.end_node()
        if tag in self.open:
            self.close_to(len(self.open) - 1 - self.open[::-1].index(tag))

    def handle_data(self, data):
        self.node.append(data)

    def handle_charref(self, name):
        self.node.append(unescape(f"&#{name};"))

    def handle_entityref(self, name):
        # An unknown name keeps its ampersand but not the semicolon.
        self.node.append(html5.get(f"{name};", f"&{name}"))

    def _skip(self, _text):
        self.end_node()

    handle_comment = handle_decl = handle_pi = _skip

    def unknown_decl(self, data):
        self.end_node()
        if data.upper().startswith("CDATA["):
            self.node.append(data[len("CDATA["):])
            self.end_node()


def _mime_policy() -> policy.EmailPolicy:
    """The default rules with parsed headers kept: the parser asks for the same ones many times."""
    return policy.default.clone(header_factory=lru_cache(maxsize=4096)(policy.default.header_factory))


def _html_part(content: bytes, rules: policy.EmailPolicy) -> tuple[str | None, str | None, str | None]:
    """``(html, error_kind, error)`` of one archive."""
    try:
        for part in message_from_bytes(content, policy=rules).walk():
            body = part.get_payload(decode=True) if part.get_content_type() == "text/html" else None
            if body:
                return body.decode(part.get_content_charset("utf-8"), errors="replace"), None, None
        return None, "no_html", "no HTML content found"
    except Exception as exc:  # one bad archive must not end the job
        return None, "other", f"{type(exc).__name__}: {exc}"


#: How much raw text is Python objects at a time.
PIECE_BYTES = 1 << 20


def _pieces(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``PIECE_BYTES`` in ``column``: a batch of Spark's can be of 64 MB, and far larger as Python objects."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        of_row = np.cumsum(sizes) // PIECE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(of_row)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            yield batch.slice(start, end - start)


def _with_key(key: pa.Array, names: list[str], columns: list[list[str | None]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([key, *[pa.array(c, pa.string()) for c in columns]], names=names)


def decode_mhtml(pages: DataFrame) -> DataFrame:
    """``(doc_key, content)`` archives to bronze rows; failures keep a row with their kind.

    The HTML is the first non-empty ``text/html`` part, depth first, with
    undecodable bytes replaced.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = _mime_policy()
        for piece in _pieces(batches, "content"):
            rows = [_html_part(bytes(c.as_py()), rules) for c in piece.column("content")]
            yield _with_key(piece.column("doc_key"), BRONZE.fieldNames(), [[r[i] for r in rows] for i in range(3)])

    return pages.select("doc_key", "content").mapInArrow(decode, BRONZE)


def bronze_summary(bronze: DataFrame) -> DataFrame:
    failed = F.col("error_kind").isNotNull()
    return bronze.agg(
        F.count("*").alias("total"),
        F.count_if(~failed).alias("extracted"),
        F.count_if(failed).alias("failed"),
    )


def extract(pages: DataFrame, spec: dict[str, Selector], key: str = "doc_key", html: str = "html") -> DataFrame:
    """One string column per selector; NULL when no element matches or a read attribute is empty.

    A page without text keeps its row, with all columns NULL.
    """
    names = list(spec)
    key_type = pages.schema[key].dataType.simpleString()
    schema = ", ".join([f"`{key}` {key_type}", *[f"`{n}` string" for n in names]])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches, html):
            found = [_FieldReader(spec).read(page.as_py()) if page.is_valid else {} for page in piece.column(html)]
            yield _with_key(piece.column(key), [key, *names], [[f.get(n) for f in found] for n in names])

    return pages.select(key, html).mapInArrow(read, schema)


def extract_listings(bronze: DataFrame) -> DataFrame:
    """Bronze pages to ``(doc_key, source_id, job_title, company, description)``, absent fields ``''``."""
    pages = bronze.select("doc_key", normalize_newlines("html").alias("html"))
    found = extract(pages, JOB_PAGE)
    return found.select(
        "doc_key",
        last_path_segment("url").alias("source_id"),
        *[or_empty(n).alias(n) for n in ("job_title", "company", "description")],
    )
