import base64

import pytest

from hiremill.operators import decode, silver
from hiremill.operators.decode import JOB_PAGE, Selector, _FieldReader


def read(page, **spec):
    return _FieldReader(spec or JOB_PAGE).read(page)


@pytest.mark.parametrize(
    "page, want",
    [
        ("<p>a<b> b </b>c</p>d", "a b c"),
        ("<p>a<!-- x -->b</p>", "a b"),
        ("<p>a &amp; b &lt;i&gt; &#233;&nbsp;</p>", "a & b <i> é"),
        ("<p>x<script>no()</script><style>p{}</style>y<template>t</template></p>", "x y"),
        ("<p>one<br>two<br/>three<img src=a>four</p>", "one two three four"),
        ("<p>open <b>bold <p>inner</p> tail", "open bold inner tail"),
        ("<p>a</i>b</p>c", "a b"),
        ("<p>a<div/>b</p>", "a b"),
        ("<p></p>", ""),
        ("<p>R&amp;D &unknown; 3 < 4</p>", "R&D &unknown 3 < 4"),
        ("<p>a&amp&lt;b&ampx; &copy2</p>", "a&<b&ampx &copy2"),
        ("<p>&#38;&#x27;&eacute</p>", "&'é"),
        ("<p>a<![CDATA[ b ]]>c</p>", "a b c"),
        ("<ruby><p>k<rt>ann</rt>l</p></ruby>", "k l"),
        ("<p>  \n </p>", ""),
        ("<P>upper</P>", "upper"),
    ],
)
def test_element_text(page, want):
    assert read(page, t=Selector(tag="p")) == {"t": want}


def test_first_match_only_and_missing():
    assert read('<i data-x="a">1</i><i data-x="a">2</i>', t=Selector(attr="data-x", value="a")) == {"t": "1"}
    assert read("<i>1</i>", t=Selector(attr="data-x", value="a")) == {}


def test_nested_selected_elements():
    page = '<div data-automation="jobAdDetails">a<h1 data-automation="job-detail-title">T</h1>b</div>'
    assert read(page) == {"description": "a T b", "job_title": "T"}


@pytest.mark.parametrize(
    "page, want",
    [
        ('<meta property="og:url" content=" u ">', {"url": "u"}),
        ('<meta property="og:url"><meta property="og:url" content="later">', {"url": None}),
        ('<meta property="og:url" content="">', {"url": None}),
        ('<meta name="og:url" content="u">', {}),
    ],
)
def test_meta(page, want):
    assert read(page, url=decode.meta("og:url")) == want


def archive(parts):
    lines = ["MIME-Version: 1.0", 'Content-Type: multipart/related; boundary="B"', ""]
    for kind, charset, body in parts:
        lines += ["--B", f"Content-Type: {kind}; charset={charset}", "Content-Transfer-Encoding: base64", ""]
        lines += [base64.b64encode(body).decode()]
    return "\r\n".join([*lines, "--B--", ""]).encode()


def test_decode_archives(spark):
    rows = [
        ("ok", archive([("text/plain", "utf-8", b"no"), ("text/html", "utf-8", "<p>é</p>".encode())])),
        ("latin", archive([("text/html", "iso-8859-1", "<p>é</p>".encode("latin-1"))])),
        ("empty-first", archive([("text/html", "utf-8", b""), ("text/html", "utf-8", b"<b>2</b>")])),
        ("bad-bytes", archive([("text/html", "utf-8", b"<p>\xff</p>")])),
        ("none", archive([("text/plain", "utf-8", b"x")])),
        ("charset", archive([("text/html", "no-such-charset", b"<p>x</p>")])),
        ("single", b"Content-Type: text/html\r\n\r\n<i>whole</i>"),
        ("nothing", b""),
    ]
    bronze = decode.decode_mhtml(spark.createDataFrame(rows, "doc_key string, content binary"))
    got = {r.doc_key: (r.html, r.error_kind) for r in bronze.collect()}
    assert got == {
        "ok": ("<p>é</p>", None),
        "latin": ("<p>é</p>", None),
        "empty-first": ("<b>2</b>", None),
        "bad-bytes": ("<p>\ufffd</p>", None),
        "none": (None, "no_html"),
        "charset": (None, "other"),
        "single": ("<i>whole</i>", None),
        "nothing": (None, "no_html"),
    }
    assert tuple(decode.bronze_summary(bronze).first()) == (8, 5, 3)


def test_listings_are_checked_in_field_order(spark):
    pages = [
        ("1", '<meta property="og:url" content="https://x/job/7//"><b data-automation="job-detail-title">T</b>'
              '<b data-automation="advertiser-name">C</b><p data-automation="jobAdDetails">a\r\nb</p>'),
        ("2", '<b data-automation="job-detail-title">T</b>'),
        ("3", '<meta property="og:url" content="https://x/8"><b data-automation="job-detail-title">\xa0</b>'),
        ("4", ""),
    ]
    checked = silver.check_listings(decode.extract_listings(spark.createDataFrame(pages, "doc_key string, html string")))
    assert [tuple(r) for r in silver.valid_listings(checked).collect()] == [("1", "7", "T", "C", "a\nb")]
    rejects = {r.doc_key: r.bad_field for r in silver.rejected_listings(checked).collect()}
    assert rejects == {"2": "source_id", "3": "job_title", "4": "source_id"}
    assert tuple(silver.silver_summary(checked).first()) == (4, 1, 3, 2, 1, 0, 0)


def test_a_batch_is_decoded_in_pieces_of_bounded_size():
    import pyarrow as pa

    pages = ["x" * 400_000, None, "é" * 300_000, "y" * 3_000_000, "", None, *["z" * 1000] * 2500]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(pages))), pa.array(pages)], names=["doc_key", "html"])
    pieces = list(decode._pieces(iter([batch, batch.slice(0, 0)]), "html"))
    assert [p for piece in pieces for p in piece.column("html").to_pylist()] == pages
    assert [k for piece in pieces for k in piece.column("doc_key").to_pylist()] == list(range(len(pages)))
    sizes = [[len((p or "").encode()) for p in piece.column("html").to_pylist()] for piece in pieces]
    assert all(sum(s[1:]) <= decode.PIECE_BYTES for s in sizes)


def test_keys_keep_their_type_and_pages_without_text_their_row(spark):
    rows = [(2**60 + 1, "<p>a</p>"), (None, "<p>b</p>"), (3, None), (4, "")]
    got = decode.extract(spark.createDataFrame(rows, "doc_key long, html string"), {"t": Selector(tag="p")})
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(2**60 + 1, "a"), (None, "b"), (3, None), (4, None)], key=str)
