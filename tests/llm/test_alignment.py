import base64
import hashlib
from bisect import bisect_left
from collections import Counter

import public_tokenizers as vocabularies
import pytest
import sentencepiece
from tokenizers import Tokenizer

from hiremill.llm import alignment
from hiremill.llm.alignment import ByteTokenizer, PieceTokenizer, align_documents, aligned_counts
from hiremill.llm.queries import QUERIES
from tests.llm.helpers import EDGES, SF, documents

A, B = (vocabularies.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
BIG = 9_007_199_254_740_993


@pytest.fixture(scope="module")
def plain():
    """(ids, bytes) of both sides, each by the library of its file."""
    one, two = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    one.encode_special_tokens = True
    with open(vocabularies.path("byte_bpe_50k.tiktoken"), "rb") as file:
        entry = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, file)}

    def of_a(text):
        ids = one.encode(" " + text, add_special_tokens=False).ids
        return ids, [entry[i] for i in ids]

    def of_b(text):
        ids = two.encode(text)
        names = [two.id_to_piece(i) for i in ids]
        return ids, [bytes.fromhex(n[3:5]) if two.is_byte(i) else n.replace("▁", " ").encode() for i, n in zip(ids, names)]

    return of_a, of_b


def brute(texts, plain):
    """One row for each text: groups by end offsets, links as all pairs that end together."""
    rows, counts = [], Counter()
    for text in texts:
        ends, ids = [], []
        for side in plain:
            own, raw = side(text) if text else ([], [])
            if not text or b"".join(raw) != (" " + text).encode():
                own, raw = [], []
            total, at = 0, []
            for x in raw:
                total += len(x)
                at.append(total)
            ends.append(at)
            ids.append(own)
        if not ids[0] or not ids[1]:
            ids, ends = [[], []], [[], []]
        common = sorted(set(ends[0]) & set(ends[1]))
        parts = [[[], []] for _ in common]
        for side in (0, 1):
            for i, end in zip(ids[side], ends[side]):
                parts[bisect_left(common, end)][side].append(str(i))
        groups = ["|".join(map(",".join, both)) for both in parts]
        by_end = [dict(zip(at, own)) for at, own in zip(ends, ids)]
        links = [(by_end[0][e], by_end[1][e]) for e in common]
        counts.update(links)
        rows.append((len(ids[0]), len(ids[1]), len(groups), ";".join(groups), links))
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [(*r[:4], len(r[4]), sum(counts[x] == most[x[1]] for x in r[4]), sum(counts[x] for x in r[4])) for r in rows]


TEXTS = [
    "Hello  world <|endoftext|> </s> <unk> <0x41>", "▁marked", "tab\there\r\n\r\nnew  ", " lead", "café 日本語 \U0001f600 é", "Hello  world",
    "it's 12345 don't!!! x" * 3, "\x00a", "  nbsp 　wide", "aaaa" * 300, "<|endoftext|>", "  ", "the the the the",
]
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "groups", "n_links", "n_best", "count_sum"]


@pytest.mark.parametrize("most_pairs", [alignment.MOST_PAIRS, 0])
def test_equals_brute_force(spark, plain, most_pairs):
    rows = EDGES + list(enumerate(TEXTS)) + [(None, "no id"), (BIG, "large id"), (BIG + 2, None)]
    got = [tuple(r[c] for c in COLUMNS) for r in aligned_counts(documents(spark, rows, True), A, B, most_pairs=most_pairs).collect()]
    want = [(doc, *r) for (doc, _), r in zip(rows, brute([t for _, t in rows], plain))]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_query_equals_brute_force(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {(d.doc_id, *r[:3], *r[4:], hashlib.sha256(r[3].encode()).hexdigest() if r[0] else "") for d, r in zip(docs, brute([d.text for d in docs], plain))}
    assert {tuple(r) for r in QUERIES["op11_alignment"](spark, SF).collect()} == want


def test_long_texts_are_cut_where_no_token_reaches_over(spark, monkeypatch):
    text = "Some words,  two spaces\n and 12 more été " * 40
    both = alignment.Aligner(ByteTokenizer(A), PieceTokenizer(B))
    whole = both.document(text)
    monkeypatch.setattr(alignment, "PIECE", 50)
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    cut = alignment.Aligner(both.a, both.b).document(text)
    assert len(alignment.cut(" " + text)) > 10 and "".join(alignment.cut(" " + text)) == " " + text
    assert cut[:4] == whole[:4] and (cut[4] == whole[4]).all()
    assert alignment.cut("x" * 500) == ["x" * 500]


def test_ids_are_those_of_the_file_over_all_code_points(plain):
    tokens = ByteTokenizer(A)
    for first in range(1, 0x110000, 5000):
        points = [chr(c) for c in range(first, min(first + 5000, 0x110000), 7 if first < 0x30000 else 97) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}b {c}1{c} {c}{c} !{c}  {c}" for c in points)
        assert tokens.ids(" " + text) == plain[0](text)[0]


def test_empty_table(spark):
    assert aligned_counts(documents(spark, []), A, B).collect() == []
    assert align_documents(documents(spark, []), A, B).collect() == []


def test_windows_cost_no_calls_of_their_own():
    import sys

    both = alignment.Aligner(ByteTokenizer(A), PieceTokenizer(B))
    text, calls = " ".join(f"word{i} other{i}" for i in range(3000)), []
    both.document(text[:50])
    sys.setprofile(lambda frame, event, arg: calls.append(event))
    try:
        both.document(text)
    finally:
        sys.setprofile(None)
    assert len(calls) < 1500


def test_windows_are_aligned_once_and_never_shared_by_accident(monkeypatch):
    both = alignment.Aligner(ByteTokenizer(A), PieceTokenizer(B))
    texts = ["the cat and the dog 12345 " * 30, None, "▁marked", "the unbelievable cat", ""]
    want, seen = both.documents(texts), []
    align = both.align
    both.align = lambda a, b, n_a, n_b: seen.append(len(n_a)) or align(a, b, n_a, n_b)
    both.documents(texts)
    assert sum(seen) <= 15
    monkeypatch.setattr(alignment, "mix", lambda x: x * 0)
    for x, y in zip(want, both.documents(texts)):
        assert x[:4] == y[:4] and (x[4] == y[4]).all()
    assert sum(seen) > 150
