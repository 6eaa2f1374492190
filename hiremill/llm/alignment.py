"""Alignment of two tokenisers' tokens, by windows between white-space anchors.

Tokeniser A is a byte-level BPE (``tokenizer.json``), B a SentencePiece model. Each
text is tokenised whole by both, A over a space and the text, since B adds one. The
bytes of the tokens, joined, must be the text's on both sides.

**Anchors.** Where a token of A and one of B that both begin with a space start at the same
byte, both tokenisers have ended a token before: the document is cut there into windows
of token ids. **Windows** are short and recur: of many windows at a time, each pair of id
tuples is aligned once, and its groups and links are dealt to all windows that
are the same. Inside, byte offsets at which both end a token close a group:
``a1,a2|b1``, decimal ids in order. The two tokens that end there are linked.

**Counts.** A link's count is that of its id pair over all documents; the best of a B id are the A
ids it is linked with most often. Counted pairs are broadcast to the second pass if there are at
most ``most_pairs``; else documents' distinct pairs are joined with them.

NULL and empty texts, and those whose joined bytes differ on a side (a U+2581 in the text, say), have
no tokens: zeros and no groups. Each row is for itself, so repeated rows and ids give
equal rows, and a repeated text counts as often as it stands. An empty table gives no rows;
extra columns are not read. Strings of special tokens inside texts are plain text.

A's merges are run by ``tiktoken`` over the ranks of the same vocabulary, four times as fast
as ``tokenizers``; the file's merges must rise with their ids, else it is refused. The
tests compare both over every code point.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hiremill.llm.common import table
from hiremill.llm.shingles import mix
from hiremill.session import materialize

MOST_PAIRS = 4_000_000
#: Long texts are tokenised in pieces of about so many characters, texts of so many are aligned at once, and so many windows compared.
PIECE, AT_ONCE, REMEMBERED = 1 << 18, 1 << 19, 60_000
LINKS_AT_ONCE = 300_000
#: Fixed value: the pattern by which byte-level BPE vocabularies of this kind split a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_characters() -> dict[str, int]:
    """Printable stand-ins of the bytes in byte-level vocabularies: printable Latin-1 as itself, the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(shown))
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteTokenizer:
    """Token ids of a byte-level ``tokenizer.json``; ``entries`` holds each id's bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec["pre_tokenizer"]
        special = {x["id"] for x in spec["added_tokens"]}
        merged = [model["vocab"]["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in model["merges"]]
        plain = split["type"] == "ByteLevel" and split.get("use_regex", True) and not split["add_prefix_space"] and not spec["normalizer"]
        if not plain or any(x >= y for x, y in zip(merged, merged[1:])):
            raise ValueError(f"{path}: not a plain byte-level BPE whose ids rise with its merges")
        shown = byte_characters()
        ranks = {bytes(shown[c] for c in token): i for token, i in model["vocab"].items() if i not in special}
        self.entries = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.entries[i] = token
        self._encoding = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        return self._encoding.encode_ordinary(text)


class PieceTokenizer:
    """The same of a SentencePiece model that puts a space before the text."""

    def __init__(self, path: str):
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError(f"{path}: a piece goes on after a space, so long texts cannot be cut there")
        self.entries = [bytes([int(p[3:5], 16)]) if self._model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]

    def ids(self, text: str) -> list[int]:
        return self._model.encode(text, num_threads=1)


def cut(text: str) -> list[str]:
    """A long text in pieces, each from a single space between other characters on: no token reaches over one."""
    out, at = [], 0
    while len(text) - at > PIECE:
        end = at + PIECE
        while (end := text.find(" ", end)) > 0 and (text[end - 1].isspace() or end + 1 >= len(text) or text[end + 1].isspace()):
            end += 1
        if end < 0:
            break
        out.append(text[at:end])
        at = end
    return [*out, text[at:]]


def code_type(size_a: int, size_b: int) -> np.dtype:
    """The smaller integer type that holds all codes a * size_b + b."""
    return np.dtype(np.int32 if size_a * size_b < 1 << 31 else np.int64)


def spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each span, one span after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


class Aligner:
    """Aligns documents by their windows: of those met together, each pair of id tuples once."""

    def __init__(self, a: ByteTokenizer, b: PieceTokenizer):
        self.a, self.b, self.size_b = a, b, len(b.entries)
        self.code = code_type(len(a.entries), len(b.entries))
        self._entries = [pa.array(side.entries, pa.large_binary()) for side in (a, b)]
        self._length = [np.array([len(x) for x in side.entries]) for side in (a, b)]
        self._spaced = [np.array([x[:1] == b" " for x in side.entries]) for side in (a, b)]
        # What is written for a token inside a group and for one at its end, of A and of B.
        written = [b"%d%s" % (i, mark) for side, marks in ((a, b",|"), (b, b",;")) for mark in (marks[:1], marks[1:]) for i in range(len(side.entries))]
        self._written = pa.array(written, pa.large_binary())
        self._written_length = np.array([len(x) for x in written])

    def _bytes(self, side: int, own: np.ndarray) -> bytes:
        return self._entries[side].take(pa.array(own)).buffers()[2].to_pybytes() if len(own) else b""

    def _tokens(self, text: str | None) -> list[tuple[np.ndarray, np.ndarray, int]]:
        """Ids of A and of B, and the bytes, of the pieces of a text; none if the bytes of a piece are not its tokens'."""
        out = []
        for piece in cut(" " + text) if text else []:
            data = piece.encode("utf-8", "surrogatepass")
            ids = [np.array(own, dtype=np.int32) for own in (self.a.ids(piece), self.b.ids(piece[1:]))]
            if any(int(length[own].sum()) != len(data) or self._bytes(side, own) != data for side, (own, length) in enumerate(zip(ids, self._length))):
                return []
            out.append((*ids, len(data)))
        return out

    def _windows(self, a: np.ndarray, b: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First token of A and of B of each window; a text's piece begins one, with an anchor or without."""
        starts = [np.cumsum(length[own]) - length[own] for own, length in zip((a, b), self._length)]
        both = np.zeros(int(max(x[-1] for x in starts)) + 1, dtype=np.int8)
        for own, start, spaced in zip((a, b), starts, self._spaced):
            both[start[spaced[own]]] += 1
        both[begins] = 2
        first_a, first_b = (np.flatnonzero(both[start] == 2) for start in starts)
        return first_a, first_b

    @staticmethod
    def distinct(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of windows side by side: the numbers of those that differ, and the place of each window among them."""
        key = np.zeros(len(n_a), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for own, n, seed in ((a, n_a, 0x9E3779B97F4A7C15), (b, n_b, 0xC2B2AE3D27D4EB4F)):
                first = np.cumsum(n) - n
                at = (np.arange(len(own)) - np.repeat(first, n)).astype(np.uint64)
                key += mix(np.add.reduceat(mix(own.astype(np.uint64) + (at << np.uint64(32)) + np.uint64(seed)), first))
        _, kept, same = np.unique(key, return_index=True, return_inverse=True)
        like = kept[same]
        equal = (n_a[like] == n_a).all() and (n_b[like] == n_b).all()
        equal = equal and all((own[spans((np.cumsum(n) - n)[like], n)] == own).all() for own, n in ((a, n_a), (b, n_b)))
        return (kept, same) if equal else (np.arange(len(n_a)), np.arange(len(n_a)))  # two that differ have one key: none is shared

    def align(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What is written for windows, the links' codes, and the number of links of each window.

        Each starts and ends where both tokenisers do, so side by side they align as each for itself.
        """
        end_a, end_b = (np.cumsum(length[own]) for own, length in zip((a, b), self._length))
        ended = np.zeros(int(end_a[-1]) + 1, dtype=np.int8)
        ended[end_a] += 1
        ended[end_b] += 1
        last_a, last_b = ended[end_a] == 2, ended[end_b] == 2
        # Groups one after the other, in each first A's tokens, then B's.
        group_a, group_b = (np.cumsum(last) - last for last in (last_a, last_b))
        place_a = np.arange(len(a)) + np.append(0, np.flatnonzero(last_b) + 1)[group_a]
        place_b = np.arange(len(b)) + (np.flatnonzero(last_a) + 1)[group_b]
        codes = np.empty(len(a) + len(b), dtype=np.int32)
        codes[place_a] = a + np.where(last_a, len(self.a.entries), 0)
        codes[place_b] = 2 * len(self.a.entries) + b + np.where(last_b, self.size_b, 0)
        links = (a[last_a].astype(np.int64) * self.size_b + b[last_b]).astype(self.code)
        return codes, links, np.add.reduceat(last_b.astype(np.int64), np.cumsum(n_b) - n_b)

    def _aligned(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same as ``align``, each pair of id tuples aligned once."""
        kept, same = self.distinct(a, b, n_a, n_b)
        own_a, own_b = (own[spans((np.cumsum(n) - n)[kept], n[kept])] for own, n in ((a, n_a), (b, n_b)))
        codes, links, n_links = self.align(own_a, own_b, n_a[kept], n_b[kept])
        n_codes = n_a[kept] + n_b[kept]
        every = [own[spans((np.cumsum(n) - n)[same], n[same])] for own, n in ((codes, n_codes), (links, n_links))]
        return *every, n_links[same]

    def documents(self, texts: list[str | None]) -> list[tuple[int, int, int, bytes, np.ndarray]]:
        """Of each text: tokens of A, of B, groups, the groups written out, the links' codes; zeros without tokens."""
        found = [self._tokens(text) for text in texts]
        pieces = [p for own in found for p in own]
        if not pieces:
            return [(0, 0, 0, b"", np.zeros(0, dtype=self.code))] * len(texts)
        a, b = (np.concatenate([p[side] for p in pieces]) for side in (0, 1))
        first_a, first_b = self._windows(a, b, np.cumsum([0, *(p[2] for p in pieces[:-1])]))
        parts = []
        for low in range(0, len(first_a), REMEMBERED):
            high = min(low + REMEMBERED, len(first_a))
            edges = [np.append(first[low:high], first[high] if high < len(first) else len(own)) for own, first in ((a, first_a), (b, first_b))]
            parts.append(self._aligned(*(own[e[0] : e[-1]] for own, e in zip((a, b), edges)), *map(np.diff, edges)))
        codes, links, n_links = map(np.concatenate, zip(*parts))
        written = self._written.take(pa.array(codes)).buffers()[2].to_pybytes()
        # Where the tokens, the written groups and the links of each text end.
        n_a, n_b = (np.array([sum(len(p[side]) for p in own) for own in found]) for side in (0, 1))
        to_text = np.append(0, np.cumsum(self._written_length[codes]))[np.append(0, np.cumsum(n_a + n_b))].tolist()
        to_window = np.searchsorted(first_a, np.append(0, np.cumsum(n_a)))
        to_link = np.append(0, np.cumsum(n_links))[to_window].tolist()
        return [
            (i, j, q - p, written[x : max(y - 1, x)], links[p:q])
            for i, j, x, y, p, q in zip(n_a.tolist(), n_b.tolist(), to_text, to_text[1:], to_link, to_link[1:])
        ]

    def document(self, text: str | None) -> tuple[int, int, int, bytes, np.ndarray]:
        return self.documents([text])[0]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One for each Python worker: loading takes a second."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(ByteTokenizer(path_a), PieceTokenizer(path_b))
    return _ALIGNERS[path_a, path_b]


def align_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", digest: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, groups (text, or with ``digest`` its SHA-256 in hex, '' without tokens), links (codes a * pieces of B + b)."""

    def run(batches):
        both = aligner(path_a, path_b)
        for batch in batches:
            at, texts, size = 0, [], 0
            for i, text in enumerate(batch.column("text")):
                texts.append(text.as_py())
                size += len(texts[-1] or "")
                if size < AT_ONCE and i + 1 < batch.num_rows:
                    continue
                rows = both.documents(texts)
                if digest:
                    rows = [(*r[:3], hashlib.sha256(r[3]).hexdigest().encode() if r[0] else b"", r[4]) for r in rows]
                counts = [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
                ends = np.cumsum([0, *(len(r[4]) for r in rows)]).astype(np.int32)
                links = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([r[4] for r in rows])))
                groups = pa.array([r[3] for r in rows], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(rows)), *counts, groups, links], ["doc_id", "n_a", "n_b", "n_groups", "groups", "links"]
                )
                at, texts, size = i + 1, [], 0

    kind = docs.schema[id_col].dataType.simpleString()
    code = "int" if code_type(len(ByteTokenizer(path_a).entries), len(PieceTokenizer(path_b).entries)) == np.int32 else "bigint"
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, groups string, links array<{code}>"
    return docs.select(F.col(id_col).alias("doc_id"), "text").mapInArrow(run, schema)


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best): how often each pair is linked, and whether no other A id is linked with its B id more often."""
    counts = materialize(aligned.select(F.explode("links").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pair-counts")
    highest = counts.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("n").alias("most"))
    return counts.join(highest, F.col("pair") % size_b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def count_links(aligned: DataFrame, counts: DataFrame, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """``aligned`` without links, with n_links, n_best and count_sum. ``aligned`` and ``counts`` are written tables."""
    keep = [c for c in aligned.columns if c != "links"]
    if counts.count() > most_pairs:
        numbered = materialize(aligned.select("*", F.monotonically_increasing_id().alias("row_no")), "aligned-rows")
        links = numbered.select("row_no", F.explode("links").alias("pair")).groupBy("row_no", "pair").agg(F.count("*").alias("times"))
        sums = links.join(counts, "pair").groupBy("row_no").agg(
            F.sum("times").alias("n_links"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")
        )
        added = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_links", "n_best", "count_sum")]
        return numbered.join(sums, "row_no", "left").select(*keep, *added)

    known = counts.orderBy("pair").toArrow()
    held: Broadcast = aligned.sparkSession.sparkContext.broadcast([known.column(c).to_numpy() for c in ("pair", "n", "best")])

    def run(batches):
        pairs, times, best = held.value
        for batch in batches:
            sizes = pc.list_value_length(batch.column("links")).to_numpy()
            # As many rows at a time as have a bounded number of links.
            part = np.cumsum(sizes) // LINKS_AT_ONCE
            edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows] if batch.num_rows else [0]
            for low, high in zip(edges, edges[1:]):
                rows = batch.slice(low, high - low)
                flat, ends = rows.column("links").flatten().to_numpy(), np.append(0, np.cumsum(sizes[low:high]))
                at = np.searchsorted(pairs, flat)
                sums = [x[ends[1:]] - x[ends[:-1]] for x in (np.append(0, np.cumsum(y[at], dtype=np.int64)) for y in (best, times))]
                added = [pa.array(x) for x in (sizes[low:high].astype(np.int64), *sums)]
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in keep), *added], [*keep, "n_links", "n_best", "count_sum"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in aligned.schema.fields if f.name != "links"]
    return aligned.mapInArrow(run, ", ".join([*kinds, "n_links long", "n_best long", "count_sum long"]))


def aligned_counts(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", digest: bool = False, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, groups, n_links, n_best (links whose count is the highest of their B id), count_sum (over links)."""
    aligned = materialize(align_documents(docs, path_a, path_b, id_col, digest), "aligned")
    counts = materialize(pair_counts(aligned, len(PieceTokenizer(path_b).entries)), "pair-best")
    return count_links(aligned, counts, most_pairs)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """byte_bpe_50k.json against piece_bpe_32k.model over all documents."""
    import public_tokenizers

    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    found = aligned_counts(table(spark, sf_dir, "documents"), *paths, digest=True)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))
