"""SentencePiece encoding with exact N-best segmentations, and decoding.

A text is written as SentencePiece does: a ``▁`` before it and for each space. Every
way to cover it with the vocabulary's pieces is a path of the piece lattice,
scored by the sum of its pieces' scores. Forward Viterbi gives the best score up
to each position; these are exact heuristics for an A* search from the end
backward, which takes paths off its heap best first. So its first N complete
paths are the N best.

No piece reaches over the start of a word, nor over a character that only bytes
can write; there the lattice narrows to one node. Its parts are searched one by
one and remembered. The N best of the whole differ from the best in at most those
N - 1 parts with the smallest loss for their second-best path (found by forward and
backward scores); the A* lists of these are merged exactly, list by list, of which never
more than the N best sums are kept.

Characters without a piece become byte pieces, with a score below all others.
Equal scores go to the path with the longer last piece, then to the earlier part.
NULL and empty texts have no piece: score 0 and one empty segmentation. Decoding
gives back the text, ``▁`` in it as a space. Repeated rows are each encoded;
an empty table gives no rows; columns but id and text are not read.
"""

from __future__ import annotations

import heapq
import re
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hiremill.llm.common import map_frames, table, worker_memory

N_BEST = 3
CACHE = 500_000
BLOCK = 800
BASE = np.uint64(0x100000001B3)
SPACE = "▁"
NONE = float("inf")


def best_sums(lists: list[list[tuple[float, bytes]]], most: int) -> list[tuple[float, tuple]]:
    """The ``most`` choices of one item from each list (best first) with the largest sums; equal sums keep the order of the lists.

    List by list: the j-th item goes only with the first ``most // j`` choices so far, since
    all those before both are as good. So a list adds some ``most * log(most)`` sums.
    """
    kept: list[tuple[float, tuple, tuple]] = [(0, (), ())]
    for items in lists:
        sums = [
            (-(score + items[j][0]), (*places, j), (*way, items[j]))
            for i, (score, places, way) in enumerate(kept)
            for j in range(min(len(items), most // (i + 1)))
        ]
        kept = [(-minus, places, way) for minus, places, way in heapq.nsmallest(most, sums)]
    return [(score, way) for score, _, way in kept]


class Segmenter:
    def __init__(self, model_path: str, n_best: int = N_BEST):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=model_path)
        size = sp.get_piece_size()
        plain = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.n_best = n_best
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
        self.id = {sp.id_to_piece(i): i for i in plain}
        self.byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(size) if sp.is_byte(i)}
        self.unknown_id, self.unknown = sp.unk_id(), min(self.score.values(), default=0.0) - 10.0
        self.longest = max(map(len, self.score), default=1)
        self.letters = set().union(*self.score)
        whole = all(SPACE not in p.lstrip(SPACE) for p in self.score)
        # Parts: a run of word starts with what follows; or a character that no piece holds.
        alone = re.escape("".join(sorted({"\n", "\t", "\r"} - self.letters)))
        rest = f"[^{SPACE}{alone}]" if alone else f"[^{SPACE}]"
        self.parts = re.compile(f"{SPACE}+{rest}*|{rest}+" + (f"|[{alone}]" if alone else "") if whole else "(?s).+")
        self.text = [b""] * size
        for i in plain:
            self.text[i] = sp.id_to_piece(i).replace(SPACE, " ").encode()
        for value, i in self.byte.items():
            self.text[i] = bytes([value])
        self._index_pieces()
        self.known: dict[str, tuple[bytes, float, float]] = {}
        self.lists: dict[str, list[tuple[float, bytes]]] = {}

    def _ids(self, piece: str) -> list[int]:
        if (i := self.id.get(piece)) is not None:
            return [i]
        return [self.byte.get(b, self.unknown_id) for b in piece.encode("utf-8", "replace")]

    def _lattice(self, part: str) -> tuple[list[list[tuple[int, float]]], list[float], list[int]]:
        """Edges ending at each position, longest first; the best score up to it and where its last piece starts."""
        n, get = len(part), self.score.get
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        alpha, back = [-NONE] * (n + 1), [0] * (n + 1)
        alpha[0] = 0.0
        longest, unknown = self.longest, self.unknown
        for s in range(n):
            base = alpha[s]
            for e in range(s + 1, min(n, s + longest) + 1):
                v = get(part[s:e])
                if v is None:
                    if e > s + 1:
                        continue
                    v = unknown
                ends[e].append((s, v))
                if base + v > alpha[e]:
                    alpha[e], back[e] = base + v, s
        return ends, alpha, back

    def _learn(self, part: str) -> tuple[bytes, float, float]:
        """Ids and score of the best path, and what the second best loses."""
        n = len(part)
        ends, alpha, back = self._lattice(part)
        cuts = [n]
        while cuts[-1]:
            cuts.append(back[cuts[-1]])
        cuts.reverse()
        ids = [i for a, b in zip(cuts, cuts[1:]) for i in self._ids(part[a:b])]
        # The second best path has an edge off the best one: the best path through any such edge.
        best, second = set(zip(cuts, cuts[1:])), -NONE
        beta = [-NONE] * (n + 1)
        beta[n] = 0.0
        for e in range(n, 0, -1):
            after = beta[e]
            for s, v in ends[e]:
                if after + v > beta[s]:
                    beta[s] = after + v
                if (through := alpha[s] + v + after) > second and (s, e) not in best:
                    second = through
        out = np.array(ids, dtype="<u4").tobytes(), alpha[n], alpha[n] - second
        self.known[part] = out
        return out

    def _index_pieces(self) -> None:
        """Pieces by the hash of their letters, in tables where each has a slot of its own."""
        names = list(self.score)
        self.piece_score = np.array([self.score[p] for p in names] + [-NONE])
        self.piece_id = np.array([self.id[p] for p in names] + [-1], dtype=np.int64)
        with np.errstate(over="ignore"):
            keys = np.zeros(len(names) + 1, dtype=np.uint64)
            for i, p in enumerate(names):
                for c in p:
                    keys[i] = keys[i] * BASE + np.uint64(ord(c) + 1)
        self.piece_key, self.slots = keys, []
        left, factor = np.arange(len(names)), np.uint64(0x9E3779B97F4A7C15)
        while len(left):
            slot = (keys[left] * factor) >> np.uint64(44)
            _, first = np.unique(slot, return_index=True)
            place = np.full(1 << 20, len(names), dtype=np.int32)
            place[slot[first]] = left[first]
            self.slots.append((factor, place))
            left = np.delete(left, first)
            factor = np.uint64((int(factor) * 0xD1342543DE82EF95 + 2) % (1 << 64) | 1)

    def _pieces(self, h: np.ndarray) -> np.ndarray:
        """Number of the piece with each hash; one past the last if there is none."""
        found = np.full(h.shape, len(self.piece_id) - 1, dtype=np.int32)
        for factor, place in self.slots:
            at = place[(h * factor) >> np.uint64(44)]
            found = np.where(self.piece_key[at] == h, np.minimum(at, found), found)
        return found

    def learn_many(self, parts: list[str]) -> None:
        """``_learn`` for many parts, those of one length at a time as arrays."""
        if len(self.known) + len(parts) > CACHE:
            self.known.clear()
        by_length: dict[int, list[str]] = {}
        for p in parts:
            by_length.setdefault(len(p), []).append(p)
        for n, same in by_length.items():
            if n > 32 or len(same) < 16:
                for p in same:
                    self._learn(p)
                continue
            for low in range(0, len(same), 4096):
                self._learn_same(n, same[low : low + 4096])

    def _learn_same(self, n: int, parts: list[str]) -> None:
        codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(-1, n).T.astype(np.uint64) + np.uint64(1)
        width = codes.shape[1]
        found: list[np.ndarray] = []  # by length - 1: piece number at each start
        with np.errstate(over="ignore"):
            h = np.zeros((n + 1, width), dtype=np.uint64)
            for size in range(1, min(n, self.longest) + 1):
                h = h[:-1] * BASE + codes[size - 1 :]
                found.append(self._pieces(h))
        none = len(self.piece_id) - 1
        odd = (found[0] == none).any(axis=0)  # a letter without a piece: left to _learn
        value = [self.piece_score[f] for f in found]
        alpha, back = np.full((n + 1, width), -NONE), np.zeros((n + 1, width), dtype=np.int64)
        alpha[0] = 0.0
        for e in range(1, n + 1):
            for s in range(max(0, e - len(value)), e):
                v = alpha[s] + value[e - s - 1][s]
                better = v > alpha[e]
                alpha[e][better] = v[better]
                back[e][better] = s
        beta, on = np.full((n + 1, width), -NONE), np.zeros((n + 1, width), dtype=bool)
        beta[n], on[n] = 0.0, True
        second = np.full(width, -NONE)
        ids = np.full((n, width), -1, dtype=np.int64)
        rows = np.arange(width)
        for e in range(n, 0, -1):
            here = on[e]
            on[back[e][here], rows[here]] = True
            for s in range(max(0, e - len(value)), e):
                v = value[e - s - 1][s]
                after = v + beta[e]
                np.maximum(beta[s], after, out=beta[s])
                best = here & (back[e] == s)
                second = np.maximum(second, np.where(best, -NONE, alpha[s] + after))
                ids[e - 1][best] = self.piece_id[found[e - s - 1][s][best]]
        flat = ids.T[ids.T >= 0].astype("<u4").tobytes()
        edges = np.cumsum(np.append(0, 4 * (ids >= 0).sum(axis=0))).tolist()
        loss = (alpha[n] - second).tolist()
        self.known.update(zip(parts, zip([flat[a:b] for a, b in zip(edges, edges[1:])], alpha[n].tolist(), loss)))
        for i in np.flatnonzero(odd):
            self._learn(parts[i])

    def best_paths(self, part: str, most: int | None = None) -> list[tuple[float, bytes]]:
        """The N best (score, ids) by backward A* over the forward scores."""
        most = most or self.n_best
        ends, alpha, _ = self._lattice(part)
        found, order = [], 0
        heap = [(-alpha[len(part)], 0, len(part), 0.0, None)]
        while heap and len(found) < most:
            _, _, at, done, path = heapq.heappop(heap)
            if at == 0:
                ids = []
                while path:
                    ids += self._ids(part[path[0] : path[1]])
                    path = path[2]
                found.append((done, np.array(ids, dtype="<u4").tobytes()))
                continue
            for s, v in ends[at]:
                order += 1
                heapq.heappush(heap, (-(alpha[s] + v + done), order, s, done + v, (s, at, path)))
        return found

    def encode(self, texts: list[str | None]) -> list[list[tuple[float, bytes]]]:
        """Of each text the N best segmentations, best first: score and ids, 32 bits little-endian each."""
        parts = [self.parts.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        needed = set().union(*parts)
        if new := needed - self.known.keys():
            # Beyond the bound all is forgotten, then what these texts need is learned.
            self.learn_many(list(new if len(self.known) + len(new) <= CACHE else needed))
        return [self._merged(p) for p in parts]

    def _merged(self, parts: list[str]) -> list[tuple[float, bytes]]:
        if not parts:
            return [(0.0, b"")]
        ids, scores, losses = zip(*map(self.known.__getitem__, parts))
        total = sum(scores)
        best = [(total, b"".join(ids))]
        if self.n_best == 1:
            return best
        loss = np.array(losses)
        few = min(self.n_best - 1, len(loss))
        edge = np.partition(loss, few - 1)[few - 1]
        at = np.flatnonzero(loss <= edge)
        at = np.sort(at[np.argsort(loss[at], kind="stable")][:few])
        at = [int(i) for i in at if loss[i] < NONE]
        if not at:
            return best
        lists = []
        for i in at:
            if (paths := self.lists.get(parts[i])) is None:
                if len(self.lists) >= CACHE // 10:
                    self.lists.clear()
                paths = self.lists[parts[i]] = self.best_paths(parts[i])
            lists.append(paths)
        same = total - sum(scores[i] for i in at)
        ways = [(-(same + score), k, way) for k, (score, way) in enumerate(best_sums(lists, self.n_best))]
        edges = np.cumsum([0, *map(len, ids)])
        out = []
        for minus, _, way in ways:
            joined, last = [], 0
            for i, c in zip(at, way):
                joined += [best[0][1][last : edges[i]], c[1]]
                last = edges[i + 1]
            out.append((-minus, b"".join([*joined, best[0][1][last:]])))
        return out

    def decode(self, ids: bytes) -> str:
        """The text of 32-bit ids."""
        raw = b"".join(map(self.text.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))
        return raw.decode("utf-8", "replace")[1:]


def _worker_segmenter(path: str, n_best: int) -> Segmenter:
    """What a Python worker has learned serves its later tasks as well."""
    made = worker_memory("segmenters")
    return made.get((path, n_best)) or made.setdefault((path, n_best), Segmenter(path, n_best))


def encode_documents(
    docs: DataFrame, model_path: str | None = None, n_best: int = N_BEST, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, and best first the scores and ids (binary) of the N best segmentations."""
    path = model_path or public_tokenizers.path("piece_bpe_32k.model")

    def run(batches):
        segmenter = _worker_segmenter(path, n_best)
        for pdf in batches:
            for low in range(0, len(pdf), BLOCK):
                found = segmenter.encode(list(pdf["text"].iloc[low : low + BLOCK]))
                yield pd.DataFrame(
                    {"doc_id": pdf["doc_id"].iloc[low : low + BLOCK], "scores": [[s for s, _ in f] for f in found], "ids": [[i for _, i in f] for f in found]}
                )

    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_frames(picked, run, f"doc_id {kind}, scores array<double>, ids array<binary>")


def decode_documents(encoded: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id and the text that the best ids of ``encode_documents`` stand for."""
    path = model_path or public_tokenizers.path("piece_bpe_32k.model")

    def run(batches):
        segmenter = _worker_segmenter(path, 1)
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text": [segmenter.decode(i) for i in pdf["best"]]})

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return map_frames(encoded.select("doc_id", F.col("ids")[0].alias("best")), run, f"doc_id {kind}, text string")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three best segmentations of every document and whether decoding gives back its text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("piece_bpe_32k.model")

    def run(batches):
        segmenter = _worker_segmenter(path, N_BEST)
        for pdf in batches:
            for low in range(0, len(pdf), BLOCK):
                texts, rows = list(pdf["text"].iloc[low : low + BLOCK]), []
                for doc, text, found in zip(pdf["doc_id"].iloc[low : low + BLOCK], texts, segmenter.encode(texts)):
                    best = found[0][1]
                    same = segmenter.decode(best) == (text or "").replace(SPACE, " ")
                    rows.append((doc, len(best) // 4, zlib.crc32(best), found[0][0], [s for s, _ in found], [zlib.crc32(i) for _, i in found], same))
                yield pd.DataFrame(rows, columns=["doc_id", "n_pieces", "ids_crc32", "score", "n_best_scores", "n_best_crc32", "round_trip"], dtype=object)

    return map_frames(
        docs, run, "doc_id long, n_pieces long, ids_crc32 long, score double, n_best_scores array<double>, n_best_crc32 array<long>, round_trip boolean"
    )
