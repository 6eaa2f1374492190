"""Packing of tokenised documents into fixed windows with a controlled source mixture.

Deficit round-robin over source queues. Every source is a queue of tokens; a
round lasts one window. In each round a queue's deficit grows by its share of
the window, and it is served once the deficit covers at least ``grain`` tokens
(rarer sources wait a few rounds, so that they are not cut into crumbs); what
it is not served is carried into the next round. Served tokens are laid one
after the other into windows of ``length`` tokens, so windows are full but for
the last one, and each holds the target proportions to within one service a queue.

The deficit after r rounds has a closed form: a queue of T tokens, served every
m rounds, has been served floor(T * (r - r mod m) / R) of them, R being the
number of rounds. So no state is passed from task to task: a task computes the
place of any token from the queue totals alone, as if it had run all rounds
before. Shares are those of the tokens themselves, so that every token is packed.

Two passes. The first tokenises each document once and writes its ids together
with its place among the tokens of its source within the task. The second reads
that table, adds what the tasks before hold of the source and cuts. Texts are
never shuffled.

At most ``max_queues`` sources, those with the most tokens, have a queue of the
windows. All others, any number, share one more, in which they are mixed by the
same closed form: they are dealt into groups of about ``GROUP`` / 2, a group's
sources into one order of the group's tokens, ``GROUP`` groups into that of a larger one,
and so on to the shared queue (``tail_levels``). A token's place is carried from one
order to the next. The totals of a group are joined to its sources; they never meet on the driver.

NULL texts are empty, and a document always ends with ``end_id``, so each has
at least one token. NULL sources are a queue of their own. Repeated rows and
ids are packed row by row. An empty table gives no rows. Columns but id, text
and source are not read.
"""

from __future__ import annotations

import json
import os
import re
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hiremill.llm.common import map_frames, table, worker_memory
from hiremill.session import materialize

LENGTH = 2048
GRAIN = 64
END_ID = 1
MAX_QUEUES = 256
#: Queues of one order within the shared queue.
GROUP = 256
MOST_ROUNDS = 1 << 31
CACHE = 200_000
ROWS_OUT = 10_000
#: Documents and bytes of text that are encoded at once.
DOCS_AT_ONCE, BYTES_AT_ONCE = 500, 2 << 20
#: A word of Latin-1 letters with the signs behind it, or any other, of which it keeps nothing; an apostrophe may belong to the letters.
PLAIN = re.compile(r"(?m)^(?:([A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([!-&(-/:-@\[-`{-~]*)$|.*$)")


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write a byte as a letter: itself if it prints, else one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordEncoder:
    """Ids of whole texts, from remembered ids of their words.

    Made for vocabularies that drop white space and mark word ends: their
    normaliser and pre-tokeniser work within what stands between white space, so
    a text's ids are those of its words in turn (words are cut at ASCII white space;
    rarer white space is left to the tokeniser). Texts are cut and their words numbered as Arrow
    columns, so only the distinct ones of many texts are looked up, and what is remembered lies in
    columns as well: a Python object for each word and its ids took ten times the memory. A word of Latin-1
    letters is one unit for them, and so is the run of signs behind it. Such words go
    to the bare merge model, many in one call: their last ids show where each ends.
    Any other tokeniser gets the texts as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words, self.ids = pa.array([], pa.string()), np.zeros(0, dtype="<u4")
        self.sizes, self.again = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=bool)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        suffix = spec["model"].get("end_of_word_suffix")
        self.by_word = bool(suffix) and "\\s+" in str(spec["normalizer"]) and "Lowercase" in str(spec["normalizer"])
        if self.by_word:
            spec |= {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
            self.bare = Tokenizer.from_str(json.dumps(spec))
            self.letters = _byte_letters()
            self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
            self.ends[[i for t, i in spec["model"]["vocab"].items() if t.endswith(suffix)]] = True

    def _forget(self) -> None:
        """Of the remembered words only those stay that were met again since the last time; none if these are over half of what may be held."""
        keep = self.again if 2 * self.again.sum() <= CACHE else np.zeros(len(self.again), dtype=bool)
        self.words, self.ids, self.sizes = self.words.filter(pa.array(keep)), self.ids[np.repeat(keep, self.sizes)], self.sizes[keep]
        self.again = np.zeros(len(self.sizes), dtype=bool)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, words: list[str]) -> list[bytes]:
        """Ids of lower-case words of Latin-1 letters."""
        joined = [
            " ".join(words[i : i + 200]).encode().decode("latin-1").translate(self.letters).replace(self.letters[32], " ")
            for i in range(0, len(words), 200)
        ]
        ids = np.concatenate([np.array(e.ids, dtype="<u4") for e in self.bare.encode_batch_fast(joined, add_special_tokens=False)])
        ends = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
        if len(ends) != len(words):
            raise ValueError("the vocabulary does not mark every word's end")
        data = ids.tobytes()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of words without white space, each once."""
        pairs = PLAIN.findall("\n".join(words))
        lows = [core.lower() for core, _ in pairs]
        odd = list({tail for _, tail in pairs if tail} | {w for w, low in zip(words, lows) if not low})
        parts = dict(zip(odd, self._whole(odd))) | {"": b""}
        cores = list({low for low in lows if low})
        plain = dict(zip(cores, self._plain(cores))) if cores else {}
        return [plain[low] + parts[tail] if low else parts[w] for w, low, (_, tail) in zip(words, lows, pairs)]

    def _remembered(self, words: pa.Array) -> np.ndarray:
        """The numbers of distinct words among the remembered ones; those that are not there yet are learned."""
        at = pc.index_in(words, value_set=self.words)
        if len(self.words) + at.null_count > CACHE:
            self._forget()
            at = pc.index_in(words, value_set=self.words)
        unknown = pc.is_null(at).to_numpy(zero_copy_only=False)
        at = pc.fill_null(at, 0).to_numpy().copy()
        self.again[at[~unknown]] = True
        if unknown.any():
            new = words.filter(pa.array(unknown))
            ids = self._word_ids(new.to_pylist())
            at[unknown] = np.arange(len(self.words), len(self.words) + len(new))
            self.words = pa.concat_arrays([self.words, new])
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(ids), dtype="<u4")])
            self.sizes = np.append(self.sizes, np.fromiter(map(len, ids), dtype=np.int32, count=len(ids)) // 4)
            self.again = np.append(self.again, np.zeros(len(new), dtype=bool))
        return at

    def flat(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, each with ``end`` behind it if given; and how many of each text."""
        if not len(texts):
            return np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.int64)
        words = pc.ascii_split_whitespace(texts) if self.by_word else texts
        edges = words.offsets.to_numpy() if self.by_word else np.arange(len(texts) + 1)
        numbered = (words.flatten() if self.by_word else texts).dictionary_encode()
        number, distinct = numbered.indices.to_numpy(), numbered.dictionary
        del words, numbered
        if self.by_word:
            number = self._remembered(distinct)[number]
            held, sizes = self.ids, self.sizes
        else:
            entries = self._whole(distinct.to_pylist())
            held, sizes = np.frombuffer(b"".join(entries), dtype="<u4"), np.fromiter(map(len, entries), dtype=np.int64, count=len(entries)) // 4
        starts = np.cumsum(sizes, dtype=np.int64) - sizes
        if end is not None:
            number = np.insert(number, edges[1:] - edges[0], len(sizes))
            edges = edges + np.arange(len(edges))
            starts, sizes, held = np.append(starts, len(held)), np.append(sizes, 1), np.append(held, np.array([end], dtype="<u4"))
        n = sizes[number]
        to = np.append(0, np.cumsum(n, dtype=np.int64))
        kind = np.int32 if max(int(to[-1]), len(held)) < 1 << 31 else np.int64
        at = np.repeat((starts[number] - to[:-1]).astype(kind), n)
        at += np.arange(to[-1], dtype=kind)
        ids = held[at]
        return ids, np.diff(to[edges - edges[0]])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, 32 bits little-endian each."""
        ids, sizes = self.flat(pa.array(texts, pa.string()))
        data, ends = ids.tobytes(), (4 * np.cumsum(sizes)).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """doc_id, source, task, start (among the source's tokens in this task), n and the ids, 32 bits each."""

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        # What a Python worker has learned serves its later tasks as well.
        encoders = worker_memory("word_encoders")
        encoder = encoders.get(tokenizer_path) or encoders.setdefault(tokenizer_path, WordEncoder(tokenizer_path))
        task, at = TaskContext.get().partitionId(), {}
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            bytes_to = np.cumsum(pc.binary_length(texts).to_numpy())
            low = 0
            while low < batch.num_rows:  # a bounded number of bytes at a time, one text at least
                before = bytes_to[low - 1] if low else 0
                high = max(low + 1, min(low + DOCS_AT_ONCE, int(np.searchsorted(bytes_to, before + BYTES_AT_ONCE, side="right"))))
                ids, sizes = encoder.flat(texts.slice(low, high - low), end_id)
                starts, sources = [], batch.column("source").slice(low, high - low)
                for source, n in zip(sources.to_pylist(), sizes.tolist()):
                    starts.append(at.get(source, 0))
                    at[source] = starts[-1] + n
                offsets = pa.py_buffer(np.append(0, 4 * np.cumsum(sizes)).astype(np.int32))
                held = pa.Array.from_buffers(pa.binary(), len(sizes), [None, offsets, pa.py_buffer(ids)])
                tasks = pa.array(np.full(len(sizes), task, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), sources, tasks, pa.array(starts, pa.int64()), pa.array(sizes), held],
                    ["doc_id", "source", "task", "start", "n", "ids"],
                )
                low = high
            pa.default_memory_pool().release_unused()  # two of these workers share an executor's memory with its JVM

    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(source_col).cast("string").alias("source"))
    return picked.mapInArrow(run, f"doc_id {kind}, source string, task int, start long, n long, ids binary")


class Rounds:
    """Where the tokens of each queue stand in the packed order."""

    def __init__(self, totals: list[int], length: int, grain: int):
        self.totals = np.array(totals, dtype=np.int64)
        tokens = int(self.totals.sum())
        self.rounds = max(1, min(-(-tokens // length), MOST_ROUNDS))
        self.whole, self.rest = self.totals // self.rounds, self.totals % self.rounds
        self.every = np.array([min(self.rounds, -(-grain * self.rounds // max(int(t), 1))) for t in self.totals], dtype=np.int64)

    def served(self, queue, after):
        """Tokens of ``queue`` served in the rounds before ``after``; both may be arrays."""
        done = np.where(after >= self.rounds, self.rounds, after - after % self.every[queue])
        return done * self.whole[queue] + done * self.rest[queue] // self.rounds

    def services(self, queue: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the services that hold the tokens ``first`` and ``last``."""
        m, total = self.every[queue], self.totals[queue]
        top = -(-self.rounds // m) - 1

        def of(token):
            k = np.clip((token * (self.rounds / m) / total).astype(np.int64), 0, top)
            for _ in range(3):  # the estimate is at most one or two off
                k = np.where(self.served(queue, k * m) > token, k - 1, k)
                k = np.where(self.served(queue, np.minimum((k + 1) * m, self.rounds)) <= token, k + 1, k)
            return k

        return of(first), of(last)

    def places(self, queue: np.ndarray, service: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First token of a service within its queue, the one after its last, and its place in the packed order."""
        m = self.every[queue]
        begin, end = self.served(queue, service * m), self.served(queue, np.minimum((service + 1) * m, self.rounds))
        now = np.minimum((service + 1) * m, self.rounds) - 1  # served in the last round of its period
        place = begin.copy()
        if len(queue) < len(self.totals):
            others = np.arange(len(self.totals))
            for i, q in enumerate(queue):
                before = self.served(others, np.where(others < q, now[i] + 1, now[i]))
                place[i] += before.sum() - before[q]
            return begin, end, place
        for other in range(len(self.totals)):
            place += np.where(other == queue, 0, self.served(np.full_like(queue, other), np.where(other < queue, now + 1, now)))
        return begin, end, place


def cut(rounds: Rounds, queue: np.ndarray, start: np.ndarray, n: np.ndarray, length: int):
    """The pieces of documents that are ``n`` tokens from ``start`` of their queue: (row, first token, tokens, place)."""
    if not len(queue):
        return (np.zeros(0, np.int64),) * 4
    first, last = rounds.services(queue, start, start + n - 1)
    row = np.repeat(np.arange(len(queue)), last - first + 1)
    service = np.arange(len(row)) - np.repeat(np.cumsum(last - first + 1) - (last - first + 1), last - first + 1) + first[row]
    begin, end, place = rounds.places(queue[row], service)
    a, b = np.maximum(begin, start[row]), np.minimum(end, (start + n)[row])
    keep = b > a
    row, a, b, place = row[keep], a[keep], b[keep], (place + a - begin)[keep]
    parts = (place + (b - a) - 1) // length - place // length + 1
    again = np.repeat(np.arange(len(row)), parts)
    window = np.arange(len(again)) - np.repeat(np.cumsum(parts) - parts, parts) + (place // length)[again]
    low = np.maximum(window * length, place[again])
    high = np.minimum((window + 1) * length, (place + b - a)[again])
    row = row[again]
    return row, a[again] + (low - place[again]) - start[row], high - low, low


def tail_levels(rest: DataFrame, count: int, width: int) -> tuple[DataFrame, int]:
    """Where the sources (name, n) that share a queue stand in it, and the number of levels L.

    (name, group0, child0, totals0, ..., up to L - 1): the source is number child0 of the
    queues of group0, whose tokens are totals0; that group is number child1 of group1, and so on.
    The only group of the last level is the shared queue. Sources are dealt by hash, so no order of all is needed.
    """
    groups = 1 if count <= width else -(-2 * count // width)
    group = F.pmod(F.xxhash64("name"), F.lit(groups))
    nodes, path, level = rest.select("name", "n", group.alias("group")), None, 0
    while True:
        order = Window.partitionBy("group").orderBy(F.desc("n"), "name")
        numbered = materialize(nodes.withColumn("child", F.row_number().over(order) - 1), "packing-nodes")
        listed = numbered.groupBy("group").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("child", "n"))), lambda x: x["n"]).alias("totals"), F.sum("n").alias("sum")
        )
        listed = materialize(listed, "packing-groups")
        step = numbered.join(listed.select(F.col("group").alias("of_group"), "totals"), F.col("group") == F.col("of_group")).select(
            F.col("name").alias(f"node{level}"), F.col("group").alias(f"group{level}"), F.col("child").alias(f"child{level}"), F.col("totals").alias(f"totals{level}")
        )
        path = step if path is None else path.join(step, F.col(f"group{level - 1}") == F.col(f"node{level}")).drop(f"node{level}")
        level += 1
        if groups == 1:
            return path.withColumnRenamed("node0", "name"), level
        groups = -(-groups // width)
        nodes = listed.select(F.col("group").alias("name"), F.col("sum").alias("n"), F.expr(f"`group` div {width}").alias("group"))


def in_shared_queue(pdf: pd.DataFrame, level: int, row: np.ndarray, start: np.ndarray, n: np.ndarray, windows: int, grain: int):
    """Pieces (row of ``pdf``, n tokens from ``start`` of a queue of this level) in the order of their group: (piece, first token, tokens, place).

    A round is what the group gets of one window, or ``grain`` tokens if that is more.
    """
    group, child, totals = (pdf[f"{c}{level}"].to_numpy() for c in ("group", "child", "totals"))
    got = [(np.zeros(0, np.int64),) * 4]
    of = group[row].astype(np.int64)
    order = np.argsort(of, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
        if len(at):
            sizes = totals[row[at[0]]]
            rounds = Rounds(sizes, max(grain, int(sizes.sum()) // windows), grain)
            piece, *rest = cut(rounds, child[row[at]].astype(np.int64), start[at], n[at], 1 << 62)
            got.append((at[piece], *rest))
    return tuple(map(np.concatenate, zip(*got)))


def pack_documents(
    docs: DataFrame, tokenizer_path: str | None = None, length: int = LENGTH, grain: int = GRAIN, end_id: int = END_ID,
    max_queues: int = MAX_QUEUES, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """doc_id, source, start, length, ids (binary), ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    path = tokenizer_path or public_tokenizers.path("word_bpe_49k.json")
    tokens = materialize(tokenize(docs, path, end_id, id_col, text_col, source_col), "packing-tokens")
    per_task = materialize(tokens.groupBy("source", "task").agg(F.sum("n").alias("n")), "packing-totals")
    # At most max_queues rows come to the driver: the queues of the largest sources, and the sum of the rest.
    largest = per_task.groupBy("source").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "source").limit(max_queues).collect()
    all_tokens, sources = per_task.agg(F.sum("n"), F.count_distinct(F.struct("source"))).first()
    all_tokens = all_tokens or 0
    totals = [r["n"] for r in largest]
    rest = all_tokens - sum(totals)
    rounds = Rounds([*totals, *([rest] if rest else [])] or [0], length, grain)
    numbers = docs.sparkSession.createDataFrame([(r["source"], i) for i, r in enumerate(largest)], "name string, number int")
    before = Window.partitionBy("source").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialize(
        per_task.join(F.broadcast(numbers), F.col("source").eqNullSafe(F.col("name")), "left")
        .withColumn("queue", F.coalesce("number", F.lit(len(totals))))
        .select(F.col("source").alias("of"), F.col("task").alias("by"), "queue", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")),
        "packing-bases",
    )
    levels, path = 0, []
    if rest:
        shared = bases.filter(F.col("queue") == len(totals)).groupBy(F.col("of").alias("name")).agg(F.sum("n").alias("n"))
        places, levels = tail_levels(shared, sources - len(totals), GROUP)
        path = [f"{c}{i}" for i in range(levels) for c in ("group", "child", "totals")]
        bases = bases.join(places, F.col("of").eqNullSafe(F.col("name")), "left")
    placed = tokens.join(bases.drop("n"), tokens["source"].eqNullSafe(bases["of"]) & (tokens["task"] == bases["by"])).select(
        "doc_id", "source", "queue", (F.col("base") + F.col("start")).alias("start"), "n", "ids", *path
    )

    def placed_pieces(pdf, queue, start, n):
        tail = np.flatnonzero(queue == len(totals)) if levels else ()
        if not len(tail):
            return cut(rounds, queue, start, n, length)
        # Pieces of the shared queue's documents: row, first token of the document, tokens, place in the order so far.
        row, first, count, at = tail, np.zeros_like(tail), n[tail], start[tail]
        for level in range(levels):
            piece, more, size, place = in_shared_queue(pdf, level, row, at, count, rounds.rounds, grain)
            row, first, count, at = row[piece], first[piece] + more, size, place
        own = np.flatnonzero(queue < len(totals))
        row, first = np.concatenate([own, row]), np.concatenate([np.zeros_like(own), first])
        at, count = np.concatenate([start[own], at]), np.concatenate([n[own], count])
        piece, more, size, place = cut(rounds, queue[row], at, count, length)
        return row[piece], first[piece] + more, size, place

    def run(batches):
        worker_memory("word_encoders").clear()  # no word is looked up from here on
        for pdf in batches:
            starts, sizes = pdf["start"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
            queues = pdf["queue"].to_numpy(np.int64)
            low = 0
            while low < len(pdf):  # as many documents at a time as make a bounded number of pieces
                high = low + max(1, int(np.searchsorted(np.cumsum(sizes[low:] // grain + 2), ROWS_OUT, side="right")))
                row, first, count, place = placed_pieces(pdf.iloc[low:high], queues[low:high], starts[low:high], sizes[low:high])
                ids = list(pdf["ids"].iloc[low:high])
                pieces = [ids[r][4 * a : 4 * (a + c)] for r, a, c in zip(row.tolist(), first.tolist(), count.tolist())]
                yield pd.DataFrame(
                    {
                        "doc_id": pdf["doc_id"].iloc[low:high].to_numpy()[row], "source": pdf["source"].iloc[low:high].to_numpy()[row],
                        "start": first, "length": count, "ids": pieces, "ids_crc32": [zlib.crc32(p) for p in pieces],
                        "doc_tokens": sizes[low:high][row], "sequence_id": place // length, "offset": place % length,
                    }
                )
                low = high

    kind = docs.schema[id_col].dataType.simpleString()
    return map_frames(
        placed, run, f"doc_id {kind}, source string, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 2048 tokens, mixed by source."""
    return pack_documents(table(spark, sf_dir, "documents")).drop("ids")
