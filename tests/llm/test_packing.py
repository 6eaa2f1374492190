import gc
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from hiremill.llm import packing
from hiremill.llm.packing import Rounds, WordEncoder, cut, op7_packing, pack_documents
from tests.llm.helpers import EDGES, SF, words

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_words_give_the_ids_of_the_text():
    texts = ["", "  a\t\tb\n\nc\r\nd\x0b e\x85f\xa0g <|endoftext|> it's I'LL 'S İstanbul ΣΑΣ é é", "x***### Ünï_code-9! don't.", "日本 語", "'s a's"]
    want = Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)
    assert WordEncoder(PATH).encode(texts) == [np.array(e.ids, dtype="<u4").tobytes() for e in want]


@pytest.mark.parametrize("length, grain, sizes", [(16, 1, (5, 90, 3)), (128, 8, (400, 3)), (2048, 64, (9000, 20_000, 7)), (2048, 64, (10,))])
def test_every_token_has_one_place(length, grain, sizes):
    rng = np.random.default_rng(length)
    queue, start, n = [], [], []
    for q, total in enumerate(sizes):
        at = 0
        while at < total:
            take = int(min(total - at, rng.integers(1, 60)))
            queue.append(q), start.append(at), n.append(take)
            at += take
    rounds = Rounds(list(sizes), length, grain)
    row, first, count, place = cut(rounds, *(np.array(v, dtype=np.int64) for v in (queue, start, n)), length)
    order = np.argsort(place)
    assert (place[order] == np.cumsum(np.append(0, count[order]))[:-1]).all() and count.sum() == sum(sizes)
    assert (place // length == (place + count - 1) // length).all()


def test_windows_hold_the_mixture():
    totals = [600_000, 300_000, 90_000, 10_000]
    rounds = Rounds(totals, 2048, 64)
    row, first, count, place = cut(rounds, np.arange(4), np.zeros(4, np.int64), np.array(totals), 2048)
    held = np.zeros((place.max() // 2048 + 1, 4))
    np.add.at(held, (place // 2048, row), count)
    share = np.array(totals) / sum(totals)
    # What a queue is behind after any number of windows is less than what it is served at once.
    behind = np.abs(np.cumsum(held[:-1], axis=0) - 2048 * share * np.arange(1, len(held))[:, None])
    assert (behind <= np.maximum(64, 2048 * share) + 2048 * share + 4).all()


def check(rows, got, length):
    docs, windows = defaultdict(list), defaultdict(list)
    for r in got:
        docs[r.doc_id].append(r)
        windows[r.sequence_id].append((r.offset, r.length))
    ids = Tokenizer.from_file(PATH)
    for d, text in rows:
        want = np.array([*ids.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        if sum(x == d for x, _ in rows) > 1:
            continue
        at = 0
        for r in sorted(docs[d], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(want)) and r.ids_crc32 == zlib.crc32(want[at : at + r.length].tobytes())
            at += r.length
        assert at == len(want)
    full = 0
    for pieces in windows.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= length
        full += at == length
    assert full >= len(windows) - 1 and sorted(windows) == list(range(len(windows)))


def test_edges(spark):
    rows = EDGES + [(i, words(300, 40 + i % 90, i)) for i in range(200)]
    df = spark.createDataFrame([(d, t, None if d % 5 == 0 else f"s{d % 3}", 1, 2) for d, t in rows], "doc_id long, text string, source string, n long, task int")
    check(rows, pack_documents(df, length=256).collect(), 256)
    check(rows, pack_documents(df, length=256, max_queues=1).collect(), 256)
    assert pack_documents(df.filter("false")).count() == 0


@pytest.mark.parametrize("group", [256, 7, 2])
def test_sources_without_a_queue_of_their_own_are_mixed(spark, monkeypatch, group):
    monkeypatch.setattr(packing, "GROUP", group)
    rows = [(i, words(300, 40, i), None if i % 30 == 7 else f"s{i % 30}") for i in range(300)] + [(i, words(300, 200, i), "large") for i in range(300, 320)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = pack_documents(df, length=256, grain=8, max_queues=2).collect()
    check([r[:2] for r in rows], got, 256)
    all_tokens = sum(r.length for r in got)
    for source in {r.source for r in got}:
        pieces = sorted((256 * r.sequence_id + r.offset, r.length) for r in got if r.source == source)
        total, held = sum(n for _, n in pieces), 0
        for place, n in pieces:  # at any place, the source has had its share of the tokens, but for a few services
            assert abs(held - total * place / all_tokens) <= 80 < total / 8
            held += n


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, op7_packing(spark, SF).collect(), 2048)


def test_a_word_is_looked_up_once_for_many_texts():
    class Counting(dict):
        asked = 0

        def __getitem__(self, word):
            self.asked += 1
            return super().__getitem__(word)

    encoder = WordEncoder(PATH)
    encoder.known = Counting()
    texts = ["the quick brown fox, the quick dog!", "  the brown DOG\tfox,\r\n", ""] * 200
    got = encoder.encode(texts)
    want = Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)
    assert got == [np.array(e.ids, dtype="<u4").tobytes() for e in want]
    assert encoder.known.asked <= 40


def test_texts_of_a_batch_are_cut_at_any_size(spark, monkeypatch):
    rows = [(i, words(200, i % 70, i)) for i in range(90)] + [(90, None), (91, "a'b it's ÉTÉ ΣΑΣ é"), (92, "x" * 3000)]
    df = spark.createDataFrame([(d, t, f"s{d % 3}") for d, t in rows], "doc_id long, text string, source string").coalesce(1)
    whole = sorted(tuple(r) for r in pack_documents(df, length=256).collect())
    check(rows, pack_documents(df, length=256).collect(), 256)
    monkeypatch.setattr(packing, "DOCS_AT_ONCE", 7)
    monkeypatch.setattr(packing, "BYTES_AT_ONCE", 500)
    assert sorted(tuple(r) for r in pack_documents(df, length=256).collect()) == whole


def test_what_is_remembered_takes_few_bytes_a_word():
    encoder, n = WordEncoder(PATH), 40_000
    encoder.encode(["warm up"])
    rng = np.random.default_rng(3)
    letters = rng.integers(97, 123, (n, 12), dtype=np.uint8)
    texts = [b" ".join(row.tobytes() for row in part).decode() for part in np.array_split(letters, 20)]
    tracemalloc.start()
    try:
        arrow = pa.total_allocated_bytes()
        for text in texts:
            encoder.encode([text])
        gc.collect()
        held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - arrow
    finally:
        tracemalloc.stop()
    assert held <= 80 * n
    assert encoder.encode(texts) == [np.array(e.ids, dtype="<u4").tobytes() for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def test_words_are_learned_once_and_again_after_they_were_forgotten(monkeypatch):
    encoder, asked, texts = WordEncoder(PATH), [], ["the quick, brown fox", "the lazy dog's it's", "É\x85é  the 日本 fox\t", ""]
    learn = encoder._word_ids
    monkeypatch.setattr(encoder, "_word_ids", lambda words: asked.extend(words) or learn(words))
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    assert [x for _ in range(3) for t in texts for x in encoder.encode([t])] == want * 3 and len(asked) == len(set(asked))
    monkeypatch.setattr(packing, "CACHE", 4)
    assert [x for _ in range(3) for t in texts for x in encoder.encode([t])] == want * 3
