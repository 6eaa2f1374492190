"""How the sources of each language differ from each other and from the language: exact term counts by minimal perfect hashes.

**First pass.** The number of a language's documents that hold a term, exactly: terms are
counted in the tasks, in bounded tables, and the partial counts are added up. Terms in at
least ``least_documents`` documents are the language's vocabulary.

**Perfect hashes.** A language's vocabulary is dealt by hash into shards of bounded size. Each shard gets a
minimal perfect hash by levels of bit fields (a key settles in the first level in which no
other key has its bit; its slot is the number of bits before it), and its terms are stored by slot.

**Second pass.** Shards are broadcast in rounds of at most ``round_bytes``, each round over the
whole table; one round is enough up to some ten million terms. A text's terms are counted, looked up in their
shard, verified against the stored term, and added to the dense slots of their group. Slots leave a task
as counts by group and shard when they are over a bound, and are added up by group and shard.

**Divergence.** All cells of a shard, groups x slots, meet in one task; shards are cut so small that
there are at most ``cells`` of them. Probabilities p = 1 + floor(10^9 (count + 1) / (N + V)) and
floor((p - q)^2 / q) are integers of 64 bits: the division goes digit by digit in base 1000, exact for N + V under 9 * 10^15.
A term list keeps ``most_terms`` of each shard before it is ranked: the whole list's are among them.
Pairs of sources are the square of a language's sources by definition.

NULL text, language and source count as ''. Documents are rows: repeated ones count as
often as they stand; ids are not read. Groups without a term have counts of 0. Languages
without a vocabulary give pairs of value 0. Ties go by the item's UTF-8 bytes. A text is split
whole. An empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hiremill.llm.common import table
from hiremill.session import materialize

LEAST_DOCUMENTS, MOST_TERMS, SCALE = 3, 200, 1_000_000_000
#: Terms of a shard, cells (groups x slots) of a shard, bytes of the shards of a round.
SHARD_TERMS, CELLS, ROUND_BYTES = 4096, 1 << 20, 128 << 20
#: Terms counted in a task before they leave, and slots.
HELD_TERMS, HELD_SLOTS = 400_000, 8_000_000
#: Bytes outside terms become spaces; A-Z become a-z.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
PIECE = 1 << 20
U = np.uint64


def terms(data: bytes):
    """The terms of a text in lists: runs of letters and of characters beyond ASCII, A-Z as a-z."""
    at = 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and TERM_BYTES[data[end]] != 32:
            end += 1
        yield data[at:end].translate(TERM_BYTES).split()
        at = end


def grouped_texts(docs: DataFrame) -> DataFrame:
    """(lang, source, text): NULL as '', the text as bytes."""
    return docs.select(
        F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text")
    )


def document_counts(texts: DataFrame) -> DataFrame:
    """(lang, term, documents): partial counts of the tasks."""

    def out(held):
        keys = [(lang, term, n) for lang, counts in held.items() for term, n in counts.items()]
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.binary()), pa.array([k[2] for k in keys], pa.int64())],
            ["lang", "term", "documents"],
        )

    def run(batches):
        held, size = {}, 0
        for batch in batches:
            langs, data = batch.column("lang"), batch.column("text")
            for i in range(batch.num_rows):
                counts = held.setdefault(langs[i].as_py(), Counter())
                before, own = len(counts), set()
                for piece in terms(data[i].as_py()):
                    own.update(piece)
                counts.update(own)
                size += len(counts) - before
                if size > HELD_TERMS:
                    yield out(held)
                    held, size = {}, 0
        yield out(held)

    return texts.select("lang", "text").mapInArrow(run, "lang string, term binary, documents long")


def term_hash(term: bytes, seed: int = 0) -> int:
    """With seed 0 the value of Spark's xxhash64(term)."""
    return xxhash.xxh64_intdigest(term, 42 + seed)


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys: slot(keys) is 0 .. n - 1, and anything for other keys."""

    LEVELS = 32

    def __init__(self, fields: list[np.ndarray]):
        self.fields = fields
        self.ranks = [np.cumsum(f, dtype=np.int32) for f in fields]
        self.starts = np.cumsum([0, *(int(r[-1]) for r in self.ranks)])

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        x = (keys ^ U(level * 0x9E3779B97F4A7C15 % 2**64)) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(29))) * U(0x94D049BB133111EB)
        return ((x >> U(32)) * U(size) >> U(32)).astype(np.int64)

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash | None:
        """None if two keys are equal."""
        fields, left = [], keys
        while len(left):
            if len(fields) == cls.LEVELS:
                return None
            size = 2 * len(left) + 1
            at = cls._place(left, len(fields), size)
            alone = np.bincount(at, minlength=size) == 1
            fields.append(alone)
            left = left[~alone[at]]
        return cls(fields or [np.ones(1, dtype=bool)])

    def slot(self, keys: np.ndarray) -> np.ndarray:
        out, open_ = np.zeros(len(keys), dtype=np.int64), np.arange(len(keys))
        for level, field in enumerate(self.fields):
            at = self._place(keys[open_], level, len(field))
            hit = field[at]
            out[open_[hit]] = self.starts[level] + self.ranks[level][at[hit]] - 1
            open_ = open_[~hit]
        return out

    def packed(self) -> bytes:
        sizes = np.array([len(self.fields), *map(len, self.fields)], dtype=np.int64)
        return sizes.tobytes() + b"".join(np.packbits(f).tobytes() for f in self.fields)

    @classmethod
    def unpacked(cls, data: bytes) -> PerfectHash:
        n = int(np.frombuffer(data, np.int64, 1)[0])
        sizes, at, fields = np.frombuffer(data, np.int64, n, 8), 8 * (n + 1), []
        for size in sizes.tolist():
            length = -(-size // 8)
            fields.append(np.unpackbits(np.frombuffer(data, np.uint8, length, at), count=size).astype(bool))
            at += length
        return cls(fields)


def shard_tables(vocabulary: DataFrame, languages: DataFrame) -> DataFrame:
    """(lang, shard, seed, hash, terms): of each shard the packed perfect hash, the seed of its keys, and the terms by slot."""

    def build(key, pdf):
        words, seed, made = pdf["term"].tolist(), -1, None
        while made is None:  # two terms of equal hash get another seed
            seed += 1
            keys = np.array([term_hash(w, seed) for w in words], dtype=np.uint64)
            made = PerfectHash.of(keys)
        by_slot = [b""] * len(words)
        for slot, word in zip(made.slot(keys).tolist(), words):
            by_slot[slot] = word
        return pd.DataFrame({"lang": [key[0]], "shard": [key[1]], "seed": [seed], "hash": [made.packed()], "terms": [by_slot]})

    shard = F.pmod(F.xxhash64("term"), F.col("shards"))
    placed = vocabulary.join(languages.select("lang", "shards"), "lang").select("lang", "term", shard.alias("shard"))
    return placed.groupBy("lang", "shard").applyInPandas(build, "lang string, shard long, seed long, hash binary, terms array<binary>")


class Vocabulary:
    """The shards of a round: which slot a language's term has, if it is a kept one. A language's slots of all its shards follow each other."""

    def __init__(self, rows: list[tuple], shards: dict[str, int]):
        self.shards = shards
        self.of = {(lang, shard): (seed, PerfectHash.unpacked(packed), terms) for lang, shard, seed, packed, terms in rows}
        self.held = {lang: sorted(s for of, s in self.of if of == lang) for lang in shards}
        self.starts = {lang: np.cumsum([0, *(len(self.of[lang, s][2]) for s in held)]) for lang, held in self.held.items()}

    def size(self, lang: str) -> int:
        return int(self.starts[lang][-1]) if lang in self.starts else 0

    def slots(self, lang: str, words: list[bytes]) -> np.ndarray:
        """The slot of each word among the language's, -1 if it is not a kept term of the round."""
        out = np.full(len(words), -1, dtype=np.int64)
        if not words or not self.size(lang):
            return out
        keys = np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(42)), dtype=np.uint64, count=len(words))
        shard = np.mod(keys.view(np.int64), self.shards[lang])
        order = np.argsort(shard, kind="stable")
        numbers = shard[order]
        for number, start in zip(self.held[lang], self.starts[lang].tolist()):
            at = order[np.searchsorted(numbers, number) : np.searchsorted(numbers, number, side="right")]
            if not len(at):
                continue
            seed, perfect, terms_by_slot = self.of[lang, number]
            own = keys[at] if not seed else np.array([term_hash(words[i], seed) for i in at], dtype=np.uint64)
            slot = perfect.slot(own)
            same = pc.equal(terms_by_slot.take(pa.array(slot)), pa.array([words[i] for i in at.tolist()], pa.binary())).to_numpy(zero_copy_only=False)
            out[at[same]] = start + slot[same]
        return out


CELL_ROW = "lang string, source string, shard long, slots binary, counts binary"


def cell_batch(rows: list[tuple]) -> pa.RecordBatch:
    """Rows (lang, source, shard, counts by slot); only slots that count leave."""
    some = [np.flatnonzero(r[3]) for r in rows]
    kinds = [pa.string(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [
            *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)),
            pa.array([x.astype(np.int32).tobytes() for x in some], pa.binary()),
            pa.array([r[3][x].astype(np.int64).tobytes() for r, x in zip(rows, some)], pa.binary()),
        ],
        ["lang", "source", "shard", "slots", "counts"],
    )


def slot_counts(texts: DataFrame, rows: list[tuple], shards: dict[str, int]) -> DataFrame:
    """(lang, source, shard, slots, counts): how often each group has the terms of ``rows``, partial counts of the tasks."""
    held = texts.sparkSession.sparkContext.broadcast((rows, shards))

    def run(batches):
        vocabulary = Vocabulary(*held.value)
        counted: dict[str, dict[str, Counter]] = {}
        dense: dict[tuple[str, str], np.ndarray] = {}
        size = 0

        def out():
            rows = []
            for (lang, source), counts in dense.items():
                starts = vocabulary.starts[lang]
                some = np.unique(np.searchsorted(starts, np.flatnonzero(counts), side="right") - 1)
                rows += [(lang, source, vocabulary.held[lang][s], counts[starts[s] : starts[s + 1]]) for s in some.tolist()]
            dense.clear()
            return cell_batch(rows)

        def add():
            """Counts to slots: the words of a language are looked up once for all its groups."""
            for lang, groups in counted.items():
                if not vocabulary.size(lang):
                    continue
                words = list(set().union(*groups.values()))
                slot_of = dict(zip(words, vocabulary.slots(lang, words).tolist()))
                for source, counts in groups.items():
                    slots = np.fromiter(map(slot_of.__getitem__, counts), dtype=np.int64, count=len(counts))
                    times = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
                    if (lang, source) not in dense:
                        if sum(map(len, dense.values())) + vocabulary.size(lang) > HELD_SLOTS and dense:
                            yield out()
                        dense[lang, source] = np.zeros(vocabulary.size(lang), dtype=np.int64)
                    dense[lang, source][slots[slots >= 0]] += times[slots >= 0]
            counted.clear()

        for batch in batches:
            langs, sources, data = (batch.column(c) for c in ("lang", "source", "text"))
            for i in range(batch.num_rows):
                counts = counted.setdefault(langs[i].as_py(), {}).setdefault(sources[i].as_py(), Counter())
                before = len(counts)
                for piece in terms(data[i].as_py()):
                    counts.update(piece)
                size += len(counts) - before
                if size > HELD_TERMS:
                    yield from add()
                    size = 0
        yield from add()
        yield out()

    return texts.mapInArrow(run, CELL_ROW)


def summed_cells(partial: DataFrame) -> DataFrame:
    """One row for each (lang, source, shard), and ``n``, the sum of its counts."""

    def run(batches):
        key, total = None, np.zeros(0, dtype=np.int64)

        def out():
            cells = cell_batch([(*key, total)])
            return pa.RecordBatch.from_arrays([*cells.columns, pa.array([int(total.sum())], pa.int64())], [*cells.schema.names, "n"])

        for batch in batches:
            for row in batch.to_pylist():
                new = (row["lang"], row["source"], row["shard"])
                if new != key:
                    if key is not None:
                        yield out()
                    key, total = new, np.zeros(0, dtype=np.int64)
                slots, counts = np.frombuffer(row["slots"], np.int32), np.frombuffer(row["counts"], np.int64)
                if len(slots) and slots[-1] >= len(total):
                    total = np.append(total, np.zeros(int(slots[-1]) + 1 - len(total), dtype=np.int64))
                total[slots] += counts
        if key is not None:
            yield out()

    place = ["lang", "source", "shard"]
    return partial.repartition(*place).sortWithinPartitions(*place).mapInArrow(run, f"{CELL_ROW}, n long")


def probabilities(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (count + 1) / total), three decimal digits at a time."""
    rest, out = counts + 1, 0
    whole, rest = np.divmod(rest, total)
    out = whole
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + digit
    return out + 1


def shard_values(cells: DataFrame, shards: DataFrame, most_terms: int) -> DataFrame:
    """(lang, source, part, item, value): the pairs' sums over each shard, and each group's foremost terms of it.

    ``cells`` has every group of the language once for each shard, with its total n and, if any, counts;
    ``shards`` the terms, the language's total and V.
    """

    def run(key, rows, about):
        by_slot, all_n, v = (about[c].iat[0] for c in ("terms", "all_n", "v"))
        words = [bytes(w) for w in by_slot]
        alphabetic = np.empty(len(words), dtype=np.int64)
        alphabetic[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        counts = np.zeros((len(rows), len(words)), dtype=np.int64)
        for i, (slots, own) in enumerate(zip(rows["slots"], rows["counts"])):
            if slots is not None:
                counts[i, np.frombuffer(slots, np.int32)] = np.frombuffer(own, np.int64)
        sources = rows["source"].tolist()
        p = probabilities(counts, rows["n"].to_numpy(dtype=np.int64)[:, None] + int(v))
        q = probabilities(counts.sum(axis=0), np.int64(int(all_n) + int(v)))
        out = []
        for j, other in enumerate(sources):
            far = p - p[j]
            sums = (far * far // p[j]).sum(axis=1).tolist()
            out += [(source, "pair", other, sums[i]) for i, source in enumerate(sources) if i != j]
        far = p - q
        value = far * far // q
        for i, source in enumerate(sources):
            at = np.flatnonzero((counts[i] > 0) & (far[i] > 0))
            at = at[np.lexsort((alphabetic[at], -value[i, at]))[:most_terms]]
            out += [(source, "term", words[k].decode("utf-8", "replace"), x) for k, x in zip(at.tolist(), value[i, at].tolist())]
        frame = pd.DataFrame(out, columns=["source", "part", "item", "value"])
        frame.insert(0, "lang", key[0])
        return frame

    place = ["lang", "shard"]
    return cells.groupBy(*place).cogroup(shards.groupBy(*place)).applyInPandas(run, "lang string, source string, part string, item string, value long")


def rounds_of(shards: DataFrame, round_bytes: int) -> DataFrame:
    """``shards`` with the round of each, so that no round has more bytes than that, unless it is one shard."""
    size = F.length("hash") + F.aggregate("terms", F.lit(0).cast("long"), lambda total, t: total + F.length(t) + 16)
    sized = shards.withColumn("bytes", size)
    found = sized.agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")).first()
    rounds = -(-(found["bytes"] or 0) // round_bytes) or 1
    while True:
        dealt = sized.withColumn("round", F.pmod(F.xxhash64("lang", "shard"), F.lit(rounds)))
        most = dealt.groupBy("round").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")).filter((F.col("bytes") > round_bytes) & (F.col("n") > 1))
        if rounds == 1 or not most.head(1):
            return dealt.drop("bytes")
        rounds = -(-rounds * 5 // 4)


def source_divergence(
    docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, most_terms: int = MOST_TERMS, shard_terms: int = SHARD_TERMS,
    cells: int = CELLS, round_bytes: int = ROUND_BYTES,
) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank."""
    texts = grouped_texts(docs)
    groups = materialize(texts.select("lang", "source").distinct(), "divergence-groups")
    kept = document_counts(texts).groupBy("lang", "term").agg(F.sum("documents").alias("documents")).filter(F.col("documents") >= least_documents)
    vocabulary = materialize(kept.select("lang", "term"), "divergence-vocabulary")
    per_shard = F.greatest(F.lit(1), F.least(F.lit(shard_terms), F.expr(f"{cells} div sources")))
    languages = groups.groupBy("lang").agg(F.count("*").alias("sources")).join(vocabulary.groupBy("lang").agg(F.count("*").alias("v")), "lang", "left")
    languages = languages.select("lang", F.coalesce("v", F.lit(0)).alias("v"), F.ceil(F.coalesce("v", F.lit(0)) / per_shard).alias("shards"))
    languages = materialize(languages, "divergence-languages")
    shards = materialize(rounds_of(materialize(shard_tables(vocabulary, languages), "divergence-shards"), round_bytes).join(languages.select("lang", "shards"), "lang"), "divergence-rounds")

    partial = None
    for number in sorted(r["round"] for r in shards.select("round").distinct().collect()):
        part = shards.filter(F.col("round") == number).drop("round").toArrow()
        names = dict(zip(part.column("lang").to_pylist(), part.column("shards").to_pylist()))
        fields = [part.column(c).to_pylist() for c in ("lang", "shard", "seed", "hash")]
        rows = [(*f, pa.array(own.as_py(), pa.binary())) for *f, own in zip(*fields, part.column("terms"))]
        counted = materialize(slot_counts(texts, rows, names), "divergence-cells")
        partial = counted if partial is None else partial.unionByName(counted)

    none = groups.filter(F.lit(False)).select("lang", "source", F.lit("").alias("part"), F.lit("").alias("item"), F.lit(0).cast("long").alias("value"))
    values = none
    if partial is not None:
        summed = materialize(summed_cells(partial), "divergence-sums")
        group_n = groups.join(summed.groupBy("lang", "source").agg(F.sum("n").alias("n")), ["lang", "source"], "left").select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"))
        group_n = materialize(group_n, "divergence-totals")
        all_n = group_n.groupBy("lang").agg(F.sum("n").alias("all_n"))
        every = group_n.join(languages.filter("shards > 0"), "lang").select("lang", "source", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"))
        full = every.join(summed.select("lang", "source", "shard", "slots", "counts"), ["lang", "source", "shard"], "left")
        about = shards.select("lang", "shard", "terms").join(all_n, "lang").join(languages.select("lang", "v"), "lang")
        values = materialize(shard_values(full, about, most_terms), "divergence-values")

    bare = groups.join(languages.filter("v = 0").select("lang"), "lang")
    others = bare.select(F.col("lang").alias("of_lang"), F.col("source").alias("item"))
    empty = bare.join(others, (F.col("lang") == F.col("of_lang")) & (F.col("source") != F.col("item"))).select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    pairs = values.filter("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).unionByName(empty)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank)
    foremost = values.filter("part = 'term'").select("lang", "source", "part", "item", "value", rank).filter(F.col("rank") <= most_terms)
    return pairs.unionByName(foremost)


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: terms in at least 3 documents of their language, term lists of 200."""
    return source_divergence(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
),
words AS (
    SELECT row_no, lang, source, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM docs
),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT row_no) >= 3),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
found AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term),
totals AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM groups LEFT JOIN found USING (lang, source) GROUP BY lang, source),
lang_found AS (SELECT lang, term, sum(n) AS n FROM found GROUP BY lang, term),
lang_totals AS (SELECT lang, sum(total) AS total FROM totals GROUP BY lang),
p AS (
    SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (total + v)::HUGEINT AS p
    FROM groups JOIN kept USING (lang) JOIN sizes USING (lang) JOIN totals USING (lang, source) LEFT JOIN found USING (lang, source, term)
),
q AS (
    SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 1)) // (total + v)::HUGEINT AS q
    FROM lang_found JOIN sizes USING (lang) JOIN lang_totals USING (lang)
),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    UNION ALL
    SELECT a.lang, a.source, b.source, 0 FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    WHERE a.lang NOT IN (SELECT lang FROM sizes)
),
terms AS (
    SELECT lang, source, term AS item, ((p - q) * (p - q)) // q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
),
listed AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM listed)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
