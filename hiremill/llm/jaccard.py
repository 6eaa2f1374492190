"""N-gram Jaccard join by PartEnum signatures.

A document is the set of its word shingles, as 64-bit hashes; equal sets share
one set id and are joined from then on as one. Two sets link if their Jaccard
similarity is at least ``percent`` / 100.

**Signatures.** Sets are taken up in bands of size; band j serves the pairs
whose larger set has a size in [low, high], and a smaller set that can still
reach the threshold signs in the bands above its own as well. Similar sets of s1 and s2
elements differ in at most (100 - p) (s1 + s2) / (100 + p) of them: k for the
largest sets of a band, and k' <= k for a set and the largest partner it can have there. The
hash domain is cut into n > k ranges, of which at least n - k' hold the same elements in
both. A signature is the hash of (band, range, elements in the range). Empty
ranges are not signed: a set with e empty ranges keeps n - k' - e shared ones for
certain, its *need*, and a set whose need is not positive signs again over
another, remixed hash of its elements until it is. So every similar pair shares
at least the larger need of the two, counted in one seed and band.

**Candidates.** Signatures are sorted in their partitions. Groups of up to
``small`` sets give their pairs, of which those are verified that occur as
often as the need says. Larger groups never give pairs: a pair met in them
alone has at least its need of signatures there (both sets are *saturated*), and
shares one of the rarest of them. A saturated set stays in the groups of its
rarest signatures, and ``families.group_labels`` links what is similar in a group by pivots,
without its pairs.

**Verification** is the exact set intersection. Links, not all pairs, leave:
equal texts are joined by set id, classes by their components.

NULL, empty and blank texts have no set and link with nothing. Texts with fewer
words than a shingle are one shingle. Repeated rows share a component by
their set. An empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hiremill.llm.common import table
from hiremill.llm.families import group_labels
from hiremill.llm.shingles import Shingler, binary_texts, mix
from hiremill.session import materialize

WORDS = 5
PERCENT = 80
SMALL = 24
#: The filter of wanted sets has 16 bits for each, at most 32 MB.
FILTER_BITS = 16
MOST_FILTER_BITS = 1 << 28
#: Ranges for each of the k + 1 that are needed, and how much larger the largest set of a band may be than its smallest.
RANGES, RATIO = 1.08, 1.5
SIGNATURE_ROW = "sig long, set_id long, place int, need int"
U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit shingle hashes; empty without a word."""
    return next(Shingler(words).sets([(text or "").encode("utf-8", "surrogatepass")]))


def set_id(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.md5(s.tobytes()).digest()[:8], "little", signed=True)


class Bands:
    """Size bands: the largest size, k and n of each, and those in which a set of some size signs."""

    def __init__(self, percent: int = PERCENT, fine: float = RANGES, ratio: float = RATIO):
        self.percent, self.fine, self.ratio = percent, fine, ratio
        self.edges, self.params = [1], []

    def apart(self, total: int) -> int:
        """In how many elements two similar sets of so many elements together differ at most."""
        return (100 - self.percent) * total // (100 + self.percent)

    def _grow(self, size: int) -> None:
        while self.edges[-1] <= size:
            self.edges.append(max(self.edges[-1] + 1, int(np.ceil(self.edges[-1] * self.ratio))))
            high = self.edges[-1] - 1
            k = self.apart(2 * high)
            self.params.append((high, k, int(np.ceil(self.fine * (k + 1))) + 2))

    def of(self, size: int) -> list[tuple[int, int, int]]:
        """(band, k of this size, n) from the band of ``size`` to that of the largest size it can link with."""
        most = 100 * size // self.percent
        self._grow(most)
        first = int(np.searchsorted(self.edges, size, side="right")) - 1
        last = int(np.searchsorted(self.edges, most, side="right")) - 1
        rows = [(j, *self.params[j]) for j in range(first, last + 1)]
        return [(j, self.apart(size + min(high, most)), n) for j, high, k, n in rows if k > 0]


def signatures(s: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, place = band and seed, need) of a set; bands where only equal sets link give none."""
    sigs, places, needs = [], [], []
    with np.errstate(over="ignore"):
        for band, k, n in bands.of(len(s)):
            seed, h = 0, s
            while True:
                part = ((h >> U(32)) * U(n)) >> U(32)
                first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
                need = len(first) - k
                place = band * 64 + seed
                got = np.add.reduceat(mix(h), first)
                sigs.append(mix(got + mix(part[first] * U(_BASE) + U(place + 1))))
                places.append(np.full(len(first), place, dtype=np.int32))
                needs.append(np.full(len(first), max(need, 1), dtype=np.int32))
                if need > 0 or seed == 63:
                    break
                seed += 1
                h = np.sort(mix(s + U(seed) * U(_BASE)))
    if not sigs:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate(sigs), np.concatenate(places), np.concatenate(needs)


def signature_rows(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(sig, set_id, place, need), once for every set and task."""

    def run(batches):
        bands, shingler, seen = Bands(percent), Shingler(words), set()
        for batch in batches:
            out, size = [], 0
            for s in shingler.sets(binary_texts(batch.column("text"))):
                if not len(s) or (key := set_id(s)) in seen:
                    continue
                seen.add(key)
                if len(seen) > 2_000_000:  # only a saving: a set may be signed again
                    seen.clear()
                sig, place, need = signatures(s, bands)
                out.append((sig.view(np.int64), np.full(len(sig), key, dtype=np.int64), place, need))
                size += len(sig)
                if size > 100_000:
                    yield _signature_batch(out)
                    out, size = [], 0
            if out:
                yield _signature_batch(out)

    return docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, SIGNATURE_ROW)


def _signature_batch(out: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["sig", "set_id", "place", "need"])


def grouped_candidates(rows: DataFrame, small: int) -> DataFrame:
    """Of signatures shared by several sets: pairs (a, b) of small groups, members (a, b = NULL) of larger ones."""

    def run(batches):
        held = np.zeros((0, 4), dtype=np.int64)  # the group that may go on in the next batch
        big = None  # the signature of a group that is being passed through
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            sig = columns[0]
            if not len(sig):
                continue
            # Nearly all signatures stand alone: only rows beside an equal one go on, and the batch's ends.
            same = sig[1:] == sig[:-1]
            keep = np.append(same, True) | np.append(True, same)
            part = np.concatenate([held, np.stack([c[keep].astype(np.int64) for c in columns], axis=1)])
            part = part[np.append(True, (part[1:, :2] != part[:-1, :2]).any(axis=1))]
            last = int(np.flatnonzero(np.append(True, part[1:, 0] != part[:-1, 0]))[-1])
            done, held = part[:last], part[last:]
            if big is not None and len(done):  # the rest of the group that was passed on comes first
                n = int(np.searchsorted(done[:, 0], big, side="right"))
                yield from _out(done[n:], done[:n])
                big = None
            elif len(done):
                yield from _out(done, done[:0])
            if len(held) > small + 1:  # large already: pass on all but its last row
                yield from _out(held[:0], held[:-1])
                held, big = held[-1:], held[-1, 0]
        yield from _out(held[:0], held) if big is not None else _out(held, held[:0])

    def _out(done, members):
        parts = [(members, None)] if len(members) else []
        if len(done):
            starts = np.flatnonzero(np.append(True, done[1:, 0] != done[:-1, 0]))
            sizes = np.diff(np.append(starts, len(done)))
            size = np.repeat(sizes, sizes)
            if (m := size > small).any():
                parts.append((done[m], None))
            rest = done[(size > 1) & (size <= small)]
            for lag in range(1, small):
                at = np.flatnonzero(rest[:-lag, 0] == rest[lag:, 0]) if len(rest) > lag else ()
                if not len(at):
                    break
                pair = rest[at].copy()
                pair[:, 3] = np.maximum(pair[:, 3], rest[at + lag, 3])
                parts.append((pair, rest[at + lag, 1]))
        for rows, other in parts:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows[:, 0].copy()), pa.array(rows[:, 1].copy()), pa.nulls(len(rows), pa.int64()) if other is None else pa.array(other),
                    pa.array(rows[:, 2].astype(np.int32)), pa.array(rows[:, 3].astype(np.int32)),
                ],
                ["sig", "a", "b", "place", "need"],
            )

    ordered = rows.repartition("sig").sortWithinPartitions("sig", "set_id")
    return ordered.mapInArrow(run, "sig long, a long, b long, place int, need int")


def wanted_filter(wanted: DataFrame) -> bytes:
    """A bit for every place of a wanted set_id: sized from their number, 32 MB at most. What passes by chance is left out by a join."""
    bits = min(1 << max(16, (max(wanted.count(), 1) * FILTER_BITS - 1).bit_length()), MOST_FILTER_BITS)
    slots = wanted.select(F.pmod("set_id", F.lit(bits)).alias("slot"))
    part = slots.groupBy(F.expr("slot div 32").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(slot % 32 as int)))").alias("bits")).toArrow()
    filled = np.zeros(bits // 32, dtype=np.uint32)
    filled[part.column("word").to_numpy()] = part.column("bits").to_numpy().astype(np.uint32)
    return filled.tobytes()


def document_sets(docs: DataFrame, wanted: DataFrame, words: int, id_col: str) -> DataFrame:
    """(doc_id, n_shingles, set_id, members): the members of sets that pass the filter of ``wanted``, once for every set and task."""
    held = docs.sparkSession.sparkContext.broadcast(wanted_filter(wanted))

    def run(batches):
        filled, shingler, seen = np.frombuffer(held.value, dtype=np.uint32), Shingler(words), set()
        bits = 32 * len(filled)
        for batch in batches:
            at, sizes, keys, members, held_bytes = 0, [], [], [], 0
            for s in shingler.sets(binary_texts(batch.column("text"))):
                key = set_id(s) if len(s) else None
                own = None
                if key is not None and key not in seen and filled[key % bits // 32] >> np.uint32(key % 32) & np.uint32(1):
                    own = s.tobytes()
                    seen.add(key)
                    if len(seen) > 2_000_000:  # only a saving
                        seen.clear()
                sizes.append(len(s))
                keys.append(key)
                members.append(own)
                held_bytes += len(own or b"")
                if held_bytes > 1 << 24 or at + len(sizes) == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").slice(at, len(sizes)), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), pa.array(members, pa.binary())],
                        ["doc_id", "n_shingles", "set_id", "members"],
                    )
                    at, sizes, keys, members, held_bytes = at + len(sizes), [], [], [], 0

    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return picked.mapInArrow(run, f"doc_id {kind}, n_shingles long, set_id long, members binary")


def split_candidates(found: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """The pairs (a, b) that occur often enough, and the saturated sets' rows in large groups (sig, set_id, place, lost, spare).

    ``spare``: a partner shares one of so many rarest of the set's signatures there.
    """
    members = found.filter(F.col("b").isNull())
    lost = members.groupBy(F.col("a").alias("set_id"), "place").agg(F.count("*").alias("lost"), F.max("need").alias("need"))
    lost = materialize(lost, f"{name}-lost")

    def missing(side):
        return lost.select(F.col("set_id").alias(f"{side}_id"), F.col("place").alias(f"{side}_place"), F.col("lost").alias(f"{side}_lost"))

    counted = found.filter(F.col("b").isNotNull()).groupBy("a", "b", "place").agg(F.count("*").alias("n"), F.max("need").alias("need"))
    a, b = missing("a"), missing("b")
    pairs = (
        counted.join(a, (F.col("a") == F.col("a_id")) & (F.col("place") == F.col("a_place")), "left")
        .join(b, (F.col("b") == F.col("b_id")) & (F.col("place") == F.col("b_place")), "left")
        .filter(F.col("n") + F.least(F.coalesce("a_lost", F.lit(0)), F.coalesce("b_lost", F.lit(0))) >= F.col("need"))
        .select("a", "b").distinct()
    )
    full = lost.filter(F.col("lost") >= F.col("need")).select(
        F.col("set_id").alias("full_id"), F.col("place").alias("full_place"), "lost", (F.col("lost") - F.col("need") + 1).alias("spare")
    )
    hot = members.join(full, (F.col("a") == F.col("full_id")) & (F.col("place") == F.col("full_place")))
    hot = hot.select("sig", F.col("a").alias("set_id"), "place", "lost", "spare")
    return materialize(pairs, f"{name}-pairs"), materialize(hot, f"{name}-hot")


def rarest(hot: DataFrame) -> DataFrame:
    """(sig, set_id, size) of each set's ``spare`` rarest signatures: two similar sets share one of them in both."""
    sizes = hot.groupBy("sig").agg(F.count("*").alias("size"))
    order = Window.partitionBy("set_id", "place").orderBy("size", "sig")
    return hot.join(sizes, "sig").withColumn("at", F.row_number().over(order)).filter("at <= spare").select("sig", "set_id", "size")


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, small: int = SMALL, id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, set_id and component_id: the smallest doc_id reachable over links, its own included."""
    found = materialize(grouped_candidates(signature_rows(docs, words, percent), small), "jaccard-candidates")
    pairs, hot = split_candidates(found, "jaccard")
    hot = materialize(rarest(hot), "jaccard-rarest")
    central = hot.groupBy("set_id").agg(F.sum(F.log2("size")).alias("central"))
    ends = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
    wanted = materialize(ends.join(central, "set_id", "full"), "jaccard-wanted")
    sets = materialize(document_sets(docs, wanted, words, id_col), "jaccard-sets")
    members = sets.filter(F.col("members").isNotNull()).join(wanted.select("set_id"), "set_id", "left_semi")
    members = members.groupBy("set_id").agg(F.first("members").alias("members"), F.first("n_shingles").alias("size"))
    # The middle of a family has most of its marks in common: the share counts, as their number grows with the set.
    members = members.join(wanted, "set_id").select(F.col("set_id").alias("set_no"), "members", "size", (F.col("central") / F.col("size")).alias("central"))
    members = materialize(members, "jaccard-members")
    groups = hot.select(F.col("sig").alias("g"), F.col("set_id").alias("set_no"))
    labels = group_labels(groups, pairs, members, percent)

    per_set = sets.filter(F.col("set_id").isNotNull()).groupBy("set_id").agg(F.min("doc_id").alias("first_doc"))
    classed = per_set.join(labels, per_set["set_id"] == labels["node"], "left").select(
        "set_id", "first_doc", F.coalesce("label", "set_id").alias("class_id")
    )
    smallest = classed.groupBy("class_id").agg(F.min("first_doc").alias("component_id"))
    by_set = classed.join(smallest, "class_id").select(F.col("set_id").alias("of_set"), "component_id")
    return sets.join(by_set, F.col("set_id") == F.col("of_set"), "left").select(
        "doc_id", "n_shingles", "set_id", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: five words, similarity 0.8 or more."""
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
