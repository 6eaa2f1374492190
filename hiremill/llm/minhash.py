"""MinHash near-duplicates by an inverted join over signature coordinates.

A document is the set of its word shingles, as 64-bit hashes; equal sets are one
set from the start. Its signature holds, for each of ``coordinates`` hash
functions, the least value over the set: two sets agree in a coordinate with the
probability of their Jaccard similarity. A set is posted under each of its
coordinate-value pairs, and two sets are candidates if they collide in at least
``matches`` lists. With 48 coordinates and 24 matches, a pair of similarity 0.8 is
missed once in about a million, and one of 0.85 practically never.

**Skip.** Values that one set alone has are dropped. A set with under ``matches``
values left collides with none often enough, and goes.

**Prefix.** With the values of a set ordered from rare to common, two sets that share
``matches`` of all share one of the first (left - matches + 1). Only these are posted,
so the long lists of common passages are skipped.

**Merge.** Lists, split by size, of up to ``small`` sets give their pairs; of each,
collisions are counted over both whole signatures (the longer lists are probed, not merged),
and pairs under ``matches`` go. Longer lists are those of large families of copies;
``families.group_labels`` links their members without making the pairs of a list.

**Confirmation** is the exact intersection of the full sets. Components of the links
follow, with the smallest doc_id as the name.

NULL, empty and blank texts have no set, link with nothing, and are kept. Texts with
fewer words than a shingle are one shingle. Repeated rows share their set. Rows without
an id take part; a component's name is the smallest id that is there, so NULL only
where no row of it has one, and kept is then NULL too. An empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hiremill.llm.common import table
from hiremill.llm.families import group_labels, group_pairs
from hiremill.llm.shingles import Shingler, binary_texts, mix
from hiremill.session import materialize

WORDS = 4
PERCENT = 80
COORDINATES = 48
MATCHES = 24
SMALL = 8
#: The filter of wanted sets has 16 bits for each, at most 32 MB.
FILTER_BITS = 16
MOST_FILTER_BITS = 1 << 28
U = np.uint64


def signer(coordinates: int):
    """signature(set): the least value of each coordinate's hash, which the coordinate's number is mixed into."""
    with np.errstate(over="ignore"):
        seeds = mix(np.arange(1, 2 * coordinates + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
    factors, shifts = seeds[:coordinates, None] | U(1), seeds[coordinates:, None]

    def signature(s: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            least = np.full(coordinates, ~U(0))
            for at in range(0, len(s), 2048):
                least = np.minimum(least, (factors * s[None, at : at + 2048] + shifts).min(axis=1))
            return mix(least + seeds[:coordinates] * U(3)).view(np.int64)

    return signature


def set_key(s: np.ndarray) -> bytes:
    """128 bits of the set's hash: equal keys are equal sets at any number of documents."""
    return hashlib.md5(s.tobytes()).digest()


def signed_documents(docs: DataFrame, words: int, coordinates: int, id_col: str) -> DataFrame:
    """(doc_id, n_shingles, key, signature): the signature once for every set and task."""

    def run(batches):
        signature, shingler, seen = signer(coordinates), Shingler(words), set()
        for batch in batches:
            sizes, keys, signs = [], [], []
            for s in shingler.sets(binary_texts(batch.column("text"))):
                key = set_key(s) if len(s) else None
                sizes.append(len(s))
                keys.append(key)
                signs.append(None if key is None or key in seen else signature(s))
                seen.add(key)
                if len(seen) > 500_000:  # only a saving: a set may be signed again
                    seen.clear()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(signs, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "key", "signature"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, f"doc_id {kind}, n_shingles long, key binary, signature array<bigint>")


def prefix_postings(sets: DataFrame, matches: int) -> DataFrame:
    """(value, set_no, size, central): each set under the rarest of its shared values; central is higher, the more common they are."""
    rows = sets.select("set_no", "size", F.explode("signature").alias("value"))
    often = rows.groupBy("value").agg(F.count("*").alias("often")).filter("often > 1")
    own = Window.partitionBy("set_no")
    ranked = rows.join(often, "value").select(
        "value", "set_no", "size", F.count("*").over(own).alias("left"), F.sum(F.log2("often")).over(own).alias("central"),
        F.row_number().over(own.orderBy("often", "value")).alias("at"),
    )
    return ranked.filter((F.col("left") >= matches) & (F.col("at") <= F.col("left") - matches + 1)).select("value", "set_no", "size", "central")


def size_groups(postings: DataFrame, percent: int) -> DataFrame:
    """(g, set_no, n): lists split by size, so that the members of a group are of one order; every similar pair of a list is in one group.

    A set of band b stands in the groups b and b - 1 of each of its values; its
    partners are at most one band away.
    """
    band = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-9)
    placed = postings.select("value", "set_no", band.alias("band")).select(
        "set_no", F.explode(F.array(F.struct(F.xxhash64("value", "band").alias("g"), F.lit(1).alias("home")), F.struct(F.xxhash64("value", F.col("band") - 1).alias("g"), F.lit(0).alias("home")))).alias("p")
    ).select("set_no", "p.g", "p.home")
    sizes = placed.groupBy("g").agg(F.count("*").alias("n"), F.max("home").alias("home")).filter("n > 1 and home = 1")
    return placed.select("g", "set_no").join(sizes.select("g", "n"), "g")


def colliding(pairs: DataFrame, sets: DataFrame, matches: int) -> DataFrame:
    """The pairs (a, b) that agree in at least so many coordinates."""
    x, y = (sets.select(F.col("set_no").alias(f"{v}_no"), F.col("signature").alias(v)) for v in "xy")
    met = pairs.join(x, F.col("a") == F.col("x_no")).join(y, F.col("b") == F.col("y_no"))
    agree = F.size(F.filter(F.zip_with("x", "y", lambda u, v: u == v), lambda same: same))
    return met.filter(agree >= matches).select("a", "b")


def key_slot(bits: int) -> Column:
    """The place of a key in a filter of so many bits: its first four bytes."""
    return F.conv(F.hex(F.substring("key", 1, 4)), 16, 10).cast("long") % bits


def wanted_filter(wanted: DataFrame) -> tuple[bytes, int]:
    """A bit for every place of a wanted key: sized from their number, 32 MB at most. What passes by chance is left out by a join."""
    bits = min(1 << max(16, (max(wanted.count(), 1) * FILTER_BITS - 1).bit_length()), MOST_FILTER_BITS)
    slots = wanted.select(key_slot(bits).alias("slot"))
    part = slots.groupBy(F.expr("slot div 32").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(slot % 32 as int)))").alias("bits")).toArrow()
    filled = np.zeros(bits // 32, dtype=np.uint32)
    filled[part.column("word").to_numpy()] = part.column("bits").to_numpy().astype(np.uint32)
    return filled.tobytes(), bits


def with_set_members(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``wanted`` (key, set_no, ...) with the members of each set, taken from the texts again."""
    filled, bits = wanted_filter(wanted)
    held = docs.sparkSession.sparkContext.broadcast(filled)

    def run(batches):
        filter_words, shingler, seen = np.frombuffer(held.value, dtype=np.uint32), Shingler(words), set()
        for batch in batches:
            keys, members = [], []
            for s in shingler.sets(binary_texts(batch.column("text"))):
                key = set_key(s) if len(s) else b"\0" * 4
                slot = int.from_bytes(key[:4], "big") % bits
                if len(s) and key not in seen and filter_words[slot // 32] >> np.uint32(slot % 32) & np.uint32(1):
                    keys.append(key)
                    members.append(s.tobytes())
                    seen.add(key)
                    if len(seen) > 500_000:  # only a saving
                        seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(members, pa.binary())], ["key", "members"])

    found = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "key binary, members binary").join(wanted.select("key"), "key", "left_semi")
    return wanted.join(found.groupBy("key").agg(F.first("members").alias("members")), "key")


def minhash_labels(docs: DataFrame, signed: DataFrame, words: int, percent: int, matches: int, small: int) -> tuple[DataFrame, DataFrame]:
    """(sets, labels): the distinct sets (set_no, key), and the class (node, label) of those that link."""
    first = signed.filter(F.col("signature").isNotNull()).groupBy("key").agg(F.first("signature").alias("signature"), F.first("n_shingles").alias("size"))
    sets = materialize(first.withColumn("set_no", F.monotonically_increasing_id()), "minhash-sets")
    postings = materialize(prefix_postings(sets, matches), "minhash-postings")
    groups = materialize(size_groups(postings, percent), "minhash-groups")
    small_groups = groups.filter(F.col("n") <= small).select("g", "set_no", F.lit(True).alias("open"))
    pairs = materialize(colliding(group_pairs(small_groups), sets, matches), "minhash-pairs")
    large = groups.filter(F.col("n") > small).select("g", "set_no")
    central = postings.groupBy("set_no").agg(F.first("central").alias("central"))
    in_play = pairs.select(F.col("a").alias("set_no")).unionByName(pairs.select(F.col("b").alias("set_no"))).unionByName(large.select("set_no")).distinct()
    wanted = materialize(sets.select("set_no", "key", "size").join(in_play, "set_no", "left_semi").join(central, "set_no"), "minhash-wanted")
    members = materialize(with_set_members(docs, wanted, words), "minhash-members")
    return sets.select("set_no", "key"), group_labels(large, pairs, members, percent, small)


def minhash_components(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, coordinates: int = COORDINATES, matches: int = MATCHES,
    small: int = SMALL, id_col: str = "doc_id",
) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable over links, its own included), kept."""
    signed = materialize(signed_documents(docs, words, coordinates, id_col), "minhash-signed")
    sets, labels = minhash_labels(docs, signed, words, percent, matches, small)
    per_set = signed.filter(F.col("key").isNotNull()).groupBy("key").agg(F.min("doc_id").alias("first_doc")).join(sets, "key")
    # Only sets with links need a class; all others are their own.
    linked = labels.join(per_set, F.col("node") == F.col("set_no"))
    smallest = linked.groupBy("label").agg(F.min("first_doc").alias("least"))
    names = linked.join(smallest, "label").select("key", "least")
    by_key = per_set.join(names, "key", "left").select(F.col("key").alias("of_key"), F.when(F.col("least").isNull(), F.col("first_doc")).otherwise(F.col("least")).alias("name"))
    named = signed.join(by_key, F.col("key") == F.col("of_key"), "left")
    component = F.coalesce("name", "doc_id")
    return named.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: four words, similarity 0.8 or more."""
    return minhash_components(table(spark, sf_dir, "documents"))
