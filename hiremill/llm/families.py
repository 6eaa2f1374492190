"""Links inside large groups of similar sets, without all pairs of a group.

A *group* says that any two of its sets may link: at least ``percent`` / 100 of
their union in both, which is to differ in at most
H = (|u| + |x|) (100 - percent) / (100 + percent) elements. Groups of up to ``small`` sets
give their pairs. In a larger one every set u is measured against a *pivot* c, the set
whose marks are most common (the middle of a family of copies); what links with it is in
one component. For the rest the sets are seen from the pivot: let U be the
elements that are in u or in c, but not in both. Then u and x differ exactly where U and X
do, so if u and x link, U and X have at least D = (|U| + |X| - H) / 2 elements in common. If
u does not link with c, D is positive for every x: |U| > H(u, c), and |X| is at
least the difference of x and c in size, by which H grows far less.

**Components.** Only links between sets that are not connected yet are looked for. So the components of the
links so far are made before each step, and a set is *open* if it is in another one than the pivot. A link between
two components shows in an element that the differences of sets of both have; elements that those of one
component alone have are dropped. What the family has in common is gone there as well; what is left
are a copy's own changes that another family has, and of these the rarest stand first: by the prefix
filter, the smaller of U and X has a common element among its first |U| - D' + 1, with the D' of a partner of its
own size, and the larger among its first H + 1. Elements too late in both orders for D common ones to follow give no
pair. A list of over ``long`` sets that share an element is a group again, with a pivot of its own, unless they are one component by then. After ``rounds``
only texts at the threshold to most of a family are left, and lists give their pairs at any length.

**Pairs** are first measured by *parities*: a set toggles one bit for each of its elements, so two sets differ in at least
as many elements as their parities in bits. Of what that leaves, each set's pair with its smallest partner is
measured on the whole sets, and then those pairs whose sets are still apart.
No link between components is lost, and each is measured on the whole sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hiremill.llm.components import labelled, merged_labels
from hiremill.session import materialize

#: Bits of a set's parities: at least two for each element, a power of two within these bounds.
LEAST_BITS, MOST_BITS = 64, 1 << 17
STAR = "u long, c long, size long, linked boolean, apart array<bigint>"


def inside(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of each element of x, whether it is in y; both sorted, without repeats."""
    if not len(y):
        return np.zeros(len(x), dtype=bool)
    return y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x


def similar(both: int, a: int, b: int, percent: int) -> bool:
    return 100 * both >= percent * (a + b - both)


def most_apart(total: Column, percent: int) -> Column:
    """H: in how many elements two similar sets of so many elements together differ at most."""
    return total - 2 * F.ceil(percent * total / (100 + percent))


def with_members(pairs: DataFrame, a: str, b: str, sets: DataFrame) -> DataFrame:
    """``pairs`` with the members of both sides as x and y."""
    x, y = (sets.select(F.col("set_no").alias(f"{v}_no"), F.col("members").alias(v)) for v in "xy")
    return pairs.join(x, F.col(a) == F.col("x_no")).join(y, F.col(b) == F.col("y_no")).drop("x_no", "y_no")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are that similar."""

    def run(batches):
        for batch in batches:
            x, y = batch.column("x"), batch.column("y")
            keep = []
            for i in range(batch.num_rows):
                u, v = (np.frombuffer(side[i].as_buffer(), dtype=np.uint64) for side in (x, y))
                keep.append(similar(int(inside(u, v).sum()), len(u), len(v), percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return with_members(pairs.select("a", "b"), "a", "b", sets).select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def stars(rays: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Each (u, c) measured: whether it links, and what is in one of both only."""

    def run(batches):
        for batch in batches:
            sizes, linked, apart = [], [], []
            x, y = batch.column("x"), batch.column("y")
            for i in range(batch.num_rows):
                u, c = (np.frombuffer(side[i].as_buffer(), dtype=np.uint64) for side in (x, y))
                hit = inside(u, c)
                sizes.append(len(u))
                linked.append(similar(int(hit.sum()), len(u), len(c), percent))
                apart.append(np.concatenate([u[~hit], c[~inside(c, u)]]).view(np.int64))
            ends = np.cumsum([0, *map(len, apart)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *apart])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("u"), batch.column("c"), pa.array(sizes, pa.int64()), pa.array(linked, pa.bool_()), lists], ["u", "c", "size", "linked", "apart"]
            )

    return with_members(rays, "u", "c", sets).select("u", "c", "x", "y").mapInArrow(run, STAR)


def parity(s: np.ndarray) -> np.ndarray:
    """A bit for each remainder of the elements: whether an odd number of them has it."""
    bits = min(max(LEAST_BITS, 1 << (2 * max(len(s), 1) - 1).bit_length()), MOST_BITS)
    return np.packbits(np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little")


def apart_at_least(x: np.ndarray, y: np.ndarray) -> int:
    """In how many elements the sets of two parities differ at least. A longer one folds to the other's length."""
    least = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(v.reshape(-1, least)) for v in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def parities(sets: DataFrame) -> DataFrame:
    """(set_no, size, parity) of each set."""

    def run(batches):
        for batch in batches:
            members = batch.column("members")
            bits = [parity(np.frombuffer(members[i].as_buffer(), dtype=np.uint64)).tobytes() for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column("set_no"), batch.column("size"), pa.array(bits, pa.binary())], ["set_no", "size", "parity"])

    return sets.select("set_no", F.col("size").cast("long").alias("size"), "members").mapInArrow(run, "set_no long, size long, parity binary")


def may_link(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose parities differ in no more bits than similar sets in elements."""

    def run(batches):
        for batch in batches:
            x, y, most = batch.column("x"), batch.column("y"), batch.column("most").to_numpy()
            keep = [apart_at_least(*(np.frombuffer(side[i].as_buffer(), dtype=np.uint8) for side in (x, y))) <= most[i] for i in range(batch.num_rows)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x, y = (sketches.select(F.col("set_no").alias(f"{v}_no"), F.col("size").alias(f"{v}_size"), F.col("parity").alias(v)) for v in "xy")
    met = pairs.select("a", "b").join(x, F.col("a") == F.col("x_no")).join(y, F.col("b") == F.col("y_no"))
    most = most_apart(F.col("x_size") + F.col("y_size"), percent)
    return met.select("a", "b", "x", "y", most.alias("most")).mapInArrow(run, "a long, b long")


def connecting(near: DataFrame, links: DataFrame, labels: DataFrame | None, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(labels, links): ``labels`` after ``links`` and part of the similar pairs of ``near`` (a, b), and further ones that connect all they do.

    Pairs that the new labels hold in one component are not measured.
    """
    if not near.head(1):
        return merged_labels(labels, links), near
    both = near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b")))
    first = both.groupBy("a").agg(F.min("b").alias("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    first = materialize(first, "family-first")
    labels = merged_labels(labels, links.unionByName(materialize(verified(first, sets, percent), "family-links")))
    rest = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
    rest = labelled(labelled(rest, labels, "a", "a_label"), labels, "b", "b_label").filter("a_label != b_label")
    return labels, materialize(verified(rest, sets, percent), "family-links")


def group_pairs(groups: DataFrame) -> DataFrame:
    """The pairs a < b of each group (g, set_no, open) with an open set."""
    one, two = (groups.select(F.col("g").alias(f"{v}_g"), F.col("set_no").alias(v), F.col("open").alias(f"{v}_open")) for v in "ab")
    return one.join(two, (F.col("a_g") == F.col("b_g")) & (F.col("a") < F.col("b")) & (F.col("a_open") | F.col("b_open"))).select("a", "b").distinct()


def group_heads(groups: DataFrame, central: DataFrame) -> DataFrame:
    """(g, n, any, c): the size of each group of several sets with an open one, and its pivot."""
    heads = groups.join(central, "set_no").groupBy("g").agg(
        F.count("*").alias("n"), F.max("open").alias("any"), F.max_by("set_no", F.struct("central", -F.col("set_no"))).alias("c")
    )
    return materialize(heads.filter("n > 1 and any"), "family-heads")


def shared_pivots(groups: DataFrame, heads: DataFrame) -> DataFrame:
    """(g, c): one pivot for the groups of a family, so that its sets are measured once. A set need not be in a group to be its pivot.

    Each set names the pivot of the largest group it is in; a group takes the one that half of its sets name, or else keeps its own.
    """
    members = groups.select("g", "set_no").join(heads.select("g", "n", "c"), "g")
    named = members.groupBy("set_no").agg(F.max_by("c", F.struct("n", "c")).alias("named"))
    votes = members.join(named, "set_no").groupBy("g", "named").agg(F.count("*").alias("votes"), F.first("n").alias("n"), F.first("c").alias("c"))
    best = votes.groupBy("g").agg(F.max("votes").alias("votes"), F.max_by("named", F.struct("votes", "named")).alias("named"), F.first("n").alias("n"), F.first("c").alias("c"))
    return best.select("g", F.when(2 * F.col("votes") >= F.col("n"), F.col("named")).otherwise(F.col("c")).alias("c"))


def difference_postings(measured: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(g, set_no, label, open, size, n, at, first): each set under the rarest elements of its difference from the pivot that another component has.

    ``n`` is the size of the difference, ``at`` the element's place in it from 1, and ``first`` says that the place is early enough for the smaller of two.
    """
    seen = labelled(labelled(measured, labels, "u", "label"), labels, "c", "c_label").withColumn("open", F.col("label") != F.col("c_label"))
    some = seen.filter("open").select("c").distinct()
    rows = seen.join(some, "c", "left_semi").select("c", "u", "label", "size", F.size("apart").cast("long").alias("n"), "open", F.explode("apart").alias("e"))
    shared = rows.groupBy("c", "e").agg(F.count("*").alias("often"), F.min("label").alias("least"), F.max("label").alias("most"))
    shared = shared.filter("least != most").drop("least", "most")
    own = Window.partitionBy("c", "u")
    ranked = rows.join(shared, ["c", "e"]).select(
        "*", (F.col("n") - F.count("*").over(own) + F.row_number().over(own.orderBy("often", "e"))).alias("at")  # what its component alone has comes first
    )
    apart = most_apart(F.col("size") + F.floor(F.col("size") * 100 / percent), percent)
    placed = ranked.select(
        F.xxhash64("c", "e").alias("g"), F.col("u").alias("set_no"), "label", "open", "size", "n", "at",
        (F.col("at") <= F.least("n", F.col("n") - F.ceil((2 * F.col("n") - apart) / 2) + 1)).alias("first"), apart.alias("apart"),
    )
    return placed.filter(F.col("at") <= F.col("apart") + 1).drop("apart")


def difference_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of different components in the lists that can have enough in common from the element on."""
    a, b = (postings.select(*[F.col(c).alias(f"{v}_{c}") for c in postings.columns]) for v in "ab")
    ordered = (F.col("a_n") < F.col("b_n")) | ((F.col("a_n") == F.col("b_n")) & (F.col("a_set_no") < F.col("b_set_no")))
    need = F.ceil((F.col("a_n") + F.col("b_n") - most_apart(F.col("a_size") + F.col("b_size"), percent)) / 2)
    room = 1 + F.least(F.col("a_n") - F.col("a_at"), F.col("b_n") - F.col("b_at"))
    met = (F.col("a_g") == F.col("b_g")) & F.col("a_first") & ordered & (F.col("a_label") != F.col("b_label")) & (room >= need)
    return a.join(b, met).select(F.col("a_set_no").alias("a"), F.col("b_set_no").alias("b")).distinct()


def several_classes(groups: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of the ``groups`` (g, set_no, open) whose sets are not all of one component."""
    seen = labelled(groups, labels, "set_no", "label").groupBy("g").agg(F.min("label").alias("least"), F.max("label").alias("most"))
    return groups.join(seen.filter("least != most").select("g"), "g", "left_semi")


def group_labels(groups: DataFrame, pairs: DataFrame, sets: DataFrame, percent: int, small: int = 8, long: int = 1000, rounds: int = 3) -> DataFrame:
    """(node, label): the components that the similar ones of ``pairs`` (a, b) and similar pairs within ``groups`` (g, set_no) make.

    The label is the smallest set_no; sets without links have none.
    ``sets`` holds (set_no, size, members, central) of each. A group may hold any
    number of sets: it is never brought into one task. Two different groups may
    by accident have one g; that only adds candidates. No groups, no pairs: no labels.
    """
    central = sets.select("set_no", "central")
    sketches = materialize(parities(sets), "family-parities")
    groups = groups.select("g", "set_no", F.lit(True).alias("open"))
    heads = group_heads(groups, central)
    found = pairs.select("a", "b").unionByName(group_pairs(groups.join(heads.filter(F.col("n") <= small).select("g"), "g", "left_semi")))
    labels, least = None, small
    for turn in range(rounds):
        large = heads.filter(F.col("n") > least)
        some = bool(large.head(1))
        if turn and not some:
            break
        rays = groups.join(shared_pivots(groups, large), "g").filter("set_no != c").select(F.col("set_no").alias("u"), "c").distinct()
        measured = materialize(stars(rays, sets, percent), "family-stars")
        links = measured.filter("linked").select(F.col("u").alias("a"), F.col("c").alias("b"))
        if turn:
            labels = merged_labels(labels, links)
        else:
            labels, links = connecting(materialize(may_link(found.distinct(), sketches, percent), "family-near"), links, labels, sets, percent)
        if not some:
            return merged_labels(labels, links)
        postings = materialize(difference_postings(measured, labels, percent), "family-differences")
        lists = postings.groupBy("g").agg(F.count("*").alias("n"))
        last = turn + 1 == rounds
        met = postings if last else postings.join(lists.filter(F.col("n") <= long).select("g"), "g", "left_semi")
        labels = merged_labels(*connecting(materialize(may_link(difference_pairs(met, percent), sketches, percent), "family-near"), links, labels, sets, percent))
        if not last:
            groups = postings.join(lists.filter(F.col("n") > long).select("g"), "g", "left_semi").select("g", "set_no", "open")
            groups = materialize(several_classes(groups, labels), "family-groups")
            heads, least = group_heads(groups, central), long
    return labels


def group_links(groups: DataFrame, pairs: DataFrame, sets: DataFrame, percent: int, small: int = 8, long: int = 1000, rounds: int = 3) -> DataFrame:
    """Links (a, b) from each set to the smallest of its component, as ``group_labels`` finds them."""
    labels = group_labels(groups, pairs, sets, percent, small, long, rounds)
    return labels.filter("node != label").select(F.col("node").alias("a"), F.col("label").alias("b"))
