"""N-gram Jaccard self-join by parity sketches, and the classes of linked documents.

The method. A document is the set of its hashed word shingles. A parity sketch flips one bit per
element, so the Hamming distance of two sketches is at most the size of the symmetric difference D
of the sets. Two sets linked at similarity p have D <= (1 - p) / p * (size of the smaller). Elements
are also dealt by hash into k buckets, and each bucket keeps the XOR of its elements. A differing
element changes one bucket, so (pigeonhole) linked documents agree in all but D of their filled
buckets: among the D + 1 smallest bucket keys of each there is a common one. Documents are joined
on these keys; k depends on the size band, so a document also emits keys for the band below when a
smaller partner may lie there. Candidates are checked by size, by sketch, and then exactly.

No link between classes is lost. The number of filled buckets is compared with D for every
document; a band in which one has too few is keyed by single elements too, for which the argument
always holds. Not all pairs of a key are formed: each document is checked against leaders of its
keys first. Only where documents of one key remain in different components are they checked
against the largest of these components, and then the pairs that are left enumerated, in blocks:
those outside the key's largest component with all others. Before that, documents of crowded keys,
with many outside, are keyed again with those keys last in the order, so that a passage that many
documents share does not make pairs of them all; one of several keys with the same documents is
enumerated. A round of this makes no more keys than the first time.

Scale: equal sets within a task emit their keys once, and equal keys within a batch are linked to a
local leader there, so a key shared by a third of all documents arrives as one row per batch. Keys
are shuffled once as two or three longs; pairs carry sketches of a fixed size, and whole sketches
and texts are read again only for what these let through. Texts are picked by a broadcast of their
ids, so others are not shuffled. Nothing but the list of bands (at most 64) comes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.common import listed, stored, stored_counting, text_or_empty, tune_arrow
from marketlake.llm.components import components

# Documents of fewer shingles are keyed by single elements; bands are powers of two.
SMALL_BAND = 6
# Bits of a sketch over the least size of its band. Sets that differ by a third more than linked
# ones may are told apart by so few; pairs carry them through a shuffle.
SKETCH_BITS = 2
# Words of the brief sketch, which goes along with pairs; the others are looked up for what it lets
# through.
BRIEF = 8
# Filled buckets over differing elements, as planned; see `buckets`.
SPARE = 1.28
# Members of one key that one task compares with each other.
BLOCK = 1024
# Rounds that join the largest components of the keys before the rest is enumerated.
BRIDGES = 1
# Keys of so many documents are put last in the order of keys before pairs are enumerated, unless one
# component holds at least half and fewer than these are outside it: so many keys a round at most, in
# so many rounds. Those that are left are enumerated as they are. A key that is not put last has
# fewer than CROWD pairs to compare for each document.
CROWD = 1024
CROWDED = 50_000
ROUNDS = 2

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of `size` words; of the whole, if it has fewer words."""
    words = text.encode().lower().split()  # bytes: A-Z and ASCII white space alone
    n = len(words)
    if not n:
        return np.empty(0, U)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), U, n)
    size = min(size, n)
    total = np.zeros(n - size + 1, U)
    for k in range(size):
        total = total * U(0x9E3779B97F4A7C15) + hashed[k : n - size + 1 + k]
    return distinct(mix(total + U(size)))


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted values, each once."""
    values.sort()
    return values[np.r_[True, values[1:] != values[:-1]]]


def max_difference(size: int, percent: int) -> int:
    """Largest symmetric difference of a linked pair whose smaller set has `size` elements."""
    return (100 - percent) * size // percent


def band(size: int) -> int:
    return size.bit_length() - 1


def buckets(level: int, percent: int) -> int:
    """Buckets for the band of sizes 2**level to 2**(level + 1) - 1."""
    return max(1, int(SPARE * (100 - percent) / percent * (2 << level)))


def level_keys(elements: np.ndarray, level: int, percent: int, exact: bool) -> np.ndarray:
    """Keys of all filled buckets of one level, or of all elements."""
    tag = mix(np.array([level + 1], U))
    if exact or level < SMALL_BAND:
        return mix(elements ^ tag)
    k = U(buckets(level, percent))
    bucket = ((elements >> U(32)) * k) >> U(32)  # rises with the sorted elements
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    parity = np.bitwise_xor.reduceat(mix(elements), starts)
    return mix(parity ^ mix(bucket[starts] + (tag << U(1))))


def levels(size: int, percent: int) -> list[tuple[int, int]]:
    """(level, largest difference) of the bands in which a partner may lie as the smaller set."""
    own = band(size)
    found = [(own, max_difference(size, percent))]
    below = (1 << own) - 1
    if below and percent * size <= 100 * below:
        found.append((own - 1, max_difference(below, percent)))
    return found


def sketch(elements: np.ndarray) -> np.ndarray:
    """Parity bits, one to two for each element, as 64-bit words.

    Linked sets differ by a quarter of their elements at most, so few differences meet on one bit
    and the distance is close to their number. The number of bits is a power of two: a sketch folds
    to half its size by XOR of its halves.
    """
    bits = max(64, SKETCH_BITS << band(len(elements))) if len(elements) else 64
    flips = np.bincount((elements & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view(np.int64)


def brief(elements: np.ndarray) -> list[int]:
    """The parity sketch of `BRIEF` words that sets of every size have."""
    bits = 64 * BRIEF
    flips = np.bincount((elements & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view(np.int64).tolist()


BRIEFS = [f"b{i}" for i in range(BRIEF)]

PROFILE = [
    ("n", pa.int64(), T.LongType()),
    ("f1", pa.int64(), T.LongType()),
    ("f2", pa.int64(), T.LongType()),
    *[(name, pa.int64(), T.LongType()) for name in BRIEFS],
    ("sketch", pa.list_(pa.int64()), T.ArrayType(T.LongType())),
    ("keys", pa.list_(pa.int64()), T.ArrayType(T.LongType())),
    ("thin", pa.list_(pa.int32()), T.ArrayType(T.IntegerType())),
]


def leading(keys: np.ndarray, count: int, late: np.ndarray) -> np.ndarray:
    """The first `count` keys: the smallest, but any of `late` (sorted) only after all others."""
    if len(late):
        is_late = late[np.minimum(np.searchsorted(late, keys), len(late) - 1)] == keys
        others = keys[~is_late]
        if len(others) < count:
            return np.r_[others, leading(keys[is_late], count - len(others), late[:0])]
        keys = others
    return np.partition(keys, count - 1)[:count] if len(keys) > count else keys


def document_keys(elements: np.ndarray, percent: int, exact_levels=None, late=np.empty(0, U)):
    """(keys of a set, levels where its keys are too few to be sure of a common one).

    Of each level the first keys, one more than may differ, by size and those in `late` last. With
    `exact_levels` only those levels count, and single elements are the keys.
    """
    keys, thin = [np.empty(0, U)], []
    for level, most in levels(len(elements), percent) if len(elements) else []:
        if exact_levels is not None and level not in exact_levels:
            continue
        found = level_keys(elements, level, percent, exact_levels is not None)
        if len(found) <= most:
            thin.append(level)
        keys.append(leading(found, most + 1, late))
    return np.concatenate(keys), thin


def profiler(
    size: int, percent: int, exact_levels: frozenset[int] | None = None, late=np.empty(0, U)
):
    """mapInArrow: _id, _text -> id and the columns of PROFILE."""

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in PROFILE]
            for text in batch.column("_text").to_pylist():
                elements = shingles(text, size)
                digest = xxhash.xxh3_128_digest(elements.tobytes())
                keys, thin = document_keys(elements, percent, exact_levels, late)
                row = (
                    len(elements), *np.frombuffer(digest, np.int64).tolist(),
                    *brief(elements), sketch(elements), keys.view(np.int64), thin,
                )
                for column, value in zip(columns, row):
                    column.append(value)
            arrays = [pa.array(c, kind) for c, (_, kind, _) in zip(columns, PROFILE)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), *arrays], names=["id", *[name for name, _, _ in PROFILE]]
            )

    return profile


def deal_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow: id, f1, f2, keys -> key, salt, id, leader.

    Equal sets of one task emit once. Of equal keys within a batch the first is the leader: its row
    has salt 0 and no leader, the others' salts spread them over the tasks of the next stage.
    """
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        prints = zip(batch.column("f1").to_pylist(), batch.column("f2").to_pylist())
        fresh = []
        for row, fingerprint in enumerate(prints):
            if fingerprint not in seen:
                seen.add(fingerprint)
                fresh.append(row)
        lists = batch.column("keys").take(pa.array(fresh, pa.int64()))
        key = lists.flatten().to_numpy(zero_copy_only=False).view(U)
        if not len(key):
            continue
        owner = np.repeat(np.array(fresh), lists.value_lengths().to_numpy(zero_copy_only=False))
        _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        lead = first[inverse]
        follows = owner[lead] != owner
        ids = batch.column("id")
        salt = np.where(follows, (mix(key + owner.astype(U)) >> U(1)) | U(1), U(0))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(key.view(np.int64)),
                pa.array(salt.view(np.int64)),
                ids.take(pa.array(owner)),
                ids.take(pa.array(owner[lead], mask=~follows)),
            ],
            names=["key", "salt", "id", "leader"],
        )


def verifier(size: int, percent: int):
    """mapInArrow: a, b, text_a, text_b -> a, b of the pairs that are linked."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[str, np.ndarray] = {}

            def of(text: str) -> np.ndarray:
                if text not in known:
                    known[text] = shingles(text, size)
                return known[text]

            linked = []
            columns = (batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist())
            for text_a, text_b in zip(*columns):
                a, b = of(text_a), of(text_b)
                both = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(both > 0 and 100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return verify


def folded(sketch: Column, words: Column) -> Column:
    """A sketch in `words` words: its halves XORed if it has twice as many."""
    halves = F.zip_with(
        F.slice(sketch, 1, words),
        F.slice(sketch, words + 1, words),
        lambda x, y: x.bitwiseXOR(y),
    )
    return F.when(F.size(sketch) > words, halves).otherwise(sketch)


def within(n_a: Column, n_b: Column, side_a: str, side_b: str, percent: int) -> Column:
    """Whether sizes and brief sketches, in columns with these prefixes, allow a link."""
    smaller = F.least(n_a, n_b)
    distance = F.lit(0)
    for name in BRIEFS:
        distance = distance + F.bit_count(F.col(side_a + name).bitwiseXOR(F.col(side_b + name)))
    sizes = percent * F.greatest(n_a, n_b) <= 100 * smaller
    return sizes & (distance * (100 + percent) <= (100 - percent) * (n_a + n_b))


def side(classes: DataFrame, rep: str, n: str, prefix: str) -> DataFrame:
    """The class representatives as one side of pairs: `rep`, `n` and the brief sketch."""
    words = [F.col(b).alias(prefix + b) for b in BRIEFS]
    return classes.select(F.col("rep").alias(rep), F.col("n").alias(n), *words)


def apart(n_a: Column, n_b: Column, sketch_a: Column, sketch_b: Column, percent: int) -> Column:
    """At least so many elements differ, by the sketches; null if sizes or sketches rule a link out.

    Never null for a linked pair: sizes that allow a link are at most one band apart.
    """
    smaller = F.least(n_a, n_b)
    words = F.least(F.size(sketch_a), F.size(sketch_b))
    distance = F.aggregate(
        F.zip_with(
            folded(sketch_a, words),
            folded(sketch_b, words),
            lambda x, y: F.bit_count(x.bitwiseXOR(y)),
        ),
        F.lit(0),
        lambda total, x: total + x,
    )
    sizes = percent * F.greatest(n_a, n_b) <= 100 * smaller
    alike = distance * (100 + percent) <= (100 - percent) * (n_a + n_b)
    return F.when(sizes, F.when(alike, distance))


class ParityJoin:
    """One run of the join over rows (_id, _text); the steps in order."""

    def __init__(self, rows: DataFrame, size: int, percent: int):
        self.rows, self.size, self.percent = rows, size, percent
        self.id_type = rows.schema["_id"].dataType
        self.exact: frozenset[int] = frozenset()  # levels keyed by single elements too

    def schema(self, *fields: tuple[str, T.DataType]) -> T.StructType:
        return T.StructType([T.StructField(*field) for field in fields])

    def profiles(self, exact_levels: frozenset[int] | None = None) -> DataFrame:
        """id and the columns of PROFILE for each row."""
        fields = [(name, kind) for name, _, kind in PROFILE]
        return self.rows.mapInArrow(
            profiler(self.size, self.percent, exact_levels),
            self.schema(("id", self.id_type), *fields),
        )

    def dealt(self, rows: DataFrame, deal) -> DataFrame:
        """The rows of `deal_keys`, or of a function that ends in it."""
        fields = [("key", T.LongType()), ("salt", T.LongType())]
        ids = [("id", self.id_type), ("leader", self.id_type)]
        return rows.mapInArrow(deal, self.schema(*fields, *ids))

    def keyed_again(self, rows: DataFrame, exact_levels, late: np.ndarray) -> DataFrame:
        """The keys of `rows` with `late` last, dealt by the worker that makes them."""
        profile = profiler(self.size, self.percent, exact_levels, late)
        return self.dealt(rows, lambda batches: deal_keys(profile(batches)))

    def memberships(self, keyed: DataFrame) -> DataFrame:
        """key, id, leader: documents that share a key, each with another of that key."""
        same = Window.partitionBy("key", "salt")
        led = keyed.select(
            "key", "id", F.coalesce("leader", F.min("id").over(same)).alias("leader")
        )
        return led.filter(F.col("leader") != F.col("id"))

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are linked, by their texts."""
        wanted = listed(pairs.select("a").union(pairs.select("b")).distinct())
        texts = self.rows.join(wanted, F.col("_id") == F.col("a"), "left_semi")
        first = texts.select(F.col("_id").alias("a"), F.col("_text").alias("text_a"))
        second = texts.select(F.col("_id").alias("b"), F.col("_text").alias("text_b"))
        return (
            pairs.select("a", "b")
            .join(first, "a")
            .join(second, "b")
            .mapInArrow(
                verifier(self.size, self.percent),
                self.schema(("a", self.id_type), ("b", self.id_type)),
            )
        )

    def candidates(self, pairs: DataFrame, classes: DataFrame) -> DataFrame:
        """Of the pairs (a, b) of class representatives those that may be linked, with `share`.

        `share` is the part of both sets that differs at least, by sizes and sketches. The brief
        sketches come first; whole ones are looked up for what is left.
        """
        met = pairs.select("a", "b").join(side(classes, "a", "n_a", "l_"), "a")
        met = met.join(side(classes, "b", "n_b", "r_"), "b")
        n_a, n_b = F.col("n_a"), F.col("n_b")
        left = stored(met.filter(within(n_a, n_b, "l_", "r_", self.percent)).select("a", "b"))
        return self.sketched(left, classes)

    def sketched(self, pairs: DataFrame, classes: DataFrame) -> DataFrame:
        """The same by the whole sketches alone."""
        left = classes.select(
            F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a")
        )
        right = classes.select(
            F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b")
        )
        n_a, n_b = F.col("n_a"), F.col("n_b")
        share = apart(n_a, n_b, F.col("s_a"), F.col("s_b"), self.percent) / (n_a + n_b)
        met = pairs.select("a", "b").join(left, "a").join(right, "b")
        return met.select("a", "b", share.alias("share")).filter(F.col("share").isNotNull())

    def open_members(self, members: DataFrame, reps: DataFrame, found: DataFrame) -> DataFrame:
        """key, rep: the members of keys whose documents are in several components."""
        placed = with_component(reps, found)
        here = placed.select("id", F.col("component").alias("_c"))
        there = placed.select(F.col("id").alias("leader"), F.col("component").alias("_lc"))
        split = (
            members.groupBy("id", "leader")
            .agg(F.lit(1).alias("_one"))
            .join(here, "id")
            .join(there, "leader")
            .filter(F.col("_c") != F.col("_lc"))
            .select("id", "leader")
        )
        open_keys = stored(members.join(stored(split), ["id", "leader"]).select("key").distinct())
        return holders(members.join(open_keys, "key", "left_semi"), reps)

    def uncrowded(self, members: DataFrame, reps: DataFrame, found: DataFrame) -> DataFrame:
        """key, rep: members of keys that stand in for `members`, with fewer documents to a key.

        Linked documents have a common key in whatever order the keys are taken, if it is the same
        for all. So crowded keys, those of passages that many documents share, are put last, and
        their documents take the next ones of their own instead. These documents alone are keyed
        again, among themselves: a linked pair with a document that has no crowded key has a common
        key that is not crowded. A document without other keys left keeps its crowded ones.
        """
        late, parts = np.empty(0, U), []
        for _ in range(ROUNDS):
            keys = parted(with_component(members, found)).filter(F.col("_n") >= CROWD)
            crowded = keys.filter((F.col("_out") >= CROWD) | (2 * F.col("_out") > F.col("_n")))
            worst = crowded.orderBy(F.desc("_out"), "key").limit(CROWDED).select("key").collect()
            fresh = np.setdiff1d(np.array([row["key"] for row in worst], np.int64).view(U), late)
            if not len(fresh):
                break
            late = np.union1d(late, fresh)
            keys = members.sparkSession.createDataFrame(
                [(key,) for key in fresh.view(np.int64).tolist()], "key long"
            )
            parts.append(members.join(keys, "key", "left_anti"))
            again = listed(members.join(keys, "key", "left_semi").select("rep").distinct())
            rows = self.rows.join(again, F.col("_id") == F.col("rep"), "left_semi")
            keyed = self.keyed_again(rows, None, late)
            if self.exact:
                keyed = keyed.union(self.keyed_again(rows, self.exact, late))
            members = stored(holders(stored(self.memberships(keyed)), reps))
        return reduce(DataFrame.union, [*parts, members]).distinct() if parts else members

    def bridges(self, members: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
        """Pairs between the largest component of each key and the key's other documents.

        A document meets one member of that component per key, another one in each, and the pair
        that differs least goes on for each document and component.
        """
        sizes = found.groupBy("component").agg(F.count("*").alias("_size"))
        placed = stored(
            with_component(members.select("key", "rep"), found)
            .join(sizes, "component", "left")
            .select("key", "rep", "component", F.coalesce("_size", F.lit(1)).alias("_size"))
        )
        lead = F.struct("_size", "component", F.xxhash64("key", "rep"))
        leaders = placed.groupBy("key").agg(
            F.max_by(F.struct("rep", "component"), lead).alias("_lead")
        )
        met = (
            placed.join(leaders, "key")
            .filter(F.col("component") != F.col("_lead.component"))
            .select(
                F.col("rep").alias("x"),
                F.col("_lead.component").alias("there"),
                F.least("rep", "_lead.rep").alias("a"),
                F.greatest("rep", "_lead.rep").alias("b"),
            )
            .distinct()
        )
        near = self.candidates(met.select("a", "b").distinct(), classes)
        best = F.min_by(F.struct("a", "b"), F.struct("share", "a", "b"))
        return (
            met.join(near, ["a", "b"]).groupBy("x", "there").agg(best.alias("p")).select("p.*")
        ).distinct()

    def enumerated(self, members: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
        """All pairs of one key and of different components that sizes and sketches allow.

        Of keys with the same members, told by two hashes of them, one is taken. One of each pair is
        outside the key's largest component: these meet all members. Both are dealt into blocks, and
        each block of the one meets each block of the other in a place of its own.
        """
        placed = with_component(members, found)
        mixed = stored(
            parted(placed)
            .filter(F.col("_out") > 0)
            .groupBy("_n", "_x", "_y")
            .agg(F.min_by(F.struct("key", "_lead", "_out"), "key").alias("_k"))
            .select(
                "_k.key", "_k._lead",
                F.ceil(F.col("_k._out") / F.lit(BLOCK)).cast("int").alias("_rows"),
                F.ceil(F.col("_n") / F.lit(BLOCK)).cast("int").alias("_blocks"),
            )
        )
        sized = placed.join(mixed, "key").join(classes.drop("f1", "f2", "sketch"), "rep")

        def half(rows: DataFrame, rep: str, own: str, n_own: str, other: str, n_other: str,
                 prefix: str) -> DataFrame:
            words = [F.col(b).alias(prefix + b) for b in BRIEFS]
            return rows.select(
                "key", F.pmod(F.xxhash64("rep"), F.col(n_own)).cast("int").alias(own),
                F.explode(F.sequence(F.lit(0), F.col(n_other) - 1)).alias(other),
                F.col("rep").alias(rep), F.col("component").alias(f"c_{rep}"),
                F.col("n").alias(f"n_{rep}"), "_lead", *words,
            )

        outside = sized.filter(F.col("component") != F.col("_lead"))
        pairs = half(outside, "x", "_i", "_rows", "_j", "_blocks", "l_").alias("l").join(
            half(sized, "y", "_j", "_blocks", "_i", "_rows", "r_").alias("r"),
            (F.col("l.key") == F.col("r.key"))
            & (F.col("l._i") == F.col("r._i"))
            & (F.col("l._j") == F.col("r._j"))
            & (F.col("c_x") != F.col("c_y"))
            & ((F.col("c_y") == F.col("r._lead")) | (F.col("x") < F.col("y")))
            & within(F.col("n_x"), F.col("n_y"), "l_", "r_", self.percent),
        )
        pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        left = stored(pairs.distinct())
        return self.sketched(left, classes).select("a", "b")

    def run(self) -> DataFrame:
        """id, n, class_id, component_id of each row."""
        profiles = stored(self.profiles())
        filled = profiles.filter(F.col("n") > 0)
        classes = stored(
            filled.groupBy("f1", "f2", "n").agg(
                F.min("id").alias("rep"),
                *[F.first(b).alias(b) for b in BRIEFS],
                F.first("sketch").alias("sketch"),
            )
        )
        placed = stored(
            profiles.join(classes.select("f1", "f2", "n", "rep"), ["f1", "f2", "n"], "left")
            .select("id", "n", F.coalesce("rep", "id").alias("rep"))
        )
        reps = placed.filter(F.col("n") > 0).select("id", "rep").distinct()
        keyed = profiles
        thin = filled.select(F.explode("thin").alias("level")).distinct().collect()
        if thin:  # at most one level for each power of two
            self.exact = frozenset(row["level"] for row in thin)
            keyed = keyed.unionByName(stored(self.profiles(self.exact)))
        keyed = self.dealt(keyed.select("id", "f1", "f2", "keys"), deal_keys)
        members = stored(self.memberships(keyed))

        # Each document is checked against the leader that seems nearest, from either side.
        led = (
            members.groupBy("id", "leader")
            .agg(F.lit(1).alias("_one"))
            .join(reps.withColumnRenamed("rep", "_a"), "id")
            .join(reps.select(F.col("id").alias("leader"), F.col("rep").alias("_b")), "leader")
            .filter(F.col("_a") != F.col("_b"))
            .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
            .distinct()
        )
        led = stored(self.candidates(led, classes))
        best = F.min_by(F.struct("a", "b"), F.struct("share", "a", "b"))
        by_a, by_b = (led.groupBy(c).agg(best.alias("p")).select("p.*") for c in ("a", "b"))
        links = stored(self.linked(stored(by_a.union(by_b).distinct())))
        # An id with several sets belongs to all their classes.
        shared = reps.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("_max"))
        shared = shared.filter(F.col("a") != F.col("_max")).select("id", "a")
        links = links.union(
            stored(reps.join(shared, "id").select("a", F.col("rep").alias("b")))
        )
        found = components(links)
        open_members, (n_open,) = stored_counting(self.open_members(members, reps, found))
        for step in [self.bridges] * BRIDGES + [self.enumerated]:
            if not n_open:
                break
            if step == self.enumerated:
                open_members = stored(self.uncrowded(open_members, reps, found))
            pairs, (n_pairs,) = stored_counting(step(open_members, classes, found))
            if not n_pairs:
                continue
            fresh, (n_fresh,) = stored_counting(self.linked(pairs))
            if n_fresh:
                links = links.union(fresh)
                found = components(links)
        return with_component(placed, found).select(
            "id", "n", F.col("rep").alias("class_id"), F.col("component").alias("component_id")
        )


def holders(members: DataFrame, reps: DataFrame) -> DataFrame:
    """key, rep: all documents of each key, leaders included, by their classes."""
    both = members.select("key", "id").union(members.select("key", F.col("leader").alias("id")))
    return both.join(reps, "id").select("key", "rep").distinct()


def with_component(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows with `rep` and the component it is in so far, its own if it has no link."""
    return rows.join(found.select("node", "component"), F.col("rep") == F.col("node"), "left").select(
        *rows.columns, F.coalesce("component", "rep").alias("component")
    )


def parted(placed: DataFrame) -> DataFrame:
    """key, _n, _x, _y, _lead, _out of rows (key, rep, component): its members, two hashes of them,
    the component of most of them, and the number of those outside it.
    """
    parts = placed.groupBy("key", "component").agg(
        F.count("*").alias("_c"),
        F.bit_xor(F.xxhash64("rep")).alias("_x"),
        F.bit_xor(F.xxhash64(F.lit(1), "rep")).alias("_y"),
    )
    most = F.max(F.struct("_c", "component"))
    return (
        parts.groupBy("key")
        .agg(F.sum("_c").alias("_n"), F.bit_xor("_x").alias("_x"), F.bit_xor("_y").alias("_y"),
             most.alias("_m"))
        .select("key", "_n", "_x", "_y", F.col("_m.component").alias("_lead"),
                (F.col("_n") - F.col("_m._c")).alias("_out"))
    )


def jaccard_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    percent: int = 80,
) -> DataFrame:
    """One row per document: `id_col`, `n_shingles`, `class_id`, `component_id`.

    Words are runs other than ASCII white space, with A-Z lower-cased; the set of a document is its
    distinct runs of `size` words, or its one run of all words if it has fewer. Two documents are
    linked if 100 * intersection >= `percent` * union (75 to 100). `class_id` is the smallest id of
    the same set, `component_id` the smallest id reached by links, itself included.

    Null or empty texts, or texts without words, have no shingles and no links. Rows that share an
    id are one document: each has a row in the result, and links of one hold for all. A row without
    an id has null for both ids of its result. Other columns are not read. Empty table: no rows.
    Sets are compared by 64-bit hashes of their shingles.
    """
    if not 75 <= percent <= 100:
        raise ValueError("percent must be 75 to 100")
    tune_arrow(docs.sparkSession, 500, 4)  # keys and sketches of a batch add to its texts
    rows = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    result = ParityJoin(rows.filter(F.col("_id").isNotNull()), size, percent)
    known = result.run()
    lone = ParityJoin(rows.filter(F.col("_id").isNull()), size, percent).profiles()
    nothing = F.lit(None).cast(result.id_type)
    return known.union(
        lone.select("id", "n", nothing.alias("class_id"), nothing.alias("component_id"))
    ).toDF(id_col, "n_shingles", "class_id", "component_id")
