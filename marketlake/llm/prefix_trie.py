"""A trie of the prefixes of conversations, with totals of its subtrees, by a rollup in depth bands.

A node is a distinct sequence of first turns. It is named by 128 bits: the XOR of a hash of each
turn with its place, so names come from running sums and no sequence is put together anywhere.

The rollup. Depths are cut into bands of fixed height. A node adds its own figures to itself and its
ancestors within its band only, so a row explodes to one band at most, however deep it lies. What is
below reaches a band by its roots' completed totals, which are added to the node above each root.
Band roots are themselves nodes of a coarser trie, banded in the same way; so the rounds are as many
as the digits of the largest depth to the base of the height, not as many as there are bands.

Scale: turns are numbered from a range exchange over (conversation, order), so a conversation that
holds a third of all turns lies in many tasks; running sums over a conversation go in two levels of
blocks. What many nodes share (the root, a common first turn) arrives as partial sums of each task;
parents with many children are looked up from a broadcast of at most `HEAVIEST` rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import HEAVIEST, heavy_lookup, stored, text_or_empty, words

__all__ = ["BAND", "HEAVIEST", "Dealt", "PrefixTrie", "deal_turns", "digested", "prefix_trie"]

# Height of a band: a row explodes to so many ancestors at most.
BAND = 16
# Places of a conversation that one task puts in order; a multiple of the height.
BLOCK = 4096


def digested(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """conv_id, turn, h1, h2, n_words of each turn: a hash of role and text in place of them.

    Null role or text count as empty. Rows without a conversation are left out.
    """
    content = (text_or_empty(f"`{role_col}`"), text_or_empty(f"`{text_col}`"))
    return turns.select(
        F.col(f"`{conv_col}`").alias("conv_id"),
        F.col(f"`{turn_col}`").alias("turn"),
        F.xxhash64(F.lit(1), *content).alias("h1"),
        F.xxhash64(F.lit(2), *content).alias("h2"),
        F.size(words(content[1])).cast("bigint").alias("n_words"),
    ).filter(F.col("conv_id").isNotNull())


@dataclass(frozen=True)
class Dealt:
    """Turns in their order over range partitions (`_part`), and how many of a conversation each
    partition has."""

    turns: DataFrame
    parts: DataFrame

    def counts(self) -> DataFrame:
        """conv_id, n: the turns of each conversation."""
        return self.parts.groupBy("conv_id").agg(F.sum("_rows").alias("n"))

    def placed(self, about: DataFrame | None = None) -> DataFrame:
        """The turns with `place`, from 1 within each conversation, and the columns of `about`.

        `about` has one row for each conv_id. It meets the partitions of a conversation, not its
        turns, so a long conversation does not gather in one task.
        """
        earlier = (
            Window.partitionBy("conv_id")
            .orderBy("_part")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        before = self.parts.select(
            "conv_id", "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
        )
        if about is not None:
            before = before.join(about, "conv_id")
        inner = Window.partitionBy("conv_id", "_part").orderBy("turn", "h1", "h2", "_nth")
        return (
            self.turns.withColumn("_within", F.row_number().over(inner))
            .join(before, ["conv_id", "_part"])
            .withColumn("place", F.col("_before") + F.col("_within"))
            .drop("_part", "_nth", "_within", "_before", "turn")
        )


def deal_turns(turns: DataFrame) -> Dealt:
    """`turns` (conv_id, turn, h1, h2, ...) in the order of turn, nulls first, then of the hashes."""
    rows = turns.withColumn("_nth", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange("conv_id", "turn", "h1", "h2", "_nth")
    dealt = stored(ordered.withColumn("_part", F.spark_partition_id()))
    parts = dealt.groupBy("conv_id", "_part").agg(F.count("*").alias("_rows"))
    return Dealt(dealt, stored(parts))


def keyed_rows(turns: DataFrame, members: DataFrame) -> DataFrame:
    """conv_id, place, key, n_words: each conversation's prefixes, with the root at place 0."""
    block = F.floor(F.col("place") / BLOCK)
    marked = turns.select(
        "conv_id",
        F.col("place").cast("bigint").alias("place"),
        "n_words",
        F.xxhash64(F.lit(1), "place", "h1", "h2").alias("_z1"),
        F.xxhash64(F.lit(2), "place", "h1", "h2").alias("_z2"),
        block.alias("_block"),
    )
    zero = F.lit(0).cast("bigint")
    roots = members.select(
        "conv_id", zero.alias("place"), zero.alias("n_words"), zero.alias("_z1"),
        zero.alias("_z2"), zero.alias("_block"),
    )
    sums = marked.groupBy("conv_id", "_block").agg(
        F.bit_xor("_z1").alias("_z1"), F.bit_xor("_z2").alias("_z2")
    )
    so_far = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = sums.select(
        "conv_id", "_block",
        F.bit_xor("_z1").over(so_far).alias("_b1"), F.bit_xor("_z2").over(so_far).alias("_b2"),
    ).filter("_block > 0")
    inner = Window.partitionBy("conv_id", "_block").orderBy("place").rowsBetween(
        Window.unboundedPreceding, 0
    )

    def name(z: str, b: str) -> Column:
        return F.bit_xor(z).over(inner).bitwiseXOR(F.coalesce(b, zero)).alias(z)

    return (
        marked.union(roots.select(marked.columns))
        .join(before, ["conv_id", "_block"], "left")
        .select("conv_id", "place", F.struct(name("_z1", "_b1"), name("_z2", "_b2")).alias("key"),
                "n_words")
    )


def banded(keyed: DataFrame, level: int) -> DataFrame:
    """key, conv_id, path, up, n_convs, depth, n_words of the nodes at multiples of BAND ** level.

    `path`: the keys from the root of the node's band down to the node; `up`: the node above it,
    both in steps of that level. `conv_id` is the smallest member.
    """
    unit = BAND**level
    steps = keyed.filter(F.col("place") % unit == 0).select(
        "*", (F.col("place") / unit).cast("bigint").alias("_step")
    )
    steps = steps.withColumn("_block", F.floor(F.col("_step") / BLOCK))
    # The last step of a block is seen from the next one.
    seam = steps.filter(F.col("_step") % BLOCK == BLOCK - 1)
    both = steps.withColumn("_own", F.lit(True)).union(
        seam.withColumn("_block", F.col("_block") + 1).withColumn("_own", F.lit(False))
    )
    order = Window.partitionBy("conv_id", "_block").orderBy("_step")
    seen = F.collect_list("key").over(order.rowsBetween(1 - BAND, 0))
    inside = (F.col("_step") % BAND + 1).cast("int")
    pathed = both.select(
        "*", seen.alias("_seen"), F.lag("key").over(order).alias("up")
    ).filter("_own")
    placed = pathed.select(
        "key", "conv_id", "place", "n_words",
        F.struct(F.slice("_seen", F.size("_seen") - inside + 1, inside).alias("path"), "up").alias(
            "_where"
        ),
    )
    return (
        placed.groupBy("key")
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.min_by("_where", "conv_id").alias("_where"),
            F.count("*").alias("n_convs"),
            F.max("place").alias("depth"),
            F.max("n_words").alias("n_words"),
        )
        .select("key", "conv_id", "_where.path", "_where.up", "n_convs", "depth", "n_words")
    )


def subtree_sums(levels: list[DataFrame], own: DataFrame, names: list[str]) -> DataFrame:
    """key and, for each of `names`, the sum of `own` over the subtree of every node.

    `levels` are the nodes of `banded`, finest first; the last has one band.
    """
    values = [own]
    for nodes in levels[:-1]:
        sums = nodes.join(values[-1], "key").groupBy(F.col("path")[0].alias("key"))
        values.append(stored(sums.agg(*[F.sum(c).alias(c) for c in names])))
    complete = None
    for nodes, value in zip(reversed(levels), reversed(values)):
        spread = nodes.select("key", "path").join(value, "key")
        if complete is not None:
            below = (
                nodes.select("key", "up")
                .join(complete, "key")
                .filter(F.col("up").isNotNull())
                .groupBy(F.col("up").alias("key"))
                .agg(*[F.sum(c).alias(f"_{c}") for c in names])
            )
            spread = spread.join(below, "key", "left").select(
                "path", *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in names]
            )
        exploded = spread.select(F.explode("path").alias("key"), *names)
        complete = stored(exploded.groupBy("key").agg(*[F.sum(c).alias(c) for c in names]))
    return complete


@dataclass(frozen=True)
class PrefixTrie:
    """`nodes`: key, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens.
    `ends`: key, conv_id of the conversations that end at a node."""

    nodes: DataFrame
    ends: DataFrame


def prefix_trie(turns: DataFrame, members: DataFrame) -> PrefixTrie:
    """The trie of conversations given as turns (conv_id, place, h1, h2, n_words).

    `members` has every conv_id once, those without turns too; places run from 1 without gaps. A
    node has its smallest member, its depth, the smallest member of its parent (null at the root),
    its numbers of members, children and leaves below it (itself, if it has no child), and the
    tokens that all but one member of each node of its subtree would save: (members - 1) * words of
    the node's last turn, summed.

    Repeated turns are turns of their own. Empty table: no rows, no root either. Nodes are told
    apart by 128 bits of hashes.
    """
    keyed = stored(keyed_rows(turns, members))
    deepest = keyed.agg(F.max("place").alias("d")).head()["d"] or 0
    levels = [stored(banded(keyed, 0))]
    while deepest // BAND ** (len(levels) - 1) >= BAND:
        levels.append(stored(banded(keyed, len(levels))))
    nodes = levels[0]

    children = (
        nodes.filter(F.col("up").isNotNull())
        .groupBy(F.col("up").alias("key"))
        .agg(F.count("*").alias("n_children"))
    )
    described = stored(
        nodes.join(children, "key", "left").select(
            "key", "conv_id", "up", "depth", "n_convs", "n_words",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
        )
    )
    own = described.select(
        "key",
        (F.col("n_children") == 0).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_words")).alias("saved_tokens"),
    )
    sums = subtree_sums(levels, own, ["n_leaves", "saved_tokens"])
    parents = described.filter("n_children > 0").select(
        F.col("key").alias("up"), F.col("conv_id").alias("parent_conv_id"), "n_children"
    )
    tree = heavy_lookup(described, parents, ["up"], "n_children", ["parent_conv_id"])
    ends = keyed.groupBy("conv_id").agg(F.max_by("key", "place").alias("key"))
    return PrefixTrie(
        tree.join(sums, "key").select(
            "key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
            "saved_tokens",
        ),
        ends.select("key", "conv_id"),
    )
