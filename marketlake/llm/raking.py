"""Mixing sources to target weights by iterative proportional fitting, in DataFrame operations only.

Token weights of the cells (one for each combination of source, language and topic) are raked:
multiplied so that the totals by source meet their targets, then by language, then by topic, and
again until all hold. A document is then taken as often as its cell's factor gives, in whole
copies and a draw by a hash of its id, so that the expected tokens of the sample have the target
shares. How much is taken does not hang on the rarest cells: see `scale_of`.

Scale: the documents are read twice, once for the cell totals (map-side partials) and once for the
draw. The rounds work on the cells alone, as tables joined and summed by Spark: what a step writes
is one factor for each category of a margin. Only the largest error of a step comes to the driver.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from marketlake.llm.common import pack, stored, text_or_empty, unpack, words

NONE = "(none)"


def register_of(text: Column) -> Column:
    """A coarse topic from the form of a text: table, marked, list, note, article or long."""
    n = F.greatest(F.size(words(text)), F.lit(1))
    lines = F.greatest(F.size(F.split(text, "\n")), F.lit(1))

    def share(chars: str) -> Column:
        return (F.length(text) - F.length(F.translate(text, chars, ""))) / n

    return (
        F.when(share("|") >= 0.2, "table")
        .when(share("#$%&*<>{}=") >= 0.2, "marked")
        .when(n < 50, "note")
        .when(n / lines < 12, "list")
        .when(n < 1000, "article")
        .otherwise("long")
    )


@dataclass(frozen=True)
class Targets:
    """Target shares of tokens: for each margin, the exponent that tempers the corpus' own shares,
    and shares stated outright, which come before the tempered ones.

    A category's share is stated, or its tokens to the power of the exponent; what the stated ones
    leave of 1 goes to the others in proportion. 1 keeps the corpus' shares, 0 makes them equal.
    """

    exponents: dict[str, float] = field(
        default_factory=lambda: {"source": 0.7, "lang": 0.8, "topic": 0.9}
    )
    stated: dict[str, dict[str, float]] = field(default_factory=dict)

    def shares(self, cells: DataFrame, margin: str) -> DataFrame:
        """(category, target) of one margin; the targets of categories with tokens sum to 1."""
        totals = (
            cells.groupBy(F.col(margin).alias("category"))
            .agg(F.sum("tokens").alias("tokens"))
            .filter(F.col("tokens") > 0)
        )
        fixed = self.stated.get(margin, {})
        stated = F.lit(None).cast("double")
        for category, share in fixed.items():
            stated = F.when(F.col("category") == category, F.lit(float(share))).otherwise(stated)
        free = F.when(stated.isNull(), F.pow("tokens", F.lit(self.exponents.get(margin, 1.0))))
        marked = totals.select("category", stated.alias("_stated"), free.alias("_free"))
        sums = marked.agg(
            F.coalesce(F.sum("_stated"), F.lit(0.0)).alias("_fixed"),
            F.coalesce(F.sum("_free"), F.lit(0.0)).alias("_all_free"),
        )
        # One row of sums, joined to every category.
        joined = marked.withColumn("_k", F.lit(0)).join(sums.withColumn("_k", F.lit(0)), "_k")
        rest = F.greatest(F.lit(0.0), 1 - F.col("_fixed"))
        share = F.when(
            F.col("_stated").isNotNull(),
            F.col("_stated") / F.when(F.col("_all_free") > 0, F.greatest("_fixed", F.lit(1.0)))
            .otherwise(F.col("_fixed")),
        ).otherwise(rest * F.col("_free") / F.col("_all_free"))
        return joined.select("category", share.alias("target"))


class MarginsNotMet(UserWarning):
    """Raking ended above its tolerance. `error` is the largest error left, `margins` the largest of
    each margin."""

    def __init__(self, error: float, margins: dict[str, float], rounds: int):
        self.error, self.margins, self.rounds = error, margins, rounds
        left = ", ".join(f"{m} {e:.3g}" for m, e in margins.items())
        super().__init__(f"error {error:.3g} left after {rounds} rounds of raking; by margin: {left}")


# Raking ends when the error has not fallen by a hundredth in so many rounds.
PATIENCE = 10


def updated(cells: DataFrame, factors: dict[str, DataFrame], margin: str) -> DataFrame:
    """The factors of one margin, so that its sums meet the targets under the others' factors.

    `_error` is how far the sums were from the targets before.
    """
    weighted, share = cells, F.col("share")
    for other, table in factors.items():
        if other != margin:
            there = table.select(F.col("category").alias("_c"), F.col("factor").alias(f"_f_{other}"))
            weighted = weighted.join(there, F.col(other) == F.col("_c")).drop("_c")
            share = share * F.col(f"_f_{other}")
    sums = weighted.groupBy(F.col(margin).alias("category")).agg(F.sum(share).alias("_sum"))
    return sums.join(factors[margin], "category").select(
        "category",
        "target",
        F.when(F.col("_sum") > 0, F.col("target") / F.col("_sum")).otherwise(0.0).alias("factor"),
        F.abs(F.col("target") - F.col("_sum") * F.col("factor")).alias("_error"),
    )


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int, tolerance: float):
    """(`cells` with `share`, largest error left): shares that meet all margins.

    `cells` has the margins and `tokens`. What changes is one factor for each category: a round
    fits the factors of margin after margin, each from one pass over the cells. Margins that no
    weights can meet together end when the error falls no further, or at the last round, as near as
    it came, with the warning `MarginsNotMet`.
    """
    total = cells.agg(F.sum("tokens").alias("_total")).withColumn("_k", F.lit(0))
    base = stored(
        cells.withColumn("_k", F.lit(0))
        .join(total, "_k")
        .select(*cells.columns, (F.col("tokens") / F.col("_total")).alias("share"))
        .filter(F.col("tokens") > 0)
    )
    factors = {
        m: stored(t.select("category", "target", F.lit(1.0).alias("factor")))
        for m, t in targets.items()
    }
    seen: list[float] = []
    left: dict[str, float] = {}
    for _ in range(rounds):
        for margin in factors:
            # The error is observed while the factors are written.
            told = Observation()
            fitted = updated(base, factors, margin).observe(told, F.max("_error").alias("error"))
            factors[margin] = stored(fitted).drop("_error")
            left[margin] = told.get.get("error") or 0.0
        seen.append(max(left.values(), default=0.0))
        if seen[-1] <= tolerance:
            break
        if len(seen) > PATIENCE and min(seen[-PATIENCE:]) > 0.99 * min(seen[:-PATIENCE]):
            break
    error = seen[-1] if seen else 0.0
    if error > tolerance:
        warnings.warn(MarginsNotMet(error, left, len(seen)), stacklevel=2)
    raked, share = base, F.col("share")
    for margin, table in factors.items():
        there = table.select(F.col("category").alias("_c"), F.col("factor").alias(f"_f_{margin}"))
        raked = raked.join(there, F.col(margin) == F.col("_c")).drop("_c")
        share = share * F.col(f"_f_{margin}")
    return raked.select(*cells.columns, share.alias("share")), error


# Buckets of weights for each doubling.
FINENESS = 64


def scale_of(weights: DataFrame, rate: float, rare: float) -> DataFrame:
    """One row, `_scale`: the weight of which a document is taken once.

    It is the largest weight, but for the heaviest cells that hold no more than `rare` of the target
    tokens together, and 1 / `rate` at most. `weights` has `share` and `weight`, one row a cell.
    """
    buckets = weights.groupBy(F.floor(F.log2("weight") * FINENESS).alias("_bucket")).agg(
        F.sum("share").alias("_mass"), F.max("weight").alias("_top")
    )
    heavier = Window.orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    above = buckets.withColumn("_above", F.coalesce(F.sum("_mass").over(heavier), F.lit(0.0)))
    return above.filter(F.col("_above") <= rare).agg(
        F.least(F.min("_top"), F.lit(1.0 / rate)).alias("_scale")
    )


def mix_sources(
    docs: DataFrame,
    targets: Targets = Targets(),
    topic: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    rounds: int = 500,
    tolerance: float = 1e-9,
    seed: int = 7,
    rate: float = 0.4,
    rare: float = 1e-4,
) -> DataFrame:
    """`docs` with `topic`, `n_tokens` (words), `weight`, `probability`, `sampled` and `copies`.

    `weight` is the raked share of tokens over the corpus' own, of the document's cell. Divided by
    the scale, to 9 decimals, it is the number of copies to expect; `probability` is that number, 1
    at most. `copies` is its whole part, and one more if a hash of the id and `seed`, as a number
    below 1, is below the rest. `sampled`: there is a copy. With every row taken `copies` times,
    each cell is expected to have its target share. `topic` is an expression over the text column
    (default `register_of`).

    `rate` is the least share of the corpus' tokens that the sample is expected to hold. It holds
    more as long as only cells with `rare` of the target tokens need more than one copy. So a tiny
    source gets repeats and takes nothing from the others.

    Targets that are not met to the `tolerance` when raking makes no further progress, or after
    `rounds`, are told by the warning `MarginsNotMet`, which holds the error of each margin.

    A null source, language or topic is a category of its own, "(none)". A document without words
    has weight and probability 0 if its cell has no tokens, else those of its cell. Rows that share
    an id are drawn alike within a cell. Other columns pass through; a column named like a result
    is replaced. Empty table: no rows.
    """
    text = text_or_empty(text_col)
    described = docs.select(
        pack(docs),
        F.col(f"`{id_col}`").alias("_id"),
        F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit(NONE)).alias("source"),
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NONE)).alias("lang"),
        F.coalesce(register_of(text) if topic is None else topic, F.lit(NONE)).alias("topic"),
        F.size(words(text)).cast("bigint").alias("tokens"),
    )
    margins = ["source", "lang", "topic"]
    cells = stored(described.groupBy(*margins).agg(F.sum("tokens").alias("tokens")))
    total = cells.agg(F.sum("tokens").alias("_total")).withColumn("_k", F.lit(0))
    raked, _ = rake(cells, {m: targets.shares(cells, m) for m in margins}, rounds, tolerance)
    weights = (
        raked.withColumn("_k", F.lit(0))
        .join(total, "_k")
        .withColumn("weight", F.col("share") * F.col("_total") / F.col("tokens"))
    )
    weights = stored(weights)
    scale = scale_of(weights, rate, rare).withColumn("_k", F.lit(0))
    chances = stored(
        weights.join(scale, "_k").select(
            *[F.col(m).alias(f"_{m}") for m in margins],
            "weight",
            F.round(F.col("weight") / F.col("_scale"), 9).alias("expected"),
        )
    )
    joined = described.join(
        chances, [F.col(m) == F.col(f"_{m}") for m in margins], "left"
    ).select(
        "_row", "_id", "topic", "tokens",
        F.coalesce("weight", F.lit(0.0)).alias("weight"),
        F.coalesce("expected", F.lit(0.0)).alias("expected"),
    )
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("_id")), F.lit(1 << 53)) / F.lit(float(1 << 53))
    whole = F.floor("expected")
    copies = whole + (draw < F.col("expected") - whole).cast("bigint")
    return unpack(
        joined,
        docs.columns,
        topic=F.col("topic"),
        n_tokens=F.col("tokens"),
        weight=F.col("weight"),
        probability=F.least(F.col("expected"), F.lit(1.0)),
        sampled=copies > 0,
        copies=copies,
    )
