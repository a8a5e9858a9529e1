"""Validity-interval history (SCD2) of a slowly changing dimension."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.operators.dedupe import first_by
from marketlake.operators.periods import lead_by_chunk, running_max_by_chunk


def scd2_from_log(
    log: DataFrame,
    *,
    key: str,
    updated_at: str,
    order: list[Column],
    chunk: Column,
    floor: DataFrame | None = None,
    cut: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """All versions in a landing log, with `valid_from` and `valid_to` (NULL = open).

    A row is a new version iff its `updated_at` exceeds every one seen earlier for its
    key, in `order`; the first landing of an `updated_at` wins. `chunk` is any column
    non-decreasing in `order` (say the ingest day): it cuts a key's log into pieces, so
    that no task ever holds a whole key. `floor` (key, floor) gives a key's newest
    version so far: only later ones count. The versions are read by two branches: `cut`,
    such as `session.stored`, computes them once.
    """
    cut = cut or (lambda df: df)
    present = F.col(updated_at).isNotNull() & F.col(key).isNotNull()
    rows = log.filter(present).withColumn("_chunk", chunk)
    # Re-lands of an unchanged record collapse before the shuffle.
    firsts = first_by(rows, [key, updated_at], order)
    if floor is not None:
        firsts = (
            # Merged: a key for each open version is too much to broadcast, however short its row.
            firsts.join(floor.hint("merge"), key, "left")
            .filter(F.col("floor").isNull() | (F.col(updated_at) > F.col("floor")))
            .drop("floor")
        )
    seen = running_max_by_chunk(
        firsts, [key], "_chunk", order, updated_at, "_seen", condense=rows
    )
    versions = (
        seen.filter(F.col("_seen").isNull() | (F.col(updated_at) > F.col("_seen")))
        .withColumn("valid_from", F.col(updated_at))
        .drop("_seen")
    )
    # Versions rise in both log order and `updated_at`, so the log's chunks serve again.
    closed = lead_by_chunk(cut(versions), [key], "_chunk", "valid_from", "valid_to")
    return closed.drop("_chunk")


def scd2_apply(
    history: DataFrame,
    batch: DataFrame,
    *,
    key: str,
    updated_at: str,
    order: list[Column],
    chunk: Column,
    cut: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """`history` after one more batch of landings: open rows closed, new versions added."""
    floor = history.filter(F.col("valid_to").isNull()).select(
        key, F.col("valid_from").alias("floor")
    )
    added = scd2_from_log(
        batch, key=key, updated_at=updated_at, order=order, chunk=chunk, floor=floor, cut=cut
    ).select(*history.columns)
    closing = added.groupBy(key).agg(F.min("valid_from").alias("_closed_at"))
    closed = (
        history.join(closing.hint("merge"), key, "left")
        .withColumn("valid_to", F.coalesce("valid_to", "_closed_at"))
        .select(*history.columns)
    )
    return closed.unionByName(added)


def seen_at_builds(
    log: DataFrame, *, key: str, landed_at: str, order: list[Column], builds: Sequence[datetime]
) -> DataFrame:
    """The log as a snapshot job run only at `builds` would see it: the last landing per
    key before each build. `order` sorts newest first."""
    times = F.array(*[F.lit(b) for b in sorted(builds)])
    build = F.array_min(F.filter(times, lambda b: b >= F.col(landed_at)))
    rows = log.withColumn("_build", build).filter(F.col("_build").isNotNull())
    return first_by(rows, [key, "_build"], order).drop("_build")


def current(history: DataFrame) -> DataFrame:
    return history.filter(F.col("valid_to").isNull())


def as_of(history: DataFrame, moment: Column) -> DataFrame:
    """State at a moment; `valid_from` inclusive, `valid_to` exclusive."""
    return history.filter(
        (F.col("valid_from") <= moment)
        & (F.col("valid_to").isNull() | (F.col("valid_to") > moment))
    )
