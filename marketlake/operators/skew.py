"""Joins that stay balanced when one key holds much of the big side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    spread: list[str],
    how: str = "inner",
    salts: int = 32,
) -> DataFrame:
    """Join `big` to `small` with each key of `big` spread over `salts` tasks.

    The salt is a hash of the `spread` columns, so a retried task assigns it again
    alike. `small` has one narrow row per key and is repeated per salt. Left-row
    preserving joins only (inner, left, left_semi, left_anti).
    """
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    copies = copies.withColumn("_salt", F.col("_salt").cast("bigint"))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")
