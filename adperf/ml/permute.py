"""Permutations of rows by number, without a shuffle of their own.

A row's place after the permutation is a function of its number: a Feistel network over
the cells of a grid that is hardly larger than the rows.  Each half step adds a hash of
one coordinate to the other, so it can be undone, and the whole is one to one; numbers
that fall beyond the rows walk on until they are within.  Values are then exchanged by
one join on the number.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adperf.operators.windows import row_numbers
from adperf.sources.staging import stage

HALF_STEPS = 8


def place(number: Column, n: int, *salt: Column) -> Column:
    """Where row `number` of n goes, in a permutation drawn from the salt."""
    width = max(1, math.isqrt(max(0, n - 1)) + 1)
    height = -(-n // width)

    def half(s: Column, k: Column) -> Column:
        left = F.when(k % 2 == 0, F.pmod(s["l"] + F.pmod(F.xxhash64(s["r"], k, *salt), F.lit(width)), F.lit(width))).otherwise(s["l"])
        right = F.when(k % 2 == 1, F.pmod(s["r"] + F.pmod(F.xxhash64(s["l"], k, *salt), F.lit(height)), F.lit(height))).otherwise(s["r"])
        return F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def once(x: Column) -> Column:
        start = F.struct((x % width).cast("long").alias("l"), F.floor(x / width).cast("long").alias("r"))
        return F.aggregate(
            F.sequence(F.lit(0), F.lit(HALF_STEPS - 1)), start, half, lambda s: s["r"] * width + s["l"])

    # beyond the rows lie fewer than `width` numbers, and a walk meets each of them once
    walks = F.sequence(F.lit(0), F.lit(min(width * height - n, 64)))
    return F.aggregate(walks, number.cast("long"), lambda x, t: F.when((t > 0) & (x < n), x).otherwise(once(x)))


def exchanged(df: DataFrame, key: str, columns: Sequence[str], repeats: int) -> DataFrame:
    """All rows once as they are (`trial.column` empty) and once for each column and repeat with its values exchanged.

    In every trial a column's values are those of the rows, in another order.
    """
    rows = stage(row_numbers(df, F.asc(key), into="_i"), "numbered")
    n = rows.count()
    trials = F.array(
        F.struct(F.lit("").alias("column"), F.lit(0).alias("repeat")),
        *[F.struct(F.lit(c).alias("column"), F.lit(r).alias("repeat")) for c in columns for r in range(repeats)])
    copies = rows.withColumn("trial", F.explode(trials))
    moved = place(F.col("_i"), n, F.col("trial.column"), F.col("trial.repeat"))
    copies = copies.withColumn("_j", F.when(F.col("trial.column") == "", F.col("_i")).otherwise(moved))
    donors = rows.select(F.col("_i").alias("_j"), *[F.col(c).alias(f"_from_{c}") for c in columns])
    met = copies.join(donors, "_j")
    return met.withColumns({
        c: F.when(F.col("trial.column") == c, F.col(f"_from_{c}")).otherwise(F.col(c)) for c in columns
    }).drop("_i", "_j", *[f"_from_{c}" for c in columns])
