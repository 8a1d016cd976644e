"""Joins that stay balanced when a few keys hold most rows.

A key is *hot* when it holds more than `share` of the rows and more than
`min_rows` rows.  At most 1/share keys can be hot, which bounds the list and
everything keyed by it, so only such bounded frames are ever broadcast by hint.
All other joins leave the choice to Spark, which looks at sizes at run time.

The list of hot keys is stored before it is used.  Usually it is empty, and then
the plain join is all there is to plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adperf.sources.staging import stage

HOT_SHARE = 1e-4
HOT_MIN_ROWS = 1_000_000


def _above(rows: Column, total: Column, share: float, min_rows: int) -> Column:
    return (rows > F.lit(min_rows)) & (rows > total * F.lit(share))


def hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    share: float = HOT_SHARE,
    min_rows: int = HOT_MIN_ROWS,
) -> DataFrame:
    """Stored list of the keys holding more than `share` of the rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return stage(
        counts.filter(_above(F.col("_rows"), total, share, min_rows)).select(*keys), "hot"
    )


def hot_groups(
    counts: DataFrame,
    keys: Sequence[str],
    weight: str,
    share: float = HOT_SHARE,
    min_rows: int = HOT_MIN_ROWS,
) -> DataFrame:
    """The same from stored rows per key, without another look at the rows."""
    total = counts.agg(F.sum(weight)).scalar()
    return counts.filter(_above(F.col(weight), total, share, min_rows)).select(*keys)


def _listed(hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    return F.broadcast(hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys]))


def _match(
    left: DataFrame, left_names: Sequence[str], right: DataFrame, right_names, nulls: bool = True
) -> Column:
    """Equality on all keys; with `nulls` null keys are equal."""
    pairs = [(left[x], right[y]) for x, y in zip(left_names, right_names)]
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) if nulls else x == y for x, y in pairs])


def split_hot(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a hot key, all other rows)."""
    listed = _listed(hot, keys)
    on = _match(df, keys, listed, [f"_hot_{k}" for k in keys])
    return df.join(listed, on, "left_semi"), df.join(listed, on, "left_anti")


def attach_by_key(
    df: DataFrame,
    side: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    hot: DataFrame | None = None,
    covers_all: bool = False,
    **limits,
) -> DataFrame:
    """Join `side`, which has one row per key, onto `df`.

    Rows with a hot key meet the few side rows of hot keys by broadcast and are
    not shuffled; the remaining rows have no large key left and are joined
    normally.  `how` is `left`, where null keys match null keys, or `inner`, where
    they match nothing and tables bucketed by the key need no shuffle.  `hot` is
    a stored list of the hot keys, counted here if not given; `covers_all` says
    that it names every key, so that no other rows exist.
    """
    keys = list(keys)
    side_keys = [f"_side_{k}" for k in keys]
    hot = hot_keys(df, keys, **limits) if hot is None else hot
    side = side.select(
        *[F.col(k).alias(s) for k, s in zip(keys, side_keys)],
        *[F.col(c) for c in side.columns if c not in keys],
    )

    def joined(rows: DataFrame, other: DataFrame) -> DataFrame:
        on = _match(rows, keys, other, side_keys, nulls=how == "left")
        return rows.join(other, on, how).drop(*side_keys)

    if hot.isEmpty():
        return joined(df, side)
    listed = _listed(hot, keys)
    hot_side = F.broadcast(
        side.join(listed, _match(side, side_keys, listed, [f"_hot_{k}" for k in keys]), "left_semi")
    )
    if covers_all:
        return joined(df, hot_side)
    hot_rows, other_rows = split_hot(df, hot, keys)
    return joined(hot_rows, hot_side).unionByName(joined(other_rows, side))


def attach_stats(
    df: DataFrame, keys: Sequence[str], aggs: Sequence[Column], **limits
) -> DataFrame:
    """Aggregates of `df` per key, joined back onto its rows.

    The aggregate is stored once with the rows per key, which also tells the hot
    keys and whether there are any others.
    """
    keys = list(keys)
    stats = stage(df.groupBy(*keys).agg(*aggs, F.count(F.lit(1)).alias("_rows")), "stats")
    hot = hot_groups(stats, keys, "_rows", **limits)
    others = split_hot(stats, hot, keys)[1]
    return attach_by_key(
        df, stats.drop("_rows"), keys, "left", hot=hot, covers_all=others.isEmpty()
    )
