"""Windowed operators: group statistics on rows, latest row, top-k, sessions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adperf.functions import fixed
from adperf.operators import spread
from adperf.sources.staging import stage


def group_stats_onto_rows(
    df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column], **hot
) -> DataFrame:
    """Aggregates of each row's group as extra columns.

    Aggregated first (partial sums before the shuffle), then joined back, so a
    group of any size is never gathered in one task as a window would do.
    """
    return spread.attach_stats(df, keys, [agg.alias(name) for name, agg in aggs.items()], **hot)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]
) -> DataFrame:
    """The first row of each key by `order_by`."""
    return top_per_group(df, keys, order_by, 1).drop("rank")


def top_per_group(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], k: int
) -> DataFrame:
    """The first k rows of each key, numbered in `rank`.

    Spark cuts each key to k rows before the shuffle (window group limit).
    """
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def top_k(df: DataFrame, order_by: Sequence[Column], k: int) -> DataFrame:
    """The first k rows overall (take-ordered, no full sort)."""
    return df.orderBy(*order_by).limit(k)


def fill_from_group(
    df: DataFrame,
    group: str,
    col: str,
    default: object,
    into: str | None = None,
    resolve_conflicts: bool = False,
    **limits,
) -> DataFrame:
    """Fill nulls of `col` with the group's most frequent value, else `default`.

    The smallest value wins ties.  Values are counted per group first; only the
    rows to be filled take part in the join, the others pass straight through.
    `resolve_conflicts` replaces every value by the group's.
    """
    into = into or col
    counted = stage(df.groupBy(group, col).agg(F.count(F.lit(1)).alias("_n")), "values")
    known = F.col(col).isNotNull()
    typical = (
        counted.filter(known)
        .groupBy(group)
        .agg(F.min_by(F.col(col), F.struct(-F.col("_n"), F.col(col))).alias("_typical"))
    )
    wanted = df if resolve_conflicts else df.filter(~known)
    rows = counted if resolve_conflicts else counted.filter(~known)
    per_group = rows.groupBy(group).agg(F.sum("_n").alias("_n"))
    hot = spread.hot_groups(per_group, [group], "_n", **limits)
    filled = (
        spread.attach_by_key(wanted, typical, [group], "left", hot=hot)
        .withColumn(into, F.coalesce("_typical", F.lit(default)))
        .drop("_typical")
    )
    if resolve_conflicts:
        return filled
    return df.filter(known).withColumn(into, F.col(col)).unionByName(filled)


def share_of_group(df: DataFrame, keys: Sequence[str], value: str, into: str) -> DataFrame:
    """value / group total, on an already aggregated frame."""
    totals = df.groupBy(*[F.col(k).alias(f"_t_{k}") for k in keys]).agg(F.sum(value).alias("_total"))
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys])
    return df.join(totals, on).select(*df.columns, (F.col(value) / F.col("_total")).alias(into))


# ---- gaps and sessions ----------------------------------------------------------


def sessionize(
    df: DataFrame,
    user: str,
    ts: str,
    tiebreak: Sequence[str] = (),
    gap_seconds: int = fixed.SESSION_GAP_SECONDS,
    compat: bool = False,
    slices: int | None = None,
    **hot,
) -> DataFrame:
    """Add `time_since_last_action` (seconds) and `session_id` per user.

    A session ends after `gap_seconds` without an event; ids count from 0.
    With `compat` the id is kept only on the row that opens a new session and
    is 0 elsewhere.

    Ordinary users are one window partition each.  A hot user is cut into ranges
    of about equal rows: gaps and session starts are counted inside a range, and a
    summary with one row per range carries the last timestamp and the count forward.
    Both ways give the same result.
    """
    hot_list = spread.hot_keys(df, [user], **hot)
    if hot_list.isEmpty():
        result = _sessions_by_user(df, user, ts, tiebreak, gap_seconds)
    else:
        hot_rows, other_rows = spread.split_hot(df, hot_list, [user])
        result = _sessions_by_user(other_rows, user, ts, tiebreak, gap_seconds).unionByName(
            _sessions_by_range(hot_rows, user, ts, tiebreak, gap_seconds, slices)
        )
    if compat:
        opened = F.col("time_since_last_action") > gap_seconds
        result = result.withColumn(
            "session_id", F.when(opened, F.col("session_id")).otherwise(F.lit(0))
        )
    return result


def _sessions_by_user(
    df: DataFrame, user: str, ts: str, tiebreak: Sequence[str], gap_seconds: int
) -> DataFrame:
    """One window partition per user."""
    seconds = F.unix_timestamp(ts)
    w = Window.partitionBy(user).orderBy(F.col(ts), *tiebreak)
    return df.withColumn(
        "time_since_last_action", seconds - F.lag(seconds).over(w)
    ).withColumn(
        "session_id",
        F.sum(_opens("time_since_last_action", gap_seconds)).over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ),
    )


def _sessions_by_range(
    df: DataFrame, user: str, ts: str, tiebreak: Sequence[str], gap_seconds: int, slices: int | None
) -> DataFrame:
    """Sessions of few users with very many rows: one window partition per user and range of rows.

    Rows without a timestamp come before all others, open nothing and have no gap, so
    they need no window.
    """
    known = df.filter(F.col(ts).isNotNull())
    unknown = df.filter(F.col(ts).isNull()).withColumns(
        {"time_since_last_action": F.lit(None).cast("long"), "session_id": F.lit(0).cast("long")})
    seconds = F.unix_timestamp(ts)
    sliced = slice_by_range(known, F.asc(user), F.asc(ts), *[F.asc(c) for c in tiebreak], slices=slices)
    part = [user, "_slice"]
    w = Window.partitionBy(*part).orderBy(F.col(ts), *tiebreak)
    inner = (
        sliced.withColumn("_gap", seconds - F.lag(seconds).over(w))
        .withColumn("_first", F.row_number().over(w) == 1)
        .withColumn(
            "_opened",
            F.sum(_opens("_gap", gap_seconds)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        )
    )
    uw = Window.partitionBy(user).orderBy("_slice")
    summary = (
        inner.groupBy(*part)
        .agg(F.min(seconds).alias("_from"), F.max(seconds).alias("_to"), F.max("_opened").alias("_inside"))
        .withColumn("_entry_gap", F.col("_from") - F.lag("_to").over(uw))
        .withColumn("_entry", _opens("_entry_gap", gap_seconds))
        .withColumn(
            "_before",
            F.sum(F.col("_inside") + F.col("_entry")).over(
                uw.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            )
            - F.col("_inside"),
        )
        .select(F.col(user).alias("_u"), F.col("_slice").alias("_s"), "_entry_gap", "_before")
    )
    ranged = (
        inner.join(summary, inner[user].eqNullSafe(summary["_u"]) & (inner["_slice"] == summary["_s"]))
        .withColumn("time_since_last_action", F.when(F.col("_first"), F.col("_entry_gap")).otherwise(F.col("_gap")))
        .withColumn("session_id", F.col("_before") + F.col("_opened"))
    )
    columns = [*df.columns, "time_since_last_action", "session_id"]
    return ranged.select(*columns).unionByName(unknown.select(*columns))


def _opens(gap: str, gap_seconds: int) -> Column:
    return F.when(F.col(gap) > gap_seconds, 1).otherwise(0).cast("long")


# ---- running totals over a global order -----------------------------------------


def slice_by_range(df: DataFrame, *order_by: Column, slices: int | None = None) -> DataFrame:
    """Cut an order into ranges of about equal size, numbered in `_slice`.

    Spark's range partitioning samples the order; the rows are stored with the
    number of their range, so every later step sees the same cut.  Without a
    number of slices adaptive execution merges small neighbours.
    """
    ranged = (
        df.repartitionByRange(slices, *order_by) if slices else df.repartitionByRange(*order_by)
    )
    return stage(ranged.withColumn("_slice", F.spark_partition_id()), "ranges")


def row_numbers(df: DataFrame, *order_by: Column, into: str = "row", slices: int | None = None) -> DataFrame:
    """Numbers from 0 in an order without ties: ranges are numbered on their own and moved on by the rows before."""
    sliced = slice_by_range(df, *order_by, slices=slices)
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    before = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n")).select(
        F.col("_slice").alias("_s"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_slice").orderBy(*order_by))
    numbered = sliced.join(F.broadcast(before), F.col("_slice") == F.col("_s"))
    return numbered.withColumn(into, inside - 1 + F.col("_before")).drop("_slice", "_s", "_before")


def running_totals(
    df: DataFrame,
    order_by: str,
    values: Sequence[str],
    by: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """Running sums by descending `order_by`, inclusive, as `cum_<value>`; per group if asked.

    `df` has one row per distinct order value (and group).  Each range of the
    order is summed on its own; the range totals are carried over.  No task sees
    the whole frame or a whole group.
    """
    by = list(by)
    sliced = slice_by_range(df, *[F.asc(k) for k in by], F.desc(order_by), slices=slices)
    earlier = (
        Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        sliced.groupBy("_slice", *by)
        .agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
        .select(
            F.col("_slice").alias("_s"),
            *[F.col(k).alias(f"_by_{k}") for k in by],
            *[F.coalesce(F.sum(f"_t_{v}").over(earlier), F.lit(0)).alias(f"_o_{v}") for v in values],
        )
    )
    if not by:  # one row per range
        carried = F.broadcast(carried)
    on = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(f"_by_{k}")) for k in by],
        F.col("_slice") == F.col("_s"),
    )
    inside = (
        Window.partitionBy("_slice", *by)
        .orderBy(F.col(order_by).desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return sliced.join(carried, on).select(
        *df.columns,
        *[(F.sum(v).over(inside) + F.col(f"_o_{v}")).alias(f"cum_{v}") for v in values],
    )
