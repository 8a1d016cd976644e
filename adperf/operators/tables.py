"""Generic table operators: filters, counts, profiles, pivots, accounting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adperf.functions.expr import any_word, as_col
from adperf.operators import spread
from adperf.operators.windows import running_totals
from adperf.sources.staging import stage


# ---- filters ---------------------------------------------------------------------------


def apply_filters(
    df: DataFrame, filters: Mapping[str, object], domains: Mapping[str, Sequence] | None = None
) -> DataFrame:
    """Report filters: a list keeps its values, an empty list keeps nothing.

    A list covering the column's whole domain, and None, mean no filter.
    """
    for column, wanted in filters.items():
        if wanted is None:
            continue
        if isinstance(wanted, (list, tuple, set)):
            domain = (domains or {}).get(column)
            if domain is not None and set(wanted) >= set(domain):
                continue
            condition = F.col(column).isin(list(wanted)) if wanted else F.lit(False)
        else:
            condition = F.col(column) == wanted
        df = df.filter(condition)
    return df


def keyword_search(df: DataFrame, question: str, order_by: str, k: int = 5) -> DataFrame:
    """First k rows holding a question word of more than 3 letters, else the first k."""
    words = [w for w in question.lower().split() if len(w) > 3]
    marked = df.withColumn("_hit", any_word(df.columns, words))
    found = marked.agg(F.coalesce(F.bool_or("_hit"), F.lit(False)).alias("_any")).scalar()
    return (
        marked.filter(F.col("_hit") | ~found).orderBy(order_by).limit(k).drop("_hit")
    )


# ---- counts and profiles ------------------------------------------------------------------


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column | str]) -> DataFrame:
    """All counts in one pass, one row with a column per condition."""
    return df.agg(
        *[F.count_if(F.expr(c) if isinstance(c, str) else c).alias(n) for n, c in conditions.items()]
    )


def long_form(df: DataFrame, key: str, value: str, ids: Sequence[str] = ()) -> DataFrame:
    """Columns to (key, value) rows."""
    rest = [c for c in df.columns if c not in ids]
    return df.unpivot(list(ids), rest, key, value)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and share per column, from one pass over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns],
    )
    return counts.unpivot(["_rows"], df.columns, "column_name", "null_count").select(
        "column_name",
        "null_count",
        F.coalesce(F.try_divide(F.col("null_count") * 100.0, "_rows"), F.lit(0.0)).alias("null_pct"),
    )


def duplicate_profile(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows, distinct rows (or keys), duplicates and their share.

    Counted per distinct row first, so copies are merged before the shuffle.
    """
    per_row = df.groupBy(*(keys or df.columns)).agg(F.count(F.lit(1)).alias("n"))
    return per_row.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
    ).withColumns(
        {
            "duplicate_rows": F.col("total_rows") - F.col("distinct_rows"),
            "duplicate_pct": F.coalesce(
                F.try_divide(
                    (F.col("total_rows") - F.col("distinct_rows")) * 100.0, F.col("total_rows")
                ),
                F.lit(0.0),
            ),
        }
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, stddev, min, max per numeric column, one row per column."""
    wide = df.agg(
        *[
            F.struct(
                F.count(c).alias("n"),
                F.avg(c).alias("mean"),
                F.stddev(c).alias("stddev"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    return wide.unpivot([], list(columns), "column_name", "s").select("column_name", "s.*")


def frequency(df: DataFrame, c: str | Column, name: str, top: int | None = None) -> DataFrame:
    """Rows per value, most frequent first."""
    counted = df.groupBy(as_col(c).alias(name)).agg(F.count(F.lit(1)).alias("n"))
    ordered = counted.orderBy(F.desc("n"), F.asc(name))
    return ordered.limit(top) if top else ordered


def unexpected_values(df: DataFrame, c: str, allowed: Sequence[str], top: int | None = None) -> DataFrame:
    """Distinct values outside the allowed list in order, the first `top` if asked."""
    found = df.filter(F.col(c).isNotNull() & ~F.col(c).isin(list(allowed))).select(F.col(c).alias("value"))
    ordered = found.distinct().orderBy("value")
    return ordered.limit(top) if top else ordered


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise correlation matrix in long form, from one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    upper = wide.unpivot([], wide.columns, "pair", "corr").select(
        F.split_part("pair", F.lit("|"), F.lit(1)).alias("x"),
        F.split_part("pair", F.lit("|"), F.lit(2)).alias("y"),
        "corr",
    )
    mirrored = upper.filter("x <> y").select(F.col("y").alias("x"), F.col("x").alias("y"), "corr")
    return upper.unionByName(mirrored)


def target_correlations(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """Correlation of each column with the target, strongest first."""
    wide = df.agg(*[F.corr(c, target).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "feature", "corr").orderBy(F.desc(F.abs("corr")), "feature")


def variation(df: DataFrame, columns: Sequence[str], floor: float = 1e-10) -> DataFrame:
    """Spread per column, whether it is constant and whether it varies enough to model."""
    wide = df.agg(
        *[
            F.struct(
                F.coalesce(F.stddev(c), F.lit(0.0)).alias("stddev"),
                (F.min(c) == F.max(c)).alias("constant"),
            ).alias(c)
            for c in columns
        ]
    )
    return (
        wide.unpivot([], list(columns), "column_name", "s")
        .select("column_name", "s.*")
        .withColumn("varies", F.col("stddev") > floor)
    )


def quantiles(
    df: DataFrame, value: str, positions: Mapping[str, float], group: str | None = None, accuracy: int = 10_000, **limits
) -> DataFrame:
    """Exact quantiles per group, one column each, interpolated between neighbours.

    Two scans for any number of positions.  The first makes one sketch a group, whose
    rank error of 1/accuracy brackets every quantile.  The second counts the rows: those
    between two brackets as one number, those inside a bracket by value, a share of
    about 4/accuracy each.  Only the latter are ranked, each value once with its count,
    with the ends of what lies between.  Rows of hot groups meet their brackets by broadcast.
    """
    by = [] if group is None else ["_g"]
    keys = [] if group is None else [F.col(group).alias("_g")]
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    names, qs = list(positions), sorted(set(positions.values()))
    margin = 2 / accuracy
    cuts = [max(q - margin, 0.0) for q in qs] + [min(q + margin, 1.0) for q in qs]
    brackets = stage(
        rows.groupBy(*by).agg(F.percentile_approx("_v", cuts, accuracy).alias("_cuts"), F.count(F.lit(1)).alias("_n")),
        "brackets",
    )
    if by:
        hot = spread.hot_groups(brackets, by, "_n", **limits)
        bounded = spread.attach_by_key(rows, brackets.drop("_n"), by, "left", hot=hot)
    else:
        bounded = rows.withColumn("_cuts", brackets.select("_cuts").scalar())
    edges = [(F.col("_cuts")[i], F.col("_cuts")[i + len(qs)]) for i in range(len(qs))]
    v = F.col("_v")
    # a row outside all brackets is below the bracket of its region's number
    region = reduce(lambda x, y: x + y, [F.when(v > high, 1).otherwise(0) for _, high in edges])
    inside = reduce(lambda x, y: x | y, [(v >= low) & (v <= high) for low, high in edges])
    counted = stage(
        bounded.groupBy(*by, region.alias("_region"), F.when(inside, v).alias("_v")).agg(
            F.count(F.lit(1)).alias("_c"), F.min(v).alias("_least"), F.max(v).alias("_most")),
        "near_quantiles",
    )
    # a neighbour of a bracket's end may be needed: the ends of what lies between are values of their own
    between = counted.filter(v.isNull())
    ends = between.select(*by, F.inline(F.filter(F.array(
        F.struct((F.col("_region") - 1).alias("_region"), F.col("_least").alias("_v"),
                 F.when(F.col("_least") == F.col("_most"), F.col("_c")).otherwise(1).alias("_c")),
        F.struct("_region", F.col("_most").alias("_v"),
                 F.when(F.col("_least") == F.col("_most"), 0).otherwise(1).cast("long").alias("_c")),
    ), lambda e: e["_c"] > 0)))
    rest = F.when(F.col("_least") == F.col("_most"), 0).otherwise(F.col("_c") - 2)
    lumps = between.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_region", rest))).alias("_lumps"))  # a few
    values = counted.filter(v.isNotNull()).select(*by, "_region", "_v", "_c").unionByName(ends)
    ranked = running_totals(values, "_v", ["_c"], by=by)
    ranked = _of_group(_of_group(ranked, brackets.drop("_cuts"), by), lumps, by)
    above = reduce(
        lambda x, y: x + y,
        [F.when(F.col("_region") < r, F.coalesce(F.try_element_at("_lumps", F.lit(r)), F.lit(0))).otherwise(0)
         for r in range(len(qs) + 1)],
    )
    placed = ranked.withColumn("_upto", F.col("cum__c") + above)

    def at(place: Column) -> Column:
        """Value at a place counted from the smallest; totals run from the largest."""
        rank = F.col("_n") - 1 - place
        return F.max(F.when((F.col("_upto") > rank) & (F.col("_upto") - F.col("_c") <= rank), v))

    def interpolated(q: float) -> Column:
        place = (F.col("_n") - 1) * F.lit(float(q))
        low, high = at(F.floor(place)), at(F.ceil(place))
        return low + (high - low) * F.max(place - F.floor(place))

    found = placed.groupBy(*by).agg(*[interpolated(positions[name]).alias(name) for name in names])
    return found if group is None else found.withColumnRenamed("_g", group)


def _of_group(df: DataFrame, side: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add columns known once for each group, or once for all."""
    if not by:
        return df.withColumns({c: side.select(c).scalar() for c in side.columns})
    other = side.withColumnRenamed("_g", "_other")
    return df.join(other, F.col("_g").eqNullSafe(F.col("_other")), "left").drop("_other")


def quantile(
    df: DataFrame,
    value: str,
    q: float = 0.5,
    group: str | None = None,
    into: str = "quantile",
    accuracy: int = 10_000,
) -> DataFrame:
    """One exact quantile per group."""
    return quantiles(df, value, {into: q}, group, accuracy)


def medians(df: DataFrame, group: str, value: str) -> DataFrame:
    return quantile(df, value, 0.5, group, f"median_{value}")


def adaptive_grain(df: DataFrame, date: str, hour: str) -> Column:
    """Time unit by the number of dates: one date -> hour, up to 31 -> day, else month."""
    dates = df.agg(F.count_distinct(F.col(date).cast("date")).alias("_dates")).scalar()
    return (
        F.when(dates <= 1, F.bround(hour).cast("int").cast("string"))
        .when(dates <= 31, F.date_format(date, "dd"))
        .otherwise(F.date_format(date, "yyyy-MM"))
    )


def pivot_mean(df: DataFrame, row: str, column: str, values: Sequence[str], metric: str) -> DataFrame:
    """Mean of a metric, one column per listed value."""
    return df.groupBy(row).pivot(column, list(values)).agg(F.avg(metric))


def crosstab(df: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    """Row counts of every (row, column) pair, one column per listed value."""
    counts = [F.count_if(F.col(column) == v).alias(f"{column}_{v}") for v in values]
    return df.groupBy(row).agg(*counts)


def best_per_group(
    df: DataFrame, group: str, subject: str, metric: str, largest: bool = True
) -> DataFrame:
    """Subject with the best metric per group, smallest subject on ties.

    An aggregate, so a group of any size keeps one candidate per task.
    """
    rank = F.struct(-F.col(metric) if largest else F.col(metric), F.col(subject))
    return (
        df.groupBy(group)
        .agg(F.min_by(F.struct(F.col(subject), F.col(metric)), rank).alias("_best"))
        .select(group, f"_best.{subject}", f"_best.{metric}")
    )


def label_extremes(df: DataFrame, subject: str, metric: str) -> DataFrame:
    """`best`, `worst` or `middle` per row of a small aggregate."""
    ends = df.agg(
        F.min_by(subject, F.struct(-F.col(metric), F.col(subject))).alias("best"),
        F.max_by(subject, F.struct(-F.col(metric), F.col(subject))).alias("worst"),
    )
    best, worst = ends.select("best").scalar(), ends.select("worst").scalar()
    return df.withColumn(
        "label",
        F.when(F.col(subject) == best, "best")
        .when(F.col(subject) == worst, "worst")
        .otherwise("middle"),
    )


def label_position(c: str, labels: Sequence[str]) -> Column:
    """Place of a label in a given order, the last place for others."""
    return F.coalesce(
        F.nullif(F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(c)), F.lit(0)),
        F.lit(len(labels)),
    )


def union_counts(frames: Mapping[str, DataFrame], label: str = "source") -> DataFrame:
    """Row counts of several frames as rows."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias(label), "n")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def rows_in_out(steps: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Rows before and after a step, one row per table."""
    parts = []
    for name, (before, after) in steps.items():
        one = F.count(F.lit(1))
        parts.append(before.agg(one.alias("n")).select(F.lit(name).alias("table_name"), F.lit("in").alias("side"), "n"))
        parts.append(after.agg(one.alias("n")).select(F.lit(name).alias("table_name"), F.lit("out").alias("side"), "n"))
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("table_name")
        .agg(
            F.sum(F.when(F.col("side") == "in", F.col("n"))).alias("rows_in"),
            F.sum(F.when(F.col("side") == "out", F.col("n"))).alias("rows_out"),
        )
    )
