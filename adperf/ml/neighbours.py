"""Exact nearest neighbours among rows, and synthetic rows between them.

Equal points are one class, which keeps its smallest keys only, so a point that very many
rows share forms no pairs.  Classes lie in the cells of a binary tree of half-spaces, cut
by a bounded sample, so that a cell has about CELL_ROWS classes however many there are.
A first pass compares the classes of each cell, which bounds how far the k-th neighbour
of each can be.  A second one compares a class with those other cells only whose box lies
within that bound.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adperf.ml.prep import unit_draw
from adperf.operators import spread
from adperf.operators.windows import row_numbers
from adperf.sources.staging import stage

#: Classes of a cell, about, and cells at most; beyond that many cells they grow.
CELL_ROWS, MAX_CELLS = 512, 16384
#: Classes of the sample in each cell, at least; the sample decides where cells end and nothing else.
SAMPLED = 16
#: Classes that a task compares in the first pass, about, and distances that are held at once.
TASK_ROWS, BLOCK = 16384, 1 << 20
#: Distances are rounded to so many places: what differs by less is a tie, whatever the last digits of a sum are.
PLACES = 9
#: What bounds are widened by, as a share and beyond it.
SLACK = 1e-8


@dataclass(frozen=True)
class _Tree:
    """Half-spaces: a node's values up to `at` in column `column` go to `low`, others to `high`; a leaf has column -1 and its cell in `low`."""

    column: np.ndarray
    at: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def cut(cls, sample: np.ndarray, cells: int, least: int) -> _Tree:
        """Cells with equal shares of the sample as far as equal values allow, and `least` of it or more each."""
        share, nodes, leaves = max(least, len(sample) / cells), [[-1, 0.0, 0, 0]], 0
        todo = [(0, sample)]
        while todo:
            node, part = todo.pop()
            found = None
            if len(part) >= 2 * share:
                for column in np.argsort(part.min(0) - part.max(0), kind="stable"):  # the widest first
                    values = np.sort(part[:, column])
                    at = values[(len(values) - 1) // 2]
                    if at == values[-1]:
                        at = values[max(0, np.searchsorted(values, at) - 1)]
                    down = part[:, column] <= at
                    if least <= down.sum() <= len(part) - least:
                        found = int(column), float(at), down
                        break
            if found is None:
                nodes[node] = [-1, 0.0, leaves, 0]
                leaves += 1
                continue
            column, at, down = found
            nodes[node] = [column, at, len(nodes), len(nodes) + 1]
            todo += [(len(nodes), part[down]), (len(nodes) + 1, part[~down])]
            nodes += [[-1, 0.0, 0, 0], [-1, 0.0, 0, 0]]
        column, at, low, high = zip(*nodes)
        return cls(np.array(column), np.array(at), np.array(low), np.array(high))

    def cells(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        while True:
            rows = np.flatnonzero(self.column[node] >= 0)
            if not len(rows):
                return self.low[node]
            at = node[rows]
            down = points[rows, self.column[at]] <= self.at[at]
            node[rows] = np.where(down, self.low[at], self.high[at])


def _points(column: pa.ChunkedArray, width: int) -> np.ndarray:
    parts = [c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]
    return np.concatenate(parts).reshape(-1, width) if parts else np.zeros((0, width))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of every point of `a` to every point of `b`, summed column by column."""
    total = np.zeros((len(a), len(b)))
    for x, y in zip(a.T, b.T):
        gap = x[:, None] - y[None]
        total += gap * gap
    return np.sqrt(total)


def _reach(far: np.ndarray, k: int) -> np.ndarray:
    """What the k-th smallest value of each row is at most, widened."""
    if far.shape[1] < k:
        return np.full(len(far), np.inf)
    return np.partition(far, k - 1, axis=1)[:, k - 1] * (1 + SLACK) + SLACK


def _assign(tree: _Tree, width: int) -> Callable:
    def run(batches):
        for batch in batches:
            cells = tree.cells(_points(pa.chunked_array([batch.column("v")]), width))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells, pa.int32()), *batch.columns], ["cell", *batch.schema.names])

    return run


_OTHERS = ["c", "raw", "keys"]


def _candidates(asked: pa.Table, i: np.ndarray, far: np.ndarray, points: pa.Table, j: np.ndarray) -> dict:
    """Columns q, distance and what is kept of the neighbours j of the asked i."""
    return {"q": asked["q"].take(pa.array(i)), "distance": pa.chunked_array([pa.array(far)])} | {
        n: points[n].take(pa.array(j)) for n in _OTHERS}


def _within(k: int, low: np.ndarray, high: np.ndarray) -> Callable:
    """Candidates of a cell's own classes, and (ask, q, v, reach): the other cells that may hold nearer ones."""

    def run(cell: pa.Table) -> pa.Table:
        v, own = _points(cell["v"], low.shape[1]), cell["cell"][0].as_py()
        asked, parts = cell.rename_columns(["q" if n == "c" else n for n in cell.column_names]), []
        step = max(1, BLOCK // max(len(v), len(low)))
        for start in range(0, len(v), step):
            a = v[start:start + step]
            far = _distances(a, v)
            far[np.arange(len(a)), start + np.arange(len(a))] = np.inf  # the row itself
            reach = _reach(far, k)
            i, j = np.nonzero((far <= reach[:, None]) & np.isfinite(far))
            near = _candidates(asked, start + i, far[i, j], cell, j)
            most = reach.max()
            others = np.flatnonzero((low <= a.max(0) + most).all(1) & (high >= a.min(0) - most).all(1))
            others = others[others != own]
            gaps = np.zeros((len(a), len(others)))
            for x, y, z in zip(a.T, low[others].T, high[others].T):
                gaps += np.maximum(0.0, np.maximum(y[None] - x[:, None], x[:, None] - z[None])) ** 2
            p, r = np.nonzero(np.sqrt(gaps) <= reach[:, None])
            asks = {
                "q": asked["q"].take(pa.array(start + p)), "ask": pa.array(others[r].astype(np.int32)),
                "v": cell["v"].take(pa.array(start + p)), "reach": pa.array(reach[p])}
            for made in (near, asks):
                parts.append(pa.table({
                    f: made[f] if f in made else pa.nulls(len(made["q"]), t) for f, t in (
                        ("q", cell.schema.field("c").type), ("ask", pa.int32()), ("v", cell.schema.field("v").type),
                        ("reach", pa.float64()), ("distance", pa.float64()), *((n, cell.schema.field(n).type) for n in _OTHERS))}))
        return pa.concat_tables(parts)

    return run


def _across(k: int, width: int) -> Callable:
    """Candidates of the classes that ask for a cell among its classes."""

    def run(asked: pa.Table, cell: pa.Table) -> pa.Table:
        a, b = _points(asked["v"], width), _points(cell["v"], width)
        limits, parts = asked["reach"].to_numpy(), []
        step = max(1, BLOCK // max(1, len(b)))
        for start in range(0, max(1, len(a)), step):
            far = _distances(a[start:start + step], b)
            reach = np.minimum(limits[start:start + step], _reach(far, k))
            i, j = np.nonzero(far <= reach[:, None])
            parts.append(pa.table(_candidates(asked, start + i, far[i, j], cell, j)))
        return pa.concat_tables(parts)

    return run


def standardised(df: DataFrame, columns: Sequence[str]) -> Column:
    """The columns as one array with mean 0 and standard deviation 1; constant ones are 0."""
    stats = df.agg(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev(c).alias(f"s_{c}") for c in columns]).first()
    return F.array(*[
        (F.col(c) - F.lit(float(stats[f"m_{c}"]))) / F.lit(float(stats[f"s_{c}"])) if stats[f"s_{c}"] else F.lit(0.0)
        for c in columns])


def nearest(df: DataFrame, key: str, columns: Sequence[str], k: int = 5, max_cells: int = MAX_CELLS) -> DataFrame:
    """key and neighbours (distance, key, values) of every row, the nearest first, smaller keys first on ties.

    Distances are between standardised columns.  Rows with a null, NaN or infinity among
    them take no part.  Fewer than k other rows give fewer neighbours.
    """
    known = ~F.exists(
        F.array(*[F.col(c).cast("double") for c in columns]), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = df.filter(known)
    rows = stage(whole.select(
        F.col(key).alias("key"), standardised(whole, columns).alias("v"),
        F.array(*[F.col(c).cast("double") for c in columns]).alias("raw")), "points")
    by_key = Window.partitionBy("v").orderBy("key")
    few = rows.withColumn("i", F.row_number().over(by_key)).filter(F.col("i") <= k + 1)
    classes = stage(few.groupBy("v").agg(  # k + 1 rows each at most
        F.min("key").alias("c"), F.sort_array(F.collect_list("key")).alias("keys"), F.first("raw").alias("raw")), "classes")
    n = classes.count()
    if not n:
        return rows.select("key", F.array().cast(_kind(rows)).alias("neighbours"))

    width, cells = len(columns), max(1, min(max_cells, n // CELL_ROWS))
    least = max(SAMPLED, k + 1)
    drawn = classes.filter(F.pmod(F.xxhash64("v"), F.lit(n)) < cells * least).select("v").collect() if cells > 1 else []
    sample = np.array(sorted(tuple(r["v"]) for r in drawn)).reshape(-1, width)
    tree = _Tree.cut(sample, cells, least)
    kinds = {f.name: f.dataType.simpleString() for f in classes.schema}
    held = ", ".join(f"{name} {kind}" for name, kind in kinds.items())
    placed = stage(classes.mapInArrow(_assign(tree, width), f"cell int, {held}"), "cells")
    ends = [f(F.get("v", F.lit(i))) for f in (F.min, F.max) for i in range(width)]
    boxes = {r[0]: r[1:] for r in placed.groupBy("cell").agg(*ends).collect()}  # one row for each cell
    nowhere = [*[np.inf] * width, *[-np.inf] * width]
    low, high = np.split(np.array([boxes.get(c, nowhere) for c in range(max(boxes) + 1)]), 2, axis=1)

    # a count of its own, for the work is in the pairs and not in the bytes that are dealt
    tasks = min(len(boxes), max(-(-n // TASK_ROWS), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    dealt = placed.repartition(tasks, "cell")
    found = f"distance double, c {kinds['c']}, raw {kinds['raw']}, keys {kinds['keys']}"
    first = stage(dealt.groupBy("cell").applyInArrow(
        _within(k, low, high), f"q {kinds['c']}, ask int, v {kinds['v']}, reach double, {found}"), "first")
    pairs = first.filter("ask IS NULL").select("q", "distance", *_OTHERS)
    if len(boxes) > 1:
        asks = first.filter("ask IS NOT NULL").select("q", "ask", "v", "reach").repartition(tasks, "ask")
        second = asks.groupBy("ask").cogroup(dealt.groupBy("cell")).applyInArrow(_across(k, width), f"q {kinds['c']}, {found}")
        pairs = pairs.unionByName(second)
    best = Window.partitionBy("q").orderBy("distance", "c")
    kept = pairs.withColumn("distance", F.round("distance", PLACES)).withColumn(
        "i", F.row_number().over(best)).filter(F.col("i") <= k)
    members = F.transform("keys", lambda y: F.struct(F.col("distance"), y.alias("key"), F.col("raw").alias("values")))
    others = kept.select("q", members.alias("m")).groupBy("q").agg(
        F.slice(F.sort_array(F.flatten(F.collect_list("m"))), 1, k).alias("others"))  # k lists of k + 1 at most
    side = stage(classes.join(others.withColumnRenamed("q", "c"), "c", "left").select("v", "keys", "others"), "neighbours")
    met = spread.attach_by_key(rows, side, ["v"])
    same = F.transform(
        F.filter("keys", lambda y: y != F.col("key")),
        lambda y: F.struct(F.lit(0.0).alias("distance"), y.alias("key"), F.col("raw").alias("values")))
    both = F.concat(same, F.coalesce("others", F.array().cast(_kind(rows))))
    return met.select("key", F.slice(both, 1, k).alias("neighbours"))


def _kind(rows: DataFrame) -> str:
    return f"array<struct<distance:double,key:{rows.schema['key'].dataType.simpleString()},values:array<double>>>"


def smote(
    df: DataFrame, label: str, key: str, numerics: Sequence[str], k: int = 5, times: int | None = None, ratio: float = 3.0
) -> DataFrame:
    """The rows with synthetic ones of the minority (label 1), each between a row and one of its k nearest.

    Without `times`, only classes more unequal than `ratio` are treated, and brought to
    parity; with it, every minority row gets so many.  Which neighbour, and how far
    towards it, is drawn from the row's key and the number of the copy.  The other columns
    are copied from the row.  Rows that have no neighbours are copied as they are.
    """
    minority = df.filter(F.col(label) == 1)
    found = nearest(minority, key, numerics, k)
    sizes = df.agg(F.count_if(F.col(label) == 1).alias("few"), F.count_if(F.col(label) != 1).alias("many")).first()
    able = found.count()
    wanted = times * able if times is not None else 0
    if times is None and sizes["few"] and sizes["many"] > ratio * sizes["few"]:
        wanted = sizes["many"] - sizes["few"]
    if not able or not wanted:
        return df
    numbered = row_numbers(found, F.asc("key"), into="_i")
    copies = F.floor((F.col("_i") + 1) * wanted / able) - F.floor(F.col("_i") * wanted / able)
    repeated = numbered.withColumn("_copies", copies.cast("int")).filter("_copies > 0")
    repeated = repeated.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies")))
    name = F.concat_ws("/", F.col("key"), F.col("_copy"))
    which = F.floor(unit_draw(name, "which/") * F.size("neighbours")).cast("int")
    drawn = repeated.select(
        F.col("key").alias(key), F.get("neighbours", which)["values"].alias("_to"), unit_draw(name).alias("_mix"))
    made = minority.join(drawn, key)
    mixed = {
        c: F.col(c) + F.coalesce((F.get("_to", F.lit(i)) - F.col(c)) * F.col("_mix"), F.lit(0.0)) for i, c in enumerate(numerics)}
    return df.unionByName(made.withColumns(mixed).select(*df.columns))
