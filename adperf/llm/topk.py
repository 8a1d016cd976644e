"""Exact top-k by inner product over a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance to it, cut into rings:
an annulus.  With the extremes of an annulus (distance, squared norm) and the query's
own distance to the pivot, the triangle inequality bounds the distance, and so the
inner product, of everything inside.  Each query takes its annuli in the order of
these bounds, some rows first and eight times as many in each further round, and
stops when no bound reaches its k-th score.  Ties count as reached, so smaller ids
are found.

Pivots are a bounded sample; every row is indexed.  There are at most PIVOTS * RINGS
annuli, so their extremes are a small table.  An annulus is stored in packed blocks of
at most BLOCK_ROWS rows, and blocks lie in buckets of about BUCKET_BLOCKS; a large
annulus is dealt over several buckets by hash, so a group of equal vectors is no large
block and no large bucket.  Rows are moved once, when the index is built.  In a round a
query goes once to each bucket that holds annuli it needs, packed with others, and
meets the blocks there, so what moves is queries times buckets, not queries times
blocks.  Neither side is broadcast: a row holds thousands of vectors, which Spark's
estimates do not see.

Products are taken in the narrowest type in which every partial sum is whole.  Only
tiles whose largest product reaches a query's k-th score so far are looked at again.

Defined cases: vectors that are null or hold null, NaN or infinite components take no
part, as query or candidate; vectors of unlike lengths are compared as if the shorter
were filled with zeros; rows with the query's id are not its candidates; repeated
rows are candidates as often as they occur; ties go to the smaller id; an empty table
or query set gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adperf.llm.chunks import BATCH_BYTES, bucketed
from adperf.sources.staging import stage

SCALE = 1024
PIVOTS, RINGS = 24, 12
BLOCK_ROWS = 16384
QUERY_BLOCK = 16384
#: Components of a block and of packed queries at most, blocks of a bucket, and buckets of a small table at most.
BLOCK_NUMBERS, BUCKET_BLOCKS, BUCKETS = 1 << 20, 16, 64
#: Bytes of packed queries that a worker hands over at once.
SENT_BYTES = 1 << 22
#: Rows and queries whose products are taken at once; they stay in a core's cache.
TILE = (1024, 512)
#: Rows of a tile that are looked at again for a query if the largest of their products reaches.
PART = 128
FIRST_ROWS, GROWTH = 1024, 8
#: Below these a product of whole numbers summed in floats or doubles is exact.
EXACT_FLOAT, EXACT = float(1 << 24), float(1 << 53)
LOWEST = np.iinfo(np.int64).min


def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, v: components times `scale`, rounded down; rows that take part only."""
    picked = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v"))
    numbers = F.col("v").cast("array<double>")
    # null, and so no row, if a component is null
    whole = ~F.array_contains(numbers, F.lit(float("nan")))
    for x in (float("inf"), float("-inf")):
        whole &= ~F.array_contains(numbers, F.lit(x))
    return picked.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & whole).select(
        "vec_id", F.transform("v", lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """List column as rows of whole numbers, filled with zeros on the right."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(pa.compute.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
    sizes = np.diff(ends, prepend=0)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(ends - sizes, sizes)] = flat
    return out


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    a, b = x.astype(np.float64), pivots.astype(np.float64)
    squared = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T
    return np.sqrt(np.maximum(squared, 0))


def _narrow(least: int, most: int) -> np.dtype:
    """The smallest type of whole numbers that holds both."""
    return next(np.dtype(t) for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= least and most <= np.iinfo(t).max)


def _unpacked(packed: pa.BinaryScalar, rows: int, width: int) -> np.ndarray:
    """Rows of whole numbers of any type, as they were packed."""
    held = packed.as_buffer()
    return np.frombuffer(held, f"i{held.size // (rows * width) if rows * width else 8}").reshape(rows, width)


def _ids(packed: pa.BinaryScalar) -> np.ndarray:
    return np.frombuffer(packed.as_buffer(), np.int64)


class Index:
    """Blocks of an indexed table, with the extremes of its annuli and where they lie.

    The blocks of the annulus at place j are in `parts[j]` buckets from `first[j]` on;
    `keys` has the buckets' keys.
    """

    def __init__(
        self, blocks: DataFrame | None, pivots: np.ndarray, annuli: dict[str, np.ndarray], width: int, keys: list[int]
    ) -> None:
        self.blocks, self.pivots, self.annuli, self.width, self.keys = blocks, pivots, annuli, width, keys


def _bucket_keys(spark: SparkSession, buckets: int) -> list[int]:
    """A key for each bucket, so that each is alone in its bucket of a table bucketed by key."""
    tried = spark.range(32 * buckets).select(F.col("id").cast("int").alias("k"))
    slot = F.pmod(F.hash("k"), F.lit(buckets))
    keys = sorted(r[0] for r in tried.groupBy(slot).agg(F.min("k")).select("min(k)").collect())  # one row a bucket
    return keys + list(range(32 * buckets, 33 * buckets - len(keys)))


def build(vectors: DataFrame, pivots: int = PIVOTS, rings: int = RINGS, block_rows: int = BLOCK_ROWS) -> Index | None:
    """Index of all rows of `whole_vectors`; None if there are none."""
    spark = vectors.sparkSession
    vectors = stage(vectors, "vectors")
    width, lowest, highest = vectors.agg(F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    if width is None:
        return None
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).collect()  # at most `pivots` rows
    centres = np.zeros((len(sample), width), np.int64)
    for i, row in enumerate(sample):
        centres[i, : len(row.v)] = row.v
    kind = _narrow(lowest or 0, highest or 0)
    row_bytes = kind.itemsize * width

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), width)
            far = _distances(x, centres)
            near = far.argmin(1)
            ends = np.arange(len(x) + 1, dtype=np.int32) * row_bytes
            packed = [None, pa.py_buffer(ends), pa.py_buffer(x.astype(kind).tobytes())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(near.astype(np.int32)),
                    pa.array(far[np.arange(len(near)), near] if len(near) else np.zeros(0)),
                    pa.array((x.astype(np.float64) ** 2).sum(1)),
                    pa.Array.from_buffers(pa.binary(), len(x), packed),
                ],
                names=["vec_id", "pivot", "dist", "norm", "v"],
            )

    placed = vectors.mapInArrow(assign, "vec_id long, pivot int, dist double, norm double, v binary")
    placed = stage(placed, "placed")
    step = (placed.agg(F.max("dist")).first()[0] or 0.0) / rings or 1.0
    ring = F.least(F.floor(F.col("dist") / step), F.lit(rings - 1)).cast("int")
    placed = placed.withColumn("a", F.col("pivot") * rings + ring)
    found = placed.groupBy("a").agg(
        F.first("pivot").alias("pivot"), F.count("*").alias("n"), F.min("dist").alias("low"),
        F.max("dist").alias("high"), F.max("norm").alias("norm"),
    ).orderBy("a").collect()  # at most pivots * rings rows
    annuli = {k: np.array([r[k] for r in found]) for k in ("a", "pivot", "n", "low", "high", "norm")}
    block_rows = max(1, min(block_rows, BLOCK_NUMBERS // max(1, width)))
    some = min(BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    full = max(1, min(block_rows * BUCKET_BLOCKS, -(-int(annuli["n"].sum()) // some)))
    annuli["parts"] = -(-annuli["n"] // full)
    annuli["first"], buckets, held = np.zeros(len(found), np.int64), 0, full
    for j, n in enumerate(annuli["n"]):
        if n > full:  # buckets of its own
            annuli["first"][j], buckets, held = buckets, buckets + annuli["parts"][j], full
        else:
            if held + n > full:
                buckets, held = buckets + 1, 0
            annuli["first"][j], held = buckets - 1, held + n
    keys = _bucket_keys(spark, int(buckets))
    first, parts = np.zeros(pivots * rings, np.int64), np.ones(pivots * rings, np.int64)
    first[annuli["a"]], parts[annuli["a"]] = annuli["first"], annuli["parts"]

    def at(values: list[int], place: Column) -> Column:
        return F.element_at(F.lit([int(x) for x in values]), (place + 1).cast("int"))

    share = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), at(parts, F.col("a")))
    dealt = placed.withColumn("s", at(keys, at(first, F.col("a")) + share).cast("int"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, bytes]] = []
        key, count = (0, 0), 0

        def block() -> pa.RecordBatch:
            ids, rows = zip(*held, strict=True)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()),
                    pa.array([np.concatenate(ids).tobytes()], pa.binary()), pa.array([b"".join(rows)], pa.binary()),
                ],
                names=["s", "a", "others", "y"],
            )

        for batch in batches:
            s, a, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("s", "a", "vec_id"))
            v = np.frombuffer(b"".join(batch.column("v").to_pylist()), np.uint8).reshape(len(ids), row_bytes)
            changes = np.flatnonzero((np.diff(s) != 0) | (np.diff(a) != 0)) + 1
            for lo, hi in zip([0, *changes], [*changes, len(ids)], strict=True):
                while lo < hi:
                    if held and (key != (s[lo], a[lo]) or count == block_rows):
                        yield block()
                        held, count = [], 0
                    key, upto = (s[lo], a[lo]), min(hi, lo + block_rows - count)
                    held.append((ids[lo:upto].astype(np.int64), v[lo:upto].tobytes()))
                    lo, count = upto, count + upto - lo
        if held:
            yield block()

    sorted_rows = dealt.select("s", "a", "vec_id", "v").repartition(len(keys), "s").sortWithinPartitions("s", "a", "vec_id")
    blocks = sorted_rows.mapInArrow(pack, "s int, a int, others binary, y binary")
    return Index(bucketed(blocks, "s", len(keys)), centres, annuli, int(width), keys)


def _bounds(x: np.ndarray, index: Index) -> np.ndarray:
    """Upper bounds of the inner products of queries with each annulus."""
    t, norms = index.annuli, (x.astype(np.float64) ** 2).sum(1)
    to_pivot = _distances(x, index.pivots)[:, t["pivot"]]
    gap = np.maximum(0, np.maximum(t["low"] - to_pivot, to_pivot - t["high"])) - 1e-6
    by_distance = (norms[:, None] + t["norm"][None] - np.maximum(0, gap) ** 2) / 2
    by_length = np.sqrt(norms)[:, None] * np.sqrt(t["norm"])[None]
    bound = np.minimum(by_distance, by_length)
    return bound + 1e-9 * np.abs(bound) + 1.0  # the bounds are computed in doubles


class _Met:
    """Packed queries and the best of the blocks they have met in a bucket."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, least: np.ndarray, need: np.ndarray, longest: float, k: int) -> None:
        most = np.sqrt((x.astype(np.float64) ** 2).sum(1).max(initial=0)) * longest
        self.kind = np.dtype(np.float32 if most < EXACT_FLOAT else np.float64 if most < EXACT else np.int64)
        self.none = LOWEST if self.kind == np.int64 else self.kind.type(-np.inf)
        self.ids, self.x, self.need, self.k = ids, x.astype(self.kind), need, k
        #: Scores that are not below this count.
        self.reach = np.where(least == LOWEST, self.none, least.astype(self.kind))
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.count = 0

    def meet(self, place: int, others: np.ndarray, y: np.ndarray) -> None:
        """A block of the annulus at a place; its rows are ascending in `others`."""
        who = np.flatnonzero(self.need[:, place])
        if not len(who) or not len(others):
            return
        x, y = self.x if len(who) == len(self.x) else self.x[who], y.astype(self.kind)
        low, high = np.searchsorted(others, self.ids[who], "left"), np.searchsorted(others, self.ids[who], "right")
        own = np.flatnonzero(high > low)  # a query's own rows are not its candidates
        products = np.empty(TILE[0] * TILE[1], self.kind)

        def tiles(i: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            """First row, products in parts of rows, and the largest of each part, for the queries from i on."""
            few, j = x[i : i + TILE[1]], 0
            mine = own[(own >= i) & (own < i + TILE[1])]
            while j < len(others):
                size = min(TILE[0], len(others) - j)
                size -= size % PART if size > PART else 0
                got = np.matmul(y[j : j + size], few.T, out=products[: size * len(few)].reshape(size, len(few)))
                for q in mine:
                    got[max(0, low[q] - j) : max(0, high[q] - j), q - i] = self.none
                parts = got.reshape(-1, min(PART, size), len(few))
                yield j, parts, parts.max(1)
                j += size

        for i in range(0, len(who), TILE[1]):
            part = who[i : i + TILE[1]]
            if (self.reach[part] == self.none).any():  # k rows reach the k-th of the parts' largest
                tops = np.concatenate([t for _, _, t in tiles(i)])
                if len(tops) >= self.k:
                    kth = np.partition(tops, len(tops) - self.k, axis=0)[len(tops) - self.k]
                    self.reach[part] = np.maximum(self.reach[part], kth)
            for j, parts, top in tiles(i):
                r, c = np.nonzero(top >= self.reach[part])
                if len(r):
                    self._take(part[c], parts[r, :, c], others, j + r * parts.shape[1])
        if self.count > 4 * self.k * len(self.ids):
            self._cut()

    def _take(self, who: np.ndarray, got: np.ndarray, others: np.ndarray, start: np.ndarray) -> None:
        """Products of queries with parts of rows that begin at `start`."""
        ok = (got >= self.reach[who][:, None]) & (got > self.none)
        many = np.flatnonzero(ok.sum(1) > 2 * self.k)
        if len(many):  # the k best of a part, smaller ids first; nothing below them counts from here on
            some = got[many]
            kth = np.partition(some, some.shape[1] - self.k, axis=1)[:, -self.k]
            above, equal = some > kth[:, None], some == kth[:, None]
            ok[many] = above | equal & (np.cumsum(equal, axis=1) <= self.k - above.sum(1)[:, None])
            np.maximum.at(self.reach, who[many], kth)
        q, c = np.nonzero(ok)
        self.found.append((who[q], others[start[q] + c], got[q, c].astype(np.int64)))
        self.count += len(q)

    def _cut(self) -> None:
        """Keeps the k best of each query."""
        q, v, s = (np.concatenate(c) for c in zip(*self.found, strict=True))
        order = np.lexsort((v, -s, q))
        q, v, s = q[order], v[order], s[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q, "left")
        last = rank == self.k - 1
        self.reach[q[last]] = s[last].astype(self.kind)
        stay = rank < self.k
        self.found, self.count = [(q[stay], v[stay], s[stay])], int(stay.sum())

    def best(self) -> pa.RecordBatch:
        if self.found:
            self._cut()
        q, v, s = self.found[0] if self.found else (np.zeros(0, np.int64),) * 3
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids[q]), pa.array(v), pa.array(s)], names=["query_id", "vec_id", "score"])


def search(queries: DataFrame, index: Index | None, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all indexed rows for each query."""
    spark = queries.sparkSession
    schema = "query_id long, rank int, vec_id long, score long"
    if index is None:
        return spark.createDataFrame([], schema)
    # a batch for Python ends once it has some blocks and queries, so a worker holds few at a time
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    width, light = index.width, Index(None, index.pivots, index.annuli, index.width, index.keys)
    first, upto = index.annuli["first"], index.annuli["first"] + index.annuli["parts"]
    inside = [np.flatnonzero((first <= b) & (b < upto)) for b in range(len(index.keys))]
    of_key = dict(zip(index.keys, inside, strict=True))
    longest = float(np.sqrt(index.annuli["norm"].max())) * (1 + 1e-9)
    rows_of_block = max(1, min(QUERY_BLOCK, BLOCK_NUMBERS // max(1, width)))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            o = _bounds(_matrix(batch.column("v"), width), light).argmax(1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(o)], names=["query_id", "v", "o"])

    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of the batches in as few batches as may be."""
        held = []
        for batch in batches:
            for at in range(0, len(batch), rows_of_block):
                part = batch.slice(at, rows_of_block)
                if sum(map(len, held)) + len(part) > rows_of_block:
                    yield pa.concat_batches(held)
                    held = []
                held.append(part)
        if held:
            yield pa.concat_batches(held)

    def expand(before: float, quota: float):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number = TaskContext.get().partitionId() << 32
            for part in packs(batches):
                ids = part.column("query_id").to_numpy(zero_copy_only=False).astype(np.int64)
                x = _matrix(part.column("v"), width)
                least = part.column("least").fill_null(LOWEST).to_numpy(zero_copy_only=False).astype(np.int64)
                bound = _bounds(x, light)
                order = np.argsort(-bound, axis=1, kind="stable")
                place = np.argsort(order, axis=1, kind="stable")
                sizes = np.cumsum(light.annuli["n"][order], axis=1)
                done = (sizes < before).sum(1) + 1 if before else np.zeros(len(x), np.int64)
                # fewer than k found so far: every bound reaches
                reaches = (least == LOWEST)[:, None] | ~(bound < least[:, None].astype(np.float64))
                need = reaches & (place >= done[:, None]) & (place <= (sizes < quota).sum(1)[:, None])
                x = x.astype(_narrow(int(x.min(initial=0)), int(x.max(initial=0))))
                rows, size = [], 0
                for b, key in enumerate(light.keys):
                    here = need[:, inside[b]]
                    who = np.flatnonzero(here.any(1))
                    if not len(who):
                        continue
                    rows.append((
                        key, number, ids[who].tobytes(), x[who].tobytes(), least[who].tobytes(),
                        np.packbits(here[who]).tobytes()))
                    number, size = number + 1, size + sum(map(len, rows[-1][2:]))
                    if size >= SENT_BYTES:
                        yield sent(rows)
                        rows, size = [], 0
                if rows:
                    yield sent(rows)
        return run

    kinds = {"s": pa.int32(), "g": pa.int64(), "ids": pa.binary(), "x": pa.binary(), "least": pa.binary(), "need": pa.binary()}

    def sent(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.values(), strict=True)], names=list(kinds))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, last = None, None
        for batch in batches:
            of = {name: batch.column(name) for name in batch.schema.names}
            for i in range(len(batch)):
                places = of_key[of["s"][i].as_py()]
                if met is None or of["g"][i].as_py() != last:
                    if met is not None:
                        yield met.best()
                    last, ids = of["g"][i].as_py(), _ids(of["ids"][i])
                    bits = np.unpackbits(np.frombuffer(of["need"][i].as_buffer(), np.uint8), count=len(ids) * len(places))
                    met = _Met(
                        ids, _unpacked(of["x"][i], len(ids), width), _ids(of["least"][i]),
                        bits.reshape(len(ids), len(places)).astype(bool), longest, k)
                others = _ids(of["others"][i])
                met.meet(
                    int(np.searchsorted(light.annuli["a"][places], of["a"][i].as_py())), others,
                    _unpacked(of["y"][i], len(others), width))
        if met is not None:
            yield met.best()

    state = queries.select(F.col("vec_id").alias("query_id"), "v").distinct()
    state = stage(state.mapInArrow(nearest, "query_id long, v array<long>, o int"), "queries")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    rows_in_all = int(index.annuli["n"].sum())
    before, quota = 0.0, max(float(FIRST_ROWS), rows_in_all / len(index.annuli["n"]))
    results = spark.createDataFrame([], "query_id long, vec_id long, score long")
    asking = state.withColumn("least", F.lit(None).cast("long"))
    last = False
    while not last:
        last = quota >= rows_in_all
        near = asking.orderBy("o", "query_id").select("query_id", "v", "least")  # queries that need the same annuli
        wanted = near.mapInArrow(expand(before, quota), "s int, g long, ids binary, x binary, least binary, need binary")
        met = wanted.hint("merge").join(index.blocks, "s")
        scored = met.select("s", *list(kinds)[1:], "a", "others", "y").mapInArrow(score, "query_id long, vec_id long, score long")
        merged = results.unionByName(scored).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        results = stage(merged.select("query_id", "vec_id", "score"), "best")
        kth = results.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("least"))
        asking = state.join(kth.hint("merge"), "query_id", "left")
        before, quota = quota, quota * GROWTH
    return results.select(
        "query_id", F.row_number().over(best).cast("int").alias("rank"), "vec_id", "score")


def every(id_col: Column, n: int) -> Column:
    return F.pmod(id_col, F.lit(n)) == 0


#: Brute force over all rows.
SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(coalesce(list_sum([q.e[i] * c.e[i] for i in range(1, least(len(q.e), len(c.e)) + 1)]), 0)
      AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score
FROM s QUALIFY rank <= 10
"""
