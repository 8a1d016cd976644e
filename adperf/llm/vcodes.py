"""Product codes of vectors: one codebook entry for each part of a vector, all in whole numbers.

A vector is cut into equal parts.  Each part position has a codebook that begins with the
parts of the smallest ids and is moved for some rounds: every part goes to its nearest
entry, and an entry to the rounded-down mean of its parts.

Vectors stay where they are, in chunks of some megabytes, stored once.  Within a chunk
the points of each part position are sorted along a Hilbert curve and cut into flat
blocks of BLOCK points with the box around them (least and greatest components) and their
sums.  In a round, an entry whose least distance to a block's box is beyond the smallest
of all greatest distances is nearest to none of its points; what is left is the block's
shortlist.  A shortlist of one takes the whole block by its sums, without a look at its
points; any other is evaluated by an exact kernel over the few entries that are left.  A
task adds up all its chunks, so a round moves entries, not vectors, and brings
parts x entries sums to the driver.

Defined cases: vectors that are null or hold null, NaN or infinite components take no
part; shorter vectors are filled with zeros up to the longest, and that to a multiple of
the parts; components beyond 2 ** 52 after scaling count as that, and an error beyond 64
bits as the greatest long; equal ids begin in the order of their vectors, null ids last;
fewer vectors than entries give fewer entries; equal distances go to the lower entry;
repeated rows count as often as they occur; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adperf.operators.spread import attach_stats
from adperf.sources.staging import stage

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
#: Components of a chunk, and points of a block.
CHUNK_NUMBERS, BLOCK = 1 << 22, 128
#: Components count as this at most, so that a block's sums are whole in 64 bits.
LIMIT = float(1 << 52)
MOST = (1 << 63) - 1
HILBERT_BITS, CURVE_BITS = 10, 62


def whole_vectors(
    rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", scale: int = SCALE
) -> DataFrame:
    """vec_id, label, v: components times `scale`, rounded down; rows that take part only."""
    v = F.transform(F.col(f"`{vec_col}`"), lambda x: x.cast("double"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    picked = rows.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").alias("label"), v.alias("v"))
    held = F.transform("v", lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(LIMIT)), F.lit(-LIMIT))))
    return picked.filter(F.col("v").isNotNull() & ~bad).select("vec_id", "label", held.alias("v"))


# ---------------------------------------------------------------- the order and the blocks


def hilbert_order(points: np.ndarray) -> np.ndarray:
    """Order of points (rows) along a Hilbert curve through their box."""
    low, high = points.min(0).astype(np.float64), points.max(0).astype(np.float64)
    widest = np.argsort(low - high, kind="stable")[:CURVE_BITS]  # a curve through the widest sides
    dims = len(widest)
    bits = max(1, min(HILBERT_BITS, CURVE_BITS // dims))
    span = np.maximum(high - low, 1.0)[widest]
    cells = ((points[:, widest] - low[widest]) / span * ((1 << bits) - 1)).astype(np.int64)
    # from the coarsest bit down, undo the turn that the curve makes in the cell reached so far
    x = [cells[:, d].copy() for d in range(dims)]
    for bit in range(bits - 1, 0, -1):
        below = (1 << bit) - 1
        for d in range(dims):
            far = (x[d] >> bit & 1).astype(bool)
            swap = np.where(far, 0, (x[0] ^ x[d]) & below)
            x[0] ^= swap
            x[0] ^= np.where(far, below, 0)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros(len(points), np.int64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> bit & 1, (1 << bit) - 1, 0)
    key = np.zeros(len(points), np.int64)
    for bit in range(bits - 1, -1, -1):
        for d in range(dims):
            key = key << 1 | (x[d] ^ turn) >> bit & 1
    return np.argsort(key, kind="stable")


def boxes(points: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least and greatest components and sums of each block of sorted points."""
    starts = np.arange(0, len(points), block)
    return tuple(f.reduceat(points, starts, axis=0) for f in (np.minimum, np.maximum, np.add))


def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Which entries can be nearest to a point of each block: blocks x entries."""
    below, above = low[:, None] - entries[None], entries[None] - high[:, None]
    least = np.maximum(np.maximum(below, above), 0)
    most = np.maximum(np.abs(below), np.abs(above))  # the farther side of the box
    bound = (most * most).sum(2).min(1)
    return (least * least).sum(2) <= bound[:, None]


class Part:
    """One part position of a chunk: sorted points with the boxes and sums of their blocks."""

    def __init__(self, points: np.ndarray, block: int) -> None:
        self.points, self.block = points, block
        self.low, self.high, self.sums = boxes(points, block)

    def assign(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the only entry of each block's shortlist or -1, nearest entries of the points)."""
        listed = shortlists(self.low, self.high, entries)
        single = np.where(listed.sum(1) == 1, listed.argmax(1), -1)
        near = np.repeat(single, self.block)[: len(self.points)]
        for b in np.flatnonzero(single < 0):
            some = np.flatnonzero(listed[b])  # ascending, so the lower of equally near ones is first
            here = slice(b * self.block, (b + 1) * self.block)
            gap = self.points[here][:, None] - entries[some][None]
            near[here] = some[(gap * gap).sum(2).argmin(1)]
        return single, near

    def tally(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and sums of the points of each entry."""
        single, near = self.assign(entries)
        count = np.bincount(near, minlength=len(entries)).astype(np.int64)
        sums = np.zeros(entries.shape, self.points.dtype)
        whole = np.flatnonzero(single >= 0)
        np.add.at(sums, single[whole], self.sums[whole])
        rest = np.flatnonzero(np.repeat(single < 0, self.block)[: len(near)])
        np.add.at(sums, near[rest], self.points[rest])
        return count, sums

    def errors(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entries and squared distances to them."""
        near = self.assign(entries)[1]
        gap = self.points - entries[near]
        return near, (gap * gap).sum(1)


def _number(values: np.ndarray, width: int) -> np.ndarray:
    """In 64 bits if all squared distances fit, else as whole numbers of any size."""
    most = int(np.abs(values).max(initial=0))
    return values if width * (2 * most) ** 2 < 1 << 62 and len(values) * most < 1 << 62 else values.astype(object)


class Codes:
    """Chunks of vectors in Hilbert order, and the codebooks: parts x entries x components."""

    def __init__(self, chunks: DataFrame, codebooks: np.ndarray, width: int, block: int) -> None:
        self.chunks, self.codebooks, self.width, self.block = chunks, codebooks, width, block

    def digest(self) -> str:
        """Digest of all entries' components in order."""
        return hashlib.sha256(",".join(str(int(x)) for x in self.codebooks.ravel()).encode()).hexdigest()


def _chunks(vectors: DataFrame, width: int, parts: int, numbers: int) -> DataFrame:
    """ids, labels, and for each part the order of the rows and the points in that order."""
    label = vectors.schema["label"].dataType.simpleString()
    limit = max(1, numbers // width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pack(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            v = rows["v"].combine_chunks()
            sizes = pc.list_value_length(v).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = v.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            x = np.zeros((len(sizes), width), np.int64)
            at = np.repeat(np.arange(len(sizes)), sizes)
            x[at, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
            points = x.reshape(len(x), parts, width // parts).transpose(1, 0, 2)
            orders = [hilbert_order(p) for p in points]
            most = int(np.abs(x).max(initial=0))
            kind = next(k for k in (np.int16, np.int32, np.int64) if most <= np.iinfo(k).max)
            one = pa.array([0, len(x)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(one, rows["vec_id"].combine_chunks()),
                    pa.ListArray.from_arrays(one, rows["label"].combine_chunks()),
                    pa.array([np.dtype(kind).itemsize], pa.int32()),
                    pa.array([[o.astype(np.int32).tobytes() for o in orders]], pa.list_(pa.binary())),
                    pa.array([[p[o].astype(kind).tobytes() for p, o in zip(points, orders, strict=True)]], pa.list_(pa.binary())),
                ],
                names=["ids", "labels", "bytes", "orders", "points"],
            )

        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            at = 0
            while at < len(batch):
                part = batch.slice(at, limit - size)
                held.append(part)
                size, at = size + len(part), at + len(part)
                if size == limit:
                    yield pack(held)
                    held, size = [], 0
        if held and size:
            yield pack(held)

    schema = f"ids array<bigint>, labels array<{label}>, bytes int, orders array<binary>, points array<binary>"
    return stage(vectors.mapInArrow(run, schema), "chunks")


def _parts(batch: pa.RecordBatch, i: int, width: int, block: int, book: np.ndarray) -> Iterator[tuple[np.ndarray, Part, np.ndarray]]:
    """Per part position the order of the rows, the points and the entries."""
    kind = {2: np.int16, 4: np.int32, 8: np.int64}[batch.column("bytes")[i].as_py()]
    for p, (order, points) in enumerate(
        zip(batch.column("orders")[i].as_py(), batch.column("points")[i].as_py(), strict=True)
    ):
        x = np.frombuffer(points, kind).astype(np.int64).reshape(-1, width // len(book))
        both = _number(np.concatenate([x, book[p].astype(np.int64)]), width)
        yield np.frombuffer(order, np.int32), Part(both[: len(x)], block), both[len(x) :]


def _round(codes: Codes) -> np.ndarray:
    """The codebooks after one round."""
    book, width, block = codes.codebooks, codes.width, codes.block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(book.shape[:2], np.int64), np.zeros(book.shape, object)
        for batch in batches:
            for i in range(len(batch)):
                for p, (_, part, entries) in enumerate(_parts(batch, i, width, block, book)):
                    n, s = part.tally(entries)
                    counts[p] += n
                    sums[p] += s
        used = np.argwhere(counts > 0)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used[:, 0].astype(np.int32)), pa.array(used[:, 1].astype(np.int32)),
                pa.array([int(counts[p, e]) for p, e in used], pa.int64()),
                pa.array([[str(int(x)) for x in sums[p, e]] for p, e in used], pa.list_(pa.string())),
            ],
            names=["part", "entry", "n", "sums"],
        )

    told = codes.chunks.select("bytes", "orders", "points").mapInArrow(run, "part int, entry int, n long, sums array<string>")
    long = told.select("part", "entry", "n", F.posexplode("sums").alias("at", "s"))
    totals = long.groupBy("part", "entry", "at").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    moved = book.copy()
    for r in totals.collect():  # parts x entries x components of a part at most
        moved[r["part"], r["entry"], r["at"]] = int(r["s"]) // r["n"]
    return moved


def train(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
    block: int = BLOCK, chunk_numbers: int = CHUNK_NUMBERS,
) -> Codes | None:
    """Codebooks of `whole_vectors`; None if there are none."""
    vectors = stage(vectors, "vectors")
    longest = vectors.agg(F.max(F.size("v"))).first()[0]
    if longest is None:
        return None
    width = max(1, -(-longest // parts)) * parts
    first = vectors.orderBy(F.asc_nulls_last("vec_id"), "v").select("v").limit(entries).collect()  # at most `entries` rows
    book = np.zeros((len(first), width), np.int64)
    for i, row in enumerate(first):
        book[i, : len(row["v"])] = row["v"]
    book = np.ascontiguousarray(book.reshape(len(first), parts, width // parts).transpose(1, 0, 2))
    codes = Codes(_chunks(vectors, width, parts, chunk_numbers), book, width, block)
    for _ in range(rounds):
        codes = Codes(codes.chunks, _round(codes), width, block)
    return codes


def encode(codes: Codes) -> DataFrame:
    """vec_id, label, codes (an entry for each part), error (squared distance) of every vector."""
    book, width, block = codes.codebooks, codes.width, codes.block
    label = codes.chunks.schema["labels"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                n = len(batch.column("ids")[i].values)
                found, error = np.zeros((n, len(book)), np.int32), np.zeros(n, object)
                for p, (order, part, entries) in enumerate(_parts(batch, i, width, block, book)):
                    near, far = part.errors(entries)
                    found[order, p] = near
                    error[order] += far
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ids")[i].values, batch.column("labels")[i].values,
                        pa.ListArray.from_arrays(
                            pa.array((np.arange(n + 1) * len(book)).astype(np.int32)), pa.array(found.ravel())),
                        pa.array([min(int(e), MOST) for e in error], pa.int64()),
                    ],
                    names=["vec_id", "label", "codes", "error"],
                )

    return codes.chunks.mapInArrow(run, f"vec_id long, label {label}, codes array<int>, error long")


def coded(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every vector."""
    codes = train(vectors, **options)
    if codes is None:
        empty = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
        return vectors.sparkSession.createDataFrame([], empty)
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    rows = stage(encode(codes).withColumn("code", code).drop("codes"), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST).cast("decimal(38,0)")).cast("long")
    return attach_stats(rows, ["label"], [total.alias("label_error")]).select(
        "vec_id", "code", "error", "label_error", F.lit(codes.digest()).alias("codebooks_sha256"))


def _assigned(book: str) -> str:
    return f"""
  SELECT x.rn, x.p, min([list_sum([(x.x[i] - c.x[i]) * (x.x[i] - c.x[i]) for i in range(1, len(x.x) + 1)]), c.e]) AS best
  FROM pt x JOIN {book} c USING (p) GROUP BY x.rn, x.p"""


def _moved(book: str, assigned: str) -> str:
    return f"""
  SELECT c.p, c.e, coalesce(m.x, c.x) AS x FROM {book} c LEFT JOIN (
    SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM (
      SELECT p, e, i, CAST(sum(v) AS BIGINT) AS s, count(*) AS n FROM (
        SELECT x.p, a.best[2] AS e, unnest(x.x) AS v, unnest(range(len(x.x))) AS i
        FROM pt x JOIN {assigned} a USING (rn, p)) GROUP BY p, e, i) GROUP BY p, e) m ON m.p = c.p AND m.e = c.e"""


#: All distances, round by round.
SQL = f"""
WITH k AS (
  SELECT vec_id, label, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
r AS (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS rn FROM k),
pt AS (
  SELECT rn, p, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS x
  FROM r, (SELECT unnest(range({PARTS})) AS p)),
c0 AS (SELECT p, rn AS e, x FROM pt WHERE rn < {ENTRIES}),
a0 AS ({_assigned('c0')}),
c1 AS ({_moved('c0', 'a0')}),
a1 AS ({_assigned('c1')}),
c2 AS ({_moved('c1', 'a1')}),
a2 AS ({_assigned('c2')}),
o AS (
  SELECT rn, string_agg(lpad(lower(hex(best[2])), 2, '0'), '' ORDER BY p) AS code, CAST(sum(best[1]) AS BIGINT) AS error
  FROM a2 GROUP BY rn),
b AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM r JOIN o USING (rn) CROSS JOIN b
"""
