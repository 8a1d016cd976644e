"""Texts in chunks, and counts of keys over all chunks brought back to each.

A chunk is a row with an array of whole rows of the input, some megabytes of text.
Chunks are stored once, bucketed by their number, so later passes over the corpus
join small tables to them without moving a text.

`exchange` counts keys: every chunk gives its own distinct 64-bit keys with numbers,
cut by their leading bits into ranges; a range adds up the numbers of equal keys over
all chunks, and every chunk gets back, in the order of its own keys, the totals.
What moves is a few bytes for each distinct key of a chunk, in both directions; a
key that is in every row is in each chunk once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adperf.llm import textvec
from adperf.sources.staging import stage, staging_root

#: Text bytes of a chunk, and rows at most; a longer text makes a longer chunk.
CHUNK_BYTES, CHUNK_ROWS = 5 << 19, 50_000
BATCH_BYTES = "4m"
#: Keys of a range, all chunks together, that a task should handle at once.
RANGE_KEYS = 1_000_000


def cut(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """chunk, bytes (of text) and rows (array of rows of `docs`), stored and bucketed by chunk."""
    # a batch for Python ends once it has one chunk, so a worker holds few at a time
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    fields = docs.schema.fields
    at = [f.name for f in fields].index(text_col)
    inner = T.StructType([T.StructField(f"f{i}", f.dataType) for i, f in enumerate(fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32

        def pack(parts: list[pa.RecordBatch], size: int) -> pa.RecordBatch:
            table = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            rows = pa.StructArray.from_arrays(table.columns, names=[f"f{i}" for i in range(len(fields))])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()), pa.array([size], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows),
                ],
                names=["chunk", "bytes", "rows"],
            )

        held: list[pa.RecordBatch] = []
        size = count = 0
        for batch in batches:
            _, ends = textvec.text_bytes(batch.column(at))
            for a, b in textvec.blocks(ends, CHUNK_BYTES // 4):
                held.append(batch.slice(a, b - a))
                size, count = size + int(ends[b] - ends[a]), count + b - a
                if size >= CHUNK_BYTES or count >= CHUNK_ROWS:
                    yield pack(held, size)
                    held, size, count, number = [], 0, 0, number + 1
        if held:
            yield pack(held, size)

    named = docs.select(*[F.col(f"`{f.name}`").alias(f"f{i}") for i, f in enumerate(fields)])
    schema = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("bytes", T.LongType()), T.StructField("rows", T.ArrayType(inner)),
    ])
    return bucketed(named.mapInArrow(run, schema), "chunk")


def bucketed(df: DataFrame, key: str, buckets: int | None = None) -> DataFrame:
    """The frame as a stored table, bucketed by the key, in the shared folder; as many buckets as shuffle partitions, if not said."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"adperf_{uuid.uuid4().hex[:12]}"
    path = f"{staging_root(spark)}/{name}"
    df.write.bucketBy(buckets, key).option("path", path).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def texts_of(chunk_rows: pa.Array, i: int, field: str) -> pa.Array:
    """One field of the rows of chunk `i` of a batch, without a copy."""
    start, stop = chunk_rows.offsets[i].as_py(), chunk_rows.offsets[i + 1].as_py()
    return chunk_rows.values.field(field).slice(start, stop - start)


Keys = Callable[[pa.RecordBatch, int], dict[str, tuple[np.ndarray, list[np.ndarray]]]]


def exchange(
    chunks: DataFrame, keys: Keys, kinds: dict[str, str], expected: float
) -> DataFrame:
    """chunk and, per kind, the packed totals of its keys: a map of kind to a list of blobs.

    `keys(batch, i)` gives for chunk i of a batch, per kind, ascending distinct keys
    and one or more arrays of numbers.  `kinds` says how each kind adds up: "sum", or
    "first" for the smallest pair of its two numbers.  `expected` is about the number
    of keys over all chunks.
    """
    bits = max(0, int(np.ceil(np.log2(max(1, expected / RANGE_KEYS)))))
    widths = dict(kinds)

    def packed(batch: pa.RecordBatch, i: int) -> list[pa.RecordBatch]:
        out, chunk = [], batch.column("chunk")[i].as_py()
        for kind, (found, numbers) in keys(batch, i).items():
            cuts = np.searchsorted(found, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) \
                if bits else np.zeros(0, np.int64)
            edges = np.concatenate([[0], cuts, [len(found)]])
            some = [r for r in range(len(edges) - 1) if edges[r + 1] > edges[r]]
            out.append(pa.RecordBatch.from_arrays(
                [
                    pa.array([kind] * len(some), pa.string()),
                    pa.array(some, pa.int32()),
                    pa.array([chunk] * len(some), pa.int64()),
                    pa.array([textvec.pack_sorted(found[edges[r] : edges[r + 1]]) for r in some], pa.binary()),
                    pa.array(
                        [[textvec.pack_counts(x[edges[r] : edges[r + 1]]) for x in numbers] for r in some],
                        pa.list_(pa.binary()),
                    ),
                ],
                names=["kind", "range", "chunk", "keys", "numbers"],
            ))
        return out

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                yield from packed(batch, i)  # what it needs is free before the next chunk
                textvec.release()

    schema = "kind string, range int, chunk long, keys binary, numbers array<binary>"
    out = (
        "kind string, range int, chunk long, totals array<binary>, distinct long, distinct_any long, sums array<long>")

    def add(table: pa.Table) -> pa.Table:
        textvec.release()
        kind, part = table["kind"][0].as_py(), table["range"][0].as_py()
        found = [textvec.unpack_sorted(x.as_py()) for x in table["keys"]]
        unique = np.unique(np.concatenate(found))
        places = [np.searchsorted(unique, x) for x in found]
        numbers = [
            [textvec.unpack_counts(x[j].as_py()) for x in table["numbers"]] for j in range(len(table["numbers"][0]))]
        if widths[kind] == "first":
            columns = [np.full(len(unique), np.iinfo(np.uint64).max, np.uint64) for _ in range(2)]
            for at, high, low in zip(places, *numbers, strict=True):
                old, last = columns[0][at], columns[1][at]
                less = (high < old) | ((high == old) & (low < last))
                columns[0][at], columns[1][at] = np.where(less, high, old), np.where(less, low, last)
        else:
            columns = [np.zeros(len(unique), np.uint64) for _ in numbers]
            for total, values in zip(columns, numbers, strict=True):
                for at, x in zip(places, values, strict=True):
                    total[at] += x  # the keys of one chunk are distinct
        n = len(found)
        sums = [int(c.sum()) if widths[kind] == "sum" else 0 for c in columns]
        seen, any_seen = int((columns[0] > 0).sum()), int(np.any([c > 0 for c in columns], axis=0).sum())
        return pa.table({
            "kind": pa.array([kind] * n, pa.string()),
            "range": pa.array([part] * n, pa.int32()),
            "chunk": table["chunk"].combine_chunks(),
            "totals": pa.array([[textvec.pack_counts(c[at]) for c in columns] for at in places], pa.list_(pa.binary())),
            # the range's own figures stand in its first row only
            "distinct": pa.array([seen] + [0] * (n - 1), pa.int64()),
            "distinct_any": pa.array([any_seen] + [0] * (n - 1), pa.int64()),
            "sums": pa.array([sums] + [[0] * len(sums)] * (n - 1), pa.list_(pa.int64())),
        })

    moved = chunks.mapInArrow(emit, schema)
    return stage(moved.groupBy("kind", "range").applyInArrow(add, out), "totals")


def returned(chunks: DataFrame, totals: DataFrame) -> DataFrame:
    """The chunks with `back`: per kind and range the packed totals, in order.  Stored by chunk, so each pass reads them."""
    back = totals.groupBy("chunk").agg(
        F.array_sort(F.collect_list(F.struct("kind", "range", "totals"))).alias("back"))
    return chunks.join(bucketed(back, "chunk"), "chunk", "left")


def totals_of(back: pa.Array, i: int, kind: str) -> list[np.ndarray]:
    """The totals of one kind for chunk i, in the order of that chunk's keys."""
    parts = [r for r in (back[i].as_py() or []) if r["kind"] == kind]
    if not parts:
        return []
    return [
        np.concatenate([textvec.unpack_counts(r["totals"][j]) for r in parts])
        for j in range(len(parts[0]["totals"]))
    ]


def text_bytes(chunks: DataFrame) -> int:
    """Bytes of all texts."""
    return chunks.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
