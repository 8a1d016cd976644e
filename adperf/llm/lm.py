"""Scores of an n-gram language model by deleted interpolation.

Counts of n-grams of every order up to ORDER are taken over all training documents.
The probability of a token mixes the maximum-likelihood estimates of all orders and
a uniform one; the weights depend on how often the token's context was seen (one set
per power of two) and are learned by expectation-maximisation on a part of the
training documents that the counts mixed there leave out.

Counting and scoring work on chunks of texts: each chunk's distinct n-grams are added
up over all chunks, the totals come back in the chunk's own order, and texts stay
where they are (see `chunks`).  Expectation-maximisation passes over the left-out
tokens, as many bytes as there are distinct cases, and gathers one sum per context
class and order.

Defined cases: null and empty texts have one token, the end; a null id has the
remainder of an empty text, so it trains; repeated rows train as often as they occur
and get equal scores; without training tokens all probabilities are uniform; without
left-out tokens the weights stay equal; an empty table gives no rows; texts are read
whole; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adperf.llm import chunks as C
from adperf.llm import textvec
from adperf.sources.staging import stage

ORDER = 2
FOLDS = 7
#: Folds by crc32 of the id: one is never learned from, one trains the weights first.
HELD_OUT, DELETED = 2, 3
MAX_STEPS, TOLERANCE = 25, 1e-4
CLASSES = 48

END, START = (textvec.mix(np.array([x], np.uint64))[0] for x in (0xE0D, 0x57A27))


def fold(doc_id: int | None) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS


class Tokens:
    """The tokens of a chunk and their n-gram keys."""

    def __init__(self, batch: pa.RecordBatch, i: int, order: int) -> None:
        rows = batch.column("rows")
        self.ids = C.texts_of(rows, i, "f0")
        flat, offsets = textvec.text_bytes(C.texts_of(rows, i, "f1"))
        parts = [textvec.words(flat[offsets[a] : offsets[b]], offsets[a : b + 1]) for a, b in textvec.blocks(offsets)]
        counts = np.concatenate([c for _, c in parts]) if parts else np.zeros(0, np.int64)
        words = np.concatenate([h for h, _ in parts]) if parts else np.zeros(0, np.uint64)
        self.sizes = counts + 1
        stops = np.cumsum(self.sizes)
        self.first = stops - self.sizes
        token = np.empty(int(self.sizes.sum()), np.uint64)
        last = np.zeros(len(token), bool)
        last[stops - 1] = True
        token[last], token[~last] = END, words
        self.folds = np.array([fold(x) for x in self.ids.to_pylist()], np.int64)
        self.keys = [token]
        for _ in range(order - 1):  # one token further back each time, or the start
            shorter = self.keys[-1]
            before = np.empty_like(token)
            before[1:] = shorter[:-1]
            before[self.first] = START
            # the key of a context does not depend on what is before a text's start
            self.keys.append(textvec.mix(before * np.uint64(0x9FB21C651E98DF25) + token))

    def fold_of_tokens(self) -> np.ndarray:
        return np.repeat(self.folds, self.sizes)


def count_keys(order: int):
    def keys(batch: pa.RecordBatch, i: int) -> dict[str, tuple[np.ndarray, list[np.ndarray]]]:
        tokens = Tokens(batch, i, order)
        folds = tokens.fold_of_tokens()
        kept, deleted = (folds != HELD_OUT) & (folds != DELETED), folds == DELETED
        out = {}
        for n, key in enumerate(tokens.keys, 1):
            unique, place = np.unique(key, return_inverse=True)
            out[str(n)] = (unique, [
                np.bincount(place[part], minlength=len(unique)).astype(np.uint64) for part in (kept, deleted)])
        return out

    return keys


def _looked_up(batch: pa.RecordBatch, i: int, order: int) -> tuple[Tokens, list[list[np.ndarray]]]:
    """The chunk's tokens and, per order, the (kept, deleted) totals of each token's n-gram."""
    tokens = Tokens(batch, i, order)
    found = []
    for n, key in enumerate(tokens.keys, 1):
        place = np.unique(key, return_inverse=True)[1]
        found.append([t[place].astype(np.float64) for t in C.totals_of(batch.column("back"), i, str(n))])
    return tokens, found


def _estimates(
    tokens: Tokens, counts: list[np.ndarray], total: float, documents: float, vocabulary: float
) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood estimates (orders from the highest, then uniform) and context class of each token."""
    n = len(tokens.keys[0])
    estimates = []
    context = np.full(n, total)
    for k, count in enumerate(counts):
        if k:
            context = np.empty(n)
            context[1:] = counts[k - 1][:-1]
            context[tokens.first] = documents
        estimates.append(np.divide(count, context, out=np.zeros(n), where=context > 0))
    classes = np.zeros(n, np.int64)
    seen = context > 0
    classes[seen] = np.minimum(np.floor(np.log2(context[seen])).astype(np.int64) + 1, CLASSES - 1)
    return np.stack([*estimates[::-1], np.full(n, 1 / (vocabulary + 1))]), classes


def learn_weights(
    cases: DataFrame, order: int, max_steps: int = MAX_STEPS, tolerance: float = TOLERANCE
) -> tuple[np.ndarray, list[float]]:
    """Weights (CLASSES x estimates) and the log likelihood of each step.

    `cases` has rows of packed arrays: class, times and the estimates of left-out tokens.
    """
    width = order + 1
    weights = np.full((CLASSES, width), 1 / width)
    trace: list[float] = []
    for _ in range(max_steps):
        now = weights

        def share(batches: Iterator[pa.RecordBatch], now: np.ndarray = now) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sums, likelihood = np.zeros((CLASSES, width)), 0.0
                for classes, times, estimates in zip(*batch.columns, strict=True):
                    c = np.frombuffer(classes.as_py(), np.uint8).astype(np.int64)
                    t = np.frombuffer(times.as_py(), np.float64)
                    parts = now[c].T * np.frombuffer(estimates.as_py(), np.float64).reshape(width, len(c))
                    whole = parts.sum(0)
                    likelihood += float((t * np.log(whole)).sum())
                    for j in range(width):
                        sums[:, j] += np.bincount(c, t * parts[j] / whole, CLASSES)
                rows = [(k, *map(float, sums[k])) for k in range(CLASSES) if sums[k].any()]
                rows.append((-1, likelihood, *[0.0] * (width - 1)))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int32()), *[pa.array(x, pa.float64()) for x in cols[1:]]],
                    names=["class", *[f"s{j}" for j in range(width)]],
                )

        schema = "class int, " + ", ".join(f"s{j} double" for j in range(width))
        added = cases.mapInArrow(share, schema).groupBy("class").agg(
            *[F.sum(f"s{j}").alias(f"s{j}") for j in range(width)]).collect()  # one row per class
        weights = weights.copy()
        trace.append(0.0)
        for row in added:
            if row["class"] < 0:
                trace[-1] = row["s0"]
            else:
                s = np.array([row[f"s{j}"] for j in range(width)])
                weights[row["class"]] = s / s.sum()
        if len(trace) > 1 and trace[-1] - trace[-2] <= tolerance * abs(trace[-2]):
            break
    return weights, trace


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    chunks = C.cut(rows)
    totals = C.exchange(
        chunks, count_keys(order), {str(n): "sum" for n in range(1, order + 1)}, C.text_bytes(chunks) / 8)
    first = totals.filter("kind = '1'").agg(
        F.sum("distinct"), F.sum("distinct_any"), F.sum(F.col("sums")[0]), F.sum(F.col("sums")[1])).first()
    kept_total, deleted_total = float(first[2] or 0), float(first[3] or 0)
    train = kept_total + deleted_total
    everything = C.returned(chunks, totals)
    train_docs, kept_docs = _documents(rows)
    vocabulary, kept_words = float(first[1] or 0), float(first[0] or 0)

    # one chunk at a time in a function of its own, so that its arrays are free before the next
    def case(batch: pa.RecordBatch, i: int) -> pa.RecordBatch:
        tokens, found = _looked_up(batch, i, order)
        part = tokens.fold_of_tokens() == DELETED
        p, c = _estimates(tokens, [f[0] for f in found], kept_total, kept_docs, kept_words)
        table = np.concatenate([c[part][None].astype(np.float64), p[:, part]])
        by_value = np.lexsort(table)
        table = table[:, by_value]
        new = np.ones(table.shape[1], bool)
        new[1:] = (table[:, 1:] != table[:, :-1]).any(0)
        starts = np.flatnonzero(new)
        times = np.diff(np.append(starts, table.shape[1])).astype(np.float64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([table[0, starts].astype(np.uint8).tobytes()]), pa.array([times.tobytes()]),
                pa.array([np.ascontiguousarray(table[1:, starts]).tobytes()]),
            ],
            names=["classes", "times", "estimates"],
        )

    def cases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                yield case(batch, i)
                textvec.release()

    columns = everything.select("chunk", "rows", "back")
    left_out = stage(columns.mapInArrow(cases, "classes binary, times binary, estimates binary"), "cases")
    weights, _ = learn_weights(left_out, order)

    def one(batch: pa.RecordBatch, i: int) -> pa.RecordBatch:
        tokens, found = _looked_up(batch, i, order)
        counts = [f[0] + f[1] for f in found]
        del found
        p, c = _estimates(tokens, counts, train, train_docs, vocabulary)
        mixed = np.log10((weights[c].T * p).sum(0))
        base = np.log10((counts[0] + 1) / (train + vocabulary + 1))
        at = tokens.first
        return pa.RecordBatch.from_arrays(
            [
                tokens.ids, pa.array(tokens.folds == HELD_OUT), pa.array(tokens.sizes),
                pa.array(np.add.reduceat((counts[0] > 0).astype(np.int64), at)),
                pa.array(np.full(len(at), int(train))),
                pa.array(np.add.reduceat(base, at)), pa.array(np.add.reduceat(mixed, at)),
            ],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                yield one(batch, i)
                textvec.release()

    return columns.mapInArrow(scored, (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))


def _documents(rows: DataFrame) -> tuple[float, float]:
    """Documents that train, and those of them that the first counts keep."""
    folds = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))
    counted = rows.select(folds.alias("f")).groupBy("f").count().collect()  # one row per fold
    sizes = {r["f"]: r["count"] for r in counted}
    train = sum(n for f, n in sizes.items() if f != HELD_OUT)
    return float(train), float(train - sizes.get(DELETED, 0))
