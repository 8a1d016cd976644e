"""Secret scans: formats of credentials learned as probabilistic automata.

Three patterns (assignments, access keys, long hexadecimal runs) give the base spans of
each text; they are kept as they are, and their values are the labelled credentials.

For each kind a prefix tree of its values is made and states are merged whose futures do
not differ by more than chance (Hoeffding's bound on the shares of ends and of each next
character, all the way down), which leaves a small automaton that gives any string a
likelihood.  Candidates are all other runs of CANDIDATE or more credential characters in
every text.  A candidate is a secret if its likelihood under the best automaton, against
that under the pairs of characters of the whole corpus outside the base spans (and the
first characters of candidates), has odds that outweigh how rare credentials are among
candidates.

A text is read once: one pass stores spans and candidates, with counts of character pairs
by task; learning and scoring read these.  Learning takes a bounded sample, LABELLED
values of a kind by hash, each of MAX_VALUE characters at most, on the driver; counts of
pairs and rates cover all texts, and all candidates are scored.

Defined cases: a null text is empty; a text without spans gives a row with none; repeated
rows, also of null ids, give a row each; texts and runs of any length are read whole;
positions are code points; a kind with fewer than MIN_LABELLED values has no automaton;
without any automaton, and for an empty table, only base spans are given; other columns
are not read.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adperf.sources.staging import stage

# The base patterns, the least lengths, and the characters of a credential.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"

KINDS = ("assign", "access", "hex", "format")
#: Shortest run that is a candidate.
CANDIDATE = 16
#: Values that a kind's automaton is learned from, their length, and the fewest that do.
LABELLED, MAX_VALUE, MIN_LABELLED = 1500, 256, 20
#: Chance of calling equal shares different, in Hoeffding's bound.
ALPHA = 0.05
#: Share of a character's likelihood that is spread over all characters.
SMOOTHING = 0.01
#: Odds against a candidate that its likelihood must outweigh, beyond how rare credentials are.
ODDS = 100.0

_assign = re.compile(ASSIGN, re.I | re.A)
_access = re.compile(ACCESS)
# runs of the least length: the same matches as of HEX that are long enough
_hex = re.compile(rf"(?<![0-9a-f])[0-9a-f]{{{MIN_HEX},}}")
_run = re.compile(rf"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{{{CANDIDATE},}}")
_OUTSIDE = len(CHARACTERS)
_code = np.full(256, _OUTSIDE, np.int64)
_code[list(CHARACTERS.encode())] = np.arange(_OUTSIDE)

FOUND = "found array<struct<kind:string,start:bigint,end:bigint,value:string>>"


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """kind, start, end and value of the base matches, by start and kind."""
    out = [("assign", *m.span(), m[2]) for m in _assign.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    out += [("access", *m.span(), m[0]) for m in _access.finditer(text) if len(m[0]) >= MIN_ACCESS]
    out += [("hex", *m.span(), m[0]) for m in _hex.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def without(text: str, spans: Iterable[tuple[str, int, int, str]]) -> str:
    """The text with blanks in place of its spans."""
    parts, at = [], 0
    for _, start, end, _ in spans:
        if end > at:
            parts += [text[at : max(at, start)], " " * (end - max(at, start))]
            at = end
    return "".join([*parts, text[at:]])


# ---------------------------------------------------------------- automata


class Automaton:
    """Probabilities of next characters and of the end, by state."""

    def __init__(self, steps: list[dict[str, tuple[int, float]]], ends: list[float]) -> None:
        self.steps, self.ends = steps, ends

    def log_likelihood(self, value: str) -> float:
        spread = SMOOTHING / (len(CHARACTERS) + 1)
        unseen = math.log(spread)
        state, total = 0, 0.0
        for c in value:
            step = self.steps[state].get(c)
            if step is None:
                state, total = 0, total + unseen
            else:
                state, total = step[0], total + step[1]
        return total + math.log(spread + (1 - SMOOTHING) * self.ends[state])


def _alike(a: int, of_a: int, b: int, of_b: int, width: float) -> bool:
    return abs(a / of_a - b / of_b) < width * (of_a**-0.5 + of_b**-0.5)


def infer(values: Iterable[str], alpha: float = ALPHA) -> Automaton:
    """Automaton of the values' prefix tree after merging compatible states.

    Kept states start with the root; each child of a kept one is merged into the first
    kept state it is compatible with, together with all below it, or is kept itself.
    """
    width = math.sqrt(0.5 * math.log(2 / alpha))
    seen, ends, after = [0], [0], [{}]  # arrivals, ends, next state by character
    passed: list[dict[str, int]] = [{}]
    for value in sorted(values):
        state = 0
        seen[0] += 1
        for c in value:
            if c not in after[state]:
                after[state][c] = len(seen)
                seen.append(0)
                ends.append(0)
                after.append({})
                passed.append({})
            passed[state][c] = passed[state].get(c, 0) + 1
            state = after[state][c]
            seen[state] += 1
        ends[state] += 1

    def compatible(a: int, b: int) -> bool:
        pairs = [(a, b)]
        while pairs:
            p, q = pairs.pop()
            if not _alike(ends[p], seen[p], ends[q], seen[q], width):
                return False
            for c in passed[p].keys() | passed[q].keys():
                if not _alike(passed[p].get(c, 0), seen[p], passed[q].get(c, 0), seen[q], width):
                    return False
            pairs += [(after[p][c], after[q][c]) for c in after[p].keys() & after[q].keys()]
        return True

    def fold(a: int, b: int) -> None:
        pairs = [(a, b)]
        while pairs:
            p, q = pairs.pop()
            seen[p] += seen[q]
            ends[p] += ends[q]
            for c, n in passed[q].items():
                passed[p][c] = passed[p].get(c, 0) + n
            for c, child in after[q].items():
                if c in after[p]:
                    pairs.append((after[p][c], child))
                else:
                    after[p][c] = child

    kept, known = [0], {0}
    while True:
        edge = next(((p, c) for p in kept for c in sorted(after[p]) if after[p][c] not in known), None)
        if edge is None:
            break
        child = after[edge[0]][edge[1]]
        like = next((k for k in kept if compatible(k, child)), None)
        if like is None:
            kept.append(child)
            known.add(child)
        else:
            after[edge[0]][edge[1]] = like
            fold(like, child)
    number = {state: i for i, state in enumerate(kept)}
    spread = SMOOTHING / (len(CHARACTERS) + 1)
    steps = [
        {c: (number[after[s][c]], math.log(spread + (1 - SMOOTHING) * n / seen[s])) for c, n in passed[s].items()}
        for s in kept
    ]
    return Automaton(steps, [ends[s] / seen[s] for s in kept])


class Scorer:
    """Automata by kind, the likelihood of ordinary runs, and the odds to outweigh."""

    def __init__(self, automata: dict[str, Automaton], pairs: np.ndarray, starts: np.ndarray, needed: float) -> None:
        self.automata, self.needed = automata, needed
        counts = np.concatenate([pairs, starts[None]]) + 0.5
        self.ordinary = np.log(counts / counts.sum(1, keepdims=True))

    def score(self, value: str) -> float:
        """Log of the likelihood under the best automaton over that of ordinary text."""
        codes = np.concatenate([[_OUTSIDE], _code[np.frombuffer(value.encode(), np.uint8)], [_OUTSIDE]])
        before = codes[:-1].copy()
        before[0] = _OUTSIDE + 1  # how candidates begin, not how words do
        ordinary = float(self.ordinary[before, codes[1:]].sum())
        return max(a.log_likelihood(value) for a in self.automata.values()) - ordinary


# ---------------------------------------------------------------- passes


def spans_and_candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and found of every text; rows with `pairs` hold counts of character pairs instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros((_OUTSIDE + 1) ** 2, np.int64)
        kinds = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])
        for batch in batches:
            found = []
            for text in batch.column(1).to_pylist():
                text = text or ""
                spans = base_spans(text)
                rest = without(text, spans) if spans else text
                spans += [("format", *m.span(), m[0]) for m in _run.finditer(rest)]
                found.append([dict(zip(("kind", "start", "end", "value"), s, strict=True)) for s in spans])
                data = np.frombuffer(f" {rest} ".encode(), np.uint8)
                for at in range(0, len(data) - 1, 1 << 22):
                    codes = _code[data[at : at + (1 << 22) + 1]]
                    pairs += np.bincount(codes[:-1] * (_OUTSIDE + 1) + codes[1:], minlength=len(pairs))
            n = len(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(kinds)), pa.array([None] * n, pa.list_(pa.int64()))],
                names=["doc_id", "found", "pairs"],
            )
        yield pa.RecordBatch.from_arrays(
            [pa.array([None], pa.int64()), pa.array([None], pa.list_(kinds)), pa.array([pairs.tolist()])],
            names=["doc_id", "found", "pairs"],
        )

    texts = docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string"))
    return stage(texts.mapInArrow(run, f"doc_id long, {FOUND}, pairs array<long>"), "found")


def learn(found: DataFrame, labelled: int = LABELLED) -> Scorer | None:
    """Automata of the base spans' values; None if no kind has enough of them."""
    each = found.select(F.explode("found").alias("s")).select("s.kind", "s.value")
    numbers = dict(each.groupBy("kind").count().collect())  # one row for a kind
    distinct = each.filter((F.col("kind") != "format") & (F.length("value") <= MAX_VALUE)).distinct()
    distinct = stage(distinct, "values")
    automata = {}
    for kind in KINDS[:-1]:
        picked = distinct.filter(F.col("kind") == kind).orderBy(F.xxhash64("value"), "value").limit(labelled)
        values = [r["value"] for r in picked.collect()]  # at most `labelled`
        if len(values) >= MIN_LABELLED:
            automata[kind] = infer(values)
    if not automata:
        return None
    size = (_OUTSIDE + 1) ** 2
    pairs = np.zeros(size)
    counted = found.select(F.posexplode("pairs").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n"))
    for r in counted.collect():  # one row for a pair of characters
        pairs[r["at"]] = r["n"]
    starts = np.zeros(_OUTSIDE + 1)
    first = each.filter("kind = 'format'").groupBy(F.substring("value", 1, 1).alias("c")).count()
    for r in first.collect():  # one row for a character
        starts[CHARACTERS.index(r["c"])] = r["count"]
    credentials = sum(n for k, n in numbers.items() if k != "format")
    rare = max(1.0, numbers.get("format", 0) / credentials)
    return Scorer(automata, pairs.reshape(_OUTSIDE + 1, -1), starts, math.log(rare * ODDS))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", labelled: int = LABELLED) -> DataFrame:
    """doc_id and spans (kind, start, end, score) of every text, by start and kind.

    The score is a log of odds, null if there is no automaton; base spans are kept
    whatever theirs is.
    """
    found = spans_and_candidates(docs, id_col, text_col)
    scorer = learn(found, labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
        remembered: dict[str, float] = defaultdict(float)
        for batch in batches:
            out = []
            for spans in batch.column("found").to_pylist():
                kept = []
                for s in spans:
                    value, score = s["value"], None
                    if scorer:
                        score = remembered[value] if value in remembered else scorer.score(value)
                        if len(value) <= MAX_VALUE and len(remembered) < 100_000:
                            remembered[value] = score
                    if s["kind"] != "format" or (score is not None and score >= scorer.needed):
                        kept.append({"kind": s["kind"], "start": s["start"], "end": s["end"], "score": score})
                out.append(sorted(kept, key=lambda s: (s["start"], KINDS.index(s["kind"]))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.list_(kinds))], names=["doc_id", "spans"])

    schema = "doc_id long, spans array<struct<kind:string,start:bigint,end:bigint,score:double>>"
    return found.filter("pairs IS NULL").select("doc_id", "found").mapInArrow(run, schema)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(spans: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of `scan`."""
    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "format")
    return spans.select(
        "doc_id", *[number(k) for k in KINDS[:-1]], F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"))
