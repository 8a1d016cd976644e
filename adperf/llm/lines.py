"""Near-equal lines by an exact set-similarity join.

A line is the set of its words (ASCII letters in lower case).  Two lines match if the
Jaccard similarity of their sets is SIMILAR or more; a line that matches an earlier
one is removed.  Earlier means: of a smaller document id, or further up in the same
document.  Lines of fewer than MIN_TOKENS distinct words are removed only if an
earlier line has the same set: one word more or less says little among so few.

Lines of equal sets are one class, of which the earliest goes on.  Words are ordered
by rarity.  Matching sets share a word among the first n - ceil(0.75 n) + 1 of either,
so only these are indexed, and of them only those that some other line has.  Within
the rows of a word, pairs pass three exact filters before their sets are compared:
sizes, what the positions leave for an overlap if this is the first word they share,
and the parity of the sets' bits, which differs in no more places than the sets; the
number of these bits grows with the line, or all long lines would look alike.  The
nearest candidate of each line is compared first, then the next ones; a line that had
still more and matched none of them meets all the rest in a second pass, which reads
only the words at which such lines had more.  A word with very many rows is dealt over several tasks, each of
which compares a part of them with all.

Words are counted, and texts rewritten, in chunks that stay where they are (see
`chunks`); what moves is some 20 bytes for each indexed word of a line.

Defined cases: null texts stay null and have no lines; empty lines and texts stay;
repeated rows of one id follow each other in the order of storage, so one of them
stays as it is; rows without an id come last; lines and texts of any length are
read whole; an empty table gives no rows; all columns of the input are kept under
their names, whatever these are, and the counts take a name that is free.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adperf.llm import chunks as C
from adperf.llm import textvec
from adperf.llm.neardup import confirm
from adperf.sources.staging import stage

SIMILAR = (75, 100)
MIN_TOKENS = 4
#: Candidates of a line that the first pass keeps of each range of words, and of a line whose nearest one may well not match.
NEAREST, UNSURE = 4, 1024
#: Rows of one word that one task compares with all rows of the word.
WORD_ROWS = 8192
#: Bits of the filter that says which words the second pass needs; a bound, not a cut.
FILTER_BITS = 1 << 23
#: Lines of so many words have twice the 128 bits of parity, those of twice as many four times, to 128 << WIDEST.
WIDE_FROM, WIDEST = 160, 6
#: Bytes hashed and sorted at a time, so that they stay in a core's cache; a longer line is handled alone.
SET_BYTES = 1 << 17
KEY_BITS, RARITY_BITS = 51, 20
_NO_ID = np.uint64(np.iinfo(np.uint64).max)


def required(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Least overlap of matching sets of these sizes."""
    need, of = SIMILAR
    return -(-need * (n + m) // (need + of))


def prefix(n: np.ndarray) -> np.ndarray:
    need, of = SIMILAR
    return n - (-(-need * n // of)) + 1


def widths(n: np.ndarray) -> np.ndarray:
    """How often the 128 bits of parity are doubled for lines of these sizes."""
    return sum((n >= WIDE_FROM << k for k in range(WIDEST)), np.zeros(len(n), np.int64))


def line_offsets(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where lines begin (and the last ends), and how many lines each text has.

    A text without bytes has one empty line.
    """
    breaks = np.flatnonzero(flat == 10) + 1
    per_text = np.searchsorted(breaks, offsets[1:], side="right") - np.searchsorted(breaks, offsets[:-1], side="right") + 1
    total = int(per_text.sum())
    starts = np.empty(total + 1, np.int64)
    first = np.cumsum(per_text) - per_text
    inner = np.ones(total, bool)
    inner[first] = False
    starts[:-1][first] = offsets[:-1]
    # a break belongs to the text that holds the byte before the line's start
    starts[:-1][inner] = breaks
    starts[-1] = offsets[-1]
    return starts, per_text


class Lines:
    """The lines of a chunk as sets of words, in blocks."""

    def __init__(self, batch: pa.RecordBatch, i: int, id_at: int, text_at: int) -> None:
        rows = batch.column("rows")
        chunk = batch.column("chunk")[i].as_py()
        ids = C.texts_of(rows, i, f"f{id_at}").cast(pa.int64())
        self.flat, self.offsets = textvec.text_bytes(C.texts_of(rows, i, f"f{text_at}"))
        self.starts, self.per_text = line_offsets(self.flat, self.offsets)
        self.lines = len(self.starts) - 1
        known = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
        known = np.where(ids.is_null().to_numpy(zero_copy_only=False), _NO_ID, known)
        self.high = np.repeat(known, self.per_text)
        if chunk >> 32 >= 1 << 20 or chunk & 0xFFFFFFFF >= 1 << 14 or self.lines > 1 << 30:
            raise ValueError("a partition has too many chunks to number their lines; repartition the input")
        self.low = np.uint64(((chunk >> 32) << 44) | ((chunk & 0x3FFF) << 30)) + np.arange(self.lines, dtype=np.uint64)

    def sets(self) -> "Lines":
        """Adds sizes (distinct words), begins, words (ascending within a line), names."""
        words, sizes = [], []
        for a, b in textvec.blocks(self.starts, SET_BYTES):
            hashes, counts = textvec.words(self.flat[self.starts[a] : self.starts[b]], self.starts[a : b + 1])
            owner = np.repeat(np.arange(b - a, dtype=np.uint64), counts)
            if (b - a).bit_length() <= 64 - KEY_BITS:
                code = np.sort(owner << np.uint64(KEY_BITS) | hashes >> np.uint64(64 - KEY_BITS))
                key = code & np.uint64((1 << KEY_BITS) - 1)
                owner = code >> np.uint64(KEY_BITS)
            else:
                key = hashes >> np.uint64(64 - KEY_BITS)
                order = np.lexsort((key, owner))
                key, owner = key[order], owner[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
            words.append(key[new])
            sizes.append(np.bincount(owner[new].astype(np.int64), minlength=b - a))
        self.words = np.concatenate(words) if words else np.zeros(0, np.uint64)
        self.sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.names = np.zeros(self.lines, np.uint64)
        some = np.flatnonzero(self.sizes)
        if len(some):
            self.names[some] = textvec.mix(
                np.add.reduceat(textvec.mix(self.words), self.begins[some]) + self.sizes[some].astype(np.uint64))
        self.long = self.sizes >= MIN_TOKENS
        return self

    def firsts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Names of the lines with words, ascending and distinct; the first line of each; their line numbers."""
        at = np.flatnonzero(self.sizes)
        order = np.lexsort((self.low[at], self.high[at], self.names[at]))
        at = at[order]
        new = np.ones(len(at), bool)
        new[1:] = self.names[at][1:] != self.names[at][:-1]
        return self.names[at][new], at[new], at

    def parity(self) -> list[np.ndarray]:
        """128 bits of each line, in two numbers: how often each bit is hit, odd or even."""
        some = np.flatnonzero(self.sizes)
        out = [np.zeros(self.lines, np.uint64) for _ in range(2)]
        if len(some):
            bit, half = np.uint64(1) << (self.words & np.uint64(63)), (self.words >> np.uint64(6)) & np.uint64(1)
            for k in range(2):
                out[k][some] = np.bitwise_xor.reduceat(np.where(half == k, bit, np.uint64(0)), self.begins[some])
        return out

    def wide_parity(self, at: np.ndarray) -> list[np.ndarray]:
        """For each doubling k, the first half of the 128 << k bits of those of the lines `at` that have them.

        Both halves together give the bits of the doubling before, so the other half need not be kept.
        """
        out = []
        some, where = np.unique(at, return_inverse=True)
        for k in range(1, WIDEST + 1):
            has = widths(self.sizes[some]) >= k
            bits = np.zeros((int(has.sum()), 1 << k), np.uint64)
            for row, line in enumerate(some[has]):
                words = self.words[self.begins[line] : self.begins[line] + self.sizes[line]]
                bit = words & np.uint64((128 << k) - 1)
                bit = bit[bit < 64 << k].astype(np.int64)
                odd = np.bincount(bit, minlength=64 << k) & 1
                bits[row] = np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)
            place = np.cumsum(has) - 1
            out.append(bits[place[where[has[where]]]])
        return out


def _count_keys(id_at: int, text_at: int):
    def keys(batch: pa.RecordBatch, i: int) -> dict[str, tuple[np.ndarray, list[np.ndarray]]]:
        lines = Lines(batch, i, id_at, text_at).sets()
        in_long = np.repeat(lines.long, lines.sizes)
        names, first, _ = lines.firsts()
        words, times = np.unique(lines.words[in_long], return_counts=True)
        return {
            # the range is cut by the leading bits, which a key of 51 bits must fill
            "word": (words << np.uint64(64 - KEY_BITS), [times.astype(np.uint64)]),
            "line": (names, [lines.high[first], lines.low[first]]),
        }

    return keys


def _own(batch: pa.RecordBatch, i: int, lines: Lines) -> tuple[np.ndarray, np.ndarray]:
    """Of each line: whether it is its class's first line of all, and whether an equal one is earlier."""
    first, later = np.zeros(lines.lines, bool), np.zeros(lines.lines, bool)
    names, _, at = lines.firsts()
    if not len(at):
        return first, later
    high, low = C.totals_of(batch.column("back"), i, "line")
    place = np.searchsorted(names, lines.names[at])
    same = (high[place] == lines.high[at]) & (low[place] == lines.low[at])
    first[at[same]], later[at[~same]] = True, True
    return first, later


def _distinct(keys: np.ndarray) -> np.ndarray:
    """Distinct keys, ascending; sorting is faster here than `np.unique`."""
    keys = np.sort(keys)
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


def _places(known: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where each key stands among the known ones (distinct, ascending): by its last bits, and by search if these are another's."""
    mask = np.uint64((1 << max(10, (8 * len(known)).bit_length())) - 1)
    table = np.zeros(int(mask) + 1, np.int32)
    table[known & mask] = np.arange(len(known), dtype=np.int32)
    at = table[keys & mask]
    other = np.flatnonzero(known[at] != keys)
    at[other] = np.searchsorted(known, keys[other])
    return at


def _index_rows(batch: pa.RecordBatch, i: int, lines: Lines) -> dict[str, np.ndarray]:
    """word, size, place, line and rarity of the indexed words of the classes that begin in this chunk."""
    first, _ = _own(batch, i, lines)
    in_long = np.repeat(lines.long, lines.sizes)
    known = _distinct(lines.words[in_long])
    times = C.totals_of(batch.column("back"), i, "word")
    use = np.flatnonzero(first & lines.long)
    sizes = lines.sizes[use]
    if not len(use):
        return {k: np.zeros(0, np.uint64) for k in ("word", "size", "place", "line", "rarity")}
    owner = np.repeat(np.arange(len(use)), sizes)
    begin = np.cumsum(sizes) - sizes
    inner = np.arange(len(owner)) - begin[owner]
    words = lines.words[np.repeat(lines.begins[use], sizes) + inner]
    found = times[0][_places(known, words)]
    rarity = np.minimum(found, np.uint64((1 << RARITY_BITS) - 1))
    owner_bits, inner_bits = len(use).bit_length(), int(sizes.max()).bit_length()
    if owner_bits + inner_bits + RARITY_BITS <= 64:  # the words of a line ascend, so their number breaks ties
        code = np.sort(
            owner.astype(np.uint64) << np.uint64(RARITY_BITS + inner_bits)
            | rarity << np.uint64(inner_bits) | inner.astype(np.uint64))
        order = begin[owner] + (code & np.uint64((1 << inner_bits) - 1)).astype(np.int64)
    else:
        order = np.lexsort((inner, rarity, owner))
    words, found = words[order], found[order]
    keep = (inner < prefix(sizes)[owner]) & (found > 1)
    return {
        "word": words[keep], "size": sizes[owner][keep].astype(np.uint64), "place": inner[keep].astype(np.uint64),
        "line": use[owner][keep].astype(np.uint64), "rarity": found[keep],
    }


def _in_filter(bits: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Of mixed words (or their parts), whether the second pass needs them."""
    at = words % np.uint64(FILTER_BITS)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _emit_index(id_at: int, text_at: int, bits: int, needed: np.ndarray | None):
    """Index rows in blobs by range of words.  With `needed`, lines in `asked` are those to be matched."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                lines = Lines(batch, i, id_at, text_at).sets()
                rows = _index_rows(batch, i, lines)
                # parts of very common words: a row is compared in its own part, and present in all
                parts = -(-rows["rarity"].astype(np.int64) // WORD_ROWS)
                again = np.repeat(np.arange(len(parts)), parts)
                part = np.arange(len(again)) - np.repeat(np.cumsum(parts) - parts, parts)
                own = textvec.mix(lines.low[rows["line"].astype(np.int64)]) % np.maximum(parts, 1).astype(np.uint64)
                word = np.where(
                    part > 0, textvec.mix(rows["word"][again] + part.astype(np.uint64) * np.uint64(1 << KEY_BITS)),
                    textvec.mix(rows["word"])[again])
                if needed is not None:
                    use = _in_filter(needed, word)
                    again, part, word = again[use], part[use], word[use]
                if not len(word):
                    continue
                order = np.argsort(word, kind="stable")
                again, part, word = again[order], part[order], word[order]
                at = rows["line"][again].astype(np.int64)
                parity, more = lines.parity()
                asked = np.ones(lines.lines, bool)
                if needed is not None:
                    asked[:] = False
                    asked[np.array(batch.column("asked")[i].as_py() or [], np.int64)] = True
                rows = {
                    "size": rows["size"][again], "place": rows["place"][again], "parity": parity[at], "parity2": more[at],
                    "high": lines.high[at], "line": at.astype(np.uint64),
                    "asked": (asked[at] & (own[again] == part.astype(np.uint64))).astype(np.uint64),
                }
                cuts = np.searchsorted(word, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) \
                    if bits else np.zeros(0, np.int64)
                edges = np.concatenate([[0], cuts, [len(word)]])
                some = [r for r in range(len(edges) - 1) if edges[r + 1] > edges[r]]
                columns = {"word": [textvec.pack_sorted(word[edges[r] : edges[r + 1]]) for r in some]}
                for k, dtype in _INDEX.items():
                    values = rows[k].astype(dtype if dtype is not np.uint32 or rows[k].max() >> np.uint64(16) else np.uint16)
                    columns[k] = [textvec.pack_counts(values[edges[r] : edges[r + 1]], values.dtype) for r in some]
                wide, level = lines.wide_parity(at), widths(lines.sizes[at])
                ends = [np.concatenate([[0], np.cumsum(level >= k)])[edges] for k in range(1, WIDEST + 1)]
                columns["wide"] = [b"".join(w[e[r] : e[r + 1]].tobytes() for w, e in zip(wide, ends, strict=True)) for r in some]
                base = [lines.low[:1].view(np.int64)[0]] * len(some)  # the number of the chunk's first line
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int32()), pa.array(base, pa.int64()), *[pa.array(x, pa.binary()) for x in columns.values()]],
                    names=["range", "base", *columns],
                )

    return run


#: Columns of the index and their widths; numbers of four bytes take two if they fit.
_INDEX = {
    "size": np.uint32, "place": np.uint32, "parity": np.uint64, "parity2": np.uint64, "high": np.uint64, "line": np.uint32, "asked": np.uint8,
}


def _order(word: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Rows by word and size, as `np.lexsort` gives them; one sort of plain numbers where these hold all three."""
    known = _distinct(word)
    n, sizes = len(word).bit_length(), int(size.max()).bit_length()
    if len(known).bit_length() + sizes + n > 64:
        return np.lexsort((size, word))
    code = _places(known, word).astype(np.uint64) << np.uint64(sizes + n)
    code |= size.astype(np.uint64) << np.uint64(n)
    code |= np.arange(len(word), dtype=np.uint64)
    return (np.sort(code) & np.uint64((1 << n) - 1)).astype(np.int64)


def _wide_bits(table: pa.Table, col: dict[str, np.ndarray]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """How often the bits of each row are doubled; for each doubling, where a row's bits stand, and the bits."""
    level = widths(col["size"].astype(np.int64))
    ends = np.cumsum([0, *[len(x.as_py()) // 8 for x in table["word"]]])
    halves: list[list[np.ndarray]] = [[] for _ in range(WIDEST)]
    for x, a, b in zip(table["wide"], ends, ends[1:], strict=False):
        data, at = np.frombuffer(x.as_py(), np.uint64), 0
        for k in range(1, WIDEST + 1):
            n = int((level[a:b] >= k).sum()) << k
            halves[k - 1].append(data[at : at + n].reshape(-1, 1 << k))
            at += n
    out, before = [], np.stack([col["parity"], col["parity2"]], 1)
    for k in range(1, WIDEST + 1):
        half = np.concatenate(halves[k - 1])
        above = before[level[level >= k - 1] >= k]
        before = np.concatenate([half, half ^ above], 1)
        out.append((np.cumsum(level >= k) - 1, before))
    return level, out


def _near(limit: int | None):
    """Candidates of one range: later, earlier, bits apart; and, without an earlier one, the words at which a line has more than these."""

    def run(table: pa.Table) -> pa.Table:
        words = [textvec.unpack_sorted(x.as_py()) for x in table["word"]]
        rows, word = [len(x) for x in words], np.concatenate(words)

        def read(k: str) -> np.ndarray:
            data = [x.as_py() for x in table[k]]
            return np.concatenate([textvec.unpack_counts(x, np.dtype(f"u{len(x) // n}")) for x, n in zip(data, rows, strict=True)])

        col = {k: read(k) for k in _INDEX}
        col["low"] = np.repeat(table["base"].to_numpy().view(np.uint64), rows) + col.pop("line")
        order = _order(word, col["size"])
        levels, bits = _wide_bits(table, col)
        level, bits = levels[order], [(x[0][order], x[1]) for x in bits]
        word, col = word[order], {k: v[order] for k, v in col.items()}
        size, place = col["size"].astype(np.int64), col["place"].astype(np.int64)
        kept: list[np.ndarray] = []
        full: np.ndarray = np.zeros(0, np.uint64)
        held = 0

        def prune() -> None:
            nonlocal kept, held, full
            pairs = np.concatenate(kept, axis=1) if kept else np.zeros((4, 0), np.uint64)
            pairs = pairs[:, np.lexsort((pairs[1], pairs[2], pairs[0]))]
            new = np.ones(pairs.shape[1], bool)
            new[1:] = (pairs[:2, 1:] != pairs[:2, :-1]).any(0)
            pairs = pairs[:, new]
            if limit is not None:
                starts = np.flatnonzero(np.concatenate([[True], pairs[0, 1:] != pairs[0, :-1]])) if pairs.shape[1] else np.zeros(0, np.int64)
                counts = np.diff(np.append(starts, pairs.shape[1]))
                rank = np.arange(pairs.shape[1]) - np.repeat(starts, counts)
                most = np.where(pairs[3, starts] == 1, max(limit, UNSURE), limit)
                full = np.union1d(full, pairs[0, starts[counts > most]])
                pairs = pairs[:, rank < np.repeat(most, counts)]
            kept, held = [pairs], 0

        left = np.arange(len(word))
        step = 1
        while len(left):
            left = left[left + step < len(word)]
            right = left + step
            # sizes ascend within a word, so what is too large once, for all that is left of the smaller set, stays so
            near = word[left] == word[right]
            near &= required(size[left], size[right]) <= size[left] - place[left]
            left, right = left[near], right[near]
            n, m, j = size[left], size[right], place[right]
            need = required(n, m)
            apart = np.bitwise_count(col["parity"][left] ^ col["parity"][right]).astype(np.int64)
            apart += np.bitwise_count(col["parity2"][left] ^ col["parity2"][right])
            # a pair is found at the first word it shares, so all of the overlap is behind it
            ok = (m - j >= need) & (apart <= n + m - 2 * need)
            a, b, apart, most = left[ok], right[ok], apart[ok], (n + m - 2 * need)[ok]
            for k, (at, x) in enumerate(bits, 1):
                both = np.flatnonzero((level[a] >= k) & (level[b] >= k))
                if not len(both):
                    break
                apart[both] = np.bitwise_count(x[at[a[both]]] ^ x[at[b[both]]]).sum(1, dtype=np.int64)
                stay = apart <= most
                a, b, apart, most = a[stay], b[stay], apart[stay], most[stay]
            a_first = (col["high"][a] < col["high"][b]) | ((col["high"][a] == col["high"][b]) & (col["low"][a] < col["low"][b]))
            later, earlier = np.where(a_first, b, a), np.where(a_first, a, b)
            # in a dealt word, a pair is compared in the later line's own part
            mine = (col["asked"][later] == 1) & (col["low"][later] != col["low"][earlier])
            later, earlier = later[mine], earlier[mine]
            unsure = 2 * apart[mine] > most[mine]
            kept.append(np.stack([col["low"][later], col["low"][earlier], apart[mine].astype(np.uint64), unsure.astype(np.uint64)]))
            held += len(later)
            if held > 1_000_000 and limit is not None:
                prune()
            step += 1
        prune()
        pairs = kept[0]
        again = np.flatnonzero(np.isin(col["low"], full) & (col["asked"] == 1)) if len(full) else np.zeros(0, np.int64)
        return pa.table({
            "later": pa.array(np.concatenate([pairs[0], col["low"][again]]).view(np.int64)),
            "earlier": pa.concat_arrays([pa.array(pairs[1].view(np.int64)), pa.nulls(len(again), pa.int64())]),
            "apart": pa.concat_arrays([pa.array(pairs[2].view(np.int64)), pa.nulls(len(again), pa.int64())]),
            "word": pa.concat_arrays([pa.nulls(len(pairs[0]), pa.int64()), pa.array(word[again].view(np.int64))]),
        })

    return run


def _candidates(
    chunks: DataFrame, id_at: int, text_at: int, expected: float, limit: int | None, needed: np.ndarray | None = None
) -> DataFrame:
    bits = max(0, math.ceil(math.log2(max(1.0, expected / (C.RANGE_KEYS / 4)))))
    schema = "range int, base long, word binary, " + ", ".join(f"{k} binary" for k in [*_INDEX, "wide"])
    columns = ["chunk", "rows", "back"] + (["asked"] if needed is not None else [])
    index = chunks.select(*columns).mapInArrow(_emit_index(id_at, text_at, bits, needed), schema)
    found = index.groupBy("range").applyInArrow(_near(limit), "later long, earlier long, apart long, word long")
    return stage(found.groupBy("later", "earlier", "word").agg(F.min("apart").alias("apart")), "line_pairs")


def _chunk_of(line: str) -> Column:
    """The number of the chunk of a line, from the line's own number."""
    part = F.shiftrightunsigned(line, 44)
    return F.shiftleft(part, 32) + F.shiftrightunsigned(line, 30).bitwiseAND(F.lit(0x3FFF))


def _by_chunk(lines: DataFrame, name: str) -> DataFrame:
    """chunk and an array of line numbers of the lines (column line)."""
    number = F.col("line").bitwiseAND(F.lit((1 << 30) - 1)).cast("int")
    return lines.select(_chunk_of("line").alias("chunk"), number.alias("k")).groupBy("chunk").agg(
        F.collect_set("k").alias(name))  # at most the lines of one chunk


def _sets_of(chunks: DataFrame, wanted: DataFrame, id_at: int, text_at: int) -> DataFrame:
    """id and items (all words, ascending, 64 bits) of the wanted lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                lines = Lines(batch, i, id_at, text_at)
                at = np.array(batch.column("wanted")[i].as_py(), np.int64)
                parts = [lines.flat[a:b] for a, b in zip(lines.starts[at], lines.starts[at + 1], strict=True)]
                offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
                flat = np.concatenate(parts)
                for a, b in textvec.blocks(offsets):
                    hashes, counts = textvec.words(flat[offsets[a] : offsets[b]], offsets[a : b + 1])
                    owner = np.repeat(np.arange(b - a), counts)
                    order = np.lexsort((hashes, owner))
                    hashes, owner = hashes[order], owner[order]
                    new = np.ones(len(hashes), bool)
                    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
                    hashes, ends = hashes[new], np.cumsum(np.bincount(owner[new], minlength=b - a))
                    items = [hashes[x:y].tobytes() for x, y in zip([0, *ends], ends, strict=False)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(lines.low[at[a:b]].view(np.int64)), pa.array(items, pa.binary())], names=["id", "items"])

    met = chunks.join(_by_chunk(wanted, "wanted"), "chunk").select("chunk", "rows", "wanted")
    # by id, so that the pairs come to the sets
    return C.bucketed(met.mapInArrow(run, "id long, items binary").repartition("id"), "id")


def _matched(chunks: DataFrame, pairs: DataFrame, id_at: int, text_at: int) -> DataFrame:
    """line: later lines of the pairs whose sets are similar enough.

    The nearest candidate of each line is compared first, the others only if it does not match.
    """
    ends = pairs.select(F.col("later").alias("line")).union(pairs.select("earlier")).distinct()
    sets = _sets_of(chunks, ends, id_at, text_at)
    nearest = Window.partitionBy("later").orderBy("apart", "earlier")
    ranked = stage(pairs.withColumn("k", F.row_number().over(nearest)), "ranked")

    def linked(some: DataFrame) -> DataFrame:
        tried = confirm(some.select(F.col("later").alias("a"), F.col("earlier").alias("b")), sets, SIMILAR)
        return tried.filter("linked").select(F.col("a").alias("line")).distinct()

    first = stage(linked(ranked.filter("k = 1")), "matched")
    rest = ranked.filter("k > 1").join(first.withColumnRenamed("line", "later"), "later", "left_anti")
    return stage(first.unionByName(linked(rest)), "matched")


def _filter_of(words: DataFrame) -> np.ndarray:
    """FILTER_BITS bits that say which words (column word) are needed."""
    at = F.col("word").bitwiseAND(F.lit(FILTER_BITS - 1))
    bit = F.expr("shiftleft(1, cast(word & 7 AS int))")
    found = words.select(F.shiftright(at, 3).cast("int").alias("at"), bit.alias("bits")).groupBy("at").agg(
        F.bit_or("bits").alias("bits"))
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in found.toLocalIterator():  # FILTER_BITS / 8 rows at most
        bits[row["at"]] = row["bits"]
    return bits


def counts_column(columns: list[str]) -> str:
    """`_lines`, with as many underscores in front as make it a name of its own."""
    name, taken = "_lines", {c.lower() for c in columns}
    while name in taken:
        name = f"_{name}"
    return name


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of `docs` with the text rewritten, n_lines and n_removed added under `counts_column`."""
    names = docs.columns
    id_at, text_at = names.index(id_col), names.index(text_col)
    chunks = C.cut(docs, text_col)
    size = C.text_bytes(chunks)
    totals = C.exchange(chunks, _count_keys(id_at, text_at), {"word": "sum", "line": "first"}, size / 8)
    chunks = C.returned(chunks, totals)

    found = _candidates(chunks, id_at, text_at, size / 20, NEAREST)
    pairs = found.filter("earlier is not null").drop("word")
    removed = _matched(chunks, pairs, id_at, text_at)
    again = found.filter("earlier is null").select(F.col("later").alias("line"), "word")
    again = stage(again.join(removed, "line", "left_anti"), "open")
    if not again.isEmpty():
        asked = chunks.join(_by_chunk(again, "asked"), "chunk", "left")
        rest = _candidates(asked, id_at, text_at, size / 200, None, _filter_of(again)).drop("word")
        rest = rest.join(pairs.select("later", "earlier"), ["later", "earlier"], "left_anti")
        removed = removed.unionByName(_matched(chunks, stage(rest, "rest"), id_at, text_at))
    return _rewritten(chunks.join(_by_chunk(removed, "gone"), "chunk", "left"), docs, id_at, text_at)


def _rewritten(chunks: DataFrame, docs: DataFrame, id_at: int, text_at: int) -> DataFrame:
    fields = docs.schema.fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                lines = Lines(batch, i, id_at, text_at).sets()
                _, gone = _own(batch, i, lines)
                gone[np.array(batch.column("gone")[i].as_py() or [], np.int64)] = True
                column = C.texts_of(batch.column("rows"), i, f"f{text_at}")
                texts, first = column.to_pylist(), np.cumsum(lines.per_text) - lines.per_text
                removed = np.add.reduceat(gone.astype(np.int64), first)
                data = lines.flat
                for k in np.flatnonzero(removed):
                    at = range(first[k], first[k] + lines.per_text[k])
                    stops = [*lines.starts[first[k] + 1 : first[k] + lines.per_text[k]] - 1, lines.offsets[k + 1]]
                    kept = [data[lines.starts[x] : y].tobytes() for x, y in zip(at, stops, strict=True) if not gone[x]]
                    texts[k] = b"\n".join(kept).decode()
                blank = column.is_null().to_numpy(zero_copy_only=False)
                out = [C.texts_of(batch.column("rows"), i, f"f{j}") for j in range(len(fields))]
                out[text_at] = pa.array(texts, pa.string())
                counts = pa.StructArray.from_arrays(
                    [pa.array(np.where(blank, 0, lines.per_text)), pa.array(removed)], names=["n_lines", "n_removed"])
                yield pa.RecordBatch.from_arrays([*out, counts], names=[*[f"f{j}" for j in range(len(fields))], "lines"])

    inner = T.StructType([T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())])
    schema = T.StructType([
        *[T.StructField(f"f{j}", T.StringType() if j == text_at else f.dataType) for j, f in enumerate(fields)],
        T.StructField("lines", inner),
    ])
    rows = chunks.select("chunk", "rows", "back", "gone").mapInArrow(run, schema)
    return rows.select(*[F.col(f"f{j}").alias(f.name) for j, f in enumerate(fields)], F.col("lines").alias(counts_column(docs.columns)))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` without repeated lines; documents left without a word are dropped, if lines went."""
    rows = dedup(docs, id_col, text_col)
    empty = ~F.coalesce(F.col(text_col).rlike("[^ \\t-\\r]"), F.lit(False))
    kept = rows.filter(~((F.col(counts_column(docs.columns))["n_removed"] > 0) & empty))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


#: Rarest words first, all pairs that share one of the prefix, similarity in full.
SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS no
  FROM documents),
t AS (
  SELECT doc_id, no, line, list_sort(list_distinct([x for x in string_split_regex(
      translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') if x <> ''])) AS ws
  FROM l),
c AS (
  SELECT row_number() OVER (ORDER BY arg_min(doc_id, (doc_id, no)), arg_min(no, (doc_id, no))) AS id, ws, len(ws) AS n
  FROM t WHERE len(ws) >= 1 GROUP BY ws),
w AS (SELECT id, n, unnest(ws) AS word FROM c WHERE n >= 4),
f AS (SELECT word, count(*) AS times FROM w GROUP BY word),
p AS (
  SELECT id, n, word FROM w JOIN f USING (word)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY times, word) <= n - CAST(ceil(0.75 * n) AS BIGINT) + 1),
k AS (
  SELECT DISTINCT a.id AS earlier, b.id AS later FROM p a JOIN p b
  ON a.word = b.word AND a.id < b.id AND 4 * least(a.n, b.n) >= 3 * greatest(a.n, b.n)),
gone AS (
  SELECT DISTINCT later AS id FROM k JOIN c x ON x.id = earlier JOIN c y ON y.id = later
  WHERE 7 * len(list_intersect(x.ws, y.ws)) >= 3 * (x.n + y.n)),
marked AS (
  SELECT t.doc_id, t.no, t.line,
    c.id IS NOT NULL AND (g.id IS NOT NULL OR row_number() OVER (PARTITION BY t.ws ORDER BY t.doc_id, t.no) > 1) AS gone
  FROM t LEFT JOIN c ON c.ws = t.ws LEFT JOIN gone g ON g.id = c.id)
SELECT d.doc_id, CAST(coalesce(m.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(m.removed, 0) AS BIGINT) AS n_removed,
  CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(m.text, '') END AS text
FROM documents d LEFT JOIN (
  SELECT doc_id, count(*) AS n, sum(gone::INT) AS removed,
    string_agg(line, chr(10) ORDER BY no) FILTER (NOT gone) AS text
  FROM marked GROUP BY doc_id) m ON m.doc_id = d.doc_id
"""
