"""Concatenate and cut: documents laid end to end and cut into fixed windows.

Two passes.  The first encodes every text once and stores the ids with each
document's place inside its partition.  Prefix sums over the partitions' token
totals (one row per partition) then give every document its place in the whole
stream, and the second pass cuts it where windows end: one boundary record for
each document and window it touches.  Only the last window can have padding.

Defined cases: null texts count as empty and still carry the closing id; an empty
text is one piece of one id; repeated rows and repeated ids are packed as often as
they occur; an empty table gives no pieces; columns other than the two named ones
are not read, so their names cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adperf.sources.staging import stage

SEQUENCE_TOKENS = 2048
END_ID = 1
#: Encoded pre-tokens a worker remembers before it starts anew; only speed depends on it.
REMEMBERED = 400_000

_LETTERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-ɏ"
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
#: Texts in these characters are split here as the tokenizer's own pattern splits them.
_PLAIN = re.compile("[\n\t\x20-\x7e\xa1-įı-ɏ]*")
_PIECES = re.compile(
    rf"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[{_NUMBERS}]|[^\s{_LETTERS}{_NUMBERS}]+"
)


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encoder(path: str) -> Callable[[str], bytes]:
    """Text -> its ids as little-endian unsigned 32-bit, as the tokenizer gives them.

    The vocabulary never joins pre-tokens, so each distinct one is encoded once and
    remembered.  Texts outside the plain alphabet go through the tokenizer whole.
    """
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    merge, letters = whole.model.tokenize, _byte_letters()
    known: dict[str, bytes] = {}

    def packed(ids: list[int]) -> bytes:
        return b"".join(i.to_bytes(4, "little") for i in ids)

    def encode(text: str) -> bytes:
        if "<|" in text or not _PLAIN.fullmatch(text):
            return packed(whole.encode(text, add_special_tokens=False).ids)
        pieces = _PIECES.findall(text.lower())
        try:
            return b"".join(map(known.__getitem__, pieces))
        except KeyError:
            if len(known) > REMEMBERED:
                known.clear()
            for piece in pieces:
                if piece not in known:
                    shown = piece.encode().decode("latin-1").translate(letters)
                    known[piece] = packed([t.id for t in merge(shown)])
            return b"".join(map(known.__getitem__, pieces))

    return encode


def encode_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    path: str | None = None, end_id: int = END_ID,
) -> DataFrame:
    """doc_id, part, start in the part, n and ids (binary) of every row, stored."""
    where = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(where), end_id.to_bytes(4, "little")
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = [encode(t or "") + end for t in batch.column(1).to_pylist()]
            sizes = [len(x) // 4 for x in ids]
            starts = []
            for n in sizes:
                starts.append(at)
                at += n
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([part] * len(ids), pa.int64()),
                    pa.array(starts, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                names=["doc_id", "part", "local_start", "n", "ids"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, part long, local_start long, n long, ids binary"
    return stage(rows.mapInArrow(run, schema), "encoded")


def partition_starts(encoded: DataFrame) -> DataFrame:
    """part, part_start: prefix sums over the partitions' totals, one row per partition."""
    totals = encoded.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("part_start"))


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    path: str | None = None, end_id: int = END_ID, window: int = SEQUENCE_TOKENS,
) -> DataFrame:
    """Boundary records: the piece of each document in each window, with its ids.

    Columns doc_id, start, length, ids (binary), doc_tokens, sequence_id, offset.
    """
    encoded = encode_documents(docs, id_col, text_col, path, end_id)
    # one row per stored partition, far below any broadcast limit
    starts = F.broadcast(partition_starts(encoded))
    begin = F.col("part_start") + F.col("local_start")
    placed = encoded.join(starts, "part").select("doc_id", "n", "ids", begin.alias("begin"))
    first, last = F.expr(f"begin div {window}"), F.expr(f"(begin + n - 1) div {window}")

    def piece(w: F.Column) -> F.Column:
        left = F.greatest(w * window, F.col("begin"))
        right = F.least((w + 1) * window, F.col("begin") + F.col("n"))
        start = left - F.col("begin")
        return F.struct(
            start.alias("start"),
            (right - left).alias("length"),
            F.substr("ids", (start * 4 + 1).cast("int"), ((right - left) * 4).cast("int")).alias("ids"),
            w.alias("sequence_id"),
            (left - w * window).alias("offset"),
        )

    pieces = placed.select(
        "doc_id", F.col("n").alias("doc_tokens"),
        F.inline(F.transform(F.sequence(first, last), piece)),
    )
    return pieces.select("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")


def sequences(pieces: DataFrame, window: int = SEQUENCE_TOKENS, pad_id: int = 0) -> DataFrame:
    """Pieces joined into windows: sequence_id, ids (binary), n_tokens, padded_tokens, doc_ids.

    A window holds at most `window` ids.  A short one is padded, unless its length
    is a power of two, which trainers take as it is.
    """
    joined = pieces.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id", "length"))).alias("p"),
        F.sum("length").alias("n_tokens"),
    )
    n = F.col("n_tokens")
    even = n.bitwiseAND(n - 1) == 0
    padded = F.when(even, n).otherwise(F.lit(window))
    pad = F.lit(pad_id.to_bytes(4, "little"))
    filler = F.expr("aggregate(p, cast('' as binary), (a, x) -> concat(a, x.ids))")
    return joined.select(
        "sequence_id",
        F.concat(filler, F.unhex(F.repeat(F.hex(pad), (padded - n).cast("int")))).alias("ids"),
        n,
        padded.alias("padded_tokens"),
        F.col("p.doc_id").alias("doc_ids"),
        F.col("p.length").alias("lengths"),
    )


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset",
    )
