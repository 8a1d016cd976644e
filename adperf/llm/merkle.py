"""Merkle manifest of a dataset, kept as a postorder append log.

Every group of rows (a source) has a tree over its rows' digests in the order of their
ids; the groups' roots have a tree of their own.  A node is the digest of up to ARITY
neighbours, one alone included, and levels go on until one node is left.

A tree is built by aligned builders: each takes ARITY ** LEVELS neighbouring leaves, so
its top is one node of the tree, and appends leaves and nodes to its segment of the log
in the order in which they are complete.  The next round's builders take those tops as
leaves, so a group of any size is spread over tasks and needs one round for each LEVELS
levels.  Where a node lies in such a log follows from the sizes of the subtrees before
it (`places`), so a proof reads its siblings by address; nothing is searched.  Proofs
come from the top down: each round's segment joins the path of its top and gives the
paths of its leaves.

Rows are numbered by a range sort: only the first group of a partition can have begun in
an earlier one, so a table of one row a partition gives every row its place.

Defined cases: a null field is `-`, any other its UTF-8 bytes, with their number before
them; a null group comes before all others, a null id before all ids; rows of equal group
and id go by their digest, wholly equal rows are leaves of their own; a group of one row
has that row's digest as its root; one group is the root itself; an empty table gives no
rows and no root; texts of any length are hashed whole; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adperf.sources.staging import stage

ARITY = 3
#: Levels that a builder completes: segments of at most 3 ** 7 leaves.
LEVELS = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The one tree of the groups' roots.
TOP = ""


def row_digest(fields: Sequence[Column]) -> Column:
    """Digest of a row: of all fields, each with its length, so that no two rows read alike."""
    strings = [f.cast("string") for f in fields]
    return F.sha2(
        F.concat(*[F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")) for s in strings]), 256)


def leaves(
    rows: DataFrame, claimed: dict[str, Column] | None = None, when: Column | None = None,
    id_col: str = "doc_id", group_col: str = "source", fields: Sequence[str] = FIELDS,
) -> DataFrame:
    """tree, key, leaf and claim: the digest of each row, and of what a reader holds of it.

    `claimed` has other values of some fields; they count where `when` is true, and
    claim is null elsewhere.
    """
    own = {f: F.col(f"`{f}`") for f in fields}
    group = F.col(f"`{group_col}`").cast("string")
    claim = F.lit(None).cast("binary")
    if claimed:
        claim = F.when(F.coalesce(when, F.lit(False)), F.unhex(row_digest([claimed.get(f, c) for f, c in own.items()])))
    return rows.select(
        # '0' for null, so that it is a key like others and the first
        F.coalesce(F.concat(F.lit("1"), group), F.lit("0")).alias("tree"),
        F.col(f"`{id_col}`").cast("long").alias("key"),
        F.unhex(row_digest(list(own.values()))).alias("leaf"),
        claim.alias("claim"),
    )


def group_of(tree: Column) -> Column:
    """The group whose tree it is."""
    return F.when(tree != "0", F.substring(tree, 2, 1 << 30))


# ---------------------------------------------------------------- places in a log


def height_of(n: int) -> int:
    """Levels above n leaves until one node is left."""
    h, width = 0, 1
    while width < n:
        h, width = h + 1, width * ARITY
    return h


def place(level: int, index: np.ndarray, n: int, height: int) -> np.ndarray:
    """Where nodes of a level stand in the postorder log of n leaves.

    Once leaf number e is the last below a node, all nodes that are complete by then
    come before it, but for those above it, which the same leaf completes later.
    """
    e = np.minimum((np.asarray(index, np.int64) + 1) * ARITY**level, n)
    before = sum(-(-e // ARITY**j) for j in range(level + 1))
    return before + sum((e - 1) // ARITY**j for j in range(level + 1, height + 1)) - 1


@lru_cache(maxsize=64)
def places(n: int, height: int) -> tuple[np.ndarray, ...]:
    """Places of all nodes, level by level."""
    return tuple(place(level, np.arange(-(-n // ARITY**level)), n, height) for level in range(height + 1))


def append_log(found: Sequence[str], height: int) -> list[str]:
    """Leaves and nodes in the order in which they are complete."""
    log: list[str] = []
    waiting: list[list[str]] = [[] for _ in range(height + 1)]
    for count, node in enumerate(found, 1):
        level = 0
        log.append(node)
        waiting[0].append(node)
        while level < height and (len(waiting[level]) == ARITY or count == len(found)):
            node = hashlib.sha256("".join(waiting[level]).encode()).hexdigest()
            waiting[level].clear()
            level += 1
            log.append(node)
            waiting[level].append(node)
    return log


@lru_cache(maxsize=64)
def _runs(n: int, height: int) -> tuple[np.ndarray, np.ndarray]:
    """For each leaf the places of its run on every level, its own being -1, and the run's sizes."""
    entries, sizes, leaf = [], [], np.arange(n)
    for level in range(height):
        at = places(n, height)[level]
        own = leaf // ARITY**level
        first = own // ARITY * ARITY
        members = first[:, None] + np.arange(ARITY)
        there = members < len(at)
        where = np.where(members == own[:, None], -1, at[np.minimum(members, len(at) - 1)])
        entries.append(np.where(there, where, -2))
        sizes.append(there.sum(1))
    if not height:
        return np.zeros((n, 0), np.int64), np.zeros((n, 0), np.int64)
    return np.concatenate(entries, 1), np.stack(sizes, 1)


# ---------------------------------------------------------------- numbering and building


def numbered(rows: DataFrame, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with `idx`, their place in their tree; tree and n, its leaves)."""
    tie = "_tie"  # equal rows may be many; their order is of no matter
    by = ["tree", *order, tie]
    spread = rows.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by).drop(tie)
    at = rows.columns.index("tree")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen, begun = TaskContext.get().partitionId(), None, 0, True
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            tree = batch.column(at)
            new = np.ones(n, bool)
            new[0] = last is None or tree[0].as_py() != last
            if n > 1:
                new[1:] = pc.not_equal(tree.slice(1), tree.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            if last is not None and new[0]:
                begun = False
            start = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            local = np.where(start < 0, seen + np.arange(n), np.arange(n) - start)
            turns = np.flatnonzero(new)
            later = turns[turns > 0]
            first = np.full(n, begun)
            if len(later):
                first[later[0]:] = False
                begun = False
            last, seen = tree[n - 1].as_py(), int(local[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(local.astype(np.int64)), pa.array(first)],
                names=[*batch.schema.names, "part", "local", "first"],
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", part int, local long, first boolean"
    placed = stage(spread.mapInArrow(count, schema), "ordered")
    runs = stage(
        placed.groupBy("tree", "part").agg((F.max("local") + 1).alias("n"), F.bool_or("first").alias("first")), "runs")
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for a partition at most
    begun = runs.withColumn("earlier", F.sum("n").over(earlier)).filter("first AND earlier IS NOT NULL").select("part", "earlier")
    idx = F.col("local") + F.when(F.col("first"), F.coalesce("earlier", F.lit(0))).otherwise(0)
    members = placed.join(F.broadcast(begun), "part", "left").withColumn("idx", idx).drop("part", "local", "first", "earlier")
    return members, runs.groupBy("tree").agg(F.sum("n").alias("n"))


def build_segments(members: DataFrame, levels: int) -> DataFrame:
    """One round: tree, block, n, height, nodes (the segment), keys and claims of its leaves, top."""
    size = ARITY**levels
    key = members.schema["key"].dataType.simpleString()
    blocks = members.groupBy("tree", F.expr(f"idx div {size}").alias("block")).agg(
        F.collect_list(F.struct("idx", "leaf", "key", "claim")).alias("rows"))  # at most `size`

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                rows, block = batch.column("rows")[i].values, batch.column("block")[i].as_py()
                rows = rows.take(pa.array(np.argsort(rows.field("idx").to_numpy(), kind="stable")))
                n = len(rows)
                # a segment that is full or not the first has segments beside it, or might
                height = levels if block or n == size else height_of(n)
                log = append_log([x.hex() for x in rows.field("leaf").to_pylist()], height)
                nodes = bytes.fromhex("".join(log))
                one = pa.array([0, n], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("tree").slice(i, 1), pa.array([block], pa.int64()), pa.array([n], pa.int32()),
                        pa.array([height], pa.int32()), pa.array([nodes], pa.binary()),
                        pa.ListArray.from_arrays(one, rows.field("key")), pa.ListArray.from_arrays(one, rows.field("claim")),
                        pa.array([nodes[-32:]], pa.binary()),
                    ],
                    names=["tree", "block", "n", "height", "nodes", "keys", "claims", "top"],
                )

    schema = (
        f"tree string, block long, n int, height int, nodes binary, keys array<{key}>, claims array<binary>, top binary")
    return stage(blocks.mapInArrow(run, schema), "segments")


def build_rounds(members: DataFrame, levels: int) -> list[DataFrame]:
    """Segments round by round, until every tree has one top."""
    rounds = []
    while True:
        segments = build_segments(members, levels)
        rounds.append(segments)
        # trees of several segments go on
        more = stage(segments.filter("block > 0").select("tree").distinct(), "more")
        if more.isEmpty():
            return rounds
        members = segments.join(more, "tree", "left_semi").select(
            "tree", F.col("block").alias("idx"), F.col("top").alias("leaf"), F.lit(None).cast("long").alias("key"),
            F.lit(None).cast("binary").alias("claim"))


@dataclass
class Manifest:
    """The log of all trees.

    `groups` and `tops` are the rounds of the groups' trees and of the tree of their
    roots; `sizes` has tree and n; `root` is the root's digest, None for no rows.
    """

    groups: list[DataFrame]
    tops: list[DataFrame]
    sizes: DataFrame
    root: str | None
    levels: int

    def subroots(self) -> DataFrame:
        """tree, round, top: the root of every group."""
        found = None
        for r, segments in enumerate(self.groups):
            own = segments
            if r + 1 < len(self.groups):
                own = own.join(self.groups[r + 1].select("tree").distinct(), "tree", "left_anti")
            own = own.select("tree", F.lit(r).alias("round"), "top")
            found = own if found is None else found.unionByName(own)
        return found


def build(rows: DataFrame, levels: int = LEVELS) -> Manifest:
    """The manifest of `leaves`."""
    members, sizes = numbered(rows, ["key", "leaf"])
    groups = build_rounds(members, levels)
    manifest = Manifest(groups, [], stage(sizes, "sizes"), None, levels)
    roots = manifest.subroots().select(
        F.lit(TOP).alias("tree"), F.col("tree").alias("key"), F.col("top").alias("leaf"),
        F.lit(None).cast("binary").alias("claim"))
    manifest.tops = build_rounds(numbered(roots, ["key"])[0], levels)
    root = manifest.tops[-1].select(F.lower(F.hex("top"))).first()
    manifest.root = root[0] if root else None
    return manifest


# ---------------------------------------------------------------- reading the log


def nodes(manifest: Manifest) -> DataFrame:
    """tree, position, level, idx, digest: the whole log of the groups' trees, one row for each node."""
    out = "tree string, position long, level int, idx long, digest string"
    found = None
    for r, segments in enumerate(manifest.groups):
        base = r * manifest.levels
        below = ARITY**manifest.levels

        def run(batches: Iterator[pa.RecordBatch], base: int = base) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(len(batch)):
                    block, n, height, total = (batch.column(c)[i].as_py() for c in ("block", "n", "height", "total"))
                    data = batch.column("nodes")[i].as_py().hex()
                    where = places(n, height)
                    for level in range(1 if base else 0, height + 1):  # later rounds repeat tops as their leaves
                        here = where[level]
                        index = block * below // ARITY**level + np.arange(len(here))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([batch.column("tree")[i].as_py()] * len(here), pa.string()),
                                pa.array(place(base + level, index, total, height_of(total))),
                                pa.array(np.full(len(here), base + level, np.int32)), pa.array(index.astype(np.int64)),
                                pa.array([data[64 * p : 64 * p + 64] for p in here], pa.string()),
                            ],
                            names=["tree", "position", "level", "idx", "digest"],
                        )

        sized = segments.join(manifest.sizes.withColumnRenamed("n", "total"), "tree")
        part = sized.select("tree", "block", "n", "height", "nodes", "total").mapInArrow(run, out)
        found = part if found is None else found.unionByName(part)
    return found


def _extract(segments: DataFrame, levels: int, top: bool) -> DataFrame:
    """tree, idx, key, leaf, claim, subroot, path of every leaf of segments with `path` and `subroot` of their top.

    With `top` the leaves are the groups' roots, each its own subroot.
    """
    key = segments.schema["keys"].dataType.elementType.simpleString()
    size = ARITY**levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                block, n, height = (batch.column(c)[i].as_py() for c in ("block", "n", "height"))
                data = batch.column("nodes")[i].as_py().hex()
                held = len(data) // 64
                above = batch.column("path")[i].as_py() or []
                own, sizes = _runs(n, height)
                upper = [x for run_ in above for x in run_]
                digests = pa.array([data[64 * p : 64 * p + 64] for p in range(held)] + upper, pa.string())
                entries = np.concatenate([own, np.broadcast_to(held + np.arange(len(upper)), (n, len(upper)))], 1)
                widths = np.concatenate([sizes, np.broadcast_to([len(x) for x in above], (n, len(above)))], 1)
                flat = entries[entries != -2].astype(np.int64)
                path = digests.take(pa.array(flat, pa.int64(), mask=flat < 0))
                runs = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(widths.ravel())]).astype(np.int32)), path)
                paths = pa.ListArray.from_arrays(
                    pa.array((np.arange(n + 1) * widths.shape[1]).astype(np.int32)), runs)
                leaf = digests.take(pa.array(places(n, height)[0]))
                subroot = leaf if top else pa.array([batch.column("subroot")[i].as_py()] * n, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("tree")[i].as_py()] * n, pa.string()),
                        pa.array(block * size + np.arange(n, dtype=np.int64)), batch.column("keys")[i].values, leaf,
                        batch.column("claims")[i].values, subroot, paths,
                    ],
                    names=["tree", "idx", "key", "leaf", "claim", "subroot", "path"],
                )

    schema = (
        f"tree string, idx long, key {key}, leaf string, claim binary, subroot string, path array<array<string>>")
    columns = ["tree", "block", "n", "height", "nodes", "keys", "claims", "subroot", "path"]
    return segments.select(*columns).mapInArrow(run, schema)


def proofs(manifest: Manifest) -> DataFrame:
    """tree, idx, key, leaf, claim, subroot and path of every row.

    The path has a run of digests for each level from the leaf to the root; the place
    of the node itself is null, so `fold` can put any other digest there.
    """
    levels = manifest.levels
    empty = F.array().cast("array<array<string>>")
    given = None
    for segments in reversed(manifest.tops):
        if given is None:
            upper = segments.withColumns({"path": empty, "subroot": F.lit(None).cast("string")})
        else:
            upper = segments.join(given.select("tree", F.col("idx").alias("block"), "path", "subroot"), ["tree", "block"])
        given = stage(_extract(upper, levels, top=True), "paths")
    roots = given.select(F.col("key").alias("tree"), F.lit(0).cast("long").alias("block"), "path", "subroot")
    roots = roots.join(manifest.subroots().select("tree", "round"), "tree")
    given = None
    for r in reversed(range(len(manifest.groups))):
        above = roots.filter(F.col("round") == r).drop("round")
        if given is not None:
            above = above.unionByName(given.select("tree", F.col("idx").alias("block"), "path", "subroot"))
        given = _extract(manifest.groups[r].join(above, ["tree", "block"]), levels, top=False)
        if r:
            given = stage(given, "paths")
    return given


def siblings(path: Column) -> Column:
    """All siblings on a path, one after the other."""
    return F.array_join(F.flatten(path), "")


def fold(path: str, digest: str) -> Column:
    """The root that a digest leads to along a path; both are SQL expressions."""
    return F.expr(f"aggregate({path}, {digest}, (h, run) -> sha2(array_join(run, '', h), 256))")


def verify(found: DataFrame, root: str | None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of `proofs`."""
    folded = found.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", F.lit(root).cast("string").alias("root"),
        F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
        fold("path", "coalesce(lower(hex(claim)), leaf)").alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def without_newlines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Leaves whose claims, for ids with an even checksum, lack the text's line ends."""
    even = F.crc32(F.col(id_col).cast("long").cast("string").cast("binary")) % 2 == 0
    return leaves(docs, {text_col: F.replace(F.col(text_col), F.lit("\n"), F.lit(""))}, even, id_col)


_FIELDS = " || ".join(
    f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in FIELDS)
#: The trees level by level; each proof from the nodes that share a parent; the fold level by level.
SQL = f"""
WITH RECURSIVE crc AS (
  SELECT *, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), flatten([[CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]
      for c in string_split(CAST(doc_id AS VARCHAR), '')])),
    lambda a, x: xor(xor(a, x) >> 1, CASE WHEN xor(a, x) & 1 = 1 THEN 3988292384 ELSE 0 END)) & 1 = 1 AS even
  FROM documents),
d AS (
  SELECT doc_id, coalesce('1' || source, '0') AS tree, sha256({_FIELDS}) AS leaf,
    sha256({_FIELDS.replace('CAST(text AS VARCHAR)', "CASE WHEN even THEN replace(text, chr(10), '') ELSE text END")}) AS claim
  FROM crc),
r AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY tree) AS n FROM d),
lv AS (
  SELECT tree, 0 AS level, idx, leaf AS h, n FROM r
  UNION ALL
  SELECT tree, level + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 2) // 3
  FROM lv WHERE n > 1 GROUP BY tree, level, idx // 3),
s AS (
  SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM lv WHERE n = 1),
sv AS (
  SELECT 0 AS level, idx, h, n FROM s
  UNION ALL
  SELECT level + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 2) // 3
  FROM sv WHERE n > 1 GROUP BY level, idx // 3),
beside AS (
  SELECT r.tree, r.idx, x.level, x.idx AS pos, x.h FROM r JOIN lv x ON x.tree = r.tree AND x.n > 1
    AND x.idx // 3 = r.idx // CAST(pow(3, x.level + 1) AS BIGINT) AND x.idx <> r.idx // CAST(pow(3, x.level) AS BIGINT)
  UNION ALL
  SELECT r.tree, r.idx, 1000 + x.level, x.idx, x.h FROM r JOIN s USING (tree) JOIN sv x ON x.n > 1
    AND x.idx // 3 = s.idx // CAST(pow(3, x.level + 1) AS BIGINT) AND x.idx <> s.idx // CAST(pow(3, x.level) AS BIGINT)),
proof AS (SELECT tree, idx, sha256(string_agg(h, '' ORDER BY level, pos)) AS p FROM beside GROUP BY tree, idx),
f AS (
  SELECT tree, idx, 0 AS level, idx AS pos, claim AS h FROM r
  UNION ALL
  SELECT f.tree, f.idx, any_value(f.level) + 1, any_value(f.pos) // 3,
    sha256(string_agg(CASE WHEN x.idx = f.pos THEN f.h ELSE x.h END, '' ORDER BY x.idx))
  FROM f JOIN lv x ON x.tree = f.tree AND x.level = f.level AND x.n > 1 AND x.idx // 3 = f.pos // 3
  GROUP BY f.tree, f.idx),
g AS (
  SELECT f.tree, f.idx, 0 AS level, s.idx AS pos, f.h FROM f JOIN lv ON lv.tree = f.tree AND lv.level = f.level AND lv.n = 1
    JOIN s ON s.tree = f.tree
  UNION ALL
  SELECT g.tree, g.idx, any_value(g.level) + 1, any_value(g.pos) // 3,
    sha256(string_agg(CASE WHEN x.idx = g.pos THEN g.h ELSE x.h END, '' ORDER BY x.idx))
  FROM g JOIN sv x ON x.level = g.level AND x.n > 1 AND x.idx // 3 = g.pos // 3
  GROUP BY g.tree, g.idx)
SELECT r.doc_id, r.leaf, s.h AS subroot, t.h AS root, coalesce(p, sha256('')) AS proof_sha256,
  g.h AS folded_root, g.h = t.h AS verified
FROM r JOIN s USING (tree) CROSS JOIN (SELECT * FROM sv WHERE n = 1) t
  JOIN g ON g.tree = r.tree AND g.idx = r.idx AND g.level = t.level
  LEFT JOIN proof ON proof.tree = r.tree AND proof.idx = r.idx
"""
