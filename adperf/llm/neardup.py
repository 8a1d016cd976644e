"""Near-duplicate documents by an LSH forest.

A document is its set of distinct five-word shingles.  Documents of equal sets are
one class, of which the smallest id goes on.  `TREES` sorted orders of MinHash
signatures, each of `DEPTH` values, are the forest.  In each order a document's
candidates are the `REACH` ones on either side with which it shares the longest
prefix, at least `LEAST_DEPTH` values; a region of an order that holds more than
`REGION_ROWS` documents is cut at one value more, again and again, so the depth
follows the density.  Candidates whose sketches are far apart are left out, by a
margin of six standard errors below the threshold.

Links are confirmed on the full sets, in rounds: the nearest partners of every
document first; then components are put on the forest, and neighbours of different
components are compared.  A candidate of some member of a group that did not link is then compared with that
group's hubs, the members with the most links, until no round finds a link.  So a
document that is near only to the centre of a large group is found without
comparing all pairs.

Last, documents whose regions held more than their reach are closed exactly: a
prefix, position and length join over their shingles, rarest first, gives every pair
of different components that can be similar (see `crowd_pairs`).

Texts lie in chunks that stay where they are (see `chunks`): signatures, the sets of
candidates and the rows that stay are all read from there.

Defined cases: null and empty texts have no shingles and link with nothing; texts of
fewer than five words are one shingle, the whole sequence; rows of one id count as
one document if their sets are equal, otherwise each set is a document of its own; a null id is left out of the groups and kept
by `first_of_groups`; very long texts are read whole; an empty table gives no rows;
other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adperf.llm import chunks as C
from adperf.llm import textvec
from adperf.llm.components import components, extended
from adperf.sources.staging import stage

SHINGLE = 5
SIMILAR = (75, 100)  # intersection * 100 >= union * 75
TREES, DEPTH, LEAST_DEPTH = 20, 6, 2
REACH = 4
REGION_ROWS = 256
#: Hash functions; those beyond the trees only lengthen the sketch.
FUNCTIONS = 128
#: Bits of the sketch that may differ: a pair at the threshold differs in 16 of 128, +- 3.7.
MAX_APART = 38
FIRST_PARTNERS = 2
HUBS = 4
#: Rows of one shingle that a task of the exact join holds on one side.
SHINGLE_ROWS = 512

_A = textvec.mix(np.arange(1, FUNCTIONS + 1, dtype=np.uint64)) | np.uint64(1)
_B = textvec.mix(np.arange(1001, 1001 + FUNCTIONS, dtype=np.uint64))
_SET1, _SET2 = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


def shingles(flat: np.ndarray, offsets: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending within it, and their number."""
    hashes, counts = textvec.words(flat, offsets)
    texts = len(counts)
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    owner = np.repeat(np.arange(texts), counts)
    runs = textvec.chained(hashes, n)
    whole = owner[: len(runs)] == owner[n - 1 :] if len(runs) else np.zeros(0, bool)
    keys, owners = runs[whole], owner[: len(runs)][whole]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        few = [textvec.chained(hashes[first[i] : first[i] + counts[i]], counts[i])[0] for i in short]
        length = counts[short].astype(np.uint64)
        few = textvec.mix(np.array(few, np.uint64) ^ (length * _SET1))
        keys, owners = np.concatenate([keys, few]), np.concatenate([owners, short])
    order = np.lexsort((keys, owners))
    keys, owners = keys[order], owners[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])
    keys, owners = keys[new], owners[new]
    return keys, np.bincount(owners, minlength=texts).astype(np.int64)


def set_names(keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Two sums over each set that name it; 0 for sets without shingles."""
    names = np.zeros((len(sizes), 2), np.uint64)
    some = np.flatnonzero(sizes)
    starts = np.concatenate([[0], np.cumsum(sizes[some])])[:-1]
    if len(some):
        for j, salt in enumerate((_SET1, _SET2)):
            names[some, j] = np.add.reduceat(textvec.mix(keys ^ salt), starts)
    return names


def signatures(keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """MinHash values (texts x FUNCTIONS); rows without shingles are 0."""
    values = np.zeros((len(sizes), FUNCTIONS), np.uint32)
    some = np.flatnonzero(sizes)
    starts = np.concatenate([[0], np.cumsum(sizes[some])])[:-1]
    if len(some):
        for j in range(FUNCTIONS):
            high = ((keys * _A[j] + _B[j]) >> np.uint64(32)).astype(np.uint32)
            values[some, j] = np.minimum.reduceat(high, starts)
    return values


def describe(chunks: DataFrame, id_at: int, text_at: int) -> DataFrame:
    """A row per document: doc_id, its place (chunk, row), n_shingles, set1, set2 (the set's name),
    s1, s2 (sketch) and sig. Stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = (np.uint64(1) << np.arange(64, dtype=np.uint64))[None]
        for batch in batches:
            for i in range(len(batch)):
                ids = C.texts_of(batch.column("rows"), i, f"f{id_at}").cast(pa.int64())
                flat, offsets = textvec.text_bytes(C.texts_of(batch.column("rows"), i, f"f{text_at}"))
                chunk = batch.column("chunk")[i].as_py()
                for a, b in textvec.blocks(offsets):
                    keys, sizes = shingles(flat[offsets[a] : offsets[b]], offsets[a : b + 1])
                    values, names = signatures(keys, sizes), set_names(keys, sizes)
                    bits = (textvec.mix(values.astype(np.uint64)) & np.uint64(1)).reshape(len(sizes), 2, 64)
                    sketch = (bits * weights[None]).sum(2).view(np.int64)
                    tree = np.ascontiguousarray(values[:, : TREES * DEPTH].astype(">u4"))
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.slice(a, b - a), pa.array([chunk] * (b - a), pa.int64()),
                            pa.array(np.arange(a, b, dtype=np.int32)), pa.array(sizes),
                            pa.array(names[:, 0].view(np.int64)), pa.array(names[:, 1].view(np.int64)),
                            pa.array(sketch[:, 0]), pa.array(sketch[:, 1]),
                            pa.array([r.tobytes() for r in tree], pa.binary()),
                        ],
                        names=["doc_id", "chunk", "row", "n_shingles", "set1", "set2", "s1", "s2", "sig"],
                    )

    schema = (
        "doc_id long, chunk long, row int, n_shingles long, set1 long, set2 long, s1 long, s2 long, sig binary")
    return stage(chunks.select("chunk", "rows").mapInArrow(run, schema), "signatures")


def _apart(x: Column, y: Column) -> Column:
    def bits(c: str) -> Column:
        return F.bit_count(x[c].bitwiseXOR(y[c]))

    return bits("s1") + bits("s2")


def forest_rows(reps: DataFrame, *also: str) -> DataFrame:
    """A row of each document for each tree: region (a prefix of the tree's values), key, id, sketch.

    With a column `moved`, a tree's region is the one given there, if any.
    """
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(TREES - 1)),
        lambda t: F.struct(t.alias("tree"), F.substr("sig", t * (4 * DEPTH) + 1, F.lit(4 * DEPTH)).alias("key")),
    )
    moved = ["moved"] if "moved" in reps.columns else []
    rows = reps.select("id", "s1", "s2", *also, *moved, F.inline(keys))
    region = F.xxhash64("tree", F.substr("key", F.lit(1), F.lit(4 * LEAST_DEPTH)))
    if moved:
        region = F.coalesce(F.try_element_at("moved", F.col("tree")), region)
    return rows.withColumn("region", region).drop("moved")


def settle_regions(reps: DataFrame) -> DataFrame:
    """`reps` with `moved`, a map of tree to region where the region of LEAST_DEPTH values is too full.

    A region that is too full is cut at one value more until it fits or values end.
    Documents that share every value of a tree are near-equal; what is still too full
    then is cut into blocks by a hash of tree and id, another cut in every tree.
    """
    rows, settled = forest_rows(reps).select("id", "tree", "key", "region"), None
    for depth in range(LEAST_DEPTH + 1, DEPTH + 2):
        full = rows.groupBy("region").count().filter(F.col("count") > REGION_ROWS)
        full = stage(full, "full")
        if full.isEmpty():
            break
        if depth > LEAST_DEPTH + 1:
            rest = rows.join(full, "region", "left_anti")
            settled = rest if settled is None else settled.unionByName(rest)
        blocks = F.ceil(F.col("count") / REGION_ROWS)
        block = F.xxhash64("region", F.pmod(F.xxhash64("tree", "id"), blocks))
        deeper = F.xxhash64("tree", F.substr("key", F.lit(1), F.lit(4 * depth))) if depth <= DEPTH else block
        rows = stage(rows.join(full, "region").withColumn("region", deeper).drop("count"), "deeper")
    else:
        depth += 1
    if depth == LEAST_DEPTH + 1:  # no region was too full
        return reps
    settled = rows if settled is None else settled.unionByName(rows)
    moved = settled.groupBy("id").agg(  # TREES entries at most
        F.map_from_entries(F.collect_list(F.struct("tree", "region"))).alias("moved"))
    return stage(reps.join(moved, "id", "left"), "settled")


def nearest_partners(reps: DataFrame) -> DataFrame:
    """a < b: each document with the FIRST_PARTNERS nearest of its neighbours in all orders."""
    order = Window.partitionBy("region").orderBy("key", "id")
    near = [
        step(F.struct("id", "s1", "s2"), k).over(order) for k in range(1, REACH + 1) for step in (F.lead, F.lag)]
    rows = forest_rows(reps)
    rows = rows.select(F.struct("id", "s1", "s2").alias("x"), F.array_compact(F.array(*near)).alias("near"))
    apart = F.transform("near", lambda y: F.struct(_apart(F.col("x"), y).alias("apart"), y["id"].alias("id")))
    rows = rows.select("x.id", F.filter(apart, lambda y: y["apart"] <= MAX_APART).alias("near"))
    best = rows.filter(F.size("near") > 0).select(
        "id", F.explode(F.slice(F.array_sort("near"), 1, FIRST_PARTNERS)).alias("y"))
    best = best.groupBy("id").agg(F.collect_set("y").alias("near"))  # of each tree two at most
    pairs = best.select("id", F.explode(F.slice(F.array_sort("near"), 1, FIRST_PARTNERS)).alias("y"))
    return pairs.select(F.least("id", "y.id").alias("a"), F.greatest("id", "y.id").alias("b")).distinct()


def candidates(reps: DataFrame, labels: DataFrame) -> DataFrame:
    """a < b: neighbours in some order of the forest that lie in different components so far.

    Components are put on the documents before neighbours meet, so that a group of
    copies that has come together makes no pairs of its own any more.
    """
    roots = labels.select(F.col("node").alias("id"), F.col("root").alias("_root"))
    rooted = reps.join(roots, "id", "left").withColumn("root", F.coalesce("_root", "id")).drop("_root")
    order = Window.partitionBy("region").orderBy("key", "id")
    near = [F.lead(F.struct("id", "s1", "s2", "root"), k).over(order) for k in range(1, REACH + 1)]
    rows = forest_rows(rooted, "root").select(
        F.struct("id", "s1", "s2", "root").alias("x"), F.array_compact(F.array(*near)).alias("near"))
    other = F.filter(
        "near", lambda y: (y["root"] != F.col("x")["root"]) & (_apart(F.col("x"), y) <= MAX_APART))
    pairs = rows.select("x.id", F.explode(F.transform(other, lambda y: y["id"])).alias("y"))
    return pairs.select(F.least("id", "y").alias("a"), F.greatest("id", "y").alias("b")).distinct()


def full_sets(chunks: DataFrame, wanted: DataFrame, text_at: int) -> DataFrame:
    """id, items: the whole sets, as ascending 64-bit hashes, of the wanted documents (id, chunk, row)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                asked = batch.column("wanted")[i].as_py()
                at = pa.array([w["row"] for w in asked], pa.int64())
                flat, offsets = textvec.text_bytes(C.texts_of(batch.column("rows"), i, f"f{text_at}").take(at))
                for a, b in textvec.blocks(offsets):
                    keys, sizes = shingles(flat[offsets[a] : offsets[b]], offsets[a : b + 1])
                    cuts = np.concatenate([[0], np.cumsum(sizes)])
                    items = [keys[cuts[k] : cuts[k + 1]].tobytes() for k in range(b - a)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([w["id"] for w in asked[a:b]], pa.int64()), pa.array(items, pa.binary())],
                        names=["id", "items"])

    by_chunk = wanted.groupBy("chunk").agg(  # at most the rows of one chunk
        F.collect_list(F.struct("id", "row")).alias("wanted"))
    met = chunks.join(by_chunk, "chunk").select("rows", "wanted")
    # by id, so that the pairs come to the sets
    return C.bucketed(met.mapInArrow(run, "id long, items binary").repartition("id"), "id")


def confirm(pairs: DataFrame, sets: DataFrame, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """The pairs (a, b) with `linked`: whether the full sets are similar enough."""
    need, of = similar

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                u, v = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                if len(u) > len(v):
                    u, v = v, u
                at = np.minimum(np.searchsorted(v, u), len(v) - 1)
                both = int((v[at] == u).sum()) if len(u) else 0
                linked.append(len(u) > 0 and of * both >= need * (len(u) + len(v) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    size = F.length("items")
    x = sets.select(F.col("id").alias("a"), F.col("items").alias("x"), size.alias("nx"))
    y = sets.select(F.col("id").alias("b"), F.col("items").alias("y"), size.alias("ny"))
    met = pairs.select("a", "b").join(x, "a").join(y, "b")
    # the smaller set must have the share of the larger one that is asked for
    met = met.filter(F.least("nx", "ny") * of >= F.greatest("nx", "ny") * need)
    return stage(met.select("a", "b", "x", "y").mapInArrow(run, "a long, b long, linked boolean"), "confirmed")


def crowded(reps: DataFrame) -> DataFrame:
    """id of the documents of a region whose documents do not all meet each other."""
    rows = forest_rows(reps).select("region", "id")
    full = rows.groupBy("region").count().filter(F.col("count") > REACH + 1)
    return rows.join(full, "region", "left_semi").select("id").distinct()


def crowd_pairs(sets: DataFrame, labels: DataFrame, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """a < b: all pairs of different components that can be similar, an exact join.

    With the shingles of each set rarest first, the first one that two similar sets
    share leaves enough behind it in both.  A shingle that only one component has
    counts in the order but joins nothing, and of a shingle's most frequent component
    no two rows meet.  Rows of a frequent shingle are dealt over tasks.
    """
    need, of = similar

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                keys = np.frombuffer(batch.column(2)[i].as_py(), np.int64)
                repeated = [pa.array(np.full(len(keys), c[i].as_py(), np.int64)) for c in batch.columns[:2]]
                yield pa.RecordBatch.from_arrays(
                    [*repeated, pa.array(np.full(len(keys), len(keys), np.int64)), pa.array(keys)],
                    names=["id", "root", "n", "shingle"])

    rooted = sets.join(labels.select(F.col("node").alias("id"), F.col("root").alias("_root")), "id", "left")
    rows = stage(rooted.select("id", F.coalesce("_root", "id").alias("root"), "items").mapInArrow(
        run, "id long, root long, n long, shingle long"), "crowd")
    known = rows.groupBy("shingle", "root").agg(F.count("*").alias("f")).groupBy("shingle").agg(
        F.sum("f").alias("f"), F.max_by("root", F.struct("f", "root")).alias("most"), F.count("*").alias("roots"))
    shared = rows.join(known.filter("f > 1"), "shingle").groupBy("id", "root", "n").agg(  # one set's own shingles
        F.sort_array(F.collect_list(F.struct("f", "shingle", "most", "roots"))).alias("s"))
    placed = shared.select("id", "root", "n", F.size("s").alias("_k"), F.posexplode("s").alias("_at", "s"))
    placed = placed.select(  # left: the shingle and all behind it
        "id", "root", "n", (F.col("_k") - F.col("_at")).cast("long").alias("left"), "s.*")
    placed = stage(placed.filter((F.col("roots") > 1) & (F.col("left") * of >= F.col("n") * need)), "prefixes")

    parts = F.ceil(F.col("f") / SHINGLE_ROWS)
    x = placed.filter(F.col("left") * (need + of) >= 2 * need * F.col("n"))  # the smaller set of a pair
    x = x.withColumn("part", F.pmod(F.xxhash64("id"), parts))
    y = placed.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))

    def met(x: DataFrame, y: DataFrame) -> DataFrame:
        x, y = x.alias("x"), y.alias("y")
        fits = F.least("x.left", "y.left") * (need + of) >= need * (F.col("x.n") + F.col("y.n"))
        found = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.part") == F.col("y.part"))
                       & (F.col("x.root") != F.col("y.root")) & (F.col("x.n") <= F.col("y.n"))
                       & (F.col("x.n") * of >= F.col("y.n") * need) & fits)
        return found.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))

    usual = F.col("root") == F.col("most")
    return met(x.filter(~usual), y).unionByName(met(x.filter(usual), y.filter(~usual))).distinct()


def _others(met: DataFrame, labels: DataFrame) -> DataFrame:
    """id, root: the documents of `met` (id, other) with the components of the others that are not their own, each once."""
    other = labels.select(F.col("node").alias("other"), F.col("root").alias("_root"))
    own = labels.select(F.col("node").alias("id"), F.col("root").alias("_own"))
    found = met.join(other, "other", "left").select("id", F.coalesce("_root", "other").alias("root")).distinct()
    return found.join(own, "id", "left").filter(F.coalesce("_own", "id") != F.col("root")).select("id", "root")


def link_classes(reps: DataFrame, chunks: DataFrame, text_at: int) -> DataFrame:
    """node, root of all classes that have a link."""
    crowd = stage(crowded(reps), "crowded")
    reps = settle_regions(reps)
    first = stage(nearest_partners(reps), "nearest")
    # a document that has a neighbour at all is in one of these pairs
    ids = first.select(F.col("a").alias("id")).union(first.select("b")).union(crowd).distinct()
    sets = full_sets(chunks, reps.select("id", "chunk", "row").join(ids, "id"), text_at)
    tried = confirm(first, sets)
    links = tried.filter("linked").select("a", "b")
    labels = components(links)

    pairs = stage(candidates(reps, labels), "candidates")
    more = confirm(pairs.join(first, ["a", "b"], "left_anti"), sets)
    tried = tried.unionByName(more)
    found = stage(more.filter("linked").select("a", "b"), "found")
    met = pairs.select(F.col("a").alias("id"), F.col("b").alias("other")).union(pairs.select("b", "a"))
    while True:
        if not found.isEmpty():
            links = stage(links.unionByName(found), "links")
            labels = extended(labels, found)
        # candidates of a group's members that are not in it meet the group's hubs; a component is
        # named by one of its documents, so from here on that one stands for all that were met in it
        outside = stage(_others(met, labels), "outside")
        met = outside.withColumnRenamed("root", "other")
        ends = links.select(F.col("a").alias("node")).union(links.select("b"))
        degree = ends.groupBy("node").count().join(labels, "node")
        most = Window.partitionBy("root").orderBy(F.desc("count"), "node")
        hubs = degree.withColumn("k", F.row_number().over(most)).filter(F.col("k") <= HUBS).select("root", "node")
        new = outside.join(hubs, "root").select(F.least("id", "node").alias("a"), F.greatest("id", "node").alias("b"))
        new = stage(new.distinct().join(tried.select("a", "b"), ["a", "b"], "left_anti"), "hub_pairs")
        if new.isEmpty():
            break
        more = confirm(new, sets)
        tried = tried.unionByName(more).unionByName(  # what the size filter left out is settled too
            new.join(more.select("a", "b"), ["a", "b"], "left_anti").withColumn("linked", F.lit(False)))
        tried = stage(tried, "tried")
        found = stage(more.filter("linked").select("a", "b"), "found")
        if found.isEmpty():
            break
    if crowd.isEmpty():
        return labels
    new = crowd_pairs(sets.join(crowd, "id", "left_semi"), labels)
    new = stage(new.join(tried.select("a", "b"), ["a", "b"], "left_anti"), "crowd_pairs")
    if new.isEmpty():
        return labels
    found = confirm(new, sets).filter("linked").select("a", "b")
    return extended(labels, found)


def _node() -> Column:
    """A number for the place of a row: 20 bits of its partition, 26 of the chunk in it, 17 of the row."""
    part, chunk = F.shiftright("chunk", 32), F.col("chunk").bitwiseAND(F.lit(0xFFFFFFFF))
    fits = (part < 1 << 20) & (chunk < 1 << 26) & (F.col("row") < 1 << 17)
    node = F.shiftleft(part, 43) + F.shiftleft(chunk, 17) + F.col("row")
    return F.when(fits, node).otherwise(F.raise_error(F.lit("too many rows in a partition; repartition the input")))


def _grouped(chunks: DataFrame, id_at: int, text_at: int) -> DataFrame:
    """doc_id, chunk, row, n_shingles, component_id and first, one row for each id and set."""
    described = describe(chunks, id_at, text_at)
    name, place = ["set1", "set2", "n_shingles"], F.struct("doc_id", "chunk", "row")
    own = described.filter("doc_id is not null").groupBy("doc_id", *name).agg(F.min(F.struct("chunk", "row")).alias("x"))
    own = stage(own.select("doc_id", *name, "x.*"), "documents")
    classes = own.filter("n_shingles > 0").groupBy(*name).agg(F.min(place).alias("x"))
    classes = stage(classes.select(*name, "x.*").withColumn("rep", _node()), "classes")
    reps = described.select("chunk", "row", "s1", "s2", "sig").join(
        classes.select(F.col("rep").alias("id"), "chunk", "row"), ["chunk", "row"])
    labels = link_classes(stage(reps, "reps"), chunks, text_at)
    rooted = classes.join(labels, classes["rep"] == labels["node"], "left").select(
        *name, place.alias("x"), F.coalesce("root", "rep").alias("root"))
    rooted = stage(rooted, "rooted")
    leads = rooted.groupBy("root").agg(F.min("x").alias("lead"))
    named = rooted.join(leads, "root").select(*name, "lead")
    return own.join(named, name, "left").select(
        "doc_id", "chunk", "row", "n_shingles", F.coalesce("lead.doc_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("lead") == place, F.lit(True)).alias("first"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable) and kept, one row for each id and set."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = _grouped(C.cut(rows, "text"), 0, 1)
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def first_of_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The first row of each group of `docs`, unchanged; rows without an id all stay."""
    id_at, text_at = docs.columns.index(id_col), docs.columns.index(text_col)
    chunks, fields = C.cut(docs, text_col), docs.schema.fields
    kept = _grouped(chunks, id_at, text_at).filter("first")
    by_chunk = kept.groupBy("chunk").agg(F.collect_list("row").alias("kept"))  # at most the rows of one chunk

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                columns = [C.texts_of(batch.column("rows"), i, f"f{j}") for j in range(len(fields))]
                stay = columns[id_at].is_null().to_numpy(zero_copy_only=False).copy()
                stay[batch.column("kept")[i].as_py() or []] = True
                yield pa.RecordBatch.from_arrays(columns, names=[f"f{j}" for j in range(len(fields))]).filter(pa.array(stay))

    schema = T.StructType([T.StructField(f"f{j}", f.dataType) for j, f in enumerate(fields)])
    rows = chunks.join(by_chunk, "chunk", "left").select("rows", "kept").mapInArrow(run, schema)
    return rows.select(*[F.col(f"f{j}").alias(f.name) for j, f in enumerate(fields)])


#: All pairs that share a shingle, and what is reachable over the links.
SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, [x for x in string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+') if x <> ''] AS ws
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct([array_to_string(ws[i:i+4], ' ') for i in range(1, len(ws) - 3)]) END AS items
  FROM w),
items AS (SELECT doc_id, unnest(items) AS item FROM sets),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM items x JOIN items y ON x.item = y.item AND x.doc_id <> y.doc_id
  JOIN sets s ON s.doc_id = x.doc_id JOIN sets t ON t.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, len(s.items), len(t.items)
  HAVING 100 * count(*) >= 75 * (len(s.items) + len(t.items) - count(*))),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, CAST(len(s.items) AS BIGINT) AS n_shingles,
  least(s.doc_id, coalesce(m.low, s.doc_id)) AS component_id,
  s.doc_id <= coalesce(m.low, s.doc_id) AS kept
FROM sets s LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) m ON m.a = s.doc_id
"""
