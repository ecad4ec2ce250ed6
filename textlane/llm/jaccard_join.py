"""N-gram Jaccard self join by chosen paths.

1. Each text becomes its set of five-word shingles; equal sets are one class (its copies are never paired).  A set has a
   signature of minimum hashes whose coordinates serve as its tokens, after the published recursive similarity join.
2. Chosen paths: at a node a set goes to the children of the tokens it samples there, each with probability
   1 / (threshold * tokens); similar sets sample a common token with good probability.  Buckets of one set end, small
   buckets are compared by brute force, larger ones split again by the tokens sampled at their path, to ``MAX_DEPTH``.  What is
   still large then (sets that are nearly equal) is cut into blocks and every pair of blocks is compared: there is no cap.
   ``RUNS`` independent repetitions raise the recall.
3. Buckets compare signatures and give the edges of a spanning forest, not pairs.  Their connected components are the
   candidate clusters; the full sets of a cluster meet once, in blocks, and exact Jaccard decides: links are
   counted per set and again only spanning edges are written.  The components of those are the groups.

Work per task is bounded by the block sizes, whatever the size of a bucket or cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlane.llm.common import hashed_words, mix, seeds, shingles, sorted_runs, spread, starts

THRESHOLD = 0.8
WIDTH = 5
#: Coordinates of a signature, 16 bits each.
TOKENS = 128
RUNS = 10
MAX_DEPTH = 4
#: Buckets of more sets are split, and clusters of more sets are compared in blocks of about this size.
BLOCK = 256
#: Signatures that agree in a share of coordinates this much under the threshold are still candidates (three deviations).
SLACK = 0.11
#: Columns (shingles) of the block matrices multiplied at a time.
_COLUMNS = 4096


# --- sets and signatures ----------------------------------------------------------------------------------------------

def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of each lower-cased text's five-word shingles; a shorter text has one, an empty one none."""
    for words in hashed_words([(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]):
        yield np.unique(shingles(words, WIDTH))


def set_id(values: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(values.tobytes()) - (1 << 63)


_FACTORS = seeds(TOKENS, 5)[:, None]
_PLACES = seeds(TOKENS, 6)


def tokens(values: np.ndarray) -> np.ndarray:
    """The 64-bit tokens of a set: the minimum of each coordinate's hash over the set, mixed with the coordinate."""
    low = np.full(TOKENS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(values), 2048):
        part = values[None, at:at + 2048] * _FACTORS
        low = np.minimum(low, (part ^ (part >> np.uint64(29))).min(axis=1))
    return mix(low ^ _PLACES)


def _sign(threshold: float, runs: int):
    """doc_id, text_key, set_id, sig (16 bits of each token) and paths (first level, of all runs) of every row."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots = seeds(runs, 1234)
        for batch in batches:
            ids, found = [], {}
            for values in shingle_sets(batch.column("text").to_pylist()):
                ids.append(set_id(values) if len(values) else None)
                if len(values) and ids[-1] not in found:
                    found[ids[-1]] = tokens(values)
            sigs, paths = {}, {}
            known = list(found)
            for at in range(0, len(known), 1024):
                some = known[at:at + 1024]
                matrix = np.stack([found[k] for k in some])
                chosen = [_children(matrix, np.full(len(some), root), threshold) for root in roots]
                row, path = np.concatenate([r for r, _ in chosen]), np.concatenate([p for _, p in chosen])
                order = np.argsort(row, kind="stable")
                ends = np.searchsorted(row[order], np.arange(len(some) + 1))
                for k, key in enumerate(some):
                    sigs[key] = matrix[k].astype(np.uint16).tobytes()
                    paths[key] = path[order[ends[k]:ends[k + 1]]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(ids, pa.int64()),
                 pa.array([sigs.get(k) for k in ids], pa.binary()), pa.array([paths.get(k) for k in ids], pa.list_(pa.int64()))],
                names=["doc_id", "text_key", "set_id", "sig", "paths"])
    return sign


# --- chosen paths -----------------------------------------------------------------------------------------------------

def _children(own: np.ndarray, nodes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, path) of every child that the rows' sets (rows of tokens) choose at their nodes."""
    drawn = mix(own ^ nodes[:, None])
    row, token = np.nonzero(drawn < np.uint64(int(2.0 ** 64 / (threshold * TOKENS))))
    return row, mix(drawn[row, token] + nodes[row]).view(np.int64)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, TOKENS)


def _split(threshold: float):
    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            # The 16 bits that signatures keep of a token are enough here: all sets of a bucket share longer tokens already.
            ids = batch.column("set_id").to_numpy()
            own = mix((np.arange(TOKENS, dtype=np.uint64)[None, :] << np.uint64(16)) | _matrix(batch.column("sig")).astype(np.uint64))
            row, path = _children(own, batch.column("path").to_numpy().view(np.uint64), threshold)
            yield pa.RecordBatch.from_arrays([pa.array(path), pa.array(ids[row])], names=["path", "set_id"])
    return choose


def block_pairs(rows: DataFrame, group: str, size: str, block: int = BLOCK) -> DataFrame:
    """Adds a, b and own: a group of more than ``block`` rows is cut into blocks, and each row goes to all pairs with its block.

    A pair of rows meets in exactly one (group, a, b): compare own = a with own = b (all with all where a = b).
    """
    n = F.ceil(F.col(size) / block).cast("int")
    rows = rows.withColumns({"_n": n, "own": F.pmod(F.xxhash64("set_id", group), n).cast("int")})
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return rows.withColumns({"a": F.least("own", "_other"), "b": F.greatest("own", "_other")}).drop("_n", "_other", size)


def _paths(sets: DataFrame, threshold: float) -> DataFrame:
    """path, a, b, own, set_id of every leaf bucket of two sets or more."""
    level = sets.select(F.explode("paths").alias("path"), "set_id")
    leaves = []
    for depth in range(1, MAX_DEPTH + 1):
        many = level.groupBy("path").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
        level = spread(level.join(many, "path"), "buckets")
        # Small buckets are compared as they are; at the last level large ones are too, in blocks.
        leaves.append(level if depth == MAX_DEPTH else level.filter(F.col("n") <= BLOCK))
        large = level.filter(F.col("n") > BLOCK)
        if depth == MAX_DEPTH or large.isEmpty():
            break
        level = spread(large.select("path", "set_id").join(sets.select("set_id", "sig"), "set_id")
                       .select("path", "set_id", "sig").mapInArrow(_split(threshold), "path long, set_id long"), "paths")
    rows = leaves[0]
    for more in leaves[1:]:
        rows = rows.unionByName(more)
    return block_pairs(rows, "path", "n")


# --- comparing --------------------------------------------------------------------------------------------------------

class Forest:
    """Union-find over the rows of one comparison."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]]:
    """(table, rows, left, right) of every group: rows of its distinct sets in id order, and the places in ``rows`` of the
    two sides that are compared (one array for both if the group is one block)."""
    for table in sorted_runs(batches, keys):
        at = [*starts(table, keys), table.num_rows]
        every, own, a, b = (table.column(c).to_numpy() for c in ("set_id", "own", "a", "b"))
        for low, high in zip(at, at[1:], strict=False):
            if high - low < 2:
                continue
            rows = low + np.unique(every[low:high], return_index=True)[1]
            if a[low] == b[low]:
                left = right = np.arange(len(rows))
            else:
                left, right = np.flatnonzero(own[rows] == a[low]), np.flatnonzero(own[rows] == b[low])
            if len(rows) > 1 and len(left) and len(right):
                yield table, rows, left, right


def _near(threshold: float):
    """Buckets -> spanning edges of the pairs whose signatures agree well enough.

    Two blocks of a bucket give only the edges that connect what each block's own comparison leaves apart: nearly equal
    sets have one edge per pair of blocks, not one per set.
    """
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = int(np.floor((threshold - SLACK) * TOKENS))
        low, high, seen = [], [], None

        def edges() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(low, pa.int64()), pa.array(high, pa.int64())], names=["u", "v"])

        def joined(sigs: np.ndarray, part: np.ndarray, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, int]]:
            """Pairs that connect parts (part: each row's, changed here)."""
            for k, x in enumerate(left):
                others = right[k + 1:] if left is right else right
                others = others[part[others] != part[x]]
                for y in others[(sigs[others] == sigs[x]).sum(axis=1) >= least]:
                    if part[x] != part[y]:
                        part[part == part[y]] = part[x]
                        yield int(x), int(y)

        for table, rows, left, right in _groups(batches, ["path", "a", "b"]):
            if table is not seen:
                seen, every, ids = table, _matrix(table.column("sig")), table.column("set_id").to_numpy()
            sigs, part = every[rows], np.arange(len(rows))
            if left is not right:
                for own in (left, right):       # their edges come from the comparison of the block with itself
                    for _ in joined(sigs, part, own, own):
                        pass
            for x, y in joined(sigs, part, left, right):
                low.append(ids[rows[x]])
                high.append(ids[rows[y]])
            if len(low) > 10_000:
                yield edges()
                low, high = [], []
        yield edges()
    return compare


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all left with all right sorted sets, by products of 0/1 matrices."""
    n, m = len(left), len(right)
    out = np.zeros((n, m), dtype=np.float32)
    x, y = np.concatenate(left), np.concatenate(right)
    rows_x, rows_y = np.repeat(np.arange(n), [len(s) for s in left]), np.repeat(np.arange(m), [len(s) for s in right])
    shared = np.intersect1d(x, y)   # only these can add to an intersection
    keep_x, keep_y = np.searchsorted(shared, x), np.searchsorted(shared, y)
    ok_x = (keep_x < len(shared)) & (shared[np.minimum(keep_x, len(shared) - 1)] == x) if len(shared) else np.zeros(len(x), bool)
    ok_y = (keep_y < len(shared)) & (shared[np.minimum(keep_y, len(shared) - 1)] == y) if len(shared) else np.zeros(len(y), bool)
    cx, rx, cy, ry = keep_x[ok_x], rows_x[ok_x], keep_y[ok_y], rows_y[ok_y]
    for at in range(0, len(shared), _COLUMNS):
        a, b = (cx >= at) & (cx < at + _COLUMNS), (cy >= at) & (cy < at + _COLUMNS)
        width = min(_COLUMNS, len(shared) - at)
        p, q = np.zeros((n, width), dtype=np.float32), np.zeros((m, width), dtype=np.float32)
        p[rx[a], cx[a] - at] = 1
        q[ry[b], cy[b] - at] = 1
        out += p @ q.T   # whole numbers below 2^24: exact
    return out


def _exact(threshold: float):
    """Clusters' blocks of full sets -> (set_id, n_links in this comparison, hub: least linked set's id of its component)."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, rows, left, right in _groups(batches, ["cluster", "a", "b"]):
            own = table.take(pa.array(rows))
            ids = own.column("set_id").to_numpy()
            sets = [np.frombuffer(v, dtype=np.uint64) for v in own.column("shingles").to_pylist()]
            sizes = np.array([len(s) for s in sets], dtype=np.float64)
            both = common_counts([sets[k] for k in left], [sets[k] for k in right]).astype(np.float64)
            linked = both >= threshold * (sizes[left][:, None] + sizes[right][None, :] - both) - 1e-9
            links = np.zeros(len(ids), dtype=np.int64)
            if left is right:
                np.fill_diagonal(linked, False)
            else:
                links[right] = linked.sum(axis=0)
            links[left] += linked.sum(axis=1)
            forest = Forest(len(ids))
            for i, j in zip(*np.nonzero(linked), strict=True):
                forest.join(int(left[i]), int(right[j]))
            found = np.flatnonzero(links)
            if len(found):
                hubs = ids[[forest.root(int(x)) for x in found]]
                yield pa.RecordBatch.from_arrays([pa.array(ids[found]), pa.array(links[found]), pa.array(hubs)],
                                                 names=["set_id", "n_links", "hub"])
    return compare


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingle sets of the clusters' representatives; a row whose text isn't the representative's is left out."""
    for batch in batches:
        rows, values = [], []
        sets = shingle_sets(batch.column("text").to_pylist())
        for k, (found, want) in enumerate(zip(sets, batch.column("set_id").to_pylist(), strict=True)):
            if len(found) and set_id(found) == want:
                rows.append(k)
                values.append(found.tobytes())
        kept = batch.take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [kept.column("set_id"), kept.column("cluster"), kept.column("n"), pa.array(values, pa.binary())],
            names=["set_id", "cluster", "n", "shingles"])


# --- components -------------------------------------------------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """set_id, label of every endpoint of the edges (u, v): the least id that is connected with it.

    Each round takes the least label of the neighbours and then the label of that label; rounds are written to the
    shared folder and end when no label falls.  Hot endpoints meet in partial minima.
    """
    both = spread(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = spread(both.groupBy(F.col("u").alias("set_id")).agg(F.least("set_id", F.min("v")).alias("label")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("set_id", "v"), "v").groupBy(F.col("u").alias("set_id"))
                .agg(F.min("label").alias("near")))
        step = labels.join(near, "set_id").select("set_id", F.col("label").alias("was"), F.least("label", "near").alias("low"))
        step = spread(step, "labels")
        jump = step.select(F.col("set_id").alias("low"), F.col("low").alias("label"))
        new = spread(step.join(jump, "low").select("set_id", "was", F.least("low", "label").alias("label")), "labels")
        labels = new.select("set_id", "label")
        if new.filter("label < was").isEmpty():
            return labels


# --- the join ---------------------------------------------------------------------------------------------------------

def near_sets(docs: DataFrame, threshold: float = THRESHOLD, runs: int = RUNS) -> tuple[DataFrame, DataFrame]:
    """(rows, sets): doc_id, text_key, set_id of every row; set_id, rep, rep_key, n_docs, n_links, label, class_id of every set.

    rep and rep_key are the least doc_id with the set and the least text_key (md5 of the text) under it; label names the group.
    """
    docs = docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("text_key"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    signed = spread(docs.mapInArrow(
        _sign(threshold, runs), f"doc_id {kind}, text_key string, set_id long, sig binary, paths array<long>"), "signed")
    rows = signed.select("doc_id", "text_key", "set_id")
    known = signed.filter(F.col("set_id").isNotNull())
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")   # null ids last
    sets = spread(known.groupBy("set_id").agg(
        F.min_by(F.struct("doc_id", "text_key"), first).alias("rep"), F.count("*").alias("n_docs"), F.first("sig").alias("sig"),
        F.first("paths").alias("paths"))
        .select("set_id", F.col("rep.doc_id").alias("rep"), F.col("rep.text_key").alias("rep_key"), "n_docs", "sig", "paths"), "sets")

    buckets = _paths(sets, threshold).join(sets.select("set_id", "sig"), "set_id")
    keys = ["path", "a", "b"]
    edges = buckets.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_near(threshold), "u long, v long")
    clusters = components(spread(edges.distinct(), "near-edges")).withColumnRenamed("label", "cluster")
    clusters = spread(clusters.join(clusters.groupBy("cluster").agg(F.count("*").alias("n")), "cluster"), "clusters")

    reps = clusters.join(sets.select("set_id", "rep", "rep_key"), "set_id")
    same = docs["doc_id"].eqNullSafe(reps["rep"]) & (docs["text_key"] == reps["rep_key"])
    full = spread(docs.join(reps, same).select("text", "set_id", "cluster", "n")
                  .mapInArrow(_full_sets, "set_id long, cluster long, n long, shingles binary"), "full-sets")
    keys = ["cluster", "a", "b"]
    found = spread(block_pairs(full, "cluster", "n").repartition(*keys).sortWithinPartitions(*keys)
                   .mapInArrow(_exact(threshold), "set_id long, n_links long, hub long"), "links")
    links = found.groupBy("set_id").agg(F.sum("n_links").alias("n_links"))
    labels = components(found.filter("set_id <> hub").select(F.col("hub").alias("u"), F.col("set_id").alias("v")))
    linked = sets.drop("sig", "paths").join(links, "set_id", "left").join(labels, "set_id", "left")
    linked = spread(linked.withColumn("label", F.coalesce("label", "set_id")), "linked")
    groups = linked.groupBy("label").agg(F.min("rep").alias("class_id"))
    sets = linked.join(groups, "label").select("set_id", "rep", "rep_key", "n_docs", F.coalesce(
        "n_links", F.lit(0).cast("bigint")).alias("n_links"), "label", "class_id")
    return rows, spread(sets, "classes")


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD, runs: int = RUNS) -> DataFrame:
    """doc_id, class_id, copy_id, n_copies, n_links of every document row.

    class_id is the least doc_id of the group (documents connected by links of Jaccard >= threshold, equal sets
    included), copy_id the least doc_id with the same shingle set, n_copies the rows with that set, n_links how many
    different sets are linked to the document's set.  Sets are of lower-cased five-word shingles (a text of one to four
    words has one shingle of all its words), words are runs without ASCII white space.

    docs: doc_id, text; other columns are not read.  A null, empty or blank text has no shingle: no links, a class of its
    own under its doc_id.  A null doc_id takes part like others but never names a class unless alone.  Repeated rows give a
    row each and are copies.  An empty table gives an empty one.
    """
    rows, sets = near_sets(docs, threshold, runs)
    found = rows.join(sets, "set_id", "left")
    return found.select("doc_id", F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                        F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("rep")).alias("copy_id"),
                        F.coalesce("n_docs", F.lit(1).cast("bigint")).alias("n_copies"),
                        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"))


def duplicates(docs: DataFrame, threshold: float = THRESHOLD, runs: int = RUNS) -> tuple[DataFrame, DataFrame]:
    """(drop, repeated): the (doc_id, text_key) of the rows that are not their group's representative; those of the
    representatives that stand in several equal rows.  Rows without words are in neither."""
    rows, sets = near_sets(docs, threshold, runs)
    first = F.struct(F.col("rep").isNull(), "rep", "rep_key", "set_id")
    stays = sets.groupBy("label").agg(F.min_by(F.struct("rep", "rep_key", "set_id"), first).alias("stay")).select(
        F.col("stay.set_id").alias("set_id"), F.col("stay.rep").alias("rep"), F.col("stay.rep_key").alias("rep_key"))
    texts = rows.filter(F.col("set_id").isNotNull()).groupBy("set_id", "doc_id", "text_key").agg(F.count("*").alias("n"))
    marked = texts.join(stays, "set_id", "left").withColumn("is_rep", F.coalesce(
        F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("text_key") == F.col("rep_key")), F.lit(False)))
    marked = spread(marked.select("doc_id", "text_key", "n", "is_rep"), "duplicates")
    return marked.filter(~F.col("is_rep")).drop("n", "is_rep"), marked.filter(F.col("is_rep") & (F.col("n") > 1)).drop("n", "is_rep")
