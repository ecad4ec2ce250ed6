"""Exact top-k inner products with a vector-approximation file.

Every vector is scaled to whole numbers.  The approximation file holds one small cell number per component; a cell is an
interval of that component's values.  From the cells alone an inner product is bounded from below and above.

1. Scan: each block of queries meets each block of the approximation file.  Within a task the k-th best lower bound
   seen so far is the bar; a vector whose upper bound is below it can't be among the k best.  The highest bar of all tasks
   then thins out what the tasks kept.
2. Exact vectors are read in the order of their bounds: first the ``FIRST`` most promising ones of each query, which gives a
   sharper bar, the k-th best exact score; then every vector whose bound still reaches that bar.  None of the others can
   rank, so the result is certain and exact.

Equal vectors are one entry of the file with their smallest ids, and equal queries are searched once, so a large group of
copies costs as much as one vector.  Blocks bound what a task holds: ``BLOCK`` vectors or ``QUERIES`` queries at a time.
Cells only steer the work: any edges give the same result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textlane.llm.common import spread

SCALE = 256
#: Cells per component; vectors and queries in a block; most blocks of the file in a group, which meets all blocks of queries.
CELLS, BLOCK, QUERIES, GROUP = 64, 4096, 1024, 128
#: Exact vectors read per query at first, as a multiple of k.
FIRST = 8
#: Cells cover so many standard deviations on either side of a component's mean; the outer ones reach to its extremes.
DEVIATIONS = 3.5
#: Sums of whole numbers below this are exact in a double.
_EXACT = float(1 << 53)


def scaled(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<long>): floor(256 x) of every component of the rows that take part.

    Rows whose id or vector is null, empty, or holds a null or non-finite component take no part.  Of rows that share a
    vec_id the one with the least vector counts, so repeated rows count once.
    """
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0)).filter(finite)
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"),
                       F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("bigint")).alias("v"))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    """Rows of long lists as a matrix of ``dim`` columns; shorter rows end in zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    lengths = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == dim).all():
        return values.reshape(-1, dim)
    out = np.zeros((len(lengths), dim), dtype=np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def _spread_of(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    """Per component and task: number, sum and sum of squares, least and greatest value."""
    n, low, high = 0, np.full(dim, np.inf), np.full(dim, -np.inf)
    total, squares = np.zeros(dim), np.zeros(dim)
    for batch in batches:
        if not batch.num_rows:
            continue
        m = _matrix(batch.column("v"), dim).astype(np.float64)
        n += len(m)
        total, squares = total + m.sum(axis=0), squares + (m * m).sum(axis=0)
        low, high = np.minimum(low, m.min(axis=0)), np.maximum(high, m.max(axis=0))
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim)), pa.array(np.full(dim, n)), *map(pa.array, (total, squares, low, high))],
                                         names=["c", "n", "total", "squares", "low", "high"])


def _edges(file: DataFrame, dim: int, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per component: inner edges (cell j holds edge j-1 <= value < edge j), and the least and greatest value of each cell.

    Means and deviations come from all rows; what the driver gets is one row per component.
    """
    parts = file.select("v").mapInArrow(partial(_spread_of, dim=dim), "c long, n long, total double, squares double, low double, high double")
    rows = parts.groupBy("c").agg(*[F.sum(x).alias(x) for x in ("n", "total", "squares")], F.min("low").alias("low"),
                                  F.max("high").alias("high")).orderBy("c").collect()
    n, total, squares, low, high = (np.array([r[k] for r in rows], dtype=np.float64) for k in range(1, 6))
    mean = total / n
    deviation = np.sqrt(np.maximum(squares / n - mean * mean, 0)) * DEVIATIONS
    begin, end = np.maximum(mean - deviation, low), np.minimum(mean + deviation, high)
    edges = np.floor(begin[:, None] + (end - begin)[:, None] * np.arange(1, cells) / cells)
    edges = np.clip(edges, low[:, None], high[:, None])
    least = np.concatenate([low[:, None], edges], axis=1)
    greatest = np.concatenate([np.maximum(edges - 1, low[:, None]), high[:, None]], axis=1)
    return edges, least, np.maximum(least, greatest)


def _approximate(batches: Iterator[pa.RecordBatch], dim: int, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Blocks of the approximation file: the entries' numbers and one byte per component."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            m = _matrix(part.column("v"), dim)
            cells = np.stack([np.searchsorted(edges[c], m[:, c], side="right") for c in range(dim)], axis=1).astype(np.uint8)
            no = part.column("no").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(no[:1]), pa.array([no.tobytes()], pa.binary()), pa.array([cells.tobytes()], pa.binary())],
                                             names=["block", "numbers", "cells"])


def _query_blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, QUERIES):
            part = batch.slice(at, QUERIES)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part.column("q").to_numpy().tobytes()], pa.binary()), pa.array([_matrix(part.column("v"), dim).tobytes()], pa.binary())],
                names=["q", "queries"])


def _bounds(q: np.ndarray, cells: np.ndarray, least: np.ndarray, greatest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all inner products of queries and approximated vectors."""
    column = np.arange(cells.shape[1])
    both = np.concatenate([np.maximum(q, 0), np.minimum(q, 0)], axis=1).astype(np.float64)
    low, high = least[column, cells], greatest[column, cells]
    lower, upper = both @ np.concatenate([low, high], axis=1).T, both @ np.concatenate([high, low], axis=1).T
    # Doubles are exact up to _EXACT; beyond, bounds give way by more than any rounding of the sums.
    largest = max(np.abs(lower).max(initial=0), np.abs(upper).max(initial=0), np.abs(both).sum(axis=1).max(initial=0)
                  * max(np.abs(least).max(initial=0), np.abs(greatest).max(initial=0)))
    slack = 0.0 if largest < _EXACT else largest * 1e-12
    return lower - slack, upper + slack


def _scan(batches: Iterator[pa.RecordBatch], dim: int, k: int, least: np.ndarray, greatest: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What may rank: (q, no, lower, upper).  Rows pair a block of queries with a block of the file; equal queries follow
    each other, and their bar rises from block to block."""
    last, bar, held = None, None, []

    def kept() -> Iterator[pa.RecordBatch]:
        for q, no, lower, upper, at in held:
            stay = upper >= bar[at]
            if stay.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[stay]) for x in (q, no, lower, upper)], names=["q", "no", "lower", "upper"])

    for batch in batches:
        for qs, queries, numbers, cells in zip(*(batch.column(c) for c in ("q", "queries", "numbers", "cells")), strict=True):
            q_no = np.frombuffer(qs.as_py(), dtype=np.int64)
            if last is None or not np.array_equal(q_no, last):
                if last is not None:
                    yield from kept()
                last, held = q_no, []
                best = np.full((len(q_no), k), -np.inf)
                bar = best[:, 0]
                q = np.frombuffer(queries.as_py(), dtype=np.int64).reshape(-1, dim)
            no = np.frombuffer(numbers.as_py(), dtype=np.int64)
            lower, upper = _bounds(q, np.frombuffer(cells.as_py(), dtype=np.uint8).reshape(-1, dim), least, greatest)
            best = np.sort(np.concatenate([best, np.partition(lower, max(0, lower.shape[1] - k), axis=1)[:, -k:]], axis=1), axis=1)[:, -k:]
            bar = best[:, 0]
            row, col = np.nonzero(upper >= bar[:, None])
            held.append((q_no[row], no[col], lower[row, col], upper[row, col], row))
            if sum(len(h[0]) for h in held) > 1 << 20:
                held = [tuple(x[h[3] >= bar[h[4]]] for x in h) for h in held]
                if sum(len(h[0]) for h in held) > 1 << 19:
                    yield from kept()
                    held = []
    if last is not None:
        yield from kept()


def _scores(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    """Exact inner products of the vectors qv and v of each row."""
    for batch in batches:
        a, b = _matrix(batch.column("qv"), dim), _matrix(batch.column("v"), dim)
        if len(a) and float(np.abs(a.astype(np.float64)).sum(axis=1).max()) * float(np.abs(b.astype(np.float64)).max()) >= float(1 << 62):
            a, b = a.astype(object), b.astype(object)     # exact; a score beyond 64 bits ends the job with an error
        score = (a * b).sum(axis=1)
        yield pa.RecordBatch.from_arrays([batch.column("q"), batch.column("no"), pa.array(list(score), pa.int64())], names=["q", "no", "score"])


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, cells: int = CELLS) -> DataFrame:
    """The k highest inner products of each query vector with all other rows: query_id, rank (from 1), vec_id, score.

    vectors: vec_id, embedding (array of numbers); other columns are ignored.  Components become floor(256 x).  Queries are
    the rows whose vec_id is divisible by ``every``; candidates are all rows but the query's own.  Ties go to the smaller
    vec_id; a query with fewer than k candidates returns them all.  Rows with a null id, and vectors that are null, empty
    or hold a null or non-finite component, take no part; of rows that share a vec_id the one with the least vector counts.
    Components that a shorter vector lacks count as 0.  An empty table gives an empty one.  A score that doesn't fit 64
    bits is an error.
    """
    spark, out = vectors.sparkSession, "query_id long, rank int, vec_id long, score long"
    rows = spread(scaled(vectors).withColumn("h", F.xxhash64("v")), "scaled-vectors")
    dim = rows.agg(F.max(F.size("v"))).first()[0]
    if dim is None:
        return spark.createDataFrame([], out)
    wanted = k + 1      # one of them may be the query's own row
    # One entry per distinct vector; more than ``wanted`` of its ids can't rank.
    order = Window.partitionBy("h", "v").orderBy("vec_id")
    ids = rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= wanted)
    entries = ids.groupBy("h", "v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    file = spread(entries.withColumn("no", F.monotonically_increasing_id()), "exact-vectors")
    asked = rows.filter(F.col("vec_id") % every == 0)
    queries = spread(asked.select("h", "v").distinct().withColumn("q", F.monotonically_increasing_id()), "query-vectors")

    edges, least, greatest = _edges(file, dim, cells)
    approx = spread(file.select("no", "v").mapInArrow(partial(_approximate, dim=dim, edges=edges), "block long, numbers binary, cells binary"),
                    "approximation-file")
    n_blocks = approx.count()
    n_groups = max(1, -(-n_blocks // GROUP), min(n_blocks, spark.sparkContext.defaultParallelism))
    blocks = queries.select("q", "v").mapInArrow(partial(_query_blocks, dim=dim), "q binary, queries binary")
    blocks = blocks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
    approx = approx.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(n_groups)).cast("int"))
    # A merge join goes through a group's file blocks for one block of queries after the other, as the rising bar wants it.
    pairs = blocks.join(approx.hint("merge"), "group").select("q", "queries", "numbers", "cells")
    found = spread(pairs.mapInArrow(partial(_scan, dim=dim, k=wanted, least=least, greatest=greatest),
                                    "q long, no long, lower double, upper double"), "candidates")

    per_query = Window.partitionBy("q")

    def kth(df: DataFrame, column: str) -> DataFrame:
        """(q, bar): the k-th best value of each query; queries with fewer have no bar."""
        ranked = df.withColumn("n", F.row_number().over(per_query.orderBy(F.desc(column)))).filter(F.col("n") <= wanted)
        return ranked.filter(F.col("n") == wanted).select("q", F.col(column).cast("double").alias("bar"))

    def exact(pairs: DataFrame) -> DataFrame:
        read = pairs.select("q", "no").join(file.select("no", "v"), "no").join(queries.select("q", F.col("v").alias("qv")), "q")
        return read.mapInArrow(partial(_scores, dim=dim), "q long, no long, score long")

    found = found.join(kth(found, "lower"), "q", "left").filter(F.col("bar").isNull() | (F.col("upper") >= F.col("bar"))).drop("bar", "lower")
    turn = F.row_number().over(per_query.orderBy(F.desc("upper"), "no"))
    found = spread(found.withColumn("turn", turn), "candidates-in-order")
    first = spread(exact(found.filter(F.col("turn") <= FIRST * wanted)), "first-scores")
    later = found.filter(F.col("turn") > FIRST * wanted).join(kth(first, "score"), "q").filter(F.col("upper") >= F.col("bar"))
    scores = first.unionByName(exact(later))

    scores = scores.join(kth(scores, "score"), "q", "left").filter(F.col("bar").isNull() | (F.col("score") >= F.col("bar")))
    ranked = (scores.join(file.select("no", "ids"), "no").select("q", "score", F.explode("ids").alias("vec_id"))
              .withColumn("n", F.row_number().over(per_query.orderBy(F.desc("score"), "vec_id"))).filter(F.col("n") <= wanted))
    answers = ranked.join(queries.select("q", "h", "v"), "q").select("h", "v", "vec_id", "score")
    mine = asked.select(F.col("vec_id").alias("query_id"), "h", "v").join(answers, ["h", "v"]).filter(F.col("vec_id") != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return mine.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)
