"""Approximate nearest neighbours by collision counting.

Every vector is projected on ``LINES`` random lines; a block of the index keeps
one sorted array per line. A query opens a window around its own projection on
every line and widens all windows step by step (virtual rehashing: a wider window
is a coarser hash that needs no new table). A vector inside enough windows
collides often enough to be verified with the exact measure; widening stops when
``VERIFIED`` of the block and ``VERIFIED_LEAST`` more have been verified, so that
small tables are searched nearly whole.

The largest inner product becomes the nearest neighbour by one more dimension:
vectors are scaled by the largest norm and filled up to length one.

Index and queries meet in blocks, each a task of bounded size; a query sees every
block. Each block returns its best ``k``, and the best of those are the result.

Defined results: vectors that are null, zero, or hold null or non-finite
components take no part, nor do those of another length than most (ties: the
longer); rows with a null id are left out; of several rows of one id the smallest
vector counts; equal scores are ordered by id; fewer than ``k`` candidates are
all returned; an empty table gives an empty result; columns of other names play
no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tagwright.session import write_shared

K = 20
LINES = 64
COLLISIONS = 0.7  # share of the lines on which a verified vector collides
VERIFIED = 0.12  # share of a block that is verified before widening stops,
VERIFIED_LEAST = 250  # and vectors beside it
WIDEN = 1.3
BEGIN = 2.0
INDEX_BLOCK = 8192
QUERY_BLOCK = 2048


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the vectors that take part, v in double precision."""
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & sound & F.exists("v", lambda x: x != 0))
    return write_shared(rows.groupBy("vec_id").agg(F.min("v").alias("v")))


def search_block(index: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, largest: float, k: int):
    """The best ``k`` of an index block that each query finds: query, id, score."""
    n, dims = index.shape
    lines = np.random.default_rng(5).normal(size=(dims + 1, LINES))
    lifted = index / largest
    rest = np.sqrt(np.maximum(0, 1 - (lifted**2).sum(axis=1)))
    along = np.concatenate([lifted, rest[:, None]], axis=1) @ lines
    own = (queries / np.sqrt((queries**2).sum(axis=1))[:, None]) @ lines[:dims]
    order = np.ascontiguousarray(np.argsort(along, axis=0).T)
    sorted_lines = np.take_along_axis(along, order.T, axis=0).T
    enough = int(np.ceil(COLLISIONS * LINES))
    wanted = min(n, int(VERIFIED * n) + VERIFIED_LEAST + k + 1)

    # Window ends of all queries, as the windows widen, line by line.
    radii = [0.5]
    while radii[-1] < 64:
        radii.append(radii[-1] * WIDEN)
    low = np.empty((len(radii), len(queries), LINES), dtype=np.int32)
    high = np.empty_like(low)
    for j in range(LINES):
        for i, r in enumerate(radii):
            low[i, :, j] = np.searchsorted(sorted_lines[j], own[:, j] - r, "left")
            high[i, :, j] = np.searchsorted(sorted_lines[j], own[:, j] + r, "right")
    # What windows hold in all bounds the collisions: no narrower one can do. As
    # others collide too, the search begins where they hold ``BEGIN`` times as much.
    held = (high - low).sum(axis=2, dtype=np.int64)
    out = []
    for q in range(len(queries)):
        i = int(np.searchsorted(held[:, q], min(BEGIN * wanted * enough, n * LINES)))
        i = min(i, len(radii) - 1)
        a, b = low[i, q], high[i, q]
        hits = np.bincount(np.concatenate([order[j, a[j] : b[j]] for j in range(LINES)]), minlength=n)
        found = np.flatnonzero(hits >= enough)
        while len(found) < wanted and i + 1 < len(radii):
            i += 1
            c, d = low[i, q], high[i, q]
            more = [order[j, c[j] : a[j]] for j in range(LINES)] + [order[j, b[j] : d[j]] for j in range(LINES)]
            hits += np.bincount(np.concatenate(more), minlength=n)
            a, b = c, d
            found = np.flatnonzero(hits >= enough)
        if len(found) < min(wanted, n):
            found = np.arange(n)
        found = found[ids[found] != query_ids[q]]
        if len(found) > 2 * k:
            # Products of one call may differ in the last place from the exact
            # scores: whatever comes that near to the best is scored again.
            rough = index[found] @ queries[q]
            edge = np.partition(rough, len(rough) - k)[len(rough) - k]
            found = found[rough >= edge - 1e-9 * (1 + abs(edge))]
        scores = (index[found] * queries[q]).sum(axis=1)
        best = np.lexsort((ids[found], -scores))[:k]
        out.append((np.full(len(best), query_ids[q]), ids[found[best]], scores[best]))
    return [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]


def matrix(rows: pa.Table) -> np.ndarray:
    return np.asarray(rows["v"].combine_chunks().flatten()).reshape(rows.num_rows, -1)


def nearest(vectors: DataFrame, query_step: int = 20, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: for every vector of ``vectors`` (vec_id,
    embedding) whose id is divisible by ``query_step``, the ``k`` nearest found."""
    rows = usable(vectors)
    by_length = rows.groupBy(F.size("v").alias("dims")).agg(
        F.count("vec_id").alias("n"),
        F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).alias("largest"),
        F.sum((F.col("vec_id") % query_step == 0).cast("long")).alias("queries"),
    )
    most = by_length.orderBy(F.desc("n"), F.desc("dims")).head()
    if most is None:
        most = {"dims": 0, "n": 0, "largest": 1.0, "queries": 0}
    blocks, parts = (max(1, -(-most[c] // size)) for c, size in (("n", INDEX_BLOCK), ("queries", QUERY_BLOCK)))
    largest = most["largest"]

    def search(key, index: pa.Table, queries: pa.Table) -> pa.Table:
        found = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        if index.num_rows and queries.num_rows:
            found = search_block(
                matrix(index), np.asarray(index["vec_id"]), matrix(queries), np.asarray(queries["vec_id"]), largest, k
            )
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, found))))

    rows = rows.filter(F.size("v") == most["dims"])
    own = F.xxhash64("vec_id")
    index = rows.withColumn("block", F.pmod(own, F.lit(blocks))).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    )
    asked = rows.filter(F.col("vec_id") % query_step == 0).withColumn("part", F.pmod(own, F.lit(parts)))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = [F.col("block").cast("long").alias("block"), F.col("part").cast("long").alias("part")]
    index, asked = (side.select(*keys, "vec_id", "v") for side in (index, asked))
    found = index.groupBy("block", "part").cogroup(asked.groupBy("block", "part")).applyInArrow(
        search, "query_id long, vec_id long, score double"
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
