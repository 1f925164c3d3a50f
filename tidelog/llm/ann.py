"""Approximate nearest neighbours by an inverted multi-index, for the inner product.

The two halves of a vector are quantised separately by k-means, fitted on a bounded
sample; a pair of centroids is a cell, and every vector is indexed in its cell. A
query walks the centroid pairs by the sum of its two half distances (here: from the
largest inner product down) with a heap, until the cells hold its share of all
vectors. Their entries are ranked by the inner product of the original vectors.

Equal vectors are one entry that keeps its ``k + 1`` smallest ids, which is all that
an answer can hold. Entries and queries meet by groups of first centroids in blocks of
bounded size, so no cell, vector or query set has to fit one task. Only codebooks and
the number of entries per cell pass the driver: both have fixed sizes.

Cases: vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part, nor do rows without id; ties go to the smaller id;
rows equal in id and vector count once, an id with several vectors asks and answers
with its best; fewer candidates than ``k`` are all returned; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import materialize
from tidelog.storage import ship_package

# Centroids per half, rows of the fitting sample, rounds of k-means.
CENTROIDS, SAMPLE, ROUNDS = 64, 8192, 12
# Share of all entries that a query looks at, and how often it looks at what it returns at least.
SHARE, LEAST_TIMES = 0.5, 4
# Groups of first centroids; entries and queries of a block; queries at a time.
GROUPS, ENTRY_BLOCK, QUERY_BLOCK, STEP = 16, 4096, 4096, 256
# Queries that one task walks for; each walk is a heap over all centroid pairs.
WALK_BLOCK = 128
# Scores within this of the last place are compared exactly.
MARGIN = 1e-9


def _usable(vector: str) -> Column:
    v = F.col(vector)
    broken = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~broken & F.exists(v, lambda x: x != 0)


def _common_length(rows: DataFrame) -> int:
    """The most frequent length (the largest of several)."""
    counts = rows.groupBy(F.size("v").alias("d")).count()
    found = counts.orderBy(F.desc("count"), F.desc("d")).first()
    return found["d"] if found else 0


def kmeans(points: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids of a sample; starts are spread evenly over the (hash-ordered) sample."""
    centers = points[np.linspace(0, len(points) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        nearest = assign(points, centers)
        for c in range(k):
            if (members := nearest == c).any():
                centers[c] = points[members].mean(axis=0)
    return centers


def assign(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.argmax(points @ centers.T - 0.5 * (centers * centers).sum(axis=1), axis=1)


def walk(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, wanted: int) -> list[int]:
    """Cells (numbered ``i * len(second) + j``) by falling ``first[i] + second[j]``, until they hold
    ``wanted`` entries or all cells were seen."""
    rows, columns = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    a, b = (-first[rows]).tolist(), (-second[columns]).tolist()
    names_a, names_b, n = rows.tolist(), columns.tolist(), len(b)
    counts = sizes.tolist()
    # A row of the ordered grid is entered when the row before it was left behind.
    heap, cells, held = [(a[0] + b[0], 0, 0)], [], 0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        cell = names_a[i] * n + names_b[j]
        if counts[cell]:
            cells.append(cell)
            held += counts[cell]
        if j + 1 < n:
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
    return cells


def _matrix(column: pa.ChunkedArray | pa.Array, d: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d).astype(np.float64)


def search(vectors: DataFrame, asked: Column, k: int = 20, share: float = SHARE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each row of
    ``vectors`` (``vec_id, embedding``) for which ``asked`` holds, among all other rows."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"), asked.alias("asked")).filter(
        _usable("v") & F.col("vec_id").isNotNull()
    )
    d = _common_length(rows)
    rows = rows.filter(F.size("v") == d)

    # One entry per different vector, with its smallest ids.
    nth = F.dense_rank().over(Window.partitionBy("v").orderBy("vec_id"))
    entries = (
        rows.select("v", "vec_id").withColumn("nth", nth).filter(F.col("nth") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    )
    entries = materialize(entries, "ann-entries")

    sample = entries.select("v").orderBy(F.xxhash64("v")).limit(SAMPLE).toArrow()
    half = d // 2
    points = _matrix(sample.column("v"), d) if sample.num_rows else np.zeros((1, max(d, 1)))
    size = max(1, min(CENTROIDS, len(points) // 8))
    books = kmeans(points[:, :half], size), kmeans(points[:, half:], size)
    books_shared = spark.sparkContext.broadcast(books)

    def place(batches):
        c1, c2 = books_shared.value
        for batch in batches:
            m = _matrix(batch.column(0), d)
            cell = assign(m[:, :half], c1) * len(c2) + assign(m[:, half:], c2)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32())], names=["v", "ids", "cell"])

    placed = materialize(entries.mapInArrow(place, "v array<double>, ids array<long>, cell int"), "ann-cells")
    sizes = np.zeros(size * size, np.int64)
    for row in placed.groupBy("cell").count().collect():
        sizes[row["cell"]] = row["count"]
    width = math.ceil(size / GROUPS) * size
    in_group = [int(sizes[g * width:(g + 1) * width].sum()) for g in range(GROUPS)]
    blocks = [max(1, math.ceil(n / ENTRY_BLOCK)) for n in in_group]
    wanted = max(math.ceil(share * int(sizes.sum())), LEAST_TIMES * (k + 1))
    sizes_shared = spark.sparkContext.broadcast(sizes)

    def probe(batches):
        c1, c2 = books_shared.value
        for batch in batches:
            m = _matrix(batch.column(1), d)
            first, second = m[:, :half] @ c1.T, m[:, half:] @ c2.T
            source, group, cells = [], [], []
            for q in range(len(m)):
                seen = np.sort(walk(first[q], second[q], sizes_shared.value, wanted))
                for g in np.unique(seen // width).tolist():
                    source.append(q)
                    group.append(g)
                    cells.append(seen[seen // width == g].astype(np.int32))
            taken = pa.array(source, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(taken), batch.column(1).take(taken), pa.array(group, pa.int32()),
                 pa.array(cells, pa.list_(pa.int32()))],
                names=["query_id", "v", "group", "cells"],
            )

    queries = rows.filter("asked").select(F.col("vec_id").alias("query_id"), "v")
    n_queries = queries.count()
    query_blocks = max(1, math.ceil(n_queries / QUERY_BLOCK))
    per_group = F.array(*[F.lit(n) for n in blocks])
    asking = (
        queries.repartition(max(1, math.ceil(n_queries / WALK_BLOCK)), "query_id")
        .mapInArrow(probe, "query_id long, v array<double>, group int, cells array<int>")
        .withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).cast("int"))
        .withColumn("eb", F.explode(F.sequence(F.lit(0), F.get(per_group, F.col("group")) - 1)))
    )
    offered = (
        placed.withColumn("group", F.floor(F.col("cell") / width).cast("int"))
        .withColumn("eb", F.pmod(F.xxhash64("v"), F.get(per_group, F.col("group"))).cast("int"))
        .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    )

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        return nearest(left, right, d, k, width)

    keys = ["group", "eb", "qb"]
    found = asking.groupBy(*keys).cogroup(offered.groupBy(*keys)).applyInArrow(
        rank, "query_id long, ids array<long>, score double"
    )
    each = (
        found.select("query_id", "score", F.explode("ids").alias("vec_id"))
        .filter(F.col("vec_id") != F.col("query_id"))
        .groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def nearest(queries: pa.Table, entries: pa.Table, d: int, k: int, width: int) -> pa.Table:
    """Best entries of a block for each query, among the cells that the query walked."""
    names = ["query_id", "ids", "score"]
    empty = pa.table([pa.array([], pa.int64()), pa.array([], pa.list_(pa.int64())), pa.array([], pa.float64())], names=names)
    if not queries.num_rows or not entries.num_rows:
        return empty
    v, cell = _matrix(entries.column("v"), d), entries.column("cell").to_numpy() % width
    ids = entries.column("ids").combine_chunks()
    asked = queries.column("query_id").combine_chunks()
    asked = asked.chunk(0) if isinstance(asked, pa.ChunkedArray) else asked
    ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
    parts = []
    for start in range(0, queries.num_rows, STEP):
        part = queries.slice(start, STEP)
        q = _matrix(part.column("v"), d)
        walked = np.zeros((len(q), width), bool)
        for r, cells in enumerate(part.column("cells")):
            walked[r, cells.values.to_numpy() % width] = True
        scores = np.where(walked[:, cell], q @ v.T, -np.inf)
        # One more than asked for: the query itself may be among them.
        last = np.partition(scores, -(k + 1), axis=1)[:, -(k + 1)] if len(v) > k + 1 else np.full(len(q), -np.inf)
        r, c = np.nonzero((scores >= (last - MARGIN)[:, None]) & (scores > -np.inf))
        exact = (q[r] * v[c]).sum(axis=1)
        parts.append(pa.table([asked.take(pa.array(r + start)), ids.take(pa.array(c)), pa.array(exact)], names=names))
    return pa.concat_tables(parts) if parts else empty
