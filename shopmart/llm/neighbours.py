"""Approximate nearest neighbours by low-dimensional stable projections and a kd-tree.

Vectors are projected on ``DIMS`` random normal directions. For two vectors at
distance d, the squared projected distance over d squared has a chi-square distribution
with ``DIMS`` degrees of freedom. A kd-tree over projections is fitted on a bounded sample
(at most ``SAMPLE`` rows) and every row is put into one of its leaves. A search
takes projected neighbours in the order of their projected distance and verifies
each by its distance; it stops before a projected distance at which a vector nearer than
the k-th found so far would have been seen already with probability ``SURE``.

On Spark, a leaf's rows are a block. Queries first meet the leaf that they lie in, which
bounds their k-th distance; then they go to exactly those further leaves whose box is
not yet ruled out by the stopping test. Within a block rows are again taken in the order
of projected distance until the test holds. The queries are a stated set; they
meet blocks of rows, and each returns k rows per block at most.

Vectors that are null, zero, of another length than most, or hold null or non-finite components
take no part. Equal distances are ordered by the smaller id. A repeated id is a candidate of
its own for others' queries. Fewer than k candidates give all there are; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopmart.llm.common import stored

DIMS = 8  # even, which gives the chi-square distribution a closed form
SURE = 0.98
SAMPLE = 20_000
LEAF_ROWS = 4_000
BLOCK_QUERIES = 1_024
SEED = 7


def chi_square(x: np.ndarray) -> np.ndarray:
    """Distribution function with ``DIMS`` degrees of freedom."""
    half = np.asarray(x, float) / 2
    term, total = np.ones_like(half), np.ones_like(half)
    for k in range(1, DIMS // 2):
        term = term * half / k
        total = total + term
    return 1 - np.exp(-half) * total


def _reach() -> float:
    """The projected distance, as a multiple of the k-th distance, at which the test holds."""
    low, high = 0.0, 100.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(np.array(middle)) < SURE else (low, middle)
    return math.sqrt(high)


REACH = _reach()


def projections(size: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((size, DIMS))


class Leaves:
    """A kd-tree whose nodes are split at the median of the widest direction."""

    def __init__(self, points: np.ndarray, n_leaves: int) -> None:
        self.split: list[tuple[int, float, int, int] | int] = []
        self.boxes: list[tuple[np.ndarray, np.ndarray]] = []
        low, high = np.full(DIMS, -np.inf), np.full(DIMS, np.inf)
        self._grow(points, max(0, math.ceil(math.log2(max(1, n_leaves)))), low, high)

    def _grow(self, points: np.ndarray, depth: int, low: np.ndarray, high: np.ndarray) -> int:
        place = len(self.split)
        self.split.append(0)
        axis = int(np.argmax(np.ptp(points, axis=0))) if len(points) > 1 else 0
        at = float(np.median(points[:, axis])) if len(points) else 0.0
        left = points[:, axis] < at
        if depth == 0 or not left.any():
            self.split[place] = len(self.boxes)
            self.boxes.append((low, high))
            return place
        below, above = high.copy(), low.copy()
        below[axis] = above[axis] = at
        one = self._grow(points[left], depth - 1, low, below)
        two = self._grow(points[~left], depth - 1, above, high)
        self.split[place] = (axis, at, one, two)
        return place

    def assign(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point."""
        out = np.zeros(len(points), np.int32)
        todo = [(0, np.arange(len(points)))]
        while todo:
            place, rows = todo.pop()
            node = self.split[place]
            if isinstance(node, int):
                out[rows] = node
                continue
            axis, at, one, two = node
            left = points[rows, axis] < at
            todo += [(one, rows[left]), (two, rows[~left])]
        return out

    def within(self, point: np.ndarray, radius: float) -> list[int]:
        """Leaves in the order of their boxes' distance from a point, up to a radius."""
        heap: list[tuple[float, int, np.ndarray]] = [(0.0, 0, np.zeros(DIMS))]
        found = []
        while heap:
            square, place, off = heapq.heappop(heap)
            if square > radius * radius:
                break
            node = self.split[place]
            if isinstance(node, int):
                found.append(node)
                continue
            axis, at, one, two = node
            near, far = (one, two) if point[axis] < at else (two, one)
            heapq.heappush(heap, (square, near, off))
            beyond = off.copy()
            beyond[axis] = point[axis] - at
            heapq.heappush(heap, (float(beyond @ beyond), far, beyond))
        return found


def search_block(
    query: np.ndarray, vectors: np.ndarray, ids: np.ndarray, order: np.ndarray, gaps: np.ndarray,
    k: int, bound: float, step: int = 64,
) -> list[tuple[float, int]]:
    """The k nearest of a block's rows, which are taken in the order of projected distance
    ``gaps`` until the stopping test holds; ``bound`` is a k-th distance known before."""
    best: list[tuple[float, int]] = []
    kth = bound
    for start in range(0, len(order), step):
        if gaps[order[start]] > REACH * kth:
            break
        rows = order[start : start + step]
        distances = np.sqrt(((vectors[rows] - query) ** 2).sum(axis=1))
        best += zip(distances.tolist(), ids[rows].tolist(), strict=True)
        best = sorted(best)[:k]
        if len(best) == k:
            kth = min(kth, best[-1][0])
    return [b for b in best if b[0] <= kth]


def _usable(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int]:
    v = F.col(vec_col)
    clean = vectors.select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("v"))
    finite = F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ) & F.exists("v", lambda x: x != 0)
    clean = clean.where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(finite)
    sizes = clean.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size")
    most = sizes.first()
    size = most["size"] if most else 0
    return clean.where(F.size("v") == size), size


def search(
    vectors: DataFrame,
    query_ids,
    k: int = 10,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """The k nearest found of each query, a row of ``vectors`` for which the
    condition ``query_ids`` holds, among all other rows: query_id, rank, id and score."""
    usable, size = _usable(vectors, id_col, vec_col)
    size = max(1, size)  # no vectors at all
    directions = projections(size)
    n = usable.count()

    def project(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
        own = flat.reshape(-1, size)
        return own, own @ directions

    # The tree is fitted on a bounded sample; all rows are indexed.
    share = min(1.0, SAMPLE / max(1, n))
    sample = usable.sample(share, seed=SEED) if share < 1 else usable

    def project_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = np.ascontiguousarray(project(batch)[1])
            yield pa.RecordBatch.from_arrays([pa.array(low.tolist(), pa.list_(pa.float64()))], ["low"])

    # Projected by the tasks: the driver gets ``DIMS`` numbers a row.
    rows = sample.select("v").mapInArrow(project_all, "low array<double>").toPandas()["low"]
    fitted = np.array(rows.tolist(), float).reshape(-1, DIMS)
    tree = Leaves(fitted, -(-n // leaf_rows))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, low = project(batch)
            yield batch.append_column("leaf", pa.array(tree.assign(low), pa.int32()))

    placed = usable.mapInArrow(place, "id long, v array<double>, leaf int")
    placed = stored(placed, "leaves")
    queries = placed.where(query_ids(F.col("id"))).withColumn("bound", F.lit(float("inf")))

    answer = "id long, neighbour long, score double, bound double"

    def meet(asked: DataFrame) -> DataFrame:
        """Queries (id, v, leaf, bound) against the rows of their leaves, in blocks."""
        # A leaf that holds much more than its share is cut into blocks by id, and so are its
        # queries if they are many: each block of queries meets each block of rows. One row per
        # leaf is broadcast, and there are no more leaves than rows in the sample.
        blocks = placed.groupBy("leaf").agg(
            F.ceil(F.count(F.lit(1)) / (2 * leaf_rows)).cast("int").alias("blocks")
        )
        parts = asked.groupBy("leaf").agg(
            F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).cast("int").alias("parts")
        )
        counted = stored(blocks.join(parts, "leaf"), "leaf-blocks")
        block = F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("block")
        part = F.pmod(F.xxhash64("id"), "parts").cast("int").alias("part")
        each_block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
        each_part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
        cut = placed.join(F.broadcast(counted), "leaf").select("leaf", block, each_part, "id", "v")
        cut = cut.select(*[F.col(c).alias(c) for c in cut.columns])  # apart from the queries' columns
        every = asked.join(F.broadcast(counted), "leaf").select("leaf", each_block, part, "id", "v", "bound")

        def compare(left: pa.Table, right: pa.Table) -> pa.Table:
            out: list[tuple[int, int, float, float]] = []
            if left.num_rows and right.num_rows:
                rows, low = project(left.combine_chunks().to_batches()[0])
                ids = left.column("id").to_numpy()
                for batch in right.to_batches(max_chunksize=256):
                    asked_rows, asked_low = project(batch)
                    names = batch.column("id").to_pylist()
                    bounds = batch.column("bound").to_pylist()
                    for q, p, name, bound in zip(asked_rows, asked_low, names, bounds, strict=True):
                        gaps = np.sqrt(((low - p) ** 2).sum(axis=1))
                        order = np.argsort(gaps, kind="stable")
                        order = order[ids[order] != name]
                        found = search_block(q, rows, ids, order, gaps, k, bound)
                        out += [(name, other, score, bound) for score, other in found]
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            return pa.table(arrays, names=["id", "neighbour", "score", "bound"])

        keys = ("leaf", "block", "part")
        return cut.groupBy(*keys).cogroup(every.groupBy(*keys)).applyInArrow(compare, answer)

    best = Window.partitionBy("id").orderBy("score", "neighbour")

    def nearest(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    home = stored(nearest(meet(queries)), "home-neighbours")
    bounds = home.groupBy("id").agg(
        F.when(F.count(F.lit(1)) == k, F.max("score")).otherwise(float("inf")).alias("bound")
    )
    known = queries.drop("bound").join(bounds, "id", "left").fillna(float("inf"), ["bound"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, low = project(batch)
            homes, limits = batch.column("leaf").to_pylist(), batch.column("bound").to_pylist()
            rows, leaves = [], []
            for row, (p, own, limit) in enumerate(zip(low, homes, limits, strict=True)):
                for leaf in tree.within(p, REACH * limit):
                    if leaf != own:
                        rows.append(row)
                        leaves.append(leaf)
            taken = batch.take(pa.array(rows, pa.int64()))
            kept = [taken.column(c) for c in ("id", "v", "bound")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(leaves, pa.int32())], ["id", "v", "bound", "leaf"]
            )

    further = known.mapInArrow(spread, "id long, v array<double>, bound double, leaf int")
    further = stored(further, "further-leaves")
    both = home.drop("rank").unionByName(meet(further))
    return nearest(both).select(
        F.col("id").alias("query_id"), "rank", F.col("neighbour").alias(id_col), "score"
    )
