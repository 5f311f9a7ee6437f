"""Operator 7: exact top-k search by inner product with M-trees.

Vectors are dealt out over pages; each page is a metric tree whose nodes keep
a routing vector, a covering radius and the distance to their parent's routing
vector.  An inner product is searched as a distance: every vector gets one
more coordinate that brings all of a page to the same norm, so that the
largest inner product is the smallest distance.  A query visits nodes best
first; the triangle inequality with the stored distances rules out children
and entries before their distance is computed.  Scores are exact integers.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from incidentflow.session import ship_package

LEAF, FANOUT = 256, 16


class Node:
    __slots__ = ("rows", "children", "center", "radius", "to_parent", "entry_at", "child_at", "child_radius", "child_center")

    def __init__(self, center: np.ndarray):
        self.center, self.to_parent = center, 0.0
        self.rows: np.ndarray | None = None
        self.children: list[Node] = []


class MTree:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        """``vectors``: integers, one row each."""
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        x = self.vectors.astype(np.float64)
        norm = (x * x).sum(axis=1)
        self.norm = float(norm.max())
        self.points = np.column_stack([x, np.sqrt(np.maximum(self.norm - norm, 0))])
        self.pick = np.random.default_rng(len(ids))
        self.root = self._build(np.arange(len(ids)), self.points[0])

    def _build(self, rows: np.ndarray, center: np.ndarray) -> Node:
        """Bulk loading: pivots chosen from the node's rows, each row to its nearest."""
        node = Node(center)
        at = np.sqrt(((self.points[rows] - center) ** 2).sum(axis=1))
        node.radius = float(at.max())
        if len(rows) > LEAF and node.radius > 0:
            pivots = self.points[self.pick.choice(rows, FANOUT, replace=False)]
            own = self.points[rows]
            square = (own * own).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * own @ pivots.T
            nearest = square.argmin(axis=1)
            if np.bincount(nearest, minlength=FANOUT).max() < len(rows):
                for k in np.unique(nearest).tolist():
                    child = self._build(rows[nearest == k], pivots[k])
                    child.to_parent = float(np.sqrt(((pivots[k] - center) ** 2).sum()))
                    node.children.append(child)
                node.child_at = np.array([c.to_parent for c in node.children])
                node.child_radius = np.array([c.radius for c in node.children])
                node.child_center = np.array([c.center for c in node.children])
                return node
        node.rows, node.entry_at = rows, at
        return node

    def search(self, query_id: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(score, id) of the ``k`` best rows but those of the query's own id:
        highest score first, ties to the smaller id."""
        q = np.append(query.astype(np.float64), 0.0)
        square = float(q @ q)
        slack = 1e-9 * (square + self.norm) + 1e-6
        best: list[tuple[int, int]] = []  # a heap of (score, -id): the worst first
        limit = np.inf  # the distance at the worst of k: only what is further is ruled out
        d = float(np.sqrt(((q - self.root.center) ** 2).sum()))
        heap, n = [(max(d - self.root.radius, 0.0), 0, d, self.root)], 0
        while heap:
            bound, _, d, node = heapq.heappop(heap)
            if bound > limit:
                break
            if node.rows is None:
                # the parent's distance bounds each child's before it is computed
                may = np.flatnonzero(np.abs(d - node.child_at) - node.child_radius <= limit)
                to = np.sqrt(((node.child_center[may] - q) ** 2).sum(axis=1))
                low = np.maximum(to - node.child_radius[may], 0)
                for i, a, b in zip(may.tolist(), to.tolist(), low.tolist()):
                    if b <= limit:
                        n += 1
                        heapq.heappush(heap, (b, n, a, node.children[i]))
                continue
            may = node.rows[np.abs(d - node.entry_at) <= limit]
            score = self.vectors[may] @ query
            ids = self.ids[may]
            if len(may) > k + 1:
                # of equal scores the smaller ids, which come first
                top = np.lexsort((ids, -score))[: k + np.count_nonzero(ids == query_id)]
                score, ids = score[top], ids[top]
            for s, i in zip(score.tolist(), ids.tolist()):
                if i == query_id:
                    continue
                if len(best) < k:
                    heapq.heappush(best, (s, -i))
                elif (s, -i) > best[0]:
                    heapq.heapreplace(best, (s, -i))
            if len(best) == k:
                limit = float(np.sqrt(max(square + self.norm - 2 * best[0][0] + slack, 0.0))) + 1e-6
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.int64)


def _searcher(k: int):
    def run(page: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if page.num_rows and queries.num_rows:
            tree = MTree(page.column("id").to_numpy(), _matrix(page.column("v")))
            for i, q in zip(queries.column("id").to_pylist(), _matrix(queries.column("v"))):
                out += [(i, best, score) for score, best in tree.search(i, q, k)]
        return pa.table([pa.array([r[c] for r in out], pa.int64()) for c in range(3)], names=["query_id", "vec_id", "score"])

    return run


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 1024.0) -> DataFrame:
    """``id, v`` with v = floor(scale * x) of every component; rows with a null
    id, a null or empty vector or a null or non-finite component are left out,
    rows that repeat (the same id and vector) count once."""
    whole = "exists(v, x -> x IS NULL OR isnan(x) OR abs(x) = double('inf'))"
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(f"id IS NOT NULL AND v IS NOT NULL AND size(v) > 0 AND NOT {whole}")
    return rows.select("id", F.transform("v", lambda x: F.floor(F.lit(scale) * x)).alias("v")).distinct()


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, page_rows: int = 4096, query_rows: int = 4096) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every query its ``k`` rows of the
    largest inner product (all, if fewer), ties to the smaller id.

    ``vectors`` and ``queries`` hold ``id`` and ``v`` (integers).  Rows of the
    query's own id are not its candidates; vectors of another length than the
    query's are not either.  Vectors are dealt over pages of about
    ``page_rows`` and queries over blocks of about ``query_rows``, and each
    page meets each block in a task of its own, so memory is bounded by the
    two parameters; each page sends at most ``k`` rows a query on.
    """
    ship_package(vectors.sparkSession)
    n, m = vectors.count(), queries.count()
    pages, blocks = max(1, -(-n // page_rows)), max(1, -(-m // query_rows))
    spread = lambda parts, salt: F.pmod(F.xxhash64("id", "v", F.lit(salt)), F.lit(parts)).cast("int")
    left = vectors.select("id", "v", F.size("v").alias("dim"), spread(pages, 1).alias("page"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    right = queries.select("id", "v", F.size("v").alias("dim"), F.explode(F.sequence(F.lit(0), F.lit(pages - 1))).alias("page"), spread(blocks, 2).alias("block"))
    cell = ["page", "block", "dim"]
    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(_searcher(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
