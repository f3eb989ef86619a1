"""Exact top-k search by inner product with M-trees.

Vectors become whole numbers, floor(1024 x). One more coordinate, sqrt(M*M - |x|*|x|) with M the longest length, puts all of them on
a sphere and leaves inner products with queries (whose extra coordinate is 0) as they are; the largest products are then the
smallest Euclidean distances, and a metric tree finds them. Equal vectors are one object with its smallest ids.

The objects are dealt to shards by their nearest pivot. Each shard is a tree of pages: an inner page holds routing objects with
covering radii and their distances to the page's own routing object, a leaf holds objects with that distance. The search takes the page
with the smallest possible distance first. With the stored distances the triangle inequality rules out most entries of a page before
any distance is computed. A query first searches the shard of its nearest pivot; the others are searched with the bound
found there, and only if their pivot and radius allow it. Queries meet shards in blocks. Scores are exact whole numbers.

Defined results: vectors that are NULL or hold a NULL, NaN or infinite component, and rows without an id, take no part; shorter vectors are filled
with zeros; an empty vector scores 0 with everything. Rows that repeat an id are objects of their own, none of them
a candidate for a query of that id; a repeated query has one answer, by its smallest vector. Ties go to the smaller id.
"""

from __future__ import annotations

import heapq
import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthclose.llm.common import small_batches, stored

#: Entries of a leaf and children of an inner page; objects of a shard; most shards; queries of one block.
LEAF, FANOUT, SHARD, MOST_SHARDS, QUERY_BLOCK = 512, 8, 4096, 65_536, 512
SCALE = 1024


def quantized(vector: Column) -> Column:
    """floor(1024 x) of every component; NULL if one of them is no finite number."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(doubles, lambda x: F.floor(x * SCALE)))


class Tree:
    """Pages over the rows of ``points`` (on the sphere)."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.center, self.radius, self.to_parent, self.parent, self.children = [], [], [], [], []
        self.entries: list[np.ndarray] = []
        self.distances: list[np.ndarray] = []
        if len(points):
            self._page(np.arange(len(points)), 0, -1)

    def _distance(self, rows: np.ndarray, center: int) -> np.ndarray:
        return np.sqrt(((self.points[rows] - self.points[center]) ** 2).sum(axis=1))

    def _page(self, rows: np.ndarray, center: int, parent: int) -> None:
        pending = [(rows, center, parent)]
        while pending:
            rows, center, parent = pending.pop()
            page = len(self.center)
            away = self._distance(rows, center)
            self.center.append(center)
            self.radius.append(float(away.max()))
            self.parent.append(parent)
            self.to_parent.append(float(self._distance(np.array([center]), self.center[parent])[0]) if parent >= 0 else 0.0)
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(page)
            if len(rows) <= LEAF or self.radius[-1] == 0:
                self.entries.append(rows)
                self.distances.append(away)
                continue
            self.entries.append(rows[:0])
            self.distances.append(away[:0])
            # Routing objects far from each other; every object goes to the nearest.
            nearest, owner = away.copy(), np.zeros(len(rows), np.int64)
            chosen = [center]
            for k in range(1, min(FANOUT, math.ceil(len(rows) / LEAF) + 1)):
                new = int(rows[int(nearest.argmax())])
                own = self._distance(rows, new)
                closer = own < nearest
                nearest[closer], owner[closer] = own[closer], k
                chosen.append(new)
            pending += [(rows[owner == k], c, page) for k, c in enumerate(chosen) if (owner == k).any()]

    def order(self) -> np.ndarray:
        """The rows leaf by leaf: stored so, a leaf is one stretch."""
        return np.concatenate([*self.entries, np.zeros(0, np.int64)]).astype(np.int64)

    def arrays(self) -> dict[str, np.ndarray]:
        """The pages over rows in that order."""
        sizes = [len(e) for e in self.entries]
        kids = [len(c) for c in self.children]
        place = np.empty(len(self.points), np.int64)
        place[self.order()] = np.arange(len(place))
        return {
            "center": place[np.array(self.center, np.int64)], "radius": np.array(self.radius),
            "to_parent": np.array(self.to_parent), "entry_at": np.cumsum([0, *sizes]), "distances": np.concatenate([*self.distances, np.zeros(0)]), "child_at": np.cumsum([0, *kids]),
            "children": np.array([c for group in self.children for c in group], np.int64),
        }


class Search:
    """Best-first search in the pages of one shard."""

    def __init__(self, pages: dict[str, np.ndarray], limit: float):
        self.p, self.limit, self.computed = pages, limit, 0
        self.vectors = pages["vectors"].astype(float)
        self.ids, self.id_at = pages["ids"].tolist(), pages["id_at"].tolist()
        self.entry_at, self.child_at = pages["entry_at"].tolist(), pages["child_at"].tolist()

    def nearest(self, query: np.ndarray, own: int, k: int, floor: float = -math.inf) -> list[tuple[int, int]]:
        """The k best (score, id) that reach the score ``floor``, ties to the smaller id."""
        p, found = self.p, []  # found: a heap of (score, -id), the worst first
        if not len(p["center"]):
            return []
        base = float(query @ query) + self.limit
        slack = 1e-7 * (1 + math.sqrt(base + self.limit))

        def reach() -> float:
            least = max(floor, found[0][0] if len(found) == k else -math.inf)
            return math.inf if least == -math.inf else math.sqrt(max(base - 2 * least, 0.0)) + slack

        def away(rows: np.ndarray) -> np.ndarray:
            self.computed += len(rows)
            return np.sqrt(np.maximum(base - 2 * (self.vectors[rows] @ query), 0))

        first = float(away(p["center"][:1])[0])
        queue = [(max(first - p["radius"][0], 0.0), 0, first)]
        while queue:
            bound, page, to_center = heapq.heappop(queue)
            if bound > reach():
                break
            kids = p["children"][self.child_at[page] : self.child_at[page + 1]]
            most = reach()
            if len(kids):
                # |d(query, page) - d(child, page)| - radius bounds the child's distance from below.
                kids = kids[np.abs(to_center - p["to_parent"][kids]) - p["radius"][kids] <= most]
                if len(kids):
                    distance = away(p["center"][kids])
                    least = np.maximum(distance - p["radius"][kids], 0)
                    for c in np.flatnonzero(least <= most):
                        heapq.heappush(queue, (float(least[c]), int(kids[c]), float(distance[c])))
                continue
            low, high = self.entry_at[page], self.entry_at[page + 1]
            rows = np.flatnonzero(np.abs(to_center - p["distances"][low:high]) <= most) + low
            if not len(rows):
                continue
            self.computed += len(rows)
            if 2 * len(rows) > high - low:  # most of the leaf: one stretch without copying
                rows = np.arange(low, high)
                scores = self.vectors[low:high] @ query
            else:
                scores = self.vectors[rows] @ query
            worst = max(floor, found[0][0] if len(found) == k else -math.inf)
            for at in np.flatnonzero(scores >= worst).tolist():
                score, row = int(scores[at]), int(rows[at])
                for vec_id in self.ids[self.id_at[row] : self.id_at[row + 1]]:
                    if vec_id != own:
                        item = (score, -vec_id)
                        if len(found) < k:
                            heapq.heappush(found, item)
                        elif item > found[0]:
                            heapq.heapreplace(found, item)
        return sorted(((s, -i) for s, i in found), key=lambda x: (-x[0], x[1]))


def _packed(arrays: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, filled up with zeros."""
    out = np.zeros((len(column), width))
    for k, row in enumerate(column):
        values = np.asarray(row.as_py(), float)
        out[k, : len(values)] = values
    return out


def _on_sphere(vectors: np.ndarray, limit: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(limit - (vectors**2).sum(axis=1), 0))
    return np.hstack([vectors, rest[:, None]])


def top_k(vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best other rows of every row for which ``queries`` holds."""
    spark = vectors.sparkSession
    small_batches(spark)
    able = vectors.select(
        F.col(id_col).cast("long").alias("id"), quantized(F.col(vector_col)).alias("v"), queries.alias("query"))
    able = stored(able.where("id is not null and v is not null"), "vectors")
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    totals = able.agg(F.max(F.size("v")), F.max(length), F.sum(F.col("query").cast("int"))).first()
    width, limit, n_queries = totals[0] or 0, totals[1] or 0.0, totals[2] or 0
    if limit >= 2**52:
        raise ValueError("vectors are too long for exact products in doubles")
    # Equal vectors are one object; of its ids the smallest k + 1 can be in an answer, and k rows of each: the query's own id is
    # left out with all its rows. The limits are applied before the shuffle.
    order, same = Window.partitionBy("v").orderBy("id"), Window.partitionBy("v", "id").orderBy("id")
    objects = stored(
        able.select("id", "v").withColumn("r", F.row_number().over(same)).where(F.col("r") <= k)
        .withColumn("r", F.dense_rank().over(order)).where(F.col("r") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "objects")
    count = objects.count()
    shards = min(MOST_SHARDS, max(1, math.ceil(count / SHARD)))
    chosen = objects.select("v").orderBy(F.xxhash64("v"), "v").limit(shards).collect()  # at most MOST_SHARDS rows
    pivots = np.zeros((len(chosen), width))
    for row, pivot in zip(chosen, pivots, strict=True):
        pivot[: len(row["v"])] = row["v"]
    pivots = _on_sphere(pivots, limit)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _on_sphere(_matrix(batch.column(0), width), limit)
            shard = (points @ pivots.T).argmax(axis=1) if len(points) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard, pa.int64())], names=["v", "ids", "pivot"])

    dealt = stored(objects.mapInArrow(deal, "v array<long>, ids array<long>, pivot long"), "dealt")
    # A pivot with many objects has several shards.
    parts = dealt.groupBy("pivot").agg(F.ceil(F.count("*") / (2 * max(SHARD, count // MOST_SHARDS))).alias("parts"))
    sharded = dealt.join(F.broadcast(parts), "pivot").withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts")))

    def build(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        whole = _matrix(table.column("v").combine_chunks(), width)
        own = table.column("ids").to_pylist()
        pivot = int(table.column("pivot")[0].as_py())
        points = _on_sphere(whole, limit)
        radius = float(np.sqrt(((points - pivots[pivot]) ** 2).sum(axis=1)).max())
        tree = Tree(points)
        own = [own[k] for k in tree.order()]
        arrays = tree.arrays() | {
            "vectors": whole[tree.order()].astype(np.int64), "ids": np.array([i for x in own for i in x], np.int64),
            "id_at": np.cumsum([0, *(len(x) for x in own)])}
        return pa.table({
            "pivot": pa.array([pivot], pa.int64()), "part": table.column("part")[:1].combine_chunks(),
            "radius": pa.array([radius]), "pages": pa.array([_packed(arrays)], pa.binary())})

    trees = stored(sharded.groupBy("pivot", "part").applyInArrow(
        build, "pivot long, part long, radius double, pages binary"), "trees")
    # A few numbers for each shard; the shards are bounded.
    known = sorted((r["pivot"], r["part"], r["radius"]) for r in trees.select("pivot", "part", "radius").collect())
    shard_pivot = np.array([r[0] for r in known], np.int64)
    shard_part = np.array([r[1] for r in known], np.int64)
    shard_radius = np.array([r[2] for r in known])

    asked = able.where("query").groupBy("id").agg(F.min("v").alias("v")).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.lit(max(1, math.ceil(n_queries / QUERY_BLOCK)))))

    def route(home: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                q = _matrix(batch.column("v"), width)
                floor = batch.column("floor").to_numpy(zero_copy_only=False).astype(float)
                base = (q**2).sum(axis=1)[:, None] + limit
                away = np.sqrt(np.maximum(base - 2 * (q @ pivots[:, :-1].T), 0)) if len(q) else np.zeros((0, len(pivots)))
                first = away.argmin(axis=1) if len(q) else np.zeros(0, np.int64)
                at_home = shard_pivot[None, :] == first[:, None]
                if home:
                    rows, shard = np.nonzero(at_home & (shard_part[None, :] == 0))
                else:
                    bound = np.sqrt(np.maximum(base[:, 0] - 2 * floor, 0))
                    bound = np.where(np.isfinite(floor), bound, np.inf) + 1e-6 * (1 + np.sqrt(base[:, 0]))
                    able_to = away[:, shard_pivot] - shard_radius[None, :] <= bound[:, None]
                    rows, shard = np.nonzero(able_to & ~(at_home & (shard_part[None, :] == 0)))
                yield pa.RecordBatch.from_arrays(
                    [c.take(pa.array(rows)) for c in batch.columns]
                    + [pa.array(shard_pivot[shard]), pa.array(shard_part[shard])],
                    names=["id", "v", "block", "floor", "pivot", "part"])
        return run

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for pages, asks in zip(batch.column("pages"), batch.column("asks"), strict=True):
                tree = Search(dict(np.load(io.BytesIO(pages.as_py()))), limit)
                for ask in asks.as_py():
                    q = np.zeros(width)
                    q[: len(ask["v"])] = ask["v"]
                    found += [(ask["id"], i, s) for s, i in tree.nearest(q, ask["id"], k, ask["floor"])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[c] for f in found], pa.int64()) for c in range(3)], names=["query_id", "vec_id", "score"])

    schema = "id long, v array<long>, block long, floor double, pivot long, part long"

    def answers(asks: DataFrame, home: bool) -> DataFrame:
        routed = asks.select("id", "v", "block", "floor").mapInArrow(route(home), schema)
        grouped = routed.groupBy("pivot", "part", "block").agg(F.collect_list(F.struct("id", "v", "floor")).alias("asks"))
        return grouped.join(trees.select("pivot", "part", "pages"), ["pivot", "part"]).select("pages", "asks").mapInArrow(
            search, "query_id long, vec_id long, score long")

    at_home = stored(answers(asked.withColumn("floor", F.lit(float("-inf"))), True), "home")
    reached = at_home.groupBy("query_id").agg(F.count("*").alias("c"), F.min("score").alias("s")).where(F.col("c") >= k)
    further = asked.join(reached, asked["id"] == reached["query_id"], "left").withColumn(
        "floor", F.coalesce(F.col("s").cast("double"), F.lit(float("-inf"))))
    both = at_home.unionByName(answers(further, False))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return both.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def sql(modulus: int = 100, k: int = 10) -> str:
    """The same rows in SQL over the table embeddings."""
    return f"""
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS e FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
          FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % {modulus} = 0),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}"""
