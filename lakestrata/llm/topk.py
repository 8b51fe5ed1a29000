"""Exact top-k inner products by ball trees over shards."""

from __future__ import annotations

from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.functions.text import quoted
from lakestrata.session import work_folder

#: Vectors of one shard, queries of one block, vectors of one leaf.
SHARD, BLOCK, LEAF = 8192, 4096, 128


class BallTree:
    """Balls around halves of halves of the rows of `vectors`; `order` lists the rows by leaf."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        self.order = np.arange(len(vectors))
        self.vectors, self.ids = vectors, ids
        self.centres: list[np.ndarray] = []
        self.radii: list[float] = []
        self.spans: list[tuple[int, int]] = []
        self.least: list[int] = []  # smallest id inside
        self.children: list[tuple[int, int] | None] = []
        self._node(0, len(vectors))
        self.vectors, self.ids = vectors[self.order], ids[self.order]
        self.centre_rows = np.array(self.centres).reshape(len(self.radii), vectors.shape[1])

    def _node(self, start: int, stop: int) -> int:
        rows = self.vectors[self.order[start:stop]]
        centre = rows.mean(axis=0)
        away = np.sqrt(((rows - centre) ** 2).sum(axis=1))
        number = len(self.radii)
        self.centres.append(centre)
        self.radii.append(float(away.max()))
        self.spans.append((start, stop))
        self.least.append(int(self.ids[self.order[start:stop]].min()))
        self.children.append(None)
        if stop - start > LEAF:
            # Halve along the line from the farthest row to the row farthest from it.
            pole = rows[away.argmax()]
            far = rows[((rows - pole) ** 2).sum(axis=1).argmax()]
            by = np.argsort(rows @ (far - pole), kind="stable")
            self.order[start:stop] = self.order[start:stop][by]
            middle = (start + stop) // 2
            left = self._node(start, middle)
            self.children[number] = (left, self._node(middle, stop))
        return number

    def search(self, queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, k: int) -> list[list[tuple]]:
        """For each query up to k (-score, id), best first, none below its floor; its own id is left out."""
        lengths = np.sqrt((queries**2).sum(axis=1))
        bounds = queries @ self.centre_rows.T + lengths[:, None] * np.array(self.radii)
        bounds += 1e-9 * (1 + np.abs(bounds) + lengths[:, None] * np.abs(self.centre_rows).sum(axis=1))
        found = []
        for query, own, floor, bound in zip(queries, query_ids, floors, bounds, strict=True):
            best: list[tuple] = []
            heap = [(-bound[0], 0)]
            while heap:
                most, node = heappop(heap)
                worst = best[-1] if len(best) == k else (-floor, np.inf)
                if -most < -worst[0]:
                    break
                if len(best) == k and -most < 1 - worst[0] and self.least[node] > worst[1]:
                    continue  # its whole scores could only equal the k-th, of a smaller id
                if (children := self.children[node]) is not None:
                    for child in children:
                        heappush(heap, (max(most, -bound[child]), child))
                    continue
                start, stop = self.spans[node]
                scores = self.vectors[start:stop] @ query
                near = np.flatnonzero((scores >= -worst[0]) & (self.ids[start:stop] != own))
                if len(near):
                    best += zip((-scores[near]).tolist(), self.ids[start:stop][near].tolist(), strict=True)
                    best = sorted(best)[:k]
            found.append(best)
        return found


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _search(k: int):
    def search(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(rows):
            width = max(queries["vector"].map(len).max(), rows["vector"].map(len).max())
            a, b = _matrix(queries["vector"], width), _matrix(rows["vector"], width)
            tree = BallTree(b, rows["vec_id"].to_numpy(np.int64))
            floors = queries["floor"].to_numpy(float)
            for query, best in zip(
                queries["vec_id"], tree.search(a, queries["vec_id"].to_numpy(np.int64), floors, k), strict=True
            ):
                out += ((query, vec, int(-score)) for score, vec in best)
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    return search


def top_k(
    df: DataFrame, every: int = 50, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The k largest integer inner products of each query: query_id, rank (from 1), vec_id, score.

    Components become floor(scale * x). Queries are the rows whose id is divisible
    by `every`, candidates all rows of another id; equal scores go to the smaller
    id, and a query with fewer candidates gets them all. Vectors that are null or
    hold null or non-finite components take no part, nor do rows without an id; a
    shorter vector counts as padded with zeros. Rows that repeat an id are each a
    candidate; as a query the smallest vector of an id counts. Sums are exact
    while they stay below 2**53. An empty table gives no rows; other columns are
    not read.

    Rows are dealt to shards of bounded size in turn, queries to blocks of bounded
    size; a task holds one shard and one block. Each query is searched in one
    shard first, and its k-th score there is the floor for all other shards, so
    their trees are cut from the start. Each pair of a query and a shard gives k
    rows at most. Vectors and floors are written to the shared folder, so a lost
    executor costs its tasks only.
    """
    vector = F.col(quoted(vector_col))
    rows = (
        df.select(F.col(quoted(id_col)).cast("long").alias("vec_id"), vector.alias("vector"))
        .where(F.col("vec_id").isNotNull() & _usable(F.col("vector")))
        .withColumn("vector", F.transform("vector", lambda x: F.floor(x.cast("double") * scale).cast("double")))
    )
    queries = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    sizes = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(F.col(quoted(id_col)) % every == 0, 1)).alias("queries"),
    ).first()
    shards, blocks = -(-sizes["rows"] // SHARD) or 1, -(-sizes["queries"] // BLOCK) or 1
    schema = "query_id long, vec_id long, score long"
    key = ["shard", "block"]
    folder = work_folder(df.sparkSession, "top-k")
    rows.withColumn("shard", F.monotonically_increasing_id() % shards).write.parquet(f"{folder}/rows")
    queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))).write.parquet(f"{folder}/queries")

    def part(name: str) -> DataFrame:
        return df.sparkSession.read.parquet(f"{folder}/{name}")

    def every_one(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    at_home = F.col("block") % shards == F.col("shard")
    home = part("queries").select(
        "vec_id", "vector", "block", (F.col("block") % shards).alias("shard"), F.lit(float("-inf")).alias("floor")
    )
    home_rows = part("rows").withColumn("block", every_one(blocks)).where(at_home)
    home.groupBy(*key).cogroup(home_rows.groupBy(*key)).applyInPandas(_search(k), schema).write.parquet(
        f"{folder}/first"
    )
    first = part("first")
    if shards > 1:
        floors = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("floor"))
        part("queries").join(floors, F.col("vec_id") == F.col("query_id"), "left").select(
            "vec_id",
            "vector",
            "block",
            F.when(F.col("n") == k, F.col("floor").cast("double")).otherwise(float("-inf")).alias("floor"),
        ).write.parquet(f"{folder}/floors")
        others = part("floors").withColumn("shard", every_one(shards)).where(~at_home)
        other_rows = part("rows").withColumn("block", every_one(blocks)).where(~at_home)
        rest = others.groupBy(*key).cogroup(other_rows.groupBy(*key)).applyInPandas(_search(k), schema)
        first = first.unionByName(rest)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        first.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
