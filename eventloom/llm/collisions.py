"""Nearest neighbours by cosine through collision counting over sorted projections."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

# Projections, collisions that make a candidate, and the window's width in units of the radius.
PROJECTIONS, THRESHOLD, WIDTH = 96, 60, 2.0
# Radii of virtual rehashing (distance of unit vectors): the first, and the factor from one to the next.
FIRST_RADIUS, GROWTH = 0.6, 1.1
# A query stops in a block when this share of it has been verified.
VERIFY = 0.4
BLOCK_ROWS, CHUNK_QUERIES = 8_192, 20_000


class Block:
    """Index of a block of unit vectors: for each random line, its vectors in order of their projection."""

    def __init__(self, unit: np.ndarray) -> None:
        self.unit = unit
        lines = np.random.default_rng(unit.shape[1]).standard_normal((unit.shape[1], PROJECTIONS))
        self.lines = lines
        values = (unit @ lines).T
        self.order = np.argsort(values, axis=1, kind="stable")
        self.values = np.take_along_axis(values, self.order, axis=1)

    def candidates(self, queries: np.ndarray, k: int):
        """Yield, per query, the rows verified for it: those in the windows of enough lines.

        The window around the query's own projection widens with the radius; rows that enter it are counted once.
        A query stops when its k nearest verified rows lie within the radius or enough rows are verified; in the end
        the windows hold every row.
        """
        for i in range(0, len(queries), 256):
            yield from self._batch(queries[i : i + 256], k)

    def _batch(self, queries: np.ndarray, k: int) -> list[np.ndarray]:
        rows, at = len(self.unit), queries @ self.lines
        counts, verified = np.zeros((len(queries), rows), np.int16), np.zeros((len(queries), rows), bool)
        found, near = [np.zeros(0, np.int64) for _ in queries], [np.zeros(0) for _ in queries]
        low = high = np.zeros((len(queries), PROJECTIONS), np.int64)
        active, radius = list(range(len(queries))), FIRST_RADIUS
        while active:
            half = radius * WIDTH / 2
            lo, hi = np.zeros_like(low), np.zeros_like(high)
            for i in range(PROJECTIONS):
                lo[active, i] = np.searchsorted(self.values[i], at[active, i] - half, "left")
                hi[active, i] = np.searchsorted(self.values[i], at[active, i] + half, "right")
            if radius == FIRST_RADIUS:
                low, high = lo, lo
            going = []
            for q in active:
                parts = [self.order[i, a:b] for i, (a, b) in enumerate(zip(lo[q].tolist(), low[q].tolist())) if b > a]
                parts += [self.order[i, a:b] for i, (a, b) in enumerate(zip(high[q].tolist(), hi[q].tolist())) if b > a]
                if parts:
                    counts[q] += np.bincount(np.concatenate(parts), minlength=rows).astype(np.int16)
                    new = np.flatnonzero((counts[q] >= THRESHOLD) & ~verified[q])
                    verified[q, new] = True
                    found[q] = np.concatenate((found[q], new))
                    near[q] = np.concatenate((near[q], self.unit[new] @ queries[q]))
                total, everything = len(found[q]), lo[q].max() == 0 and hi[q].min() == rows
                # One more than k, as the query itself may be among them.
                close = total > k and np.partition(near[q], -(k + 1))[-(k + 1)] >= 1 - radius * radius / 2
                if not (close or everything or total >= k + 1 + VERIFY * rows):
                    going.append(q)
            low, high, active, radius = lo, hi, going, radius * GROWTH
        return found


def nearest(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of each query, nearest first, ties to the smaller id.

    Queries are the rows whose vec_id is divisible by ``every``, candidates all rows but the query's own. ``score`` is
    the cosine of the original vectors in double precision. The corpus is dealt into blocks of about ``BLOCK_ROWS``
    rows by a hash of the id, so copies of one vector spread; each block is indexed and asked by the queries in
    chunks. A query's answer needs at most k rows per block after that.

    Rows without id, and vectors that are null, empty, zero or hold null or non-finite numbers take no part. Vectors
    of different lengths are not compared. Repeated rows of an id count once if their vectors are equal; rows with
    the query's id are never its neighbours. Fewer than k candidates give all. No rows give no rows.
    """
    good = F.expr("size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('inf')) and exists(embedding, x -> x <> 0)")
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).filter("vec_id is not null").filter(good)
    asked = rows.filter(F.col("vec_id") % every == 0)
    counts = rows.agg(F.count("*"), F.count(F.when(F.col("vec_id") % every == 0, 1))).first()
    blocks, chunks = max(1, -(-counts[0] // BLOCK_ROWS)), max(1, -(-counts[1] // CHUNK_QUERIES))
    every_chunk, every_block = F.sequence(F.lit(0), F.lit(chunks - 1)), F.sequence(F.lit(0), F.lit(blocks - 1))
    left = asked.select(
        F.explode(every_block).alias("b"), F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int").alias("c"), F.col("vec_id").alias("query_id"), F.col("embedding").alias("q")
    )
    right = rows.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("b"), F.explode(every_chunk).alias("c"), F.col("vec_id").alias("v"), F.col("embedding").alias("e")
    )

    def search(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = []
        block = block.assign(d=block["e"].map(len), t=block["e"].map(lambda x: np.asarray(x).tobytes())).drop_duplicates(["v", "t"])
        queries = queries.assign(d=queries["q"].map(len), t=queries["q"].map(lambda x: np.asarray(x).tobytes())).drop_duplicates(["query_id", "t"])
        for d, asking in queries.groupby("d"):
            mine = block[block["d"] == d].sort_values("v")
            if not len(mine):
                continue
            x, y = np.stack(mine["e"].to_numpy()), np.stack(asking["q"].to_numpy())
            names, who = mine["v"].to_numpy(), asking["query_id"].to_numpy()
            x_size, y_size = np.sqrt(np.einsum("ij,ij->i", x, x)), np.sqrt(np.einsum("ij,ij->i", y, y))
            index = Block(x / x_size[:, None])
            for i, found in enumerate(index.candidates(y / y_size[:, None], k)):
                found = np.sort(found[names[found] != who[i]])
                score = np.einsum("ij,j->i", x[found], y[i]) / (x_size[found] * y_size[i])
                best = np.argsort(-score, kind="stable")[:k]
                out.append(pd.DataFrame({"query_id": who[i], "vec_id": names[found[best]], "score": score[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    hits = left.groupBy("b", "c").cogroup(right.groupBy("b", "c")).applyInPandas(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
