"""Cluster tree for pruned search: centres stay in a table and are met by joins, whatever their number.

A node with more than ``capacity`` vectors is split into ``fanout`` children around centres learnt from a bounded sample
of its own vectors. Vectors and queries go down level by level: those of a node, cut into parts, meet the node's
centres. No task and not the driver holds more than the centres of one node.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from eventloom.operators.search import _corpus, _grid, _matrix, rank_top_k
from eventloom.session import scratch_path

ROOT = 0
FANOUT = 64
# Vectors of a node that its centres are learnt from, rounds of learning, and vectors that meet the centres at a time.
SAMPLE, ROUNDS, PART = 4096, 8, 8192


def _distances(vectors: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return (vectors**2).sum(axis=1)[:, None] - 2.0 * (vectors @ centers.T) + (centers**2).sum(axis=1)[None, :]


def _means(vectors: np.ndarray, k: int) -> np.ndarray:
    """At most ``k`` centres by a fixed start and ``ROUNDS`` rounds; centres that lose all vectors go."""
    distinct = np.unique(vectors, axis=0)
    centers = distinct[np.linspace(0, len(distinct) - 1, min(k, len(distinct))).astype(int)]
    for _ in range(ROUNDS):
        home = _distances(vectors, centers).argmin(axis=1)
        used = np.unique(home)
        centers = np.stack([vectors[home == c].mean(axis=0) for c in used])
    return centers


def _learnt(rows: DataFrame, open_: DataFrame, level: int, fanout: int) -> DataFrame:
    """``node, child, center`` of the nodes to be split (``node, n``)."""

    def learn(table: pa.Table) -> pa.Table:
        lengths = pa.compute.list_value_length(table["embedding"]).to_numpy()
        dim = int(np.bincount(lengths).argmax())
        table = table.filter(pa.array(lengths == dim))
        order = np.argsort(table["id"].to_numpy(), kind="stable")
        centers = _means(_matrix(table["embedding"], dim)[order], fanout)
        node = table["node"][0].as_py()
        children = node * (fanout + 1) + 1 + np.arange(len(centers))
        return pa.table({"node": pa.array([node] * len(centers), pa.int64()), "child": pa.array(children), "center": pa.array(centers.tolist(), pa.list_(pa.float64()))})

    every = F.ceil(F.col("n") / SAMPLE)
    sample = rows.join(open_, "node").filter(F.pmod(F.xxhash64("id", F.lit(level)), every) == 0)
    return sample.select("node", "id", "embedding").groupBy("node").applyInArrow(learn, "node long, child long, center array<double>")


def _met(rows: DataFrame, centers: DataFrame, key: str, keep: int) -> DataFrame:
    """The ``keep`` nearest children of each row's node: ``key, embedding, child, distance``. Rows of nodes without centres fall away."""
    sizes = rows.groupBy("node").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    left = rows.join(sizes, "node").select("node", F.pmod(F.xxhash64(key), F.col("parts")).cast("int").alias("part"), F.col(key).alias("key"), "embedding")
    right = centers.join(sizes, "node").select(
        F.col("node").alias("c_node"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("c_part"), "child", "center"
    )
    schema = pa.schema([("key", pa.int64()), ("embedding", pa.list_(pa.float64())), ("child", pa.int64()), ("distance", pa.float64())])

    def near(some: pa.Table, around: pa.Table) -> pa.Table:
        if not some.num_rows or not around.num_rows:
            return schema.empty_table()
        around = around.sort_by("child")
        dim = len(around["center"][0])
        fit = pa.compute.equal(pa.compute.list_value_length(some["embedding"]), dim)
        some = some.filter(fit)
        distance = np.round(_distances(_matrix(some["embedding"], dim), _matrix(around["center"], dim)), 9)
        best = np.argsort(distance, axis=1, kind="stable")[:, :keep]
        at = np.repeat(np.arange(some.num_rows), best.shape[1])
        return pa.table(
            [some["key"].combine_chunks().take(pa.array(at)), some["embedding"].combine_chunks().take(pa.array(at)),
             around["child"].combine_chunks().take(pa.array(best.ravel())), pa.array(distance[at, best.ravel()])], schema=schema,
        )

    met = left.groupBy("node", "part").cogroup(right.groupBy("c_node", "c_part")).applyInArrow(near, "key long, embedding array<double>, child long, distance double")
    return met.withColumnRenamed("key", key)


@dataclass(frozen=True)
class ClusterTree:
    """``centers`` (node, child, center) and ``vectors`` by leaf below ``path``."""

    spark: SparkSession
    path: str

    @property
    def centers(self) -> DataFrame:
        return self.spark.read.schema("node long, child long, center array<double>").parquet(f"{self.path}/centers/*")

    @property
    def vectors(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/vectors")

    def leaves(self) -> DataFrame:
        """``leaf, n``: how many vectors each leaf holds."""
        return self.vectors.groupBy("leaf").agg(F.count("*").alias("n"))

    def looks(self, queries: DataFrame, nprobe: int) -> DataFrame:
        """``query_id, embedding, leaf``: the leaves a query looks into.

        On each level a query keeps its ``nprobe`` nearest nodes; a node without children is a leaf and stays. Each level is
        written before the next begins: it is read several times there, so that the plan would grow as a power of the depth.
        """
        path = scratch_path(self.spark, "looks")

        def stored(df: DataFrame, level: int) -> DataFrame:
            df.write.parquet(f"{path}/{level}")
            return self.spark.read.parquet(f"{path}/{level}")

        asked = _corpus(queries, None).select("query_id", F.col("embedding").cast("array<double>").alias("embedding"), F.lit(ROOT).cast("long").alias("node"), F.lit(0.0).alias("distance"))
        centers, nodes = self.centers, self.centers.select("node").distinct()
        nearest = Window.partitionBy("query_id").orderBy("distance", "node")
        for level in range(len(self.levels())):
            asked = stored(asked, level)
            down = _met(asked.join(nodes, "node", "left_semi").select("query_id", "embedding", "node"), centers, "query_id", nprobe)
            stay = asked.join(nodes, "node", "left_anti").select("query_id", "embedding", "node", "distance")
            asked = stay.unionByName(down.withColumnRenamed("child", "node")).withColumn("_r", F.row_number().over(nearest)).filter(F.col("_r") <= nprobe).drop("_r")
        return stored(asked.select("query_id", "embedding", F.col("node").alias("leaf")), -1)

    def levels(self) -> list[int]:
        return [r["level"] for r in self.spark.read.parquet(f"{self.path}/levels").orderBy("level").collect()]

    def topk(self, queries: DataFrame, k: int = 10, nprobe: int = 32, where: Column | None = None) -> DataFrame:
        """``k`` best rows per query among the leaves it looks into: query_id, id, score, rank."""
        looks = self.looks(queries, nprobe).select(F.col("leaf").alias("bucket"), "query_id", "embedding")
        rows = _corpus(self.vectors, where).select(F.col("leaf").alias("bucket"), "id", "embedding")
        return rank_top_k(_grid(rows, looks, k), k)

    def share_read(self, queries: DataFrame, nprobe: int) -> DataFrame:
        """One row: mean ``share`` of all vectors that a query is scored against."""
        sizes = self.leaves()
        read = self.looks(queries, nprobe).join(sizes, "leaf").groupBy("query_id").agg(F.sum("n").alias("n"))
        total = sizes.agg(F.sum("n").alias("total"))
        return read.agg(F.avg("n").alias("n")).join(F.broadcast(total)).select((F.col("n") / F.col("total")).alias("share"))


def build_tree(
    corpus: DataFrame, path: str, capacity: int = 4096, fanout: int = FANOUT, given: DataFrame | None = None, most_levels: int = 10
) -> ClusterTree:
    """Store the corpus (id, embedding) by leaf of a cluster tree.

    Leaves hold at most ``capacity`` vectors, but for vectors that no centre parts (equal ones); a search cuts those
    into blocks. ``given`` centres (node, child, center; the root is node 0) are taken as they are and nothing is learnt.
    Vectors of another length than a node's centres (its most frequent length) are left out. Each level is written before the next begins.
    """
    spark = corpus.sparkSession
    rows = _corpus(corpus, None).select("id", F.col("embedding").cast("array<double>").alias("embedding"), F.lit(ROOT).cast("long").alias("node"), F.lit(True).alias("open"))
    levels = []
    for level in range(most_levels):
        rows.write.mode("overwrite").parquet(f"{path}/level-{level}")
        rows = spark.read.parquet(f"{path}/level-{level}")
        if given is None:
            counts = rows.filter("open").groupBy("node").agg(F.count("*").alias("n")).filter(F.col("n") > capacity)
            centers = _learnt(rows, counts, level, fanout)
        else:
            centers = given.join(rows.select("node").distinct(), "node", "left_semi").select("node", "child", "center")
        centers.select(F.col("node").cast("long").alias("node"), F.col("child").cast("long").alias("child"), "center").write.mode("overwrite").parquet(f"{path}/centers/{level}")
        centers = spark.read.parquet(f"{path}/centers/{level}")
        if centers.isEmpty():
            break
        levels.append(level)
        nodes = centers.groupBy("node").agg((F.count("*") > 1).alias("several"))
        moved = _met(rows.join(nodes, "node", "left_semi").select("id", "embedding", "node"), centers, "id", 1)
        moved = moved.join(centers.select("node", "child"), "child").join(nodes, "node").select("id", "embedding", F.col("child").alias("node"), F.col("several").alias("open"))
        rows = rows.join(nodes, "node", "left_anti").unionByName(moved)
    spark.createDataFrame([(x,) for x in levels], "level int").coalesce(1).write.mode("overwrite").parquet(f"{path}/levels")
    rows.select("id", "embedding", F.col("node").alias("leaf")).hint("rebalance", "leaf").write.mode("overwrite").parquet(f"{path}/vectors")
    return ClusterTree(spark, path)
