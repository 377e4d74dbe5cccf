"""Top-k search by inner product: exact, filtered and cluster-pruned.

Scores are computed block by block inside tasks (one matrix product per pair of blocks), and a block
gives back only its k best rows per query. No (query, row) pair is ever a Spark row.

Both sides are cut into blocks of bounded size, at every size and lazily. In the exact search each corpus block meets
every query block; in the pruned one they meet in a grid of (corpus block x query block) groups by bucket. Vectors that are null, empty or hold null or non-finite numbers take no part; vectors of different
lengths never meet.

Ranking uses the score rounded to 9 digits, then the id, so equal vectors order the same way
whatever block they were scored in.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.errors import AnalysisException
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from eventloom.session import bounded_broadcast

SCORE_DIGITS = 9
# A block of the grid holds at most about this many bytes of vectors as doubles; scores are made for so many queries at a time.
CORPUS_BLOCK_BYTES = 32 * 1024 * 1024
QUERY_BLOCK_BYTES = 8 * 1024 * 1024
# Blocks of the exact search, which cuts queries finer: their blocks are what its tasks are dealt.
PACKED_BYTES, ASKED_BYTES = 16 * 1024 * 1024, 1024 * 1024
QUERY_SLICE = 128
NPROBE = 32


# --- scoring inside a task -------------------------------------------------------------------


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """List column as a rows x dim array of doubles, without copying when already double."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, dim)


def _round(scores: np.ndarray) -> np.ndarray:
    return np.round(scores, SCORE_DIGITS)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query row, corpus row and rounded score of the ``k`` best of each row of ``scores``; ties go to the smaller id."""
    n = scores.shape[1]
    if n > k:
        # Keep everything that may round to the k-th score; the id decides below.
        kth = np.partition(scores, n - k, axis=1)[:, n - k]
        near = 2 * 10.0**-SCORE_DIGITS + 4 * np.finfo(float).eps * np.abs(kth)
        q, c = np.nonzero(scores >= np.where(np.isfinite(kth), kth - near, kth)[:, None])
    else:
        q, c = (x.ravel() for x in np.indices(scores.shape))
    s = _round(scores[q, c])
    order = np.lexsort((ids[c], -s, q))
    q, c, s = q[order], c[order], s[order]
    kept = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[kept], c[kept], s[kept]


_HIT_SCHEMA = T.StructType(
    [T.StructField("query_id", T.LongType()), T.StructField("id", T.LongType()), T.StructField("score", T.DoubleType())]
)
_HIT_ARROW = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])


def _scored(query_ids: pa.Array, asked: np.ndarray, ids: pa.Array, vectors: np.ndarray, k: int, part: int) -> Iterator[pa.RecordBatch]:
    """The ``k`` best vectors of a block for each query of another, ``part`` queries at a time."""
    order = ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
    for i in range(0, len(asked), part):
        q, c, s = _best(asked[i : i + part] @ vectors.T, order, k)
        yield pa.RecordBatch.from_arrays([query_ids.take(pa.array(q + i)), ids.take(pa.array(c)), pa.array(s)], schema=_HIT_ARROW)


def rank_top_k(scored: DataFrame, k: int, by: str = "query_id") -> DataFrame:
    """``k`` best rows per query with their rank; ties go to the smaller id."""
    w = Window.partitionBy(by).orderBy(F.desc("score"), "id")
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


# --- inputs ----------------------------------------------------------------------------------


def _usable() -> Column:
    """Vectors that can be scored. ``size(null)`` is -1."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (F.size("embedding") > 0) & finite


def _corpus(df: DataFrame, where: Column | None) -> DataFrame:
    if where is not None:
        df = df.filter(where)
    return df.filter(_usable())


# --- the grid --------------------------------------------------------------------------------


def _grid(corpus: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Candidates of every (corpus block, query block) pair that shares a bucket and a vector length.

    Both sides carry ``bucket``. A bucket with many rows is cut into as many blocks as its bytes ask for, so no group
    exceeds the block sizes by more than hashing unevenness.
    """
    keys = ["bucket", "dim"]
    corpus, queries = corpus.withColumn("dim", F.size("embedding")), queries.withColumn("dim", F.size("embedding"))

    def blocks(df: DataFrame, most: int, name: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.ceil(F.count("*") * F.col("dim") * 8 / most).cast("int").alias(name))

    sizes = blocks(corpus, CORPUS_BLOCK_BYTES, "cn").join(blocks(queries, QUERY_BLOCK_BYTES, "qn"), keys)

    def own(key: str, n: str) -> Column:
        return F.pmod(F.xxhash64(key), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = corpus.join(sizes, keys).select(*keys, own("id", "cn").alias("cb"), every("qn").alias("qb"), "id", "embedding")
    # Columns of its own on the right side: the queries may be taken from the corpus itself.
    names = [F.col(c).alias(f"q_{c}") for c in keys]
    right = queries.join(sizes, keys).select(*names, every("cn").alias("q_cb"), own("query_id", "qn").alias("q_qb"), F.col("query_id").alias("q_id"), F.col("embedding").alias("asked"))

    part = QUERY_SLICE

    def score(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if rows.num_rows == 0 or asked.num_rows == 0:
            return pa.Table.from_batches([], schema=_HIT_ARROW)
        dim = len(rows["embedding"][0])
        q, vectors = _matrix(asked["asked"], dim), _matrix(rows["embedding"], dim)
        qids, ids = asked["q_id"].combine_chunks(), rows["id"].combine_chunks()
        return pa.Table.from_batches(_scored(qids, q, ids, vectors, k, part), schema=_HIT_ARROW)

    groups = [*keys, "cb", "qb"]
    return left.groupBy(*groups).cogroup(right.groupBy(*(f"q_{c}" for c in groups))).applyInArrow(score, _HIT_SCHEMA)


# --- exact search ----------------------------------------------------------------------------


def _packed(df: DataFrame, most: int) -> DataFrame:
    """Rows (id, vector) packed where they are into blocks of one vector length: dim, ids and the vectors' bytes, ``most`` at most.

    Vectors that cannot be scored are left out here, a batch at a time.
    """
    key, embedding = df.columns
    single = isinstance(df.schema[embedding].dataType.elementType, T.FloatType)
    if not single:
        df = df.withColumn(embedding, F.col(embedding).cast("array<double>"))
    number = np.dtype(np.float32 if single else np.float64)
    schema = pa.schema([("dim", pa.int32()), ("ids", pa.list_(pa.int64())), ("vectors", pa.binary())])

    def block(dim: int, parts: list[tuple[pa.Array, np.ndarray]]) -> pa.RecordBatch:
        ids = pa.concat_arrays([ids for ids, _ in parts])
        listed = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), listed, pa.array([b"".join(v.tobytes() for _, v in parts)])], schema=schema)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for batch in batches:
            lengths = pa.compute.fill_null(pa.compute.list_value_length(batch.column(1)), 0)
            for dim in filter(None, pa.compute.unique(lengths).to_pylist()):
                some = batch.filter(pa.compute.equal(lengths, dim))
                # A null element becomes one that is not a number.
                vectors = some.column(1).flatten().to_numpy(zero_copy_only=False).astype(number, copy=False).reshape(-1, dim)
                sound = np.isfinite(vectors).all(axis=1)
                ids, vectors = some.column(0).filter(pa.array(sound)), vectors[sound]
                step = max(1, most // (dim * number.itemsize))
                for at in range(0, len(vectors), step):
                    piece = vectors[at : at + step]
                    if held and size + piece.nbytes > most:
                        yield from (block(*h) for h in held.items())
                        held, size = {}, 0
                    held.setdefault(dim, []).append((ids.slice(at, step), piece))
                    size += piece.nbytes
        yield from (block(*h) for h in held.items())

    return df.select(F.col(key).cast("long").alias(key), embedding).mapInArrow(pack, "dim int, ids array<long>, vectors binary")


def topk_exact(corpus: DataFrame, queries: DataFrame, k: int = 10, where: Column | None = None) -> DataFrame:
    """``k`` best corpus rows per query: query_id, id, score, rank.

    ``corpus`` has id (long) and embedding (array); ``queries`` has query_id (long) and embedding.
    ``where`` filters the corpus by its other columns before scoring.

    The corpus is neither shuffled nor broadcast: its rows are packed into blocks where they are read, and each block meets
    every block of queries. A task holds one pair of blocks at a time. Where a few queries are made from much, write them first.
    """
    rows = _packed((corpus if where is None else corpus.filter(where)).select("id", "embedding"), PACKED_BYTES)
    # Query blocks are dealt out, as the corpus may be one file: their number sets the tasks of a search by many queries.
    # Stored vectors may be packed small, so that sizes would not tell which side to broadcast: neither is.
    asked = _packed(queries.select("query_id", F.col("embedding").cast("array<double>").alias("embedding")), ASKED_BYTES)
    asked = asked.hint("rebalance").toDF("q_dim", "q_ids", "asked").hint("shuffle_replicate_nl")
    single = isinstance(corpus.schema["embedding"].dataType.elementType, T.FloatType)
    number, part = np.float32 if single else np.float64, QUERY_SLICE

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                dim, ids, vectors, q_dim, q_ids, asked = (c[row] for c in batch.columns)
                if dim == q_dim:
                    matrix = np.frombuffer(vectors.as_buffer(), number).astype(np.float64, copy=False).reshape(-1, dim.as_py())
                    yield from _scored(q_ids.values, np.frombuffer(asked.as_buffer()).reshape(-1, dim.as_py()), ids.values, matrix, k, part)

    return rank_top_k(rows.crossJoin(asked).mapInArrow(score, _HIT_SCHEMA), k)


# --- cluster-pruned search -------------------------------------------------------------------


@dataclass(frozen=True)
class ClusterIndex:
    """Corpus stored by cluster, and the cluster centres (``nlist`` rows at most)."""

    path: str
    centers: np.ndarray

    @staticmethod
    def open(spark: SparkSession, path: str) -> ClusterIndex:
        rows = spark.read.parquet(f"{path}/centers").orderBy("cluster").toArrow()
        dim = len(rows["center"][0])
        return ClusterIndex(path, _matrix(rows["center"], dim))

    def vectors(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/vectors")


def nlist_for(n: int, most: int | None = None) -> int:
    """As many clusters as a cluster has rows: the square root of the row count, at most ``most`` if given."""
    wanted = max(1, round(n**0.5))
    return wanted if most is None else min(most, wanted)


def build_ivf(
    corpus: DataFrame, path: str, nlist: int | None = None, seed: int = 42, max_iter: int = 10, stored: bool = False,
    centers: np.ndarray | None = None,
) -> ClusterIndex:
    """Cluster the corpus and store it partitioned by cluster.

    A search then reads only the probed clusters' folders. Writing is rebalanced by cluster, and
    AQE splits a cluster that holds much of the corpus into several tasks and files. Clustering
    reads the corpus once per iteration, so it is written out first unless it is already
    ``stored``: vectors that an encoder computes must not be computed again each time. Given ``centers`` are taken as
    they are.
    """
    spark = corpus.sparkSession
    rows = _corpus(corpus, None)
    if centers is not None:
        return _store_index(_assigned(rows, centers), centers, path)
    if not stored:
        # Dealt out anew: clustering starts from the order of its rows.
        write_vectors(rows.hint("rebalance"), f"{path}/staged")
        rows = spark.read.parquet(f"{path}/staged")
    if nlist is None:
        nlist = nlist_for(rows.count())
    features = rows.withColumn("_v", array_to_vector(F.col("embedding").cast("array<double>")))
    model = KMeans(k=max(nlist, 2), seed=seed, maxIter=max_iter, featuresCol="_v", predictionCol="cluster").fit(features)
    return _store_index(model.transform(features).drop("_v"), np.array(model.clusterCenters()), path)


def _assigned(rows: DataFrame, centers: np.ndarray) -> DataFrame:
    """``id, embedding, cluster``: each vector with its nearest given centre."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = _nearest(_matrix(batch.column("embedding"), centers.shape[1]), centers, 1)[:, 0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.int32())], names=["id", "embedding", "cluster"])

    kept = rows.filter(F.size("embedding") == centers.shape[1]).select("id", F.col("embedding").cast("array<double>"))
    return kept.mapInArrow(assign, "id long, embedding array<double>, cluster int")


def _store_index(rows: DataFrame, centers: np.ndarray, path: str) -> ClusterIndex:
    rows.hint("rebalance", "cluster").write.mode("overwrite").partitionBy("cluster").parquet(f"{path}/vectors")
    stored = rows.sparkSession.createDataFrame(
        [(i, [float(x) for x in c]) for i, c in enumerate(centers)], "cluster int, center array<double>"
    )
    stored.coalesce(1).write.mode("overwrite").parquet(f"{path}/centers")
    return ClusterIndex(path, centers)


def _nearest(vectors: np.ndarray, centers: np.ndarray, nprobe: int) -> np.ndarray:
    """Cluster numbers of the ``nprobe`` centres nearest to each vector."""
    distance = (centers**2).sum(axis=1)[None, :] - 2.0 * (vectors @ centers.T)
    return np.argsort(distance, axis=1, kind="stable")[:, :nprobe]


def topk_ivf(
    spark: SparkSession, index: ClusterIndex, queries: DataFrame, k: int = 10, nprobe: int = NPROBE, where: Column | None = None
) -> DataFrame:
    """``k`` best rows per query among the clusters of its ``nprobe`` nearest centres."""
    nlist, dim = index.centers.shape
    nprobe = min(nprobe, nlist)
    corpus = _corpus(index.vectors(spark), where)
    centers = index.centers

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = _nearest(_matrix(batch.column("embedding"), dim), centers, nprobe)
            yield pa.RecordBatch.from_arrays(
                [batch.column("query_id"), batch.column("embedding"), pa.array(near.tolist(), pa.list_(pa.int32()))],
                names=["query_id", "embedding", "buckets"],
            )

    asked = _corpus(queries, None).filter(F.size("embedding") == dim).select("query_id", F.col("embedding").cast("array<double>"))
    probed = asked.mapInArrow(probe, "query_id long, embedding array<double>, buckets array<int>")
    spread = probed.select(F.explode("buckets").alias("bucket"), "query_id", "embedding")
    return rank_top_k(_grid(corpus.select(F.col("cluster").alias("bucket"), "id", "embedding"), spread, k), k)


def recall(approx: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact hits that the pruned search found, over all queries."""
    found = approx.select("query_id", "id", F.lit(1).alias("_hit"))
    return exact.select("query_id", "id").join(found, ["query_id", "id"], "left").agg(
        F.count("*").alias("exact_hits"),
        F.count("_hit").alias("found_hits"),
        (F.count("_hit") / F.count("*")).alias("recall"),
    )


def with_fields(hits: DataFrame, corpus: DataFrame, fields: dict[str, str | int], most: int | None = None) -> DataFrame:
    """Add columns of the corpus rows that were hit; a null becomes the field's default.

    Every hit is a corpus row, so an inner join loses none. Wide columns are read only here, after
    ranking; with at most ``most`` hits those are broadcast and the corpus is not shuffled.
    """
    small = hits if most is None else bounded_broadcast(hits, most)
    joined = corpus.select("id", *fields).join(small, "id")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(d)) for c, d in fields.items()})


def attach_metadata(hits: DataFrame, meta: DataFrame, defaults: dict[str, str | int], most: int | None = None) -> DataFrame:
    """Add metadata kept in another table; a hit without metadata gets the defaults.

    With at most ``most`` hits the metadata is first reduced to their ids by a broadcast semi join.
    """
    if most is not None:
        meta = meta.join(bounded_broadcast(hits.select("id").distinct(), most), "id", "left_semi")
    joined = hits.join(meta.select("id", *defaults), "id", "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(d)) for c, d in defaults.items()})


def write_vectors(df: DataFrame, path: str) -> None:
    """Replace a vector table: scalar fields plus an ``embedding`` array. Rows are written where they are made."""
    df.write.mode("overwrite").parquet(path)


def collection_report(spark: SparkSession, collections: Mapping[str, str]) -> DataFrame:
    """One row per vector collection (name to path): whether it exists, its vectors, their lengths and its columns.

    Only a path that does not exist counts as missing; any other fault of a collection is an error.
    """
    shape = "collection string, exists boolean, num_entities long, min_dim int, max_dim int, columns string"
    out = spark.createDataFrame([], shape)
    for name, path in collections.items():
        try:
            df = spark.read.parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            out = out.unionByName(spark.createDataFrame([(name, False, None, None, None, None)], shape))
            continue
        columns = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields)
        sizes = df.agg(F.count("*").alias("num_entities"), F.min(F.size("embedding")).alias("min_dim"), F.max(F.size("embedding")).alias("max_dim"))
        out = out.unionByName(sizes.select(F.lit(name).alias("collection"), F.lit(True).alias("exists"), "*", F.lit(columns).alias("columns")))
    return out
