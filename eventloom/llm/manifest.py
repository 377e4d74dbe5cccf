"""Merkle manifest of a dataset: roots per source and a proof for every row, as a rollup of nested structs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventloom.llm.common import stored

# Fixed values of the manifest: 16 nodes make a parent, so a level is one hexadecimal digit of the rank.
BITS = 4
# Digits that are grouped away in one round: a block holds 16^3 nodes, whatever the size of its tree.
DIGITS = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf(columns: Mapping[str, Column] | None = None) -> Column:
    """Digest of a row: of each column its bytes in UTF-8, a colon and its value, or ``-`` for null."""
    values = [((columns or {}).get(c, F.col(c))).cast("string") for c in COLUMNS]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values)), 256)


def fold(start: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, start, lambda h, level: F.sha2(F.concat(level["left"], h, level["right"]), 256))


def _ranked(rows: DataFrame, tree: str, *order: str) -> DataFrame:
    """Add ``rank`` (from 0) of each row in its ``tree`` and ``n``, the tree's number of rows.

    A global range sort, so a tree of any size spreads over partitions; the last key parts rows that are equal. Ranks
    are places in the partition plus the rows of the tree in earlier ones, of which there is one number per tree and
    partition.
    """
    keys = [tree, *order, "_tie"]
    placed = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stored(placed.drop("_tie").withColumn("_at", F.monotonically_increasing_id()), "ranked")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    parts = placed.groupBy(tree, "_part").agg(F.min("_at").alias("_from"), F.count("*").alias("_rows"))
    whole = Window.partitionBy(tree)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        tree, "_part", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_from")).alias("_shift"), F.sum("_rows").over(whole).alias("n")
    )
    return placed.join(parts, [tree, "_part"]).withColumn("rank", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def _rolled(nodes: DataFrame) -> DataFrame:
    """One row per block of a tree: ``tree, n, block, digest`` and the nodes below in ``kids``, nested level by level.

    ``nodes`` are ``tree, n, rank, node`` with ``node.digest``. Blocks are dealt out once; each digit of the rank is
    then grouped away inside its partition.
    """
    digits = [F.shiftright("rank", BITS * i).bitwiseAND((1 << BITS) - 1).cast("int").alias(f"d{i}") for i in range(DIGITS)]
    rows = nodes.select("tree", "n", F.shiftright("rank", BITS * DIGITS).alias("block"), *digits, "node").repartition("tree", "block")
    for i in range(DIGITS):
        above = [f"d{j}" for j in range(DIGITS - 1, i, -1)]
        kids = F.array_sort(F.collect_list(F.struct(F.col(f"d{i}").alias("digit"), "node")))
        rows = rows.groupBy("tree", "n", "block", *above).agg(kids.alias("kids"))
        joined = F.array_join(F.transform("kids", lambda k: k["node"]["digest"]), "")
        digest = F.when(F.col("n") > 1 << (BITS * i), F.sha2(joined, 256)).otherwise(F.col("kids")[0]["node"]["digest"])
        rows = rows.select("tree", "n", "block", *above, F.struct(digest.alias("digest"), "kids").alias("node"))
    return rows.select("tree", "n", "block", "node.digest", "node.kids")


def _tree(nodes: DataFrame) -> list[DataFrame]:
    """Blocks of the nodes, blocks of those blocks and so on, until every tree is one block."""
    rounds = [stored(_rolled(nodes), "blocks")]
    size = 1 << (BITS * DIGITS)
    while (rounds[-1].agg(F.max("n")).first()[0] or 0) > size:
        heads = rounds[-1].select(
            "tree", F.ceil(F.col("n") / size).cast("long").alias("n"), F.col("block").alias("rank"), F.struct("digest").alias("node")
        )
        rounds.append(stored(_rolled(heads), "blocks"))
    return rounds


def _opened(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """``tree, rank, proof, carried, node`` of the nodes in blocks, from the proof of each block (``tree, block, proof, carried``).

    A block and its proof meet in one group. Exploding a level adds the digests before and behind a node to its proof.
    """
    found = dict(above.dtypes)
    none = {c: F.lit(None).cast(dict(blocks.dtypes)[c]).alias(c) for c in ("n", "kids")}
    both = blocks.select("tree", "block", "n", "kids", *(F.lit(None).cast(found[c]).alias(c) for c in ("proof", "carried"))).unionByName(
        above.select("tree", "block", "proof", "carried", *none.values())
    )
    rows = both.groupBy("tree", "block").agg(*(F.first(c, ignorenulls=True).alias(c) for c in ("n", "kids", "proof", "carried")))
    rows = rows.withColumn("rank", F.col("block"))
    for i in reversed(range(DIGITS)):
        digests = F.transform("kids", lambda k: k["node"]["digest"]).alias("digests")
        rows = rows.select("tree", "n", "rank", "proof", "carried", digests, F.posexplode("kids").alias("at", "kid"))
        side = lambda start, length: F.array_join(F.slice("digests", start, length), "")
        level = F.struct(side(F.lit(1), F.col("at")).alias("left"), side(F.col("at") + 2, F.lit(1 << BITS)).alias("right"))
        proof = F.when(F.col("n") > 1 << (BITS * i), F.concat(F.array(level), "proof")).otherwise(F.col("proof"))
        rows = rows.select(
            "tree", "n", (F.shiftleft("rank", BITS) + F.col("kid.digit")).alias("rank"), proof.alias("proof"), "carried",
            *(["kid.node"] if i == 0 else ["kid.node.kids"]),
        )
    return rows.select("tree", "rank", "proof", "carried", "node")


def proofs(docs: DataFrame, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof`` of every row; ``extra`` columns are computed from the row and carried along.

    Leaves of a source stand by doc_id; every 16 consecutive nodes make a parent, the digest of their digests in
    hexadecimal, until one is left: the subroot. Subroots stand by source (null first, by bytes) and make the root
    alike. ``proof`` lists, from the leaf up, the digests ``left`` and ``right`` of a node in its run, one entry for
    each level that has a parent (``fold`` gives the root back).

    Texts are hashed where they are read and go no further. A source that holds most rows is many blocks of 4,096
    nodes; the work is one range sort and two shuffles of digests, and the levels above add a 4,096th each.

    Null in a column is hashed as ``-`` and an empty text as ``0:``. A null id comes first; rows of the same id stand by
    digest, and repeated rows are a leaf each. A null source is a source. No rows give no rows. Other columns are
    ignored, whatever their names.
    """
    extra = extra or {}
    fields = ["doc_id", *extra]
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("tree"), F.col("doc_id").alias("_id"), leaf().alias("_leaf"),
        F.struct(leaf().alias("digest"), "doc_id", *(c.alias(name) for name, c in extra.items())).alias("node"),
    )
    leaves = _ranked(rows, "tree", "_id", "_leaf").drop("_id", "_leaf")
    of_rows = _tree(leaves)
    subroots = of_rows[-1].select(F.lit("").alias("all"), F.col("tree").alias("member"), "digest")
    of_sources = _tree(_ranked(subroots, "all", "member").select(F.col("all").alias("tree"), "n", "rank", F.struct("digest", "member").alias("node")))

    no_proof = F.array().cast("array<struct<left: string, right: string>>").alias("proof")
    above = of_sources[-1].select("tree", "block", no_proof, F.struct(F.col("digest").alias("root")).alias("carried"))
    for blocks in reversed(of_sources):
        opened = _opened(blocks, above)
        above = opened.select("tree", F.col("rank").alias("block"), "proof", "carried", *(["node"] if blocks is of_sources[0] else []))
    above = above.select(
        F.col("node.member").alias("tree"), F.lit(0).cast("long").alias("block"), "proof",
        F.struct(F.col("carried.root").alias("root"), F.col("node.digest").alias("subroot")).alias("carried"),
    )
    for blocks in reversed(of_rows):
        opened = _opened(blocks, above)
        above = opened.select("tree", F.col("rank").alias("block"), "proof", "carried")
    return opened.select(
        "node.doc_id", F.col("node.digest").alias("leaf"), "carried.subroot", "carried.root", "proof", *(F.col("node")[c].alias(c) for c in fields[1:])
    )


def roots(docs: DataFrame) -> DataFrame:
    """The manifest itself: ``source, n_rows, subroot`` of every source. The same rules as ``proofs``."""
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("tree"), F.col("doc_id").alias("_id"), leaf().alias("_leaf"),
        F.struct(leaf().alias("digest")).alias("node"),
    )
    rounds = _tree(_ranked(rows, "tree", "_id", "_leaf").drop("_id", "_leaf"))
    counted = rounds[0].groupBy("tree").agg(F.max("n").alias("n_rows"))
    source = F.when(F.col("tree") != "", F.expr("substring(tree, 2)")).alias("source")
    both = rounds[-1].select("tree", "digest", F.lit(None).cast("long").alias("n_rows")).unionByName(counted.withColumn("digest", F.lit(None).cast("string")))
    return both.groupBy("tree").agg(F.max("n_rows").alias("n_rows"), F.max("digest").alias("subroot")).select(source, "n_rows", "subroot")
