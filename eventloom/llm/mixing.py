"""Mixing sources to target weights by weighted fair queueing, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventloom.llm.common import stored

# Shuffle cells of a source: its running total is summed per cell first, so no task holds a whole source.
CELL_DIGITS = 3


def words(text: str = "text") -> Column:
    """Number of runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _keyed(docs: DataFrame) -> DataFrame:
    """Source key that is never null and sorts null last, and the fixed random order of documents."""
    return docs.withColumn("_s", F.coalesce(F.concat(F.lit("="), "source"), F.lit("~"))).withColumn(
        "_h", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, epochs: int = 2) -> DataFrame:
    """Target words of each source: ``_s``, ``source_size``, ``target``.

    ``sizes`` has one row per source (``_s``, ``source_size``). Weights repeat along the sources in code point order.
    Targets share ``share`` of all words by weight; a source stops at ``epochs`` times its size and what is left over
    goes to the others by weight. That is the level L with sum(min(L * weight, cap)) = budget: with sources in order
    of cap / weight, the first whose own level does not pass its cap fixes L. One row per source, so one window.
    """
    by_name, by_level = Window.orderBy("_s"), Window.orderBy("_level", "_s").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    pick = F.array(*[F.lit(w) for w in weights])
    w = (
        sizes.withColumn("_w", F.element_at(pick, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
        .withColumn("_cap", F.col("source_size") * epochs)
        .withColumn("_level", F.col("_cap") / F.col("_w"))
    )
    full = F.coalesce(F.sum("_cap").over(by_level), F.lit(0))
    weight_left = F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(by_level), F.lit(0))
    w = w.withColumn("_at", (F.sum("source_size").over(everything) * F.lit(float(share)) - full) / weight_left)
    found = F.min(F.when(F.col("_at") <= F.col("_level"), F.struct("_level", "_s", "_at"))).over(everything)["_at"]
    level = F.coalesce(found, F.max("_level").over(everything))
    return w.select("_s", "source_size", F.least(F.col("_cap").cast("double"), level * F.col("_w")).alias("target"))


def schedule(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, epochs: int = 2) -> DataFrame:
    """The mix as one row per document: ``doc_id, source, size, source_size, target, finish, taken``.

    Each source's documents stand in a fixed random order (md5 of the id, then id and size) and repeat up to ``epochs``
    times. ``finish`` is the virtual finish time of the first copy: words of the source up to its end, divided by the
    source's target. All sources are cut at the same virtual time 1, where the total budget is spent; a document on
    the border counts with the words before it. ``taken`` are the words of all copies before the cut.

    Running totals are sums per cell of a source plus sums inside a cell, so a source that holds a third of all rows
    spreads over thousands of groups. Texts are read once and never shuffled.

    Null text has size 0. A null source is a source of its own, last in order. A null id sorts as the empty string.
    Repeated rows count each. A document or source without words takes 0 words; ``finish`` is null where the target is 0.
    No rows give no rows. Other columns are ignored.
    """
    base = stored(docs.select("doc_id", "source", words().alias("size")), "mix-sizes")
    base = _keyed(base).withColumn("_c", F.substring("_h", 1, CELL_DIGITS))
    cells = stored(base.groupBy("_s", "_c").agg(F.sum("size").alias("_cell")), "mix-cells")
    goal = targets(cells.groupBy("_s").agg(F.sum("_cell").alias("source_size")), weights, share, epochs)
    before = Window.partitionBy("_s").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select("_s", "_c", F.coalesce(F.sum("_cell").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_s", "_c").orderBy("_h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    rows = base.withColumn("_end", F.sum("size").over(inside)).join(starts, ["_s", "_c"]).join(goal, "_s")
    rows = rows.withColumn("_end", F.col("_start") + F.col("_end")).withColumn("_before", F.col("_end") - F.col("size"))
    limit = F.floor("target")
    taken = F.lit(0).cast("long")
    for copy in range(epochs):
        room = limit - F.col("source_size") * copy - F.col("_before")
        taken = taken + F.greatest(F.lit(0), F.least(F.col("size"), room))
    return rows.select(
        "doc_id", "source", "size", "source_size", "target",
        F.when(F.col("target") > 0, F.col("_end") / F.col("target")).alias("finish"),
        taken.cast("long").alias("taken"), "_s", "_h", "_before",
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, epochs: int = 2) -> DataFrame:
    """``schedule`` in mix order: a global range sort by virtual finish time (null last), then source and id."""
    plan = schedule(docs, weights, share, epochs)
    return plan.drop("_s", "_h", "_before").orderBy(F.col("finish").asc_nulls_last(), "source", "doc_id")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, epochs: int = 2) -> DataFrame:
    """The documents of the mix, all columns kept, a document once per copy.

    Documents stay whole: the copy on the border of a source is kept if at least half of its words are due. Each
    source needs only its number of full rounds and the place of its border, so texts are not shuffled. Documents
    without words are kept once. Rows with the same id and source share a decision.
    """
    plan = schedule(docs, weights, share, epochs)
    due = F.floor("target")
    rounds = F.when(F.col("source_size") > 0, F.floor(due / F.col("source_size"))).otherwise(F.lit(1))
    rest = due - rounds * F.col("source_size")
    place = F.struct(F.col("_h").alias("h"), F.coalesce(F.col("doc_id"), F.lit(-1)).alias("i"))
    past = F.col("_before") + F.col("size") > rest
    border = plan.groupBy("_s").agg(
        F.first(rounds).alias("_rounds"),
        F.min(F.when(past, F.struct(place.alias("p"), (2 * (rest - F.col("_before")) >= F.col("size")).alias("half")))).alias("_b"),
    )
    here = F.struct(F.col("_h").alias("h"), F.coalesce(F.col("doc_id"), F.lit(-1)).alias("i"))
    more = F.when(here < F.col("_b.p"), 1).when((here == F.col("_b.p")) & F.col("_b.half"), 1).otherwise(0)
    copies = F.when(words() == 0, 1).otherwise(F.coalesce(F.col("_rounds") + more, F.lit(0))).cast("int")
    out = _keyed(docs).join(stored(border, "mix-borders"), "_s").withColumn("_n", copies).filter("_n > 0")
    return out.withColumn("_n", F.explode(F.sequence(F.lit(1), "_n"))).select(*docs.columns)
