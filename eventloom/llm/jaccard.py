"""Exact Jaccard join of word shingle sets over a token-group matrix.

Similar documents form groups. The matrix holds, for each group, the tokens that any of its documents has. A document
asks only groups of other clusters whose token union can hold enough of its tokens, and only those are opened.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from eventloom.llm.common import in_pieces, stored, texts
from eventloom.llm.components import components
from eventloom.llm.shingles import mixed, shingle_sets

# One class of equal sets in SAMPLE is looked at to find common tokens; at most COMMON tokens are treated as common.
SAMPLE, COMMON = 32, 500_000
SIGNATURE = 8
GROUP_SIZE, GROUP_FROM, ASK_SIZE, BUCKET_TOKENS = 64, 64, 512, 500_000
# Groups that a class asks before it is known what the others connect.
FIRST_ASKED = 4
FILTER_BITS = 1 << 25
_PAGE = 32_768


def _keys(tokens: np.ndarray) -> tuple[int, int]:
    """Two 64-bit keys of a set."""
    a, b = mixed(tokens + np.uint64(11)), mixed(tokens + np.uint64(29))
    return int(a.sum().astype(np.int64)), int(np.bitwise_xor.reduce(b).astype(np.int64))


def _profiles(docs: DataFrame, width: int) -> DataFrame:
    """Per document: a hash of its text, set size, two keys of the set, its smallest tokens under 8 orders, and its tokens if sampled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts = [np.uint64(mixed(np.array([k + 1], np.uint64))[0]) for k in range(SIGNATURE)]
        for batch in in_pieces(batches, 2_000_000):
            rows = []
            for s in shingle_sets(texts(batch), width):
                if not len(s):
                    rows.append((0, None, None, None, None))
                    continue
                ka, kb = _keys(s)
                least = [int(mixed(s ^ salt).min().astype(np.int64)) for salt in salts]
                sampled = int(mixed(np.array([ka], np.int64).view(np.uint64))[0]) % SAMPLE == 0
                rows.append((len(s), ka, kb, least, s.tobytes() if sampled else None))
            n, ka, kb, least, tokens = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("h"), pa.array(n, pa.int64()), pa.array(ka, pa.int64()), pa.array(kb, pa.int64()),
                 pa.array(least, pa.list_(pa.int64())), pa.array(tokens, pa.binary())],
                ["doc_id", "h", "n", "ka", "kb", "least", "tokens"],
            )

    return docs.withColumn("h", F.xxhash64("text")).mapInArrow(run, "doc_id long, h long, n long, ka long, kb long, least array<long>, tokens binary")


def _common_tokens(profiles: DataFrame) -> np.ndarray:
    """Sorted tokens that are frequent in the sample. Which tokens these are decides only how fast the join is."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("tokens").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(raw, np.int64))], ["token"])

    sampled = profiles.filter("tokens is not null").groupBy("ka").agg(F.first("tokens").alias("tokens")).select("tokens")
    counted = stored(sampled.mapInArrow(spread, "token long").groupBy("token").count().filter("count >= 3"), "common")
    most = counted.groupBy("count").agg(F.count("*").alias("k")).orderBy(F.desc("count"))
    least, total = 3, 0
    for row in most.toLocalIterator():
        total += row["k"]
        if total > COMMON:
            least = row["count"] + 1
            break
    kept = counted.filter(F.col("count") >= least).select("token").toArrow().column(0).to_numpy()
    return np.sort(kept.view(np.uint64))


def _fetched(docs: DataFrame, classes: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``ka, tokens`` of the wanted classes, from the texts of one document each.

    A bit table of fixed size (4 MB) says which documents to look at, so other texts are not hashed or shuffled.
    """
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    marks = classes.join(wanted, "ka", "left_semi").select(F.col("first_id").alias("doc_id")).select(slot.alias("s"))
    pages = marks.groupBy(F.expr(f"s div {_PAGE}").alias("p")).agg(F.bitmap_construct_agg(F.col("s") % _PAGE).alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for p, page in zip(pages.column(0).to_pylist(), pages.column(1).to_pylist()):
        bits[p * (_PAGE // 8) : (p + 1) * (_PAGE // 8)] = np.frombuffer(page, np.uint8)
    table = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked, seen = table.value, set()
        for batch in in_pieces(batches, 2_000_000):
            s = batch.column("s").to_numpy()
            hit = (marked[s >> 3] >> (s & 7).astype(np.uint8)) & 1
            chosen = batch.filter(pa.array(hit.astype(bool)))
            found = [(_keys(x)[0], x) for x in shingle_sets(texts(chosen), width) if len(x)]
            fresh = {ka: x for ka, x in found if ka not in seen}
            seen.update(fresh)
            yield pa.RecordBatch.from_arrays(
                [pa.array(fresh.keys(), pa.int64()), pa.array([x.tobytes() for x in fresh.values()], pa.binary())], ["ka", "tokens"]
            )

    return docs.withColumn("s", slot).mapInArrow(run, "ka long, tokens binary")


def _opened(docs: DataFrame, classes: DataFrame, ask: DataFrame, member: DataFrame, width: int, percent: int) -> DataFrame:
    """Links ``a, b`` between classes that ask (``q, g, root``) and the members (``g, s, root``) of the groups asked.

    Classes of the same ``root`` are known to be connected and not linked again. A group has a bounded number of members; its askers are cut into chunks of about ``ASK_SIZE``.
    A chunk gives back a forest: links that connect what its links connect, fewer than it has askers and members.
    """
    chunks = ask.groupBy("g").agg(F.ceil(F.count("*") / ASK_SIZE).cast("int").alias("k"))
    asking = ask.join(chunks, "g").select(F.col("q").alias("ka"), "g", "root", F.pmod(F.xxhash64("q"), F.col("k")).cast("int").alias("c"), F.lit(True).alias("asks"))
    members = member.join(chunks, "g").select(
        F.col("s").alias("ka"), "g", "root", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("c"), F.lit(False).alias("asks")
    )
    roles = stored(asking.unionByName(members), "roles")
    sets = _fetched(docs, classes, roles.select("ka"), width)

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        parent: dict[int, int] = {}

        def top(x: int) -> int:
            while (above := parent.get(x, x)) != x:
                parent[x] = x = parent.get(above, above)
            return x

        asks = rows["asks"].to_numpy(bool)
        askers, group = rows[asks], rows[~asks]
        if len(askers) and len(group):
            sets_of = [np.frombuffer(x, np.uint64) for x in group["tokens"]]
            sizes = np.array([len(x) for x in sets_of])
            owner = np.repeat(np.arange(len(sets_of)), sizes)
            tokens = np.concatenate(sets_of)
            order = np.argsort(tokens, kind="stable")
            tokens, owner = tokens[order], owner[order]
            names, roots = group["ka"].to_numpy(), group["root"].to_numpy()
            for q, root, raw in zip(askers["ka"], askers["root"], askers["tokens"]):
                x = np.frombuffer(raw, np.uint64)
                lo = np.searchsorted(tokens, x, "left")
                runs = np.searchsorted(tokens, x, "right") - lo
                # The group's token union bounds what any member can share.
                if 100 * np.count_nonzero(runs) < percent * len(x):
                    continue
                at = np.repeat(lo - np.concatenate(([0], np.cumsum(runs)[:-1])), runs) + np.arange(runs.sum())
                shared = np.bincount(owner[at], minlength=len(sizes))
                linked = (100 * shared >= percent * (len(x) + sizes - shared)) & (roots != root)
                others, first = np.unique(roots[linked], return_index=True)
                for other, s in zip(others.tolist(), names[linked][first].tolist()):
                    x, y = top(root), top(other)
                    if x != y:
                        parent[x] = y
                        out.append((q, s))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return sets.join(roles, "ka").groupBy("g", "c").applyInPandas(compare, "a long, b long")


def _blocks(rows: DataFrame, whole: str, part: str) -> DataFrame:
    """Add ``g``: groups of about ``GROUP_SIZE`` rows of one ``whole``, dealt by a hash of ``part``."""
    sizes = rows.groupBy(whole).agg(F.ceil(F.count("*") / GROUP_SIZE).cast("int").alias("_k"))
    return rows.join(sizes, whole).withColumn("g", F.xxhash64(whole, F.pmod(F.xxhash64(part), F.col("_k")))).drop("_k")


def _shared_tokens(docs: DataFrame, common: np.ndarray, buckets: int, width: int, percent: int) -> DataFrame:
    """``token, ka`` of every token that stands in the prefixes of at least two different sets.

    Two sets whose overlap reaches the threshold share a token among the first ``n - ceil(n * percent / 100) + 1`` of
    each, in any one order of all tokens; here common tokens stand last and others go by value. Tokens travel in
    blocks per bucket of their values, not as rows.
    """
    known = docs.sparkSession.sparkContext.broadcast(common)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = known.value, set()
        for batch in in_pieces(batches):
            tokens, owners = [], []
            for s in shingle_sets(texts(batch), width):
                if not len(s):
                    continue
                ka = _keys(s)[0]
                if ka in seen:
                    continue
                seen.add(ka)
                need = len(s) + (-len(s) * percent) // 100 + 1
                if len(last):
                    at = np.searchsorted(last, s)
                    at[at == len(last)] = 0
                    often = last[at] == s
                    if often.any():
                        s = np.concatenate((s[~often], s[often]))
                tokens.append(s[:need])
                owners.append(np.full(min(need, len(s)), ka, np.int64))
            if len(seen) > 500_000:
                seen.clear()
            if not tokens:
                continue
            t, o = np.concatenate(tokens), np.concatenate(owners)
            b = ((mixed(t) >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(b, kind="stable")
            t, o, b = t[order], o[order], b[order]
            edges = np.flatnonzero(np.diff(b, prepend=np.int32(-1)))
            ends = np.append(edges[1:], len(b))
            yield pa.RecordBatch.from_arrays(
                [pa.array(b[edges]), pa.array([t[x:y].tobytes() for x, y in zip(edges, ends)], pa.binary()), pa.array([o[x:y].tobytes() for x, y in zip(edges, ends)], pa.binary())],
                ["bucket", "tokens", "owners"],
            )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, owners = [], []
        for batch in batches:
            tokens += [np.frombuffer(x, np.uint64) for x in batch.column("tokens").to_pylist()]
            owners += [np.frombuffer(x, np.int64) for x in batch.column("owners").to_pylist()]
        if tokens:
            t, o = np.concatenate(tokens), np.concatenate(owners)
            order = np.lexsort((o, t))
            t, o = t[order], o[order]
            new = np.append(True, (t[1:] != t[:-1]) | (o[1:] != o[:-1]))
            t, o = t[new], o[new]
            same = t[1:] == t[:-1]
            keep = np.append(False, same) | np.append(same, False)
            t, o = t[keep].view(np.int64), o[keep]
            for i in range(0, len(t), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(t[i : i + 100_000]), pa.array(o[i : i + 100_000])], ["token", "ka"])

    blocks = docs.select("text").mapInArrow(emit, "bucket int, tokens binary, owners binary")
    return blocks.repartitionById(buckets, "bucket").mapInArrow(meet, "token long, ka long")


def _up(a: str, b: str) -> str:
    return f"(({a} + {b} - 1) div {b})"


def _least_shared(size: str, percent: int) -> str:
    """How many prefix tokens sets of ``n`` and ``size`` tokens share at least if they link.

    Up to the end of the shorter prefix all shared tokens are known; behind it, the set that ends there has
    ceil(percent * tokens / 100) - 1 left.
    """
    overlap = _up(f"{percent} * (n + {size})", str(100 + percent))
    return f"({overlap} - greatest({_up(f'{percent} * n', '100')}, {_up(f'{percent} * {size}', '100')}) + 1)"


def _least_in_group(percent: int):
    """The smallest ``_least_shared`` of all sizes from ``lo`` to ``hi`` that can link with ``n``.

    Up to ``n`` the number never falls with the size. From ``n`` on it falls, but not at each step: d sizes before the
    upper end it is smaller than there by less than 2 - d * percent^2 / (100 * (100 + percent)), so only that many last
    sizes are tried for which this is above 1.
    """
    last = 100 * (100 + percent) // percent**2
    low, high = f"greatest(lo, {_up(f'{percent} * n', '100')})", f"least(hi, (100 * n) div {percent})"
    ends = f"transform(sequence(greatest({low}, {high} - {last}), {high}), m -> {_least_shared('m', percent)})"
    return F.expr(f"least({_least_shared(low, percent)}, array_min({ends}))")


def jaccard_components(docs: DataFrame, percent: int = 75, width: int = 5) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document.

    A document's set is its distinct ``width``-word shingles (see ``shingle_sets``). Two documents link if
    100 * intersection >= percent * union; components follow links of any length. ``component_id`` is the smallest
    doc_id of the component. No link between different texts is lost:

    1. Documents with equal sets are one class; the work goes on with classes.
    2. Classes that share smallest tokens under two of 8 orders with the first class that has them are compared with it. Links found give
       clusters of similar documents, however many copies there are.
    3. Every link left runs between clusters, and its ends share a prefix token; tokens of a single cluster fall away.
       Clusters, and classes that share a frequent smallest token, form groups of at most about 64. For each token the matrix says
       in which groups it stands; a class asks groups with classes of a larger cluster that share enough of its prefix
       tokens for their sizes.
    4. A group is opened if its token union holds enough of the asking set; its members are then checked. Each class first
       asks the groups it shares most with; what these links connect is not asked for again.

    Null and empty texts, and texts of white space, have no set and link with nothing. Repeated rows give a row each.
    A null id stays null, and is nobody's component_id unless no member has an id. No rows give no rows. Other columns
    are ignored.
    """
    return _placed_rows(docs, percent, width).select("doc_id", "n_shingles", "component_id")


def _placed_rows(docs: DataFrame, percent: int, width: int) -> DataFrame:
    """The rows of ``jaccard_components`` with ``h``, a hash of the text, and ``top``, which names the component even where ids repeat."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    profiles = stored(_profiles(docs, width), "profiles")
    classes = stored(
        profiles.filter("n > 0").groupBy("ka", "kb", "n").agg(F.min("doc_id").alias("first_id"), F.first("least").alias("least")), "classes"
    )
    marks = classes.select("ka", "n", F.posexplode("least").alias("i", "key"))
    firsts = marks.groupBy("i", "key").agg(F.min(F.struct("ka", "n")).alias("h"), F.count("*").alias("m")).filter("m > 1")
    near = marks.join(firsts, ["i", "key"]).filter("ka <> h.ka").filter(f"100 * least(n, h.n) >= {percent} * greatest(n, h.n)")
    near = near.groupBy(F.col("h.ka").alias("q"), F.col("ka").alias("s")).count().filter(F.col("count") >= 2).select("q", "s")
    member = stored(_blocks(near, "q", "s"), "members")
    found = _opened(docs, classes, member.select("q", "g", F.col("q").alias("root")).distinct(), member.select("g", "s", F.col("s").alias("root")), width, percent)
    clusters = components(stored(found, "links"))

    # Clusters are groups; a class without links joins the group of its most frequent smallest token, if many have that.
    full = marks.join(firsts.select("i", "key", "m"), ["i", "key"]).groupBy("ka").agg(F.max(F.struct("m", "i", "key")).alias("t"))
    sizes = classes.select("ka", "n").join(clusters.withColumnRenamed("node", "ka"), "ka", "left").join(full, "ka", "left").select(
        "ka", "n", F.coalesce("root", "ka").alias("root"),
        F.coalesce("root", F.when(F.col("t.m") >= GROUP_FROM, F.xxhash64("t.i", "t.key")), "ka").alias("bucket"),
    )
    weights = sizes.groupBy("root").agg(F.count("*").alias("w"))
    placed = stored(_blocks(sizes, "bucket", "ka").join(weights, "root"), "placed")
    total = classes.agg(F.sum(F.expr(f"n - ceil(n * {percent} / 100) + 1"))).first()[0] or 0
    buckets = max(spark.sparkContext.defaultParallelism, -(-int(total) // BUCKET_TOKENS))
    shared = stored(_shared_tokens(docs, _common_tokens(profiles), buckets, width, percent), "shared")
    rows = shared.join(placed, "ka")
    several = rows.groupBy("token").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("token")
    rows = stored(rows.join(several, "token", "left_semi"), "matrix")
    matrix = rows.groupBy("token", "g").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.max(F.struct("w", "root")).alias("top"))
    r, t = rows.alias("r"), matrix.alias("t")
    # Of two clusters the smaller asks, so the copies of a large one do not ask for each of its strays.
    apart = "struct(r.w, r.root) < struct(t.top.w, t.top.root)"
    fits = f"100 * r.n <= {100 * 100} * t.hi / {percent} and 100 * t.lo <= {100 * 100} * r.n / {percent}"
    pairs = r.join(t, F.expr(f"r.token = t.token and {apart} and {fits}"))
    ask = pairs.groupBy(F.col("r.ka").alias("q"), F.col("t.g").alias("g")).agg(
        F.count("*").alias("overlap"), F.first("r.n").alias("n"), F.first("r.root").alias("root"), F.min("t.lo").alias("lo"), F.max("t.hi").alias("hi")
    )
    ask = ask.filter(F.col("overlap") >= _least_in_group(percent))
    best = Window.partitionBy("q").orderBy(F.desc("overlap"), "g")
    ask = stored(ask.select("q", "g", "root", (F.row_number().over(best) <= FIRST_ASKED).alias("early")), "ask")
    roots = placed.select("ka", "root")

    def bridged(asking: DataFrame) -> DataFrame:
        """Pairs of roots that the groups asked connect."""
        asked = placed.join(asking.select("g").distinct(), "g", "left_semi").select("g", F.col("ka").alias("s"), "root")
        links = _opened(docs, classes, asking.select("q", "g", "root"), asked, width, percent)
        ends = links.join(roots.withColumnRenamed("ka", "a").withColumnRenamed("root", "x"), "a").join(
            roots.withColumnRenamed("ka", "b").withColumnRenamed("root", "y"), "b"
        )
        return stored(ends.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "bridges")

    # A class asks its likeliest groups first; groups that are then in its own component need not be asked.
    bridges = bridged(ask.filter("early"))
    joined = components(bridges)
    tops = roots.select("root").distinct().join(joined.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
    tops = stored(tops.select("root", F.coalesce("top", "root").alias("top")), "tops")
    whole = placed.join(tops, "root").groupBy("g").agg(F.min("top").alias("x"), F.max("top").alias("y"))
    rest = ask.filter("not early").join(whole, "g").join(tops, "root").filter("x <> top or y <> top")
    rest = stored(rest.select("q", "g", "root"), "ask")
    if not rest.isEmpty():
        joined = components(bridges.unionByName(bridged(rest)))
    final = roots.join(joined.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
    final = final.select("ka", F.coalesce("top", "root").alias("top")).join(classes.select("ka", "kb", "first_id"), "ka")
    names = final.groupBy("top").agg(F.min("first_id").alias("component_id"))
    named = stored(final.join(names, "top").select("ka", "kb", "top", "component_id"), "named")
    return profiles.drop("least", "tokens").join(named, ["ka", "kb"], "left").select(
        "doc_id", "h", "top", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def one_per_component(docs: DataFrame, percent: int = 75, width: int = 5) -> DataFrame:
    """The document that names its component, all columns kept.

    Rows are told apart by id and text: of equal ones one stays, and where different texts of a component share the id
    that names it, the one with the smallest hash stays. Texts that nothing links stay whatever their ids. Rows without
    an id all stay.
    """
    naming = _placed_rows(docs, percent, width).filter("doc_id = component_id")
    named = naming.filter("top is not null").groupBy("top").agg(F.min(F.struct("doc_id", "h")).alias("r")).select("r.*")
    kept = stored(named.unionByName(naming.filter("top is null").select("doc_id", "h").distinct()), "kept")
    # The caller's columns travel in one struct, so that none of them meets a name used here.
    rows = docs.select(F.struct(*docs.columns).alias("row")).withColumns({"doc_id": F.col("row.doc_id"), "h": F.xxhash64("row.text")})
    rows = rows.join(kept, ["doc_id", "h"], "left_semi").dropDuplicates(["doc_id", "h"])
    return rows.select("row.*").unionByName(docs.filter("doc_id is null"))
