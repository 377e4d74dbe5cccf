"""One query per operator over its whole table, and the DuckDB SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from eventloom.llm import collisions, fingerprints, jaccard, licenses, manifest, mixing, packing, quality, suffixes, token_counts, token_files, toxicity, variants
from eventloom.llm.common import held_out, read_table
from eventloom.session import scratch_path


def op1_collision_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every 50th vector."""
    return collisions.nearest(read_table(spark, sf_dir, "embeddings"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each document."""
    docs = read_table(spark, sf_dir, "documents")
    scored = toxicity.score_documents(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
        F.size("offending").alias("n_offending"), F.get("offending", F.lit(0))["start"].alias("first_offending"),
    )


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    return mixing.mix(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "finish"
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document."""
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses of each document."""
    found = licenses.scan(read_table(spark, sf_dir, "documents"))
    labels = lambda *lists: F.array_join(F.array_sort(F.array_distinct(F.concat(*lists))), ",")
    base, more = F.col("places")["label"], F.col("matches")["label"]
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(F.col("places")["start"]).alias("first_word"), F.array_max(F.col("places")["start"]).alias("last_word"),
        labels(base).alias("base_labels"), labels(base, more).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.col("matches")["containment"]), F.lit(0.0))).alias("score"),
        F.size("matches").alias("n_blocks"),
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of each document."""
    scored = quality.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= quality.AT_THRESHOLD).cast("int").alias("predicted"), "strength"
    )


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of each document's ids, read back from the coded files."""
    path = scratch_path(spark, "token-files")
    token_files.write_ids(read_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_digests(spark, path)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of each document."""
    return jaccard.jaccard_components(read_table(spark, sf_dir, "documents"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of each document and its edited version, and their likeness."""
    return fingerprints.compare_with_next(read_table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2,048 tokens."""
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, some misspelt on purpose, with their near words and forms."""
    return variants.spelling_groups(variants.word_counts(read_table(spark, sf_dir, "documents"), 7, variants.drop_letter))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each document that an earlier one has as well, and a digest of the others."""
    cut = suffixes.without_repeats(read_table(spark, sf_dir, "documents"))
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return cut.select(
        "doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of each document against the manifest's root; every fifth document has been tampered with."""
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, manifest.leaf({"text": lowered}))
    rows = manifest.proofs(read_table(spark, sf_dir, "documents"), {"tampered": tampered})
    siblings = F.array_join(F.transform("proof", lambda level: F.concat(level["left"], level["right"])), "")
    folded = manifest.fold(F.coalesce("tampered", "leaf"), F.col("proof"))
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )


# crc32 in SQL: the table of one byte, and the checksum of a string of ASCII and U+0080 to U+00FF.
_CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def _crc(text: str) -> str:
    octets = f"""flatten(list_transform(string_split({text}, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)]
        ELSE [CAST(192 + (unicode(x) >> 6) AS BIGINT), CAST(128 + (unicode(x) & 63) AS BIGINT)] END))"""
    return f"xor(list_reduce(list_concat([4294967295], {octets}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


def _merkle_sql(levels: int = 8) -> str:
    """The manifest level by level: room for 16^8 rows a source and as many sources."""
    field = lambda c: f"coalesce(strlen({c}) || ':' || {c}, '-')"
    leaf = lambda text: "sha256(" + " || ".join(field(c) for c in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)) + ")"
    steps = []
    for t in ("d", "s"):
        for k in range(levels):
            steps += [
                f"""{t}p{k} AS (SELECT g, r, n > 1 AS up,
                    coalesce(string_agg(h, '') OVER (PARTITION BY g, r // 16 ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                    coalesce(string_agg(h, '') OVER (PARTITION BY g, r // 16 ORDER BY r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS e
                    FROM {t}{k})""",
                f"""{t}{k + 1} AS (SELECT g, r // 16 AS r, (n + 15) // 16 AS n, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY r)) ELSE min(h) END AS h
                    FROM {t}{k} GROUP BY g, r // 16, n)""",
            ]
        if t == "d":
            steps += [f"s0 AS (SELECT 0 AS g, g AS member, h, row_number() OVER (ORDER BY g) - 1 AS r, count(*) OVER () AS n FROM d{levels})"]
    chain = "SELECT d0.doc_id, d0.h AS leaf, g, r, m.sr, coalesce(tampered, d0.h) AS f, '' AS p FROM d0 JOIN (SELECT member, r AS sr FROM s0) m ON m.member = d0.g"
    for t, g, r in (("d", "g", "r"), ("s", "0", "sr")):
        for k in range(levels):
            chain = f"""SELECT c.* REPLACE (CASE WHEN up THEN sha256(l || f || e) ELSE f END AS f, CASE WHEN up THEN p || l || e ELSE p END AS p)
                FROM ({chain}) c JOIN {t}p{k} x ON x.g = c.{g} AND x.r = c.{r} // {16**k}""".replace("c.0", "0")
    return f"""
        WITH {_CRC_TABLE},
        leaves AS (
            SELECT doc_id, coalesce('=' || source, '') AS g, {leaf("text")} AS h,
                   CASE WHEN {_crc("CAST(doc_id AS VARCHAR)")} % 5 = 0
                        THEN {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered
            FROM documents, crc),
        d0 AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS r, count(*) OVER (PARTITION BY g) AS n FROM leaves),
        {", ".join(steps)}
        SELECT c.doc_id, c.leaf, top.h AS subroot, root.h AS root, sha256(p) AS proof_sha256, f AS folded_root, f = root.h AS verified
        FROM ({chain}) c JOIN d{levels} top ON top.g = c.g, s{levels} root"""


QUERIES = {
    "op1_collision_search": op1_collision_search,
    "op2_toxicity": op2_toxicity,
    "op3_source_mix": op3_source_mix,
    "op4_token_counts": op4_token_counts,
    "op5_license_scan": op5_license_scan,
    "op6_quality": op6_quality,
    "op7_token_files": op7_token_files,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_fingerprints": op9_fingerprints,
    "op10_packing": op10_packing,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLES = {
    "op11_spelling_variants": f"""
        WITH RECURSIVE {_CRC_TABLE},
        runs AS (
            SELECT doc_id, w, count(*) AS n
            FROM (SELECT doc_id, unnest(regexp_extract_all(
                      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS w FROM documents)
            WHERE length(w) >= 7 GROUP BY ALL),
        hashed AS (SELECT w, n, {_crc("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w")} AS h FROM runs, crc),
        words AS (
            SELECT word, CAST(sum(n) AS BIGINT) AS n
            FROM (SELECT CASE WHEN h % 31 = 0 THEN left(w, h % length(w)) || substring(w, h % length(w) + 2) ELSE w END AS word, n FROM hashed)
            WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
        cuts AS (SELECT DISTINCT word, n, i, left(word, i - 1) || substring(word, i + 1) AS rest FROM words, unnest(range(1, length(word) + 1)) u(i)),
        near AS (
            SELECT a.word, b.word AS other, b.n AS m FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
            UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
        best AS (SELECT word, count(*) AS n_near, max(m) AS m FROM near GROUP BY word),
        forms AS (
            SELECT w.word, min(other) AS form, b.m AS form_n
            FROM words w JOIN best b USING (word) JOIN near o ON o.word = w.word AND o.m = b.m WHERE b.m >= 10 * w.n GROUP BY ALL),
        chain AS (
            SELECT word, word AS root FROM words
            UNION ALL
            SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root)
        SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, form, form_n, root
        FROM words w LEFT JOIN best USING (word) LEFT JOIN forms USING (word)
        JOIN (SELECT word, root FROM chain c WHERE NOT EXISTS (SELECT 1 FROM forms f WHERE f.word = c.root)) r USING (word)""",
    "op13_merkle_manifest": _merkle_sql(),
    "op3_source_mix": """
        WITH d AS (
            SELECT doc_id, source, coalesce('=' || source, '~') AS s, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
                   len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size
            FROM documents),
        sources AS (SELECT s, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY s),
        weighed AS (
            SELECT *, CASE (row_number() OVER (ORDER BY s) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM sources),
        capped AS (SELECT *, 2 * source_size AS cap, 2 * source_size / w AS top FROM weighed),
        ordered AS (
            SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
                       - coalesce(sum(cap) OVER (ORDER BY top, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                   / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY top, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lv
            FROM capped),
        level AS (SELECT lv FROM ordered WHERE lv <= top ORDER BY top, s LIMIT 1),
        goal AS (SELECT s, source_size, least(cap::DOUBLE, lv * w) AS target FROM capped, level),
        run AS (
            SELECT *, CAST(sum(size) OVER (PARTITION BY s ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS ends
            FROM d JOIN goal USING (s))
        SELECT doc_id, size, source_size, target, source, CASE WHEN target > 0 THEN ends / target END AS finish,
               greatest(0, least(size, CAST(floor(target) AS BIGINT) - ends + size))
               + greatest(0, least(size, CAST(floor(target) AS BIGINT) - source_size - ends + size)) AS taken
        FROM run""",
    "op8_jaccard_join": """
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
        one AS (
            SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS s
            FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM one GROUP BY doc_id),
        links AS (
            SELECT p.a, p.b FROM (
                SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM one x JOIN one y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
            JOIN sizes sa ON sa.doc_id = p.a JOIN sizes sb ON sb.doc_id = p.b WHERE 100 * k >= 75 * (sa.n + sb.n - k)),
        reach AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION
            SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
        SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, c AS component_id
        FROM w LEFT JOIN sizes USING (doc_id) JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) m ON m.a = w.doc_id""",
}
