"""Knowledge base, retrieval with metadata, prompts and retrieval quality."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from eventloom.functions.text import event_chunks
from eventloom.operators.embed import VECTOR_DIM, Encoder, LexicalModel, apply_encoder, apply_lexical, fit_lexical
from eventloom.operators.search import topk_exact, with_fields, write_vectors
from eventloom.session import scratch_path

# System instruction and section headings of the prompt.
SYSTEM_PROMPT = (
    "You are a data analytics assistant. "
    "Use the retrieved user event data below to answer the user's question. "
    "If the data does not contain enough information, say so clearly. "
    "Provide specific user IDs, event types, and patterns where possible."
)
CONTEXT_HEADING = "## Context (retrieved from data platform)"
QUESTION_HEADING = "## User Question"
ANSWER_HEADING = "## Answer"

# Columns kept per knowledge-base entry, with the default of a missing entry.
HIT_DEFAULTS = {"event_type": "?", "user_id": "?", "product_id": "", "chunk": ""}
METADATA_COLUMNS = ("event_id", "user_id", "event_type", "product_id", "page", "referrer", "device", "browser")


def kb_rows(ev: DataFrame) -> DataFrame:
    """One row per chunk of each event: id, metadata and chunk. An event that occurs twice counts once.

    The id is 60 bits of the md5 of ``event_id`` and the chunk's number: the same on every run, in any engine, and computed
    without ordering rows.
    """
    chunks = event_chunks(ev.dropDuplicates(["event_id"]))
    category = F.col("product_category") if "product_category" in ev.columns else F.lit(None).cast("string")
    text = [F.coalesce(F.col(c), F.lit("?" if c in ("user_id", "event_type") else "")).alias(c) for c in METADATA_COLUMNS]
    return chunks.select(
        F.conv(F.substring(F.md5(F.concat_ws("#", "event_id", "chunk_no")), 1, 15), 16, 10).cast("long").alias("id"), *text,
        F.coalesce(category, F.lit("")).alias("product_category"),
        F.coalesce("duration_ms", F.lit(0)).alias("duration_ms"), "chunk",
    )


@dataclass(frozen=True)
class KnowledgeBase:
    """Stored entries with their vectors, and what turns a question into a vector of the same kind."""

    entries: DataFrame
    model: LexicalModel | None = None
    encoder: Encoder | None = None
    dim: int = VECTOR_DIM

    def vectors(self, questions: DataFrame, col: str = "question") -> DataFrame:
        if self.encoder is not None:
            return apply_encoder(questions, col, self.encoder, self.dim)
        return apply_lexical(questions, col, self.model)

    def ask(self, questions: DataFrame, k: int = 5, where: Column | None = None) -> DataFrame:
        """Hits with metadata for text questions (query_id, question)."""
        return retrieve(self.entries, self.vectors(questions), k, where)


def build_knowledge_base(ev: DataFrame, path: str, encoder: Encoder | None = None, dim: int = VECTOR_DIM) -> KnowledgeBase:
    """Write entries and, without an encoder, the lexical model that questions will need."""
    # Chunks are made once: without an encoder they are read twice, for the model and for the vectors. They are dealt out
    # before they get vectors, which are many times their size.
    kb_rows(ev).write.mode("overwrite").parquet(f"{path}/chunks")
    rows = ev.sparkSession.read.parquet(f"{path}/chunks").hint("rebalance")
    if encoder is not None:
        entries = apply_encoder(rows, "chunk", encoder, dim)
    else:
        model = fit_lexical(rows, "chunk", dim)
        model.save(ev.sparkSession, f"{path}/model")
        entries = apply_lexical(rows, "chunk", model)
    write_vectors(entries, f"{path}/entries")
    return open_knowledge_base(ev.sparkSession, path, encoder, dim)


def open_knowledge_base(spark: SparkSession, path: str, encoder: Encoder | None = None, dim: int = VECTOR_DIM) -> KnowledgeBase:
    model = None if encoder is not None else LexicalModel.load(spark, f"{path}/model")
    return KnowledgeBase(spark.read.parquet(f"{path}/entries"), model, encoder, dim)


def search_rows(
    corpus: DataFrame, queries: DataFrame, fields: dict[str, str | int], k: int = 10, where: Column | None = None
) -> DataFrame:
    """Search any vector table (events, products) and return the named fields of each hit.

    The hits are written first: their size is then known where they are joined, and few of them do not shuffle the corpus.
    """
    path = scratch_path(corpus.sparkSession, "hits")
    topk_exact(corpus, queries, k, where).write.parquet(path)
    hits = corpus.sparkSession.read.parquet(path)
    return with_fields(hits, corpus, fields).withColumn("score", F.round("score", 4))


def retrieve(corpus: DataFrame, queries: DataFrame, k: int = 5, where: Column | None = None) -> DataFrame:
    """``k`` best knowledge-base entries per query; scores are rounded to 4 digits."""
    return search_rows(corpus, queries, HIT_DEFAULTS, k, where)


def build_prompts(hits: DataFrame, questions: DataFrame, system: str | None = None) -> DataFrame:
    """One prompt per question: instruction, numbered context, question.

    A question brings at most k hits, so the gathered list is short by construction.
    """
    entry = F.concat(
        F.col("rank").cast("string"), F.lit(". [Event: "), "event_type", F.lit(" | User: "), "user_id",
        F.lit(" | Product: "), F.when(F.col("product_id") != "", F.col("product_id")).otherwise(F.lit("N/A")),
        F.lit("]\n   "), "chunk",
    )
    context = (
        hits.select("query_id", F.struct("rank", entry.alias("entry")).alias("e"))
        .groupBy("query_id")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list("e")), lambda e: e["entry"]), "\n").alias("context"))
    )
    # With no hits and the text trimmed, only the headings and the question remain.
    body = F.concat_ws(
        "\n",
        F.lit(system if system is not None else SYSTEM_PROMPT), F.lit(""), F.lit(CONTEXT_HEADING),
        F.coalesce("context", F.lit("")), F.lit(""), F.lit(QUESTION_HEADING), F.col("question"), F.lit(""), F.lit(ANSWER_HEADING),
    )
    return questions.join(context, "query_id", "left").select("query_id", F.trim(body).alias("prompt"))


def hit_rate(hits: DataFrame, expected: DataFrame, k: int = 10) -> DataFrame:
    """Share of questions whose expected event type is among the first ``k`` hits."""
    within = hits.filter(F.col("rank") <= k).select("query_id", "event_type")
    judged = (
        expected.select("query_id", "expected_type").join(within, "query_id", "left")
        .groupBy("query_id").agg(F.coalesce(F.max(F.col("event_type") == F.col("expected_type")), F.lit(False)).alias("hit"))
    )
    return judged.agg(
        F.count("*").alias("queries"), F.count_if("hit").alias("hits"),
        (F.count_if("hit") / F.count("*")).alias("hit_rate"),
    )


def first_types(hits: DataFrame) -> DataFrame:
    """Event type of the best hit per question."""
    return hits.filter(F.col("rank") == 1).select("query_id", F.col("event_type").alias("top1_type"), "score")


def query_intent(hits: DataFrame, table: str = "raw.user_events", matches: int = 5) -> DataFrame:
    """What a question is about: type distribution, distinct users and products, the ``matches`` best hits, SQL.

    Hits are at most k per question, so what is gathered per question is short. The most frequent type wins; ties go to the type first met.
    """
    same_type = Window.partitionBy("query_id", "event_type")
    counted = hits.select(
        "query_id", "user_id", "product_id", "rank",
        F.struct(
            (-F.count("*").over(same_type)).alias("neg"), F.min("rank").over(same_type).alias("first_rank"),
            "event_type", F.count("*").over(same_type).alias("n"),
        ).alias("type"),
        F.when(
            F.col("rank") <= matches,
            F.struct("rank", F.round("score", 4).alias("score"), "event_type", F.col("chunk").alias("text")),
        ).alias("match"),
    )
    gathered = counted.groupBy("query_id").agg(
        F.array_sort(F.collect_set("type")).alias("t"),
        F.size(F.collect_set("user_id")).cast("long").alias("distinct_users"),
        F.size(F.collect_set("product_id")).cast("long").alias("distinct_products"),
        F.array_sort(F.collect_list("match")).alias("top_matches"),
    )
    top_type = F.col("t")[0]["event_type"]
    sql = F.format_string(f"SELECT * FROM {table} WHERE event_type = '%s' ORDER BY event_ts DESC LIMIT 100;", top_type)
    return gathered.select(
        "query_id",
        top_type.alias("interpreted_intent"),
        F.map_from_entries(F.transform("t", lambda e: F.struct(e["event_type"], e["n"]))).alias("event_type_distribution"),
        "distinct_users", "distinct_products", sql.alias("suggested_sql"), "top_matches",
    )
