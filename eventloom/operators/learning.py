"""User-segment classifier on Spark ML: features, stratified split, forest, evaluation, run record."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IndexToString, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventloom.functions.columns import days_since, finite_or
from eventloom.operators.features import activity_score
from eventloom.operators.stats import order_statistics

# Model inputs, forest size, test share, folds and seed.
FEATURES = (
    "total_events", "days_since_first_seen", "days_since_last_seen", "events_per_day", "recency_score", "activity_score",
)
TREES = 100
MAX_DEPTH = 10
MIN_LEAF = 2
TEST_SHARE = 0.2
FOLDS = 5
SEED = 42


def training_frame(dim_users: DataFrame, as_of: Column) -> DataFrame:
    """Model inputs per user, finite by construction; the segment is the label."""
    known = dim_users.filter(F.col("user_segment").isNotNull() & (F.col("total_events") > 0))
    days = known.select(
        "user_id", "user_segment", "total_events",
        days_since("first_seen_at", as_of).alias("days_since_first_seen"),
        days_since("last_seen_at", as_of).alias("days_since_last_seen"),
    )
    made = days.withColumns(
        {
            "events_per_day": F.col("total_events") / (F.col("days_since_first_seen") + 1),
            "recency_score": F.lit(1.0) / (F.col("days_since_last_seen") + 1),
            "activity_score": activity_score(F.col("total_events"), F.col("days_since_last_seen")),
        }
    )
    return made.select("user_id", "user_segment", *[finite_or(c, 0.0, 999.0, -999.0).alias(c) for c in FEATURES])


def stratified_split(df: DataFrame, label: str = "user_segment", key: str = "user_id", test: float = TEST_SHARE, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Train and test frames with the same label shares, the same rows on every run.

    Rows are ordered by a seeded hash of their key within each label, and the first part of each
    label is the test set. The cut is found as an exact order statistic, so a label holding most
    rows is never sorted in one task; the hash is even, and so are its bins. Labels must be known.

    The cuts, one row per label, are joined lazily; cache the frames if training reads them often.
    """
    hashed = df.withColumn("_h", F.shiftright(F.xxhash64(F.col(key), F.lit(seed)), 11))
    cut = order_statistics(hashed, [label], "_h", {"_cut": F.floor(F.col("n") * test).cast("long")})
    both = hashed.join(cut, label)
    return both.filter("_h >= _cut").select(*df.columns), both.filter("_h < _cut").select(*df.columns)


def _stages(trees: int) -> list:
    return [
        StringIndexer(inputCol="user_segment", outputCol="label", stringOrderType="alphabetAsc", handleInvalid="keep"),
        VectorAssembler(inputCols=list(FEATURES), outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True),
        RandomForestClassifier(numTrees=trees, maxDepth=MAX_DEPTH, minInstancesPerNode=MIN_LEAF, seed=SEED),
    ]


@dataclass(frozen=True)
class SegmentModel:
    pipeline: PipelineModel

    @property
    def labels(self) -> list[str]:
        return list(self.pipeline.stages[0].labels)

    def predict(self, df: DataFrame) -> DataFrame:
        """Input columns plus ``predicted`` (segment name), ``prediction``, ``label``, ``probability``."""
        scored = self.pipeline.transform(df)
        return IndexToString(inputCol="prediction", outputCol="predicted", labels=[*self.labels, "__unknown"]).transform(scored)

    def importance(self, spark: SparkSession) -> DataFrame:
        """Feature importances, largest first; as many rows as there are features."""
        weights = self.pipeline.stages[-1].featureImportances.toArray()
        rows = [(f, float(w)) for f, w in zip(FEATURES, weights)]
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def fit_segment_model(df: DataFrame, trees: int = TREES) -> SegmentModel:
    return SegmentModel(Pipeline(stages=_stages(trees)).fit(df))


def evaluate(predicted: DataFrame) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1, from the confusion counts."""
    weighted = lambda c: F.sum(F.col(c) * F.col("support")) / F.sum("support")
    return class_report(predicted).agg(
        (F.sum("correct") / F.sum("support")).alias("accuracy"),
        weighted("precision").alias("precision_weighted"),
        weighted("recall").alias("recall_weighted"),
        weighted("f1").alias("f1_weighted"),
        F.sum("support").alias("rows"),
    )


def class_report(predicted: DataFrame, label: str = "user_segment", guess: str = "predicted") -> DataFrame:
    """Precision, recall, F1 and support per class; an undefined ratio is 0.

    Rows collapse to (label, guess) counts at once; everything after works on those few rows.
    """
    cells = predicted.groupBy(F.col(label).alias("y"), F.col(guess).alias("p")).agg(F.count("*").alias("n"))
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(F.col("y").alias("segment"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("guessed"), F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
                F.struct(F.col("p").alias("segment"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("guessed"), F.lit(0).cast("long").alias("hit")),
            )
        )
    )
    counts = sides.groupBy("segment").agg(F.sum("actual").alias("support"), F.sum("guessed").alias("guessed"), F.sum("hit").alias("correct"))
    ratio = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    scored = counts.withColumn("precision", ratio(F.col("correct"), F.col("guessed"))).withColumn("recall", ratio(F.col("correct"), F.col("support")))
    both = F.col("precision") + F.col("recall")
    f1 = F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(F.lit(0.0))
    return scored.withColumn("f1", f1).select("segment", "precision", "recall", "f1", "support", "correct").orderBy("segment")


def cross_validate(df: DataFrame, folds: int = FOLDS, trees: int = TREES, parallelism: int = FOLDS) -> tuple[float, float]:
    """Mean and deviation of weighted F1 over the folds."""
    prepared = Pipeline(stages=_stages(trees)[:-1]).fit(df).transform(df).select("features", "label")
    validator = CrossValidator(
        estimator=_stages(trees)[-1],
        estimatorParamMaps=ParamGridBuilder().build(),
        evaluator=MulticlassClassificationEvaluator(metricName="f1"),
        numFolds=folds, seed=SEED, parallelism=parallelism,
    )
    fitted = validator.fit(prepared)
    return fitted.avgMetrics[0], fitted.stdMetrics[0]


def record_run(spark: SparkSession, base: str, run: str, params: Mapping[str, object], metrics: Mapping[str, float], model: SegmentModel) -> None:
    """Append parameters, metrics and importances to the runs table and save the model."""
    rows = [(run, "param", k, str(v)) for k, v in params.items()]
    rows += [(run, "metric", k, repr(float(v))) for k, v in metrics.items()]
    weights = model.pipeline.stages[-1].featureImportances.toArray()
    rows += [(run, "importance", f, repr(float(w))) for f, w in zip(FEATURES, weights)]
    table = spark.createDataFrame(rows, "run string, kind string, name string, value string")
    table.coalesce(1).write.mode("append").parquet(f"{base}/runs")
    model.pipeline.write().overwrite().save(f"{base}/models/{run}")
