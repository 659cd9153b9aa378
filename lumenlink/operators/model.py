"""Boosted trees on pair features: grouped split, class weights, training, scores, storage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenlink import schema
from lumenlink.operators import evaluate, order


@dataclass
class Model:
    """A fitted pipeline, the threshold tuned for it and its features in order."""

    pipeline: PipelineModel
    threshold: float
    features: tuple[str, ...] = schema.FEATURE_COLUMNS

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(self.threshold, list(self.features))], "threshold double, feature_cols array<string>").coalesce(1).write.mode("overwrite").json(f"{path}/metadata")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Model:
        meta = spark.read.schema("threshold double, feature_cols array<string>").json(f"{path}/metadata").first()
        return Model(PipelineModel.load(f"{path}/pipeline"), meta["threshold"], tuple(meta["feature_cols"]))


def with_side(pairs: DataFrame, group: str = "source1_entity_id", test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Add side ("train" or "test"): exactly the share of groups, rounded up, is on the test side, chosen by a seeded hash."""
    groups = pairs.select(group).distinct()
    hashed = order.shuffled(F.col(group).cast("string"), seed)
    wanted = groups.agg(F.ceil(F.count("*") * F.lit(test_share) - F.lit(1e-9)).cast("long")).scalar()
    test = order.first_n(groups, wanted, order.hash_levels(hashed), [hashed]).withColumn("side", F.lit("test"))
    return pairs.join(test, group, "left").withColumn("side", F.coalesce("side", F.lit("train")))


def group_split(pairs: DataFrame, group: str = "source1_entity_id", test_share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test): whole groups; see ``with_side``. ``pairs`` has no column side."""
    sided = with_side(pairs, group, test_share, seed)
    return tuple(sided.where(F.col("side") == x).select(*pairs.columns) for x in ("train", "test"))


def split_stats(sided: DataFrame, label: str = "is_match") -> DataFrame:
    """side, pairs, positives, positive_share of each side of a split."""
    counts = sided.groupBy("side").agg(F.count("*").alias("pairs"), F.count_if(F.col(label) == 1).alias("positives"))
    return counts.withColumn("positive_share", F.col("positives").cast("double") / F.col("pairs"))


EARLY_STOP_ROWS = 10_000  # with more training rows a tenth of them tells when to stop
CELL_ROWS = 50_000  # a task's, at least: each tree takes some ten jobs


def cells(pairs: DataFrame, features: tuple[str, ...] = schema.FEATURE_COLUMNS, label: str = "is_match") -> DataFrame:
    """features, label, n: how many pairs are alike in these. Weighed by n they make the same trees as the pairs."""
    return pairs.groupBy(*features, label).agg(F.count("*").alias("n"))


def fit(train: DataFrame, features: tuple[str, ...] = schema.FEATURE_COLUMNS, iterations: int = 200, seed: int = 42) -> PipelineModel:
    """Depth 5, rate 0.05, 255 bins; positives weigh as much as negatives together.

    With more than EARLY_STOP_ROWS rows, a tenth of them by hash is held out
    and boosting ends where its loss does not fall any more; ``iterations``
    is the most there can be. All pairs count, those alike in features and
    label as one row with their number as weight.
    """
    alike = cells(train, features).persist()
    try:
        return _boost(alike, features, iterations, seed)
    finally:
        alike.unpersist()


def _boost(alike: DataFrame, features: tuple[str, ...], iterations: int, seed: int) -> PipelineModel:
    known = alike.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.when(F.col("is_match") == 1, F.col("n"))), F.lit(0)).alias("positives"), F.count("*").alias("cells")).first()
    weight, rows = (known["rows"] - known["positives"]) / max(known["positives"], 1) or 1.0, known["rows"]
    weighted = alike.coalesce(-(-known["cells"] // CELL_ROWS) or 1)
    weighted = weighted.withColumn("weight", F.col("n") * F.when(F.col("is_match") == 1, weight).otherwise(1.0)).withColumn("label", F.col("is_match").cast("double"))
    trees = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=iterations, maxDepth=5, stepSize=0.05, maxBins=255, seed=seed, maxMemoryInMB=1024)
    if rows > EARLY_STOP_ROWS:
        weighted = weighted.withColumn("held_out", F.pmod(F.xxhash64(*features, F.lit(seed)), F.lit(10)) == 0)
        trees = trees.setValidationIndicatorCol("held_out")
        trees._set(validationTol=1e-4)
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), trees]).fit(weighted)


def score(pipeline: PipelineModel, pairs: DataFrame) -> DataFrame:
    """Add score: the probability of a match."""
    out = pipeline.transform(pairs).withColumn("score", vector_to_array("probability")[1])
    return out.select(*pairs.columns, "score")


def train(labelled: DataFrame, iterations: int = 200) -> Model:
    """Fit on the training groups, tune the threshold on the others (0.5 if they hold nothing)."""
    fit_on, tune_on = group_split(labelled)
    pipeline = fit(fit_on, iterations=iterations)
    best = evaluate.best_threshold(evaluate.pr_curve(score(pipeline, cells(tune_on)), n="n")).first()
    return Model(pipeline, float(best["threshold"]) if best else 0.5)
