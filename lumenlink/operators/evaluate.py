"""Labels, blocking recall, precision-recall curve and the threshold that maximises F0.5."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def label_pairs(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """Add is_match: 1 if (source1_entity_id, candidate_entity_id) is a true pair (source1_entity_id, entity_id)."""
    known = truth.select("source1_entity_id", F.col("entity_id").alias("candidate_entity_id"), F.lit(1).alias("_hit")).distinct()
    return pairs.join(known, ["source1_entity_id", "candidate_entity_id"], "left").withColumn("is_match", F.coalesce("_hit", F.lit(0))).drop("_hit")


def blocking_stats(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """queries, candidates, per_query (null without queries)."""
    n = queries.agg(F.count("*").alias("queries"))
    c = candidates.agg(F.count("*").alias("candidates"))
    return n.crossJoin(c).withColumn("per_query", F.try_divide(F.col("candidates").cast("double"), F.col("queries")))  # one row each


def blocking_recall(candidates: DataFrame, truth: DataFrame, queries: DataFrame) -> DataFrame:
    """true_pairs, recalled, recall over the queries that have true pairs; distinct pairs count."""
    t = truth.select("source1_entity_id", "entity_id").distinct().join(queries.select(F.col("id").alias("source1_entity_id")).distinct(), "source1_entity_id", "left_semi")
    c = candidates.select(F.col("query_id").alias("source1_entity_id"), F.col("target_id").alias("entity_id"), F.lit(1).alias("_hit")).distinct()
    hit = t.join(c, ["source1_entity_id", "entity_id"], "left").agg(F.count("*").alias("true_pairs"), F.count("_hit").alias("recalled"))
    return hit.withColumn("recall", F.try_divide(F.col("recalled").cast("double"), F.col("true_pairs")))


def class_weights(labelled: DataFrame, label: str = "is_match") -> DataFrame:
    """positives, negatives, weight of a positive: negatives per positive."""
    counts = labelled.agg(F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) == 0).alias("negatives"))
    return counts.withColumn("weight", F.col("negatives").cast("double") / F.greatest("positives", F.lit(1)))


def f_beta(p: Column, r: Column, beta: float = 0.5) -> Column:
    b = beta * beta
    below = F.lit(b) * p + r
    return F.when(below > 0, F.lit(1 + b) * p * r / below).otherwise(0.0)


def pr_curve(scored: DataFrame, score: str = "score", label: str = "is_match", n: str | None = None) -> DataFrame:
    """threshold, precision, recall, f05 for each distinct score (precision and recall of score >= threshold).

    Cumulative counts run over distinct scores in two steps, so that no task
    gets them all: a total per range of scores, then running sums in it. Scores
    outside 0 to 1 share the ranges at the ends. ``n`` names the number of
    pairs that a row stands for (one without it).
    """
    pairs = (F.col(n) if n else F.lit(1)).cast("long")
    at = scored.groupBy(F.col(score).alias("threshold")).agg(F.sum(pairs).alias("n"), F.sum(F.col(label).cast("long") * pairs).alias("pos"))
    bucket = F.floor(F.least(F.greatest(F.col("threshold"), F.lit(0.0)), F.lit(1.0)) * 1024)
    at = at.withColumn("_b", bucket)
    whole = Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    # one row per bucket: 1025 at most
    sums = at.groupBy("_b").agg(F.sum("n").alias("bn"), F.sum("pos").alias("bp"))
    before = sums.select("_b", F.coalesce(F.sum("bn").over(whole), F.lit(0)).alias("n0"), F.coalesce(F.sum("bp").over(whole), F.lit(0)).alias("p0"), F.sum("bp").over(Window.partitionBy()).alias("all_pos"))
    inside = Window.partitionBy("_b").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    cum = at.join(before, "_b").select("threshold", (F.col("n0") + F.sum("n").over(inside)).alias("m"), (F.col("p0") + F.sum("pos").over(inside)).alias("tp"), "all_pos")
    p, r = F.col("tp").cast("double") / F.col("m"), F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("all_pos")), F.lit(0.0))
    return cum.select("threshold", p.alias("precision"), r.alias("recall"), f_beta(p, r).alias("f05"))


def best_threshold(curve: DataFrame) -> DataFrame:
    """The row with the greatest f05; of equal ones the lowest threshold. f05 is rounded to 12 digits for the comparison."""
    return curve.withColumn("_f", F.round("f05", 12)).orderBy(F.desc("_f"), "threshold").limit(1).drop("_f")
