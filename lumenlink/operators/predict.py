"""From scores to one list of matches per query record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenlink.functions import text
from lumenlink.sources import tables


def apply_threshold(scored: DataFrame, threshold: float, score: str = "score") -> DataFrame:
    """The pairs whose score is ``threshold`` or more."""
    return scored.where(F.col(score) >= threshold)


def match_lists(queries: DataFrame, matches: DataFrame, placed: bool = False) -> DataFrame:
    """source1_entity_id, matched_entity_ids (ascending, repetitions kept) for every query row; empty without matches.

    ``placed`` keeps the query rows' place, by which ``write_delimited`` puts
    the lists in the order of the queries' file.
    """
    lists = matches.groupBy("source1_entity_id").agg(text.join_ids(F.sort_array(F.collect_list("candidate_entity_id"))).alias("_ids"))
    place = [tables.PLACE] if placed else []
    out = queries.select(F.col("entity_id").alias("source1_entity_id"), *place).join(lists, "source1_entity_id", "left")
    return out.select("source1_entity_id", F.coalesce("_ids", F.lit("")).alias("matched_entity_ids"), *place)


def singletons(queries: DataFrame, matches: DataFrame) -> DataFrame:
    """The query records without a match."""
    return queries.select(F.col("entity_id").alias("source1_entity_id")).join(matches, "source1_entity_id", "left_anti")


def match_summary(lists: DataFrame) -> DataFrame:
    """queries, matched, links, matched_share."""
    n = F.when(F.col("matched_entity_ids") == "", 0).otherwise(F.size(F.split("matched_entity_ids", ",")))
    out = lists.agg(F.count("*").alias("queries"), F.count_if(n > 0).alias("matched"), F.coalesce(F.sum(n).cast("long"), F.lit(0).cast("long")).alias("links"))
    return out.withColumn("matched_share", F.try_divide(F.col("matched").cast("double"), F.col("queries")))
