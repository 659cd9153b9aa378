"""Similarity features of candidate pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenlink.functions import similarity, text
from lumenlink.sources import tables


KEYED = {"entity_id", "name", "addr", "country"}


def keyed(records: DataFrame, *order: str) -> DataFrame:
    """One row per entity_id (the last in ``order``, then by place) with name, address and country in the raw profile."""
    one = tables.last_wins(records, "entity_id", *order)
    return one.select("entity_id", text.raw(F.col("business_name")).alias("name"), text.raw(F.col("business_address")).alias("addr"), text.raw(F.col("country")).alias("country"))


def pair_features(pairs: DataFrame, queries: DataFrame, targets: DataFrame) -> DataFrame:
    """The eight features of (source1_entity_id, candidate_entity_id) pairs; pairs with an unknown side go.

    ``targets`` may have src: of equal ids the later source holds. What
    ``keyed`` returns is taken, too.
    """
    queries, targets = (x if KEYED <= set(x.columns) else keyed(x, *[c for c in ("src",) if c in x.columns]) for x in (queries, targets))
    q = queries.select(*[F.col(c).alias(f"q_{c}") for c in ("entity_id", "name", "addr", "country")])
    t = targets.select(*[F.col(c).alias(f"t_{c}") for c in ("entity_id", "name", "addr", "country")])
    both = pairs.join(q, F.col("source1_entity_id") == F.col("q_entity_id")).join(t, F.col("candidate_entity_id") == F.col("t_entity_id"))
    a, b = (lambda c: F.col(f"q_{c}")), (lambda c: F.col(f"t_{c}"))
    return both.select(
        "source1_entity_id",
        "candidate_entity_id",
        similarity.exact(a("name"), b("name")).alias("name_exact_match"),
        similarity.exact(a("addr"), b("addr")).alias("addr_exact_match"),
        similarity.exact(a("country"), b("country")).alias("country_match"),
        similarity.levenshtein(a("name"), b("name")).alias("name_levenshtein"),
        similarity.jaro_winkler(a("name"), b("name")).alias("name_jaro_winkler"),
        similarity.levenshtein(a("addr"), b("addr")).alias("addr_levenshtein"),
        similarity.length_difference(a("name"), b("name")).alias("name_length_diff"),
        similarity.length_difference(a("addr"), b("addr")).alias("addr_length_diff"),
    )
