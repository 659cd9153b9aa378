"""Schemas and options of the linkage engine."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

SOURCE_COLUMNS = ("entity_id", "business_name", "business_address", "country")
FEATURE_COLUMNS = (
    "name_exact_match", "addr_exact_match", "country_match", "name_levenshtein", "name_jaro_winkler", "addr_levenshtein", "name_length_diff", "addr_length_diff",
)
_KINDS = (T.IntegerType(),) * 3 + (T.DoubleType(),) * 3 + (T.IntegerType(),) * 2

CANDIDATES = T.StructType([T.StructField(c, T.StringType()) for c in ("source1_entity_id", "candidate_entity_ids")])
TRUTH = T.StructType([T.StructField(c, T.StringType()) for c in ("source1_entity_id", "matched_entity_ids")])
FEATURES = T.StructType([T.StructField(c, T.StringType()) for c in ("source1_entity_id", "candidate_entity_id")] + [T.StructField(c, k) for c, k in zip(FEATURE_COLUMNS, _KINDS, strict=True)])


@dataclass(frozen=True)
class BlockingOptions:
    """k: candidates per query; max_df: a token in this many targets of a country or more is dropped."""

    k: int = 30
    max_df: int = 10_000
    min_token: int = 3
    exact_bonus: int = 1000


@dataclass(frozen=True)
class TfidfOptions:
    """Vocabulary: terms in ``min_df`` targets or more, the ``vocabulary`` most frequent; ``digits`` rounds the cosine before ranking.

    ``sample``: fit on so many targets, chosen by a hash with ``seed``; None fits on all.
    """

    k: int = 30
    min_df: int = 2
    vocabulary: int = 100_000
    digits: int = 6
    sample: int | None = None
    seed: int = 42
