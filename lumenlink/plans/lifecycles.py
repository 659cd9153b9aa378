"""The three ways to run the engine from end to end; everything but the model is lazy."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenlink.functions import text
from lumenlink.operators import blocking, evaluate, features, model, predict
from lumenlink.schema import BlockingOptions, TfidfOptions
from lumenlink.sources import tables


def token_records(records: DataFrame) -> DataFrame:
    """Source rows as blocking wants them: id, name (token profile), country, and src if there."""
    made = {"name": text.name_token(F.col("business_name")), "country": text.country(F.col("country"))}
    return records.select(*[c for c in ("src",) if c in records.columns], F.col("entity_id").alias("id"), text.once(made))


def tfidf_records(records: DataFrame) -> DataFrame:
    """id, name (tfidf profile), country and body: name and address, or what there is of them."""
    out = records.select(*[c for c in ("src",) if c in records.columns], F.col("entity_id").alias("id"), text.name_tfidf(F.col("business_name")).alias("name"), text.address_tfidf(F.col("business_address")).alias("_addr"), text.country(F.col("country")).alias("country"))
    return out.withColumn("body", text.combined(F.col("name"), F.col("_addr"))).drop("_addr")


def rich_records(records: DataFrame) -> DataFrame:
    """entity_id, norm_name, norm_addr, combined, country in the rich profiles."""
    out = records.select("entity_id", text.name_rich(F.col("business_name")).alias("norm_name"), text.address_rich(F.col("business_address")).alias("norm_addr"), text.country(F.col("country")).alias("country"))
    return out.select("entity_id", "norm_name", "norm_addr", text.combined(F.col("norm_name"), F.col("norm_addr")).alias("combined"), "country")


def candidates(queries: DataFrame, targets: DataFrame, how: str = "token", options: BlockingOptions | TfidfOptions | None = None) -> DataFrame:
    """query_id, target_id (and score, rank by tokens) of source rows."""
    if how == "token":
        return blocking.block_tokens(token_records(queries), token_records(targets), options or BlockingOptions())
    return blocking.block_tfidf(tfidf_records(queries), tfidf_records(targets), options or TfidfOptions())


def pairs_with_features(queries: DataFrame, targets: DataFrame, found: DataFrame) -> DataFrame:
    pairs = found.select(F.col("query_id").alias("source1_entity_id"), F.col("target_id").alias("candidate_entity_id"))
    return features.pair_features(pairs, queries, targets)


@dataclass(frozen=True)
class Targets:
    """Target sources made ready once: ``index`` for blocking by tokens, ``keyed`` for features."""

    index: blocking.TargetIndex
    keyed: DataFrame

    def persist(self) -> Targets:
        return Targets(self.index.persist(), self.keyed.persist())

    def unpersist(self) -> None:
        self.index.unpersist()
        self.keyed.unpersist()


def prepare_targets(sources: list[DataFrame], options: BlockingOptions | None = None) -> Targets:
    targets = tables.union_targets(*sources)
    return Targets(blocking.index_targets(token_records(targets), options or BlockingOptions()), features.keyed(targets, "src"))


def train_pipeline(queries: DataFrame, sources: list[DataFrame], truth: DataFrame, iterations: int = 200, options: BlockingOptions | None = None) -> model.Model:
    """Blocking, features, labels, training; ``truth`` has source1_entity_id and matched_entity_ids (a list; the last row of a record holds)."""
    targets = tables.union_targets(*sources)
    known = tables.explode_list(tables.last_wins(truth, "source1_entity_id"), "source1_entity_id", "matched_entity_ids", "entity_id", trimmed=True)
    labelled = evaluate.label_pairs(pairs_with_features(queries, targets, candidates(queries, targets, "token", options)), known).persist()
    try:
        return model.train(labelled, iterations)
    finally:
        labelled.unpersist()


def match_pipeline(queries: DataFrame, sources: list[DataFrame] | Targets, fitted: model.Model, how: str = "token", options: BlockingOptions | TfidfOptions | None = None, placed: bool = False) -> DataFrame:
    """One row per query row: source1_entity_id, matched_entity_ids (and place, if wanted). Prepared targets are searched by tokens."""
    if isinstance(sources, Targets):
        targets, found = sources.keyed, blocking.block_tokens(token_records(queries), sources.index, options or BlockingOptions())
    else:
        targets = tables.union_targets(*sources)
        found = candidates(queries, targets, how, options)
    scored = model.score(fitted.pipeline, pairs_with_features(queries, targets, found))
    return predict.match_lists(queries, predict.apply_threshold(scored, fitted.threshold), placed)
