"""Candidate generation: exact names, shared rare tokens, TF-IDF cosine, top-k.

Inputs: ``queries`` (id, name, country) and ``targets`` (src, id, name,
country), names normalised. Records with equal names and countries have equal
scores, so scores are made once per distinct name: a name that a third of all
records bear costs one row, and of its bearers only the first k per query can
be candidates.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenlink.functions import text
from lumenlink.operators import order
from lumenlink.schema import BlockingOptions, TfidfOptions


def with_name_id(records: DataFrame) -> DataFrame:
    """Add name_id, 128 bits that stand for name and country wherever these would be carried through joins."""
    known = F.concat(F.length("name").cast("string"), F.lit(":"), "name", F.coalesce("country", F.lit("")))
    return records.withColumn("name_id", F.coalesce(F.unhex(F.md5(known.cast("binary"))), F.lit(b"")))  # never null, so nothing asks for that


def _named(records: DataFrame) -> DataFrame:
    """The records with a name, and their name_id; names are evaluated once a row."""
    keys = [c for c in ("src", "id") if c in records.columns]
    return with_name_id(records.select(*keys, text.once({"name": F.col("name"), "country": F.col("country")})).where("name <> ''"))


def exact_pairs(queries: DataFrame, targets: DataFrame) -> DataFrame:
    """query_id, src, target_id of records with equal, non-empty names and equal countries."""
    q = _named(queries).select(F.col("id").alias("query_id"), "name_id")
    t = _named(targets).select("src", F.col("id").alias("target_id"), "name_id")
    return q.join(t, "name_id").select("query_id", "src", "target_id")


def exact_links(queries: DataFrame, targets: DataFrame) -> DataFrame:
    """query_id, src, target_id, links: the first target with the query's name and country, and how many there are.

    What ``exact_pairs`` tells, without spelling out the pairs within a name.
    Queries without such a target are not in it.
    """
    t = _named(targets).groupBy("name_id").agg(F.min(F.struct("src", "id")).alias("first"), F.count("*").alias("links"))
    q = _named(queries).select(F.col("id").alias("query_id"), "name_id")
    return q.join(t, "name_id").select("query_id", "first.src", F.col("first.id").alias("target_id"), "links")


def postings(targets: DataFrame, min_token: int = 3) -> DataFrame:
    """token, country, src, target_id: a row for each distinct token of each target."""
    return targets.select(F.explode(text.tokens(F.col("name"), min_token)).alias("token"), "country", "src", F.col("id").alias("target_id"))


@dataclass(frozen=True)
class TargetIndex:
    """What blocking needs of the targets: one row per distinct name, its rare tokens, its first k bearers."""

    names: DataFrame  # t: name_id, first (src, id)
    words: DataFrame  # token, country, t: tokens in fewer than max_df targets of the country
    bearers: DataFrame  # t, src, target_id

    def persist(self) -> TargetIndex:
        return TargetIndex(self.names.persist(), self.words.persist(), self.bearers.persist())

    def unpersist(self) -> None:
        for df in (self.names, self.words, self.bearers):
            df.unpersist()


def _names(targets: DataFrame, min_token: int) -> DataFrame:
    """name_id, row (src, id, country, words of the first target) and n of the distinct names; the names themselves end here.

    One aggregate holds it all, and n stays in use, so that everything which
    is made of the names shares one shuffle of them.
    """
    rows = with_name_id(targets).select("name_id", "country", text.tokens(F.col("name"), min_token).alias("words"), "src", "id")
    return rows.groupBy("name_id").agg(F.min(F.struct("src", "id", "country", "words")).alias("row"), F.count("*").alias("n")).where("n > 0")


def token_frequencies(targets: DataFrame, min_token: int = 3) -> DataFrame:
    """token, country, df: in how many targets of the country the token is."""
    words = _names(targets, min_token).select(F.explode("row.words").alias("token"), "row.country", "n")
    return words.groupBy("token", "country").agg(F.sum("n").alias("df"))


def rare_tokens(targets: DataFrame, options: BlockingOptions = BlockingOptions()) -> DataFrame:
    return token_frequencies(targets, options.min_token).where(F.col("df") < options.max_df)


def index_targets(targets: DataFrame, options: BlockingOptions = BlockingOptions()) -> TargetIndex:
    """The index of ``targets`` (src, id, name, country); lazy. Persist it to match many batches of queries."""
    names = _names(targets, options.min_token)
    rare = rare_tokens(targets, options).select("token", "country").hint("merge")
    words = names.select(F.explode("row.words").alias("token"), "row.country", F.col("name_id").alias("t")).join(rare, ["token", "country"])
    place = F.row_number().over(Window.partitionBy("name_id").orderBy("src", "id"))
    bearers = with_name_id(targets).select("name_id", "src", "id").withColumn("place", place).where(F.col("place") <= options.k)
    return TargetIndex(names.select(F.col("name_id").alias("t"), F.struct("row.src", "row.id").alias("first")), words, bearers.select(F.col("name_id").alias("t"), "src", F.col("id").alias("target_id")))


def _name_scores(queries: DataFrame, index: TargetIndex, options: BlockingOptions) -> DataFrame:
    """q, t, score of distinct names (by name_id) that share a rare token or are equal.

    Only ids and single tokens go through the joins, never names. The postings
    are merged, not broadcast: the planner sizes them before they are exploded.
    A token that many queries have is split by adaptive skew joins; of targets,
    ``max_df`` bear it at most.
    """
    q = with_name_id(queries).select("name_id", "country", (F.col("name") != "").alias("named"), text.tokens(F.col("name"), options.min_token).alias("words"))
    q = q.groupBy("name_id").agg(F.first("country").alias("country"), F.first("named").alias("named"), F.first("words").alias("words"))
    q_words = q.select(F.explode("words").alias("token"), "country", F.col("name_id").alias("q"))
    shared = q_words.join(index.words.hint("merge"), ["token", "country"]).select("q", "t", F.lit(1).alias("points"))
    same = q.where("named").select(F.col("name_id").alias("q")).join(index.names.select("t").hint("merge"), F.col("q") == F.col("t")).select("q", "t", F.lit(options.exact_bonus).alias("points"))
    return shared.unionByName(same).groupBy("q", "t").agg(F.sum("points").alias("score"))


def token_scores(queries: DataFrame, targets: DataFrame, options: BlockingOptions = BlockingOptions()) -> DataFrame:
    """query_id, src, target_id, score of all record pairs: shared rare tokens, and the bonus for equal names."""
    scores = _name_scores(queries, index_targets(targets, options), options)
    q = with_name_id(queries).select(F.col("id").alias("query_id"), F.col("name_id").alias("q"))
    t = with_name_id(targets).select("src", F.col("id").alias("target_id"), F.col("name_id").alias("t"))
    return scores.join(q, "q").join(t, "t").select("query_id", "src", "target_id", "score")


def top_k(scores: DataFrame, k: int, score: str = "score") -> DataFrame:
    """Add rank (1 .. k): score descending, then source, then id."""
    best = Window.partitionBy("query_id").orderBy(F.desc(score), "src", "target_id")
    return scores.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).withColumn("rank", F.col("rank").cast("long"))


def block_tokens(queries: DataFrame, targets: DataFrame | TargetIndex, options: BlockingOptions = BlockingOptions()) -> DataFrame:
    """query_id, src, target_id, score, rank: the k best targets of each query.

    k names at most can hold a query's k best records, so names are cut first,
    then their first k bearers are put in.
    """
    k = options.k
    index = targets if isinstance(targets, TargetIndex) else index_targets(targets, options)
    named = _name_scores(queries, index, options).join(index.names.select("t", "first"), "t")
    best = named.withColumn("place", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "first"))).where(F.col("place") <= k)
    records = best.select("q", "t", "score").join(index.bearers, "t")
    best_first = Window.partitionBy("q").orderBy(F.desc("score"), "src", "target_id")
    ranked = records.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k).withColumn("rank", F.col("rank").cast("long"))
    q = with_name_id(queries).select(F.col("id").alias("query_id"), F.col("name_id").alias("q"))
    return q.join(ranked, "q").select("query_id", "src", "target_id", "score", "rank")


# ---------------------------------------------------------------- TF-IDF


def term_counts(records: DataFrame, keys: list[str], body: str) -> DataFrame:
    """keys, term, tf: words of two or more letters, digits or underscores."""
    words = F.filter(F.split(F.col(body), r"[^a-z0-9_]+"), lambda w: F.length(w) >= 2)
    return records.select(*keys, F.explode(words).alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("tf"))


def vocabulary(counts: DataFrame, options: TfidfOptions) -> DataFrame:
    """term, df of the fitted terms: df of at least min_df, the most frequent by total tf, ties by term."""
    by_term = counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("total")).where(F.col("df") >= options.min_df)
    total, term = F.col("total"), F.col("term")
    levels = [-F.floor(F.log2(total.cast("double")) * 64), -total, F.substring(term, 1, 3), F.substring(term, 4, 3)]
    return order.first_n(by_term, options.vocabulary, levels, [F.desc("total"), "term"]).select("term", "df")


def weights(counts: DataFrame, terms: DataFrame, n_docs: Column, keys: list[str]) -> DataFrame:
    """keys, term, w: (1 + ln tf)(ln((1 + n) / (1 + df)) + 1), of length 1 per record."""
    w = (F.lit(1.0) + F.log("tf")) * (F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0)
    raw = counts.join(terms, "term").select(*keys, "term", w.alias("w"))
    norms = raw.groupBy(*keys).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return raw.join(norms, keys).select(*keys, "term", (F.col("w") / F.col("norm")).alias("w"))


def fit_rows(targets: DataFrame, options: TfidfOptions) -> DataFrame:
    """The targets that TF-IDF is fitted on: all, or exactly ``options.sample`` of them, chosen by a seeded hash of source and id."""
    if not options.sample:
        return targets
    chance = order.shuffled(F.concat_ws(":", "src", "id"), options.seed)
    return order.first_n(targets, options.sample, order.hash_levels(chance), [chance])


def tfidf_weights(queries: DataFrame, targets: DataFrame, options: TfidfOptions = TfidfOptions()) -> tuple[DataFrame, DataFrame]:
    """Weights of queries (id, term, w) and targets (src, id, term, w), fitted on the targets' column body. Lazy."""
    fitted = fit_rows(targets, options)
    counts = term_counts(targets, ["src", "id"], "body")
    terms = vocabulary(counts if not options.sample else term_counts(fitted, ["src", "id"], "body"), options)
    n_docs = fitted.agg(F.count("*").cast("double")).scalar()
    return weights(term_counts(queries, ["id"], "body"), terms, n_docs, ["id"]), weights(counts, terms, n_docs, ["src", "id"])


def cosine_pairs(queries: DataFrame, targets: DataFrame, options: TfidfOptions = TfidfOptions()) -> DataFrame:
    """query_id, src, target_id, score: cosines of all pairs that share a fitted term, rounded."""
    qw, tw = tfidf_weights(queries, targets, options)
    q = qw.select(F.col("id").alias("query_id"), "term", F.col("w").alias("qw"))
    t = tw.select("src", F.col("id").alias("target_id"), "term", F.col("w").alias("tw"))
    dots = q.join(t, "term").groupBy("query_id", "src", "target_id").agg(F.sum(F.col("qw") * F.col("tw")).alias("score"))
    return dots.withColumn("score", F.round("score", options.digits))


def block_tfidf(queries: DataFrame, targets: DataFrame, options: TfidfOptions = TfidfOptions()) -> DataFrame:
    """query_id, target_id (distinct): the k nearest by cosine whose country is the query's (any, if that is empty), and all equal names.

    Inputs have name, country and body (the text that is compared). The country
    is asked after the k nearest are taken.
    """
    best = top_k(cosine_pairs(queries, targets, options), options.k)
    q = queries.select(F.col("id").alias("query_id"), F.col("country").alias("q_country"))
    t = targets.select("src", F.col("id").alias("target_id"), F.col("country").alias("t_country"))
    near = best.join(q, "query_id").join(t, ["src", "target_id"]).where("q_country = t_country or q_country = ''")
    return near.select("query_id", "target_id").unionByName(exact_pairs(queries, targets).select("query_id", "target_id")).distinct()


def candidate_lists(queries: DataFrame, candidates: DataFrame, by_rank: bool = True) -> DataFrame:
    """source1_entity_id, candidate_entity_ids for every query (empty without candidates), in rank or ascending order."""
    from lumenlink.sources import tables

    lists = tables.collect_ids(candidates, "query_id", "target_id", "ids", order="rank" if by_rank else None, distinct=not by_rank)
    out = queries.select(F.col("id").alias("query_id")).join(lists, "query_id", "left")
    return out.select(F.col("query_id").alias("source1_entity_id"), F.coalesce("ids", F.lit("")).alias("candidate_entity_ids"))
