"""Linking a stream of query records against static targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from lumenlink.operators import model
from lumenlink.plans import lifecycles


def match_stream(queries: DataFrame, sources: list[DataFrame] | lifecycles.Targets, fitted: model.Model, sink, checkpoint: str) -> StreamingQuery:
    """Match each micro-batch of ``queries`` (source columns) and hand its lists to ``sink(lists, batch_id)``.

    The targets are normalised and indexed once, in the first batch, and kept
    by the executors (lost parts are made again); hand in persisted ``Targets``
    to give them back when the stream has ended.
    """
    targets = sources if isinstance(sources, lifecycles.Targets) else lifecycles.prepare_targets(sources).persist()

    def each(batch: DataFrame, batch_id: int) -> None:
        sink(lifecycles.match_pipeline(batch, targets, fitted), batch_id)

    return queries.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
