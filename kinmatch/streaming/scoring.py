"""Queries that arrive as a stream, matched against a fixed index, a micro-batch at a time.

Ranks are per query, so a query's rows must be in one micro-batch: a query is one row, which holds.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kinmatch.functions.constants import MODEL_COLUMNS
from kinmatch.operators import cleaning, features, modeling
from kinmatch.operators.blocking import Blocker


def match_stream(raw: DataFrame, blocker: Blocker, model: PipelineModel | None, path: str, checkpoint: str, *, once: bool = True) -> StreamingQuery:
    """Clean, block and score each micro-batch of raw source 1 records; append to Parquet.

    A batch is written to a folder of its own number, over what a failed attempt left, so each
    query's matches appear once.
    """

    def handle(batch: DataFrame, number: int) -> None:
        cleaned = cleaning.clean_records(batch).withColumn("source", F.lit(1)).persist()
        pairs, _ = blocker.candidates(cleaned)
        if model is not None:
            table = features.extract(pairs, cleaned, blocker.references)
            pairs = modeling.predict(model, table, list(MODEL_COLUMNS))
        pairs.write.mode("overwrite").parquet(f"{path}/batch={number}")
        cleaned.unpersist()
        blocker.forget()

    writer = raw.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
