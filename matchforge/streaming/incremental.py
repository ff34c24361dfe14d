"""Incremental load: new files in a landing folder are appended to a target
table, skipping keys already there.

``readStream`` on the landing folder -> ``foreachBatch(append_if_absent)`` with
a checkpoint in the shared folder. Exactly-once comes from two things: the
file source and checkpoint replay each micro-batch with the same files after a
failure, and the append is idempotent (an anti-join on the key), so a replayed
batch appends nothing twice. No state store is needed.

The target is read through the batch's own session inside the batch, so each
batch sees what earlier batches appended.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from matchforge.operators.load import append_if_absent


def start_incremental_load(spark: SparkSession, landing: str, schema, target: str,
                           checkpoint: str, keys: Sequence[str], order: Sequence[str] | None = None,
                           fmt: str = "parquet", max_files_per_trigger: int | None = None,
                           available_now: bool = True,
                           processing_time: str | None = None) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is landed and stops
    (an hourly job without catch-up becomes one run per trigger)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(landing)

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        append_if_absent(batch, target, [list(keys)], order)

    writer = stream.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def run_incremental_load(spark: SparkSession, landing: str, schema, target: str,
                         checkpoint: str, keys: Sequence[str], **kw) -> DataFrame:
    """Process everything landed so far, then return the target table."""
    q = start_incremental_load(spark, landing, schema, target, checkpoint, keys, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(target)


def start_scoring_stream(spark: SparkSession, model, requests: str, features: Sequence[str],
                         output: str, checkpoint: str, text_col: str = "value",
                         keep: Sequence[str] = ()) -> StreamingQuery:
    """Score a stream of JSON request records (one flat object per line) with a
    fitted pipeline; predictions land as parquet."""
    from matchforge.operators.model import parse_requests, score
    lines = spark.readStream.format("text").load(requests)
    rows = parse_requests(lines, text_col, features)
    scored = score(model, rows, keep=list(keep) + list(features), features=features)
    return (scored.writeStream.format("parquet").option("path", output)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
