"""Quarantine of landed records that could not be used, and their replay.

The quarantine is an append-only table partitioned by source and reason. A row
says that a record (known by its source and the hash of its raw text) was tried
in a numbered attempt and failed for a reason, or was 'repaired'. The state of a
record is an aggregate over its rows, so a run that is repeated with the same
attempt number, after a lost driver for instance, changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchforge.operators.load import read_target
from matchforge.sources.documents import parsed_lines
from matchforge.staging import drop_staged, stage, stage_measured

REPAIRED = "repaired"
RECORD = "record_id string, attempt bigint, raw string, source string, reason string"


def record_id(raw: str = "raw"):
    """Equal raw texts of a source are one record."""
    return F.sha2(F.col(raw), 256)


def quarantine(rejects: DataFrame, path: str, attempt: int) -> None:
    """Append rejects (source, reason, raw) of an attempt; attempts of a record
    are numbered upwards."""
    (rejects.select(record_id().alias("record_id"), F.lit(attempt).cast("bigint").alias("attempt"), "raw", "source", "reason")
     .write.mode("append").partitionBy("source", "reason").parquet(path))


def open_records(spark: SparkSession, path: str, source: str | None = None) -> DataFrame:
    """(source, record_id, reason, attempts, raw) of the records that are not
    repaired: the reason of their last attempt and the number of attempts."""
    log = read_target(spark, path)
    if log is None:
        log = spark.createDataFrame([], RECORD)
    if source is not None:
        log = log.where(F.col("source") == source)
    last = F.max_by("reason", F.struct(F.col("attempt"), F.col("reason") == REPAIRED))
    return (log.groupBy("source", "record_id")
            .agg(last.alias("reason"), F.count_distinct("attempt").alias("attempts"), F.first("raw", ignorenulls=True).alias("raw"))
            .where(F.col("reason") != REPAIRED))


def replay(spark: SparkSession, path: str, source: str, schema, needed: Sequence[str], attempt: int,
           merge: Callable[[DataFrame], None], repairs: DataFrame | None = None) -> dict[str, int]:
    """Try a source's open records again: their repaired text where ``repairs``
    (record_id, value; one row a record) has one, else the raw text, which a
    mended schema may now accept. ``merge`` gets the usable documents (the
    schema's columns, record_id and attempts) and must be idempotent, as an
    append of absent rows is; only then are they marked as repaired, so a replay
    that dies in between is simply run again. The others count one attempt more.
    """
    tried = open_records(spark, path, source).select("record_id", "attempts", "raw")
    if repairs is not None:
        tried = tried.join(repairs.select("record_id", "value"), "record_id", "left")
    else:
        tried = tried.withColumn("value", F.lit(None).cast("string"))
    lines = tried.withColumn("value", F.coalesce("value", "raw"))
    rows, n = stage_measured(parsed_lines(lines, schema, needed), f"replay-{source}",
                             repaired=F.count_if(F.col("why").isNull()), failed=F.count("why"))
    usable = rows.where("why IS NULL")
    merge(usable.select("doc.*", "record_id", (F.col("attempts") + 1).alias("attempts")))
    # The raw text is in the quarantine already.
    done = stage(rows.select("record_id", F.lit(attempt).cast("bigint").alias("attempt"), F.lit(None).cast("string").alias("raw"),
                             F.lit(source).alias("source"), F.coalesce("why", F.lit(REPAIRED)).alias("reason")), "replayed")
    done.write.mode("append").partitionBy("source", "reason").parquet(path)
    for copy in (rows, done):
        drop_staged(spark, copy)
    return n
