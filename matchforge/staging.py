"""Staged copies: a table written once into the shared folder and read back.

Later steps read the copy, so nothing upstream runs twice and a lost executor
costs a task, not the lineage. ``Staged`` remembers the copies of one job, so
that the job can remove them when its own output is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from matchforge.session import scratch_path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    path = scratch_path(df.sparkSession, f"stage-{name}")
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def stage_measured(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """A staged copy and aggregates over it, in one pass over the columns they
    need. Not by an ``Observation`` on the write: a session that has observed
    anything is no longer serializable, and models that MLlib fits in it (their
    summaries hold the session) could then not be applied."""
    copy = stage(df, name)
    return copy, copy.agg(*[column.alias(key) for key, column in metrics.items()]).first().asDict()


def drop_staged(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a staged copy through the file system that holds
    them. Only paths under our own scratch folder are touched."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/matchforge/stage-" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
