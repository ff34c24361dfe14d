"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchforge.session import scratch_path

#: Text bytes that one vectorised step holds at a time inside a task.
STEP_BYTES = 8 << 20


def ship(spark: SparkSession) -> None:
    """Let executors import this package wherever the driver was started:
    Spark's own file distribution carries a zip of it, once per context. Texts
    reach Python in batches of bounded bytes (one longer text comes whole)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(STEP_BYTES))
    sc = spark.sparkContext
    if getattr(sc, "_matchforge_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="matchforge-zip-"), "matchforge_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("matchforge", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._matchforge_shipped = True


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back: later uses
    read that copy, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(schema).parquet(path)


def bucketed(df: DataFrame, name: str, column: str, parts: int) -> DataFrame:
    """``df`` written once into the shared folder, dealt by ``column`` into
    ``parts`` buckets: joins on it with equally bucketed data move no rows."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.repartition(parts, column).write.bucketBy(parts, column).sortBy(column).format("parquet")
     .option("compression", "zstd").option("path", path).saveAsTable(f"{name}_{path.rsplit('-', 1)[-1]}"))
    return spark.table(f"{name}_{path.rsplit('-', 1)[-1]}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only id and text, under names of our own: whatever other columns the
    input has cannot clash with the operator's."""
    return docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("txt"))


def by_bytes(batches: Iterator[pa.RecordBatch], column: str = "txt",
             step: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``step`` text bytes (one
    longer text still comes whole)."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i in range(n):
            total += int(sizes[i])
            if total >= step:
                yield batch.slice(start, i + 1 - start)
                start, total = i + 1, 0
        if start < n:
            yield batch.slice(start, n - start)


class Cuts:
    """What a worker process remembers of words it has cut: ids as bytes, by
    word. New words are young; one that is asked for again becomes old. Either
    part is emptied when it is full, so memory stays bounded and words that
    occur once don't drive out common ones."""

    def __init__(self, young: int = 400_000, old: int = 500_000):
        self.limits, self.young, self.old = (young, old), {}, {}

    def get(self, words: list[str]) -> list[bytes | None]:
        old, young = self.old, self.young
        if len(old) > self.limits[1]:
            old.clear()
        out = list(map(old.get, words))
        for i in [i for i, x in enumerate(out) if x is None]:
            x = young.pop(words[i], None)
            if x is not None:
                old[words[i]] = out[i] = x
        return out

    def put(self, words: list[str], cuts: list[bytes]) -> None:
        if len(self.young) + len(words) > self.limits[0]:
            self.young.clear()
        if len(words) <= self.limits[0]:
            self.young.update(zip(words, cuts))


def pooled(cuts: list[bytes], of: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Ids of texts: ``of`` numbers the cut of each of their words, ``sizes``
    says how many words each text has."""
    count = np.fromiter(map(len, cuts), dtype=np.int64, count=len(cuts)) // 4
    return laid(np.frombuffer(b"".join(cuts), dtype="<u4"), (np.cumsum(count) - count)[of], count[of], sizes)


def laid(pool: np.ndarray, at: np.ndarray, n: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Ids of texts whose words have ``n`` ids of the pool from ``at`` on each;
    ``sizes`` says how many words each text has."""
    flat = pool[np.repeat(at - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    ends = np.r_[0, np.cumsum(n)][np.r_[0, np.cumsum(sizes)]]
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]


def sliced(flat: np.ndarray, count: np.ndarray) -> list[bytes]:
    """Ids that lie behind one another, as the bytes of each word."""
    raw, ends = flat.astype("<u4").tobytes(), np.r_[0, np.cumsum(count) * 4].tolist()
    return [raw[a:b] for a, b in zip(ends, ends[1:])]


def crc_mod(id_col: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo n (null ids: remainder of the
    empty string, 0)."""
    return (F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % n).cast("int")


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
