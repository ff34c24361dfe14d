"""Scoring of JSON request records with a saved model, as a batch job or a
file stream (the re-aimed form of a prediction endpoint: requests land as
JSON lines, predictions land as parquet)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from matchforge.operators.load import load_model
from matchforge.operators.model import parse_requests, score, split_requests


def model_features(model) -> list[str]:
    """Feature names a fitted pipeline expects (from its assembler inputs)."""
    for stage in model.stages:
        if hasattr(stage, "getInputCols"):
            return [c[:-2] if c.endswith("_z") else c for c in stage.getInputCols()]
    raise ValueError("model has no feature assembler")


def score_requests(spark: SparkSession, model_path: str, requests: str,
                   features: Sequence[str] | None = None) -> DataFrame:
    """Batch: every JSON line under ``requests`` -> its features, prediction
    and the word 'win' / 'loss'."""
    model = load_model(model_path)
    features = list(features or model_features(model))
    lines = spark.read.text(requests)
    return score(model, parse_requests(lines, "value", features), keep=features, features=features)


def rejected_requests(spark: SparkSession, model_path: str, requests: str) -> DataFrame:
    """Batch: the JSON lines under ``requests`` that cannot be scored."""
    features = model_features(load_model(model_path))
    return split_requests(parse_requests(spark.read.text(requests), "value", features), features)[1].select("value")


def main(argv=None):
    """``python -m matchforge.plans.score_job --model M --requests R --out O [--stream]``"""
    import argparse

    p = argparse.ArgumentParser(description="score JSON request records")
    p.add_argument("--model", required=True)
    p.add_argument("--requests", required=True, help="folder of JSON lines")
    p.add_argument("--out", required=True, help="parquet output folder")
    p.add_argument("--rejects", default=None, help="folder for the requests that cannot be scored")
    p.add_argument("--stream", action="store_true", help="process new files incrementally")
    p.add_argument("--checkpoint", default=None, help="stream checkpoint (shared folder)")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("matchforge-score").getOrCreate()
    if a.stream:
        from matchforge.session import scratch_path
        from matchforge.streaming.incremental import start_scoring_stream
        model = load_model(a.model)
        q = start_scoring_stream(spark, model, a.requests, model_features(model), a.out,
                                 a.checkpoint or scratch_path(spark, "score-ckpt"))
        q.awaitTermination()
    else:
        score_requests(spark, a.model, a.requests).write.mode("overwrite").parquet(a.out)
        if a.rejects:
            rejected_requests(spark, a.model, a.requests).write.mode("overwrite").text(a.rejects)
    return a.out


if __name__ == "__main__":
    main()
