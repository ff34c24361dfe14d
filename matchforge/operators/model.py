"""Features, tuning, fitting and scoring of the win/loss classifier (MLlib).

Parity with the source model (a standard scaler and an L2 logistic regression
in a randomised 3-fold search):

* Scaling uses the **population** standard deviation (Spark's StandardScaler
  uses the sample one). The fitted means and deviations become constants in a
  ``SQLTransformer``, so the scaling is plain column arithmetic inside the
  saved ``PipelineModel``; a constant column gets deviation 1.
* The source objective is ``½‖w‖² + C·Σ loss``; Spark minimises
  ``mean loss + regParam·½‖w‖²``. They agree when ``regParam = 1/(C·n)``
  with ``standardization=False``, ``n`` being the rows of *that* fit, so each
  fold and the final refit get their own ``regParam``.
* Candidates with ``C <= 0`` are invalid: their score is null and they never
  win. The solver choice of the source grid has no Spark counterpart (one
  solver, same objective); candidates are sampled from the C grid with a seed.
* Folds are stratified: the rows of each class are numbered (without a sort or
  a shuffle) and dealt out in turn, so the folds of a class differ by at most
  one row, also among equal rows.
* The search fits all (fold, C) together by Newton steps (``search``); only the
  refit of the winner is an MLlib fit, since that is what is saved.
* Rows with a null feature or label are left out before a fit and counted; a
  candidate without a finite score has a null score and never wins.

Every step reads a staged copy of the training table (written once to the
shared folder), not the lineage that built it.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchforge.functions.scalar import label_word
from matchforge.operators.filters import split_rejects
from matchforge.operators.joins import left_enrich
from matchforge.operators.project import features_without
from matchforge.operators.search import MAX_STEPS, Setting, fold_accuracies, newton_fits
from matchforge.staging import stage
from matchforge.params import MAX_ITER, TUNE_C_GRID, TUNE_CANDIDATES, TUNE_FOLDS

FEATURE_DROP = ["champion_id", "performance_id", "match_id", "summoner_id", "champion_name"]
LABEL = "outcome_id"


def feature_table(performance: DataFrame, champion: DataFrame) -> DataFrame:
    """Performance ⟕ champion on champion_id, ids and names dropped."""
    return left_enrich(performance, champion, ["champion_id"]).drop(*FEATURE_DROP)


def feature_columns(df: DataFrame, label: str = LABEL) -> list[str]:
    return features_without(df, label)


def moments(df: DataFrame, cols: Sequence[str], by: str | None = None) -> list[dict]:
    """Per group of ``by`` (or of all rows): n, and the mean and population
    variance of each column. One aggregation, one row per group."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m_{c}"), F.var_pop(x).alias(f"v_{c}")]
    rows = (df.groupBy(by) if by else df.groupBy()).agg(*aggs).collect()
    return [r.asDict() for r in rows]


def merged(parts: Sequence[dict], cols: Sequence[str]) -> dict:
    """Moments of the union of disjoint groups."""
    n = sum(p["_n"] for p in parts)
    out = {"_n": n}
    for c in cols:
        mean = sum(p["_n"] * (p[f"m_{c}"] or 0.0) for p in parts) / max(n, 1)
        out[f"m_{c}"] = mean
        out[f"v_{c}"] = sum(p["_n"] * ((p[f"v_{c}"] or 0.0) + ((p[f"m_{c}"] or 0.0) - mean) ** 2) for p in parts) / max(n, 1)
    return out


def scaler_of(stats: dict, cols: Sequence[str], suffix: str = "_z") -> SQLTransformer:
    """Transformer that standardises ``cols`` by the population deviation; a
    constant column gets deviation 1."""
    exprs = []
    for c in cols:
        mean, std = stats[f"m_{c}"] or 0.0, (stats[f"v_{c}"] or 0.0) ** 0.5
        exprs.append(f"(CAST(`{c}` AS DOUBLE) - ({mean!r})) / ({std if std > 0 else 1.0!r}) AS `{c}{suffix}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__")


def population_scaler(df: DataFrame, cols: Sequence[str],
                      suffix: str = "_z") -> tuple[SQLTransformer, int]:
    """The scaler of ``df``'s columns, and its row count."""
    stats = merged(moments(df, cols), cols)
    return scaler_of(stats, cols, suffix), stats["_n"]


def complete_rows(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows without a null feature or label: what a fit can use."""
    return df.dropna(how="any", subset=[*feature_columns(df, label), label])


def _classifier(c_value: float, n: int, label: str, max_iter: int) -> LogisticRegression:
    return LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter,
                              regParam=1.0 / (c_value * n), elasticNetParam=0.0,
                              standardization=False, fitIntercept=True, tol=1e-6)


def _assembler(features: Sequence[str]) -> VectorAssembler:
    # "keep": a request with a missing value still gets its row back (score()
    # gives it a null prediction); fits only see complete rows.
    return VectorAssembler(inputCols=[f"{c}_z" for c in features], outputCol="features", handleInvalid="keep")


def fit(df: DataFrame, c_value: float, label: str = LABEL,
        features: Sequence[str] | None = None, max_iter: int = MAX_ITER) -> PipelineModel:
    """Scaler + assembler + L2 logistic regression with the source's objective,
    on the complete rows of ``df``."""
    if c_value <= 0:
        raise ValueError("C must be positive")
    features = list(features or feature_columns(df, label))
    rows = df.dropna(how="any", subset=[*features, label])
    scaler, n = population_scaler(rows, features)
    return Pipeline(stages=[scaler, _assembler(features), _classifier(c_value, n, label, max_iter)]).fit(rows)


def with_folds(df: DataFrame, folds: int = TUNE_FOLDS, seed: int = 0, label: str = LABEL) -> DataFrame:
    """``df`` with ``_fold``: the rows of each class dealt out in turn, so the
    folds of a class differ by at most one row.

    No row is moved or sorted: a task numbers the rows of each class as it
    writes them, and a table of counts (one row per task and class) says where
    each task's numbers begin. Equal rows stay spread as they were."""
    names = list(df.columns)

    def number(batches):
        from pyspark import TaskContext
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            codes = batch.column(names.index(label)).dictionary_encode()
            index = codes.indices.to_numpy(zero_copy_only=False)
            index = np.where(np.isnan(index), -1, index).astype(np.int64) if index.dtype.kind == "f" else index.astype(np.int64)
            nth = np.zeros(batch.num_rows, dtype=np.int64)
            for code in np.unique(index).tolist():
                value, own = (None if code < 0 else codes.dictionary[code].as_py()), index == code
                nth[own] = seen.get(value, 0) + np.arange(own.sum())
                seen[value] = seen.get(value, 0) + int(own.sum())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, part, dtype=np.int32)), pa.array(nth)],
                                             names=[*names, "_part", "_nth"])
    schema = T.StructType([*df.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_nth", T.LongType())])
    numbered = stage(df.mapInArrow(number, schema), "numbered")
    counts = numbered.groupBy("_part", F.col(label).alias("_class")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_class").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("_part").alias("_of"), "_class", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return numbered.join(F.broadcast(starts), (F.col("_part") == F.col("_of")) & F.col(label).eqNullSafe(F.col("_class"))).select(
        *names, F.pmod(F.col("_start") + F.col("_nth") + F.lit(seed), F.lit(folds)).cast("int").alias("_fold"))


@dataclass
class TuneResult:
    best_c: float
    best_score: float
    scores: dict
    model: PipelineModel
    incomplete: int = 0


def sample_candidates(seed: int, n: int = TUNE_CANDIDATES, grid=TUNE_C_GRID,
                      solvers: int = 4) -> list[float]:
    """Seeded sample of ``n`` (C, solver) settings from the grid; the solver is
    dropped (one Spark solver), so repeated C values collapse."""
    settings = [(c, s) for c in grid for s in range(solvers)]
    picked = random.Random(seed).sample(settings, n)
    return sorted({c for c, _ in picked})


def best_candidate(scores: dict) -> float:
    """The candidate of the highest finite score; of equal ones the smallest."""
    valid = {c: s for c, s in scores.items() if s is not None and math.isfinite(s)}
    if not valid:
        raise ValueError("no valid candidate")
    return max(sorted(valid), key=lambda c: valid[c])


def cross_validate(df: DataFrame, candidates: Sequence[float], label: str = LABEL, seed: int = 0,
                   folds: int = TUNE_FOLDS, max_iter: int = MAX_ITER) -> dict:
    """Mean accuracy over the folds of each C; null if C is invalid or a fold
    gives none. The moments of all folds come from one aggregation, and so does
    each Newton step of all (fold, C) at once; one more job scores them all."""
    features = feature_columns(df, label)
    data = stage(with_folds(df, folds, seed, label), "folds")
    parts = {p["_fold"]: p for p in moments(data, features, "_fold")}
    settings = []
    for f in range(folds):
        stats = merged([p for k, p in parts.items() if k != f], features)
        deviations = tuple((stats[f"v_{c}"] or 0.0) ** 0.5 or 1.0 for c in features)
        settings += [Setting(f, float(c), tuple(stats[f"m_{c}"] or 0.0 for c in features), deviations, stats["_n"])
                     for c in dict.fromkeys(candidates) if c > 0 and stats["_n"]]
    fits = newton_fits(data, features, label, "_fold", settings, min(max_iter, MAX_STEPS)) if settings else []
    results: dict = {c: [] for c in candidates}
    for s, a in zip(settings, fold_accuracies(data, features, label, "_fold", settings, fits) if settings else []):
        results[s.c].append(a)
    return {c: (sum(a) / folds if len(a) == folds and all(x is not None and math.isfinite(x) for x in a) else None) for c, a in results.items()}


def tune_and_fit(df: DataFrame, label: str = LABEL, seed: int = 0,
                 candidates: Sequence[float] | None = None, folds: int = TUNE_FOLDS,
                 max_iter: int = MAX_ITER) -> TuneResult:
    """Randomised search over C with k-fold accuracy, then a refit of the best
    C on every complete row. ``df`` should be staged (read from storage)."""
    cands = list(candidates) if candidates is not None else sample_candidates(seed)
    rows = complete_rows(df, label)
    incomplete = df.filter(" OR ".join(f"`{c}` IS NULL" for c in df.columns)).count()
    scores = cross_validate(rows, cands, label, seed, folds, max_iter)
    best_c = best_candidate(scores)
    model = fit(rows, best_c, label, feature_columns(df, label), max_iter)
    return TuneResult(best_c, scores[best_c], scores, model, incomplete)


def request_ok(features: Sequence[str]) -> Column:
    """Whether a request has every feature."""
    ok = F.lit(True)
    for c in features:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return ok


def score(model: PipelineModel, rows: DataFrame, keep: Sequence[str] = (),
          features: Sequence[str] | None = None) -> DataFrame:
    """Predicted class and its word ('win' / 'loss') for every row. With
    ``features``, a row that lacks one of them has a null class and word."""
    out = model.transform(rows)
    ok = request_ok(features) if features else F.lit(True)
    return out.select(*keep, F.when(ok, F.col("prediction").cast("int")).alias("prediction"),
                      F.when(ok, label_word(F.col("prediction"))).alias("predicted"))


def parse_requests(requests: DataFrame, text_col: str, features: Sequence[str]) -> DataFrame:
    """JSON request records (one flat object each) -> feature rows; a record
    that does not parse, or lacks a field, has nulls there."""
    schema = ", ".join(f"`{c}` DOUBLE" for c in features)
    parsed = requests.select("*", F.from_json(F.col(text_col), schema).alias("_req"))
    return parsed.select("*", *[F.col(f"_req.`{c}`").alias(c) for c in features]).drop("_req")


def split_requests(parsed: DataFrame, features: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(requests that can be scored, those that lack a field or don't parse)."""
    return split_rejects(parsed, request_ok(features))
