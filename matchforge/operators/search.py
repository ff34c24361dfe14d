"""Fits of many settings at once: every (left-out fold, C) of a cross-validated
logistic regression takes a Newton step from one aggregation.

A task adds up, for each setting, the loss, the gradient and the Hessian of its
rows (a few dozen numbers a setting, whatever the rows), Spark sums them over
the tasks, and the driver solves one small system a setting. A step that does
not lower the objective is halved. Rows are read in place: no copy per fold,
none per candidate.

The objective is ½‖w‖² + C·Σ loss over features that are standardised by the
population moments of the setting's own training rows; the intercept is free.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Newton steps at most, the largest mean gradient of a finished fit, and the
#: least gain in the objective (relative) that is worth another step.
MAX_STEPS, TOLERANCE, GAIN = 50, 1e-8, 1e-12


@dataclass(frozen=True)
class Setting:
    """One fit: the fold that is left out (None: none), C, and the mean and
    deviation of each feature and the row count of its training rows."""

    fold: int | None
    c: float
    mean: tuple[float, ...]
    deviation: tuple[float, ...]
    n: int

    def raw(self, theta: np.ndarray) -> np.ndarray:
        """Weights and intercept for features as they are."""
        w = theta[:-1] / np.array(self.deviation)
        return np.r_[w, theta[-1] - w @ np.array(self.mean)]


def _sums(data: DataFrame, features: Sequence[str], label: str, fold: str, settings: Sequence[Setting], thetas: Sequence[np.ndarray]) -> list[np.ndarray]:
    """Loss, gradient and upper Hessian of each setting at its weights: one job.

    Tasks work in the scale of the first setting, so the rows of a batch and
    the products of their features serve all settings in three matrix products;
    the driver turns the sums into each setting's own scale."""
    columns, folds, d = list(features), np.array([np.nan if s.fold is None else s.fold for s in settings]), len(features) + 1
    center, scale = np.array(settings[0].mean), np.array(settings[0].deviation)
    turns = []  # [z, 1] of a setting = [z, 1] of the first one @ turn
    for s in settings:
        turn = np.diag(np.r_[scale / np.array(s.deviation), 1.0])
        turn[-1, :-1] = (center - np.array(s.mean)) / np.array(s.deviation)
        turns.append(turn)
    weights = np.column_stack([t @ theta for t, theta in zip(turns, thetas)])
    upper = np.triu_indices(d)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 + d + len(upper[0]), len(folds)))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in columns])
            y, k = (batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in (label, fold))
            z = np.c_[(x - center) / scale, np.ones(len(x))]
            margin, own = z @ weights, k[:, None] != folds
            e = np.exp(-np.abs(margin))
            p = np.where(margin >= 0, 1.0, e) / (1 + e)
            total[0] += ((np.maximum(margin, 0) + np.log1p(e) - y[:, None] * margin) * own).sum(0)
            total[1:1 + d] += z.T @ ((p - y[:, None]) * own)
            total[1 + d:] += (z[:, upper[0]] * z[:, upper[1]]).T @ (p * (1 - p) * own)
        at, value = np.indices(total.shape).reshape(2, -1), total.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(at[1].astype("int32")), pa.array(at[0].astype("int32")), pa.array(value)], names=["m", "at", "v"])
    sums = data.select(*columns, label, fold).mapInArrow(add, "m int, at int, v double").groupBy("m", "at").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((len(folds), 1 + d + len(upper[0])))
    for r in sums:  # a fixed number of rows: settings x (1 + d + d (d + 1) / 2)
        out[r.m, r.at] = r.v
    for total, turn in zip(out, turns):
        hessian = np.zeros((d, d))
        hessian[upper] = total[1 + d:]
        total[1:1 + d] = turn.T @ total[1:1 + d]
        total[1 + d:] = (turn.T @ (hessian + np.triu(hessian, 1).T) @ turn)[upper]
    return list(out)


def newton_fits(data: DataFrame, features: Sequence[str], label: str, fold: str, settings: Sequence[Setting],
                max_steps: int = MAX_STEPS) -> list[np.ndarray]:
    """Weights (of the standardised features, then the intercept) that minimise
    the objective of each setting over the rows outside its fold."""
    d = len(features) + 1
    upper, ridge = np.triu_indices(d), np.r_[np.ones(d - 1), 0.0]
    best = [np.zeros(d) for _ in settings]
    value, step = [np.inf] * len(settings), [np.zeros(d) for _ in settings]
    open_ = list(range(len(settings)))
    for _ in range(max_steps):
        tries = [best[m] + step[m] for m in open_]
        on = []
        for m, theta, total in zip(list(open_), tries, _sums(data, features, label, fold, [settings[m] for m in open_], tries)):
            s = settings[m]
            objective = s.c * total[0] + 0.5 * (ridge * theta) @ theta
            if not objective <= value[m]:  # too far: half the step
                step[m] = step[m] / 2
                if np.abs(step[m]).max() > 1e-12:
                    on.append(m)
                continue
            gain, value[m], best[m] = value[m] - objective, objective, theta
            gradient = s.c * total[1:1 + d] + ridge * theta
            if np.abs(gradient).max() <= TOLERANCE * s.c * max(s.n, 1) or gain <= GAIN * abs(objective):
                continue
            hessian = np.zeros((d, d))
            hessian[upper] = s.c * total[1 + d:]
            hessian = hessian + np.triu(hessian, 1).T + np.diag(ridge + 1e-12)
            step[m] = -np.linalg.solve(hessian, gradient)
            on.append(m)
        open_ = on
        if not open_:
            break
    return best


def fold_accuracies(data: DataFrame, features: Sequence[str], label: str, fold: str, settings: Sequence[Setting],
                    thetas: Sequence[np.ndarray]) -> list[float | None]:
    """Share of the rows of its left-out fold that each fit predicts rightly
    (None without rows): one job for all."""
    columns, folds = list(features), [s.fold for s in settings]
    weights = np.array([s.raw(t) for s, t in zip(settings, thetas)])

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, rows = np.zeros(len(folds), dtype=np.int64), np.zeros(len(folds), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in columns])
            y, k = (batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in (label, fold))
            own = k[:, None] == np.array(folds)
            right += (((x @ weights[:, :-1].T + weights[:, -1] > 0) == (y[:, None] > 0.5)) & own).sum(0)
            rows += own.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(folds), dtype="int32")), pa.array(right), pa.array(rows)], names=["m", "hits", "n"])
    found = data.select(*columns, label, fold).mapInArrow(hits, "m int, hits bigint, n bigint").groupBy("m").agg(
        F.sum("hits").alias("hits"), F.sum("n").alias("n")).collect()
    out: list[float | None] = [None] * len(folds)
    for r in found:
        out[r.m] = r.hits / r.n if r.n else None
    return out
