import numpy as np

from matchforge.operators.model import fit, sample_candidates, score, tune_and_fit


def _data(spark, n=300, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * np.array([1.0, 5.0, 0.5]) + np.array([0.0, 10.0, -2.0])
    logits = 0.8 * x[:, 0] - 0.3 * (x[:, 1] - 10) / 5 + 1.5 * x[:, 2] + 2.0
    y = (rng.random(n) < 1 / (1 + np.exp(-logits))).astype(int)
    rows = [(float(a), float(b), float(c), 7, int(t)) for (a, b, c), t in zip(x, y)]
    return x, y, spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, c DOUBLE, const INT, outcome_id INT")


def _newton(z, y, c_value):
    """Direct solve of ½‖w‖² + C·Σ logloss (intercept unpenalised)."""
    X = np.hstack([np.ones((len(z), 1)), z])
    w = np.zeros(X.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-X @ w))
        reg = np.r_[0.0, w[1:]]
        g = c_value * X.T @ (p - y) + reg
        H = c_value * (X.T * (p * (1 - p))) @ X + np.diag(np.r_[0.0, np.ones(len(w) - 1)])
        w -= np.linalg.solve(H, g)
    return w


def test_coefficients_match_direct_solve(spark):
    x, y, df = _data(spark)
    model = fit(df, 1.0, features=["a", "b", "c", "const"])
    lr = model.stages[-1]
    z = (x - x.mean(axis=0)) / x.std(axis=0)          # population std
    z = np.hstack([z, np.zeros((len(z), 1))])           # constant column -> 0
    w = _newton(z, y, 1.0)
    got = np.r_[lr.intercept, lr.coefficients.toArray()]
    assert np.allclose(got, w, atol=1e-4)


def test_tuning_null_for_invalid_c_and_repeatable(spark):
    _, _, df = _data(spark, n=200)
    r1 = tune_and_fit(df, candidates=[0.0, 0.5, 2.0], seed=1)
    r2 = tune_and_fit(df, candidates=[0.0, 0.5, 2.0], seed=1)
    assert r1.scores[0.0] is None and r1.best_c in (0.5, 2.0)
    assert r1.scores == r2.scores
    out = score(r1.model, df, keep=["outcome_id"])
    assert set(r.predicted for r in out.collect()) <= {"win", "loss"}
    assert sample_candidates(5) == sample_candidates(5)


def test_saved_model_scores_the_same(spark, workdir):
    from matchforge.operators.load import load_model, save_model
    _, _, df = _data(spark, n=120)
    model = fit(df, 1.0)
    save_model(model, f"{workdir}/model")
    again = load_model(f"{workdir}/model")
    a = [r.prediction for r in score(model, df).collect()]
    b = [r.prediction for r in score(again, df).collect()]
    assert a == b


def test_score_job_batch_and_stream(spark, workdir):
    import json
    import os

    from matchforge.operators.load import save_model
    from matchforge.plans import score_job
    _, _, df = _data(spark, n=120)
    model = fit(df, 1.0)
    save_model(model, f"{workdir}/m")
    assert score_job.model_features(model) == ["a", "b", "c", "const"]
    os.makedirs(f"{workdir}/req")
    with open(f"{workdir}/req/r.json", "w") as f:
        for a in (0.0, 2.0, -2.0):
            f.write(json.dumps({"a": a, "b": 10.0, "c": -2.0, "const": 7}) + "\n")
        f.write('garbage\n{"a": 1.0}\n')
    score_job.main(["--model", f"{workdir}/m", "--requests", f"{workdir}/req",
                    "--out", f"{workdir}/out", "--rejects", f"{workdir}/bad"])
    got = spark.read.parquet(f"{workdir}/out").collect()
    assert len(got) == 5 and sorted(str(r.predicted) for r in got if r.b is None) == ["None", "None"]
    assert {r.predicted for r in got if r.b is not None} <= {"win", "loss"}
    assert sorted(r.value for r in spark.read.text(f"{workdir}/bad").collect()) == ['garbage', '{"a": 1.0}']
    score_job.main(["--model", f"{workdir}/m", "--requests", f"{workdir}/req",
                    "--out", f"{workdir}/out_s", "--stream", "--checkpoint", f"{workdir}/ck"])
    assert spark.read.parquet(f"{workdir}/out_s").count() == 5


def test_equal_rows_are_dealt_over_all_folds(spark):
    from matchforge.operators.model import cross_validate, with_folds
    rows = [(1.0, 0)] * 90 + [(2.0, 1)] * 91
    df = spark.createDataFrame(rows, "a DOUBLE, outcome_id INT")
    sizes = {(r.outcome_id, r._fold): r["count"] for r in with_folds(df).groupBy("outcome_id", "_fold").count().collect()}
    assert sizes == {(0, 0): 30, (0, 1): 30, (0, 2): 30, (1, 0): 31, (1, 1): 30, (1, 2): 30}
    scores = cross_validate(df, [0.0, 1.0])
    assert scores[0.0] is None and scores[1.0] == 1.0


def test_a_score_that_is_not_finite_never_wins():
    import pytest

    from matchforge.operators.model import best_candidate
    assert best_candidate({0.0: None, 0.5: float("nan"), 1.0: 0.6, 2.0: 0.6}) == 1.0
    with pytest.raises(ValueError):
        best_candidate({0.5: float("nan")})


def test_rows_with_nulls_are_left_out_and_counted(spark):
    _, _, df = _data(spark, n=90)
    bad = spark.createDataFrame([(None, 1.0, 1.0, 7, 1), (1.0, 1.0, 1.0, 7, None)], df.schema)
    whole, with_bad = (tune_and_fit(x, candidates=[1.0], seed=1) for x in (df, df.unionByName(bad)))
    assert with_bad.incomplete == 2 and whole.incomplete == 0
    assert np.allclose(whole.model.stages[-1].coefficients.toArray(), with_bad.model.stages[-1].coefficients.toArray())


def test_newton_fits_equal_the_library_fits(spark):
    """Every (fold, C) against a fit of the library on the same rows."""
    from pyspark.sql import functions as F

    from matchforge.operators.model import cross_validate, merged, moments, with_folds
    from matchforge.operators.search import Setting, newton_fits
    _, _, df = _data(spark, n=240)
    features, data = ["a", "b", "c", "const"], with_folds(df, seed=4)
    rows = data.collect()
    assert sorted((r.a, r.b) for r in rows) == sorted((r.a, r.b) for r in df.collect())
    parts = {p["_fold"]: p for p in moments(data, features, "_fold")}
    settings, want, scores = [], [], {}
    for f in range(3):
        stats = merged([p for k, p in parts.items() if k != f], features)
        for c in (0.5, 4.0):
            settings.append(Setting(f, c, tuple(stats[f"m_{x}"] for x in features), tuple(stats[f"v_{x}"] ** 0.5 or 1.0 for x in features), stats["_n"]))
            model = fit(data.where(F.col("_fold") != f).drop("_fold"), c)
            want.append(np.r_[model.stages[-1].coefficients.toArray(), model.stages[-1].intercept])
            hit = model.transform(data.where(F.col("_fold") == f)).agg(F.avg((F.col("prediction") == F.col("outcome_id")).cast("double"))).first()[0]
            scores.setdefault(c, []).append(hit)
    got = newton_fits(data, features, "outcome_id", "_fold", settings)
    assert np.allclose(got, want, atol=1e-4)
    assert cross_validate(df, [0.0, 0.5, 4.0], seed=4) == {0.0: None, **{c: sum(a) / 3 for c, a in scores.items()}}


def test_newton_steps_that_overshoot_are_halved(spark):
    """Classes that a feature separates, an outlier and a large C, where plain
    steps diverge: the gradient still ends near zero."""
    from matchforge.operators.search import Setting, newton_fits
    x = np.array([*range(30), *range(100, 129), 1e4])
    y = np.r_[np.zeros(30), np.ones(30)]
    df = spark.createDataFrame([(float(a), float(b), -1) for a, b in zip(x, y)], "a double, outcome_id double, _fold int")
    s = Setting(None, 1000.0, (float(x.mean()),), (float(x.std()),), 60)
    theta = newton_fits(df, ["a"], "outcome_id", "_fold", [s])[0]
    z = np.c_[(x - x.mean()) / x.std(), np.ones(60)]
    p = 1 / (1 + np.exp(-z @ theta))
    assert np.abs(s.c * z.T @ (p - y) + [theta[0], 0]).max() < 1e-4 * s.c
    w = s.raw(theta)
    assert np.allclose(x * w[0] + w[1], z @ theta)


def test_hundred_thousand_equal_rows_stay_spread(spark):
    from pyspark.sql import functions as F

    from matchforge.operators.model import with_folds
    df = spark.range(0, 100_000, 1, 8).select(F.lit(1.0).alias("a"), (F.col("id") % 2).cast("int").alias("outcome_id"))
    out = with_folds(df)
    assert "Exchange rangepartitioning" not in out._jdf.queryExecution().toString()
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 4 and max(sizes) <= 25_000
    assert sorted(r["count"] for r in out.groupBy("outcome_id", "_fold").count().collect()) == [16_666, 16_666, 16_667, 16_667, 16_667, 16_667]
