import collections
import re

import numpy as np

from matchforge.llm.quality import BASE, RULES, fit, keep_quality, posterior, quality_verdicts
from tests.llm.conftest import ODD_ROWS


def base(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    count = collections.Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    inside = {j for k in range(len(w) - 4) if count[tuple(w[k:k + 5])] > 1 for j in range(k, k + 5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside))


def test_base_counts(documents, texts):
    for r in quality_verdicts(documents).collect():
        got = tuple(r[c] for c in BASE)
        assert got == base(texts[r["doc_id"]])
        assert r["base_failed"] == (got[0] < 10 or 100 * got[4] > 20 * got[0])
        assert r["kept"] == (not r["base_failed"] and r["p_quality"] >= 0.5)


def test_em_finds_planted_accuracies():
    rng = np.random.default_rng(2)
    y = rng.random(20_000) < 0.8
    right = np.array([0.95, 0.9, 0.85, 0.9])
    votes = np.where(rng.random((len(y), 4)) < right, y[:, None], ~y[:, None]) * 2 - 1
    votes[rng.random(votes.shape) < 0.2] = 0
    patterns, count = np.unique(votes, axis=0, return_counts=True)
    model = fit(patterns, count.astype(float))
    assert abs(model["good"] - y.mean()) < 0.03
    theta = model["theta"]  # of those that vote
    assert np.allclose(theta[:, 1, 2] / (theta[:, 1, 0] + theta[:, 1, 2]), right, atol=0.03)
    assert ((posterior(votes, model) >= 0.5) == y).mean() > 0.95


def test_fit_equals_plain_em():
    """The same steps, rule by rule and row by row."""
    votes, count = np.array([[1, 1], [1, 0], [-1, 1], [-1, -1]]), np.array([50.0, 20.0, 5.0, 9.0])
    start = {0: {-1: 0.4, 0: 0.2, 1: 0.4}, 1: {-1: 0.01, 0: 0.09, 1: 0.9}}
    theta, good = [{y: dict(start[y]) for y in start} for _ in range(2)], 0.85
    for _ in range(3):
        post = []
        for row in votes:
            a = good * np.prod([theta[r][1][v] for r, v in enumerate(row)])
            b = (1 - good) * np.prod([theta[r][0][v] for r, v in enumerate(row)])
            post.append(a / (a + b))
        for r in range(2):
            for y in (0, 1):
                w = [(p if y else 1 - p) * n for p, n in zip(post, count)]
                seen = {v: sum(x for x, row in zip(w, votes) if row[r] == v) + start[y][v] for v in (-1, 0, 1)}
                theta[r][y] = {v: seen[v] / sum(seen.values()) for v in seen}
        good = (sum(p * n for p, n in zip(post, count)) + 0.85) / (count.sum() + 1)
    model = fit(votes, count, rounds=3)
    assert np.isclose(model["good"], good)
    assert np.allclose(model["theta"], [[[theta[r][y][v] for v in (-1, 0, 1)] for y in (0, 1)] for r in range(2)])


def test_agrees_with_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r[0]: r[1] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality").collect()}
    rows = [r for r in quality_verdicts(docs).collect() if r["doc_id"] in labels]
    good = [r["kept"] for r in rows if labels[r["doc_id"]] == 1 and not r["base_failed"]]
    bad = [r["kept"] for r in rows if labels[r["doc_id"]] == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.05 * len(bad)


def test_odd_rows(odd, none):
    out = quality_verdicts(odd).collect()
    assert len(out) == len(ODD_ROWS)
    assert sorted(tuple(r[c] for c in BASE) for r in out) == sorted(base(r[1]) for r in ODD_ROWS)
    assert quality_verdicts(none).count() == 0
    kept = keep_quality(odd)
    assert kept.columns == odd.columns and keep_quality(none).count() == 0
    assert len(RULES) == 11
