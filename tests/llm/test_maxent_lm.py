import collections
import math
import re

import numpy as np
import pytest

import matchforge.llm.maxent_lm as L
from tests.llm.conftest import ODD_ROWS


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def check_base(out, rows):
    """Counts and the unigram score against counting on the driver."""
    count = collections.Counter(w for i, t in rows if not L.held_out(i) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    want = []
    for i, t in rows:
        w = tokens(t)
        want.append((-1 if i is None else i, L.held_out(i), len(w), sum(count[x] > 0 for x in w), n,
                     sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w)))
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], *tuple(r)[1:6]) for r in out)
    for a, b in zip(sorted(want), got):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-9)
    assert len(want) == len(got)


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return L.lm_scores(docs).collect(), docs.select("doc_id", "text").collect()


def test_base_score(scored):
    check_base(*scored)


def test_better_than_unigrams_on_held_out_texts(scored):
    held = [r for r in scored[0] if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert np.mean([r["score"] > r["base_score"] for r in held]) > 0.9
    assert all(r["score"] < 0 for r in scored[0])


def test_gradient_step_equals_finite_differences():
    rng = np.random.default_rng(3)
    w = L.Weights(rng.normal(size=5), rng.normal(size=(L.ROWS, 5)) / 10)
    at, y = rng.integers(0, 40, (30, L.FEATURES)).astype(np.int32), rng.integers(0, 5, 30)
    loss = lambda m: -m.log_softmax(at)[np.arange(30), y].astype(np.float64).sum()
    before = w.rows.astype(np.float64)
    grown = np.full(L.ROWS, 1e12, dtype=np.float32)
    moved = L.Weights(w.bias, w.rows.copy())
    moved.rows = moved.rows.astype(np.float64)
    moved.step(at, y, grown, 1.0)
    step = (moved.rows - before) * -1e6
    for r in range(0, 40, 7):
        for k in range(5):
            up, down = (L.Weights(w.bias, w.rows.copy()) for _ in range(2))
            up.rows, down.rows = up.rows.astype(np.float64), down.rows.astype(np.float64)
            up.rows[r, k] += 1e-3
            down.rows[r, k] -= 1e-3
            assert abs((loss(up) - loss(down)) / 2e-3 - step[r, k]) < 2e-2


def test_probabilities_sum_to_one(spark, texts):
    """Over all events after one context: every known word, the end, unknown."""
    train = [(i, t) for i, t in sorted(texts.items()) if not L.held_out(i)][:30]
    count = collections.Counter(w for _, t in train for w in tokens(t) if w)
    held = next(i for i in range(10_000, 20_000) if L.held_out(i))
    probes = [w for w, _ in count.items()] + ["neverseenbefore"]
    ids = [i for i in range(held, held + 10 * len(probes)) if L.held_out(i)][:len(probes)]
    rows = train + list(zip(ids, probes))
    end = [(next(i for i in range(90_000, 99_000) if L.held_out(i)), "")]
    # A probe's score holds the word after the start and the end after the word;
    # without training the context weights are zero, and the end's part cancels.
    docs = spark.createDataFrame(rows + end, "doc_id long, text string")
    out = {r["doc_id"]: r["score"] for r in L.lm_scores(docs, rate=0.0).collect()}
    p_end = 10 ** out[end[0][0]]
    total = sum(10 ** out[i] for i in ids) / p_end + p_end
    assert abs(total - 1) < 1e-3


def test_odd_rows(odd, none):
    check_base(L.lm_scores(odd).collect(), [(r[0], r[1]) for r in ODD_ROWS])
    assert L.lm_scores(none).count() == 0


def test_endings_of_all_classes_are_told_apart(spark):
    """Two words whose endings share a class of six but not one of twelve:
    each is likelier behind its own context."""
    import zlib
    kind = {e: zlib.crc32(e.encode()) for e in (a + b for a in "abcdefgh" for b in "abcdefgh")}
    one, two = next((x, y) for x in kind for y in kind if kind[x] % 6 == kind[y] % 6 and kind[x] % 12 != kind[y] % 12)
    train = [i for i in range(4000) if not L.held_out(i)]
    rows = [(i, f"left word{one}" if i % 2 else f"right word{two}") for i in train]
    own, other = [i for i in range(5000, 6000) if L.held_out(i)][:2]
    rows += [(own, f"left word{one}"), (other, f"left word{two}")]
    out = {r["doc_id"]: r["score"] for r in L.lm_scores(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    assert out[own] > out[other] + 0.1


def test_segment_sums_and_log_given():
    rng = np.random.default_rng(5)
    g, size = rng.normal(size=(500, 7)).astype(np.float32), np.array([1, 2, 40, 1, 16, 17, 15, 300, 3])
    who, first = rng.integers(0, 500, size.sum()), np.cumsum(size) - size
    assert np.allclose(L.sums_of(g, who, first), np.add.reduceat(g[who], first, axis=0), atol=1e-3)
    w = L.Weights(rng.normal(size=5), rng.normal(size=(L.ROWS, 5)))
    at, y = rng.integers(0, L.ROWS, (30, L.FEATURES)), rng.integers(0, 5, 30)
    assert np.allclose(w.log_given(at, y), w.log_softmax(at)[np.arange(30), y], atol=1e-5)
