import zlib

import numpy as np
import pyarrow as pa
import pytest

from matchforge.llm.toxicity import FEATURES, features, toxicity_scores
from tests.llm.conftest import ODD_ROWS

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity_scores(docs, labels).toPandas(), labels.toPandas()


def test_held_out_accuracy(scored):
    out, labels = scored
    m = out.merge(labels, on="doc_id")
    m = m[m.held_out]
    bad, good = (m.score[m.toxic == y].to_numpy() for y in (1, 0))
    assert np.mean([(x > good).mean() + (x == good).mean() / 2 for x in bad]) > 0.95
    assert (bad >= 0.5).mean() > 0.85 and (good >= 0.5).mean() < 0.02
    assert abs(m.score.mean() - m.toxic.mean()) < 0.03  # calibrated


def test_shape(scored):
    out, _ = scored
    assert len(out) == 10_000 and out.doc_id.is_unique
    assert out.score.between(0, 1).all() and ((out.score >= 0.5) == (out.predicted == 1)).all()
    assert all((zlib.crc32(str(i).encode()) % 5 == 0) == h for i, h in zip(out.doc_id, out.held_out))


def test_features():
    x = features(pa.array(["You IDIOT, you id1ot!!", "a fine day for all of us", None, ""]), {"=idiot": 5.0, "<fine": 1.5})
    f = [dict(zip(FEATURES, row)) for row in x]
    assert f[0]["strong_share"] == 0.5 and f[0]["odds_max"] == 5 and f[0]["near_you"] == 0.5 and f[0]["you_share"] == 0.5
    assert f[0]["obfuscated_share"] == 0.25 and np.isclose(f[0]["obfuscated_strong"], np.log(2)) and f[0]["shout_rate"] == 0.5
    assert f[0]["capital_words"] == 0.25
    assert f[1]["strong_share"] == 0 and not x[2].any() and not x[3].any()


def test_held_out_labels_are_not_learned(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    held = [r["doc_id"] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    flipped = labels.withColumn("toxic", (1 - labels["toxic"]) * labels["doc_id"].isin(held).cast("int")
                                + labels["toxic"] * (~labels["doc_id"].isin(held)).cast("int"))
    a, b = (sorted(map(tuple, toxicity_scores(documents, x).collect())) for x in (labels, flipped))
    assert a == b


def test_odd_rows(spark, odd, none):
    one = spark.createDataFrame([(1, 1), (2, None), (None, 1), (99, 0), (6, 0)], "doc_id long, toxic int")
    out = toxicity_scores(odd, one).toPandas()
    assert len(out) == len(ODD_ROWS) and out.score.between(0, 1).all()
    assert toxicity_scores(odd, one.where("false")).toPandas().score.eq(0).all()
    assert toxicity_scores(none, one).count() == 0
