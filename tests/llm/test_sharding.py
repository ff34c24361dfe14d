import zlib

import numpy as np

from matchforge.llm.sharding import pack, shards_by_bytes
from tests.llm.conftest import ODD_ROWS


def brute_pack(vectors, residual, totals, weights=(4.0, 1.0, 1.0)):
    order = sorted(range(len(vectors)), key=lambda i: (-max(v / t for v, t in zip(vectors[i], totals)), i))
    out = {}
    for i in order:
        dots = [sum(w * (v / t) * (r / t) for w, v, r, t in zip(weights, vectors[i], res, totals)) for res in residual]
        s = max(range(len(dots)), key=lambda k: (round(dots[k], 15), -k))
        out[i] = s
        residual[s] = [r - v for r, v in zip(residual[s], vectors[i])]
    return [out[i] for i in range(len(vectors))]


def test_pack_follows_the_dot_product():
    v = np.random.default_rng(1).integers(1, 1000, (60, 3)).astype(float)
    totals = v.sum(axis=0)
    residual = np.tile(totals / 4, (4, 1))
    assert pack(v, residual.copy(), totals).tolist() == brute_pack(v.tolist(), residual.tolist(), totals.tolist())


def test_all_rows_near_equal_shards(documents, texts):
    out = shards_by_bytes(documents).toPandas()
    assert sorted(out.doc_id) == sorted(texts)
    for r in out.itertuples():
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
    for _, g in out.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    bytes_ = out.groupby("shard")["size"].sum()
    assert len(bytes_) == 8 and bytes_.max() - bytes_.min() <= 0.1 * bytes_.mean()
    assert out.assign(t=out.doc_id.map(texts)).groupby("t").shard.nunique().max() == 1
    assert set(out.law) == {"bytes"} and out.grown_shard.isna().all()


def test_hot_group_is_split(spark):
    rows = [(i, "the same text over and over") for i in range(600)] + [(1000 + i, f"text number {i} " * 3) for i in range(600)]
    out = shards_by_bytes(spark.createDataFrame(rows, "doc_id long, text string"), shards=4).toPandas()
    assert len(out) == 1200 and out.doc_id.is_unique
    size = out.groupby("shard")["size"].sum()
    assert size.max() <= 1.05 * size.min()


def test_odd_rows(odd, none):
    out = shards_by_bytes(odd, shards=3).toPandas()
    assert len(out) == len(ODD_ROWS)
    for _, g in out.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    assert out[out.doc_id == 3]["size"].tolist() == [1]
    assert shards_by_bytes(none).count() == 0
