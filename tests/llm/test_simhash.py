import random

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from matchforge.llm import simhash as S
from matchforge.llm.components import connected_components
from tests.llm.conftest import ODD_ROWS


def plain_print(text, shingle=3):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    grams = [b" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] or ([b" ".join(w)] if w else [])
    h = [xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(pairs):
    """rows (id, fingerprint) -> smallest reachable id of each row."""
    up = list(range(len(pairs)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(pairs)):
        for j in range(i):
            if (pairs[i][1] ^ pairs[j][1]).bit_count() <= 3:
                up[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(pairs):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return [low.get(root(i)) for i in range(len(pairs))]


def shown(rows):
    return sorted(map(str, rows))


def test_documents_equal_brute_force(documents, texts):
    pairs = [(i, plain_print(t)) for i, t in texts.items()]
    want = [(i, format(f, "016x"), c) for (i, f), c in zip(pairs, components(pairs))]
    assert shown(want) == shown(map(tuple, S.simhash_components(documents).collect()))


@pytest.mark.parametrize("n", [1, 64, 65, 300])
def test_planes(n):
    f = np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64)
    p = S.planes_of(f)
    assert all(int(p[b][i // 64]) >> i % 64 & 1 == int(f[i]) >> b & 1 for i in range(n) for b in range(64))


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_carry_save_counters(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**64, 6, dtype=np.uint64)
    f = np.array([base[i % 6] ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, i % 6, replace=False))) for i in range(150)], dtype=np.uint64)
    planes = S.planes_of(f)
    lanes = np.array([2**64 - 1, 2**64 - 1, 2**22 - 1], dtype=np.uint64)
    q, rows = np.repeat(f, 3), np.tile(np.arange(3), len(f))
    k, mask = S.within(planes, lanes, q, rows, radius)
    got = {(x // 3, 64 * (x % 3) + lane) for x, m in zip(k.tolist(), mask.tolist()) for lane in range(64) if m >> lane & 1}
    assert got == {(i, j) for i in range(150) for j in range(150) if (int(f[i]) ^ int(f[j])).bit_count() <= radius}


@pytest.mark.parametrize("block, mean", [(4096, 64), (7, 64), (50, 1)])
def test_links_connect_the_same(spark, block, mean, monkeypatch):
    """Hot buckets cut into chunk pairs, and more blocks that must agree, find
    the same components."""
    monkeypatch.setattr(S, "MEAN_BUCKET", mean / 2**16 if mean == 1 else mean)
    r = random.Random(4)
    near = r.getrandbits(64)
    fps = {r.getrandbits(64) for _ in range(200)} | {near ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 4))) for _ in range(200)}
    fps |= {r.getrandbits(16) for _ in range(100)}
    rows = [(x - 2**64 if x >= 2**63 else x,) for x in sorted(fps)]
    links = S.links_of(spark.createDataFrame(rows, "fp long").repartition(3), 3, block)
    root = {r["node"]: r["root"] for r in connected_components(links).collect()}
    want = components([(x[0], x[0] % 2**64) for x in rows])
    assert [root.get(x[0], x[0]) for x in rows] == want


def test_components(spark):
    r = random.Random(9)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 160)] + [(r.randint(200, 260), r.randint(200, 260)) for _ in range(40)]
    edges += [(5, 5), (None, 3), (7, None), (0, 1)]
    got = {x["node"]: x["root"] for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    near = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    for n in near:
        seen, todo = {n}, [n]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        assert got[n] == min(seen)
    assert got.keys() == near.keys()


def test_odd_rows(odd, none):
    pairs = [(r[0], plain_print(r[1])) for r in ODD_ROWS]
    want = [(i, format(f, "016x"), c) for (i, f), c in zip(pairs, components(pairs))]
    assert shown(want) == shown(map(tuple, S.simhash_components(odd).collect()))
    assert S.simhash_components(none).count() == 0


def test_one_of_each_group_stays(odd, none, documents, texts):
    pairs = [(i, plain_print(t)) for i, t in texts.items()]
    assert sorted(r["doc_id"] for r in S.near_dedup(documents).collect()) == sorted(set(components(pairs)))
    out = S.near_dedup(odd)
    assert out.columns == odd.columns
    ids = sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in out.collect())
    pairs = [(r[0], plain_print(r[1])) for r in ODD_ROWS]
    groups = {(c, f) if c is None else c for (_, f), c in zip(pairs, components(pairs))}
    assert len(ids) == len(groups) and S.near_dedup(none).count() == 0
