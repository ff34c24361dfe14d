import random

import pytest

from matchforge.llm.decontaminate import RATE, Matcher, anchored, decontaminate, leaks, masks, myers, normal, pieces
from tests.llm.conftest import words


def distances(item, text):
    """Sellers' table: least edit distance to a substring ending at each place."""
    row = list(range(len(item) + 1))
    out = [row[-1]]
    for c in text:
        new = [0]
        for i, d in enumerate(item, 1):
            new.append(min(row[i] + 1, new[i - 1] + 1, row[i - 1] + (d != c)))
        row = new
        out.append(row[-1])
    return out


def test_myers_equals_the_table():
    r = random.Random(1)
    for _ in range(150):
        item = "".join(r.choice("abc ") for _ in range(r.randint(1, 90)))
        text = "".join(r.choice("abc ") for _ in range(r.randint(0, 120)))
        want = distances(item, text)
        d, end = myers(masks(item), len(item), text)
        assert d == min(want) and (d == len(item) or want[end] == d)
        prefix = [distances_anchored(item, text[:k]) for k in range(len(text) + 1)]
        d, n = anchored(masks(item), len(item), text)
        assert d == min(prefix) and prefix[n] == d


def distances_anchored(a, b):
    row = list(range(len(a) + 1))
    for j, c in enumerate(b, 1):
        new = [j]
        for i, d in enumerate(a, 1):
            new.append(min(row[i] + 1, new[i - 1] + 1, row[i - 1] + (d != c)))
        row = new
    return row[-1]


def edited(r, text, n):
    for _ in range(n):
        k = r.randrange(len(text))
        text = r.choice([text[:k] + "z" + text[k:], text[:k] + text[k + 1:], text[:k] + "q" + text[k + 1:]])
    return text


def test_pigeonhole_finds_all_within_the_budget():
    r = random.Random(2)
    items = [(k, words(k, 30)) for k in range(12)]
    m = Matcher(items, RATE)
    for k, text in items:
        budget = int(RATE * len(normal(text)))
        assert "".join(p for _, p in pieces(text, budget)) == text and len(pieces(text, budget)) == budget + 1
        for n in (0, 1, budget, 3 * budget):
            doc = words(100 + k, 20) + " " + edited(r, text, n).upper() + "\n" + words(200 + k, 20)
            want = {i: min(distances(normal(t), normal(doc))) for i, t in items}
            want = {i: d for i, d in want.items() if d <= int(RATE * len(normal(items[i][1])))}
            got = {i: d for i, d, _, _ in m.find(doc)}
            assert got == want and (n > budget // 2 or k in got)  # an edit beside a space may count twice
            for i, d, a, b in m.find(doc):
                assert distances_anchored(normal(items[i][1]), normal(doc)[a:b]) == d


@pytest.fixture()
def items(spark):
    return spark.createDataFrame([(1, words(6, 40)), (2, None), (None, words(77, 30)), (4, ""), (5, words(78, 30))],
                                 "item_id long, text string")


def test_documents_equal_brute_force(spark, documents, texts):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    it = [(i, normal(t)) for i, t in bench.collect()]
    got = {(r["doc_id"], r["item_id"]) for r in leaks(documents, bench).collect()}
    assert {(d, i) for d, x in texts.items() for i, t in it if t in normal(x)} <= got
    for d, i in got:
        t = dict(it)[i]
        assert min(distances(t, normal(texts[d])[:20_000])) <= int(RATE * len(t))
    left = {r["doc_id"] for r in decontaminate(documents, bench).collect()}
    assert left == set(texts) - {d for d, _ in got}


def test_odd_rows(odd, none, items):
    out = leaks(odd, items).collect()
    assert [(r["doc_id"], r["item_id"], r["distance"], r["start"]) for r in out] == [(6, 1, 0, 0)]
    assert decontaminate(odd, items).columns == odd.columns
    assert decontaminate(odd, items).count() == odd.count() - 1
    assert leaks(none, items).count() == 0 and leaks(odd, items.where("false")).count() == 0
    assert decontaminate(odd, items.where("false")).count() == odd.count()
