import random
import re
import zlib
from collections import Counter

import pytest

import matchforge.llm.spelling_variants as spelling
from matchforge.llm.spelling_variants import Index, near_words, roots, spelling_groups

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    n = Counter()
    for i, text in rows:
        for w in RUN.findall(text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            n[w if h % 199 else w[:h % len(w)] + w[h % len(w) + 1:]] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    near = {w: [v for v in n if is_near(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])
    return sorted((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n)


def corpus(seed):
    r = random.Random(seed)
    base = ["".join(r.choice(["an", "er", "é", "ß", "th", "o", "×"]) for _ in range(r.randint(4, 6))) for _ in range(40)]
    words = []
    for w in base:
        for _ in range(4):
            k = r.randrange(len(w))
            words.append(r.choice([w, w[:k] + w[k + 1:], w[:k] + r.choice("aeé") + w[k:], w[:k] + r.choice("tnß") + w[k + 1:]]))
        words += [w] * r.choice([1, 5, 30])
    seps = [" ", ", ", "œ", "1", "_", "日", "\n"]
    return [(i if i % 17 else None, "".join(r.choice(words) + r.choice(seps) for _ in range(r.randint(0, 200))).title() if i % 5 else None if i % 10 else "")
            for i in range(150)]


def result(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(spark, seed):
    rows = corpus(seed)
    want = brute(rows)
    assert len(want) > 100 and any(r[1] for r in want)
    assert result(spelling_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))) == want


@pytest.mark.parametrize("alphabet", ["ab", "abcé"])
def test_schemes_find_near_words_by_the_shared_half(alphabet):
    for seed in range(40):
        r = random.Random(seed)
        words = sorted({"".join(r.choice(alphabet) for _ in range(r.randint(6, 9))).encode("latin1") for _ in range(50)})
        index = Index(words)
        for right in (False, True):
            q, v = index.near(words, right)
            want = {(a, b) for a in words for b in words if a != b and is_near(a, b)
                    and (b.endswith(a[len(a) // 2:]) if right else b.startswith(a[:len(a) // 2]))}
            got = [(words[i], index.words[j]) for i, j in zip(q.tolist(), v.tolist())]
            assert len(got) == len(set(got)) and set(got) == want


def test_unknown_letters_and_absent_words():
    index = Index([b"banana", b"bandana"])
    q, v = index.near([b"banena", b"zzzzzz", b"bonana", b"xandana"], False)
    assert [(q[i], index.words[v[i]]) for i in range(len(q))] == [(0, b"banana")]
    q, v = index.near([b"banena", b"zzzzzz", b"bonana", b"xandana"], True)
    assert sorted((q[i], index.words[v[i]]) for i in range(len(q))) == [(2, b"banana"), (3, b"bandana")]


def test_blocks_of_a_frequent_half(spark, monkeypatch):
    """All words share a half: it is cut into blocks, and no link is lost or doubled."""
    r = random.Random(5)
    words = {"abcd" + "".join(r.choice("xy") for _ in range(4)) for _ in range(40)} | {"".join(r.choice("xy") for _ in range(4)) + "efgh" for _ in range(40)}
    rows = [(w, 5 + k % 7) for k, w in enumerate(sorted(words))]
    monkeypatch.setattr(spelling, "BLOCK_WORDS", 4)
    got = {r.word: (r.n_near, r.near) for r in near_words(spark.createDataFrame(rows, "word string, n long")).collect()}
    n = dict(rows)
    for w in words:
        near = [v for v in words if v != w and is_near(w, v)]
        assert got[w] == (len(near), min(near, key=lambda v: (-n[v], v), default=None))


def test_roots_follow_long_chains(spark):
    rows = [(f"w{i}", f"w{i + 1}") for i in range(20)] + [(f"x{i}", "w3") for i in range(30)]
    assert dict(map(tuple, roots(spark.createDataFrame(rows, "word string, form string")).collect())) == {w: "w20" for w, _ in rows}


def test_odd_input_and_long_words(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert result(spelling_groups(odd)) == brute(rows)
    assert spelling_groups(none).collect() == []
    long = "ab" * 2_000
    rows = [(i, f"{long} {long[:-1]}c") for i in range(6)] + [(9, "x" * 9_000_000)]
    got = spelling_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert result(got) == brute(rows)
