import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from xxhash import xxh64_intdigest

import matchforge.llm.sp_dropout as S
from tests.llm.conftest import ODD_ROWS, words

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", "▁", "a▁b  c ", "\n\n  \n", "\u0000😀", " lead", " \t\r x", "é" * 300, None, "x" * 5000]


@pytest.fixture(scope="module")
def model():
    return S.model(PATH)


def test_without_dropout_equals_the_library(model, texts):
    some = list(texts.values())[:60]
    got = S.encode(model, some, np.arange(len(some)), 7, 0.0, 1)
    lib = sentencepiece.SentencePieceProcessor(model_file=PATH).encode(some)
    assert [x.tolist() for x in got] == lib


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.6, 1.0])
def test_rounds_equal_the_heap_agenda(model, rate, monkeypatch):
    monkeypatch.setattr(S, "LONG", 100)
    ws = sorted(set(words(3, 400, "abthe▁é😀ingor").split()))
    keys = np.array([xxh64_intdigest(w, 5) for w in ws], dtype=np.uint64)
    limit = min(int(rate * 2**64), S.MASK)
    ws += ["x" * 150 + ws[0]]  # one that takes the heap
    keys = np.r_[keys, keys[:1]]
    flat, n = S.cut_words(model, ws, keys, limit)
    want = [S._bytes(model, S.agenda(model, w, int(k), limit))[0].tolist() for w, k in zip(ws, keys)]
    assert [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])] == want


def brute(model, word, key, limit):
    """Best allowed merge of the whole word, again and again."""
    parts = [(i, i + 1, int(model.of_char[ord(c)])) for i, c in enumerate(word)]
    while True:
        best = None
        for k, ((a, b, x), (_, c, y)) in enumerate(zip(parts, parts[1:])):
            hit = model.pairs.get(x * model.k + y) if x >= 0 and y >= 0 else None
            if hit and S._mix1(S._mix1(S._mix1(key ^ a) ^ b) ^ c) >= limit and (best is None or hit[0] > best[0]):
                best = (hit[0], k, (a, c, hit[1]))
        if best is None:
            break
        parts[best[1]:best[1] + 2] = [best[2]]
    out = []
    for a, b, x in parts:
        out += [x] if 0 <= x < model.size else [-1 - ord(c) for c in word[a:b]]
    return out


def test_agenda_equals_brute_force(model):
    for w in sorted(set(words(4, 80, "theing a"))):
        for limit in (0, 1 << 62, 1 << 63):
            assert S.agenda(model, w, 99, limit) == brute(model, w, 99, limit)


def test_round_trip_and_variation(model, texts):
    some = [*list(texts.values())[:40], *ODD]
    ids = np.arange(len(some))
    one, two = (S.encode(model, some, ids, seed, 0.2, 4) for seed in (1, 2))
    again = S.encode(model, some, ids, 1, 0.2, 4)
    for t, a, b, c in zip(some, one, two, again):
        assert S.decode(model, a) == S.decode(model, b) == (t or "")
        assert a.tolist() == c.tolist()
    assert sum(a.tolist() != b.tolist() for a, b in zip(one, two)) >= 40


def test_odd_rows(odd, none):
    out = S.encode_documents(odd, PATH).toPandas()
    assert len(out) == len(ODD_ROWS) and out.lossless.all()
    assert out[out.doc_id == 3].n_pieces.tolist() == [0]
    assert S.encode_documents(none, PATH).count() == 0


def test_every_occurrence_draws_its_own_merges(model, texts):
    """A frequent word gets more than four cuts, and each occurrence is what
    its own key gives."""
    got = S.encode(model, [" ".join(["understanding"] * 3000)], np.array([5]), 7, 0.1)[0]
    cut = " ".join(map(str, got.tolist()))
    assert len({tuple(x.split()) for x in cut.split(str(model.symbols["▁"]))}) > 4
    some, ids = [*list(texts.values())[:20], *ODD, "the the the the"], np.arange(20 + len(ODD) + 1)
    limit = int(0.3 * 2**64)
    for i, (t, a) in enumerate(zip(some, S.encode(model, some, ids, 7, 0.3))):
        want = []
        for k, w in enumerate(S.WORDS.findall(" " + t) if t else []):
            key = S._mix1(S._mix1(i ^ 7) ^ k)
            want += S._bytes(model, S.agenda(model, w, key, limit))[0].tolist()
        assert a.tolist() == want and S.decode(model, a) == (t or "")
    plain = S.encode(model, some, ids, 7, 0.0)
    assert [x.tolist() for x in plain] == [x.tolist() for x in S.encode(model, some, ids, 7, 0.0, 1)]


def test_trees_of_words_keep_every_cut(model, texts, monkeypatch):
    """Cuts from the words' trees are those of the agenda: over steps, with
    nodes that are dropped in between, at rates that go deep, and words met
    again are not cut again."""
    some, limit = [*list(texts.values())[:12], *ODD], int(0.4 * 2**64)
    paths = S.Paths(model, 300)
    monkeypatch.setitem(S._PATHS, model.path, paths)
    for step in range(4):
        ids = np.arange(len(some)) + 1000 * step
        for i, t, a in zip(ids.tolist(), some, S.encode(model, some, ids, 7, 0.4)):
            want = []
            for k, w in enumerate(S.WORDS.findall(" " + t) if t else []):
                want += S._bytes(model, S.agenda(model, w, S._mix1(S._mix1(i ^ 7) ^ k), limit))[0].tolist()
            assert a.tolist() == want
    assert (paths.up < np.arange(len(paths.up))).all() and len(paths.ids) == paths.n_ids.sum()
    monkeypatch.setitem(S._PATHS, model.path, S.Paths(model))
    plain = S.encode(model, some * 2, np.arange(2 * len(some)), 7, 0.0)
    calls = []
    monkeypatch.setattr(S, "rounds", lambda *x: calls.append(x))
    again = S.encode(model, some[:12], np.arange(12), 7, 0.0)
    assert not calls and [x.tolist() for x in again] == [x.tolist() for x in plain[:12]]
