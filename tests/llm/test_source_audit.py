import heapq
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

import matchforge.llm.source_audit as audit
from matchforge.llm.source_audit import source_divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs=10, top=10):
    """rows (lang, source, text) -> the result's rows, by plain loops over all
    sources and kept terms."""
    n, df, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        words = TERM.findall((text or "").translate(LOWER))
        groups[lang].add(source)
        n[lang, source].update(words)
        df[lang].update(set(words))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, c in df[lang].items() if c >= min_docs]
        total = {s: sum(n[lang, s][t] for t in kept) for s in sources}
        everything = sum(total.values())
        p = {s: [1 + 10**9 * (n[lang, s][t] + 2) // (total[s] + 2 * len(kept)) for t in kept] for s in sources}
        q = [1 + 10**9 * (sum(n[lang, s][t] for s in sources) + 2) // (everything + 2 * len(kept)) for t in kept]
        for s in sources:
            pairs = [(-sum((a - b) ** 2 // (a + b) for a, b in zip(p[s], p[o])), o.encode()) for o in sources if o != s]
            terms = [(-((a - b) ** 2 // (a + b)), t.encode()) for t, a, b in zip(kept, p[s], q) if n[lang, s][t] and a > b]
            for part, items in (("pair", sorted(pairs)), ("term", heapq.nsmallest(top, terms))):
                out += [(lang, s, part, i.decode(), -v, k + 1) for k, (v, i) in enumerate(items)]
    return sorted(out)


def corpus(seed, docs=400, words=60):
    r = random.Random(seed)
    vocabulary = ["Été", "ÉTÉ", "naïve", "日本", "😀", "don't", "x1y", "The", "the"] + ["".join(r.choice("abcdefghij") for _ in range(3)) for _ in range(150)]
    langs, sources = ["en", "de", None, "a\tb"], ["s0", "s1", "S1", None, "é", "zz"]
    return [(r.choice(langs), r.choice(sources), None if r.random() < 0.02 else " ".join(r.choice(vocabulary[:r.randint(20, len(vocabulary))]) for _ in range(r.randint(0, words))))
            for _ in range(docs)] + [("only", "one", "few words"), ("two", "a", "x"), ("two", "b", "")]


def result(df):
    return sorted(map(tuple, df.collect()))


def frame(spark, rows, parts=5):
    return spark.createDataFrame(rows, "lang string, source string, text string").repartition(parts)


def test_equals_plain_loops(spark):
    rows = corpus(1)
    got = result(source_divergence(frame(spark, rows)))
    assert got == brute(rows)
    assert [r[4] for r in got if r[0] == "two"] == [0, 0]


def test_small_blocks_and_many_runs(spark, monkeypatch):
    """Blocks that leave after every step, chunks of a few postings, shards in
    one partition: the merge still sees every run."""
    rows = corpus(2, docs=120)
    block = audit.Block(3)
    runs = []
    for k in range(0, len(rows), 10):
        part = rows[k:k + 10]
        block.add([(t or "").encode() for _, _, t in part], [(a or "", b or "") for a, b, _ in part])
        monkeypatch.setattr(audit, "CHUNK", 7)
        runs += [c for b in block.run() for c in b.to_pylist()]
    assert len(runs) > 300
    runs.sort(key=lambda c: (c["shard"], c["lang"].encode(), c["first"].encode()))
    batch = pa.RecordBatch.from_pylist(runs, schema=audit.ARROW)
    want, df = Counter(), Counter()
    for lang, source, text in rows:
        words = TERM.findall((text or "").translate(LOWER))
        want.update((lang or "", w, source or "") for w in words)
        df.update((lang or "", w) for w in set(words))
    got, docs, order = Counter(), {}, []
    for lang, term, d, found in audit.merged_terms(iter([batch])):
        if term:
            docs[lang.decode(), term.decode()] = d
            got.update({(lang.decode(), term.decode(), s): n for s, n in found.items()})
            assert (lang, term) not in order
            order.append((lang, term))
    assert got == want and docs == df


def test_block_leaves_when_full():
    block = audit.Block(2)
    assert not block.full()
    block.add([" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(2000)).encode()], [("en", "a")])
    assert not block.full() and len(block.terms) == 2001
    audit_terms, audit.BLOCK_TERMS = audit.BLOCK_TERMS, 1000
    try:
        assert block.full()
    finally:
        audit.BLOCK_TERMS = audit_terms
    list(block.run())
    assert len(block.terms) == 1


@pytest.mark.parametrize("parts", [1, 9])
def test_without_broadcast_and_any_partitioning(spark, monkeypatch, parts):
    rows = corpus(3, docs=150)
    monkeypatch.setattr(audit, "sized_broadcast", lambda df, *_: df)
    assert result(source_divergence(frame(spark, rows, parts))) == brute(rows)


def test_large_counts_stay_exact(spark):
    """Ten digits of a count times 10^9 would pass 64 bits."""
    n, of = 12_345_678_901, 98_765_432_109
    assert spark.range(1).selectExpr(f"{audit._share(f'{n}L', f'{of}L')} AS p").first().p == 1 + 10**9 * n // of


def test_odd_input(spark, odd, none):
    got = source_divergence(odd.selectExpr("*", "cast(null AS string) AS lang", "txt AS source", "1 AS p", "2 AS value", "3 AS shard"))
    rows = [(None, r.txt, r.text) for r in odd.collect()]
    assert result(got) == brute(rows)
    assert source_divergence(none.selectExpr("*", "txt AS lang", "txt AS source")).collect() == []


def test_long_text_beyond_a_step(spark, monkeypatch):
    """A text larger than a step's bytes stays one document."""
    long = "alpha beta Gamma " * 600_000  # 10 MB
    rows = [("en", "a", long), ("en", "b", "alpha delta")] + [("en", "b", "alpha gamma")] * 9
    assert result(source_divergence(frame(spark, rows, 2))) == brute(rows)
