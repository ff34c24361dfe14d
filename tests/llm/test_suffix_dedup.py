import hashlib
import random

import numpy as np
import pytest

from matchforge.llm.suffix_dedup import least_of, remove_repeats, sort_columns
from tests.llm.conftest import ODD_ROWS


def brute(rows, length=50):
    """rows (id, bytes) -> (id, bytes, removed, spans, kept hash), sorted."""
    first = {}
    for i, b in rows:
        key = -1e30 if i is None else i
        for k in range(len(b) - length + 1):
            s = b[k:k + length]
            first[s] = min(first.get(s, key), key)
    out = []
    for i, b in rows:
        key = -1e30 if i is None else i
        gone = np.zeros(len(b) + 1, dtype=bool)
        for k in range(len(b) - length + 1):
            if first[b[k:k + length]] < key:
                gone[k:k + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((-1 if i is None else i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
                  for r in df.collect())


@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh \xff"])
def test_columns_sort_all_suffixes(alphabet):
    r = random.Random(3)
    strings = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 70))).encode("latin1") for _ in range(40)]
    strings += strings[:4]
    bwt, lcp, string, at = sort_columns(strings)
    want = sorted((s[k:], i, k) for i, s in enumerate(strings) for k in range(len(s) + 1))
    assert [(i, k) for _, i, k in want] == list(zip(string.tolist(), at.tolist()))
    assert [strings[i][k - 1] + 1 if k else 0 for _, i, k in want] == bwt.tolist()

    def shared(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n
    assert [0, *(shared(a[0], b[0]) for a, b in zip(want, want[1:]))] == lcp.tolist()


def test_least_of():
    a, b = b"0123456789" * 7, b"zz" + b"0123456789" * 6
    got = least_of([a, b], np.array([5, 3]))
    assert got[1].tolist() == [3] * len(got[1])
    assert got[0].tolist() == [3] * len(got[0])


def test_documents_equal_brute_force(documents, texts):
    assert result(remove_repeats(documents)) == brute([(i, t.encode()) for i, t in texts.items()])


def test_periodic_and_shared_passages(spark):
    r = random.Random(5)
    passage = "".join(r.choice("abcdefghij ") for _ in range(400))
    rows = [(i, "".join(r.choice("klmnop ") for _ in range(r.randint(0, 200))) + passage[r.randint(0, 300):] + "ab" * r.randint(0, 90))
            for i in range(60)]
    rows += [(100, "ab" * 4000), (101, "aab" * 700 + passage), (102, passage[:49]), (103, passage[:50]), (104, "é" * 60), (105, "é" * 25)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(remove_repeats(df)) == brute([(i, t.encode()) for i, t in rows])


def test_odd_rows(odd, none):
    want = brute([(r[0], (r[1] or "").encode()) for r in ODD_ROWS])
    assert result(remove_repeats(odd)) == want
    assert remove_repeats(none).count() == 0


def test_sql_agrees(spark, documents):
    import duckdb

    from matchforge.llm.queries import OP3_SQL, op3_suffix_dedup
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    want = con.execute(f"SELECT doc_id, n_bytes, n_removed, n_spans, kept_sha256 FROM ({OP3_SQL})").fetchall()
    assert result(op3_suffix_dedup(spark, "/root/testdata/sf0.001")) == sorted(want)
