import io
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import matchforge.llm.token_files as T
from matchforge.llm.common import Cuts
from matchforge.llm.token_files import (Reader, Writer, bits_for, encode, pack, read_token_files, token_files, unpack,
                                        write_token_files)
from matchforge.llm.words import as_bytes, cut_texts
from tests.llm.conftest import ODD_ROWS

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["a  b", "x  y z", " lead trail ", "\n\n\nfoo  \n bar", "it's we'll 123 45.6", "<|endoftext|> x", "\t\ta\r\n b",
       "é ñ 　k", "", None, "a\x85 b", "a​ b", "x\x1c y", "日本 語   z", "a  b", "x" * 3000]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


def test_chunks_encode_like_whole_texts(library, texts):
    some = [*ODD, *list(texts.values())[:50]]
    assert [x.tolist() for x in encode(PATH, some)] == [library(x) for x in some]


def test_chunks_are_cut_without_a_string_each(library):
    """Slices with an offset, marks at chunks' ends, and a memory of words that
    holds no more than its bound."""
    some = ["one, two; one: two! (three). x1, é, a.b, .,", None, "", "y", " ", "two,\n", "\xa0 one,", "three.", ", one"]
    text = pa.array(["skipped, ", *some, "skipped"]).slice(1, len(some))
    chunks, sizes = cut_texts(text, T._chunks)
    assert chunks.to_pylist()[:8] == ["one", ",", " two", ";", " one", ":", " two", "!"] and sizes.sum() == len(chunks)
    assert sizes.tolist()[1:6] == [0, 0, 1, 1, 3] and "".join(chunks.to_pylist()) == "".join(x or "" for x in some)
    assert [x.tolist() for x in encode(PATH, text)] == [library(x) for x in some]
    words, memory = as_bytes(chunks.slice(2, 4)), Cuts(3, 2)
    assert words == [b" two", b";", b" one", b":"]
    for _ in range(3):
        memory.put(words[:3], [b"1", b"2", b"3"])
        assert memory.get(words) == [b"1", b"2", b"3", None] and len(memory.old) + len(memory.young) <= 6


@pytest.mark.parametrize("bits", [1, 5, 15, 16, 17, 23, 32])
def test_packing_round_trip(bits):
    rng = np.random.default_rng(bits)
    ids = rng.integers(0, 2**bits, 150_003, dtype=np.uint64).astype(np.uint32)
    assert len(pack(ids, bits)) == -(-len(ids) * bits // 8)
    assert (unpack(pack(ids[:999], bits), 500, bits, 300) == ids[300:800]).all()
    lists = np.split(ids, np.sort(rng.integers(0, len(ids), 40)))
    f = io.BytesIO()
    w = Writer(f, bits)
    w.add(np.arange(20), lists[:20])
    w.add(np.arange(20, len(lists)), lists[20:])
    w.close()
    r = Reader(f)
    assert r.bits == bits and r.docs.tolist() == list(range(len(lists)))
    assert all(r.document(k).tolist() == x.tolist() for k, x in enumerate(lists))
    assert (r.ids(65_000, 140_001) == ids[65_000:140_001]).all()


def test_bits():
    assert [bits_for(n) for n in (1, 2, 3, 32_768, 32_769, 50_257, 65_536, 65_537)] == [1, 1, 2, 15, 16, 16, 16, 17]


def test_documents(documents, texts, library):
    got = {r["doc_id"]: tuple(r)[1:] for r in token_files(documents, PATH, 2).collect()}
    at = 0
    for i in sorted(texts):
        ids = library(texts[i]) + [2]
        assert got.pop(i) == (at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        at += len(ids)
    assert not got


def test_odd_rows(odd, none, library, tmp_path):
    folder, manifest = write_token_files(odd, PATH, 2, str(tmp_path / "files"))
    assert manifest.agg({"n_docs": "sum"}).first()[0] == len(ODD_ROWS)
    assert not [p for p in (tmp_path / "files").iterdir() if p.name.startswith("_writing")]
    out = read_token_files(folder, manifest).collect()
    want = sorted((-1 if r[0] is None else r[0], len(library(r[1])) + 1) for r in ODD_ROWS)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"]) for r in out) == want
    assert [r["doc_id"] for r in sorted(out, key=lambda r: r["start"])][:2] == [None, None]
    assert token_files(none, PATH, 2).count() == 0
