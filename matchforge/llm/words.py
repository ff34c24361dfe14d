"""Vectorised word, line and window counts of Arrow text arrays.

A word is a run of bytes outside 0x20 and 0x09-0x0D; UTF-8 text keeps its
characters whole under that rule.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def split_words(text: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(document number of each word, words), in order; null texts have none."""
    parts = pc.ascii_split_whitespace(pc.fill_null(text, ""))
    sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(len(text)), sizes)
    words = parts.flatten()
    some = pc.not_equal(pc.binary_length(words), 0)  # leading or trailing white space leaves empty parts
    if pc.all(some).as_py() is not False:
        return doc, words
    keep = some.to_numpy(zero_copy_only=False)
    return doc[keep], words.filter(some)


def cut_texts(text: pa.Array, cut: Callable[[np.ndarray, np.ndarray], None]) -> tuple[pa.Array, np.ndarray]:
    """(pieces of all texts behind one another, how many each text has); null
    texts have none. ``cut`` gets the texts' bytes and a flag for each (and one
    more), set where a text begins, and sets it where other pieces begin."""
    text = pc.fill_null(text.cast(pa.string()), "")
    none = pa.array([], type=pa.string()), np.zeros(len(text), dtype=np.int64)
    if not len(text):
        return none
    ends = np.frombuffer(text.buffers()[1], dtype=np.int32)[text.offset:text.offset + len(text) + 1]
    first, n = int(ends[0]), int(ends[-1] - ends[0])
    if not n:
        return none
    data = text.buffers()[2].slice(first, n)
    begins = np.zeros(n + 1, dtype=bool)
    begins[ends - first] = True
    cut(np.frombuffer(data, dtype=np.uint8), begins)
    at = np.flatnonzero(begins).astype(np.int32)
    sizes = np.diff(np.searchsorted(at, ends - first))
    return pa.Array.from_buffers(pa.string(), len(at) - 1, [None, pa.py_buffer(at), data]), sizes


def as_bytes(words: pa.Array) -> list[bytes]:
    """The words' UTF-8 bytes (no nulls)."""
    if not len(words):
        return []
    ends = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset:words.offset + len(words) + 1].tolist()
    raw = words.buffers()[2].slice(0, ends[-1]).to_pybytes() if ends[-1] else b""
    return [raw[a:b] for a, b in zip(ends, ends[1:])]


def codes_of(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(code of each word, distinct words)."""
    d = words.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing step (splitmix64)."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def per_doc(doc: np.ndarray, n: int, weight: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(doc, weights=weight, minlength=n).astype(np.int64)


def repeat_words(doc: np.ndarray, code: np.ndarray, n_docs: int, window: int = 5) -> np.ndarray:
    """Words of each document that lie in a window which occurs twice or more
    in that document (the first occurrence included)."""
    n = len(code) - window + 1
    if n <= 0:
        return np.zeros(n_docs, dtype=np.int64)
    h = mix(doc[:n])
    m = mix(code)
    for k in range(window):
        h = mix(h ^ m[k:k + n])
    at = np.flatnonzero(doc[:n] == doc[window - 1:])
    h = h[at]
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = s[1:] == s[:-1]
    twice = np.zeros(len(s), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    first = at[order[twice]]
    step = np.zeros(len(code) + 1, dtype=np.int64)
    np.add.at(step, first, 1)
    np.add.at(step, first + window, -1)
    return per_doc(doc[np.cumsum(step[:-1]) > 0], n_docs)


def line_counts(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Lines with a word, how many of them equal an earlier one of their text,
    and (document, line) of all lines with a word."""
    n = len(text)
    parts = pc.split_pattern(pc.fill_null(text, ""), "\n")
    doc = np.repeat(np.arange(n), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    lines = parts.flatten()
    some = pc.not_equal(pc.binary_length(pc.ascii_trim_whitespace(lines)), 0)
    doc, lines = doc[some.to_numpy(zero_copy_only=False)], lines.filter(some)
    code, distinct = codes_of(lines)
    one = np.unique(doc * (len(distinct) + 1) + code)
    total = per_doc(doc, n)
    return total, total - per_doc(one // (len(distinct) + 1), n), doc, lines
