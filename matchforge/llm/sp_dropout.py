"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

The merge agenda of a word always takes the best-scored pair of neighbouring
symbols, leftmost first. With dropout, a candidate merge (left start, boundary,
right end) is skipped if a keyed hash of the seed, the document id, the word's
position and those three places falls under the dropout rate. The decision
belongs to the candidate, so a run, a retry and any partitioning give the same
pieces.

A cut depends on the word and on the candidates that are skipped when their
turn comes, and on nothing else. So each worker keeps a tree of every repeated
word: a node holds the merges that follow if no more candidate is skipped, and
their cut; an occurrence draws these merges in their order, stays if none is
skipped, and else goes on to the node below the first skipped one. Words that
were not met before are cut by themselves. All words of a step go through the
agenda together: one round finds and applies the best allowed merge of every
word by array operations. Very long words take the agenda one by one with a heap.

No piece of the model joins two words: pieces hold the space mark only in
front, and line feeds are bytes. Characters outside the model, and the space
mark itself when a text contains it, become byte pieces, so decoding gives back
every text exactly.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from matchforge.llm.common import Cuts, by_bytes, id_text, laid, pooled, ship, sliced
from matchforge.llm.words import as_bytes, cut_texts, mix

MARK = "▁"
LONG = 48  # characters of a word beyond which the heap takes over
STEP = 4 << 20
WORDS = re.compile(r"\n| *[^ \n]+| +")
MASK = (1 << 64) - 1
AT_ONCE = 100_000  # words that are drawn or cut at a time
DEEP = 8  # skips that nodes follow; an occurrence with more is cut by itself


class Model:
    """Symbols, merges and byte pieces of a SentencePiece BPE model file."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.path = path
        self.size = n
        self.byte_ids = np.zeros(256, dtype=np.int32)
        ids: dict[str, int] = {}
        self.bytes = [b""] * n
        for i in range(n):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(p[1:-1], 16)] = i
                self.bytes[i] = bytes([int(p[1:-1], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                if MARK in p.lstrip(MARK) or "\n" in p:
                    raise ValueError("a piece reaches over a word's end")
                ids[p] = i
                self.bytes[i] = p.replace(MARK, " ").encode()
        # Symbols: piece ids, then characters that only larger pieces contain.
        inner = sorted({c for p in ids for c in p if c not in ids})
        self.symbols = dict(ids) | {c: n + k for k, c in enumerate(inner)}
        self.k = n + len(inner) + 1
        pairs = {}
        for p, i in ids.items():
            for cut in range(1, len(p)):
                a, b = self.symbols.get(p[:cut]), self.symbols.get(p[cut:])
                if a is not None and b is not None:
                    pairs[a * self.k + b] = (sp.get_score(i), i)
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.scores = np.array([pairs[k][0] for k in self.keys.tolist()])
        self.merged = np.array([pairs[k][1] for k in self.keys.tolist()], dtype=np.int64)
        self.pairs = pairs
        self.of_char = np.full(0x110000, -1, dtype=np.int32)
        for c, i in self.symbols.items():
            if len(c) == 1:
                self.of_char[ord(c)] = i
        self.of_char[ord(" ")] = self.of_char[ord(MARK)]
        self.of_char[ord(MARK)] = -1  # in a text it is an ordinary character
        self.piece_bytes = pa.array(self.bytes, type=pa.binary())

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(score, merged symbol) of neighbouring symbols; score -inf if they
        don't merge."""
        key = left * self.k + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        ok = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(ok, self.scores[at], -np.inf), self.merged[at]


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    return Model(path)


def _draw(key: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Keyed hash of a candidate: from ``a``, cut at ``b``, up to ``c``."""
    return mix(mix(mix(key ^ a.astype(np.uint64)) ^ b.astype(np.uint64)) ^ c.astype(np.uint64))


def _mix1(x: int) -> int:
    x = (x + 0x9E3779B97F4A7C15) & MASK
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ x >> 27) * 0x94D049BB133111EB) & MASK
    return x ^ x >> 31


def agenda(m: Model, word: str, key: int, limit: int) -> list[int]:
    """Symbols and fallback characters of one word, by a heap agenda; candidates
    whose draw is under ``limit`` (of 2^64) are skipped. Ids; characters
    outside the model are -1 - code point."""
    code = [int(m.of_char[ord(c)]) for c in word]
    n = len(code)
    sym, end, prev, live = code[:], list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap: list[tuple[float, int, int, int, int]] = []

    def offer(i: int, j: int) -> None:
        if i < 0 or j >= n or sym[i] < 0 or sym[j] < 0:
            return
        found = m.pairs.get(sym[i] * m.k + sym[j])
        if found and _mix1(_mix1(_mix1(key ^ i) ^ j) ^ end[j]) >= limit:
            heapq.heappush(heap, (-found[0], i, j, end[j], found[1]))

    for i in range(n - 1):
        offer(i, i + 1)
    while heap:
        _, i, j, stop, new = heapq.heappop(heap)
        if not (live[i] and j < n and live[j] and end[i] == j and end[j] == stop):
            continue
        sym[i], end[i], live[j] = new, stop, False
        if stop < n:
            prev[stop] = i
            offer(i, stop)
        offer(prev[i], i)
    out = []
    i = 0
    while i < n:
        if sym[i] >= 0 and sym[i] < m.size:
            out.append(sym[i])
        else:
            out += [-1 - ord(c) for c in word[i:end[i]]]
        i = end[i]
    return out


def cut_words(m: Model, words: list[str], keys: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The agenda of all words at once: a round applies each word's best
    allowed merge. Gives back the piece ids of all words behind one another and
    how many each word has; characters outside the model are bytes."""
    flat, n, _ = rounds(m, words, lambda w, a, b, c: _draw(keys[w], a, b, c) < np.uint64(limit), keys, limit)
    return flat, n


def rounds(m: Model, words: list[str], skipped: Callable[..., np.ndarray], keys: np.ndarray | None = None,
           limit: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``cut_words`` for any rule of skipping (word, left start, boundary, right
    end), and the merges (word, left start, boundary, right end) of each word in
    their order. Words of more than ``LONG`` characters need keys and limit."""
    n_chars = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    short = np.flatnonzero(n_chars <= LONG)
    sizes = n_chars[short]
    chars = np.frombuffer("".join([words[i] for i in short.tolist()]).encode("utf-32-le"), dtype=np.uint32)
    word = np.repeat(short, sizes)
    start = np.arange(len(chars)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    sym, end = m.of_char[chars].astype(np.int64), start + 1
    origin = np.arange(len(chars))
    merges: list[np.ndarray] = [np.zeros((0, 4), dtype=np.int32)]

    def score(i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For the pair (i, i + 1)."""
        s, new = m.look_up(sym[i], sym[i + 1])
        s[word[i] != word[i + 1]] = -np.inf
        k = np.flatnonzero(s > -np.inf)
        at = i[k]
        s[k[skipped(word[at], start[at], start[at + 1], end[at + 1])]] = -np.inf
        return s, new

    done: list[tuple] = []
    if len(sym):
        s, new = (np.r_[x, [z]] for x, z in zip(score(np.arange(len(sym) - 1)), (-np.inf, 0)))
    while len(sym):
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        top = np.maximum.reduceat(s, first)
        size = np.diff(np.r_[first, len(word)])
        open_ = np.isfinite(top)
        if not open_.all():  # finished words leave
            stay = np.repeat(open_, size)
            done.append((word[~stay], origin[~stay], start[~stay], end[~stay], sym[~stay]))
            word, origin, start, end, sym, s, new = (x[stay] for x in (word, origin, start, end, sym, s, new))
            if not len(sym):
                break
            size, top = size[open_], top[open_]
        at = np.flatnonzero(s == np.repeat(top, size))
        at = at[np.r_[True, word[at][1:] != word[at][:-1]]]  # leftmost of equal scores
        merges.append(np.stack([word[at], start[at], start[at + 1], end[at + 1]], axis=1).astype(np.int32))
        sym[at], end[at] = new[at], end[at + 1]
        stay = np.ones(len(sym), dtype=bool)
        stay[at + 1] = False
        at = at - np.arange(len(at))  # places after the removal
        word, origin, start, end, sym, s, new = (x[stay] for x in (word, origin, start, end, sym, s, new))
        s[at] = -np.inf
        for i in (at[at < len(sym) - 1], at[at > 0] - 1):
            s[i], new[i] = score(i)
    none = np.zeros(0, dtype=np.int64)
    word, origin, start, end, sym = (np.concatenate(x) for x in zip((none,) * 5, *done))
    order = np.argsort(origin)
    word, origin, start, end, sym = (x[order] for x in (word, origin, start, end, sym))
    odd = (sym < 0) | (sym >= m.size)  # symbols without a piece: their characters
    whole = np.where(odd, end - start, 1)
    inner = np.arange(whole.sum()) - np.repeat(np.cumsum(whole) - whole, whole)
    flat = np.where(np.repeat(odd, whole), -1 - chars[np.repeat(origin, whole) + inner].astype(np.int64), np.repeat(sym, whole))
    word = np.repeat(word, whole)
    for i in np.flatnonzero(n_chars > LONG).tolist():
        at = int(np.searchsorted(word, i))
        cut = np.array(agenda(m, words[i], int(keys[i]), limit), dtype=np.int64)
        flat, word = np.r_[flat[:at], cut, flat[at:]], np.r_[word[:at], np.full(len(cut), i), word[at:]]
    flat, n = _bytes(m, flat)
    made = np.concatenate(merges)
    return flat, np.bincount(np.repeat(word, n), minlength=len(words)), made[np.argsort(made[:, 0], kind="stable")]


def _bytes(m: Model, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids with characters outside the model, -1 - code point, as byte pieces;
    how many ids each has become)."""
    ids = np.asarray(ids, dtype=np.int64)
    n = np.ones(len(ids), dtype=np.int64)
    odd = np.flatnonzero(ids < 0)
    if not len(odd):
        return ids.astype(np.int32), n
    chars, of = np.unique(-1 - ids[odd], return_inverse=True)
    raw = [chr(c).encode() for c in chars.tolist()]
    table = m.byte_ids[np.array([list(x.ljust(4, b"\0")) for x in raw])]
    n[odd] = np.array([len(x) for x in raw])[of]
    which = np.zeros(len(ids), dtype=np.int64)
    which[odd] = of
    source = np.repeat(np.arange(len(ids)), n)
    inner = np.arange(len(source)) - np.repeat(np.cumsum(n) - n, n)
    return np.where(ids[source] < 0, table[which[source], inner], ids[source]).astype(np.int32), n


class Paths:
    """What a worker process remembers of words, by node of their trees. The
    root of a word skips nothing; the node below merge ``j`` of a node skips that
    one too. ``merges`` are those that come after the ones a node shares with
    the node above it, which have been drawn there."""

    def __init__(self, m: Model, limit: int = 500_000):
        self.m, self.limit = m, limit
        self.roots: dict[bytes, int] = {}
        self.below: dict[int, int] = {}  # node * 256 + j
        self.seen: set = set()  # words and places that were met once
        self.up = np.zeros(0, dtype=np.int32)
        self.skip = np.zeros((0, 3), dtype=np.uint8)  # the candidate that a node skips and the one above doesn't
        self.shared, self.hits = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        self.merges, self.ids = np.zeros((0, 3), dtype=np.uint8), np.zeros(0, dtype=np.uint32)
        self.n_merges, self.n_ids = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32)
        self._places()

    def _places(self) -> None:
        self.merges_at, self.ids_at = (np.cumsum(n, dtype=np.int64) - n for n in (self.n_merges, self.n_ids))

    def add(self, words: list[str], up: np.ndarray | None = None, j: np.ndarray | None = None) -> np.ndarray:
        """New nodes: the words' roots, or those below merges ``j`` of the nodes ``up``."""
        k = len(words)
        if up is None:
            up, shared, skip = np.full(k, -1), np.zeros(k, dtype=np.int64), np.zeros((k, 3), dtype=np.uint8)
        else:
            shared, skip = self.shared[up] + j, self.merges[self.merges_at[up] + j]
        of, node, gone = np.flatnonzero(up >= 0), up[up >= 0], skip[up >= 0]
        taken = [np.zeros(0, dtype=np.int64)]
        while len(of):  # up to the roots
            taken.append(_packed(of, *gone.T))
            inner = self.up[node] >= 0
            of, gone, node = of[inner], self.skip[node[inner]], self.up[node[inner]]
        barred = np.sort(np.concatenate(taken))

        def skipped(*candidate: np.ndarray) -> np.ndarray:
            if not len(barred):
                return np.zeros(len(candidate[0]), dtype=bool)
            key = _packed(*candidate)
            return barred[np.minimum(np.searchsorted(barred, key), len(barred) - 1)] == key

        ids, n_ids, merges = rounds(self.m, words, skipped)
        n = np.bincount(merges[:, 0], minlength=k)
        place = np.arange(len(merges)) - np.repeat(np.cumsum(n) - n, n)
        made = len(self.up) + np.arange(k)
        for name, x in (("up", up), ("skip", skip), ("shared", shared), ("hits", np.zeros(k)), ("n_ids", n_ids), ("ids", ids),
                        ("n_merges", n - shared), ("merges", merges[place >= np.repeat(shared, n), 1:])):
            old = getattr(self, name)
            setattr(self, name, np.concatenate([old, x.astype(old.dtype)]))
        self._places()
        return made

    def first_skip(self, node: np.ndarray, keys: np.ndarray, limit: int) -> np.ndarray:
        """The place of the first merge of each node that its key skips; -1: none."""
        out = np.full(len(node), -1, dtype=np.int64)
        for lo in range(0, len(node), AT_ONCE):
            x = node[lo:lo + AT_ONCE]
            n = self.n_merges[x].astype(np.int64)
            of = np.repeat(np.arange(len(x)), n)
            inner = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            abc = self.merges[self.merges_at[x][of] + inner]
            hit = np.flatnonzero(_draw(keys[lo:lo + AT_ONCE][of], abc[:, 0], abc[:, 1], abc[:, 2]) < np.uint64(limit))
            hit = hit[np.r_[True, of[hit][1:] != of[hit][:-1]]] if len(hit) else hit
            out[lo + of[hit]] = inner[hit]
        return out

    def trim(self) -> None:
        """If there are too many nodes, those that were met once go (and all, if
        too many would stay). A node is met no more often than the one above."""
        if len(self.seen) > self.limit:
            self.seen.clear()
        if len(self.up) <= self.limit:
            return
        stay = self.hits > 1
        if stay.sum() > self.limit // 2:
            stay[:] = False
        now = np.cumsum(stay) - 1
        self.roots = {w: int(now[i]) for w, i in self.roots.items() if stay[i]}
        self.below = {int(now[k >> 8]) << 8 | k & 255: int(now[i]) for k, i in self.below.items() if stay[i]}
        self.seen.clear()
        self.merges, self.ids = self.merges[np.repeat(stay, self.n_merges)], self.ids[np.repeat(stay, self.n_ids)]
        self.up = np.where(self.up >= 0, now[self.up], -1)[stay].astype(np.int32)
        self.hits = self.hits[stay] >> 1
        for name in ("skip", "shared", "n_merges", "n_ids"):
            setattr(self, name, getattr(self, name)[stay])
        self._places()

    def again(self, names: list, n: np.ndarray) -> np.ndarray:
        """Whether names that came ``n`` times now have been met before or are
        met several times; the others are remembered."""
        out = np.fromiter(map(self.seen.__contains__, names), dtype=bool, count=len(names)) | (n > 1)
        self.seen.update(x for x, o in zip(names, out.tolist()) if not o)
        return out


def _packed(of: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((of.astype(np.int64) << 8 | a) << 8 | b) << 8 | c


_CUTS: dict[tuple, Cuts] = {}  # of this worker process, by setting
_PATHS: dict[str, Paths] = {}  # of this worker process, by model file


def _own_cuts(m: Model, words: pa.Array, code: np.ndarray, keys: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, the first one of each occurrence there, how many it has), every
    occurrence cut with its own key."""
    p = _PATHS.setdefault(m.path, Paths(m))
    p.trim()
    names = as_bytes(words)
    root = np.fromiter(map(p.roots.get, names, repeat(-1)), dtype=np.int64, count=len(names))
    new = np.flatnonzero((root < 0) & (pc.utf8_length(words).to_numpy(zero_copy_only=False) <= min(LONG, 255)))
    new = new[p.again([names[i] for i in new.tolist()], np.bincount(code, minlength=len(names))[new])]
    for lo in range(0, len(new), AT_ONCE):
        some = new[lo:lo + AT_ONCE].tolist()
        root[some] = p.add([names[i].decode() for i in some])
        p.roots.update((names[i], int(root[i])) for i in some)
    node = root[code]
    todo = np.flatnonzero(node >= 0)
    for _ in range(DEEP):
        p.hits += np.bincount(node[todo], minlength=len(p.hits))
        j = p.first_skip(node[todo], keys[todo], limit)
        todo, j = todo[j >= 0], j[j >= 0]
        if not len(todo):
            break
        which, one, of, n = np.unique(node[todo] << 8 | j, return_index=True, return_inverse=True, return_counts=True)
        ks = which.tolist()
        below = np.fromiter(map(p.below.get, ks, repeat(-1)), dtype=np.int64, count=len(ks))
        new = np.flatnonzero(below < 0)
        new = new[p.again([ks[i] for i in new.tolist()], n[new])]
        for lo in range(0, len(new), AT_ONCE):
            some = new[lo:lo + AT_ONCE]
            below[some] = p.add([names[i].decode() for i in code[todo[one[some]]].tolist()], which[some] >> 8, which[some] & 255)
            p.below.update(zip(which[some].tolist(), below[some].tolist()))
        node[todo] = below[of]
        todo = todo[node[todo] >= 0]
    node[todo] = -1  # too deep
    easy, hard = np.flatnonzero(node >= 0), np.flatnonzero(node < 0)
    at, count = np.zeros(len(code), dtype=np.int64), np.zeros(len(code), dtype=np.int64)
    at[easy], count[easy] = p.ids_at[node[easy]], p.n_ids[node[easy]]
    ids, size = [p.ids], len(p.ids)
    for lo in range(0, len(hard), AT_ONCE):
        x = hard[lo:lo + AT_ONCE]
        flat, n = cut_words(m, [names[i].decode() for i in code[x].tolist()], keys[x], limit)
        at[x], count[x] = size + np.cumsum(n) - n, n
        ids.append(flat.astype(np.uint32))
        size += len(flat)
    return np.concatenate(ids), at, count


def _words(raw: np.ndarray, begins: np.ndarray) -> None:
    """Line feeds are words; others begin at spaces behind something else."""
    feed, space = raw == 10, raw == 32
    begins[1:-1] |= feed[1:] | feed[:-1] | (space[1:] & ~space[:-1])


def encode(m: Model, texts: pa.Array | list[str | None], ids: np.ndarray, seed: int, rate: float,
           variants: int | None = None) -> list[np.ndarray]:
    """Piece ids of whole texts (null: none). With ``variants``, an occurrence
    draws one of so many cuts of its word instead of its own."""
    from xxhash import xxh64_intdigest

    limit = min(int(rate * 2.0**64), MASK)
    text = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, type=pa.string()), "")
    words, sizes = cut_texts(pc.if_else(pc.equal(text, ""), "", pc.binary_join_element_wise(" ", text, "")), _words)
    if not len(words):
        return [np.zeros(0, dtype=np.uint32) for _ in range(len(text))]
    d = words.dictionary_encode()
    code = d.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    place = np.arange(len(code)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    drawn = mix(mix(np.repeat(ids.astype(np.uint64), sizes) ^ np.uint64(seed)) ^ place.astype(np.uint64))
    if variants is None:
        return laid(*_own_cuts(m, d.dictionary, code, drawn, limit), sizes)
    both, of = np.unique(code * variants + (drawn % np.uint64(variants)).astype(np.int64), return_inverse=True)
    names = [f"{v} {w}" for v, w in zip((both % variants).tolist(), d.dictionary.take(pa.array(both // variants)).to_pylist())]
    memory = _CUTS.setdefault((id(m), seed, rate, variants), Cuts())
    cuts = memory.get(names)
    need = [i for i, x in enumerate(cuts) if x is None]
    own = [names[i] for i in need]
    keys = np.fromiter((xxh64_intdigest(x, seed) for x in own), dtype=np.uint64, count=len(own))
    new = sliced(*cut_words(m, [x.partition(" ")[2] for x in own], keys, limit))
    for i, x in zip(need, new):
        cuts[i] = x
    memory.put(own, new)
    return pooled(cuts, of, sizes)


def decode(m: Model, ids: np.ndarray) -> str:
    """The text of piece ids: pieces' bytes, without the space put in front."""
    raw = b"".join(m.piece_bytes.take(pa.array(ids)).to_pylist()) if len(ids) else b""
    return raw[1:].decode("utf-8", errors="replace")


def _decoded(m: Model, lists: list[np.ndarray]) -> pa.Array:
    """Texts of many id lists: the pieces' bytes lie behind one another."""
    flat = m.piece_bytes.take(pa.array(np.concatenate([np.zeros(0, dtype=np.uint32), *lists])))
    data = flat.buffers()[2]
    raw = data.to_pybytes() if data is not None else b""
    ends = np.frombuffer(flat.buffers()[1], dtype=np.int32)[:len(flat) + 1]
    at = ends[np.r_[0, np.cumsum([len(x) for x in lists])]].tolist()
    return pa.array([raw[a + 1:b].decode("utf-8", errors="replace") for a, b in zip(at, at[1:])], type=pa.string())


def _run(path: str, seed: int, rate: float, variants: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in by_bytes(batches, step=STEP):
            ids = pc.fill_null(batch.column("id"), 0).to_numpy(zero_copy_only=False)
            text = batch.column("txt")
            lists = encode(m, text, ids, seed, rate, variants)
            back = _decoded(m, lists)
            same = pc.equal(pc.fill_null(text, ""), back)
            sizes = np.array([len(x) for x in lists], dtype=np.int32)
            pieces = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)),
                                              pa.array(np.concatenate([np.zeros(0, dtype=np.uint32), *lists]).astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes.astype(np.int64)), pieces, back, same],
                ["doc_id", "n_pieces", "pieces", "decoded", "lossless"])
    return run


def encode_documents(docs: DataFrame, path: str, seed: int = 7, rate: float = 0.1, variants: int | None = None,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_pieces, pieces, decoded, lossless) for every row.

    ``path`` is a SentencePiece BPE model file that every executor can read.
    Null and empty texts have no pieces and decode to the empty string; a null
    id draws as id 0; repeated rows get equal pieces; an empty
    table gives an empty result.
    """
    ship(docs.sparkSession)
    return id_text(docs, id_col, text_col).mapInArrow(
        _run(path, seed, rate, variants),
        "doc_id long, n_pieces long, pieces array<int>, decoded string, lossless boolean")
