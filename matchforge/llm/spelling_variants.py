"""Spelling variant grouping: words one edit apart, found by search schemes
over bidirectional FM-indexes of the delimited vocabulary.

A word and a near word agree on either the whole left or the whole right half
of the first, at the same end. Words therefore meet by half: a word searches
under its two halves, and lies in the index under every prefix and suffix that
can be the half of a near word. Halves are dealt by hash to shards of bounded
size; the words under a very frequent half are dealt to blocks, each of which
sees all searches of that half.

A shard's index holds its words as cyclic strings ``$word``. Their rotations in
order give the forward interval of a pattern, those of the reversed words the
reverse one; both are kept in step, so a pattern grows at either end. A scheme
matches one half exactly, outwards from the middle to the delimiter, then grows
across the other half with one error up to the other delimiter. Rotations that
start with the delimiter come first and in word order: where the forward
interval of ``$word$`` starts is the word's number.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchforge.llm.common import by_bytes, id_text, ship, shuffle_parts, stage
from matchforge.operators.joins import sized_broadcast

#: One byte for each code point up to U+00FF: letters stay (A-Z as a-z), all others become blanks.
LETTERS = bytes(c if c >= 0xC0 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))
#: Distinct words whose counts a task holds; index symbols of a shard on
#: average; words of one half that one block holds; searches made at a time.
HELD_WORDS, SHARD_SYMBOLS, BLOCK_WORDS, SEARCHES = 300_000, 150_000, 20_000, 5_000
#: Rank rows are kept for every so many symbols; the rest is counted.
STEP = 16

NEAR = "word string, n bigint, n_near bigint, near_n bigint, near string"


def varied(word: bytes, seed: int) -> bytes:
    """The run as the corpus has it, or with one code point less: ``seed`` is
    the crc32 of what stands before the word."""
    h = zlib.crc32(word if word.isascii() else word.decode("latin1").encode(), seed)
    if h % 199:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1:]


def word_counts(docs: DataFrame, min_chars: int, min_count: int) -> DataFrame:
    """(id, txt) -> (word, n) of the frequent words."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}
        for batch in by_bytes(batches):
            for i, text in zip(batch.column("id").to_pylist(), batch.column("txt").to_pylist()):
                words = (text or "").encode("latin1", "replace").translate(LETTERS).split()
                seed = zlib.crc32(f"{'' if i is None else i}:".encode())
                for w, n in Counter(w for w in words if len(w) >= min_chars).items():
                    w = varied(w, seed)
                    held[w] = held.get(w, 0) + n
            if len(held) > HELD_WORDS:
                yield from rows(held)
                held.clear()
        yield from rows(held)

    def rows(held):
        words, n = [w.decode("latin1") for w in held], list(held.values())
        for i in range(0, len(words), 20_000):
            yield pa.RecordBatch.from_arrays([pa.array(words[i:i + 20_000], pa.string()), pa.array(n[i:i + 20_000], pa.int64())], names=["word", "n"])

    return (docs.mapInArrow(count, "word string, n bigint").where(F.length("word") >= min_chars)
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def _ranked(first: np.ndarray, nxt: np.ndarray, longest: int) -> np.ndarray:
    """Numbers of strings in order, equal strings alike: ``first`` is the first
    symbol at each place, ``nxt`` the place behind (-1: none). Known lengths
    double in every round."""
    rank, k = first.astype(np.int64), 1
    while k < longest:
        after = np.where(nxt >= 0, rank[nxt] + 1, 0)
        rank = np.unique(rank * (after.max() + 1) + after, return_inverse=True)[1]
        nxt = np.where(nxt >= 0, nxt[nxt], -1)
        k *= 2
    return rank


class Ranks:
    """How often each symbol occurs before a row of one of the two orders."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        n, self.alphabet = len(symbols), alphabet
        self.symbols = np.r_[symbols, np.full(STEP + -n % STEP, alphabet, dtype=symbols.dtype)]
        counts = np.zeros((len(self.symbols) // STEP + 1, alphabet + 1), dtype=np.int32)
        np.add.at(counts, (np.arange(n) // STEP + 1, symbols + 1), 1)
        #: less[b, c]: symbols under c before row b * STEP
        self.less = np.cumsum(np.cumsum(counts, axis=0, dtype=np.int32), axis=1, dtype=np.int32)
        self.starts = self.less[-1].astype(np.int64)

    def _rest(self, at: np.ndarray) -> np.ndarray:
        """Symbols from the last kept row to ``at``; others read as the largest."""
        block = self.symbols[(at // STEP * STEP)[:, None] + np.arange(STEP)]
        return np.where(np.arange(STEP) < (at % STEP)[:, None], block, self.alphabet)

    def one(self, at: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols less than c, and equal to c, before the rows ``at``."""
        rest, row = self._rest(at), self.less[at // STEP, c].astype(np.int64)
        return row + (rest < c[:, None]).sum(1), self.less[at // STEP, c + 1] - row + (rest == c[:, None]).sum(1)

    def all(self, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before the rows ``at``."""
        out, rest = np.diff(self.less[at // STEP].astype(np.int64), axis=1), self._rest(at)
        out, row = np.c_[out, np.zeros(len(at), dtype=np.int64)], np.arange(len(at))
        for k in range(STEP):
            out[row, rest[:, k]] += 1
        return out[:, :-1]

    def grow(self, a, b, size, c):
        """Interval (a, size) in this order and (b, size) in the other one,
        with the symbol c added at this order's end of the pattern."""
        under, same = self.one(np.r_[a, a + size], np.r_[c, c])
        k = len(a)
        return self.starts[c] + same[:k], b + under[k:] - under[:k], same[k:] - same[:k]


class Index:
    """Bidirectional FM-index of distinct words (one byte a code point)."""

    def __init__(self, words: list[bytes]):
        self.words = sorted(words)
        sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        flat = np.frombuffer(b"$".join(self.words) + b"$", dtype=np.uint8)  # $ is no letter
        self.code = np.full(256, -1, dtype=np.int64)
        letters = np.unique(flat)
        self.code[letters] = np.arange(len(letters))  # $ has the least byte
        symbols, n = self.code[flat], len(flat)
        ends = np.cumsum(sizes + 1) - 1  # places of the delimiters
        starts = ends - sizes
        place, word = np.arange(n), np.repeat(np.arange(len(sizes)), sizes + 1)
        longest = int(sizes.max()) + 1
        # Rotation at a place: from its symbol on; equal ones by word number, since the word follows.
        forward = _ranked(symbols, np.where(place < ends[word], place + 1, -1), longest)
        before = np.where(place > starts[word], place - 1, ends[word])  # one place back in the cycle
        f_order = np.argsort(forward * len(sizes) + word, kind="stable")
        self.left = Ranks(symbols[before][f_order], len(letters))
        # The same of the words read backwards; the symbol at a place is its first.
        backward = _ranked(symbols, np.where(place == starts[word], -1, np.where(place == ends[word], -1, place - 1)), longest)
        mirror = np.empty(len(sizes), dtype=np.int64)  # numbers of the reversed words
        mirror[np.lexsort((backward[ends - 1],))] = np.arange(len(sizes))
        b_order = np.argsort(backward * len(sizes) + mirror[word], kind="stable")
        after = np.where(place < ends[word], place + 1, starts[word])
        self.right = Ranks(symbols[after][b_order], len(letters))
        self.size = n

    def near(self, queries: list[bytes], right_half: bool) -> tuple[np.ndarray, np.ndarray]:
        """(number of the query, number of the word) of words that are one edit
        from a query and share its left (right) half exactly."""
        sizes = np.array([len(w) for w in queries], dtype=np.int64)
        flat = self.code[np.frombuffer(b"$".join(queries) + b"$", dtype=np.uint8)]
        first = np.cumsum(sizes + 1) - sizes - 1
        half = sizes // 2
        if right_half:  # outwards from the middle to the right, then to the left
            inner, outer, sign = self.right, self.left, 1
            exact, rest = first + half, first + half - 1
            n_exact, n_rest = sizes - half, half
        else:
            inner, outer, sign = self.left, self.right, -1
            exact, rest = first + half - 1, first + half
            n_exact, n_rest = half, sizes - half

        def symbol(q, j, start, count, step):
            """Symbol j of a half, the delimiter behind it."""
            return np.where(j < count[q], flat[np.where(j < count[q], start[q] + step * j, 0)], 0)

        q = np.arange(len(queries))
        a, b, size = (np.zeros(len(q), dtype=np.int64) for _ in range(3))
        size += self.size
        j = 0
        done = []
        while len(q):
            c = symbol(q, j, exact, n_exact, sign)
            ok = c >= 0
            q, a, b, size, c = q[ok], a[ok], b[ok], size[ok], c[ok]
            a, b, size = inner.grow(a, b, size, c)
            last = (j == n_exact[q]) & (size > 0)
            done.append((q[last], a[last], b[last], size[last]))
            on = (j < n_exact[q]) & (size > 0)
            q, a, b, size = q[on], a[on], b[on], size[on]
            j += 1
        q, b, a, size = (np.concatenate(x) for x in zip(*done))  # from now on in the outer order

        found, late = [], [np.zeros(0, dtype=np.int64) for _ in range(5)]  # late: error made (q, j, a, b, size)
        j = 0
        while len(q) or len(late[0]):
            lq, lj, la, lb, ls = late
            if len(lq):
                c = symbol(lq, lj, rest, n_rest, -sign)
                ok = c >= 0
                lq, lj, la, lb, ls, c = (x[ok] for x in (lq, lj, la, lb, ls, c))
                la, lb, ls = outer.grow(la, lb, ls, c)
                end = (lj == n_rest[lq]) & (ls > 0)
                found.append((lq[end], (la if right_half else lb)[end]))
                on = (lj < n_rest[lq]) & (ls > 0)
                lq, lj, la, lb, ls = lq[on], lj[on] + 1, la[on], lb[on], ls[on]
            if len(q):
                c = symbol(q, j, rest, n_rest, -sign)
                low = outer.all(a)
                seen = outer.all(a + size) - low
                under = np.cumsum(seen, axis=1) - seen
                row, s = np.nonzero(seen)
                grown = (outer.starts[s] + low[row, s], b[row] + under[row, s], seen[row, s])
                wrong = (s != c[row]) & (s > 0)
                inside = wrong & (c[row] != 0)  # another symbol stands for the query's
                skip = np.flatnonzero((c != 0) & (c != symbol(q, np.full(len(q), j + 1), rest, n_rest, -sign)))
                at = np.full(len(row), j)
                late = [np.concatenate(x) for x in (
                    (lq, q[row][inside], q[row][wrong], q[skip]),
                    (lj, at[inside] + 1, at[wrong], np.full(len(skip), j + 1)),
                    (la, grown[0][inside], grown[0][wrong], a[skip]),
                    (lb, grown[1][inside], grown[1][wrong], b[skip]),
                    (ls, grown[2][inside], grown[2][wrong], size[skip]))]
                go = (s == c[row]) & (c[row] != 0)
                q, a, b, size = q[row][go], grown[0][go], grown[1][go], grown[2][go]
            else:
                late = [lq, lj, la, lb, ls]
            j += 1
        if not found:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        q, v = (np.concatenate(x) for x in zip(*found))
        pair = np.unique(q * len(self.words) + v)
        return pair // len(self.words), pair % len(self.words)


def _search(index: Index, counts: np.ndarray, rows: list[tuple]) -> Iterator[tuple]:
    """Rows (side, word, n, block, blocks) -> (word, n, n_near, near_n, near)."""
    for side in (0, 1):
        part = [r for r in rows if r[0] == side]
        if not part:
            continue
        words = [r[1] for r in part]
        q, v = index.near(words, right_half=side == 1)
        keep = np.ones(len(q), dtype=bool)
        for k, (i, w) in enumerate(zip(q.tolist(), v.tolist())):
            _, word, _, block, blocks = part[i]
            hit = index.words[w]
            # What shares the left half is found by it; words of other blocks are found there.
            if side and hit.startswith(word[:len(word) // 2]):
                keep[k] = False
            elif blocks > 1 and zlib.crc32(hit.decode("latin1").encode()) % blocks != block:
                keep[k] = False
        q, v = q[keep], v[keep]
        order = np.lexsort((v, -counts[v], q))
        q, v = q[order], v[order]
        best = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, dtype=np.int64)
        n_near = np.bincount(q, minlength=len(part)).tolist()
        top = dict(zip(q[best].tolist(), v[best].tolist()))
        for i, r in enumerate(part):
            w = top.get(i)
            yield (r[1].decode("latin1"), r[2], n_near[i], None if w is None else int(counts[w]), None if w is None else index.words[w].decode("latin1"))


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, role, side, word, n, block, blocks) by shard, indexed words
    (role 0) before searches -> near words of the searches."""
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    shard, held, index, counts, wait = None, {}, None, None, []

    def answer():
        nonlocal index, counts
        if index is None and held:
            index = Index(list(held))
            counts = np.array([held[w] for w in index.words], dtype=np.int64)
        if index is not None and wait:
            out = list(_search(index, counts, wait))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), type=t) for c, t in zip(zip(*out), types)], names=["word", "n", "n_near", "near_n", "near"])
        wait.clear()

    for batch in batches:
        for s, role, side, word, n, block, blocks in zip(*(c.to_pylist() for c in batch.columns)):
            if s != shard or len(wait) >= SEARCHES:
                yield from answer()
            if s != shard:
                shard, held, index = s, {}, None
            if role:
                wait.append((side, word.encode("latin1"), n, block, blocks))
            else:
                held[word.encode("latin1")] = n
    yield from answer()


def near_words(words: DataFrame) -> DataFrame:
    """(word, n) -> (word, n, n_near, near_n, near): how many words are one
    edit away and the most frequent of them (ties: the least)."""
    spark = words.sparkSession
    size, least = words.agg(F.coalesce(F.sum(F.length("word") + 1), F.lit(0)), F.coalesce(F.min(F.length("word")), F.lit(0))).first()
    parts = shuffle_parts(spark)
    shards = max(parts, int(4 * size // SHARD_SYMBOLS) + 1)

    def keys(*sides):
        return F.explode(F.array(*(F.struct(F.lit(s).alias("side"), k.alias("key")) for s, k in sides)))
    searches = words.select("word", "n", keys((0, F.expr("left(word, length(word) div 2)")), (1, F.expr("right(word, length(word) - length(word) div 2)"))).alias("k"))
    spans = F.expr("array_distinct(array((length(word) - 1) div 2, length(word) div 2, (length(word) + 1) div 2))")
    ends = F.expr("array_distinct(array(length(word) div 2, (length(word) + 1) div 2, (length(word) + 2) div 2))")
    indexed = words.select("word", "n", spans.alias("p"), ends.alias("s")).select("word", "n", F.explode(F.expr(
        f"concat(transform(filter(p, x -> x >= {least // 2}), x -> named_struct('side', 0, 'key', left(word, x))),"
        f" transform(filter(s, x -> x >= {least - least // 2}), x -> named_struct('side', 1, 'key', right(word, x))))")).alias("k"))
    searches, indexed = (x.select("word", "n", "k.side", "k.key") for x in (searches, indexed))
    hot = (indexed.groupBy("side", "key").agg(F.count("*").alias("c")).where(F.col("c") > BLOCK_WORDS)
           .select("side", "key", F.expr(f"cast(ceil(c / {BLOCK_WORDS}) AS int)").alias("blocks")))
    hot = sized_broadcast(stage(hot, "hot-halves"))
    blocks = F.coalesce("blocks", F.lit(1))
    indexed = indexed.join(hot, ["side", "key"], "left").select(
        F.lit(0).alias("role"), "side", "key", "word", "n", (F.crc32("word") % blocks).cast("int").alias("block"), blocks.alias("blocks"))
    searches = searches.join(hot, ["side", "key"], "left").select(
        F.lit(1).alias("role"), "side", "key", "word", "n", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), blocks.alias("blocks"))
    placed = indexed.unionByName(searches).select(
        F.expr(f"cast(pmod(xxhash64(side, key, block), {shards}) AS int)").alias("shard"), "role", "side", "word", "n", "block", "blocks")
    found = placed.repartitionById(parts, "shard").sortWithinPartitions("shard", "role").mapInArrow(_shards, NEAR)
    return (found.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"),
                                      F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("m"), "near"))).alias("top"))
            .select("word", "n", "n_near", (-F.col("top.m")).alias("near_n"), F.col("top.near").alias("near")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) -> (word, root): every root pointer is followed by the
    pointer it points to, until none moves. Counts grow along a chain, so there
    are no cycles and chains are short (a logarithm of the largest count)."""
    step = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        far = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stage(step.join(sized_broadcast(far), "root", "left")
                      .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        step = moved.select("word", "root")
        if not moved.where("moved").limit(1).count():
            return step


def spelling_groups(docs: DataFrame, min_chars: int = 6, min_count: int = 5, ratio: int = 5,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root string, n, n_near, form_n long) of each frequent word.

    ``form`` is the near word with the most occurrences if it has at least
    ``ratio`` times the word's; ``root`` is where following forms ends.

    Null and empty texts have no words; a null id stands before its words as
    an empty text. Repeated rows count each. Very long words are searched like
    others. Other columns are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    words = stage(word_counts(id_text(docs, id_col, text_col), min_chars, min_count), "words")
    near = stage(near_words(words).select(
        "word", "n", "n_near", *(F.when(F.col("near_n") >= ratio * F.col("n"), F.col(c)).alias(a) for c, a in (("near", "form"), ("near_n", "form_n")))), "near-words")
    root = roots(near.where("form IS NOT NULL").select("word", "form"))
    return near.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
