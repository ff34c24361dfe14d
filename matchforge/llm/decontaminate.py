"""Benchmark decontamination by pigeonhole edit matching.

An item of n characters may occur in a document with up to
``floor(rate * n)`` = e edits. It is cut into e + 1 pieces of near equal
length: whatever the e edits hit, one piece stays exact. All pieces of all
items form one multi-pattern automaton that reads each document once; around
every exact piece hit, Myers' bit-parallel algorithm computes the edit distance
of the whole item to the best substring, and only distances within the budget
count. Text and items are compared lower-cased with white space runs as one
space.

The items are the stated query set: they are taken in blocks of bounded bytes,
each block one pass over the documents, with no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchforge.llm.common import id_text, ship

#: Item text that one pass holds as an automaton.
BLOCK_BYTES = 8 << 20
#: Edits allowed for each character of an item.
RATE = 0.08

MATCH_SCHEMA = "id long, item_id long, distance int, start int, stop int"


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """(offset, piece): budget + 1 pieces that make up the item."""
    n, k = len(item), budget + 1
    edges = [n * i // k for i in range(k + 1)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:]) if b > a]


def masks(item: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(item):
        out[c] = out.get(c, 0) | 1 << i
    return out


def myers(peq: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """(distance, end): the least edit distance of the pattern to a substring
    of ``text``, and where the first such substring ends."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, end = m, 0
    get = peq.get
    for j, c in enumerate(text):
        eq = get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
            if score < best:
                best, end = score, j + 1
                if not best:
                    break
        ph = ph << 1 & full
        pv = (mh << 1 & full) | (full & ~(xv | ph))
        mv = ph & xv
    return best, end


class Matcher:
    """All items of one block, ready to be found in documents."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items = []
        found: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            t = normal(text)
            if not t:
                continue  # an empty item is found nowhere
            budget = int(rate * len(t))
            k = len(self.items)
            self.items.append((item_id, t, budget, masks(t)))
            for at, piece in pieces(t, budget):
                found.setdefault(piece, []).append((k, at))
        self.auto = ahocorasick.Automaton()
        for piece, where in found.items():
            self.auto.add_word(piece, (len(piece), where))
        if found:
            self.auto.make_automaton()

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item id, distance, start, stop) for each item that occurs: its
        best occurrence, as a span of the normalised text."""
        t = normal(text)
        if not self.items or not t:
            return []
        windows: dict[int, list[tuple[int, int]]] = {}
        for end, (size, where) in self.auto.iter(t):
            for k, at in where:
                windows.setdefault(k, []).append(end + 1 - size - at)
        out = []
        for k, starts in windows.items():
            item_id, item, budget, peq = self.items[k]
            best = None
            for lo, hi in self._merged(starts, len(item), budget, len(t)):
                d, end = myers(peq, len(item), t[lo:hi])
                if d <= budget and (best is None or d < best[0]):
                    best = (d, lo, lo + end)
                    if not d:
                        break
            if best:
                d, lo, stop = best
                back = t[max(lo, stop - len(item) - d):stop][::-1]
                _, n = anchored(masks(item[::-1]), len(item), back)
                out.append((item_id, d, stop - n, stop))
        return out

    @staticmethod
    def _merged(starts: list[int], size: int, budget: int, n: int) -> Iterator[tuple[int, int]]:
        lo = hi = None
        for s in sorted(starts):
            a, b = max(0, s - budget), min(n, s + size + budget)
            if lo is None:
                lo, hi = a, b
            elif a <= hi:
                hi = max(hi, b)
            else:
                yield lo, hi
                lo, hi = a, b
        if lo is not None:
            yield lo, hi


def anchored(peq: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """(distance, length): the least edit distance of the pattern to a prefix
    of ``text``, and the shortest such prefix."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, n = m, 0
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        score += 1 if ph & high else -1 if mh & high else 0
        if score < best:
            best, n = score, j + 1
        ph = (ph << 1 | 1) & full
        pv = (mh << 1 & full) | (full & ~(xv | ph))
        mv = ph & xv
    return best, n


_MATCHERS: dict[int, Matcher] = {}  # of this worker process


def _matcher(block) -> Matcher:
    if block.id not in _MATCHERS:
        _MATCHERS.clear()
        items, rate = block.value
        _MATCHERS[block.id] = Matcher(items, rate)
    return _MATCHERS[block.id]


class Block:
    """A broadcast block of items, told apart from others by its number."""

    def __init__(self, spark, items, rate):
        self.sent = spark.sparkContext.broadcast((items, rate))
        self.id = self.sent._jbroadcast.id()

    def __getstate__(self):
        return {"sent": self.sent, "id": self.id}

    @property
    def value(self):
        return self.sent.value


def item_blocks(items: DataFrame, id_col: str, text_col: str, rate: float) -> list[Block]:
    spark = items.sparkSession
    it = id_text(items, id_col, text_col).where("txt is not null")
    total = it.agg(F.sum(F.octet_length("txt"))).first()[0] or 0
    n = total // BLOCK_BYTES + 1
    out = []
    for b in range(n):
        part = it if n == 1 else it.where(F.pmod(F.xxhash64("txt"), F.lit(n)) == b)
        out.append(Block(spark, [(r["id"], r["txt"]) for r in part.orderBy("id").collect()], rate))
    return out


def _find(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _matcher(block)
        for batch in batches:
            rows = []
            for i, x in zip(batch.column("id"), batch.column("txt")):
                rows += [(i.as_py(), *hit) for hit in m.find(x.as_py())]
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()))],
                ["id", "item_id", "distance", "start", "stop"])
    return run


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_id: str = "item_id", item_text: str = "text", rate: float = RATE) -> DataFrame:
    """(doc_id, item_id, distance, start, stop): one row for each row of
    ``docs`` and item that occurs in it within its edit budget; distance is the
    least of any occurrence, start and stop its span in the normalised text.

    Null or empty texts hold nothing, null or empty items occur nowhere, ids
    may be null or repeated (each row counts by itself), and empty tables give
    an empty result.
    """
    ship(docs.sparkSession)
    out = None
    for block in item_blocks(items, item_id, item_text, rate):
        part = id_text(docs, id_col, text_col).mapInArrow(_find(block), MATCH_SCHEMA)
        out = part if out is None else out.unionByName(part)
    return out.withColumnRenamed("id", "doc_id")


def _clean(block, text_col):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _matcher(block)
        for batch in batches:
            yield batch.filter(pa.array([not m.find(x.as_py()) for x in batch.column(text_col)], type=pa.bool_()))
    return run


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", rate: float = RATE) -> DataFrame:
    """The rows of ``docs``, all columns, in which no item occurs."""
    ship(docs.sparkSession)
    for block in item_blocks(items, item_id, item_text, rate):
        docs = docs.mapInArrow(_clean(block, text_col), docs.schema)
    return docs
