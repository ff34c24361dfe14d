"""Exact substring deduplication by column-wise suffix sorting.

A byte is removed if a 50-byte string that covers it also starts in a document
with a smaller id. The method sorts the suffixes of a collection of strings
column by column: round j inserts, for every string, the symbol in front of its
suffix of length j into the Burrows-Wheeler transform of all shorter suffixes,
at the place that symbol counts give, and updates the common prefixes of the
rows beside it. Equal 50-byte strings end as rows with common prefixes of 50.

The rounds of a collection are as many as its longest string has symbols, so
whole documents would need one pass over the corpus per character. The corpus is
cut instead so that no pair of equal 50-byte strings is lost:

* The *anchor* of a 50-byte string is the least hash of its 24-byte strings.
  Equal strings have equal anchors, so strings of different anchors never need
  comparing. Neighbouring strings mostly share an anchor: a *piece* is a run of
  at most ``RUN`` of them, some 50 to 76 bytes, and the pieces of one anchor are
  a collection of short strings.
* Anchors of one document only have no pair; their pieces are left out. A
  document whose whole text a smaller one has is removed as such, and no string
  of it is needed to judge others.
* An anchor with one distinct piece has nothing to sort.

Documents are packed into *blocks*. Blocks, anchors, pieces and results move
through Spark's shuffle and staged files, sorted by anchor; they are the external
files, read sequentially. A task reads pieces until ``HOLD`` bytes of whole
anchors are together and sorts that collection in memory. Copies of a piece are
merged within a block before the shuffle and within a collection after it, so a
piece that a third of all documents hold is one string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchforge.llm.common import bucketed, by_bytes, id_text, ship, shuffle_parts
from matchforge.llm.words import mix

LENGTH = 50
GRAM = 24
RUN = 27
BLOCK_BYTES = 2 << 20
HOLD = 2 << 20
LEAST_ID = -(1 << 63)  # stands for a null id, which is before all others

BLOCKS = "block long, ids array<long>, sizes array<int>, h1 array<long>, h2 array<long>, txt binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from xxhash import xxh64_intdigest

    part, n = TaskContext.get().partitionId(), 0
    for batch in by_bytes(batches, step=BLOCK_BYTES):
        texts = batch.column("txt").fill_null("").cast(pa.binary())
        data = [x.as_py() for x in texts]
        one = lambda x, t: pa.array([x], type=t)
        yield pa.RecordBatch.from_arrays(
            [one((part << 33) + n, pa.int64()), one(batch.column("id").fill_null(LEAST_ID).to_pylist(), pa.list_(pa.int64())),
             one([len(x) for x in data], pa.list_(pa.int32())),
             *(one(np.array([xxh64_intdigest(x, s) for x in data], dtype=np.uint64).view(np.int64), pa.list_(pa.int64())) for s in (1, 2)),
             one(b"".join(data), pa.binary())], ["block", "ids", "sizes", "h1", "h2", "txt"])
        n += 1


def loads(data: np.ndarray) -> np.ndarray:
    """At each place of a byte array, its next 8 bytes as one integer (the
    array must be filled up by 8 bytes)."""
    return np.ndarray((len(data) - 8,), "<u8", data, 0, (1,))


def runs_of(text: bytes, sizes: np.ndarray, length: int = LENGTH, step: int = 1 << 20):
    """Runs of consecutive ``length``-byte strings with one anchor: (start,
    number of strings, anchor, document) arrays over the whole block."""
    ends = np.cumsum(sizes)
    window = length - GRAM + 1
    data = np.frombuffer(text + b"\0" * (length + 16), dtype=np.uint8)
    out: list[tuple] = []
    for a in range(0, len(text), step):
        b = min(a + step, len(text))
        part = data[a:b + length + 8]
        w = loads(part)
        grams = b - a + length - GRAM
        m, span = np.zeros(grams, dtype=np.uint64), 1
        for k in range(0, GRAM, 8):
            m = mix(m ^ w[k:k + grams])
        while span * 2 <= window:
            m = np.minimum(m[:-span], m[span:])
            span *= 2
        if span < window:
            m = np.minimum(m[:len(m) - (window - span)], m[window - span:])
        m = m[:b - a] >> np.uint64(16)
        at = np.arange(a, b)
        doc = np.searchsorted(ends, at, side="right")
        ok = at + length <= ends[doc]
        new = np.r_[True, (m[1:] != m[:-1]) | (doc[1:] != doc[:-1]) | (ok[1:] != ok[:-1])]
        first = np.flatnonzero(new)
        n = np.diff(np.r_[first, b - a])
        keep = ok[first]
        first, n = first[keep], n[keep]
        cuts = -(-n // RUN)  # repetitive text has long runs
        if len(cuts) and cuts.max() > 1:
            inner = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
            first, n = np.repeat(first, cuts) + inner * RUN, np.minimum(np.repeat(n, cuts) - inner * RUN, RUN)
        out.append((first + a, n, m[first].astype(np.int64), doc[first]))
    if not out:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none
    return tuple(np.concatenate(x) for x in zip(*out))


def keys_of(text: bytes, start: np.ndarray, n: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """A 64-bit key of the bytes of each run's piece."""
    size = n + length - 1
    w = loads(np.frombuffer(text + b"\0" * 16, dtype=np.uint8))
    key = mix(size.astype(np.uint64))
    longest = int(size.max(initial=0))
    for at in range(0, longest, 8):
        here = size > at
        place = np.where(here, np.minimum(start + at, start + size - 8), 0)  # the last load ends with the piece
        key = np.where(here, mix(key ^ w[place]), key)
    return key.view(np.int64)


def _sizes(batch, i: int) -> np.ndarray:
    return batch.column("sizes")[i].values.to_numpy(zero_copy_only=False).astype(np.int64)


def _copies(batch, i: int) -> np.ndarray:
    """Which documents of a block are whole copies of a smaller one."""
    out, at = np.zeros(len(batch.column("ids")[i].values), dtype=bool), batch.column("copies")[i]
    if at.is_valid:
        out[at.values.to_numpy(zero_copy_only=False)] = True
    return out


def _anchors(parts: int, length: int):
    """Each block's anchors, dealt out by anchor: six bytes each, those that
    two documents of the block share first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                _, _, anchor, doc = runs_of(batch.column("txt")[i].as_py(), _sizes(batch, i), length)
                own = ~_copies(batch, i)[doc]
                anchor, doc = anchor[own], doc[own]
                order = np.lexsort((doc, anchor))
                anchor, doc = anchor[order], doc[order]
                first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]]) if len(anchor) else anchor
                last = np.r_[first[1:], len(anchor)] - 1 if len(anchor) else anchor
                many, anchor = doc[first] != doc[last], anchor[first]
                home = (anchor % parts).astype(np.int64)
                order = np.lexsort((~many, home))
                home, many, anchor = home[order], many[order], anchor[order]
                packed = np.ascontiguousarray(anchor.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])
                to, at = np.unique(home, return_index=True)
                stop = np.r_[at[1:], len(home)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to), pa.array(np.full(len(to), batch.column("block")[i].as_py())),
                     pa.array(np.array([many[x:y].sum() for x, y in zip(at, stop)], dtype=np.int64)),
                     pa.array([packed[x:y].tobytes() for x, y in zip(at, stop)], type=pa.binary())],
                    ["home", "block", "many", "anchors"])
    return run


def unpack6(data: bytes) -> np.ndarray:
    raw = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    raw[:, :6] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    return raw.view("<u8")[:, 0].astype(np.int64)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the anchors of one home, those of two documents or more, back to the
    blocks that hold them."""
    homes: dict[int, list[tuple[int, int, bytes]]] = {}
    for batch in batches:
        for home, block, many, data in zip(*(batch.column(c).to_pylist() for c in ("home", "block", "many", "anchors"))):
            homes.setdefault(home, []).append((block, many, data))
    for rows in homes.values():
        lists = [unpack6(x[2]) for x in rows]
        flat = np.concatenate(lists)
        s = np.sort(flat)
        common = np.unique(np.concatenate([s[1:][s[1:] == s[:-1]], *(x[:r[1]] for x, r in zip(lists, rows))]))
        for (block, _, _), x in zip(rows, lists):
            x = np.sort(x)
            at = np.minimum(np.searchsorted(common, x), max(len(common) - 1, 0))
            x = x[common[at] == x] if len(common) else x[:0]
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([x.astype("<i8").tobytes()], type=pa.binary())],
                                                 ["block", "shared"])


def _pieces(length: int):
    """Distinct pieces of a block under shared anchors, with the least and the
    greatest id of the documents that hold them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text, block = batch.column("txt")[i].as_py(), batch.column("block")[i].as_py()
                ids = batch.column("ids")[i].values.to_numpy(zero_copy_only=False)
                shared = np.unique(np.frombuffer(b"".join(batch.column("shared")[i].as_py()), dtype="<i8"))
                start, n, anchor, doc = runs_of(text, _sizes(batch, i), length)
                if not len(start) or not len(shared):
                    continue
                keep = (shared[np.minimum(np.searchsorted(shared, anchor), len(shared) - 1)] == anchor) & ~_copies(batch, i)[doc]
                start, n, anchor, doc = start[keep], n[keep], anchor[keep], doc[keep]
                key = keys_of(text, start, n, length)
                order = np.argsort(key, kind="stable")
                first = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]]) if len(key) else key
                if not len(key):
                    continue
                held = ids[doc[order]]
                lo, hi = np.minimum.reduceat(held, first), np.maximum.reduceat(held, first)
                pick = order[first]
                cut = [text[a:a + m + length - 1] for a, m in zip(start[pick].tolist(), n[pick].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[pick]), pa.array(np.full(len(pick), block)), pa.array(key[pick]), pa.array(lo),
                     pa.array(hi), pa.array(cut, type=pa.binary())], ["anchor", "block", "key", "lo", "hi", "piece"])
    return run


def common_prefix(w: np.ndarray, a: np.ndarray, b: np.ndarray, room_a: np.ndarray, room_b: np.ndarray) -> np.ndarray:
    """Common prefix lengths of the suffixes at ``a`` and ``b``, of which
    ``room`` symbols are left; ``w``: the loads of the strings."""
    room = np.minimum(room_a, room_b)
    out = np.zeros(len(a), dtype=np.int64)
    open_ = np.flatnonzero(room > 0)
    while len(open_):
        diff = w[a[open_] + out[open_]] ^ w[b[open_] + out[open_]]
        low = diff & (np.uint64(0) - diff)  # lowest set bit: its byte is the first that differs
        same = np.where(diff == 0, 8, np.bitwise_count(low - np.uint64(1)).astype(np.int64) // 8)
        out[open_] += same
        open_ = open_[(same == 8) & (out[open_] < room[open_])]
    return np.minimum(out, room)


def sort_columns(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Column-wise construction over a collection of strings.

    Gives back, for every suffix in sorted order (empty ones first, equal ones
    by string), its transform symbol (0: the suffix is the whole string, else
    the byte in front plus 1), its common prefix with the row before, its string
    and its place in it.
    """
    size = np.array([len(x) for x in strings], dtype=np.int64)
    m = len(strings)
    begin = np.cumsum(size) - size
    data = np.frombuffer(b"".join(strings) + b"\0" * 16, dtype=np.uint8)
    w = loads(data)
    # Round 0: the empty suffixes, with the last symbol of each string.
    row = np.arange(m)  # row of each string's longest suffix so far
    front = lambda s, j: np.where(size[s] > j, data[np.maximum(begin[s] + size[s] - j - 1, 0)].astype(np.uint16) + 1, 0).astype(np.uint16)
    bwt, lcp = front(np.arange(m), 0), np.zeros(m, dtype=np.int16)
    string, left = np.arange(m, dtype=np.int32), np.zeros(m, dtype=np.int16)  # left: symbols of the suffix
    live = np.flatnonzero(size > 0)
    for j in range(1, int(size.max(initial=0)) + 1):
        live = live[size[live] >= j]
        # A suffix that starts with symbol c has as its row: the empty ones, the
        # smaller symbols of the transform, and the c before its tail's row.
        order = np.argsort(bwt, kind="stable")
        rank = np.empty(len(bwt), dtype=np.int64)
        rank[order] = np.arange(len(bwt))
        whole = int((bwt == 0).sum())
        place = m + rank[row[live]] - whole
        by_place = np.argsort(place)
        s, place = live[by_place], place[by_place]
        total = len(bwt) + len(s)
        old = np.ones(total, dtype=bool)
        old[place] = False

        def put(was: np.ndarray, new) -> np.ndarray:
            out = np.empty(total, dtype=was.dtype)
            out[old] = was
            out[place] = new
            return out

        moved = np.flatnonzero(old)
        row = moved[row]  # strings that are used up keep their last row
        row[s] = place
        bwt, lcp, string, left = put(bwt, front(s, j)), put(lcp, 0), put(string, s), put(left, j)
        # Common prefixes change at the new rows and at those behind them.
        at = np.unique(np.r_[place, place + 1])
        at = at[at < total]
        x, y = string[at], string[at - 1]
        lx, ly = left[at].astype(np.int64), left[at - 1].astype(np.int64)
        lcp[at] = common_prefix(w, begin[x] + size[x] - lx, begin[y] + size[y] - ly, lx, ly)
    return bwt, lcp, string, size[string] - left


def least_of(strings: list[bytes], lo: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each ``length``-byte string of each of ``strings``: the least ``lo``
    of any that holds it too."""
    _, lcp, string, at = sort_columns(strings)
    size = np.array([len(x) for x in strings], dtype=np.int64)
    first = np.flatnonzero(lcp < length)
    least = np.repeat(np.minimum.reduceat(lo[string], first), np.diff(np.r_[first, len(lcp)]))
    full = size[string] - at >= length
    string, at, least = string[full], at[full], least[full]
    begin = np.cumsum(size - length + 1) - (size - length + 1)
    out = np.empty(int((size - length + 1).sum()), dtype=np.int64)
    out[begin[string] + at] = least
    return np.split(out, begin[1:])


def _solve(length: int):
    """Pieces sorted by anchor -> for each block and piece with a string that a
    smaller document holds: runs (at, least) of the least ids."""
    def work(rows: pa.Table) -> pa.RecordBatch:
        d = rows.column("piece").combine_chunks().dictionary_encode()
        code = d.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        get = lambda c: rows.column(c).to_numpy()
        lo = np.full(len(d.dictionary), np.iinfo(np.int64).max)
        np.minimum.at(lo, code, get("lo"))
        anchor = np.zeros(len(lo), dtype=np.int64)
        anchor[code] = get("anchor")
        _, of, count = np.unique(anchor, return_inverse=True, return_counts=True)
        alone = np.flatnonzero(count[of] == 1)  # one least id for all its strings
        flat, string, at = lo[alone], alone, np.zeros(len(alone), dtype=np.int64)
        rest = np.flatnonzero(count[of] > 1)
        if len(rest):
            least = least_of(d.dictionary.take(pa.array(rest)).to_pylist(), lo[rest], length)
            n = np.array([len(x) for x in least], dtype=np.int64)
            f, s = np.concatenate(least), np.repeat(rest, n)
            k = np.arange(len(f)) - np.repeat(np.cumsum(n) - n, n)
            change = np.r_[True, (f[1:] != f[:-1]) | (s[1:] != s[:-1])]
            flat, string, at = np.r_[flat, f[change]], np.r_[string, s[change]], np.r_[at, k[change]]
            order = np.argsort(string, kind="stable")
            flat, string, at = flat[order], string[order], at[order]
        begin = np.searchsorted(string, np.arange(len(lo) + 1))
        low = np.minimum.reduceat(flat, begin[:-1])
        use = np.flatnonzero(low[code] < get("hi"))  # else no holder in the block has a smaller one
        each = (begin[1:] - begin[:-1])[code[use]]
        idx = np.repeat(begin[code[use]], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(get("block")[use], each)), pa.array(np.repeat(get("key")[use], each)),
             pa.array(at[idx].astype(np.int32)), pa.array(flat[idx])], ["block", "key", "at", "least"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in by_bytes(batches, "piece", HOLD):
            held.append(batch)
            size += batch.column("piece").nbytes
            if size >= HOLD:
                rows = pa.Table.from_batches(held)
                anchor = rows.column("anchor").to_numpy()
                cut = int(np.searchsorted(anchor, anchor[-1]))  # the last anchor may go on
                if cut:
                    yield work(rows.slice(0, cut))
                    held = rows.slice(cut).to_batches()
                else:
                    held = _merged(rows)
                size = sum(x.column("piece").nbytes for x in held)
        if held and sum(x.num_rows for x in held):
            yield work(pa.Table.from_batches(held))
    return run


def _merged(rows: pa.Table) -> list[pa.RecordBatch]:
    return rows.combine_chunks().to_batches()


def _removed(length: int):
    """Blocks with their results -> one row per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text, sizes = batch.column("txt")[i].as_py(), _sizes(batch, i)
                ids = batch.column("ids")[i].values.to_numpy(zero_copy_only=False)
                gone = np.zeros(len(text) + 1, dtype=np.int32)
                hits = batch.column("hits")[i]
                if hits.is_valid and len(hits.values):
                    found = hits.values
                    key, at, least = (found.field(c).to_numpy(zero_copy_only=False) for c in ("key", "at", "least"))
                    order = np.lexsort((at, key))
                    key, at, least = key[order], at[order].astype(np.int64), least[order]
                    known = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
                    count = np.diff(np.r_[known, len(key)])
                    start, n, _, doc = runs_of(text, sizes, length)
                    own = keys_of(text, start, n, length)
                    k = np.minimum(np.searchsorted(key[known], own), len(known) - 1)
                    hit = np.flatnonzero(key[known][k] == own)
                    k, start, n, doc = k[hit], start[hit], n[hit], doc[hit]
                    each = count[k]
                    idx = np.repeat(known[k], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                    which = np.repeat(np.arange(len(k)), each)
                    last = np.r_[which[1:] != which[:-1], True] if len(which) else np.zeros(0, dtype=bool)
                    begin = at[idx]
                    stop = np.where(last, n[which], np.r_[begin[1:], 0]) if len(which) else begin
                    smaller = least[idx] < ids[doc[which]]
                    np.add.at(gone, (start[which] + begin)[smaller], 1)
                    np.add.at(gone, (start[which] + stop + length - 1)[smaller], -1)
                gone = np.cumsum(gone[:-1]) > 0
                edge = np.cumsum(sizes) - sizes
                gone |= np.repeat(_copies(batch, i) & (sizes >= length), sizes)
                rows = []
                keep = np.frombuffer(text, dtype=np.uint8)
                for a, m, x in zip(edge.tolist(), sizes.tolist(), ids.tolist()):
                    g = gone[a:a + m]
                    n_gone = int(g.sum())
                    spans = int(g[0]) + int((g[1:] & ~g[:-1]).sum()) if m else 0
                    rest = text[a:a + m] if not n_gone else keep[a:a + m][~g].tobytes()
                    rows.append((None if x == LEAST_ID else x, m, n_gone, spans, hashlib.sha256(rest).hexdigest(), rest))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for every row:
    kept has the bytes that no ``length``-byte string (GRAM at least) of a
    document with a smaller id covers.

    Null texts count as empty; a null id counts as smaller than all others;
    rows with one id are not compared with each other; texts shorter than
    ``length`` stay; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    if length < GRAM:
        raise ValueError("strings must be at least as long as an anchor's")
    parts = shuffle_parts(spark)
    # Bucketed by block: the two joins below do not move the texts again.
    blocks = bucketed(id_text(docs, id_col, text_col).mapInArrow(_blocks, BLOCKS), "blocks", "block", parts)
    listed = blocks.select("block", F.posexplode(F.arrays_zip("ids", "sizes", "h1", "h2")).alias("at", "d")).select("block", "at", "d.*")
    least = listed.groupBy("h1", "h2", "sizes").agg(F.min("ids").alias("least"), F.max("ids").alias("most")).where("least < most")
    copies = bucketed(listed.join(least, ["h1", "h2", "sizes"]).where("ids > least").groupBy("block").agg(
        F.collect_list("at").alias("copies")), "copies", "block", parts)  # of a block's own documents
    blocks = blocks.select("block", "ids", "sizes", "txt").join(copies, "block", "left")
    anchors = blocks.mapInArrow(_anchors(parts, length), "home long, block long, many long, anchors binary")
    shared = (anchors.repartition(parts, "home").mapInArrow(_shared, "block long, shared binary")
              .groupBy("block").agg(F.collect_list("shared").alias("shared")))  # a block's own anchors at most
    pieces = blocks.join(shared, "block").mapInArrow(
        _pieces(length), "anchor long, block long, key long, lo long, hi long, piece binary")
    results = (pieces.repartition(parts, "anchor").sortWithinPartitions("anchor")
               .mapInArrow(_solve(length), "block long, key long, at int, least long")
               .groupBy("block").agg(F.collect_list(F.struct("key", "at", "least")).alias("hits")))
    return blocks.join(results, "block", "left").mapInArrow(
        _removed(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
