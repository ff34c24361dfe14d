"""SimHash near-duplicates with bit-sliced comparison.

Fingerprints of word shingles are compared inside pigeonhole buckets: the 64
bits are cut into ``radius + m`` blocks and, if two fingerprints differ in at
most ``radius`` bits, at least ``m`` blocks agree, so one of the C(radius+m, m)
block choices puts both in one bucket. ``m`` grows with the number of distinct
fingerprints only to keep buckets small; the links found are the same for any
``m``.

A bucket is compared vertically. 64 fingerprints are one *word row*: 64 machine
words, word b holding bit b of all 64. A query fingerprint is held against a
word row one plane at a time; three machine words (ones, twos, and a sticky
"beyond the radius") count the differing bits of all 64 lanes at once by
carry-save addition, and a row is abandoned when every lane is beyond.

Buckets above ``BLOCK`` fingerprints are cut into chunks and every pair of
chunks is its own task group, so a hot bucket is spread over tasks. A task
emits only the links that join two parts of its own forest, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from matchforge.llm.common import id_text, ship, shuffle_parts, stage
from matchforge.llm.components import connected_components

#: Fingerprints of one bucket chunk; two chunks meet in one task group.
BLOCK = 4096
#: Mean bucket size above which one more block must agree.
MEAN_BUCKET = 64
#: (query, word row) combinations that one vectorised step compares.
STEP = 1 << 14


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Fingerprint of lower-cased (A-Z) UTF-8 text: a bit is 1 if it is set in
    over half of the XXH64 (seed 42) hashes of all word shingles, repeats
    included. Fewer words than a shingle: one shingle of all of them. No word:
    zero."""
    from xxhash import xxh64_intdigest

    words = text.split()  # ASCII white space: 0x20 and 0x09-0x0D
    n = len(words) - shingle + 1
    if not words:
        return 0
    if n <= 1:
        return xxh64_intdigest(b" ".join(words), 42)
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    h = np.fromiter(map(xxh64_intdigest, grams, repeat(42)), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for s in range(0, n, 1 << 14):
        part = h[s:s + (1 << 14)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = pc.ascii_lower(pc.fill_null(batch.column("txt"), "")).cast(pa.binary())
            fp = np.fromiter((fingerprint(x.as_py(), shingle) for x in low), dtype=np.uint64, count=len(low))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fp.view(np.int64))], ["id", "fp"])
    return run


class Forest:
    """Union-find over 0..n-1 with array roots, grown by blocks of links."""

    def __init__(self, n: int):
        self.up = np.arange(n, dtype=np.int64)

    def roots(self, x: np.ndarray) -> np.ndarray:
        r = self.up[x]
        while True:
            nxt = self.up[r]
            if np.array_equal(nxt, r):
                return r
            r = nxt

    def add(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Joins the ends of all links; gives back links that are enough for
        it (each joined two parts when it was added)."""
        out_a, out_b = [], []
        while len(a):
            ra, rb = self.roots(a), self.roots(b)
            keep = ra != rb
            a, b, ra, rb = a[keep], b[keep], ra[keep], rb[keep]
            if not len(a):
                break
            hi, lo = np.maximum(ra, rb), np.minimum(ra, rb)
            hi, first = np.unique(hi, return_index=True)  # one link per upper root: no cycles
            self.up[hi] = lo[first]
            out_a.append(a[first])
            out_b.append(b[first])
        self.up = self.roots(np.arange(len(self.up)))
        none = np.zeros(0, dtype=np.int64)
        return np.concatenate([none, *out_a]), np.concatenate([none, *out_b])


def planes_of(fps: np.ndarray) -> np.ndarray:
    """Vertical storage: (64, rows) words; bit i of plane b of row r is bit b
    of fingerprint 64 r + i. The last row is filled up with zeros."""
    rows = -(-len(fps) // 64)
    full = np.zeros(rows * 64, dtype="<u8")
    full[:len(fps)] = fps
    bits = np.unpackbits(full.view(np.uint8).reshape(rows, 64, 8), axis=2, bitorder="little")
    packed = np.packbits(np.ascontiguousarray(bits.transpose(2, 0, 1)), axis=2, bitorder="little")
    return np.ascontiguousarray(packed).view("<u8").reshape(64, rows)


def within(planes: np.ndarray, lanes: np.ndarray, queries: np.ndarray, rows: np.ndarray, radius: int):
    """For each combination k: which lanes of word row ``rows[k]`` are within
    ``radius`` (0 to 3) differing bits of ``queries[k]``. Gives back the
    combinations that have such lanes, and a lane mask for each."""
    live = np.arange(len(queries))
    q, r, over = queries, rows, ~lanes[rows]
    ones, twos = np.zeros(len(q), dtype=np.uint64), np.zeros(len(q), dtype=np.uint64)
    full, bit1 = np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(1)
    for b in range(64):
        diff = planes[b][r] ^ (np.uint64(0) - ((q >> np.uint64(b)) & bit1))
        carry = ones & diff
        ones = ones ^ diff
        over = over | (twos & carry)
        twos = twos ^ carry
        if b % 8 == 7:
            keep = over != full
            if not keep.all():
                live, q, r, over, ones, twos = (x[keep] for x in (live, q, r, over, ones, twos))
                if not len(live):
                    break
    if radius < 3:
        over = over | {2: ones & twos, 1: twos, 0: ones | twos}[radius]
    hit = ~over
    keep = hit != 0
    return live[keep], hit[keep]


def _compare(groups: np.ndarray, node: np.ndarray, side: np.ndarray, fps: np.ndarray, forest: Forest,
             radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between members of one group (rows sorted by group; in a group of
    two chunks only links across sides are new, so sides 0 and 1 are told
    apart; side 2 is a chunk by itself)."""
    start = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    size = np.diff(np.r_[start, len(groups)])
    many = size > 1
    start, size = start[many], size[many]
    if not len(start):
        none = np.zeros(0, dtype=np.int64)
        return none, none
    # Every bucket gets word rows of its own: slot = position in those rows.
    n_rows = -(-size // 64)
    row0 = np.r_[0, np.cumsum(n_rows)[:-1]]
    member = np.repeat(start, size) + (np.arange(size.sum()) - np.repeat(np.r_[0, np.cumsum(size)[:-1]], size))
    inner = np.arange(size.sum()) - np.repeat(np.r_[0, np.cumsum(size)[:-1]], size)
    slot = np.repeat(row0 * 64, size) + inner
    total = int(n_rows.sum())
    held, used = np.zeros(total * 64, dtype=np.uint64), np.zeros(total * 64, dtype=bool)
    at = np.zeros(total * 64, dtype=np.int64)
    held[slot], used[slot], at[slot] = fps[member], True, member
    planes = planes_of(held)
    lanes = np.packbits(used.reshape(total, 64), axis=1, bitorder="little").view("<u8").reshape(total)
    # A query meets its own word row and the later ones of its bucket.
    bucket = np.repeat(np.arange(len(size)), size)
    first = row0[bucket] + inner // 64
    rows_each = row0[bucket] + n_rows[bucket] - first
    out_a, out_b = [], []
    ends = np.cumsum(rows_each)
    i = 0
    while i < len(member):
        base = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, base + STEP, side="right")))
        each = rows_each[i:j]
        which = np.repeat(np.arange(i, j), each)
        rows = np.repeat(first[i:j], each) + (np.arange(len(which)) - np.repeat(np.cumsum(each) - each, each))
        k, mask = within(planes, lanes, fps[member[which]], rows, radius)
        if len(k):
            bits = np.unpackbits(mask.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, lane = np.nonzero(bits)
            a, b = member[which[k[row]]], at[rows[k[row]] * 64 + lane]
            new = (b > a) & ((side[a] != side[b]) | (side[a] == 2))
            a, b = forest.add(node[a[new]], node[b[new]])
            out_a.append(a)
            out_b.append(b)
        i = j
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *out_a]), np.concatenate([none, *out_b])


def _links(radius: int, hold: int = 1 << 20):
    """Sorted rows (g, side, fp) of whole groups -> links enough to connect
    what the task's groups connect."""
    def work(g, side, fp):
        uniq, node = np.unique(fp, return_inverse=True)
        a, b = _compare(g, node, side, fp.view(np.uint64), Forest(len(uniq)), radius)
        return pa.RecordBatch.from_arrays([pa.array(uniq[a]), pa.array(uniq[b])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple] = []
        rows = 0
        for batch in batches:
            kept.append(tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("g", "side", "fp")))
            rows += batch.num_rows
            if rows >= hold:
                g, side, fp = (np.concatenate(x) for x in zip(*kept))
                cut = int(np.searchsorted(g, g[-1]))  # the last group may go on
                if cut:
                    yield work(g[:cut], side[:cut], fp[:cut])
                kept, rows = [(g[cut:], side[cut:], fp[cut:])], len(g) - cut
        if rows:
            yield work(*(np.concatenate(x) for x in zip(*kept)))
    return run


def _choices(radius: int, agree: int) -> list[int]:
    """Bit masks of the block choices: all ways to take ``agree`` of
    ``radius + agree`` blocks."""
    n = radius + agree
    edges = [round(64 * i / n) for i in range(n + 1)]
    blocks = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(n)]
    return [sum(c) for c in combinations(blocks, agree)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def links_of(distinct: DataFrame, radius: int, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints (column fp, no
    repeats) connected by steps of at most ``radius`` differing bits."""
    spark = distinct.sparkSession
    if not 0 <= radius <= 3:
        raise ValueError("the counters hold radii 0 to 3")
    n, agree = distinct.count(), 1
    while n > MEAN_BUCKET * 2 ** (64 * agree // (radius + agree)) and agree < 4:
        agree += 1
    masks = [_signed(m) for m in _choices(radius, agree)]
    keyed = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
        for i, m in enumerate(masks)])).alias("k")).select("k.t", "k.key", "fp")
    sizes = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    sized = keyed.join(sizes, ["t", "key"]).withColumn("chunks", F.ceil(F.col("n") / block).cast("int"))
    chunk = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    met = (sized.withColumn("c", chunk)
           .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
           .withColumn("lo", F.least("c", "o")).withColumn("hi", F.greatest("c", "o"))
           .withColumn("side", F.when(F.col("c") == F.col("o"), 2).when(F.col("c") == F.col("lo"), 0).otherwise(1)))
    # A chunk pair's own groups: both sides by themselves are compared in (c, c).
    g = F.xxhash64("t", "key", "lo", "hi")
    rows = met.select(g.alias("g"), F.col("side").cast("int").alias("side"), "fp")
    return (rows.repartition(shuffle_parts(spark), "g").sortWithinPartitions("g")
            .mapInArrow(_links(radius), "a long, b long"))


def component_roots(distinct: DataFrame, radius: int) -> DataFrame:
    """(fp, rep, root) of a staged table of distinct fingerprints (fp, rep)."""
    parts = stage(connected_components(links_of(distinct.select("fp"), radius)), "parts")
    return distinct.join(parts, distinct["fp"] == parts["node"], "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                       radius: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    component_id is the smallest id that is reachable over links of at most
    ``radius`` differing bits, the row's own included. Null text counts as
    empty (fingerprint zero, linked like any other). A null id keeps its row;
    it is never the smallest, so component_id is null only if all ids of the
    component are. Repeated ids and rows all come back. An empty table gives an
    empty result.
    """
    ship(docs.sparkSession)
    prints = stage(id_text(docs, id_col, text_col).mapInArrow(_fingerprints(shingle), "id long, fp long"), "prints")
    rooted = component_roots(stage(prints.groupBy("fp").agg(F.min("id").alias("rep")), "distinct-prints"), radius)
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    of = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(of, "fp").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _with_print(shingle: int, text_col: str, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = pc.ascii_lower(pc.fill_null(batch.column(text_col), "")).cast(pa.binary())
            fp = np.fromiter((fingerprint(x.as_py(), shingle) for x in low), dtype=np.uint64, count=len(low))
            yield batch.append_column(name, pa.array(fp.view(np.int64)))
    return run


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
               radius: int = 3) -> DataFrame:
    """The rows of ``docs``, all columns: one of each component, that of the
    smallest id (of equal ids, the smallest fingerprint, then text hash; null
    ids only where a component has no other)."""
    ship(docs.sparkSession)
    marked = docs.mapInArrow(_with_print(shingle, text_col, "_fp"), StructType([*docs.schema, StructField("_fp", LongType())]))
    prints = stage(marked.select(F.col(id_col).cast("long").alias("id"), F.col("_fp").alias("fp")), "prints")
    rooted = component_roots(stage(prints.groupBy("fp").agg(F.min("id").alias("rep")), "distinct-prints"), radius)
    first = F.struct(F.col("rep").isNull().alias("none"), "rep", "fp")
    kept = rooted.groupBy("root").agg(F.min(first).alias("k")).select(
        F.col("k.rep").alias("_kept_id"), F.col("k.fp").alias("_kept_fp"))
    rows = marked.join(kept, marked[id_col].cast("long").eqNullSafe(kept["_kept_id"]) & (marked["_fp"] == kept["_kept_fp"]),
                       "left_semi")
    same = Window.partitionBy(F.col(id_col).cast("long"), "_fp").orderBy(F.xxhash64(text_col))
    return rows.withColumn("_nth", F.row_number().over(same)).where("_nth = 1").select(*docs.columns)
