"""Source divergence audit: how far each (language, source) group's word use
lies from the other sources of its language, and which terms it overuses.

Indexing is single-pass in memory. A task numbers terms in a dictionary and
gathers the postings (group, occurrences, documents) of a block; when the block
is full, it leaves as a term-sorted run, cut by hash shard, and the dictionary
starts anew. Chunks of runs meet in their shard, ordered by their first term; a
heap holds one cursor for each open chunk, merges equal terms and emits their
frequencies in term order, so a shard is never held whole.

Divergence sums f = floor((p - q)^2 / (p + q)) over all kept terms of a
language. With p0 a source's share of a term that it does not use, and V kept
terms, the sum over a pair (s, t) of sources is

    A(s, t) + A(t, s) - V * f(p0s, p0t) + C(s, t)

A(s, t) sets every share of s against p0t; it needs only how many terms of s
have a share. C corrects the terms that both use; it is streamed from the
frequencies, a term's postings at a time, into sums for each pair.

All arithmetic is in integers and exact.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchforge.llm.common import by_bytes, ship, shuffle_parts, stage
from matchforge.operators.joins import sized_broadcast

#: Postings and dictionary entries of a block; postings of a chunk.
BLOCK_POSTINGS, BLOCK_TERMS, CHUNK = 2_000_000, 300_000, 20_000
#: Rows of an Arrow batch that leaves a task, pairs whose sums a task holds.
BATCH_ROWS, HELD_PAIRS = 20_000, 1_000_000

#: Bytes of terms stay (A-Z as a-z); every other byte becomes a blank. Bytes
#: of characters beyond ASCII are all above 0x7F.
TERM_BYTES = bytes(c if c > 0x7F or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))

RUNS = "shard int, lang string, first string, terms array<string>, sizes array<int>, names array<string>, source array<int>, n array<bigint>, docs array<bigint>"
FREQUENCIES = "lang string, term string, docs bigint, sources array<string>, n array<bigint>"
ARROW = pa.schema([("shard", pa.int32()), ("lang", pa.string()), ("first", pa.string()), ("terms", pa.list_(pa.string())), ("sizes", pa.list_(pa.int32())),
                   ("names", pa.list_(pa.string())), ("source", pa.list_(pa.int32())), ("n", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64()))])


def _summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the sums of their values."""
    if not len(key):
        return key, *values
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[at], *(np.add.reduceat(v[order], at) for v in values)


class Block:
    """Postings of the texts that were added since the last run."""

    def __init__(self, shards: int):
        self.shards = shards
        self.clear()

    def clear(self) -> None:
        self.terms, self.groups, self.parts, self.size = {b"": 0}, {}, [], 0

    def full(self) -> bool:
        if self.size > BLOCK_POSTINGS:  # equal postings of several steps become one
            self.parts = [_summed(*(np.concatenate(x) for x in zip(*self.parts)))]
            self.size = len(self.parts[0][0])
        return self.size > BLOCK_POSTINGS // 2 or len(self.terms) > BLOCK_TERMS

    def add(self, texts: list[bytes], groups: list[tuple[str, str]]) -> None:
        number, known = self.groups, self.terms
        group = np.array([number.setdefault(g, len(number)) for g in groups], dtype=np.int64)
        ids, sizes = [], []
        for t in texts:
            words = t.translate(TERM_BYTES).split()
            for w in set(words).difference(known):
                known[w] = len(known)
            ids.append(np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words)))
            sizes.append(len(words))
        # The empty term has one posting for each document: it marks the groups that occur.
        doc = np.r_[np.repeat(np.arange(len(texts)), sizes), np.arange(len(texts))]
        key, n = np.unique(doc << 32 | np.concatenate([*ids, np.zeros(len(texts), dtype=np.int64)]), return_counts=True)
        posting = (key & 0xFFFFFFFF) << 32 | group[key >> 32]
        self.parts.append(_summed(posting, n, np.ones_like(n)))
        self.size += len(self.parts[-1][0])

    def run(self) -> Iterator[pa.RecordBatch]:
        """The block as a run, in order of (shard, language, term)."""
        if not self.parts:
            return
        key, n, docs = _summed(*(np.concatenate(x) for x in zip(*self.parts)))
        terms, groups = list(self.terms), list(self.groups)
        self.clear()
        place = np.empty(len(terms), dtype=np.int64)
        place[sorted(range(len(terms)), key=terms.__getitem__)] = np.arange(len(terms))
        shard = np.fromiter((zlib.crc32(t) % self.shards for t in terms), dtype=np.int64, count=len(terms))
        langs = sorted({g[0] for g in groups}, key=str.encode)
        lang = np.array([langs.index(g[0]) for g in groups])
        term, group = key >> 32, key & 0xFFFFFFFF
        order = np.lexsort((place[term], lang[group], shard[term]))
        term, group, n, docs = term[order], group[order], n[order], docs[order]
        piece = shard[term] * len(langs) + lang[group]
        new_term = np.r_[True, (term[1:] != term[:-1]) | (piece[1:] != piece[:-1])]
        starts = np.flatnonzero(new_term)  # of the postings of a (language, term)
        new = np.r_[True, piece[starts][1:] != piece[starts][:-1]] | np.r_[True, np.diff(starts // CHUNK) > 0]
        cuts, ends, rows = np.flatnonzero(new).tolist(), np.r_[starts, len(term)], []
        for a, b in zip(cuts, [*cuts[1:], len(starts)]):
            x, y = ends[a], ends[b]
            used, source = np.unique(group[x:y], return_inverse=True)
            names = [terms[t].decode("utf-8", "replace") for t in term[starts[a:b]].tolist()]
            rows.append((int(shard[term[x]]), langs[lang[group[x]]], names[0], names, np.diff(ends[a:b + 1]), [groups[g][1] for g in used.tolist()], source, n[x:y], docs[x:y]))
            if len(rows) == 500 or y - x > CHUNK // 4:
                yield _chunks(rows)
                rows = []
        if rows:
            yield _chunks(rows)


def _chunks(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(zip(*rows), ARROW)], schema=ARROW)


def index_runs(docs: DataFrame, shards: int) -> DataFrame:
    """(lang, source, txt) -> chunks of term-sorted runs."""
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(shards)
        for batch in by_bytes(batches):
            texts = pc.fill_null(batch.column("txt"), "").cast(pa.binary()).to_pylist()
            block.add(texts, list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())))
            if block.full():
                yield from block.run()
        yield from block.run()
    return docs.mapInArrow(index, RUNS)


def _cursors(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Chunks as (key of the first term, its rows), one at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            v = {f.name: batch.column(k)[i] for k, f in enumerate(batch.schema)}
            shard, lang, sizes = v["shard"].as_py(), v["lang"].as_py().encode(), v["sizes"].values.to_numpy()
            terms, names = v["terms"].as_py(), v["names"].as_py()
            source, n, docs = (v[k].values.to_numpy().tolist() for k in ("source", "n", "docs"))
            ends = np.r_[0, np.cumsum(sizes)].tolist()
            yield shard, lang, terms, names, source, n, docs, ends


def merged_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, bytes, int, dict[str, int]]]:
    """Heap-merge of chunks that come ordered by (shard, language, first
    term): (language, term, documents, occurrences by source), once each."""
    heap, key, docs, found, coming = [], None, 0, {}, _cursors(batches)
    nxt, serial = next(coming, None), 0
    while heap or nxt is not None:
        while nxt is not None and (not heap or (nxt[0], nxt[1], nxt[2][0].encode()) <= heap[0][:3]):
            serial += 1
            heapq.heappush(heap, (nxt[0], nxt[1], nxt[2][0].encode(), serial, 0, nxt))
            nxt = next(coming, None)
        shard, lang, term, tie, i, chunk = heap[0]
        _, _, terms, names, source, n, d, ends = chunk
        if key != (shard, lang, term):
            if key is not None:
                yield key[1], key[2], docs, found
            key, docs, found = (shard, lang, term), 0, {}
        for k in range(ends[i], ends[i + 1]):
            docs += d[k]
            name = names[source[k]]
            found[name] = found.get(name, 0) + n[k]
        if i + 1 < len(terms):
            heapq.heapreplace(heap, (shard, lang, terms[i + 1].encode(), tie, i + 1, chunk))
        else:
            heapq.heappop(heap)
    if key is not None:
        yield key[1], key[2], docs, found


def term_frequencies(runs: DataFrame, min_docs: int) -> DataFrame:
    """Kept terms with their occurrences by source; the empty term of each
    language lists all sources (its numbers count documents)."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "term", "docs", "sources", "n"]
        types = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())]
        rows, size = [], 0
        for lang, term, docs, found in merged_terms(batches):
            if docs >= min_docs or not term:
                by_name = sorted(found.items(), key=lambda x: x[0].encode())
                rows.append((lang.decode(), term.decode(), docs, [s for s, _ in by_name], [n for _, n in by_name]))
                size += len(by_name)
            if size > 10 * BATCH_ROWS or len(rows) >= BATCH_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), type=t) for c, t in zip(zip(*rows), types)], names=names)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), type=t) for c, t in zip(zip(*rows), types)], names=names)
    return (runs.repartitionById(shuffle_parts(runs.sparkSession), "shard")
            .sortWithinPartitions("shard", "lang", "first").mapInArrow(merge, FREQUENCIES))


def _share(n: str, of: str) -> str:
    """SQL of 1 + floor(10^9 n / of) for n <= of; the product can pass 64 bits
    and is a decimal."""
    return f"(1 + (1000000000BD * cast({n} as decimal(20, 0))) div cast({of} as decimal(20, 0)))"


def _f(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q})) div (({p}) + ({q})))"


def _pairs_of_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, term, source, p, p0), terms together and sources in order ->
    sums of what the terms used by both add to a pair of sources."""
    def f(p, q):
        return (p - q) * (p - q) // (p + q)

    def codes(column: pa.Array, seen: dict[str, int]) -> np.ndarray:
        d = column.dictionary_encode()
        return np.array([seen.setdefault(x, len(seen)) for x in d.dictionary.to_pylist()], dtype=np.int64)[d.indices.to_numpy()]

    def emit():
        key, value = _summed(*(np.concatenate(x) for x in zip(*held)))
        lang, a, b = np.array([*langs], dtype=object)[key >> 42], key >> 21 & 0x1FFFFF, key & 0x1FFFFF
        names = np.array([*sources], dtype=object)
        for i in range(0, len(key), BATCH_ROWS):
            s = slice(i, i + BATCH_ROWS)
            yield pa.RecordBatch.from_arrays([pa.array(lang[s], pa.string()), pa.array(names[a[s]], pa.string()), pa.array(names[b[s]], pa.string()), pa.array(value[s], pa.int64())], names=["lang", "source", "item", "value"])

    langs, sources, held, size, rest = {}, {}, [], 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        if rest is not None:
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        same = pc.and_(pc.equal(batch.column("lang").slice(1), batch.column("lang").slice(0, batch.num_rows - 1)),
                       pc.equal(batch.column("term").slice(1), batch.column("term").slice(0, batch.num_rows - 1))).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.r_[True, ~same])
        rest = batch.slice(starts[-1])  # the last term may go on in the next batch
        batch = batch.slice(0, starts[-1])
        for key, value in _pairs_of(batch, starts, f, codes, langs, sources):
            held.append((key, value))
            size += len(key)
            if size > HELD_PAIRS:
                held = [_summed(*(np.concatenate(x) for x in zip(*held)))]
                size = len(held[0][0])
                if size > HELD_PAIRS // 2:
                    yield from emit()
                    held, size = [], 0
        if len(sources) > 1_000_000:  # numbers of sources have 21 bits
            if held:
                yield from emit()
            held, size, langs, sources = [], 0, {}, {}
    if rest is not None:
        held += _pairs_of(rest, np.array([0]), f, codes, langs, sources)
    if held:
        yield from emit()


def _pairs_of(batch, starts, f, codes, langs, sources):
    """Corrections of all pairs of postings of a term: postings that are
    ``d`` places apart, for each d up to the longest list."""
    n = batch.num_rows
    if not n:
        return
    lang, source = codes(batch.column("lang"), langs), codes(batch.column("source"), sources)
    p, p0 = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("p", "p0"))
    ends = np.r_[starts[starts < n][1:], n]
    left = np.repeat(ends, np.diff(np.r_[starts[starts < n], n])) - np.arange(n) - 1  # postings of the term behind this one
    d, i = 1, np.flatnonzero(left >= 1)
    while len(i):
        j = i + d
        yield (lang[i] << 42 | source[i] << 21 | source[j],
               f(p[i], p[j]) - f(p[i], p0[j]) - f(p0[i], p[j]) + f(p0[i], p0[j]))
        d += 1
        i = i[left[i] >= d]


def source_divergence(docs: DataFrame, min_docs: int = 10, top_terms: int = 10, text_col: str = "text",
                      lang_col: str = "lang", source_col: str = "source", shards: int | None = None) -> DataFrame:
    """(lang, source, part, item, value long, rank int).

    Part ``pair``: each other source of the language and the divergence from
    it over all kept terms. Part ``term``: the ``top_terms`` terms that the
    group uses more than its language does. Kept terms are in at least
    ``min_docs`` documents (rows) of the language.

    Null texts, languages and sources count as ''. Empty texts have no terms,
    but their group is there. A language without kept terms has pairs of value
    0. Repeated rows count each. Other columns are not read. An empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(*(F.coalesce(docs[c].cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "txt"))))
    freq = stage(term_frequencies(index_runs(rows, shards or shuffle_parts(spark)), min_docs), "frequencies")
    postings = (freq.where("term <> ''").withColumn("all_n", F.expr("aggregate(n, 0L, (a, x) -> a + x)"))
                .select("lang", "term", "all_n", F.explode(F.arrays_zip("sources", "n")).alias("x"))
                .select("lang", "term", "all_n", F.col("x.sources").alias("source"), F.col("x.n").alias("n")))
    groups = freq.where("term = ''").select("lang", F.explode("sources").alias("source"))
    totals = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("used"))
    by_lang = freq.where("term <> ''").groupBy("lang").agg(F.count("*").alias("v"), F.sum(F.expr("aggregate(n, 0L, (a, x) -> a + x)")).alias("lang_total"))
    stats = stage(groups.join(totals, ["lang", "source"], "left").join(sized_broadcast(by_lang), "lang", "left")
                  .fillna(0, ["total", "used", "v", "lang_total"])
                  .withColumn("p0", F.expr(f"if(v = 0, 0L, {_share('2L', 'if(v = 0, 1L, total + 2 * v)')})")), "groups")
    small = sized_broadcast(stats)
    shares = (postings.join(small, ["lang", "source"])
              .withColumn("p", F.expr(_share("n + 2", "total + 2 * v"))).withColumn("q", F.expr(_share("all_n + 2", "lang_total + 2 * v"))))
    terms = (shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(_f("p", "q")).alias("value")))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    terms = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)

    other = small.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    used = (shares.groupBy("lang", "source", "p").agg(F.count("*").alias("n_terms"))
            .unionByName(stats.where("v > used").select("lang", "source", F.col("p0").alias("p"), (F.col("v") - F.col("used")).alias("n_terms"))))
    against = (used.join(other, "lang").where("source <> item")
               .select("lang", "source", "item", F.expr(f"n_terms * {_f('p', 'q0')}").alias("value")).groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    common = shares.select("lang", "term", "source", "p", "p0")
    if small is stats:  # too many groups to broadcast: the join has dealt the postings anew
        common = common.repartition("lang", "term")
    common = common.sortWithinPartitions("lang", "term", "source").mapInArrow(_pairs_of_terms, "lang string, source string, item string, value bigint")
    base = stats.join(other, "lang").where("source <> item").select(
        "lang", "source", "item", F.expr("if(v = 0, 0L, -v * " + _f("p0", "if(v = 0, 1L, q0)") + ")").alias("value"))
    parts = base
    for x in (against, common):
        parts = parts.unionByName(x).unionByName(x.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    pairs = (parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(order)))
    return pairs.unionByName(terms)
