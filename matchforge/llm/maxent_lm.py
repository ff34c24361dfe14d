"""Language-model scores by a hashed maximum-entropy model.

Events are the words of the training documents, one end per document, and one
event for all unknown words. A word's probability is that of its class given the
words before it, times its share of its class:

* Classes are a frequency band (powers of ten of the relative count) times a
  hash of the word's last two characters. The end is a class, and words counted
  once form a class with the unknown event, which gets the share that words seen
  once and twice suggest (Good and Turing).
* The class softmax has n-gram and skip features: the word before, the two
  before that (skipped over their successors), and the pair of the two before.
  Each is hashed to one of ``ROWS`` weight rows.

Training is by distributed gradient updates: in each of ``ROUNDS`` rounds the
tasks go over their part of the documents in mini-batches from the same weights,
and the token-weighted mean of their changes moves the weights. Every training
document is used once. The weights have a fixed size; counts do not, so counting
is a shuffle: each block's distinct words are dealt out by hash and come back to
the block with their counts over the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchforge.llm.common import bucketed, by_bytes, id_text, ship, shuffle_parts, stage
from matchforge.llm.words import codes_of, mix, per_doc, split_words

BLOCK_BYTES = 4 << 20
ROWS = 1 << 13
ROUNDS = 3
BATCH = 4096
RATE = 0.25
BANDS, ENDINGS = 8, 12
END_HASH = 0x9E3779B97F4A7C15  # no word hashes are expected to meet it
FEATURES = 4
SLICES = 16
TOGETHER = 16  # rows of a segment that are summed with those of the others

BLOCKS = ("block long, ids array<long>, held array<boolean>, sizes array<int>, codes binary, hashes binary, "
          "trained binary, endings binary")


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as codes into a block's own list of distinct words."""
    from xxhash import xxh64_intdigest

    part, number = TaskContext.get().partitionId(), 0
    for batch in by_bytes(batches, step=BLOCK_BYTES):
        n = batch.num_rows
        doc, words = split_words(pc.ascii_lower(pc.fill_null(batch.column("txt"), "")))
        code, distinct = codes_of(words)
        sizes = per_doc(doc, n) + 1
        flat = np.full(len(code) + n, len(distinct), dtype="<u4")  # the last code is the end
        flat[np.arange(len(code)) + doc] = code
        texts = distinct.to_pylist()
        hashes = np.array([*(xxh64_intdigest(w.encode()) for w in texts), END_HASH], dtype="<u8")
        endings = np.array([*(zlib.crc32(w[-2:].encode()) % ENDINGS for w in texts), 0], dtype=np.uint8)
        ids = batch.column("id").to_pylist()
        held = np.array([held_out(i) for i in ids])
        trained = np.bincount(flat[~np.repeat(held, sizes)], minlength=len(hashes)).astype("<u4")
        row = [(part << 33) + number, ids, held.tolist(), sizes.tolist(), *(x.tobytes() for x in (flat, hashes, trained, endings))]
        number += 1
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), *[pa.binary()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array([x], type=t) for x, t in zip(row, kinds)],
                                         ["block", "ids", "held", "sizes", "codes", "hashes", "trained", "endings"])


def _deal(parts: int):
    """A block's distinct words and training counts, dealt out by hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, hashes, trained in zip(*(batch.column(c).to_pylist() for c in ("block", "hashes", "trained"))):
                h, t = np.frombuffer(hashes, dtype="<u8"), np.frombuffer(trained, dtype="<u4")
                home = (h % np.uint64(parts)).astype(np.int64)
                order = np.argsort(home, kind="stable")
                to, at = np.unique(home[order], return_index=True)
                cut = [order[a:b] for a, b in zip(at, [*at[1:], len(order)])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to), pa.array(np.full(len(to), block)), pa.array([h[x].tobytes() for x in cut], type=pa.binary()),
                     pa.array([t[x].tobytes() for x in cut], type=pa.binary())], ["home", "block", "hashes", "trained"])
    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts over all blocks, back to each block in the order it sent its
    words; and the number of words with a count (block -1)."""
    homes: dict[int, list] = {}
    for batch in batches:
        for home, *rest in zip(*(batch.column(c).to_pylist() for c in ("home", "block", "hashes", "trained"))):
            homes.setdefault(home, []).append(rest)
    for home, rows in homes.items():
        h = [np.frombuffer(x[1], dtype="<u8") for x in rows]
        known, of = np.unique(np.concatenate(h), return_inverse=True)
        count = np.bincount(of, weights=np.concatenate([np.frombuffer(x[2], dtype="<u4") for x in rows]), minlength=len(known))
        back = np.split(count[of].astype("<i8"), np.cumsum([len(x) for x in h])[:-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array([*(x[0] for x in rows), -1]), pa.array([home] * (len(rows) + 1), type=pa.int64()),
             pa.array([*(zlib.compress(x.tobytes(), 1) for x in back), b""], type=pa.binary()),
             pa.array([*[0] * len(rows), int((count > 0).sum())], type=pa.int64())], ["block", "home", "counts", "kinds"])


def counts_of(hashes: np.ndarray, parts: int, back: list[dict]) -> np.ndarray:
    """Corpus counts of a block's words from what the homes sent back."""
    home = (hashes % np.uint64(parts)).astype(np.int64)
    order = np.argsort(home, kind="stable")
    sent = sorted(back, key=lambda x: x["home"])
    out = np.zeros(len(hashes), dtype=np.int64)
    out[order] = np.concatenate([np.frombuffer(zlib.decompress(x["counts"]), dtype="<i8") for x in sent])
    return out


def raw_classes(count: np.ndarray, endings: np.ndarray, total: int) -> np.ndarray:
    """0: the end; 1: words counted at most once; else band and ending."""
    band = np.clip(np.floor(-np.log10(np.maximum(count, 1) / max(total, 1))), 0, BANDS - 1).astype(np.int64)
    out = np.where(count <= 1, 1, 2 + band * ENDINGS + endings)
    out[-1] = 0
    return out


class Block:
    """One block, ready for training or scoring."""

    def __init__(self, row: dict, parts: int, total: int):
        self.ids, self.sizes = row["ids"], np.array(row["sizes"], dtype=np.int64)
        self.held = np.array(row["held"], dtype=bool)
        self.code = np.frombuffer(row["codes"], dtype="<u4").astype(np.int64) if "codes" in row else None
        self.hashes = np.frombuffer(row["hashes"], dtype="<u8")
        self.trained = np.frombuffer(row["trained"], dtype="<u4").astype(np.int64)
        self.count = counts_of(self.hashes, parts, row["back"])
        self.kind = raw_classes(self.count, np.frombuffer(row["endings"], dtype=np.uint8).astype(np.int64), total)

    def contexts(self) -> np.ndarray:
        """(tokens, FEATURES) weight rows; places before a document's start
        count as the end."""
        place = np.arange(len(self.code)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        end = len(self.hashes) - 1
        before = []
        for k in (1, 2, 3):
            p = np.full(len(self.code), end, dtype=np.int64)
            p[k:] = self.code[:-k]
            before.append(np.where(place >= k, p, end))
        low = np.uint64(ROWS - 1)
        words = [mix(self.hashes ^ np.uint64(k)) for k in (1, 2, 3, 4, 5)]
        cols = [(words[k][before[k]] & low) for k in range(3)] + [mix(words[3][before[0]] ^ words[4][before[1]]) & low]
        return np.stack(cols, axis=1).astype(np.int32)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _tally(parts: int, total: int):
    """Training tokens of each class, and of words counted once and twice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, once, twice = np.zeros(2 + BANDS * ENDINGS, dtype=np.int64), 0, 0
        for row in _rows(batches):
            b = Block(row, parts, total)
            sums += np.bincount(b.kind, weights=b.trained, minlength=len(sums)).astype(np.int64)
            once += int(b.trained[:-1][b.count[:-1] == 1].sum())
            twice += int(b.trained[:-1][b.count[:-1] == 2].sum())
        kinds = np.arange(len(sums) + 2)
        yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(np.r_[sums, once, twice])], ["kind", "tokens"])
    return run


def sums_of(g: np.ndarray, who: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows ``g[who]`` by segments that begin at ``first``: the
    first few rows of all segments at once, the rest of the long ones by themselves
    (``np.add.reduceat`` over rows takes three times as long)."""
    size = np.diff(np.r_[first, len(who)])
    out = g[who[first]]
    left = np.flatnonzero(size > 1)
    for k in range(1, TOGETHER):
        out[left] += g[who[first[left] + k]]
        left = left[size[left] > k + 1]
    for i in left.tolist():
        out[i] += g[who[first[i] + TOGETHER:first[i] + size[i]]].sum(axis=0)
    return out


class Weights:
    """Class biases and feature rows."""

    def __init__(self, bias: np.ndarray, rows: np.ndarray):
        self.bias, self.rows = bias.astype(np.float32), rows.astype(np.float32)

    def logits(self, at: np.ndarray) -> np.ndarray:
        out = self.rows[at[:, 0]]
        out += self.bias
        for f in range(1, FEATURES):
            out += self.rows[at[:, f]]
        return out

    def log_softmax(self, at: np.ndarray) -> np.ndarray:
        z = self.logits(at)
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def log_given(self, at: np.ndarray, y: np.ndarray) -> np.ndarray:
        """``log_softmax`` at the classes ``y`` only."""
        z = self.logits(at)
        z -= z.max(axis=1, keepdims=True)
        own = z[np.arange(len(y)), y]
        return own - np.log(np.exp(z, out=z).sum(axis=1))

    def step(self, at: np.ndarray, y: np.ndarray, grown: np.ndarray, rate: float) -> None:
        """One mini-batch: gradient of the mean log-loss by weight row, with
        each row's own step size (``grown``: its squared gradients so far)."""
        g = self.logits(at)
        g -= g.max(axis=1, keepdims=True)
        np.exp(g, out=g)
        g /= g.sum(axis=1, keepdims=True)
        g[np.arange(len(y)), y] -= 1
        flat = at.reshape(-1).astype(np.uint16)
        order = np.argsort(flat, kind="stable")
        s = flat[order]
        first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
        touched = s[first].astype(np.int64)
        change = sums_of(g, order // FEATURES, first)
        grown[touched] += (change * change).sum(axis=1)
        self.rows[touched] -= rate / np.sqrt(grown[touched])[:, None] * change


def _train(sent, parts: int, total: int, dense: np.ndarray, rate: float):
    """A task's pass over its blocks, from the round's weights; gives back its
    change in slices, times its tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bias, rows = sent.value
        w, grown, tokens = Weights(bias, rows.copy()), np.ones(ROWS, dtype=np.float32), 0
        for row in _rows(batches):
            b = Block(row, parts, total)
            use = np.flatnonzero(~np.repeat(b.held, b.sizes))
            y, at = dense[b.kind][b.code[use]], b.contexts()[use]
            for a in range(0, len(use), BATCH):
                w.step(at[a:a + BATCH], y[a:a + BATCH], grown, rate)
            tokens += len(use)
        if tokens:
            change = ((w.rows - rows) * tokens).astype("<f4")
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(SLICES)), pa.array([x.tobytes() for x in np.split(change, SLICES)], type=pa.binary()),
                 pa.array([tokens] * SLICES, type=pa.int64())], ["slice", "change", "tokens"])
    return run


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, list] = {}
    for batch in batches:
        for k, x, n in zip(*(batch.column(c).to_pylist() for c in ("slice", "change", "tokens"))):
            x = np.frombuffer(x, dtype="<f4").astype(np.float64)
            if k in sums:
                sums[k][0] += x
                sums[k][1] += n
            else:
                sums[k] = [x, n]
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums)), pa.array([(x / n).astype("<f4").tobytes() for x, n in sums.values()], type=pa.binary())],
            ["slice", "change"])


def _score(sent, parts: int, total: int, kinds: int, dense: np.ndarray, log_share: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = Weights(*sent.value)
        for row in _rows(batches):
            b = Block(row, parts, total)
            cls = dense[b.kind]
            inside = np.where(b.count > 1, np.log(np.maximum(b.count, 1)) - log_share["classes"][cls],
                              np.where(b.count == 1, log_share["once"], log_share["unknown"]))
            inside[-1] = 0.0
            base = np.log10((b.count + 1) / (total + kinds + 1))
            at, y = b.contexts(), cls[b.code]
            given = np.empty(len(y))
            for a in range(0, len(y), BATCH):
                part = y[a:a + BATCH]
                given[a:a + BATCH] = w.log_given(at[a:a + BATCH], part)
            doc = np.repeat(np.arange(len(b.sizes)), b.sizes)
            add = lambda x: np.bincount(doc, weights=x, minlength=len(b.sizes))
            yield pa.RecordBatch.from_arrays(
                [pa.array(b.ids, type=pa.int64()), pa.array(b.held), pa.array(b.sizes), pa.array(add(b.count[b.code] > 0).astype(np.int64)),
                 pa.array(np.full(len(b.sizes), total)), pa.array(add(base[b.code])),
                 pa.array(add(given + inside[b.code]) / np.log(10))],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)
    for every row of ``docs``.

    The model learns from rows whose crc32(id as text) mod 7 is not 2. Words
    are lower-cased (A-Z); each text ends with one end token. base_score is the
    add-one unigram log10 probability, score the model's, over the same events.
    Null texts count as empty; null ids are training rows; repeated rows count
    each; an empty table gives an empty result. Without training rows all words
    are unknown, and the classes are equally likely.
    """
    spark = docs.sparkSession
    ship(spark)
    parts = shuffle_parts(spark)
    blocks = bucketed(id_text(docs, id_col, text_col).mapInArrow(_blocks, BLOCKS), "lm_blocks", "block", parts)
    trained = F.aggregate(F.arrays_zip("held", "sizes"), F.lit(0).cast("long"),
                          lambda n, x: n + F.when(x["held"], 0).otherwise(x["sizes"]))
    total = int(blocks.agg(F.sum(trained)).first()[0] or 0)
    counted = stage(blocks.select("block", "hashes", "trained").mapInArrow(
        _deal(parts), "home long, block long, hashes binary, trained binary").repartition(parts, "home")
        .mapInArrow(_count, "block long, home long, counts binary, kinds long"), "lm-counts")
    kinds = int(counted.where("block = -1").agg(F.sum("kinds")).first()[0] or 0)
    back = bucketed(counted.where("block >= 0").groupBy("block").agg(F.collect_list(F.struct("home", "counts")).alias("back")),
                    "lm_back", "block", parts)  # a block's own words, as many as it sent
    joined = blocks.join(back, "block")
    tally = {r["kind"]: r["n"] for r in joined.drop("codes").mapInArrow(_tally(parts, total), "kind long, tokens long")
             .groupBy("kind").agg(F.sum("tokens").alias("n")).collect()}  # one row per class
    n_raw = 2 + BANDS * ENDINGS
    sums = np.array([tally.get(k, 0) for k in range(n_raw)], dtype=float)
    once, twice = tally.get(n_raw, 0), tally.get(n_raw + 1, 0) / 2
    present = [k for k in range(n_raw) if sums[k] > 0 or k < 2]
    dense = np.zeros(n_raw, dtype=np.int64)
    dense[present] = np.arange(len(present))
    unknown = once / (once + 2 * twice) if once else 1.0
    unknown = min(unknown, 1 - 1e-3) if once else 1.0
    log_share = {"classes": np.log(np.maximum(sums[present], 1)), "unknown": float(np.log(unknown)),
                 "once": float(np.log((1 - unknown) / once)) if once else 0.0}
    bias = np.log((sums[present] + 1) / (sums[present] + 1).sum())
    rows = np.zeros((ROWS, len(present)), dtype=np.float32)
    for k in range(ROUNDS):
        sent = spark.sparkContext.broadcast((bias, rows))  # ROWS times classes, whatever the data
        part = joined.where(F.pmod(F.xxhash64("block"), F.lit(ROUNDS)) == k)
        moved = (part.mapInArrow(_train(sent, parts, total, dense, rate), "slice long, change binary, tokens long")
                 .repartition(SLICES, "slice").mapInArrow(_sum, "slice long, change binary").collect())
        rows = rows.copy().reshape(SLICES, -1)
        for r in moved:
            rows[r["slice"]] += np.frombuffer(r["change"], dtype="<f4")
        rows = rows.reshape(ROWS, len(present))
    sent = spark.sparkContext.broadcast((bias, rows))
    return joined.mapInArrow(_score(sent, parts, total, kinds, dense, log_share),
                             "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                             "base_score double, score double")
