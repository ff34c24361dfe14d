"""Token-id files with fixed-width bit packing.

A file holds the ids of consecutive documents, each id in the fewest bits that
the vocabulary needs, least significant bit first. Blocks of ``BLOCK`` ids start
on byte boundaries; their byte offsets and, for each document, its id and its
first id's place are stored behind them, so any document or id is read without
its predecessors, and numpy unpacks whole blocks at once.

    header   magic, version, bits, ids per block, ids, documents, blocks
    blocks   packed ids
    tables   block offsets (u64), document ids (i64), document starts (u64)

Writing: documents are range-partitioned by id, one file per partition, streamed
block by block into the shared folder under a name of the attempt's own and then
renamed; the task reports one manifest row. A retry writes its own file.
"""

from __future__ import annotations

import os
import re
import string
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchforge.llm.common import Cuts, by_bytes, id_text, pooled, ship, shuffle_parts, sliced, stage
from matchforge.llm.words import as_bytes, cut_texts
from matchforge.session import scratch_path

MAGIC = b"MFTOKEN1"
HEADER = struct.Struct("<8sIIQQQQ")  # magic, bits, ids per block, ids, documents, blocks, tables at
BLOCK = 1 << 16
NO_ID = -(1 << 63)  # stands for a null document id
STEP = 4 << 20
BATCH = 20_000  # chunks that the tokenizer encodes at a time
MARKS = ".,;:!?"

#: A chunk is white space and what follows up to the next white space. The
#: tokenizer's own splitting always cuts where a chunk begins, except at white
#: space beyond ASCII, so texts that have such are encoded whole.
WIDE_SPACE = "[%s]" % "".join(f"\\x{{{c:x}}}" for c in [
    *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200E), *range(0x2028, 0x2030), 0x205F, 0x2060, 0x3000, 0xFEFF])
IS_SPACE, IS_MARK, IS_LETTER = (np.isin(np.arange(256), list(x)) for x in (
    b" \t\n\v\f\r", MARKS.encode(), string.ascii_letters.encode()))


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as a bit stream, filled up to whole bytes."""
    if bits == 16:
        return ids.astype("<u2").tobytes()
    low = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    return np.packbits(np.unpackbits(low, axis=1, bitorder="little")[:, :bits].reshape(-1), bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int, first: int = 0) -> np.ndarray:
    """``n`` ids of a packed block, from its id number ``first`` on."""
    at = (first + np.arange(n, dtype=np.int64)) * bits
    raw = np.frombuffer(data + b"\0" * 8, dtype=np.uint8)
    words = np.lib.stride_tricks.as_strided(raw, shape=(len(raw) - 7, 8), strides=(1, 1))[at >> 3].copy().view("<u8")[:, 0]
    return ((words >> (at & 7).astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.uint32)


class Writer:
    """Streams one file: blocks as they fill, tables at the end."""

    def __init__(self, out, bits: int):
        self.out, self.bits = out, bits
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0
        self.offsets: list[int] = []
        self.docs: list[np.ndarray] = []
        self.starts: list[np.ndarray] = []
        self.at = HEADER.size
        out.write(b"\0" * HEADER.size)

    def add(self, doc_ids: np.ndarray, lists: list[np.ndarray]) -> None:
        sizes = np.array([len(x) for x in lists], dtype=np.int64)
        self.docs.append(doc_ids)
        self.starts.append(self.n_ids + np.cumsum(sizes) - sizes)
        self.held += lists
        self.n_ids += int(sizes.sum())
        self.n_held += int(sizes.sum())
        if self.n_held >= BLOCK:
            self._blocks(False)

    def _blocks(self, last: bool) -> None:
        flat = np.concatenate(self.held) if self.held else np.zeros(0, dtype=np.uint32)
        stop = len(flat) if last else len(flat) // BLOCK * BLOCK
        for a in range(0, stop, BLOCK):
            data = pack(flat[a:min(a + BLOCK, stop)], self.bits)
            self.offsets.append(self.at)
            self.out.write(data)
            self.at += len(data)
        self.held, self.n_held = [flat[stop:]], len(flat) - stop

    def close(self) -> bytes:
        """The header, which belongs at the file's front."""
        self._blocks(True)
        none = np.zeros(0, dtype=np.int64)
        docs, starts = np.concatenate([none, *self.docs]), np.concatenate([none, *self.starts])
        self.out.write(np.array(self.offsets, dtype="<u8").tobytes() + docs.astype("<i8").tobytes() + starts.astype("<u8").tobytes())
        head = HEADER.pack(MAGIC, self.bits, BLOCK, self.n_ids, len(docs), len(self.offsets), self.at)
        self.out.write(head)  # stores that only append keep it at the end
        return head


class Reader:
    """Random access to one file (any object with seek and read)."""

    def __init__(self, f):
        self.f = f
        f.seek(0, 2)
        f.seek(f.tell() - HEADER.size)
        magic, self.bits, self.block, self.n_ids, self.n_docs, self.n_blocks, at = HEADER.unpack(f.read(HEADER.size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        f.seek(at)
        tables = f.read(8 * (self.n_blocks + 2 * self.n_docs))
        self.offsets = np.frombuffer(tables, dtype="<u8", count=self.n_blocks)
        self.docs = np.frombuffer(tables, dtype="<i8", count=self.n_docs, offset=8 * self.n_blocks)
        self.starts = np.frombuffer(tables, dtype="<u8", count=self.n_docs, offset=8 * (self.n_blocks + self.n_docs)).astype(np.int64)

    def blocks(self, first: int, last: int) -> np.ndarray:
        """All ids of blocks first to last (included), with one read."""
        self.f.seek(int(self.offsets[first]))
        n = min(self.n_ids, (last + 1) * self.block) - first * self.block
        size = -(-self.block * self.bits // 8)
        data = self.f.read(size * (last - first) + -(-(n - (last - first) * self.block) * self.bits // 8))
        if self.bits == 16:
            return np.frombuffer(data, dtype="<u2").astype(np.uint32)
        parts = [unpack(data[k * size:(k + 1) * size], min(self.block, n - k * self.block), self.bits) for k in range(last - first + 1)]
        return np.concatenate(parts)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` (excluded) of the file."""
        if stop <= start:
            return np.zeros(0, dtype=np.uint32)
        a, b = start // self.block, (stop - 1) // self.block
        return self.blocks(a, b)[start - a * self.block:stop - a * self.block]

    def document(self, k: int) -> np.ndarray:
        stop = int(self.starts[k + 1]) if k + 1 < self.n_docs else self.n_ids
        return self.ids(int(self.starts[k]), stop)


def _open(path: str):
    """(file system, path in it) of a folder's address."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _uri(path: str) -> str:
    return re.sub(r"^file:/+", "file:///", path)


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # their strings in a text are ordinary text
    return t


_CUTS: dict[str, Cuts] = {}  # of this worker process, by tokenizer


def _chunks(raw: np.ndarray, begins: np.ndarray) -> None:
    """Chunks begin at white space; a mark behind a letter, at a chunk's end, is
    a token of its own, so "word," shares the cut of "word"."""
    space = IS_SPACE[raw]
    begins[1:-1] |= space[1:] & ~space[:-1]
    begins[1:-1] |= IS_MARK[raw[1:]] & IS_LETTER[raw[:-1]] & begins[2:]


def encode(path: str, texts: pa.Array | list[str | None]) -> list[np.ndarray]:
    """Ids of whole texts, as the tokenizer gives them without special tokens;
    it encodes each distinct chunk of a step once."""
    t = _tokenizer(path)
    text = texts if isinstance(texts, pa.Array) else pa.array(texts, type=pa.string())
    wide = pc.fill_null(pc.match_substring_regex(text, WIDE_SPACE), False)
    whole = np.flatnonzero(wide.to_numpy(zero_copy_only=False))
    chunks, sizes = cut_texts(pc.if_else(wide, "", text) if len(whole) else text, _chunks)
    out: list[np.ndarray] = [np.zeros(0, dtype=np.uint32)] * len(text)
    if len(chunks):
        d = chunks.dictionary_encode()
        words = as_bytes(d.dictionary)
        memory = _CUTS.setdefault(path, Cuts(200_000, 300_000))
        cuts = memory.get(words)
        need = [i for i, x in enumerate(cuts) if x is None]
        for a in range(0, len(need), BATCH):  # as the words of one text, so that one result holds all
            some = need[a:a + BATCH]
            own = [words[i] for i in some]
            e = t.encode([w.decode() for w in own], is_pretokenized=True, add_special_tokens=False)
            new = sliced(np.array(e.ids), np.bincount(np.array(e.word_ids, dtype=np.int64), minlength=len(own)))
            memory.put(own, new)
            for i, x in zip(some, new):
                cuts[i] = x
        out = pooled(cuts, d.indices.to_numpy(zero_copy_only=False), sizes)
    for i in whole.tolist():
        out[i] = np.array(t.encode(text[i].as_py(), add_special_tokens=False).ids, dtype=np.uint32)
    return out


def _write(folder: str, tokenizer: str, end_id: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        system, base = _open(folder)
        own = f"{base}/_writing-{shard:06d}-{uuid.uuid4().hex}"
        writer = None
        last = np.array([end_id], dtype=np.uint32)
        for batch in by_bytes(batches, step=STEP):
            if writer is None:
                system.create_dir(base, recursive=True)
                out = system.open_output_stream(own)
                writer = Writer(out, bits)
            ids = batch.column("id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
            lists = [np.concatenate([x, last]) for x in encode(tokenizer, batch.column("txt"))]
            writer.add(ids, lists)
        if writer is not None:
            writer.close()
            out.close()
            name = f"shard-{shard:06d}.bin"
            system.move(own, f"{base}/{name}")
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], type=t) for x, t in ((shard, pa.int32()), (name, pa.string()), (writer.n_ids, pa.int64()),
                                                     (sum(map(len, writer.docs)), pa.int64()))],
                ["shard", "name", "n_ids", "n_docs"])
    return run


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None,
                      id_col: str = "doc_id", text_col: str = "text") -> tuple[str, DataFrame]:
    """Files of all documents in ascending id order under ``folder`` (default:
    a new one in the shared folder), and their manifest (shard, name, n_ids,
    n_docs, start). ``end_id`` is appended to each document. Null texts have
    the end id only; null ids come first; an empty table makes no file."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    ship(spark)
    folder = _uri(folder or scratch_path(spark, "token-files"))
    bits = bits_for(max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1))
    rows = id_text(docs, id_col, text_col).repartitionByRange(shuffle_parts(spark), "id").sortWithinPartitions("id")
    made = stage(rows.mapInArrow(_write(folder, tokenizer, end_id, bits), "shard int, name string, n_ids long, n_docs long"),
                 "token-manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return folder, made.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open(folder)
        for batch in batches:
            for name, start in zip(batch.column("name").to_pylist(), batch.column("start").to_pylist()):
                with system.open_input_file(f"{base}/{name}") as f:
                    r = Reader(f)
                    ends = np.r_[r.starts[1:], r.n_ids] if r.n_docs else r.starts
                    k = 0
                    while k < r.n_docs:  # runs of documents of about 16 blocks
                        stop = max(k + 1, int(np.searchsorted(ends, r.starts[k] + 16 * BLOCK, side="right")))
                        flat = r.ids(int(r.starts[k]), int(ends[stop - 1])).astype("<u4")
                        cut = r.starts[k:stop] - r.starts[k]
                        size = ends[k:stop] - r.starts[k:stop]
                        crc = [zlib.crc32(flat[a:a + n]) for a, n in zip(cut.tolist(), size.tolist())]
                        ids = r.docs[k:stop]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids, mask=ids == NO_ID), pa.array(start + r.starts[k:stop]), pa.array(size),
                             pa.array(crc, type=pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
                        k = stop
    return run


def read_token_files(folder: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files:
    start counts the ids of all documents before it, the checksum is over its
    ids as little-endian unsigned 32-bit integers."""
    spread = manifest.repartition(shuffle_parts(manifest.sparkSession))
    return spread.mapInArrow(_read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the files and reads them back: one row for each row of ``docs``."""
    return read_token_files(*write_token_files(docs, tokenizer, end_id, None, id_col, text_col))
