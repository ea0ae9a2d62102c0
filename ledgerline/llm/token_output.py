"""Token ids in binary blocks with Elias-Fano document boundaries."""

from __future__ import annotations

import gc
import re
import sys
import zlib
from codecs import charmap_decode
from collections.abc import Iterator
from itertools import chain
from types import ModuleType

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.session import scratch_dir

from .common import cut, ship, small

END_ID = 2
# A block holds the documents up to about so many bytes of text.
BLOCK_BYTES = 10 << 20
# Bytes of text in a range partition, about.
PARTITION_BYTES = 20 << 20
# Every so many ones of the high bits, their place is kept.
SAMPLE = 128
# Documents whose offsets are selected at once on reading.
READ = 1024
# Texts that go to the library whole: white space beside white space or at the
# start or end, or white space but spaces and line feeds.
_ODD = (r"[ \n][ \n]|^[ \n]|[ \n]\z|[\x00\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
        r"\x{202f}\x{205f}\x{3000}]")
_UNIT = r"^(?: ?(?:\pL+|\pN+|[^\s\pL\pN]+)|\n?)$"
_MARK = "\0"


def _printed() -> str:
    """Byte-level vocabularies write each byte as a printable character: those
    that are printable in Latin-1 as themselves, the others in turn from 256.
    The mark stays."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}
    return _MARK + "".join(other.get(b, chr(b)) for b in range(1, 256))


_PRINTED = _printed()


class EliasFano:
    """A non-decreasing sequence of n numbers up to u in about
    n * (2 + log2(u / n)) bits.

    The low bits of each number are packed; the high bits are written in
    unary: number i sets bit (high + i).  ``places`` holds the place of each
    SAMPLE-th one, so that select reads a few bytes of the bits.
    """

    def __init__(self, n: int, width: int, low: bytes, high: bytes, places: bytes):
        self.n, self.width, self.low, self.high, self.places = n, width, low, high, places

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, (top // n).bit_length() - 1) if n else 0
        v = values.astype(np.uint64)
        bits = ((v[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        at = (v >> np.uint64(width)).astype(np.int64) + np.arange(n)
        ones = np.zeros((top >> width) + n, np.uint8)
        ones[at] = 1
        return cls(n, width, np.packbits(bits.ravel(), bitorder="little").tobytes(),
                   np.packbits(ones, bitorder="little").tobytes(), at[::SAMPLE].astype("<u4").tobytes())

    def _low(self, i: int) -> int:
        at = i * self.width
        part = int.from_bytes(self.low[at // 8:(at + self.width + 7) // 8], "little")
        return (part >> (at % 8)) & ((1 << self.width) - 1)

    def select(self, i: int) -> int:
        """The i-th number."""
        place = int(np.frombuffer(self.places, "<u4", 1, 4 * (i // SAMPLE))[0])
        left, at = i % SAMPLE, place // 8
        byte = self.high[at] & (0xFF << (place % 8)) & 0xFF
        while left >= byte.bit_count():
            left -= byte.bit_count()
            at += 1
            byte = self.high[at]
        for _ in range(left):
            byte &= byte - 1
        one = 8 * at + (byte & -byte).bit_length() - 1
        return ((one - i) << self.width) | self._low(i)

    def all(self) -> np.ndarray:
        one = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[:self.n]
        bits = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")[:self.n * self.width]
        low = bits.reshape(self.n, self.width).astype(np.int64) @ (1 << np.arange(self.width, dtype=np.int64))
        return ((one - np.arange(self.n)) << self.width) + low


def _library(path: str) -> Tokenizer:
    """The tokenizer, kept for all tasks of a Python worker."""
    kept = sys.modules.setdefault("_ledgerline_tokenizers", ModuleType("_ledgerline_tokenizers")).__dict__
    if path not in kept:
        kept[path] = Tokenizer.from_file(path)
    return kept[path]


def _gather(units: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The ids of the units in order; unit k has sizes[k] of ``ids``."""
    # A block holds fewer than 2^31 ids.
    starts = (np.cumsum(sizes) - sizes).astype(np.int32)
    n = sizes[units].astype(np.int32)
    shift = starts[units]
    shift -= np.cumsum(n, dtype=np.int32)
    shift += n
    at = np.repeat(shift, n)
    at += np.arange(len(at), dtype=np.int32)
    return ids[at]


class Encoder:
    """Ids of whole texts, each followed by the end id.

    The vocabulary's splitter always parts a text at single spaces and line
    feeds between other characters and where a letter or digit is followed by
    another sign.  The pieces between such places can be encoded apart, so
    each distinct piece of a few megabytes of text is encoded once.  A piece
    that is one word, number or run of signs, with a space before it or not,
    is a unit of the splitter and goes to the library's model, any other to
    the library.  Texts with other white space, or with the string of a
    token added to the vocabulary, go to the library whole.
    """

    def __init__(self, path: str, end_id: int):
        self.library, self.end_id = _library(path), end_id
        added = [re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()]
        self.odd = "|".join([_ODD, *added])
        self.kind = "<u2" if max(self.library.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"

    def _whole(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _pieces(self, pieces: pa.Array) -> list[list[int]]:
        simple = pc.match_substring_regex(pieces, _UNIT).to_numpy(zero_copy_only=False)
        own = pieces.filter(pa.array(simple)).to_pylist()
        # The model reads bytes as printable characters.
        seen = charmap_decode(_MARK.join(own).encode(), "strict", _PRINTED)[0].split(_MARK) if own else []
        model = self.library.model.tokenize
        short = iter([[t.id for t in model(x)] for x in seen])
        rest = iter([self._whole(x) for x in pieces.filter(pa.array(~simple)).to_pylist()])
        return [next(short) if u else next(rest) for u in simple]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's ids end."""
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        x = pc.if_else(pa.array(odd), pa.scalar(""), texts)
        x = pc.replace_substring_regex(x, r"([\pL\pN])([^\s\pL\pN])", "\\1\0\\2")
        x = pc.replace_substring(pc.replace_substring(x, " ", _MARK + " "), "\n", f"{_MARK}\n{_MARK}")
        split = pc.split_pattern(x, _MARK)
        edge = split.offsets.to_numpy().astype(np.int64)
        code = pc.dictionary_encode(split.flatten())
        del x, split
        units, own = code.indices.to_numpy(zero_copy_only=False), self._pieces(code.dictionary)
        del code
        whole = [self._whole(t.as_py()) for t, o in zip(texts, odd) if o] if odd.any() else []
        all_units = [*own, *whole, [self.end_id]]
        sizes = np.fromiter(map(len, all_units), np.int64, len(all_units))
        ids = np.fromiter(chain.from_iterable(all_units), self.kind, int(sizes.sum()))
        k, end = len(own), len(all_units) - 1
        del own, all_units
        # After each text's pieces comes the end; a text that goes whole has
        # one empty piece, whose place it takes.
        n = len(texts)
        row = np.full(len(units) + n, end, np.int32)
        row[np.arange(len(units)) + np.repeat(np.arange(n), np.diff(edge))] = units
        ends = edge[1:] + np.arange(n)
        row[ends[odd] - 1] = k + np.arange(len(whole))
        del units
        return _gather(row, sizes, ids), np.cumsum(sizes[row])[ends]


BLOCK_SCHEMA = ("part int, seq int, kind string, n_ids long, doc_ids array<long>, ids binary, "
                "low_width int, low binary, high binary, places binary")
_BLOCK = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("kind", pa.string()), ("n_ids", pa.int64()),
                    ("doc_ids", pa.list_(pa.int64())), ("ids", pa.binary()), ("low_width", pa.int32()),
                    ("low", pa.binary()), ("high", pa.binary()), ("places", pa.binary())])


def _blocks(batches: Iterator[pa.RecordBatch], path: str, end_id: int, most: int) -> Iterator[pa.RecordBatch]:
    # The many short lists hold no cycles; collecting them doubles the time.
    gc.disable()
    try:
        yield from _encoded(batches, path, end_id, most)
    finally:
        gc.enable()


def _encoded(batches: Iterator[pa.RecordBatch], path: str, end_id: int, most: int) -> Iterator[pa.RecordBatch]:
    encode = Encoder(path, end_id)
    part, seq = TaskContext.get().partitionId(), 0

    def block(docs: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        ids, ends = encode(pc.fill_null(texts, ""))
        ef = EliasFano.encode(ends)
        row = {"part": part, "seq": seq, "kind": encode.kind, "n_ids": len(ids), "doc_ids": docs, "ids": ids.tobytes(),
               "low_width": ef.width, "low": ef.low, "high": ef.high, "places": ef.places}
        arrays = [pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs) if f.name == "doc_ids"
                  else pa.array([row[f.name]], f.type) for f in _BLOCK]
        return pa.RecordBatch.from_arrays(arrays, schema=_BLOCK)

    left: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        full = (held + np.cumsum(size)) // most
        cuts = [0, *(np.flatnonzero(np.diff(full, prepend=0) > 0) + 1).tolist(), len(batch)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            left.append(batch.slice(a, b - a))
            if b < len(batch) or cuts[-2] == len(batch):
                t = pa.Table.from_batches(left).combine_chunks()
                left = []
                if len(t):
                    yield block(t["doc_id"].chunk(0), t["text"].chunk(0))
                    seq += 1
                del t
                pa.default_memory_pool().release_unused()
        held = 0 if cuts[-2] == len(batch) else (held if len(cuts) == 2 else 0) + int(size[cuts[-2]:].sum())
    t = pa.Table.from_batches(left).combine_chunks() if left else None
    if t:
        yield block(t["doc_id"].chunk(0), t["text"].chunk(0))


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID,
                 block_bytes: int = BLOCK_BYTES, partitions: int | None = None) -> str:
    """Write the ids of all texts, each followed by ``end_id``, in ascending
    doc_id order as a table of blocks below ``path``.

    A block is a row: the ids of whole documents as one byte array, two bytes
    an id where the vocabulary allows, their doc_ids, and the Elias-Fano code
    of where each document ends.  Blocks are ordered by (part, seq).  Spark
    commits the files, so a lost task leaves nothing behind.

    Null texts are empty and only have the end id.  Null ids come first;
    rows with equal ids keep their input order.  A range partition is cut by
    id and row, so a much repeated id is spread too.  An empty table writes
    no blocks.
    """
    tokenizer = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    rows = docs.select("doc_id", "text").withColumn("_at", F.monotonically_increasing_id())
    if partitions is None:
        size = docs.select(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
        partitions = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // PARTITION_BYTES))
    ordered = rows.repartitionByRange(partitions, "doc_id", "_at").sortWithinPartitions("doc_id", "_at")
    ordered.select("doc_id", "text").mapInArrow(
        lambda b: _blocks(b, tokenizer, end_id, block_bytes), BLOCK_SCHEMA).write.parquet(path)
    return path


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            n = len(r["doc_ids"])
            ends = EliasFano(n, r["low_width"], r["low"], r["high"], r["places"])
            ids = np.frombuffer(r["ids"], r["kind"])
            for first in range(0, n, READ):  # a few documents' offsets at a time, by select
                at = [ends.select(i) if i >= 0 else 0 for i in range(first - 1, min(n, first + READ))]
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([r["part"]] * len(crc), pa.int32()), "seq": pa.array([r["seq"]] * len(crc), pa.int32()),
                    "doc_id": pa.array(r["doc_ids"][first:first + READ], pa.int64()), "at": pa.array(at[:-1], pa.int64()),
                    "n_tokens": pa.array([b - a for a, b in zip(at, at[1:])], pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the blocks
    below ``path``; start is the number of ids before it in the whole array.

    The blocks' own offsets are two running sums: over the parts, one row
    each, and over the blocks of a part.
    """
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    n = cut(blocks.select("part", "seq", "n_ids"))
    parts = n.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("part_from"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    offsets = n.withColumn("own", F.coalesce(F.sum("n_ids").over(within), F.lit(0))).join(parts, "part").select(
        "part", "seq", (F.col("part_from") + F.col("own")).alias("block_from"))
    docs = blocks.mapInArrow(_documents, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return docs.join(small(cut(offsets)), ["part", "seq"]).select(
        "doc_id", (F.col("block_from") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def tokenize(docs: DataFrame, **how) -> DataFrame:
    """Write ``docs`` below the shared folder and read the result back."""
    spark = docs.sparkSession
    return read_tokens(spark, write_tokens(docs, scratch_dir(spark, "tokens"), **how))


ship(__name__)
