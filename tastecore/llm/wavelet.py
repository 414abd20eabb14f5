"""Token ids as wavelet matrices, one per shard of consecutive documents.

A wavelet matrix holds a sequence as bit-planes: plane by plane, from the highest bit down, the
values are parted into those with a 0 and those with a 1, in their order. With counts of ones per 64
bits, a token is read (`access`), counted (`rank`) and found (`select`) by one step per plane, without
unpacking the rest. Tokens are first replaced by their rank among the shard's distinct tokens, so there
are as few planes as the shard needs.

Documents are range partitioned by doc_id; each partition is one Parquet file (zstd) whose rows are its
shards, in order: the documents' ids and lengths, and the matrix. Shards end with a document, at
`SHARD_TOKENS` tokens or more, so a longer document is a shard of its own.

Edge cases: a null or empty text holds only the end id; rows without an id come first; repeated ids keep
all their rows, ordered by text; an empty table gives files without shards. Only doc_id and text are read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tastecore.llm.batches import map_arrow, slices, text_of
from tastecore.llm.token_ids import encoder

SHARD_TOKENS = 1_000_000
HEADER = struct.Struct("<8sqii")  # mark, tokens, distinct tokens, planes
MARK = b"WAVELET1"
NO_ID = np.iinfo(np.int64).min


class WaveletMatrix:
    def __init__(self, size: int, symbols: np.ndarray, planes: list[np.ndarray]) -> None:
        """`planes`: 64-bit words, lowest bit first, highest plane first."""
        self.size, self.symbols, self.planes = size, symbols, planes
        self.ones = [np.concatenate(([0], np.cumsum(np.bitwise_count(p), dtype=np.int64))) for p in planes]
        self.zeros = [size - int(o[-1]) for o in self.ones]

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        symbols = np.flatnonzero(np.bincount(ids)).astype(np.uint32) if len(ids) and ids.max() < 1 << 20 else np.unique(ids).astype(np.uint32)
        if len(symbols) and symbols[-1] < 1 << 20:
            codes_of = np.zeros(int(symbols[-1]) + 1, np.uint32)
            codes_of[symbols] = np.arange(len(symbols))
            values = codes_of[ids]
        else:
            values = np.searchsorted(symbols, ids).astype(np.uint32)
        depth = max(len(symbols) - 1, 0).bit_length()
        values = values.astype(np.uint16 if depth <= 16 else np.uint32)
        planes = []
        for level in reversed(range(depth)):
            bits = (values & values.dtype.type(1 << level)) != 0
            packed = np.packbits(bits, bitorder="little")
            planes.append(np.concatenate((packed, np.zeros(-len(packed) % 8, np.uint8))).view(np.uint64))
            values = np.concatenate((values[~bits], values[bits]))
        return cls(len(ids), symbols, planes)

    def to_bytes(self) -> bytes:
        head = HEADER.pack(MARK, self.size, len(self.symbols), len(self.planes))
        return b"".join([head, self.symbols.astype("<u4").tobytes(), *[p.astype("<u8").tobytes() for p in self.planes]])

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        mark, size, distinct, depth = HEADER.unpack_from(data)
        if mark != MARK:
            raise ValueError("not a wavelet matrix")
        at, words = HEADER.size, -(-size // 64)
        symbols = np.frombuffer(data, "<u4", distinct, at)
        at += 4 * distinct
        return cls(size, symbols, [np.frombuffer(data, "<u8", words, at + 8 * words * i) for i in range(depth)])

    def _rank1(self, level: int, at: int) -> int:
        word, bit = divmod(at, 64)
        count = int(self.ones[level][word])
        return count + (int(self.planes[level][word]) & (1 << bit) - 1).bit_count() if bit else count

    def _bit(self, level: int, at: int) -> int:
        return int(self.planes[level][at // 64]) >> at % 64 & 1

    def access(self, at: int) -> int:
        """The token at a place."""
        if not 0 <= at < self.size:
            raise IndexError(at)
        code = 0
        for level in range(len(self.planes)):
            bit, ones = self._bit(level, at), self._rank1(level, at)
            code = code << 1 | bit
            at = self.zeros[level] + ones if bit else at - ones
        return int(self.symbols[code])

    def _code(self, token: int) -> int | None:
        code = int(np.searchsorted(self.symbols, token))
        return code if code < len(self.symbols) and self.symbols[code] == token else None

    def _range(self, code: int, start: int, end: int) -> tuple[int, int]:
        for level in range(len(self.planes)):
            a, b = self._rank1(level, start), self._rank1(level, end)
            one = code >> len(self.planes) - 1 - level & 1
            start, end = (self.zeros[level] + a, self.zeros[level] + b) if one else (start - a, end - b)
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of a token among places start .. end - 1."""
        code = self._code(token)
        if code is None:
            return 0
        low, high = self._range(code, start, self.size if end is None else end)
        return high - low

    def _select_bit(self, level: int, bit: int, number: int) -> int:
        """Place of the number-th 0 or 1 (from 0) of a plane."""
        ones = self.ones[level]
        before = ones if bit else 64 * np.arange(len(ones)) - ones
        word = int(np.searchsorted(before, number, side="right")) - 1
        left = number - int(before[word])
        value = int(self.planes[level][word])
        value = value if bit else ~value
        place = -1
        for _ in range(left + 1):
            place += 1
            while not value >> place & 1:
                place += 1
        return 64 * word + place

    def select(self, token: int, number: int) -> int | None:
        """Place of the number-th occurrence (from 0) of a token."""
        code = self._code(token)
        if code is None:
            return None
        start, end = self._range(code, 0, self.size)
        if not 0 <= number < end - start:
            return None
        at = start + number
        for level in reversed(range(len(self.planes))):
            one = code >> len(self.planes) - 1 - level & 1
            at = self._select_bit(level, one, at - self.zeros[level] if one else at)
        return at

    def decode(self) -> np.ndarray:
        """All tokens, plane by plane from the lowest."""
        values = np.zeros(self.size, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for number, level in enumerate(reversed(range(len(self.planes)))):
            bits = np.unpackbits(self.planes[level].view(np.uint8), count=self.size, bitorder="little").view(bool)
            above = np.empty_like(values)
            above[~bits] = values[: self.zeros[level]]
            above[bits] = values[self.zeros[level] :] | values.dtype.type(1 << number)
            values = above
        return self.symbols[values] if len(self.symbols) else values.astype(np.uint32)


SHARD_SCHEMA = "part int, shard int, start long, n_tokens long, doc_ids binary, lengths binary, matrix binary"


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode all documents in ascending doc_id order and write them under `path`, one file per partition."""
    names = [c.split()[0] for c in SHARD_SCHEMA.split(", ")]
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, start = TaskContext.get().partitionId(), 0, 0
        encode = encoder(tokenizer).encode
        doc_ids: list[int] = []
        held: list[np.ndarray] = []
        size = 0

        def full() -> pa.RecordBatch:
            lengths = np.array([len(i) for i in held], "<u4").tobytes()
            row = (part, shard, start, size, np.array(doc_ids, "<i8").tobytes(), lengths, WaveletMatrix.of(np.concatenate(held)).to_bytes())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

        for rows in slices(batches):
            for doc_id, ids in zip(rows.column(0).to_pylist(), encode(rows.column(1).to_pylist())):
                doc_ids.append(NO_ID if doc_id is None else doc_id)
                held.append(np.append(ids, np.uint32(end_id)))
                size += len(held[-1])
                if size >= shard_tokens:
                    yield full()
                    shard, start = shard + 1, start + size
                    doc_ids, held, size = [], [], 0
        if held:
            yield full()

    order = ["doc_id", F.xxhash64("text"), "text"]
    ordered = text_of(docs).repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    map_arrow(ordered, run, SHARD_SCHEMA).write.option("compression", "zstd").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Shards with `start` as the number of ids of all documents before them."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    # One row per partition written: the window is as small as that.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    shifts = sizes.select(F.col("part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    # Broadcast bound: one row per partition written.
    return shards.join(F.broadcast(shifts), "part").withColumn("start", F.col("start") + F.col("shift")).drop("shift")


def documents(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the shards."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in slices(batches, 1):
            start, doc_ids, lengths, matrix = (row.column(i)[0].as_py() for i in range(4))
            doc_ids, lengths = np.frombuffer(doc_ids, "<i8"), np.frombuffer(lengths, "<u4").astype(np.int64)
            data = memoryview(WaveletMatrix.from_bytes(matrix).decode().astype("<u4").tobytes())
            ends = np.cumsum(lengths)
            crc = [zlib.crc32(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
            columns = (pa.array(doc_ids, mask=doc_ids == NO_ID), pa.array(start + ends - lengths), pa.array(lengths), pa.array(crc, pa.int64()))
            yield pa.RecordBatch.from_arrays(list(columns), names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return map_arrow(shards.select("start", "doc_ids", "lengths", "matrix"), run, schema)


def token_counts(shards: DataFrame, tokens: list[int]) -> DataFrame:
    """token, n: occurrences of the given tokens, by rank alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in slices(batches, 1):
            matrix = WaveletMatrix.from_bytes(row.column(0)[0].as_py())
            yield pa.RecordBatch.from_pydict({"token": pa.array(tokens, pa.int64()), "n": pa.array(map(matrix.count, tokens), pa.int64())})

    found = map_arrow(shards.select("matrix"), run, "token long, n long")
    return found.groupBy("token").agg(F.sum("n").alias("n"))


def occurrences(shards: DataFrame, token: int) -> DataFrame:
    """place: where a token stands among all ids, by select."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in slices(batches, 1):
            start, matrix = row.column(0)[0].as_py(), WaveletMatrix.from_bytes(row.column(1)[0].as_py())
            places = [start + matrix.select(token, i) for i in range(matrix.count(token))]
            yield pa.RecordBatch.from_pydict({"place": pa.array(places, pa.int64())})

    return map_arrow(shards.select("start", "matrix"), run, "place long")
