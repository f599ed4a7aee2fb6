"""Token shards with Elias-Fano coded document boundaries.

A shard is one file image: a header, the Elias-Fano lists of document ids and
of id offsets, and the concatenated token ids. Documents are written in
ascending doc_id order: a range sort deals the texts before any is tokenized,
and each task cuts its range into shards of bounded size. Shards are stored as
binary rows, so any store that Spark writes to will do.
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

from ..session import scratch_path
from .arrow import record_batch, text_blocks
from .tokenizer import ENCODE_BYTES, WORD_FILE, tokenizer_path, word_encoder

MAGIC = b"EFTOK1\0\0"
SHARD_IDS = 1 << 20
SAMPLE = 256  # every so many-th set bit has its position stored
SHARDS = "part int, seq int, n_docs long, n_ids long, shard binary"
INDEX = "doc_id long, start long, n_tokens long, ids_crc32 long"


class EliasFano:
    """A non-decreasing list of integers from 0 up in about 2 + log2(largest / length) bits each."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray) -> None:
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        if n == 0:
            return cls(0, 0, np.empty(0, np.uint8), np.empty(0, np.uint8), np.empty(0, np.uint64))
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        at = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(at[-1]) + 1, np.uint8)
        bits[at] = 1
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"), at[::SAMPLE].astype(np.uint64))

    def _low(self, i: int, j: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(j - i, np.uint64)
        first, last = i * self.low_bits, j * self.low_bits
        bits = np.unpackbits(self.low[first // 8:-(-last // 8)], bitorder="little")[first % 8:first % 8 + last - first]
        return (bits.reshape(-1, self.low_bits).astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def select(self, i: int) -> int:
        """Value number ``i``, found from the nearest stored position."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        byte = at // 8
        bits = np.unpackbits(self.high[byte:byte + 1], bitorder="little")
        bits[:at % 8] = 0
        while left >= int(bits.sum()):
            left -= int(bits.sum())
            byte += 1
            bits = np.unpackbits(self.high[byte:byte + 1], bitorder="little")
        place = byte * 8 + int(np.flatnonzero(bits)[left])
        return ((place - i) << self.low_bits) | int(self._low(i, i + 1)[0])

    def all(self) -> np.ndarray:
        """Every value, as unsigned 64-bit integers."""
        if not self.n:
            return np.empty(0, np.uint64)
        at = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        return ((at - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(0, self.n)

    def to_bytes(self) -> bytes:
        head = struct.pack("<QIQQQ", self.n, self.low_bits, len(self.low), len(self.high), len(self.samples))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, data: memoryview, at: int = 0) -> tuple[EliasFano, int]:
        n, low_bits, n_low, n_high, n_samples = struct.unpack_from("<QIQQQ", data, at)
        at += struct.calcsize("<QIQQQ")
        low = np.frombuffer(data, np.uint8, n_low, at)
        high = np.frombuffer(data, np.uint8, n_high, at + n_low)
        samples = np.frombuffer(data, "<u8", n_samples, at + n_low + n_high)
        return cls(n, low_bits, low, high, samples), at + n_low + n_high + 8 * n_samples


class TokenShard:
    """A shard's file image, read without unpacking more than is asked for."""

    def __init__(self, data: bytes) -> None:
        view = memoryview(data)
        if bytes(view[:8]) != MAGIC:
            raise ValueError("not a token shard")
        self.n_docs, self.n_null, self.first_doc, width, self.n_ids = struct.unpack_from("<QQqIQ", view, 8)
        at = 8 + struct.calcsize("<QQqIQ")
        self.doc_keys, at = EliasFano.from_bytes(view, at)
        self.ends, at = EliasFano.from_bytes(view, at)
        self.ids = np.frombuffer(view, f"<u{width}", self.n_ids, at)

    @staticmethod
    def pack(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
        """``doc_ids`` ascending, nulls first; ``lengths`` counts each document's ids."""
        known = [d for d in doc_ids if d is not None]
        first = known[0] if known else 0
        keys = np.array([d - first for d in known], np.uint64)
        width = 2 if len(ids) == 0 or int(ids.max()) < 1 << 16 else 4
        head = struct.pack("<QQqIQ", len(doc_ids), len(doc_ids) - len(known), first, width, len(ids))
        ends = np.cumsum(np.asarray(lengths, np.uint64))
        return MAGIC + head + EliasFano.build(keys).to_bytes() + EliasFano.build(ends).to_bytes() + ids.astype(f"<u{width}").tobytes()

    def doc_ids(self) -> list[int | None]:
        return [None] * self.n_null + [self.first_doc + int(k) for k in self.doc_keys.all()]

    def doc(self, i: int) -> np.ndarray:
        """Ids of the shard's i-th document, by two selects."""
        start = self.ends.select(i - 1) if i else 0
        return self.ids[start:self.ends.select(i)]


def encode_shards(docs: DataFrame, path: str | None = None, end_id: int = 1, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Shards of the documents in ascending doc_id order, nulls first; a null text has its end id alone.

    Equal doc_ids stand next to each other, ordered by a hash of the text.
    """
    path = path or tokenizer_path(WORD_FILE)
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("shard", pa.binary())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        part, seq = TaskContext.get().partitionId(), 0
        doc_ids, lengths, held, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate(held)
            return record_batch(schema, part=[part], seq=[seq], n_docs=[len(doc_ids)], n_ids=[len(ids)], shard=[TokenShard.pack(doc_ids, np.concatenate(lengths), ids)])

        for batch, texts in text_blocks(batches, "text", ENCODE_BYTES):
            ids, counts = encoder.encode(texts)
            doc_ids += batch.column("doc_id").to_pylist()
            lengths.append(counts + 1)
            held.append(np.insert(ids, np.cumsum(counts), end_id))
            size += len(held[-1])
            if size >= shard_ids:
                yield flush()
                doc_ids, lengths, held, size = [], [], [], 0
                seq += 1
        if doc_ids:
            yield flush()

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("nr"))
    order = ["doc_id", "tie", "nr"]  # the row number lets a range end between equal rows
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(write, SHARDS)


def write_shards(docs: DataFrame, folder: str, **options) -> None:
    """Write the shards of ``docs`` as binary rows under ``folder``."""
    encode_shards(docs, **options).write.parquet(folder)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """The shards under ``folder``, each with the number of ids before it (``base``).

    Running totals go over the parts first and then within each part.
    """
    shards = spark.read.schema(SHARDS).parquet(folder)
    sizes = shards.select("part", "seq", "n_ids")
    before = lambda *by: F.coalesce(F.sum("n_ids").over(Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n_ids")).select("part", before("part").alias("part_base"))
    index = sizes.withColumn("in_part", before("part", "seq")).join(parts, "part").select("part", "seq", (F.col("part_base") + F.col("in_part")).alias("base"))
    return shards.join(index, ["part", "seq"])


def shard_documents(shards: DataFrame) -> DataFrame:
    """Per document, from the shards alone: its first id's place among all ids, its ids, and their checksum."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, data in zip(batch.column("base").to_pylist(), batch.column("shard")):
                shard = TokenShard(data.as_py())
                ends = shard.ends.all().astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                ids = memoryview(shard.ids.astype("<u4").tobytes())
                sums = [zlib.crc32(ids[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield record_batch(schema, doc_id=shard.doc_ids(), start=starts + base, n_tokens=ends - starts, ids_crc32=sums)

    return shards.select("base", "shard").mapInArrow(read, INDEX)


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """Write the shards to the shared folder and read every document back from them."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-shards")
    write_shards(docs, folder, **options)
    return shard_documents(read_shards(spark, folder))
