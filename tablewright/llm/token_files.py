"""Token ids in binary files: fixed-width bit packing with random access.

Format, little-endian throughout. A file is one value of the layout

    header           8 x uint64: magic, bits, ids, documents, blocks, part, number, ids before
    block offsets    (blocks + 1) x uint64, bytes from the first block
    documents        int64 ids, then uint64 starts (documents + 1), then uint8 null marks
    blocks           BLOCK_IDS ids each, ``bits`` bits per id, filled up to whole 64-bit words
    line feed        ends the file

``bits`` is the least width that holds the largest id of the vocabulary. Part and number order
the files; "ids before" counts the ids of the part that lie in earlier files of it. A block
needs only its offset to be unpacked, by 64 numpy shifts for any number of blocks.

Files are written by Spark's own committed writer (one row per file, its bytes as they are) to
any store Spark can write to, and read back with the binary file source, so lost executors leave
no half-written or doubled file.

Results for edge cases: null text is a document of only the end id; null document ids come first
and are marked; repeated ids are ordered by text; an empty table gives no files and no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import text_arrays as ta
from tablewright.llm import tokens
from tablewright.staging import fresh_path, stage

MAGIC = int.from_bytes(b"TWTOKEN1", "little")
BLOCK_IDS = 4096  # a multiple of 64
# A file is closed when it holds this many ids; a document is never split over files.
FILE_IDS = 2_000_000
_HEADER = 8


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> np.ndarray:
    """``ids``, filled up with zeros to a multiple of 64, as 64-bit words."""
    lanes = np.zeros((-(-len(ids) // 64), 64), np.uint64)
    lanes.reshape(-1)[: len(ids)] = ids
    words = np.zeros((len(lanes), bits), np.uint64)
    for lane in range(64):
        word, shift = divmod(lane * bits, 64)
        words[:, word] |= lanes[:, lane] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= lanes[:, lane] >> np.uint64(64 - shift)
    return words.reshape(-1)


def unpack_bits(words: np.ndarray, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of ``words``."""
    words = words.reshape(-1, bits)
    lanes = np.empty((len(words), 64), np.uint64)
    mask = np.uint64((1 << bits) - 1)
    for lane in range(64):
        word, shift = divmod(lane * bits, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | (words[:, word + 1] << np.uint64(64 - shift))
        lanes[:, lane] = value & mask
    return lanes.reshape(-1)[:count].astype(np.uint32)


def to_file(documents: list[int | None], ids: np.ndarray, starts: np.ndarray, bits: int, part: int, number: int, before: int) -> bytes:
    """The bytes of one file."""
    words = pack_bits(ids, bits)
    blocks = -(-len(ids) // BLOCK_IDS)
    block_bytes = BLOCK_IDS // 64 * bits * 8
    offsets = np.minimum(np.arange(blocks + 1) * block_bytes, words.nbytes).astype("<u8")
    header = np.array([MAGIC, bits, len(ids), len(documents), blocks, part, number, before], "<u8")
    names = np.array([0 if d is None else d for d in documents], "<i8")
    nulls = np.array([d is None for d in documents], np.uint8)
    parts = (header, offsets, names, starts.astype("<u8"), nulls, words.astype("<u8"))
    return b"".join(part.tobytes() for part in parts) + b"\n"


class TokenFile:
    """A view of the bytes of one file."""

    def __init__(self, content: bytes):
        header = np.frombuffer(content, "<u8", _HEADER)
        if header[0] != MAGIC:
            raise ValueError("not a token file")
        _, self.bits, self.ids, count, blocks, self.part, self.number, self.before = map(int, header)
        at = 8 * _HEADER
        self.offsets = np.frombuffer(content, "<u8", blocks + 1, at)
        at += 8 * (blocks + 1)
        self.documents = np.frombuffer(content, "<i8", count, at)
        at += 8 * count
        self.starts = np.frombuffer(content, "<u8", count + 1, at).astype(np.int64)
        at += 8 * (count + 1)
        self.nulls = np.frombuffer(content, np.uint8, count, at).astype(bool)
        self.blocks_at = at + count
        self.content = content

    def read(self, start: int, end: int) -> np.ndarray:
        """Ids ``start .. end - 1``, unpacking only the blocks that hold them."""
        if end <= start:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK_IDS, -(-end // BLOCK_IDS)
        low, high = int(self.offsets[first]), int(self.offsets[last])
        words = np.frombuffer(self.content, "<u8", (high - low) // 8, self.blocks_at + low)
        base = first * BLOCK_IDS
        return unpack_bits(words, self.bits, end - base)[start - base :]

    def document(self, i: int) -> np.ndarray:
        return self.read(self.starts[i], self.starts[i + 1])


def write_token_files(
    documents: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int,
    text: str = "text",
    key: str = "doc_id",
    file_ids: int = FILE_IDS,
) -> None:
    """Encode whole texts, each followed by ``end_id``, into files in ascending order of ``key``.

    Documents are range-partitioned by key into as many parts as the session has shuffle
    partitions and sorted within each.
    """
    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = tokens.encoder(tokenizer_path), TaskContext.get().partitionId()
        bits = bits_for(max(encoder.vocabulary, end_id + 1))
        number = before = size = 0
        names: list[int | None] = []
        held: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            starts = np.concatenate([[0], np.cumsum([len(ids) for ids in held])])
            content = to_file(names, np.concatenate(held), starts, bits, part, number, before)
            return pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], names=["content"])

        for batch in batches:
            for some, _ in ta.record_slices(batch, limit=tokens.SLICE_CHARS):
                found = encoder.encode(some.column("text"))
                for i, name in enumerate(some.column("key").to_pylist()):
                    ids = np.append(found.ids[found.bounds[i] : found.bounds[i + 1]], np.uint32(end_id))
                    if held and size + len(ids) > file_ids:
                        yield close()
                        number, before, size, names, held = number + 1, before + size, 0, [], []
                    names.append(name)
                    held.append(ids)
                    size += len(ids)
        if held:
            yield close()

    named = documents.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    ordered = named.repartitionByRange(parts, "key").sortWithinPartitions("key", "text")
    files = ordered.mapInArrow(build, "content binary")
    # The cast keeps the bytes as they are, and the text writer writes them so.
    raw = files.select(F.col("content").cast("string").alias("value"))
    raw.write.option("maxRecordsPerFile", 1).option("compression", "none").text(path)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row per document: its id, part, start within the part, ids and their checksum."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                if not len(content.as_py()):
                    continue  # the writer leaves an empty file for a table without rows
                file = TokenFile(content.as_py())
                ids = file.read(0, file.ids)
                raw = [ids[a:b].astype("<u4").tobytes() for a, b in zip(file.starts, file.starts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(file.documents, pa.int64(), mask=file.nulls),
                        pa.array(np.full(len(raw), file.part, np.int32)),
                        pa.array(file.starts[:-1] + file.before),
                        pa.array(np.diff(file.starts)),
                        pa.array([zlib.crc32(one) for one in raw], pa.int64()),
                        pa.array(raw if with_ids else [None] * len(raw), pa.binary()),
                    ],
                    names=["doc_id", "part", "start", "n_tokens", "ids_crc32", "ids"],
                )

    content = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return content.mapInArrow(
        unpack, "doc_id long, part int, start long, n_tokens long, ids_crc32 long, ids binary"
    )


def with_global_starts(read: DataFrame) -> DataFrame:
    """Staged rows of ``read_token_files`` with ``start`` counted over all parts.

    The ids of each part are added up on the driver: one number per part, and the writer makes
    as many parts as the session has shuffle partitions.
    """
    ends = read.groupBy("part").agg(F.max(F.col("start") + F.col("n_tokens")).alias("ids"))
    base, rows = 0, []
    for row in ends.orderBy("part").collect():
        rows.append((row["part"], base))
        base += row["ids"]
    bases = read.sparkSession.createDataFrame(rows, "part int, base long")
    joined = read.join(F.broadcast(bases), "part")
    return joined.withColumn("start", F.col("start") + F.col("base")).drop("base")


def round_trip(documents: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write ``documents`` to fresh files in the shared folder and describe what they hold."""
    spark = documents.sparkSession
    path = fresh_path(spark, "token-files")
    write_token_files(documents, path, tokenizer_path, end_id)
    return with_global_starts(stage(read_token_files(spark, path, with_ids=False), "token-index"))
