"""Best-fit packing of token pieces into sequences under several capacities.

A sequence has room for tokens, for documents and for attention cost (the sum of squared piece
lengths). Pieces are placed longest first; of the open sequences with room in every dimension
the one with the smallest residual norm, or the largest weighted dot product of piece and
residual, takes the piece. Pieces are dealt at random (by a hash of their place in the input) to
groups of about ``GROUP_PIECES``, which are packed side by side: each group leaves at most a few
sequences open, so the loss does not grow with the table.

Results for edge cases: null text counts as empty and is one piece holding the end id; texts
longer than a sequence are cut into full pieces and a rest; pieces of equal length are placed in
the order of document, piece and input; repeated rows are packed like other rows; an empty table
gives an empty one. Only the key and text columns are used, so other columns never clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import text_arrays as ta
from tablewright.llm import tokens
from tablewright.staging import stage

CAPACITY = 4096
MAX_DOCUMENTS = 1024
# A sequence of one piece of full length costs this much, the most there can be.
MAX_ATTENTION = CAPACITY * CAPACITY
# Weights of tokens, documents and attention in the choice among sequences.
WEIGHTS = (1.0, 0.05, 0.05)
# Expected pieces in a group.
GROUP_PIECES = 16_384

_PIECES = "doc_id long, part int, row long, piece int, start long, length long, ids_crc32 long, ids binary"


def pieces(
    documents: DataFrame,
    tokenizer_path: str,
    end_id: int,
    text: str = "text",
    key: str = "doc_id",
    capacity: int = CAPACITY,
    with_ids: bool = True,
    memo_pieces: int | None = None,
) -> DataFrame:
    """One row per piece: its document, place, length, checksum and ids (little-endian 32 bit)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokenizer_path, memo_pieces=memo_pieces)
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            for some, _ in ta.record_slices(batch, limit=tokens.SLICE_CHARS):
                found = encoder.encode(some.column("text"))
                ends = np.array([end_id], np.uint32)
                rows: list[tuple] = []
                for i, document in enumerate(some.column("key").to_pylist()):
                    ids = np.concatenate([found.ids[found.bounds[i] : found.bounds[i + 1]], ends])
                    for number, start in enumerate(range(0, len(ids), capacity)):
                        raw = ids[start : start + capacity].astype("<u4").tobytes()
                        kept = raw if with_ids else None
                        rows.append((document, part, row, number, start, len(raw) // 4, zlib.crc32(raw), kept))
                    row += 1
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)],
                    names=["doc_id", "part", "row", "piece", "start", "length", "ids_crc32", "ids"],
                )

    named = documents.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return named.mapInArrow(cut, _PIECES)


def place(
    lengths: np.ndarray,
    capacity: int = CAPACITY,
    max_documents: int = MAX_DOCUMENTS,
    max_attention: int = MAX_ATTENTION,
    weights: tuple[float, float, float] = WEIGHTS,
    rule: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece; lengths must fit an empty sequence."""
    limits = np.array([capacity, max_documents, max_attention], float)
    scale = np.sqrt(np.array(weights)) / limits
    order = np.argsort(-lengths, kind="stable")
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    least = lengths.min(initial=capacity)
    room = np.empty((3, len(lengths) + 1))
    names = np.empty(len(lengths) + 1, np.int64)
    count = opened = 0
    for number, i in enumerate(order):
        length = float(lengths[i])
        need = np.array([length, 1.0, length * length])
        if need[0] > limits[0] or need[2] > limits[2]:
            raise ValueError(f"a piece of {lengths[i]} tokens fits no sequence")
        if number % 256 == 0 and count:
            live = (room[0, :count] >= least) & (room[1, :count] >= 1)
            live &= room[2, :count] >= float(least) ** 2
            kept = int(live.sum())
            room[:, :kept], names[:kept], count = room[:, :count][:, live], names[:count][live], kept
        rest = room[:, :count] - need[:, None]
        fits = np.flatnonzero(rest.min(0) >= 0) if count else rest[0]
        if not len(fits):
            best, room[:, count], names[count] = count, limits, opened
            count, opened = count + 1, opened + 1
        elif rule == "norm":
            norms = ((rest[:, fits] * scale[:, None]) ** 2).sum(0)
            best = fits[norms.argmin()]
        else:
            dots = (room[:, fits] * (need * scale**2)[:, None]).sum(0)
            best = fits[dots.argmax()]
        sequence[i], offset[i] = names[best], capacity - int(room[0, best])
        room[:, best] -= need
    return sequence, offset


def pack(
    cut: DataFrame,
    capacity: int = CAPACITY,
    max_documents: int = MAX_DOCUMENTS,
    max_attention: int = MAX_ATTENTION,
    weights: tuple[float, float, float] = WEIGHTS,
    rule: str = "norm",
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """Staged ``pieces`` with their ``sequence_id`` and ``offset`` in it."""
    groups = -(-cut.count() // group_pieces) or 1
    group = F.pmod(F.xxhash64("part", "row", "piece"), F.lit(groups))
    columns = [c for c in cut.columns if c != "ids"]

    def fill(key: tuple, some: pd.DataFrame) -> pd.DataFrame:
        some = some.sort_values(["doc_id", "piece", "part", "row"], kind="stable")
        sequence, offset = place(
            some["length"].to_numpy(), capacity, max_documents, max_attention, weights, rule
        )
        placed = some.assign(sequence_id=(int(key[0]) << 32) + sequence, offset=offset)
        return placed[[*columns, "sequence_id", "offset"]]

    kinds = ", ".join(f"{c} {dict(cut.dtypes)[c]}" for c in columns)
    grouped = cut.select(*columns, group.alias("group")).groupBy("group")
    return grouped.applyInPandas(fill, f"{kinds}, sequence_id long, offset long")


def pack_documents(
    documents: DataFrame, tokenizer_path: str, end_id: int, memo_pieces: int | None = None, **limits
) -> DataFrame:
    """Place of every piece of every document; ids are left out.

    ``memo_pieces`` bounds the pieces of text a worker keeps the ids of.
    """
    capacity = limits.get("capacity", CAPACITY)
    cut = pieces(documents, tokenizer_path, end_id, capacity=capacity, with_ids=False, memo_pieces=memo_pieces)
    return pack(stage(cut, "pieces"), **limits)


def sequences(cut: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences: ids end to end, and the document and length of each piece."""
    joined = placed.join(cut.select("part", "row", "piece", "ids"), ["part", "row", "piece"])
    held = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    return joined.groupBy("sequence_id").agg(held.alias("held")).select(
        "sequence_id",
        F.aggregate("held", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
        F.transform("held", lambda x: F.struct(x["doc_id"], x["piece"], x["length"])).alias("pieces"),
    )
