"""Token counts of the parts of a text, from one encoding of the whole text.

The text is encoded once, with the character span of each token, and the spans are joined with
the intervals of fields or sections (both sorted, so by binary search, inside the row). A token
that crosses a boundary is allocated by a named rule:

    start      the section that holds its first character
    majority   the section that holds most of its characters, the earlier one at a tie
    fraction   each section in proportion to the characters it holds

A token whose span is one character (bytes of one character) never crosses. Sections are in
ascending order and do not overlap; the characters between and around them form section -1,
which is reported where it has tokens. The counts of a text add up to its tokens.

Results for edge cases: null or empty text has one empty line, with 0 tokens; a null array of
intervals is an empty one; empty sections get 0; equal rows give equal results; an empty table
gives an empty one. Columns that have the name of a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm import text_arrays as ta
from tablewright.llm import tokens

RULES = ("start", "majority", "fraction")
OUTSIDE = -1

_COUNT = pa.struct(
    [
        ("section", pa.int32()),
        ("start", pa.int32()),
        ("end", pa.int32()),
        ("n_tokens", pa.float64()),
        ("n_crossing", pa.int64()),
    ]
)
_COUNTS_DDL = "array<struct<section: int, start: int, end: int, n_tokens: double, n_crossing: bigint>>"


def fields(*columns: Column, separator: str = "\n") -> tuple[Column, Column]:
    """``(text, intervals)`` of fields joined by ``separator``, for one encoding of all of them.

    Null fields are empty. A separator belongs to the field before it.
    """
    filled = [F.coalesce(column.cast("string"), F.lit("")) for column in columns]
    at, intervals = F.lit(0), []
    for number, column in enumerate(filled):
        end = at + F.length(column) + (len(separator) if number < len(filled) - 1 else 0)
        intervals.append(F.struct(at.cast("int").alias("start"), end.cast("int").alias("end")))
        at = end
    return F.concat_ws(separator, *filled), F.array(*intervals)


def line_bounds(text: str) -> np.ndarray:
    """[line, (start, end)]: each line with the line feed that ends it."""
    breaks = np.flatnonzero(ta.flatten([text]).codes == 10) + 1
    edges = np.concatenate([[0], breaks, [len(text)]])
    return np.stack([edges[:-1], edges[1:]], 1)


def allocate(spans: np.ndarray, sections: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """``(tokens, crossing tokens)`` of each section, and last of the rest of the text."""
    count = len(sections)
    # Every character lies in one of 2 n + 1 cells: before, in, between and after sections.
    edges = sections.reshape(-1)
    low, high = spans[:, 0], np.maximum(spans[:, 1], spans[:, 0] + 1)
    first = np.searchsorted(edges, low, "right")
    touched = np.searchsorted(edges, high - 1, "right") - first + 1
    cells = np.bincount(first[touched == 1], minlength=2 * count + 1).astype(float)
    crossing = np.zeros(2 * count + 1, np.int64)
    if (touched > 1).any():
        tokens_over = np.flatnonzero(touched > 1)
        cell = ta.spread(first[tokens_over], touched[tokens_over])
        token = np.repeat(tokens_over, touched[tokens_over])
        bounded = np.concatenate([[-1], edges, [np.iinfo(np.int64).max]])
        held = np.minimum(bounded[cell + 1], high[token]) - np.maximum(bounded[cell], low[token])
        cell, token, held = cell[held > 0], token[held > 0], held[held > 0]  # no empty sections
        heads = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        several = np.diff(np.append(heads, len(token))) > 1
        crossing += np.bincount(cell[np.repeat(several, np.diff(np.append(heads, len(token))))], minlength=len(cells))
        if rule == "fraction":
            np.add.at(cells, cell, held / (high - low)[token])
        elif rule == "majority":
            order = np.lexsort((cell, -held, token))
            np.add.at(cells, cell[order][heads], 1)
        else:
            np.add.at(cells, cell[heads], 1)
    return (
        np.append(cells[1::2], cells[0::2].sum()),
        np.append(crossing[1::2], crossing[0::2].sum()),
    )


def attribute(
    df: DataFrame,
    tokenizer_path: str,
    text: Column | str = "text",
    intervals: Column | None = None,
    rule: str = "majority",
) -> DataFrame:
    """``df`` with ``token_counts``: an entry per section with its span, tokens and crossings.

    ``intervals`` is an array of ``struct<start, end>`` in code points, end exclusive; without
    it the sections are the lines of the text.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    by_line = intervals is None

    @F.arrow_udf(_COUNTS_DDL)
    def count(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        encoder = tokens.encoder(tokenizer_path, spans=True)
        for texts, given in batches:
            parts = []
            for low, high in ta.slices(ta.byte_lengths(texts)):
                some = texts.slice(low, high - low)
                found = encoder.encode(some)
                cut = None if by_line else given.slice(low, high - low).to_pylist()
                columns: list[list] = [[], [], [], [], []]
                offsets = [0]
                for i, one in enumerate(some.to_pylist()):
                    if by_line:
                        sections = line_bounds(one or "")
                    else:
                        pairs = [(x["start"], x["end"]) for x in cut[i] or []]
                        sections = np.array(pairs, np.int64).reshape(-1, 2)
                    spans = found.spans[found.bounds[i] : found.bounds[i + 1]]
                    held, crossing = allocate(spans, sections, rule)
                    size = len(sections) + bool(held[-1])
                    columns[0].append(np.append(np.arange(len(sections)), OUTSIDE)[:size])
                    columns[1].append(np.append(sections[:, 0], 0)[:size])
                    columns[2].append(np.append(sections[:, 1], 0)[:size])
                    columns[3].append(held[:size])
                    columns[4].append(crossing[:size])
                    offsets.append(offsets[-1] + size)
                arrays = [
                    pa.array(np.concatenate(column) if column else [], field.type)
                    for column, field in zip(columns, _COUNT)
                ]
                entries = pa.StructArray.from_arrays(arrays, fields=list(_COUNT))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries)
                parts.append(lists.cast(pa.list_(_COUNT)))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(_COUNT))

    text = F.col(text) if isinstance(text, str) else text
    given = F.lit(0) if by_line else intervals
    return df.withColumn("token_counts", count(text, given))
