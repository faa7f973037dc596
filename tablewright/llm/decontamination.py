"""Benchmark passages in documents: q-gram lemma filter and banded alignment.

Texts are compared as words: letters and digits in lower case, anything between words one space.
Benchmark items are cut into overlapping segments. A segment of m characters that occurs with at
most e edits shares at least ``m - q + 1 - q * e`` q-grams with the place, on diagonals (place in
the document less place in the segment) that differ by at most e. So a document is scanned for
q-grams of the benchmark, stretches with too few of them in a row are passed over, shared q-grams
are counted per segment and diagonal band (bands overlap by half, so that no run of e + 1
diagonals is split), and bands that meet the bound are verified by edit distance within the band.

The q-gram index is broadcast; it is built from blocks of benchmark items of bounded size, and a
benchmark of several blocks is searched for block by block.

Items with fewer than ``MIN_CHARS`` characters after normalisation are looked for whole, from the
beginning of a word to the end of one, with the same number of edits a character: one edit from 16
characters on, by q-grams of their own length, none below. In scripts written without blanks words
begin and end at every character.

Results for edge cases: null, empty and unmatched texts have an empty list; null items and items
without a letter or digit are left out, those with a null id are reported with it; items with equal
normalised text are all reported; an item found at several places has an entry for each; repeated
documents get equal results; empty tables give no entries; very long texts are searched whole, at
some 100 bytes a character. A column named as the result is replaced.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import text_arrays as ta

Q = 10
SEGMENT = 64
STRIDE = 32
# Edits per character of a segment, rounded down: 4 in 64.
EDIT_RATE = 1 / 16
# Shorter items are matched whole, between ends of words.
MIN_CHARS = 32
# Characters of the q-grams of such items: one in half an item is left whole by an edit.
SHORT_Q = 8
# Blocks of scripts that are written without blanks (Thai to Khmer, kana, Han).
UNSPACED = [
    (0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x312F),
    (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F),
    (0x20000, 0x323AF),
]
# Characters of benchmark items in one broadcast index, some 60 bytes each.
BLOCK_CHARS = 500_000
# Candidate bands aligned at once.
ALIGN_ROWS = 4096

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_BITS = 22

_log = logging.getLogger(__name__)

_LEAK = pa.struct(
    [
        ("item_id", pa.int64()),
        ("start", pa.int32()),
        ("end", pa.int32()),
        ("segments", pa.int32()),
        ("edits", pa.int32()),
    ]
)
LEAKS_DDL = "array<struct<item_id: bigint, start: int, end: int, segments: int, edits: int>>"


@lru_cache(maxsize=1)
def _word_table() -> np.ndarray:
    table = ta.letter_table().copy()
    table |= np.fromiter((chr(c).isdigit() for c in range(len(table))), bool, len(table))
    return table


@lru_cache(maxsize=1)
def _unspaced_table() -> np.ndarray:
    table = np.zeros(0x110000, bool)
    for first, last in UNSPACED:
        table[first : last + 1] = True
    return table


def word_edges(flat: ta.Flat) -> tuple[np.ndarray, np.ndarray]:
    """Whether a word may begin at each place of normalised texts, and end before it."""
    blank, unspaced = flat.codes == 32, _unspaced_table()[flat.codes]
    between = np.ones(len(blank) + 1, bool)
    between[1:-1] = unspaced[1:] | unspaced[:-1]
    between[flat.bounds] = True
    begins, ends = between.copy(), between
    begins[1:] |= blank
    ends[:-1] |= blank
    begins[:-1] &= ~blank
    ends[1:] &= ~blank
    return begins, ends


def normalise(flat: ta.Flat) -> tuple[ta.Flat, np.ndarray]:
    """Words in lower case with one space after each, and the place of each kept character."""
    word = _word_table()[flat.codes]
    follows = np.zeros(len(word), bool)
    follows[1:] = word[:-1] & ~word[1:]
    edges = flat.bounds[:-1]
    follows[edges[edges < len(word)]] = False
    places = np.flatnonzero(word | follows)
    codes = np.where(word[places], ta.lower_table()[flat.codes[places]], 32).astype(np.uint32)
    return ta.Flat(codes, np.searchsorted(places, flat.bounds)), places


def gram_hashes(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """Hash of the q characters from each position, by doubling."""
    with np.errstate(over="ignore"):
        power = {1: np.uint64(_MULTIPLIER)}
        level, width, result, done = codes.astype(np.uint64) + np.uint64(1), 1, None, 0
        shift = np.uint64(1)
        remaining = q
        while remaining:
            if remaining & 1:
                if result is None:
                    result = level
                else:
                    result = result[: max(0, len(level) - done)] + level[done:] * shift
                shift = shift * power[width]
                done += width
            remaining >>= 1
            if remaining:
                level = level[: max(0, len(level) - width)] + level[width:] * power[width]
                power[2 * width] = power[width] * power[width]
                width *= 2
        result = result[: max(0, len(codes) - q + 1)]
        result = (result ^ (result >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return result ^ (result >> np.uint64(29))


class Index(NamedTuple):
    """Segments of some items and their q-grams."""

    q: int
    items: list[list[int]]  # ids of the items with one text, by text number
    text: np.ndarray  # text number of each segment
    codes: np.ndarray  # [segment, longest segment], filled up with zeros
    lengths: np.ndarray
    edits: np.ndarray
    bounds: np.ndarray  # shared q-grams a place must have
    grams: np.ndarray  # sorted distinct hashes
    starts: np.ndarray  # of the postings of each
    postings: np.ndarray  # [posting, (segment, place in it)]
    marks: np.ndarray  # whether any hash has these top bits
    short: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # by length: sorted hashes, text numbers, codes
    near: Index | None  # of short items with an edit to spare


def build_index(items: list[tuple[int, str | None]]) -> Index:
    flat, _ = normalise(ta.flatten([text for _, text in items]))
    by_text: dict[bytes, list[int]] = {}
    for i, (item, _) in enumerate(items):
        codes = flat.codes[flat.bounds[i] : flat.bounds[i + 1]]
        codes = codes[:-1] if len(codes) and codes[-1] == 32 else codes
        if len(codes):
            by_text.setdefault(codes.tobytes(), []).append(item)
    rows, text = [], []
    near_rows, near_text = [], []
    exact: dict[int, list[tuple[int, np.ndarray]]] = {}
    for number, raw in enumerate(by_text):
        codes = np.frombuffer(raw, np.uint32)
        if len(codes) < MIN_CHARS:
            if len(codes) * EDIT_RATE >= 1:
                near_rows.append(codes)
                near_text.append(number)
            else:
                exact.setdefault(len(codes), []).append((number, codes))
            continue
        last = max(0, len(codes) - SEGMENT)
        for start in sorted({*range(0, last, STRIDE), last}):
            rows.append(codes[start : start + SEGMENT])
            text.append(number)
    names, short = list(by_text.values()), {length: _short(some) for length, some in exact.items()}
    near = _indexed(SHORT_Q, MIN_CHARS, names, near_rows, near_text) if near_rows else None
    return _indexed(Q, SEGMENT, names, rows, text)._replace(short=short, near=near)


def _indexed(q: int, width: int, names: list[list[int]], rows: list[np.ndarray], text: list[int]) -> Index:
    """Index of segments of at most ``width`` characters."""
    lengths = np.array([len(row) for row in rows], np.int64)
    edits = (lengths * EDIT_RATE).astype(np.int64)
    padded = np.zeros((len(rows), width), np.uint32)
    found = []
    for i, row in enumerate(rows):
        padded[i, : len(row)] = row
        found.append(gram_hashes(row, q))
    hashes = np.concatenate(found) if found else np.zeros(0, np.uint64)
    counts = np.array([len(one) for one in found], np.int64)
    segment = np.repeat(np.arange(len(rows)), counts)
    place = ta.spread(np.zeros(len(rows), np.int64), counts) if found else np.zeros(0, np.int64)
    order = np.argsort(hashes, kind="stable")
    grams, starts = np.unique(hashes[order], return_index=True)
    marks = np.zeros(1 << _BITS, bool)
    marks[(grams >> np.uint64(64 - _BITS)).astype(np.int64)] = True
    return Index(
        q, names, np.array(text, np.int64), padded, lengths, edits,
        np.maximum(lengths - q + 1 - q * edits, 1), grams, np.append(starts, len(hashes)),
        np.stack([segment[order], place[order]], 1), marks, {}, None,
    )


def _short(items: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes, text numbers and codes of items of one length."""
    codes = np.stack([one for _, one in items])
    hashes = (codes.astype(np.uint64) * _powers(_MULTIPLIER, codes.shape[1])).sum(1, dtype=np.uint64)
    order = np.argsort(hashes)
    return hashes[order], np.array([number for number, _ in items], np.int64)[order], codes[order]


def _powers(base: int, count: int) -> np.ndarray:
    """``base`` to the powers of 0 up to ``count - 1``, modulo 2 ** 64."""
    result = np.full(count, base, np.uint64)
    result[:1] = 1
    return np.cumprod(result)


def exact_places(flat: ta.Flat, index: Index) -> list[tuple[int, int, int, int, int]]:
    """``(text, item text, start, end, 0)`` where a short item stands between ends of words."""
    found: list[tuple[int, int, int, int, int]] = []
    if not index.short or not len(flat.codes):
        return found
    begins, ends = word_edges(flat)
    word = np.flatnonzero(begins[:-1])
    text = ta.text_of(flat.bounds, word)
    # The hash of a stretch is a difference of sums, brought to power 0 at its beginning.
    sums = np.zeros(len(flat.codes) + 1, np.uint64)
    np.cumsum(flat.codes.astype(np.uint64) * _powers(_MULTIPLIER, len(flat.codes)), out=sums[1:])
    inverse = _powers(_INVERSE, len(flat.codes))
    for length, (hashes, numbers, codes) in index.short.items():
        end = word + length
        fits = end <= flat.bounds[text + 1]
        start, end, holder = word[fits], end[fits], text[fits]
        closed = ends[end]
        start, end, holder = start[closed], end[closed], holder[closed]
        own = (sums[end] - sums[start]) * inverse[start]
        low, high = np.searchsorted(hashes, own), np.searchsorted(hashes, own, "right")
        which = np.repeat(np.arange(len(own)), high - low)
        item = ta.spread(low, high - low)
        same = (flat.codes[start[which, None] + np.arange(length)] == codes[item]).all(1)
        which, item = which[same], item[same]
        found += zip(holder[which].tolist(), numbers[item].tolist(), start[which].tolist(), end[which].tolist(), [0] * len(which))
    return found


def whole_places(
    found: list[tuple[int, int, int, int, int]], flat: ta.Flat, index: Index
) -> list[tuple[int, int, int, int, int]]:
    """The places near those found where a whole short item stands between ends of words."""
    if not found:
        return []
    begins, ends = word_edges(flat)
    segment = {number: i for i, number in enumerate(index.text.tolist())}
    kept = set()
    for text, number, at, _, _ in found:
        i = segment[number]
        budget = int(index.edits[i])
        item = index.codes[i, : index.lengths[i]].tolist()
        reach = 4 * (budget + 1)
        low, high = int(flat.bounds[text]), int(flat.bounds[text + 1])
        best = (budget + 1, 0, 0)
        for start in range(max(low, at - reach), min(high, at + reach + 1)):
            if begins[start]:
                stretch = flat.codes[start : min(high, start + len(item) + budget)].tolist()
                cost, end = _whole(item, stretch, ends[start:])
                best = min(best, (cost, start, start + end))
        if best[0] <= budget:
            kept.add((text, number, best[1], best[2], best[0]))
    return sorted(kept)


def _whole(item: list[int], stretch: list[int], closed: np.ndarray) -> tuple[int, int]:
    """Least edits from the item to a beginning of the stretch that ends a word, and its length."""
    costs = list(range(len(stretch) + 1))
    for code in item:
        last, costs[0] = costs[0], costs[0] + 1
        for j, other in enumerate(stretch, 1):
            last, costs[j] = costs[j], min(last + (code != other), costs[j] + 1, costs[j - 1] + 1)
    return min(((cost, end) for end, cost in enumerate(costs) if end and closed[end]), default=(len(item), 0))


def dense_hits(hits: np.ndarray, ends: np.ndarray, least: int, span: int) -> np.ndarray:
    """The hits that lie in a stretch of ``span`` places of one text with ``least`` hits."""
    if len(hits) < least:
        return hits[:0]
    close = (hits[least - 1 :] - hits[: len(hits) - least + 1]) < span
    close &= hits[least - 1 :] < ends[: len(hits) - least + 1]
    covered = np.zeros(len(hits) + 1, np.int64)
    covered[: len(close)] += close
    covered[least : least + len(close)] -= close
    return hits[np.cumsum(covered[:-1]) > 0]


def align(segments: np.ndarray, lengths: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(edits, start, end)`` of the best place of each segment in its window.

    Only paths within the band are looked at: character j of a segment against places
    j .. j + band of the window. Among places of least edits the shortest is taken.
    """
    n, width = segments.shape
    band = windows.shape[1] - width + 1
    unit = 1 << 20  # an edit; the rest of a value tells where the path began
    step = np.arange(band) * unit
    value = np.tile(band - 1 - np.arange(band, dtype=np.int64), (n, 1))
    final = value.copy()
    for j in range(width):
        match = value + (segments[:, j : j + 1] != windows[:, j : j + band]) * unit
        match[:, :-1] = np.minimum(match[:, :-1], value[:, 1:] + unit)
        value = np.minimum.accumulate(match - step, axis=1) + step
        final[lengths == j + 1] = value[lengths == j + 1]
    best = final.argmin(1)
    held = final[np.arange(n), best]
    return held // unit, band - 1 - held % unit, best + lengths


def find(texts: list[str | None], index: Index) -> list[list[dict]]:
    """Leaks of each text, by place."""
    flat, places = normalise(ta.flatten(texts))
    found = {*similar_places(flat, index), *exact_places(flat, index)}
    if index.near:
        found.update(whole_places(similar_places(flat, index.near), flat, index.near))
    found = sorted(found)
    return _merged(found, [[] for _ in texts], flat, places, index, texts)


def similar_places(flat: ta.Flat, index: Index) -> list[tuple[int, int, int, int, int]]:
    """``(text, item text, start, end, edits)`` where a segment of an item stands."""
    found: list[tuple[int, int, int, int, int]] = []
    q, width = index.q, index.codes.shape[1]
    if not len(index.grams) or len(flat.codes) < q:
        return found
    hashes = gram_hashes(flat.codes, q)
    hits = np.flatnonzero(index.marks[(hashes >> np.uint64(64 - _BITS)).astype(np.int64)])
    text = ta.text_of(flat.bounds, hits)
    inside = hits + q <= flat.bounds[text + 1]
    hits, text = hits[inside], text[inside]
    edits = int(index.edits.max())
    hits = dense_hits(hits, flat.bounds[text + 1], int(index.bounds.min()), width + edits - q + 1)
    gram = np.searchsorted(index.grams, hashes[hits])
    known = gram < len(index.grams)
    known[known] = index.grams[gram[known]] == hashes[hits[known]]
    hits, gram = hits[known], gram[known]
    if not len(hits):
        return found
    counts = index.starts[gram + 1] - index.starts[gram]
    posting = index.postings[ta.spread(index.starts[gram], counts)]
    place = np.repeat(hits, counts)
    segment = posting[:, 0]
    text = ta.text_of(flat.bounds, place)
    # Diagonals are counted from the start of the text, and kept above 0.
    diagonal = place - posting[:, 1] + width
    half = edits + 1
    band = diagonal // half
    keys = np.concatenate([band, band - 1]) * len(index.text) + np.tile(segment, 2)
    texts_of = np.tile(text, 2)
    # A band may reach over the end of a text; hits of different texts are counted apart.
    order = np.lexsort((texts_of, keys))
    keys, texts_of = keys[order], texts_of[order]
    head = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (texts_of[1:] != texts_of[:-1])))
    shared = np.diff(np.append(head, len(keys)))
    segment = keys[head] % len(index.text)
    met = shared >= index.bounds[segment]
    segment, text = segment[met], texts_of[head][met]
    first = (keys[head][met] // len(index.text)) * half - width - edits
    band_width = 2 * half + 2 * edits
    for at in range(0, len(segment), ALIGN_ROWS):
        some = slice(at, at + ALIGN_ROWS)
        look = first[some, None] + np.arange(width + band_width - 1)
        low, high = flat.bounds[text[some]], flat.bounds[text[some] + 1]
        out = (look < low[:, None]) | (look >= high[:, None])
        window = np.where(out, 0xFFFFFFFF, flat.codes[np.clip(look, 0, len(flat.codes) - 1)])
        cost, start, end = align(index.codes[segment[some]], index.lengths[segment[some]], window)
        good = (cost <= index.edits[segment[some]]) & (end > start)
        start = np.maximum(first[some] + start, low)[good]
        end = np.minimum(first[some] + end, high)[good]
        found += zip(
            text[some][good].tolist(), index.text[segment[some][good]].tolist(), start.tolist(), end.tolist(), cost[good].tolist()
        )
    return found


def _merged(found, leaks, flat, places, index: Index, texts) -> list[list[dict]]:
    """Entries for runs of overlapping or neighbouring matches of one item."""
    text_starts = np.cumsum([0] + [len(text or "") for text in texts])
    groups: list[list[int]] = []
    for text, item, start, end, cost in found:
        last = groups[-1] if groups else None
        if last and last[:2] == [text, item] and start <= last[3] + SEGMENT:
            last[3], last[4], last[5] = max(last[3], end), last[4] + 1, max(last[5], cost)
        else:
            groups.append([text, item, start, end, 1, cost])
    for text, item, start, end, segments, cost in groups:
        low = int(places[start] - text_starts[text])
        high = int(places[end - 1] - text_starts[text]) + 1
        for name in index.items[item]:
            leaks[text].append({"item_id": name, "start": low, "end": high, "segments": segments, "edits": cost})
    for entries in leaks:
        entries.sort(key=lambda entry: (entry["start"], entry["item_id"] is None, entry["item_id"] or 0, entry["end"]))
    return leaks


def blocks_of(benchmark: DataFrame, text: str, key: str, block_chars: int) -> list[DataFrame]:
    """The items in blocks of about ``block_chars`` characters each."""
    named = benchmark.select(F.col(key).cast("long").alias("item_id"), F.col(text).alias("text"))
    named = named.filter("text IS NOT NULL")
    chars = named.agg(F.sum(F.length("text"))).head()[0] or 0
    count = max(1, -(-int(chars) // block_chars))
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    return [named.filter(number == i) if count > 1 else named for i in range(count)]


def with_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_text: str = "text",
    item_key: str = "item_id",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``documents`` with ``leaks``: the benchmark items found in the text, and where."""
    context = documents.sparkSession.sparkContext
    columns = []
    for block in blocks_of(benchmark, item_text, item_key, block_chars):
        items = sorted(((row["item_id"], row["text"]) for row in block.collect()), key=lambda one: (one[0] is None, one))
        index = build_index(items)
        exact = sum(len(index.items[n]) for _, numbers, _ in index.short.values() for n in numbers)
        _log.info("%d of %d benchmark items are searched without edits, being short", exact, len(items))
        columns.append(_search(context.broadcast(index))(F.col(text)))
    return documents.withColumn("leaks", F.concat(*columns) if len(columns) > 1 else columns[0])


def _search(shared):
    @F.arrow_udf(LEAKS_DDL)
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = shared.value
        for batch in batches:
            rows: list[list[dict]] = []
            for low, high in ta.slices(ta.byte_lengths(batch)):
                rows += find(batch.slice(low, high - low).to_pylist(), index)
            yield pa.array(rows, pa.list_(_LEAK))

    return search
