"""Removal of repeated passages: matching statistics of documents against FM-indexes of shards.

A window is ``WINDOW`` consecutive words. A word goes if a window over it also starts earlier: in a
document of smaller key, or earlier in its own. Every occurrence but the first is removed, on the
whole table, judged on the input.

Shards are cut by content, so that all places of a passage meet in one index and no XX Windows of equal words have equal
least grams at the same place, hence lie in the same shard, and never twice in one segment.

1. Every document is cut into segments. Hashes of their grams, not texts, are counted in buckets;
   a gram that occurs once can not belong to a repeated window.
2. Documents are dealt into groups and streamed, in order, past the repeated grams of their group.
   Distinct segments with such a gram, each with its first place in the group, are the requests.
3. A shard builds a compressed FM-index of its distinct requests (``fm_index``: wavelet matrix of the
   Burrows-Wheeler transform, in order of first place) and streams every window through backward
   search. A window whose matching statistic reaches ``WINDOW`` words at a second place has an
   interval of two suffixes or more; the least position in it is its first occurrence.
4. Documents are streamed once more past the verdicts of their group; later places of a segment
   within a group need none.

Texts are moved twice at most, the second time only those with a repeated gram. Requests and
documents are read from one shuffle, each by a pass of its own, which takes less disk than a written
table of both. A gram with more
than ``HOT_SEGMENTS`` places (a line of a third of all documents) is cut into single windows, dealt
by the hash of all their words, so no shard gets it whole. Group, bucket and shard numbers follow the
measured size of the texts. Words are compared by 64-bit hashes.

Results for edge cases: a null or empty text has no words; a text shorter than a window loses none.
Rows are ordered by key, rows without one last, then by a hash of the text; rows equal in both are
the same document and get equal results. Keys are integers. A very long text is hashed and cut in
pieces, at some 30 bytes a word. Only the columns named are read; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import text_arrays as ta
from tablewright.llm.fm_index import FMIndex

WINDOW = 20
GRAM = 8
# Segments with one gram above which they are dealt window by window.
HOT_SEGMENTS = 50_000
# Bytes of text for each group, bucket and shard, and the most groups.
GROUP_BYTES = 8_000_000
MOST_GROUPS = 20_000
# Windows handled at once, request bytes and gram hashes held back by a task.
BLOCK = 500_000
HELD_BYTES = 24_000_000
HELD_GRAMS = 1_000_000

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_LONG_WORD = 256
_POWERS = np.cumprod(np.full(_LONG_WORD, _BASE | 1, _U))
_BLANK = np.zeros(256, bool)
_BLANK[list(b"\t\n\v\f\r ")] = True


# --- words, grams and segments ----------------------------------------------------------


def mix(hashes: np.ndarray) -> np.ndarray:
    """Spread all bits over all others."""
    hashes = (hashes ^ (hashes >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    hashes = (hashes ^ (hashes >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return hashes ^ (hashes >> _U(33))


def words_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word in the bytes of several texts."""
    starts, ends = ta.runs(~_BLANK[data], bounds)
    hashes = np.zeros(len(starts), _U)
    sizes = ends - starts
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // ta.BATCH_CHARS)) + 1
    for low, high in itertools.pairwise([0, *cuts.tolist(), len(sizes)] if len(sizes) else [0]):
        lengths = np.minimum(sizes[low:high], _LONG_WORD)
        firsts = np.cumsum(lengths) - lengths
        inside = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
        values = (data[ta.spread(starts[low:high], lengths)].astype(_U) + _U(1)) * _POWERS[inside]
        hashes[low:high] = mix(np.add.reduceat(values, firsts))
    for i in np.flatnonzero(sizes > _LONG_WORD):
        hashes[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
    return starts, ends, hashes


def grams(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` words, put together from runs of powers of two."""
    done, size, block, step = None, 0, hashes, 1
    while True:
        if length & step:
            if done is None:
                done = block
            else:
                joined = len(hashes) - size - step + 1
                done = done[:joined] * _U(pow(_BASE, step, 1 << 64)) + block[size : size + joined]
            size += step
        if size == length:
            return mix(done)
        block = block[:-step] * _U(pow(_BASE, step, 1 << 64)) + block[step:]
        step *= 2


def least(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least value of each ``width`` neighbours, and the place of its first occurrence."""
    places = np.arange(len(values))
    size = 1
    while size < width:
        step = min(size, width - size)
        later = values[step:] < values[:-step]
        places = np.where(later, places[step:], places[:-step])
        values = np.where(later, values[step:], values[:-step])
        size += step
    return values, places


def segments(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of windows and gram of every segment; ``bounds`` are those of the texts."""
    found = []
    text_ends = np.repeat(bounds[1:], np.diff(bounds))
    for low in range(0, len(hashes) - WINDOW + 1, BLOCK):
        part = hashes[low : low + BLOCK + WINDOW - 1]
        values, places = least(grams(part, GRAM), WINDOW - GRAM + 1)
        firsts = np.arange(low, low + len(values))
        whole = firsts + WINDOW <= text_ends[firsts]
        fresh = whole.copy()
        fresh[1:] &= (places[1:] != places[:-1]) | ~whole[:-1]
        starts = np.flatnonzero(fresh)
        windows = np.bincount(np.cumsum(fresh)[whole] - 1, minlength=len(starts))
        found.append((starts + low, windows, values[starts]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U)
    return tuple(np.concatenate(column) for column in zip(*found))


def content(hashes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of the words of each segment."""
    if not len(starts):
        return np.zeros(0, _U)
    firsts = np.cumsum(lengths) - lengths
    inside = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    return mix(np.add.reduceat(hashes[ta.spread(starts, lengths)] * _POWERS[inside], firsts))


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts end to end, with their bounds; null is empty."""
    parts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    bounds = np.frombuffer(parts.buffers()[1], np.int64)[parts.offset : parts.offset + len(parts) + 1]
    buffer = parts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


# --- step 1: grams that occur more than once --------------------------------------------


def _distinct(major: np.ndarray, minor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of pairs, and where in that order each distinct pair begins."""
    order = np.lexsort((minor, major))
    major, minor = major[order], minor[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (major[1:] != major[:-1]) | (minor[1:] != minor[:-1])
    return order, np.flatnonzero(fresh)


def _count_grams(buckets: int):
    """Gram hashes of a task with their group and number of places, packed by bucket."""

    def packed(found: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        gram, group = (np.concatenate(column) for column in zip(*found))
        order, firsts = _distinct(gram, group)
        numbers = np.diff(np.append(firsts, len(order)))
        gram, group = gram[order[firsts]], group[order[firsts]]
        bucket = (mix(gram) % _U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        used, firsts = np.unique(bucket[order], return_index=True)
        edges = dict(zip(used.tolist(), itertools.pairwise([*firsts.tolist(), len(order)])))
        columns = [gram[order], group.astype("<u4")[order], numbers.astype("<u4")[order]]
        for some in np.array_split(used, max(1, len(used) // 1000)):
            bodies = [[column[slice(*edges[b])].tobytes() for b in some.tolist()] for column in columns]
            arrays = [pa.array(some, pa.int32()), *[pa.array(body, pa.binary()) for body in bodies]]
            yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "gram", "group", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for batch in batches:
            for rows, _ in ta.record_slices(batch, "text"):
                data, bounds = _flat(rows.column("text"))
                starts, _, hashes = words_of(data, bounds)
                word_bounds = np.searchsorted(starts, bounds)
                places, _, gram = segments(hashes, word_bounds)
                group = rows.column("group").to_numpy()[ta.text_of(word_bounds, places)]
                if len(gram):
                    found.append((gram, group))
                    held += len(gram)
                if held > HELD_GRAMS:
                    yield from packed(found)
                    found, held = [], 0
        if found:
            yield from packed(found)

    return run


def _numbers(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _repeated_grams(table: pa.Table) -> pa.Table:
    """Of one bucket: for each group the grams that occur again somewhere, with a mark if hot."""
    gram, group, n = (_numbers(table[name], kind) for name, kind in (("gram", "<u8"), ("group", "<u4"), ("n", "<u4")))
    known, where = np.unique(gram, return_inverse=True)
    total = np.bincount(where, weights=n, minlength=len(known))
    kept = np.flatnonzero(total[where] > 1)
    order, firsts = _distinct(group[kept], gram[kept])
    kept = kept[order[firsts]]
    columns = [gram[kept], (total[where[kept]] > HOT_SEGMENTS).astype("u1")]
    groups, firsts = np.unique(group[kept], return_index=True)
    edges = [*firsts.tolist(), len(kept)]
    bodies = [[column[a:b].tobytes() for a, b in itertools.pairwise(edges)] for column in columns]
    return pa.table(
        [pa.array(groups, pa.int32()), *[pa.array(body, pa.binary()) for body in bodies]], names=["group", "gram", "hot"]
    )


# --- step 2: documents past the repeated grams of their group ---------------------------


def _sorted_runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Neighbouring rows of one group and kind."""
    group, kind = batch.column("group").to_numpy(), batch.column("kind").to_numpy()
    edges = np.flatnonzero((np.diff(group) != 0) | (np.diff(kind) != 0)) + 1
    for a, b in itertools.pairwise([0, *edges.tolist(), len(group)]):
        if b > a:
            yield int(group[a]), int(kind[a]), batch.slice(a, b - a)


_REQUEST = [("nokey", "u1"), ("key", "<i8"), ("order", "<i8"), ("start", "<u4"), ("size", "<u4")]
_SEGMENT = np.dtype([("start", "<u4"), ("windows", "u1"), ("first", "u1"), ("content", "<u8")])


def _packed_requests(rows: np.ndarray, data: np.ndarray) -> bytes:
    raw = np.array([len(rows)], "<u4").tobytes() + b"".join(rows[name].tobytes() for name, _ in _REQUEST) + data.tobytes()
    return np.array([len(raw)], "<u8").tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked_requests(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    size = int(np.frombuffer(body, "<u8", 1)[0])
    raw = pa.decompress(body[8:], decompressed_size=size, codec="zstd", asbytes=True)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    rows, at = np.zeros(n, _REQUEST), 4
    for name, kind in _REQUEST:
        rows[name] = np.frombuffer(raw, kind, n, at)
        at += n * np.dtype(kind).itemsize
    return rows, np.frombuffer(raw, np.uint8, offset=at)


class _Group:
    """Repeated grams, segments seen and requests not yet sent of one group of documents."""

    def __init__(self, number: int, shards: int):
        self.number, self.shards = number, shards
        self.gram, self.hot = np.zeros(0, _U), np.zeros(0, bool)
        self.seen = np.zeros(0, _U)
        self.requests: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def learn(self, rows: pa.RecordBatch) -> None:
        gram = np.concatenate([self.gram, _numbers(rows.column("gram"), "<u8")])
        hot = np.concatenate([self.hot, _numbers(rows.column("hot"), "u1").astype(bool)])
        order = np.argsort(gram)
        self.gram, self.hot = gram[order], hot[order]

    def candidates(self, hashes: np.ndarray, word_bounds: np.ndarray):
        """Segments whose gram occurs again: first word, windows, content hash, shard."""
        starts, windows, gram = segments(hashes, word_bounds)
        if not len(self.gram) or not len(gram):
            return starts[:0], windows[:0], gram[:0], starts[:0]
        at = np.minimum(np.searchsorted(self.gram, gram), len(self.gram) - 1)
        known = self.gram[at] == gram
        starts, windows, gram, hot = starts[known], windows[known], gram[known], self.hot[at[known]]
        if hot.any():
            parts = np.where(hot, windows, 1)
            inside = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
            starts, hot = np.repeat(starts, parts) + inside, np.repeat(hot, parts)
            windows, gram = np.where(hot, 1, np.repeat(windows, parts)), np.repeat(gram, parts)
        found = content(hashes, starts, windows + WINDOW - 1)
        shard = (mix(np.where(hot, found, gram)) % _U(self.shards)).astype(np.int64)
        return starts, windows, found, shard

    def first_places(self, found: np.ndarray) -> np.ndarray:
        """Mark segments not seen before in this group."""
        known, at = np.unique(found, return_index=True)
        if len(self.seen):
            near = np.minimum(np.searchsorted(self.seen, known), len(self.seen) - 1)
            fresh = self.seen[near] != known
            known, at = known[fresh], at[fresh]
        first = np.zeros(len(found), bool)
        first[at] = True
        self.seen = np.sort(np.concatenate([self.seen, known]))
        return first

    def flushed(self) -> Iterator[tuple[int, bytes]]:
        """Shards and packed requests."""
        if not self.requests:
            return
        shard = np.concatenate([one[0] for one in self.requests])
        rows = np.concatenate([one[1] for one in self.requests])
        data = np.concatenate([one[2] for one in self.requests])
        self.requests, self.held = [], 0
        order = np.argsort(shard, kind="stable")
        sizes = rows["size"].astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        numbers, firsts = np.unique(shard[order], return_index=True)
        for number, a, b in zip(numbers, firsts, [*firsts[1:], len(order)]):
            some = order[a:b]
            yield int(number), _packed_requests(rows[some], data[ta.spread(starts[some], sizes[some])])


_REQUESTS = "group int, shard int, requests binary"
_DOCUMENTS = (
    "group int, nokey boolean, key long, order long, n_words long, kept_sha256 string, text string, segments binary"
)


def digest(text: bytes, kept: np.ndarray | None = None) -> str:
    """SHA-256 of the kept words joined by one space; all without ``kept``."""
    total, at, begun = hashlib.sha256(), 0, False
    for words in ta.word_lists(text):
        count = len(words)
        if kept is not None:
            words = list(itertools.compress(words, kept[at : at + count].tolist()))
        at += count
        if words:
            total.update((b" " if begun else b"") + b" ".join(words))
            begun = True
    return total.hexdigest()


def _same_as_previous(rows: pa.RecordBatch, previous) -> np.ndarray:
    """Rows equal in key and order to the one before them; ``previous`` precedes the first."""
    names = ["nokey", "key", "order"]
    columns = [rows.column(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in names]
    same = np.zeros(rows.num_rows, bool)
    if previous is not None:
        same[0] = all(int(column[0]) == value for column, value in zip(columns, previous))
    same[1:] = np.logical_and.reduce([column[1:] == column[:-1] for column in columns])
    return same


class _Parsed:
    """Candidate segments of some documents, with their first places in the group marked."""

    def __init__(self, state: _Group, rows: pa.RecordBatch):
        self.rows = rows
        self.data, self.bounds = _flat(rows.column("text"))
        self.starts, self.ends, hashes = words_of(self.data, self.bounds)
        self.word_bounds = np.searchsorted(self.starts, self.bounds)
        self.places, self.windows, self.content, self.shard = state.candidates(hashes, self.word_bounds)
        self.owner = ta.text_of(self.word_bounds, self.places)
        self.first = state.first_places(self.content)

    def requests(self) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Shard, row and bytes of each segment at its first place."""
        new = np.flatnonzero(self.first)
        if not len(new):
            return None
        begin = self.starts[self.places[new]]
        size = self.ends[self.places[new] + self.windows[new] + WINDOW - 2] - begin
        asked = np.zeros(len(new), _REQUEST)
        asked["size"], asked["start"] = size, self.places[new] - self.word_bounds[self.owner[new]]
        for name in ("nokey", "key", "order"):
            asked[name] = self.rows.column(name).to_numpy(zero_copy_only=False)[self.owner[new]]
        return self.shard[new], asked, self.data[ta.spread(begin, size)]

    def documents(self, texts: bool) -> pa.RecordBatch:
        """Documents with their segments; a text without any is done and leaves its digest alone."""
        listed = np.zeros(len(self.places), _SEGMENT)
        listed["start"], listed["windows"] = self.places - self.word_bounds[self.owner], self.windows
        listed["first"], listed["content"] = self.first, self.content
        edges = np.searchsorted(self.owner, np.arange(self.rows.num_rows + 1))
        bodies = [listed[a:b].tobytes() or None for a, b in itertools.pairwise(edges)]
        spans = itertools.pairwise(self.bounds)
        whole = [None if body else digest(self.data[a:b].tobytes()) for body, (a, b) in zip(bodies, spans)]
        keep = pa.array([texts or body is not None for body in bodies], pa.bool_())
        own = {name: self.rows.column(name) for name in ("group", "nokey", "key", "order")}
        own |= {"n_words": pa.array(np.diff(self.word_bounds)), "kept_sha256": pa.array(whole, pa.string())}
        own |= {"text": pc.if_else(keep, self.rows.column("text"), pa.scalar(None, pa.string()))}
        return pa.RecordBatch.from_pydict(own | {"segments": pa.array(bodies, pa.binary())})


def _groups(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[tuple[_Group, pa.RecordBatch, np.ndarray]]:
    """Documents in bounded parts, with the state of their group and marks on repeated rows."""
    state, previous = None, None
    for batch in batches:
        for group, kind, part in _sorted_runs(batch):
            if state is None or state.number != group:
                state, previous = _Group(group, shards), None
            if kind == 0:
                state.learn(part)
                continue
            for rows, _ in ta.record_slices(part, "text"):
                same = _same_as_previous(rows, previous)
                previous = [int(rows.column(name)[-1].as_py()) for name in ("nokey", "key", "order")]
                yield state, rows, same


def _ask(shards: int):
    """Requests of every group."""

    def sent(state: _Group) -> pa.RecordBatch:
        pairs = list(state.flushed())
        arrays = [pa.array([value] * len(pairs), pa.int32()) for value in (state.number,)]
        arrays += [pa.array([shard for shard, _ in pairs], pa.int32()), pa.array([body for _, body in pairs], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["group", "shard", "requests"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        for state, rows, same in _groups(batches, shards):
            if current is not None and current is not state:
                yield sent(current)
            current = state
            found = None if same.all() else _Parsed(state, rows.filter(pa.array(~same))).requests()
            if found is not None:
                state.requests.append(found)
                state.held += len(found[2]) + 40 * len(found[1])
            if state.held > HELD_BYTES:
                yield sent(state)
        if current is not None:
            yield sent(current)

    return run


def _list(shards: int, texts: bool):
    """Documents with their candidate segments; a repeated row is that before it once more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for state, rows, same in _groups(batches, shards):
            out = None if same.all() else _Parsed(state, rows.filter(pa.array(~same))).documents(texts)
            if same.any():
                pool = [one for one in (last, out) if one is not None]
                before = last is not None
                at = pa.array(np.cumsum(~same) - 1 + before)
                out = pa.Table.from_batches(pool).take(at).combine_chunks().to_batches()[0]
            last = out.slice(out.num_rows - 1)
            yield out

    return run


# --- step 3: one shard ------------------------------------------------------------------


def repeats(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per segment the bits of its windows that stand at an earlier place too.

    ``hashes`` has the words of all segments end to end, in order of place. The index is built over
    all of them.
    """
    _, ids = np.unique(hashes, return_inverse=True)
    places = np.arange(len(ids)) + np.repeat(np.arange(len(lengths)), lengths)  # a zero after each text
    text = np.zeros(len(ids) + len(lengths), np.int64)
    text[places] = ids + 1
    index = FMIndex(text)
    windows = np.maximum(lengths - WINDOW + 1, 0)
    owner = np.repeat(np.arange(len(lengths)), windows)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    begins = (np.cumsum(lengths) - lengths + np.arange(len(lengths)))[owner] + inside
    again, low, high = index.repeated(begins, WINDOW)
    later = again[index.earliest(low, high) < begins[again]]
    bits = np.zeros(len(lengths), _U)
    np.bitwise_or.at(bits, owner[later], _U(1) << inside[later].astype(_U))
    return bits


def _judge_shard(table: pa.Table) -> pa.Table:
    """Verdicts on the requests of a shard, packed by group; windows without one stay."""
    bodies = [_unpacked_requests(body) for body in table["requests"].to_pylist()]
    groups = np.repeat(table["group"].to_numpy(), [len(rows) for rows, _ in bodies])
    rows = np.concatenate([rows for rows, _ in bodies])
    data = np.concatenate([text for _, text in bodies])
    bounds = np.concatenate([[0], np.cumsum(rows["size"].astype(np.int64))])
    starts, _, hashes = words_of(data, bounds)
    word_bounds = np.searchsorted(starts, bounds)
    begins, lengths = word_bounds[:-1], np.diff(word_bounds)
    order = np.lexsort([rows[name] for name in ("start", "order", "key", "nokey")])
    rows, groups, begins, lengths = rows[order], groups[order], begins[order], lengths[order]
    contents = content(hashes, begins, lengths)
    _, firsts, which = np.unique(contents, return_index=True, return_inverse=True)
    distinct = np.sort(firsts)  # in order of place
    bits = np.zeros(len(rows), _U)
    bits[distinct] = repeats(hashes[ta.spread(begins[distinct], lengths[distinct])], lengths[distinct])
    # What is not the first place of a segment is repeated as a whole.
    later = np.ones(len(rows), bool)
    later[distinct] = False
    place = [rows[name] for name in ("start", "order", "key", "nokey")]
    first = firsts[which]
    same_place = np.logical_and.reduce([one == one[first] for one in place])
    bits = np.where(later, np.where(same_place, bits[first], ~_U(0)), bits)
    some = np.flatnonzero(bits)
    some = some[np.argsort(groups[some], kind="stable")]
    numbers, starts = np.unique(groups[some], return_index=True)
    edges = [*starts, len(some)]
    packed = [[column[some[a:b]].tobytes() for a, b in itertools.pairwise(edges)] for column in (contents, bits)]
    return pa.table(
        [pa.array(numbers, pa.int32()), *[pa.array(body, pa.binary()) for body in packed]], names=["group", "content", "bits"]
    )


# --- step 4: documents past the verdicts of their group ---------------------------------


def removed_words(listed: np.ndarray, bits: np.ndarray, n_words: int) -> np.ndarray:
    """Mark the words under windows with a bit; ``bits`` belong to the segments ``listed``."""
    edges = np.zeros(n_words + 1, np.int64)
    for j in range(int(listed["windows"].max(initial=0))):
        hit = (bits >> _U(j) & _U(1)).astype(bool) & (listed["windows"] > j)
        starts = listed["start"][hit].astype(np.int64) + j
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + WINDOW, -1)
    return np.cumsum(edges[:-1]) > 0


def spans_of(removed: np.ndarray) -> list[dict[str, int]]:
    starts, ends = ta.runs(removed, np.array([0, len(removed)]))
    return [{"start": a, "end": b} for a, b in zip(starts.tolist(), ends.tolist())]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_RESULT = (
    "nokey boolean, key long, n_words long, n_removed long, removed array<struct<start: long, end: long>>, "
    "kept_sha256 string, kept string"
)


def _apply(texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, content_known, bits_known = None, np.zeros(0, _U), np.zeros(0, _U)
        for batch in batches:
            for group, kind, part in _sorted_runs(batch):
                if group != current:
                    current, content_known, bits_known = group, np.zeros(0, _U), np.zeros(0, _U)
                if kind == 0:
                    known = np.concatenate([content_known, _numbers(part.column("content"), "<u8")])
                    found = np.concatenate([bits_known, _numbers(part.column("bits"), "<u8")])
                    order = np.argsort(known)
                    content_known, bits_known = known[order], found[order]
                    continue
                for rows, _ in ta.record_slices(part, "text"):
                    yield documents(rows, content_known, bits_known)

    def documents(rows: pa.RecordBatch, known: np.ndarray, found: np.ndarray) -> pa.RecordBatch:
        lost, spans, digests, kept_texts = [], [], [], []
        column = pc.fill_null(rows.column("text").cast(pa.large_binary()), b"")
        facts = zip(*[rows.column(name).to_pylist() for name in ("segments", "n_words", "kept_sha256")])
        for i, (body, n_words, whole) in enumerate(facts):
            if body is None:
                removed = np.zeros(n_words if texts else 0, bool)
            else:
                listed = np.frombuffer(body, _SEGMENT)
                bits = np.zeros(len(listed), _U)
                if len(known):
                    at = np.minimum(np.searchsorted(known, listed["content"]), len(known) - 1)
                    bits = np.where(known[at] == listed["content"], found[at], _U(0))
                removed = removed_words(listed, np.where(listed["first"], bits, ~_U(0)), n_words)
            text = column[i].as_buffer().to_pybytes()
            lost.append(int(removed.sum()))
            spans.append(spans_of(removed))
            digests.append(whole or digest(text, ~removed))
            kept_texts.append(kept_text(text, ~removed) if texts else None)
        arrays = [rows.column(name) for name in ("nokey", "key", "n_words")]
        arrays += [pa.array(lost, pa.int64()), pa.array(spans, _SPANS), pa.array(digests, pa.string()), pa.array(kept_texts, pa.string())]
        names = ["nokey", "key", "n_words", "n_removed", "removed", "kept_sha256", "kept"]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def kept_text(text: bytes, kept: np.ndarray) -> str:
    parts, at = [], 0
    for words in ta.word_lists(text):
        parts += itertools.compress(words, kept[at : at + len(words)].tolist())
        at += len(words)
    return b" ".join(parts).decode()


def _streamed(facts: DataFrame, documents: DataFrame) -> DataFrame:
    """Facts (kind 0) before the documents (kind 1) of each group, in order of place."""
    both = facts.withColumn("kind", F.lit(0)).unionByName(documents.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    return both.repartition("group").sortWithinPartitions("group", "kind", "nokey", "key", "order")


def deduplicate(df: DataFrame, key: str = "doc_id", text: str = "text", texts: bool = False) -> DataFrame:
    """A row per document: ``key, n_words, n_removed, removed, kept_sha256`` and with ``texts`` ``kept``.

    ``removed`` has spans of word numbers, ``kept`` the words that stay joined by one space,
    ``kept_sha256`` the digest of that.
    """
    own_key, own_text = F.col(f"`{key}`"), F.col(f"`{text}`")
    rows = df.select(
        own_key.isNull().alias("nokey"),
        F.coalesce(own_key.cast("long"), F.lit(0).cast("long")).alias("key"),
        F.xxhash64(own_text).alias("order"),
        own_text.alias("text"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    shards = max(1, -(-size // GROUP_BYTES))
    groups = min(shards, MOST_GROUPS)
    rows = rows.withColumn("group", F.pmod(F.xxhash64("nokey", "key", "order"), F.lit(groups)).cast("int"))
    grams_seen = rows.select("group", "text").mapInArrow(_count_grams(shards), "bucket int, gram binary, group binary, n binary")
    known = grams_seen.groupBy("bucket").applyInArrow(_repeated_grams, "group int, gram binary, hot binary")
    streamed = _streamed(known, rows)
    requests = streamed.mapInArrow(_ask(shards), _REQUESTS)
    verdicts = requests.groupBy("shard").applyInArrow(_judge_shard, "group int, content binary, bits binary")
    documents = streamed.mapInArrow(_list(shards, texts), _DOCUMENTS)
    found = _streamed(verdicts, documents).mapInArrow(_apply(texts), _RESULT)
    names = ["n_words", "n_removed", "removed", "kept_sha256", *(["kept"] if texts else [])]
    return found.select(F.when(~F.col("nokey"), F.col("key")).alias(key), *names)
