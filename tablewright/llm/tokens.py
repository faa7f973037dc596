"""Encoding of whole texts with a public tokenizer, each distinct piece once per worker.

A text is cut where the tokenizer cuts it anyway, between a word and the white space or the
ASCII punctuation after it; the distinct pieces of a batch are encoded by the ``tokenizers``
library and kept in a bounded memo, and the ids of the batch are gathered by numpy. The result
equals encoding each text in one call. Strings of special tokens in a text are ordinary text.

Pieces of plain Latin letters need no cutting or normalising but for case, so they go straight
to the library's merge model; probe words decide which of two spellings a tokenizer file has for
them, or that it has none.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from tablewright.llm import text_arrays as ta

# Pieces a worker keeps, some 200 bytes each, unless an operator asks for fewer; longer pieces are
# not kept. Half of them are those used since the memo was last halved, the others those used before.
MEMO_PIECES = 1_200_000
MEMO_PIECE_CHARS = 64

# White space and invisible characters on which libraries may differ, and the cut mark: texts
# that hold one are encoded in a single call.
_UNUSUAL = (
    r"[\x00\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}\x{2029}\x{202f}\x{205f}"
    r"\x{2060}\x{3000}\x{feff}]"
)
_SPACE = r"([\t-\r ]+)"
_LETTER_AND_SIGN = r"(\pL)([!-/:-@\[-`{-~])"
# Texts encoded together; the more, the fewer repeated look-ups.
SLICE_CHARS = 3_000_000

# Letters whose lower case is one letter of the same list, and which are never recomposed.
_LATIN = "A-Za-zÀ-ÖØ-Þà-öø-þ"
_DROPPED_SPACE = re.compile(f"[\t-\r ]*([{_LATIN}]+)")
_KEPT_SPACE = re.compile(f"( ?[{_LATIN}]+)")
_PROBES = ["the", "Of", "stra", "Élan", "ñandú", "ÀÖØÞ", "zebra", "A", "unbelievable", "été"]


class Encoded(NamedTuple):
    """Ids of several texts end to end; ``spans`` has the start and end character of each id."""

    ids: np.ndarray
    bounds: np.ndarray
    spans: np.ndarray | None = None


class Encoder:
    """One tokenizer file. ``spans`` asks for character spans as well as ids."""

    def __init__(self, path: str, spans: bool = False, memo_pieces: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.spans = spans
        self.memo_pieces = memo_pieces
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        letters = [chr(c) for c in range(0x100) if re.match(f"[{_LATIN} ]", chr(c))]
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        kept = {ord(c): spell(c)[0][0] for c in letters}
        lowered = {ord(c): spell(c.lower())[0][0] for c in letters}
        self.plain = None
        for pattern, spelling in ((_DROPPED_SPACE, lowered), (_KEPT_SPACE, kept)):
            if self.plain is None and not spans and self._agrees(pattern, spelling):
                self.plain = (pattern, spelling)

    def _agrees(self, pattern: re.Pattern, spelling: dict[int, str]) -> bool:
        probes = [space + word for word in _PROBES for space in ("", " ")]
        whole = [self.tokenizer.encode(probe, add_special_tokens=False).ids for probe in probes]
        return whole == [self._merged(pattern.fullmatch(probe)[1], spelling) for probe in probes]

    def _merged(self, word: str, spelling: dict[int, str]) -> list[int]:
        return [token.id for token in self.tokenizer.model.tokenize(word.translate(spelling))]

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def _packed(self, pieces: list[str]) -> list[bytes]:
        """Per piece the ids, or rows of id, start and end, as 32-bit integers."""
        if self.spans:
            found = self.tokenizer.encode_batch(pieces, add_special_tokens=False)
            rows = []
            for one in found:
                row = np.empty((len(one.ids), 3), np.uint32)
                if len(row):
                    row[:, 0], row[:, 1:] = one.ids, one.offsets
                rows.append(row.tobytes())
            return rows
        ids: list[list[int] | None] = [None] * len(pieces)
        if self.plain:
            pattern, spelling = self.plain
            tokenize = self.tokenizer.model.tokenize
            for i, piece in enumerate(pieces):
                if match := pattern.fullmatch(piece):
                    ids[i] = [token.id for token in tokenize(match[1].translate(spelling))]
        rest = [i for i, one in enumerate(ids) if one is None]
        found = self.tokenizer.encode_batch_fast([pieces[i] for i in rest], add_special_tokens=False)
        for i, one in zip(rest, found):
            ids[i] = one.ids
        return [array("I", one).tobytes() for one in ids]

    def _known(self, pieces: list[str]) -> list[bytes]:
        memo, older = self.memo, self.older
        packed = [memo.get(piece) for piece in pieces]
        absent = [i for i, one in enumerate(packed) if one is None]
        missing = []
        for i in absent:
            packed[i] = older.get(pieces[i])
            if packed[i] is None:
                missing.append(i)
        words = [pieces[i] for i in missing]
        for start, end in ta.slices(np.array([len(word) for word in words], np.int64), 500_000):
            for i, one in zip(missing[start:end], self._packed(words[start:end])):
                packed[i] = one
        if len(memo) + len(absent) > (self.memo_pieces or MEMO_PIECES) // 2:
            self.memo, self.older = {}, memo
        self.memo.update((pieces[i], packed[i]) for i in absent if len(pieces[i]) <= MEMO_PIECE_CHARS)
        return packed

    def encode(self, texts: pa.Array) -> Encoded:
        """Ids of every text; null counts as empty."""
        texts = pc.fill_null(texts, "")
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        unusual = pc.match_substring_regex(texts, _UNUSUAL)
        # Cuts stand before runs of white space, and between a letter and a sign.
        cut = pc.replace_substring_regex(texts, _SPACE, "\x00\\1")
        cut = pc.replace_substring_regex(cut, _LETTER_AND_SIGN, "\\1\x00\\2")
        cut = pc.if_else(unusual, texts, cut)
        lists = pc.split_pattern(cut, "\x00")
        if pc.any(unusual).as_py():
            offsets, parts = [0], []
            for i, odd in enumerate(unusual.to_pylist()):
                parts.append(texts.slice(i, 1) if odd else lists[i].values)
                offsets.append(offsets[-1] + len(parts[-1]))
            pieces = pa.concat_arrays(parts)
            offsets = np.array(offsets, np.int64)
        else:
            pieces = lists.flatten()
            offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
        coded = pieces.dictionary_encode()
        words = coded.indices.to_numpy(zero_copy_only=False)
        packed = self._known(coded.dictionary.to_pylist())
        width = 3 if self.spans else 1
        lengths = np.fromiter(map(len, packed), np.int64, len(packed)) // (4 * width)
        starts = np.cumsum(lengths) - lengths
        table = np.frombuffer(b"".join(packed), np.uint32).reshape(-1, width)
        counts = lengths[words] if len(words) else np.zeros(0, np.int64)
        rows = table[ta.spread(starts[words], counts)] if len(words) else table[:0]
        before = np.concatenate([[0], np.cumsum(counts)])
        bounds = before[offsets]
        if not self.spans:
            return Encoded(rows[:, 0], bounds)
        sizes = pc.utf8_length(coded.dictionary).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.concatenate([[0], np.cumsum(sizes[words])]) if len(words) else np.zeros(1, np.int64)
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        piece_starts = at[:-1] - at[offsets[:-1]][text]
        spans = rows[:, 1:].astype(np.int64) + np.repeat(piece_starts, counts)[:, None]
        return Encoded(rows[:, 0], bounds, spans)


@lru_cache(maxsize=4)
def encoder(path: str, spans: bool = False, memo_pieces: int | None = None) -> Encoder:
    """The worker's encoder of a tokenizer file; its memo lasts as long as the worker."""
    return Encoder(path, spans, memo_pieces)
