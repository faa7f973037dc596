"""Language of mixed texts: script ranges narrow candidates, Viterbi labels spans.

A word is a run of letters of one script. Its script leaves the languages that write it; each of
them scores the word by the log-probabilities of its letter trigrams and of the word itself.
Viterbi over the words of a text, with a penalty for each change of language, gives spans; the
language with most letters is the language of the text.

Results for edge cases: null text, or text without a letter, is ``und`` with score 0 and no
spans; a script no learned language writes gives no evidence, so such a word takes the language
of its neighbours, and a text of nothing else the most frequent language with score 0; ties go
to the first language by name; repeated rows get equal results; an empty table gives an empty
one. A column that has the name of a result column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm import text_arrays as ta

UNKNOWN = "und"

# Buckets of hashed trigrams and words.
BUCKETS = 1 << 16
# Expected number of labelled rows of a language used to count trigrams.
ROWS_PER_LANGUAGE = 20_000
# Log-probability units a change of language costs.
SWITCH_PENALTY = 12.0
# A language writes a script that holds at least this share of its letters.
SCRIPT_SHARE = 0.01
# Score of a language that does not write the script of a word.
OTHER_SCRIPT = -40.0

# First and last code point of the main blocks of each script.
SCRIPT_RANGES = {
    "latin": [(0x0041, 0x024F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF)],
    "greek": [(0x0370, 0x03FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x0400, 0x052F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x0530, 0x058F)],
    "hebrew": [(0x0590, 0x05FF)],
    "arabic": [(0x0600, 0x06FF), (0x0750, 0x077F), (0x08A0, 0x08FF), (0xFB50, 0xFDFF)],
    "devanagari": [(0x0900, 0x097F)],
    "bengali": [(0x0980, 0x09FF)],
    "gurmukhi": [(0x0A00, 0x0A7F)],
    "gujarati": [(0x0A80, 0x0AFF)],
    "tamil": [(0x0B80, 0x0BFF)],
    "telugu": [(0x0C00, 0x0C7F)],
    "kannada": [(0x0C80, 0x0CFF)],
    "malayalam": [(0x0D00, 0x0D7F)],
    "sinhala": [(0x0D80, 0x0DFF)],
    "thai": [(0x0E00, 0x0E7F)],
    "lao": [(0x0E80, 0x0EFF)],
    "tibetan": [(0x0F00, 0x0FFF)],
    "georgian": [(0x10A0, 0x10FF), (0x2D00, 0x2D2F)],
    "ethiopic": [(0x1200, 0x137F)],
    "khmer": [(0x1780, 0x17FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2FA1F)],
}
SCRIPTS = ["other", *SCRIPT_RANGES]


@lru_cache(maxsize=1)
def script_table() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for number, ranges in enumerate(SCRIPT_RANGES.values(), 1):
        for first, last in ranges:
            table[first : last + 1] = number
    return table


class Words(NamedTuple):
    """Words of a batch: bounds in the flat array, script, hash buckets of their features."""

    starts: np.ndarray
    ends: np.ndarray
    scripts: np.ndarray
    word_buckets: np.ndarray
    letters: np.ndarray  # positions of all letters of all words, in order
    trigram_buckets: np.ndarray  # one for each of these letters


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return ((values ^ (values >> np.uint64(29))) % np.uint64(BUCKETS)).astype(np.int32)


def words_of(flat: ta.Flat) -> Words:
    letter = ta.letter_table()[flat.codes]
    script = script_table()[flat.codes]
    # A mark (script "other") belongs to the word it stands in.
    change = np.zeros(len(letter), bool)
    change[1:] = (script[1:] != script[:-1]) & (script[1:] > 0) & (script[:-1] > 0)
    starts, ends = ta.runs(letter, flat.bounds)
    cuts = np.flatnonzero(change & letter)
    if len(cuts) and len(starts):
        inside = cuts[cuts > starts[np.maximum(np.searchsorted(starts, cuts, "right") - 1, 0)]]
        starts, ends = np.union1d(starts, inside), np.union1d(ends, inside)
    # Marks alone, as after an emoji or a digit, are no word.
    base = np.append(0, np.cumsum(letter & ~ta.mark_table()[flat.codes]))
    lettered = base[ends] > base[starts]
    starts, ends = starts[lettered], ends[lettered]
    lengths = ends - starts
    positions = ta.spread(starts, lengths)
    lowered = ta.lower_table()[flat.codes[positions]].astype(np.uint64)
    first = np.zeros(len(positions), bool)
    first[np.cumsum(lengths) - lengths] = True
    last = np.roll(first, -1)
    before, after = np.roll(lowered, 1), np.roll(lowered, -1)
    before[first], after[last] = 0, 0
    trigrams = _mixed((before * np.uint64(0x110000) + lowered) * np.uint64(0x110000) + after)
    order = np.arange(len(positions)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))
        weighted = (lowered + np.uint64(1)) * powers[order % 64]
        offsets = np.cumsum(lengths) - lengths
        hashes = np.add.reduceat(weighted, offsets) if len(offsets) else weighted
    return Words(starts, ends, script[starts], _mixed(hashes), positions, trigrams)


class LanguageModel(NamedTuple):
    languages: list[str]
    trigrams: np.ndarray  # [bucket, language] log-probabilities
    words: np.ndarray
    writes: np.ndarray  # [script, language]
    common: int  # index of the most frequent language


def fit(
    rows: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    rows_per_language: int = ROWS_PER_LANGUAGE,
) -> LanguageModel:
    """Count trigrams, words and scripts of each language over its labelled rows.

    Of a language with more than ``rows_per_language`` rows about so many are used, picked by a
    hash of ``key``. Tasks count; the driver receives one number per language and bucket.
    """
    named = rows.select(
        F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(key).cast("string").alias("key")
    ).filter("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in named.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0)), np.zeros((BUCKETS, 0)), np.zeros((len(SCRIPTS), 0), bool), 0)
    share = F.create_map(
        *[F.lit(x) for k in languages for x in (k, min(1.0, rows_per_language / sizes[k]))]
    )
    drawn = F.pmod(F.xxhash64("key", "text"), F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30)
    index = {k: i for i, k in enumerate(languages)}
    width = 2 * BUCKETS + len(SCRIPTS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(languages), width), np.int64)
        for batch in batches:
            for part, texts in ta.text_slices(batch):
                flat = ta.flatten(texts)
                of_row = np.array([index[k] for k in part.column("lang").to_pylist()], np.int64)
                words = words_of(flat)
                for kind, buckets, at in (
                    (0, words.trigram_buckets, words.letters),
                    (BUCKETS, words.word_buckets, words.starts),
                    (2 * BUCKETS, np.repeat(words.scripts, words.ends - words.starts), words.letters),
                ):
                    language = of_row[ta.text_of(flat.bounds, at)]
                    cells = language * width + kind + buckets
                    totals += np.bincount(cells, minlength=totals.size).reshape(totals.shape)
        language, bucket = totals.nonzero()
        yield pa.RecordBatch.from_arrays(
            [pa.array(language), pa.array(bucket), pa.array(totals[language, bucket])],
            names=["language", "bucket", "n"],
        )

    counted = named.filter(drawn).select("text", "lang").mapInArrow(count, "language long, bucket long, n long")
    table = counted.groupBy("language", "bucket").agg(F.sum("n").alias("n")).toPandas()
    totals = np.zeros((width, len(languages)))
    totals[table["bucket"], table["language"]] = table["n"]
    letters = totals[2 * BUCKETS :]
    writes = letters >= np.maximum(SCRIPT_SHARE * letters.sum(0), 1)
    common = max(range(len(languages)), key=lambda i: sizes[languages[i]])
    return LanguageModel(
        languages,
        _log_share(totals[:BUCKETS]),
        _log_share(totals[BUCKETS : 2 * BUCKETS]),
        writes,
        common,
    )


def _log_share(counts: np.ndarray) -> np.ndarray:
    smoothed = counts + 0.05
    return np.log(smoothed / smoothed.sum(0)).astype(np.float32)


def word_scores(words: Words, model: LanguageModel) -> np.ndarray:
    """[word, language] log-scores; zeros where no learned language writes the script."""
    if not len(words.starts):
        return np.zeros((0, len(model.languages)), np.float32)
    lengths = words.ends - words.starts
    offsets = np.cumsum(lengths) - lengths
    scores = np.add.reduceat(model.trigrams[words.trigram_buckets], offsets, axis=0)
    scores += model.words[words.word_buckets]
    writes = model.writes[words.scripts]
    scores = np.where(writes, scores, scores.min(1, keepdims=True) + np.float32(OTHER_SCRIPT))
    scores[~writes.any(1)] = 0
    return scores - scores.max(1, keepdims=True)


def best_path(scores: np.ndarray, penalties: np.ndarray) -> np.ndarray:
    """The states that maximise scores less ``penalties[t]`` for each change into step t.

    A step with penalty 0 starts a new sequence, so all texts of a batch form one chain. The
    chain is cut into blocks that are worked on side by side: the first pass finds, for every
    state a block may be entered from, the best score of each state it may be left in; a short
    pass over blocks fixes the entry states; the last pass follows the choices back.
    """
    n, states = scores.shape
    if not n or states == 1:
        return np.zeros(n, np.int64)
    width = max(1, int(np.sqrt(n)))
    blocks = -(-n // width)
    padded = np.zeros((blocks * width, states), np.float32)
    padded[:n] = scores
    cost = np.zeros(blocks * width, np.float32)
    cost[:n] = penalties
    by_step = padded.reshape(blocks, width, states).transpose(1, 0, 2)
    costs = cost.reshape(blocks, width).T
    through = np.full((blocks, states, states), -np.inf, np.float32)
    through[:, range(states), range(states)] = 0
    for t in range(width):
        switched = through.max(2) - costs[t][:, None]
        through = np.maximum(through, switched[:, :, None]) + by_step[t][:, None, :]
    entry = np.zeros((blocks, states))
    value = np.zeros(states)
    for block in range(blocks):
        entry[block] = value
        value = (value[:, None] + through[block]).max(0)
        value -= value.max()
    final = int(value.argmax())
    rows = np.arange(blocks)
    value = entry
    back = np.empty((width, blocks, states), np.int16)
    for t in range(width):
        top = value.argmax(1)
        switched = value[rows, top] - costs[t]
        stay = value >= switched[:, None]
        stay[rows, top] = True
        back[t] = np.where(stay, np.arange(states), top[:, None])
        value = np.where(stay, value, switched[:, None]) + by_step[t]
    came = np.tile(np.arange(states), (blocks, 1))
    for t in reversed(range(width)):
        came = back[t][rows[:, None], came]
    state = np.empty(blocks, np.int64)
    for block in reversed(range(blocks)):
        state[block] = final
        final = int(came[block, final])
    path = np.empty((width, blocks), np.int64)
    for t in reversed(range(width)):
        path[t] = state
        state = back[t][rows, state]
    return path.T.reshape(-1)[:n]


_RESULT = "struct<lang_pred: string, lang_score: double, lang_spans: array<struct<start: int, end: int, lang: string>>>"


def _label(texts: list[str | None], model: LanguageModel, penalty: float):
    """Languages, scores and spans of some texts."""
    flat = ta.flatten(texts)
    words = words_of(flat)
    scores = word_scores(words, model)
    text = ta.text_of(flat.bounds, words.starts)
    penalties = np.full(len(text), penalty, np.float32)
    new_text = np.ones(len(text), bool)
    new_text[1:] = text[1:] != text[:-1]
    penalties[new_text] = 0
    path = best_path(scores, penalties)
    known = model.writes[words.scripts].any(1)
    letters = words.ends - words.starts
    tally = np.zeros((len(texts), len(model.languages)))
    np.add.at(tally, (text[known], path[known]), letters[known])
    total = np.bincount(text, letters, len(texts))
    best = tally.argmax(1)
    best[tally.max(1, initial=0) == 0] = model.common
    first = new_text.copy()
    first[1:] |= path[1:] != path[:-1]
    heads = np.flatnonzero(first)
    tails = np.append(heads[1:], len(path))[: len(heads)] - 1
    per_text = np.bincount(text[heads], minlength=len(texts))
    return (
        [model.languages[k] if t else UNKNOWN for k, t in zip(best, total)],
        tally[np.arange(len(texts)), best] / np.maximum(total, 1),
        np.concatenate([[0], np.cumsum(per_text)]),
        words.starts[heads] - flat.bounds[text[heads]],
        words.ends[tails] - flat.bounds[text[heads]],
        [model.languages[k] for k in path[heads]],
    )


def identify(
    df: DataFrame, model: LanguageModel, text: str = "text", penalty: float = SWITCH_PENALTY
) -> DataFrame:
    """``df`` with ``lang_pred``, ``lang_score`` (share of the letters) and ``lang_spans``."""
    # Scores take languages x letters numbers, so more languages mean smaller slices.
    limit = max(10_000, min(ta.BATCH_CHARS, 8 * ta.BATCH_CHARS // max(1, len(model.languages))))
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct(
        [
            ("lang_pred", pa.string()),
            ("lang_score", pa.float64()),
            ("lang_spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))),
        ]
    )

    @F.arrow_udf(_RESULT)
    def label(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fitted = shared.value
        for batch in batches:
            parts = []
            for start, end in ta.slices(ta.byte_lengths(batch), limit):
                texts = batch.slice(start, end - start).to_pylist()
                if not fitted.languages:
                    rows = [{"lang_pred": UNKNOWN, "lang_score": 0.0, "lang_spans": []}] * len(texts)
                    parts.append(pa.array(rows, kind))
                    continue
                names, scores, offsets, first, last, span_names = _label(texts, fitted, penalty)
                spans = pa.StructArray.from_arrays(
                    [pa.array(first, pa.int32()), pa.array(last, pa.int32()), pa.array(span_names, pa.string())],
                    fields=list(kind.field("lang_spans").type.value_type),
                )
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)
                arrays = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), lists.cast(kind.field("lang_spans").type)]
                parts.append(pa.StructArray.from_arrays(arrays, fields=list(kind)))
            yield pa.concat_arrays(parts) if parts else pa.array([], kind)

    kept = [c for c in df.columns if c not in ("lang_pred", "lang_score", "lang_spans")]
    labelled = df.select(*[F.col(f"`{c}`") for c in kept], label(F.col(text)).alias("__label"))
    return labelled.select(*[F.col(f"`{c}`") for c in kept], "__label.*")


def held_out(key: str = "doc_id") -> Column:
    """Rows a model must not learn from: crc32 of the key as text leaves 1 by 3."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))
