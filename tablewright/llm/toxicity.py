"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

1. A lexicon of words and word beginnings is mined from labelled rows: those that a likelihood
   ratio test finds more often in toxic texts. A short list of English insults joins it.
2. Voters look at a text: each votes toxic, clean or not at all. Lexicon voters hold a part of
   the lexicon each, pattern voters look at capitals, exclamation marks and masking symbols.
3. A generative model with one hidden label per text estimates, by expectation maximisation and
   without the given labels, how each voter behaves on toxic and on clean texts, and how voters
   are correlated beyond the label; a voter counts less the more it repeats others. Only the
   share of toxic rows is taken from the labels.
4. A logistic classifier over lexicon entries and text patterns is trained on the posterior
   labels. It scores every whole text.

The lexicon and the classifier are fitted on at most about ``LABELLED_ROWS`` labelled rows, drawn
by a hash. Results for edge cases: null and empty texts get the score of a text without any
evidence; rows without a label or id are not learned from; with no toxic rows only the short list
counts; equal texts get equal scores; an empty table gives an empty one. A column named as a
result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import text_arrays as ta
from tablewright.sizing import broadcast_if_small
from tablewright.staging import stage

LABELLED_ROWS = 20_000
PREFIXES = (3, 4, 5, 6, 7)
# Signed likelihood ratio a mined entry needs, and the share of toxic rows among its rows.
LEAST_RATIO = 20.0
LEAST_PRECISION = 0.8
LEXICON_ENTRIES = 2000
LEXICON_PARTS = 4
EM_ROUNDS = 40
NEGLIGIBLE_CORRELATION = 0.1

# Common English insults.
INSULT_NOUNS = ["idiot", "moron", "loser", "clown", "scum", "trash", "fool", "coward", "bastard", "jerk"]
INSULT_ADJECTIVES = ["stupid", "pathetic", "worthless", "disgusting", "dumb", "ugly", "useless", "filthy"]

_WHOLE = 99
_MARK_BITS = 20


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def grams(flat: ta.Flat) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(kind, hash, text)`` of every word beginning of each length, and of whole words."""
    starts, ends = ta.runs(ta.letter_table()[flat.codes], flat.bounds)
    if not len(starts):
        return
    text, lengths = ta.text_of(flat.bounds, starts), ends - starts
    places = ta.spread(starts, lengths)
    lowered = ta.lower_table()[flat.codes[places]].astype(np.uint64) + np.uint64(1)
    first = np.cumsum(lengths) - lengths
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(max(int(lengths.max()), max(PREFIXES)), 0x9E3779B97F4A7C15, np.uint64))
        hashed = np.zeros(len(starts), np.uint64)
        for length in range(1, max(PREFIXES) + 1):
            has = lengths >= length
            hashed, text_of, first_of, lengths = hashed[has], text[has], first[has], lengths[has]
            text, first = text_of, first_of
            hashed = hashed + lowered[first + length - 1] * powers[length - 1]
            if length in PREFIXES:
                yield length, _mixed(hashed + np.uint64(length)), text
        lengths = ends - starts
        offsets = np.cumsum(lengths) - lengths
        weighted = lowered * powers[np.arange(len(places)) - np.repeat(offsets, lengths)]
        whole = np.add.reduceat(weighted, offsets)
        yield _WHOLE, _mixed(whole + np.uint64(_WHOLE)), ta.text_of(flat.bounds, starts)


def gram_of(word: str, kind: int = _WHOLE) -> int:
    return next(int(hashes[0]) for found, hashes, _ in grams(ta.flatten([word])) if found == kind)


def distinct_grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """``(text, hash)`` of the different grams of each text."""
    found = list(grams(ta.flatten(texts)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = np.concatenate([one[1] for one in found])
    text = np.concatenate([one[2] for one in found])
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1]))
    return text[new], hashes[new]


class Lexicon(NamedTuple):
    hashes: np.ndarray  # sorted
    part: np.ndarray  # voter of each entry
    parts: int
    marks: np.ndarray  # whether any hash has these top bits


def _lexicon(parts: dict[int, int], count: int) -> Lexicon:
    hashes = np.array(sorted(parts), np.uint64)
    marks = np.zeros(1 << _MARK_BITS, bool)
    marks[(hashes >> np.uint64(64 - _MARK_BITS)).astype(np.int64)] = True
    return Lexicon(hashes, np.array([parts[int(h)] for h in hashes], np.int64), count, marks)


# Text patterns: capitals, exclamation marks, masking symbols, digits, per letter or character.
PATTERNS = ("capitals", "exclamations", "symbols", "digits")
_PATTERN_LIMITS = (0.5, 0.02, 0.05, 0.1)


class Evidence(NamedTuple):
    """Lexicon entries found in texts, each once per text, and the patterns of each text."""

    text: np.ndarray
    entry: np.ndarray
    patterns: np.ndarray  # [text, pattern]


def evidence(texts: list[str | None], lexicon: Lexicon) -> Evidence:
    flat = ta.flatten(texts)
    entries, holders = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for _, hashes, text in grams(flat):
        maybe = np.flatnonzero(lexicon.marks[(hashes >> np.uint64(64 - _MARK_BITS)).astype(np.int64)])
        at = np.searchsorted(lexicon.hashes, hashes[maybe])
        at[at == len(lexicon.hashes)] = 0
        same = lexicon.hashes[at] == hashes[maybe] if len(lexicon.hashes) else np.zeros(0, bool)
        entries.append(at[same])
        holders.append(text[maybe[same]])
    size = max(1, len(lexicon.hashes))
    pairs = np.unique(np.concatenate(holders) * size + np.concatenate(entries))
    codes = flat.codes
    letter = ta.letter_table()[codes]
    masks = (
        letter & (ta.lower_table()[codes] != codes),
        codes == ord("!"),
        np.isin(codes, [ord(c) for c in "*#$%&@"]),
        (codes >= 48) & (codes <= 57),
    )
    sizes = np.maximum(np.diff(flat.bounds), 1)
    counts = []
    for mask in masks:
        total = np.concatenate([[0], np.cumsum(mask)])
        counts.append((total[flat.bounds[1:]] - total[flat.bounds[:-1]]) / sizes)
    return Evidence(pairs // size, pairs % size, np.stack(counts, 1))


def votes(found: Evidence, lexicon: Lexicon) -> np.ndarray:
    """[text, voter] of 1 toxic, -1 clean, 0 no vote."""
    n = len(found.patterns)
    lexical = np.zeros((n, lexicon.parts), np.int8)
    lexical[found.text, lexicon.part[found.entry]] = 1
    hits = np.bincount(found.text, minlength=n)
    patterns = (found.patterns > np.array(_PATTERN_LIMITS)).astype(np.int8)
    several = np.where(hits >= 2, 1, np.where(hits == 0, -1, 0)).astype(np.int8)
    calm = np.where(found.patterns.max(1) < 0.1, -1, 0).astype(np.int8)
    return np.column_stack([lexical, patterns, several, calm])


class LabelModel(NamedTuple):
    behaviour: np.ndarray  # [voter, label, vote + 1] probabilities
    weights: np.ndarray  # of voters; below 1 where a voter repeats others
    prior: float
    correlations: np.ndarray

    def accuracies(self) -> np.ndarray:
        """Of each voter, among its votes, the expected share that is right."""
        right = self.behaviour[:, 1, 2] * self.prior + self.behaviour[:, 0, 0] * (1 - self.prior)
        wrong = self.behaviour[:, 0, 2] * (1 - self.prior) + self.behaviour[:, 1, 0] * self.prior
        return right / np.maximum(right + wrong, 1e-12)

    def posterior(self, cast: np.ndarray) -> np.ndarray:
        logs = np.log(self.behaviour)
        ratio = np.full(len(cast), np.log(self.prior / (1 - self.prior)))
        for j in range(cast.shape[1]):
            ratio += self.weights[j] * (logs[j, 1] - logs[j, 0])[cast[:, j] + 1]
        return 1 / (1 + np.exp(-np.clip(ratio, -50, 50)))


def fit_label_model(cast: np.ndarray, prior: float, rounds: int = EM_ROUNDS) -> LabelModel:
    """Expectation maximisation from votes alone; ``prior`` is the share of toxic texts."""
    voters = cast.shape[1]
    prior = float(np.clip(prior, 0.005, 0.5))
    behaviour = np.tile(np.array([[0.3, 0.6, 0.1], [0.1, 0.5, 0.4]]), (voters, 1, 1))
    model = LabelModel(behaviour, np.full(voters, 0.5), prior, np.eye(voters))
    onehot = np.stack([cast == v for v in (-1, 0, 1)], 2).astype(float)
    for turn in range(rounds):
        label = model.posterior(cast)
        both = np.stack([1 - label, label])
        behaviour = np.einsum("yn,njv->jyv", both, onehot) + 0.5
        behaviour /= behaviour.sum(2, keepdims=True)
        expected = behaviour[:, :, 2] - behaviour[:, :, 0]  # [voter, label]
        rest = cast - (both.T @ expected.T)
        spread = np.sqrt((rest**2).mean(0)) + 1e-9
        correlations = (rest.T @ rest) / max(1, len(cast)) / np.outer(spread, spread)
        strong = np.abs(correlations) * (np.abs(correlations) > NEGLIGIBLE_CORRELATION)
        np.fill_diagonal(strong, 0)
        weights = 1 / (1 + strong.sum(1)) if turn >= 5 else model.weights
        model = LabelModel(behaviour, weights, prior, correlations)
    return model


class ToxicityModel(NamedTuple):
    lexicon: Lexicon
    entries: np.ndarray  # weight of each lexicon entry
    patterns: np.ndarray
    count: float  # weight of log(1 + entries found)
    bias: float
    labels: LabelModel | None

    def score(self, found: Evidence) -> np.ndarray:
        n = len(found.patterns)
        logit = self.bias + found.patterns @ self.patterns
        logit += np.bincount(found.text, self.entries[found.entry] if len(found.entry) else None, n)
        logit += self.count * np.log1p(np.bincount(found.text, minlength=n))
        return 1 / (1 + np.exp(-np.clip(logit, -50, 50)))


def fit_classifier(found: Evidence, target: np.ndarray, lexicon: Lexicon, rounds: int = 400) -> ToxicityModel:
    """Logistic regression on posterior labels, by accelerated gradient steps."""
    n, size, width = len(target), len(lexicon.hashes), found.patterns.shape[1]
    hits = np.log1p(np.bincount(found.text, minlength=n))
    theta = np.zeros(size + width + 2)
    moment, square = np.zeros_like(theta), np.zeros_like(theta)
    theta[-1] = -2.0
    for turn in range(1, rounds + 1):
        model = ToxicityModel(lexicon, theta[:size], theta[size:-2], theta[-2], theta[-1], None)
        off = (model.score(found) - target) / max(1, n)
        slope = np.concatenate(
            [np.bincount(found.entry, off[found.text], size), off @ found.patterns, [off @ hits, off.sum()]]
        )
        slope[:-1] += 1e-4 * theta[:-1]
        moment, square = 0.9 * moment + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        theta -= 0.1 * (moment / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-8)
    return ToxicityModel(lexicon, theta[:size], theta[size:-2], theta[-2], theta[-1], None)


def _signed_ratio(pos: np.ndarray, neg: np.ndarray, positives: int, negatives: int) -> np.ndarray:
    """Likelihood ratio of different rates of an entry in toxic and clean rows."""
    both = (pos + neg) / max(1, positives + negatives)

    def fit(k, n, rate):
        rate = np.clip(rate, 1e-9, 1 - 1e-9)
        return k * np.log(rate) + (n - k) * np.log(1 - rate)

    high, low = pos / max(1, positives), neg / max(1, negatives)
    ratio = 2 * (fit(pos, positives, high) + fit(neg, negatives, low) - fit(pos, positives, both) - fit(neg, negatives, both))
    return np.where(high > low, ratio, -ratio)


def _count_grams(known: np.ndarray | None):
    """Counts texts per gram and label; of grams in ``known`` only, where given."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in ta.text_slices(batch):
                toxic = part.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
                text, hashes = distinct_grams(texts)
                if known is not None and len(known):
                    at = np.searchsorted(known, hashes)
                    at[at == len(known)] = 0
                    same = known[at] == hashes
                    text, hashes = text[same], hashes[same]
                values, at = np.unique(hashes, return_inverse=True)
                pos = np.bincount(at, toxic[text], len(values)).astype(np.int64)
                total = np.bincount(at, minlength=len(values)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values.view(np.int64)), pa.array(pos), pa.array(total - pos)], names=["gram", "pos", "neg"]
                )

    return count


def mine(rows: DataFrame, positives: int, negatives: int) -> list[int]:
    """Hashes of the entries that labelled ``rows`` (text, toxic) show to be toxic, best first."""
    schema = "gram long, pos long, neg long"
    frequent = rows.filter("toxic = 1").mapInArrow(_count_grams(None), schema)
    frequent = frequent.groupBy("gram").agg(F.sum("pos").alias("pos")).filter("pos >= 3").select("gram").toPandas()
    known = np.sort(frequent["gram"].to_numpy(np.int64).view(np.uint64))
    if not len(known):
        return []
    # At most the distinct grams of the toxic rows of the sample.
    shared = rows.sparkSession.sparkContext.broadcast(known)
    counted = rows.mapInArrow(lambda batches: _count_grams(shared.value)(batches), schema)
    table = counted.groupBy("gram").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).toPandas()
    pos, neg = table["pos"].to_numpy(float), table["neg"].to_numpy(float)
    table["ratio"] = _signed_ratio(pos, neg, positives, negatives)
    table["precision"] = pos / np.maximum(pos + neg, 1)
    good = table[(table["ratio"] >= LEAST_RATIO) & (table["precision"] >= LEAST_PRECISION)]
    best = good.sort_values(["ratio", "gram"], ascending=[False, True])["gram"].head(LEXICON_ENTRIES)
    return [int(gram) for gram in best.to_numpy(np.int64).view(np.uint64)]


def labelled_sample(
    df: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id", max_rows: int = LABELLED_ROWS
) -> DataFrame:
    """Staged rows ``key, text, label`` of about ``max_rows`` labelled keys, or of all if there are fewer.

    The sample is drawn from the labels alone, so that only its texts are joined, by a broadcast of
    its keys, and shuffled. A key has one row: its label is 1 if any of its labels is, its text the
    least of its texts. Keys, texts and labels that are null count nothing.
    """
    named = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("toxic"))
    one = named.filter("key IS NOT NULL AND toxic IN (0, 1)").groupBy("key").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, max_rows / max(1, one.count()))
    drawn = broadcast_if_small(stage(one.filter(_drawn("key", share)), "drawn"))
    texts = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).filter("text IS NOT NULL")
    rows = texts.join(drawn, "key").groupBy("key", "toxic").agg(F.min("text").alias("text"))
    return stage(rows.select(F.col("key").alias(key), F.col("text").alias(text), F.col("toxic").alias(label)), "labelled")


def _drawn(key: str, share: float):
    """The same keys for the same share, and more of them for a larger one."""
    return F.pmod(F.xxhash64(key), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))


def fit(labelled: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id", max_rows: int = LABELLED_ROWS) -> ToxicityModel:
    """Fit on labelled rows; of more than ``max_rows`` about so many are used."""
    rows = labelled.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).cast("int").alias("toxic"))
    rows = rows.filter("text IS NOT NULL AND toxic IN (0, 1) AND key IS NOT NULL")
    share = min(1.0, max_rows / max(1, rows.count()))
    rows = rows.filter(_drawn("key", share)).select("text", "toxic")
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    positives, negatives = sizes.get(1, 0), sizes.get(0, 0)
    parts = {gram: 2 + i % LEXICON_PARTS for i, gram in enumerate(mine(rows, positives, negatives))}
    parts |= {gram_of(word): 0 for word in INSULT_NOUNS} | {gram_of(word): 1 for word in INSULT_ADJECTIVES}
    lexicon = _lexicon(parts, 2 + LEXICON_PARTS)
    found = _gathered(rows.select("text"), lexicon)
    if not len(found.patterns):
        weights = np.full(len(lexicon.hashes), 3.0)
        return ToxicityModel(lexicon, weights, np.zeros(len(PATTERNS)), 0.0, -2.0, None)
    cast = votes(found, lexicon)
    labels = fit_label_model(cast, positives / max(1, positives + negatives))
    return fit_classifier(found, labels.posterior(cast), lexicon)._replace(labels=labels)


def _gathered(rows: DataFrame, lexicon: Lexicon) -> Evidence:
    """Evidence of the sample: per text its lexicon entries and patterns, without the text."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in ta.text_slices(batch):
                found = evidence(texts, shared.value)
                bounds = np.searchsorted(found.text, np.arange(len(texts) + 1)).astype(np.int32)
                entries = pa.ListArray.from_arrays(pa.array(bounds), pa.array(found.entry))
                steps = np.arange(0, found.patterns.size + 1, found.patterns.shape[1], dtype=np.int32)
                patterns = pa.ListArray.from_arrays(pa.array(steps), pa.array(found.patterns.reshape(-1)))
                yield pa.RecordBatch.from_arrays([entries, patterns], names=["entries", "patterns"])

    table = rows.mapInArrow(look, "entries array<long>, patterns array<double>").toPandas()
    lengths = np.array([len(one) for one in table["entries"]], np.int64)
    entry = np.concatenate([np.zeros(0, np.int64), *table["entries"]]).astype(np.int64)
    patterns = np.array(table["patterns"].tolist(), float).reshape(-1, len(PATTERNS))
    return Evidence(np.repeat(np.arange(len(lengths)), lengths), entry, patterns)


def with_score(df: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``df`` with ``toxicity``: the probability that the text is toxic."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fitted = shared.value
        for batch in batches:
            parts = [
                fitted.score(evidence(batch.slice(low, high - low).to_pylist(), fitted.lexicon))
                for low, high in ta.slices(ta.byte_lengths(batch))
            ]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return df.withColumn("toxicity", score(F.col(text)))
