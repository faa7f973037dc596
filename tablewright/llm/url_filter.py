"""URL filter: rules first, then a ratio of two character language models.

Rules name a host and the beginning of a path; the longest fitting rule decides. The urls that
rules decide train two smoothed variable-order Markov models, of accepted and of rejected urls:
the probability of a character after its last k characters mixes the counts of that context with
the probability after k - 1 characters, by Witten and Bell's estimate of how often a context
brings something new. A url is blocked where the log-likelihood of the rejected model exceeds
that of the accepted one by more than a threshold per character; the threshold is calibrated on
urls that rules decide and that were kept from training.

All urls that rules decide are counted, but for one in ``CALIBRATION_SHARE``, and all of those
calibrate. The counts stay a staged table: a gram (a character and up to ``ORDER`` before it) has
one row with what it adds to a score, and urls are scored by joining distinct urls with the grams
in them. The driver and the tasks hold the most frequent grams only, fewer than ``KNOWN_GRAMS``
whatever the input, which spares the join most rows and all frequent keys.

Results for edge cases: a null url and one without ``://`` have an empty host and path and fit
no rule; null and empty urls are blocked, there being nothing to fetch; where rules accept or
reject no url at all, the others are allowed; equal urls get equal verdicts; very long urls are
scored whole; an empty table gives an empty one. Columns named as results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm import text_arrays as ta
from tablewright.staging import stage

ORDER = 6
CALIBRATION_SHARE = 5  # one in so many
ALPHABET = 256.0
# Grams with more than this part of all occurrences are looked up in tasks, so fewer than so many.
KNOWN_GRAMS = 100_000
# Scores are summed in whole units, so that a sum does not depend on the order of rows.
UNIT = float(1 << 32)
# Width of the classes of scores the threshold is calibrated on.
SCORE_STEP = 1 / 1024

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PARTS = r"://([^/?#]*)([^?#]*)"
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Rule(NamedTuple):
    allow: bool
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rule(verdict: str, text: str) -> Rule:
    """``rule("block", "example.com/en/")``"""
    host, slash, path = text.partition("/")
    return Rule(verdict == "allow", host, slash + path)


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1)
    return F.translate(found, _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def deciding(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null; of two equal ones, block."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for one in sorted(rules, key=lambda r: (len(r.text), not r.allow)):
        fits = ((host == one.host) | F.endswith(host, F.lit("." + one.host))) & F.startswith(path, F.lit(one.path))
        name = F.when(fits, F.lit(one.text)).otherwise(name)
        verdict = F.when(fits, F.lit("allow" if one.allow else "block")).otherwise(verdict)
    return name, verdict


def contexts(flat: ta.Flat, order: int = ORDER) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(k, places, context hash, hash with the character)`` of the characters with k before them."""
    codes = ta.lower_table()[flat.codes].astype(np.uint64) + np.uint64(1)
    place = np.arange(len(codes)) - flat.bounds[ta.text_of(flat.bounds, np.arange(len(codes)))]
    with np.errstate(over="ignore"):
        before = np.zeros(len(codes), np.uint64)
        for k in range(order + 1):
            places = np.flatnonzero(place >= k)
            salted = _mixed(before[places] * np.uint64(order + 1) + np.uint64(k))
            yield k, places, salted, _mixed(salted * _MULTIPLIER + codes[places])
            # The context of k + 1 characters adds the one k + 1 places back.
            longer = np.zeros(len(codes), np.uint64)
            further = np.flatnonzero(place >= k + 1)
            longer[further] = before[further] * _MULTIPLIER + codes[further - k - 1]
            before = longer


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class MarkovModel(NamedTuple):
    """Per order: sorted contexts with uses and distinct successors; sorted pairs with counts."""

    contexts: list[np.ndarray]
    uses: list[np.ndarray]
    kinds: list[np.ndarray]
    pairs: list[np.ndarray]
    counts: list[np.ndarray]

    def log_likelihood(self, flat: ta.Flat) -> np.ndarray:
        """Of each text, over all its characters."""
        chance = np.full(len(flat.codes), 1 / ALPHABET)
        for k, places, context, pair in contexts(flat):
            uses, kinds = (_looked_up(self.contexts[k], values[k], context) for values in (self.uses, self.kinds))
            count = _looked_up(self.pairs[k], self.counts[k], pair)
            seen = uses + kinds
            mixed = (count + kinds * chance[places]) / np.maximum(seen, 1)
            chance[places] = np.where(seen > 0, mixed, chance[places])
        total = np.concatenate([[0], np.cumsum(np.log(chance))])
        return total[flat.bounds[1:]] - total[flat.bounds[:-1]]


def _looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def _model(table, side: int) -> MarkovModel:
    fields: list[list[np.ndarray]] = [[], [], [], [], []]
    for k in range(ORDER + 1):
        rows = table[(table["side"] == side) & (table["k"] == k)]
        context = rows["context"].to_numpy(np.int64).view(np.uint64)
        pair = rows["pair"].to_numpy(np.int64).view(np.uint64)
        n = rows["n"].to_numpy(float)
        keys, at = np.unique(context, return_inverse=True)
        order = np.argsort(pair)
        for field, value in zip(
            fields, (keys, np.bincount(at, n, len(keys)), np.bincount(at, minlength=len(keys)).astype(float), pair[order], n[order])
        ):
            field.append(value)
    return MarkovModel(*fields)


class UrlModel(NamedTuple):
    """``grams`` (pair, n0, n1, uses, worth) and ``scores`` (url, side, held, n, score), staged."""

    grams: DataFrame
    scores: DataFrame
    threshold: float

    @property
    def accepted(self) -> MarkovModel:
        return self._local(0)

    @property
    def rejected(self) -> MarkovModel:
        return self._local(1)

    def _local(self, side: int) -> MarkovModel:
        """The counts of a side in the driver, to look into a model of a small table."""
        table = self.grams.filter(F.col(f"n{side}") > 0).select("pair", F.col(f"n{side}").alias("n")).toPandas()
        flat = ta.flatten(table["pair"].tolist())
        table["side"], table["k"], last = side, np.diff(flat.bounds) - 1, flat.bounds[1:] - 1
        hashes = np.zeros((2, len(flat.codes)), np.uint64)
        for _, places, context, pair in contexts(flat):
            hashes[:, places] = context, pair
        table["context"], table["pair"] = hashes[:, last].view(np.int64)
        return _model(table, side)

    def score(self, urls: list[str | None]) -> np.ndarray:
        """Log-likelihood difference per character of any urls, from counts in the driver."""
        flat = ta.flatten(urls)
        difference = self.rejected.log_likelihood(flat) - self.accepted.log_likelihood(flat)
        return difference / np.maximum(np.diff(flat.bounds), 1)


def _top_pairs(flat: ta.Flat) -> np.ndarray:
    """Hash of the gram that ends at each character."""
    result = np.zeros(len(flat.codes), np.uint64)
    for _, places, _, pair in contexts(flat):
        result[places] = pair
    return result


def _gram_texts(flat: ta.Flat, places: np.ndarray) -> pa.Array:
    """The grams that end at some characters, in lower case."""
    lengths = np.minimum(places - flat.bounds[ta.text_of(flat.bounds, places)], ORDER) + 1
    codes = ta.lower_table()[flat.codes[ta.spread(places - lengths + 1, lengths)]].astype(np.uint32)
    widths = np.concatenate([[0], np.cumsum(1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF))])
    offsets = widths[np.concatenate([[0], np.cumsum(lengths)])].astype(np.int32)
    data = codes.tobytes().decode("utf-32-le").encode()
    return pa.StringArray.from_buffers(len(places), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The grams of a batch with their training rows of each side and their occurrences in urls."""
    for batch in batches:
        for part, urls in ta.text_slices(batch, "url"):
            flat = ta.flatten(urls)
            if not len(flat.codes):
                continue
            of_place = ta.text_of(flat.bounds, np.arange(len(flat.codes)))
            _, first, at = np.unique(_top_pairs(flat), return_index=True, return_inverse=True)
            rows = [part.column(c).to_numpy(zero_copy_only=False)[of_place] for c in ("n0", "n1")]
            sums = [np.bincount(at, n, len(first)).astype(np.int64) for n in (*rows, np.ones(len(at)))]
            yield pa.RecordBatch.from_arrays(
                [_gram_texts(flat, first), *map(pa.array, sums)], names=["gram", "n0", "n1", "uses"]
            )


def _with_chances(grams: DataFrame) -> DataFrame:
    """``grams`` and all their endings as ``pair``, with ``worth``: the log ratio of the chances.

    An ending of a gram is a pair of a shorter context and the same character. Groups of the
    window and matches of the joins have as many rows as the alphabet has characters at most.
    """
    ending = grams.select("*", F.explode(F.sequence(F.lit(1), F.length("gram"))).alias("m")).select(
        F.expr("right(gram, m)").alias("pair"), "n0", "n1", F.expr("if(m = length(gram), uses, 0L)").alias("uses")
    )
    pairs = ending.groupBy("pair").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "uses")])
    pairs = pairs.withColumn("context", F.expr("left(pair, length(pair) - 1)"))
    same = Window.partitionBy("context")
    for side in ("0", "1"):
        kinds = F.sum((F.col("n" + side) > 0).cast("long")).over(same)
        pairs = pairs.withColumns({"kinds" + side: kinds, "seen" + side: kinds + F.sum("n" + side).over(same)})
    pairs = stage(pairs.drop("context"), "pairs")
    levels: list[DataFrame] = []
    for length in range(1, ORDER + 2):
        level = pairs.filter(F.length("pair") == length)
        if levels:
            shorter = levels[-1].select(F.col("pair").alias("ending"), F.col("chance0").alias("s0"), F.col("chance1").alias("s1"))
            level = level.join(shorter, F.expr(f"right(pair, {length - 1})") == F.col("ending"))
        else:
            level = level.withColumns({"s0": F.lit(1 / ALPHABET), "s1": F.lit(1 / ALPHABET)})
        chances = [
            F.when(F.col("seen" + s) > 0, (F.col("n" + s) + F.col("kinds" + s) * F.col("s" + s)) / F.col("seen" + s))
            .otherwise(F.col("s" + s)).alias("chance" + s)
            for s in ("0", "1")
        ]
        levels.append(stage(level.select("pair", "n0", "n1", "uses", *chances), "chances"))
    table = levels[0]
    for level in levels[1:]:
        table = table.unionByName(level)
    worth = F.round((F.log("chance1") - F.log("chance0")) * UNIT).cast("long")
    return table.select("pair", "n0", "n1", "uses", worth.alias("worth"))


def _scored(urls: DataFrame, grams: DataFrame) -> DataFrame:
    """``urls`` with ``score``; grams too rare for every task to know are joined."""
    total = grams.agg(F.sum("uses")).head()[0] or 0
    often = F.col("uses") > total // KNOWN_GRAMS
    known = grams.filter(often).select("pair", "worth").toPandas()
    flat = ta.flatten(known["pair"].tolist())
    keys = _top_pairs(flat)[flat.bounds[1:] - 1]
    order = np.argsort(keys)
    shared = urls.sparkSession.sparkContext.broadcast((keys[order], known["worth"].to_numpy(np.int64)[order]))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per url the worth of the grams known, and a row for each other one."""
        keys, worths = shared.value
        for batch in batches:
            for part, texts in ta.text_slices(batch, "url"):
                flat = ta.flatten(texts)
                ids = part.column("id").to_numpy()
                pairs = _top_pairs(flat)
                found = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
                held = keys[found] == pairs if len(keys) else np.zeros(len(pairs), bool)
                sums = np.concatenate([[0], np.cumsum(np.where(held, worths[found], 0) if len(keys) else np.zeros(len(pairs), np.int64))])
                places = np.flatnonzero(~held)
                arrays = [
                    pa.array(np.concatenate([ids, ids[ta.text_of(flat.bounds, places)]])),
                    pa.concat_arrays([pa.nulls(len(ids), pa.string()), _gram_texts(flat, places)]),
                    pa.concat_arrays([pa.array(sums[flat.bounds[1:]] - sums[flat.bounds[:-1]]), pa.nulls(len(places), pa.int64())]),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "pair", "worth"])

    parts = stage(urls.select("id", "url").mapInArrow(look_up, "id long, pair string, worth long"), "worths")
    rare = grams.filter(~often & (F.col("uses") > 0)).select("pair", F.col("worth").alias("found"))
    joined = parts.filter("pair IS NOT NULL").select("id", "pair").join(rare, "pair").select("id", F.col("found").alias("worth"))
    sums = parts.filter("pair IS NULL").select("id", "worth").unionByName(joined).groupBy("id").agg(F.sum("worth").alias("worth"))
    return urls.join(sums, "id").withColumn("score", F.col("worth") / UNIT / F.length("url")).drop("id", "worth")


def fit(rows: DataFrame, url: str = "url", verdict: str = "verdict") -> UrlModel | None:
    """Fit on all urls with a verdict and score all urls; None where a side has no url.

    The driver receives the most frequent grams and a histogram of scores only. A url with both
    verdicts counts as blocked.
    """
    side = (F.col(verdict) == "block").cast("int")
    named = rows.select(F.col(url).alias("url"), side.alias("side")).filter("url <> ''")
    distinct = named.groupBy("url").agg(F.max("side").alias("side"), F.count("*").alias("n"))
    place = F.pmod(F.xxhash64("url"), F.lit(1 << 40))
    held = F.floor(place / (1 << 20)) % CALIBRATION_SHARE == 0
    urls = stage(distinct.select(F.monotonically_increasing_id().alias("id"), "*", held.alias("held")), "urls")
    if urls.filter("side IS NOT NULL").agg(F.countDistinct("side")).head()[0] < 2:
        return None
    training = [F.when((F.col("side") == s) & ~F.col("held"), F.col("n")).otherwise(0).alias(f"n{s}") for s in (0, 1)]
    counted = urls.select("url", *training).mapInArrow(_count, "gram string, n0 long, n1 long, uses long")
    grams = _with_chances(counted.groupBy("gram").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "uses")]))
    scores = stage(_scored(urls, grams), "scores")
    # A class holds the scores above its lower end up to its upper one.
    found = scores.filter("held AND side IS NOT NULL").groupBy("side", F.ceil(F.col("score") / SCORE_STEP).alias("class"))
    table = found.agg(F.sum("n").alias("n")).toPandas()
    middles = (table["class"].to_numpy(float) - 0.5) * SCORE_STEP
    threshold = calibrate(middles, table["side"].to_numpy(int), table["n"].to_numpy(float), SCORE_STEP)
    return UrlModel(grams, scores, threshold)


def calibrate(scores: np.ndarray, sides: np.ndarray, weights: np.ndarray | None = None, width: float = 0.0) -> float:
    """The threshold with the least mean of both error rates; the one nearest 0 of equal ones.

    With ``width`` the scores are the middles of classes so wide, each standing for ``weights`` rows.
    """
    if len(np.unique(sides)) < 2:
        return 0.0
    weights = np.ones(len(scores)) if weights is None else weights
    values = np.unique(scores)
    ends = [[values[0] - max(1e-9, width / 2)], [values[-1] + width / 2], [0.0]]
    cuts = np.concatenate([ends[0], (values[1:] + values[:-1]) / 2, *ends[1:]])
    shares = []  # of each side, at or below each cut
    for side in (0, 1):
        order = np.argsort(scores[sides == side])
        own, sums = scores[sides == side][order], np.concatenate([[0], np.cumsum(weights[sides == side][order])])
        shares.append(sums[np.searchsorted(own, cuts, "right")] / sums[-1])
    errors = (1 - shares[0]) + shares[1]
    best = cuts[errors <= errors.min() + 1e-12]
    return float(best[np.abs(best).argmin()])


def with_score(df: DataFrame, model: UrlModel, url: str = "url") -> DataFrame:
    """``df`` with ``url_score``, of urls the model was given; 0 for null and empty ones."""
    scores = model.scores.select(F.col("url").alias("__url"), F.col("score").alias("__score"))
    joined = df.join(scores, F.col(url) == F.col("__url"), "left")
    return joined.withColumn("url_score", F.coalesce("__score", F.lit(0.0))).drop("__url", "__score")


def judge(df: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule``, ``verdict`` and ``url_score``."""
    kept = [c for c in df.columns if c not in ("host", "path", "rule", "verdict", "url_score")]
    plain = df.select(*[F.col(f"`{c}`") for c in kept], host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    name, verdict = deciding(F.col("host"), F.col("path"), rules)
    ruled = plain.withColumns({"rule": name, "verdict": verdict})
    model = fit(ruled, url)
    if model is None:
        scored, blocked = ruled.withColumn("url_score", F.lit(0.0)), F.lit(False)
    else:
        scored = with_score(ruled, model, url)
        blocked = F.col("url_score") > model.threshold
    empty = F.coalesce(F.col(url), F.lit("")) == ""
    learned = F.when(empty | blocked, "block").otherwise("allow")
    return scored.withColumn("verdict", F.coalesce("verdict", learned))
