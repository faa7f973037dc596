"""What five filters remove alone, together and in every order: a removal game and its potential.

The game gives each of the 32 coalitions of filters the documents that at least one of its members
removes. Its Hart-Mas-Colell potential follows by recursion over coalitions,

    P(S) = (v(S) + sum of P(S without i) over i in S) / |S|,     P(empty) = 0,

and the Shapley value of a filter is P(all) - P(all without it). 120 P is always a whole number, so
nothing is rounded. What a filter removes as a step of an order is v(it and all before) - v(all
before): differences of coalitions supply every step of all 120 orders, with no further pass.

Texts are judged in one pass that leaves a digest, four flags, key and part of each document. Equal
digests tell copies: each digest gets its least key, and the row that has it is found by a join on
digest and key, so a text with a third of all rows is no hot key. Copies, labels and counts are
combined before every shuffle; the 32 counts of a part are the only rows that reach one task.

Filters: A fewer than 200 words, B fewer than half of the words distinct, C more than 2 % capital
letters A-Z, D any of ``#$%&*|``, E the text of a smaller key, whether or not that row is removed.

Results for edge cases: a null text is the empty text; a null part is the part ``''``. A row without
a key has no smaller one, so E never removes it, and it makes no other row a copy; rows with one key
and one text are not copies of each other. Of several labels of a key, a 1 counts; labels without a
key or with other values count nothing. A very long text is judged in pieces, its distinct words by
64-bit hashes. A repeated row counts as often as it stands there. No rows give no rows. Only the
columns named by the arguments are read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import text_arrays as ta
from tablewright.sizing import broadcast_if_small
from tablewright.staging import stage

FILTERS = "ABCDE"
LEAST_WORDS = 200
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SIGNS = b"#$%&*|"

_ALL = (1 << len(FILTERS)) - 1
_ORDERS = ["".join(order) for order in itertools.permutations(FILTERS)]
_WEIGHTS = ("n", "good", "toxic")


# --- judging texts ----------------------------------------------------------------------


def word_counts(text: bytes) -> tuple[int, int]:
    """Words and distinct words."""
    if len(text) <= ta.PIECE_BYTES:
        words = text.split()
        return len(words), len(set(words))
    total, known = 0, np.zeros(0, np.uint64)
    for words in ta.word_lists(text):
        total += len(words)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        known = np.union1d(known, hashes)
    return total, len(known)


def own_failures(text: bytes, code_points: int) -> int:
    """Bits 0 to 3 for the filters A to D, which need no other document."""
    words, distinct = word_counts(text)
    capitals = len(text) - len(text.translate(None, CAPITALS))
    signs = len(text) - len(text.translate(None, SIGNS))
    failed = (words < LEAST_WORDS, 100 * distinct < 50 * words, 100 * capitals > 2 * code_points, signs > 0)
    return sum(bit << i for i, bit in enumerate(failed))


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, _ in ta.record_slices(batch, "text"):
            texts = pc.fill_null(rows.column("text"), "")
            lengths = pc.utf8_length(texts).to_pylist()
            masks, digests = [], []
            for i, length in enumerate(lengths):
                text = texts[i].as_buffer().to_pybytes()
                masks.append(own_failures(text, length))
                digests.append(hashlib.blake2b(text, digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [rows.column("key"), rows.column("part"), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())],
                names=["key", "part", "own", "digest"],
            )


def judged(df: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """Staged rows ``digest, key, part, own, n``: equal rows are one with their number."""
    rows = df.select(
        F.col(f"`{key}`").alias("key"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.col(f"`{text}`").alias("text"),
    )
    kind = rows.schema["key"].dataType.simpleString()
    found = rows.mapInArrow(_judge, f"key {kind}, part string, own int, digest binary")
    return stage(found.groupBy("digest", "key", "part", "own").agg(F.count("*").alias("n")), "judged")


# --- counts of failures -----------------------------------------------------------------


def failure_counts(
    df: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    part: str = "source",
    label_key: str = "doc_id",
) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by the set of filters they fail, bit i for filter i.

    ``labels`` has the columns ``quality`` and ``toxic`` beside its key.
    """
    rows = judged(df, key, text, part)
    least = rows.groupBy("digest").agg(F.min("key").alias("key"))
    firsts = stage(least.filter("key IS NOT NULL").withColumn("first", F.lit(True)), "firsts")
    rows = rows.join(firsts, ["digest", "key"], "left")
    copy = F.col("key").isNotNull() & F.col("first").isNull()
    mask = F.col("own").bitwiseOR(F.when(copy, 1 << FILTERS.index("E")).otherwise(0))
    rows = rows.select("key", "part", "n", mask.alias("mask"))

    def marked(name: str):
        return F.max((F.col(name) == 1).cast("int")).alias(name)

    marks = labels.select(F.col(f"`{label_key}`").alias("key"), "quality", "toxic").filter("key IS NOT NULL")
    marks = marks.groupBy("key").agg(marked("quality"), marked("toxic"))
    marks = broadcast_if_small(stage(marks.filter("quality = 1 OR toxic = 1"), "marks"))
    rows = rows.join(marks, "key", "left")
    sums = [F.sum("n").alias("n")]
    for mark, name in (("quality", "good"), ("toxic", "toxic")):
        sums.append(F.sum(F.when(F.col(mark) == 1, F.col("n")).otherwise(0)).alias(name))
    return rows.groupBy("part", "mask").agg(*sums)


# --- the game ---------------------------------------------------------------------------


def coalition_values(counts: np.ndarray) -> np.ndarray:
    """v(S) of every coalition S, from the number of documents per set of failures (last axis)."""
    sets = np.arange(_ALL + 1)
    meets = (sets[:, None] & sets[None, :]) != 0
    return counts @ meets.astype(np.int64)


def potentials(values: np.ndarray) -> np.ndarray:
    """120 times the potential of every coalition (last axis), by recursion over its members."""
    scaled = np.zeros_like(values)
    for coalition in sorted(range(1, _ALL + 1), key=int.bit_count):
        members = [bit for bit in range(len(FILTERS)) if coalition >> bit & 1]
        below = sum(scaled[..., coalition ^ (1 << bit)] for bit in members)
        scaled[..., coalition] = (120 * values[..., coalition] + below) // len(members)
    return scaled


def _steps() -> tuple[np.ndarray, np.ndarray]:
    """Filter and coalition before it, of each step of each order."""
    bits = np.array([[FILTERS.index(letter) for letter in order] for order in _ORDERS])
    before = np.cumsum(1 << bits, axis=1) - (1 << bits)
    return bits.reshape(-1), before.reshape(-1)


def audited(counts: np.ndarray) -> dict[str, np.ndarray]:
    """Columns of the 600 steps of one part; ``counts`` is weights x sets of failures."""
    bits, before = _steps()
    after, alone, without = before | (1 << bits), 1 << bits, _ALL ^ (1 << bits)
    documents, good, toxic = coalition_values(counts)
    scaled = potentials(documents)
    removed = documents[after] - documents[before]
    return {
        "kept": counts[0].sum() - documents[after],
        "removed": removed,
        "redundant": documents[alone] - removed,
        "unique_fails": documents[_ALL] - documents[without],
        "good_lost": good[after] - good[before],
        "toxic_lost": toxic[after] - toxic[before],
        "shapley": scaled[_ALL] - scaled[without],
    }


def _audit_parts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    orders = np.repeat(_ORDERS, len(FILTERS))
    steps = np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(_ORDERS))
    for frame in frames:
        for part, sets in zip(frame["part"], frame["sets"]):
            counts = np.zeros((len(_WEIGHTS), _ALL + 1), np.int64)
            for one in sets:
                counts[:, one["mask"]] = [one[name] for name in _WEIGHTS]
            yield pd.DataFrame({"part": part, "filter_order": orders, "step": steps, **audited(counts)})


def audit(
    df: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    part: str = "source",
    label_key: str = "doc_id",
) -> DataFrame:
    """A row per part, order of the five filters and step, with what the step does there.

    ``shapley`` is the Shapley value of the step's filter times 120, the sum over all orders.
    """
    counts = failure_counts(df, labels, key, text, part, label_key)
    # At most 32 sets of failures a part.
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", *_WEIGHTS)).alias("sets"))
    schema = (
        "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
        "good_lost long, toxic_lost long, shapley long"
    )
    return parts.mapInPandas(_audit_parts, schema)


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
  FROM d LEFT JOIN l USING (doc_id)),
counts AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, mask),
letters(letter, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
steps AS (
  SELECT p.letter || q.letter || r.letter || s.letter || u.letter AS filter_order, k AS step,
         [p.b, q.b, r.b, s.b, u.b][k] AS b, CAST(list_sum([0, p.b, q.b, r.b, s.b, u.b][1:k]) AS INTEGER) AS earlier
  FROM letters p, letters q, letters r, letters s, letters u, (SELECT unnest(range(1, 6)) AS k)
  WHERE p.b + q.b + r.b + s.b + u.b = 31 AND (p.b | q.b | r.b | s.b | u.b) = 31),
told AS (
  SELECT part, filter_order, step, b,
         sum(CASE WHEN mask & (earlier | b) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & earlier = 0 AND mask & b <> 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & earlier <> 0 AND mask & b <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = b THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & earlier = 0 AND mask & b <> 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & earlier = 0 AND mask & b <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM counts, steps GROUP BY part, filter_order, step, b)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, b) AS BIGINT) AS shapley
FROM told
"""
