"""Near-duplicate documents: MinHash banding, verification, connected components.

The set of a document holds its distinct shingles of five words. Documents whose sets are equal
collapse into their least document first. The rest get ``BANDS * ROWS`` minima of universal
hashes, kept to 16 bits each; documents that agree in a whole band share a bucket. At a
similarity of 0.75 two sets share no bucket with probability 5e-6.

Buckets can hold a third of all documents, so their pairs are never listed. Every document is
first compared with one document, the least it shares a bucket with, and the members of buckets
that do not lie in one component after that with a pivot of the bucket. What is left are buckets
whose members were not linked with either: different texts with a common part, and near copies
that differ too much. Their links are found exactly by prefix filtering: the shingles of a set
are put in order from rare to frequent, and two similar sets must share one of their rarest, at
places that leave enough shingles behind it. What keeps near copies apart is text of their own,
so their rare shingles seldom meet. So each pair that shares a bucket is compared, known to be
connected, or proven too different: no link is lost, and a group of copies costs work in
proportion to its size. A comparison is first estimated from the signatures, and confirmed on the
full sets.

Results for edge cases: null, empty and blank texts have an empty set and are linked with
nothing; documents with fewer than five words have one shingle; equal texts are linked; a null
id has a null component and is kept; rows with one id are one document, all kept or all dropped;
an empty table gives an empty one. Only the key and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import text_arrays as ta
from tablewright.llm.components import components
from tablewright.staging import stage

WORDS = 5
PERCENT = 75
BANDS = 32
ROWS = 4
SEED = 20_260
# Estimated agreement below this many standard deviations under the limit is not verified.
DEVIATIONS = 5.3
# Documents with one shingle that go to a task together.
SPLIT_ROWS = 2048

_MINHASH_SHINGLES = 1 << 15


def word_hashes(flat: ta.Flat) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, A-Z in lower case, and the bounds of each text in that list."""
    codes = flat.codes
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
    starts, ends = ta.runs(~blank, flat.bounds)
    lengths = ends - starts
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(flat.bounds), np.int64)
    places = ta.spread(starts, lengths)
    lowered = codes[places].astype(np.uint64)
    lowered += np.uint64(32) * ((lowered >= 65) & (lowered <= 90)).astype(np.uint64)
    offsets = np.cumsum(lengths) - lengths
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(lengths.max()), 0x9E3779B97F4A7C15, np.uint64))
        weighted = (lowered + np.uint64(1)) * powers[np.arange(len(places)) - np.repeat(offsets, lengths)]
        hashes = _mixed(np.add.reduceat(weighted, offsets) + lengths.astype(np.uint64))
    return hashes, np.searchsorted(starts, flat.bounds)


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, ascending within each, and the bounds of each text."""
    hashes, bounds = word_hashes(ta.flatten(texts))
    counts = np.diff(bounds)
    full = np.maximum(counts - size + 1, 0)
    starts = ta.spread(bounds[:-1], full)
    with np.errstate(over="ignore"):
        shingles = np.zeros(len(starts), np.uint64)
        for i in range(size):
            shingles = _mixed(shingles + hashes[starts + i] * np.uint64(2 * i + 3))
        # Shorter texts: all their words as one.
        short = np.flatnonzero((counts > 0) & (counts < size))
        whole = np.zeros(len(short), np.uint64)
        for i in range(size - 1):
            has = counts[short] > i
            whole[has] = _mixed(whole[has] + hashes[bounds[:-1][short[has]] + i] * np.uint64(2 * i + 3))
        whole = _mixed(whole ^ counts[short].astype(np.uint64))
    text = np.concatenate([np.repeat(np.arange(len(texts)), full), short])
    values = np.concatenate([shingles, whole])
    order = np.lexsort((values, text))
    text, values = text[order], values[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    text, values = text[new], values[new]
    return values, np.searchsorted(text, np.arange(len(texts) + 1))


def coefficients(count: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    drawn = np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 63, (2, count), np.uint64)
    return drawn[0] * np.uint64(2) + np.uint64(1), drawn[1]


def signatures(values: np.ndarray, bounds: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """[text, band] as 64-bit integers of ``rows`` 16-bit lanes; zeros for empty sets."""
    a, b = coefficients(bands * rows)
    lanes = np.zeros((len(bounds) - 1, bands * 4), np.uint16)
    filled = np.flatnonzero(np.diff(bounds))
    sizes = np.diff(bounds)[filled]
    for low, high in ta.slices(sizes, _MINHASH_SHINGLES):
        some = filled[low:high]
        first = bounds[some[0]]
        block = values[first : bounds[some[-1] + 1]]
        offsets = bounds[some] - first
        with np.errstate(over="ignore"):
            for k in range(bands * rows):
                least = _mixed(np.minimum.reduceat(block * a[k] + b[k], offsets))
                lanes[some, k // rows * 4 + k % rows] = least >> np.uint64(48)
    return lanes.view(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for some, _ in ta.record_slices(batch):
            values, bounds = shingle_sets(some.column("text").to_pylist())
            sketch = signatures(values, bounds)
            # Sum and mixed sum of the hashes identify the set.
            with np.errstate(over="ignore"):
                sums = [np.concatenate([[np.uint64(0)], np.cumsum(x)]) for x in (values, _mixed(values ^ np.uint64(SEED)))]
                marks = [(one[bounds[1:]] - one[bounds[:-1]]).view(np.int64) for one in sums]
            lists = pa.ListArray.from_arrays(
                np.arange(0, sketch.size + 1, sketch.shape[1], dtype=np.int32), pa.array(sketch.reshape(-1))
            )
            yield pa.RecordBatch.from_arrays(
                [some.column("doc_id"), pa.array(np.diff(bounds)), pa.array(marks[0]), pa.array(marks[1]), lists],
                names=["doc_id", "n", "h1", "h2", "sketch"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for some, _ in ta.record_slices(batch):
            values, bounds = shingle_sets(some.column("text").to_pylist())
            sketch = signatures(values, bounds)
            steps = np.arange(0, sketch.size + 1, sketch.shape[1], dtype=np.int32)
            arrays = [
                some.column("doc_id"),
                pa.ListArray.from_arrays(pa.array(steps), pa.array(sketch.reshape(-1))),
                pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values.view(np.int64))),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "sketch", "shingles"])


def _agreement_of():
    @F.arrow_udf("int")
    def agreement(left: pa.Array, right: pa.Array) -> pa.Array:
        """Minima that two signatures share."""
        a, b = (x.flatten().to_numpy().view(np.uint16).reshape(len(x), -1) for x in (left, right))
        lanes = np.arange(a.shape[1]) % 4 < ROWS if len(a) else []
        return pa.array((a == b)[:, lanes].sum(1), pa.int32())

    return agreement


def _least_agreement(percent: int, minima: int) -> int:
    limit = percent / 100
    return int(minima * limit - DEVIATIONS * (minima * limit * (1 - limit)) ** 0.5)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges among ``pairs``: estimated from the signatures, then confirmed on the full sets.

    Both joins are left to Spark, so a document that is in very many pairs is split over tasks
    by adaptive execution. Members, which are in few pairs, are joined last.
    """
    both = pairs
    for side in ("a", "b"):
        renamed = sets.select(F.col("doc_id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("sketch", "shingles")])
        both = both.join(renamed, side)
    least = _least_agreement(percent, BANDS * ROWS)
    likely = both.filter(_agreement_of()("sketch_a", "sketch_b") >= least)
    common = F.size(F.array_intersect("shingles_a", "shingles_b")).cast("long")
    total = F.size("shingles_a") + F.size("shingles_b")
    # 100 * |A and B| >= percent * |A or B|
    sized = likely.select("a", "b", common.alias("common"), total.alias("total"))
    linked = sized.filter(100 * F.col("common") >= percent * (F.col("total") - F.col("common")))
    return linked.select(F.col("b").alias("u"), F.col("a").alias("v"))


def _open_members(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members of the buckets that lie in several components, with a pivot for each bucket.

    The pivot is the member of least hash, so a document tends to be the pivot of all its buckets
    in one wave.
    """
    if labels is None:
        rows = members.withColumn("comp", F.col("rep"))
    else:
        rows = members.join(labels, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    ends = rows.groupBy("band", "value").agg(
        F.min("comp").alias("low"),
        F.max("comp").alias("high"),
        F.min_by(F.struct("rep", "comp", "n"), F.xxhash64("rep")).alias("p"),
    )
    return rows.join(ends.filter("low < high").drop("low", "high"), ["band", "value"])


def _pivot_pairs(open_rows: DataFrame, percent: int) -> DataFrame:
    """The pivot of each open bucket with its documents of other components."""
    similar_size = 100 * F.least("n", "p.n") >= percent * F.greatest("n", "p.n")
    rows = open_rows.filter((F.col("comp") != F.col("p.comp")) & similar_size)
    return rows.select(F.least("rep", "p.rep").alias("a"), F.greatest("rep", "p.rep").alias("b")).distinct()


def _prefix_pairs(open_rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of documents of open buckets, in different components, that can be similar.

    The documents with a frequent shingle are dealt to several tasks, and those among them that
    are outside its least component, one of which is in every pair, are sent to each.
    """
    reps = open_rows.select(F.col("rep").alias("doc_id"), "comp").distinct()
    each = sets.join(reps, "doc_id").select(
        F.col("doc_id").alias("rep"), "comp", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle")
    )
    known = each.groupBy("shingle").agg(F.count("*").alias("df"), F.min("comp").alias("low"), F.max("comp").alias("high"))
    # A list is no longer than the set of its document.
    ordered = F.sort_array(F.collect_list(F.struct("df", "shingle", "low", "high")))
    ranked = each.join(known, "shingle").groupBy("rep", "comp", "n").agg(ordered.alias("ordered"))
    length = F.col("n") - F.ceil(F.col("n") * percent / 100).cast("int") + 1
    prefix = ranked.select("rep", "comp", "n", F.posexplode(F.slice("ordered", F.lit(1), length)).alias("at", "x"))
    # A shared shingle at place ``at`` of the order leaves at most n - at common ones.
    prefix = prefix.select("rep", "comp", "n", (F.col("n") - F.col("at")).alias("rest"), "x.*").filter("low < high")
    blocks = F.ceil(F.col("df") / SPLIT_ROWS).cast("int")
    left = prefix.withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
    right = prefix.filter("comp <> low").select(
        "shingle",
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"),
        *[F.col(c).alias(f"{c}2") for c in ("rep", "comp", "n", "rest")],
    )
    common = F.least("rest", "rest2")
    possible = 100 * common >= percent * (F.col("n") + F.col("n2") - common)
    paired = left.join(right, ["shingle", "block"]).filter("comp <> comp2").filter(possible)
    return paired.select(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b")).distinct()


def near_duplicates(
    documents: DataFrame, text: str = "text", key: str = "doc_id", percent: int = PERCENT
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row.

    ``component_id`` is the least id among all documents reachable by links of similarity
    ``percent / 100`` or more; ``kept`` marks the document that has it.
    """
    named = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketched = named.mapInArrow(_sketch, "doc_id long, n long, h1 long, h2 long, sketch array<long>")
    sketched = stage(sketched, "sketches")
    # Equal sets collapse into their least document.
    usable = sketched.filter("n > 0 AND doc_id IS NOT NULL")
    copies = usable.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("rep"))
    copies = stage(copies, "copies")
    reps = usable.join(copies.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    banded = reps.select(
        F.col("doc_id").alias("rep"), F.col("n").cast("int").alias("n"), F.posexplode("sketch").alias("band", "value")
    )
    centers = banded.groupBy("band", "value").agg(F.min("rep").alias("center"), F.count("*").alias("size"))
    members = banded.join(centers.filter("size > 1").drop("size"), ["band", "value"])
    members = stage(members, "members")
    labels = _linked(named, members, percent)

    found = sketched.join(copies, ["h1", "h2", "n"], "left").drop("sketch", "h1", "h2")
    if labels is not None:
        found = found.join(labels, "rep", "left")
    else:
        found = found.withColumn("comp", F.col("rep"))
    component = F.coalesce("comp", "rep", "doc_id")
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _linked(named: DataFrame, members: DataFrame, percent: int) -> DataFrame | None:
    """``(rep, comp)`` of the documents that are linked with a lesser one."""
    candidates = members.select(F.col("rep").alias("doc_id")).distinct()
    sets = named.join(candidates, "doc_id", "left_semi").mapInArrow(
        _sets, "doc_id long, sketch array<long>, shingles array<long>"
    )
    sets = stage(sets, "sets")
    near = members.filter("rep <> center").groupBy("rep").agg(F.min("center").alias("a"))
    labels = _merged(None, _verified(near.select("a", F.col("rep").alias("b")), sets, percent))
    members = members.drop("center")
    for pairs_of in (lambda rows: _pivot_pairs(rows, percent), lambda rows: _prefix_pairs(rows, sets, percent)):
        open_rows = stage(_open_members(members, labels), "open")
        if open_rows.isEmpty():
            break
        labels = _merged(labels, _verified(pairs_of(open_rows), sets, percent))
        # The pivot has met all of its bucket, and a closed bucket stays closed.
        members = open_rows.filter("rep <> p.rep").drop("comp", "p")
    return labels


def _merged(labels: DataFrame | None, edges: DataFrame) -> DataFrame | None:
    """Labels after further edges: components of components, so each wave sees few edges."""
    edges = stage(edges, "links")
    if edges.isEmpty():
        return labels
    if labels is None:
        return components(edges).select(F.col("node").alias("rep"), F.col("component").alias("comp"))
    for side in ("u", "v"):
        own = labels.select(F.col("rep").alias(side), F.col("comp").alias(f"{side}_comp"))
        edges = edges.join(own, side, "left").withColumn(side, F.coalesce(f"{side}_comp", side)).drop(f"{side}_comp")
    joined = components(edges.select("u", "v"))
    moved = joined.select(F.col("node").alias("comp"), F.col("component").alias("root"))
    kept = labels.join(moved, "comp", "left").select("rep", F.coalesce("root", "comp").alias("comp"))
    # Roots of old components are not listed in labels themselves.
    roots = joined.select(F.col("node").alias("rep"), F.col("component").alias("comp"))
    return stage(kept.unionByName(roots.join(labels.select("rep"), "rep", "left_anti")), "labels")
