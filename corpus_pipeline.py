"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents its predecessor kept and calls one operator; its result is written
as Parquet and read again. All but the last return the columns of ``documents``; the last returns
the place of every piece of every document in the packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import decontamination, language, near_duplicates, packing, pii
from tablewright.sizing import broadcast_if_small
from tablewright.staging import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Rows of an Arrow batch between Spark and Python, half a MB of text; 10,000 rows by default would
# take 40 MB and more for each direction of each task, in the JVM and in the worker, and workers take
# some 100 bytes of arrays a character of what they have at once.
BATCH_ROWS, DEFAULT_BATCH_ROWS = "250", "10000"
# Pieces of text a worker keeps the ids of, some 200 bytes each; it has run other stages before.
MEMO_PIECES = 100_000
TOKENIZER = "word_bpe_49k.json"
END_ID = 1


def _in_small_batches(step: Callable[[SparkSession, DataFrame, str], DataFrame]):
    """The stage with small Arrow batches, unless the session names a size of its own."""

    @wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        key = "spark.sql.execution.arrow.maxRecordsPerBatch"
        if spark.conf.get(key) == DEFAULT_BATCH_ROWS:
            spark.conf.set(key, BATCH_ROWS)
        return step(spark, docs, sf_dir)

    return run_step


@_in_small_batches
def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter, whatever languages share them; a missing ``lang`` is filled in."""
    model = language.fit(docs.filter(~language.held_out()))
    found = language.identify(docs, model)
    # Without any labelled row every text is unknown; those with a letter stay all the same.
    known = (F.col("lang_pred") != language.UNKNOWN) | F.col("text").rlike(r"\p{L}")
    return found.filter(known).withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


@_in_small_batches
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of least id of each group of linked texts, the first written of several.

    Rows are told apart by ``doc_id`` if it can do so, else by their places in a written table.
    Rows without an id come last in their group.
    """
    unclear = docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 OR doc_id IS NULL")
    if unclear.isEmpty():
        judged = near_duplicates.near_duplicates(docs)
        dropped = stage(judged.filter(~F.col("kept")).select("doc_id"), "dropped")
        return docs.join(broadcast_if_small(dropped), "doc_id", "left_anti").select(*COLUMNS)
    rows = stage(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("__row")), "rows")
    judged = near_duplicates.near_duplicates(rows, key="__row").select(F.col("doc_id").alias("__row"), "component_id", "kept")
    judged = stage(judged, "judged")
    shared = stage(judged.filter(~F.col("kept")).select("component_id").distinct(), "shared")
    members = judged.join(broadcast_if_small(shared), "component_id", "left_semi").drop("kept")
    members = stage(members.join(rows.select("__row", "doc_id"), "__row"), "members")
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("__row").alias("row"))
    first = members.groupBy("component_id").agg(F.min(order)["row"].alias("first"))
    # Each group has one row that stays, so the others are found without its group.
    stays = stage(first.select(F.col("first").alias("__row")), "first")
    dropped = stage(members.select("__row").join(broadcast_if_small(stays), "__row", "left_anti"), "dropped")
    return rows.join(broadcast_if_small(dropped), "__row", "left_anti").select(*COLUMNS)


@_in_small_batches
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    found = decontamination.with_leaks(docs, benchmark)
    return found.filter(F.size("leaks") == 0).select(*COLUMNS)


@_in_small_batches
def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the kind of data in place of personal data."""
    redacted = pii.redact(docs, pii.fit(docs))
    return redacted.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(*COLUMNS)


@_in_small_batches
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and offset."""
    placed = packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), END_ID, MEMO_PIECES)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", keep_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("pii", redact_personal_data),
    ("packing", pack),
]

# Language, signatures, alignment, tagging and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
