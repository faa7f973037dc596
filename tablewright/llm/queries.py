"""Queries over the supplied tables, one for each operator, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import (
    attribution,
    decontamination,
    filter_audit,
    language,
    near_duplicates,
    packing,
    pii,
    quality,
    substrings,
    token_files,
    toxicity,
    url_filter,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    documents = table(spark, folder, "documents")
    model = language.fit(documents.filter(~language.held_out() & F.col("doc_id").isNotNull()))
    found = language.identify(documents.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        language.held_out().alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
    )


WORDS = "word_bpe_49k.json"
BYTES = "byte_bpe_50k.json"


@query
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document packed into sequences of at most 4096 tokens."""
    documents = table(spark, folder, "documents")
    placed = packing.pack_documents(documents, public_tokenizers.path(WORDS), end_id=1)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op8_attribution(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every line of every document, encoded as whole texts."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    counted = attribution.attribute(documents, public_tokenizers.path(BYTES))
    # Every text has a line; the outer form keeps Spark from encoding again to test for one.
    return counted.select("doc_id", F.explode_outer("token_counts").alias("c")).select("doc_id", "c.*")


@query
def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document, read back from bit-packed files."""
    documents = table(spark, folder, "documents")
    read = token_files.round_trip(documents, public_tokenizers.path(BYTES), end_id=0)
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items found in documents, with their places."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = decontamination.with_leaks(documents, table(spark, folder, "benchmark"))
    # The outer form keeps Spark from searching each text again to test for an entry.
    entries = found.select("doc_id", F.explode_outer("leaks").alias("leak")).select("doc_id", "leak.*")
    return entries.filter("start IS NOT NULL")


@query
def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents linked by a similarity of 0.75 or more."""
    return near_duplicates.near_duplicates(table(spark, folder, "documents"))


@query
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learned from labelled rows that are not held out."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    learned = toxicity.labelled_sample(documents.filter(~language.held_out()), labels.filter(~language.held_out()))
    scored = toxicity.with_score(documents, toxicity.fit(learned))
    return scored.select(
        "doc_id",
        language.held_out().alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.7).cast("int").alias("predicted"),
    )


@query
def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Base measures and the line-frequency verdict of every document."""
    return quality.judged(table(spark, folder, "documents"))


ORACLE["op7_quality"] = quality.ORACLE_SQL


URL_RULES = [
    url_filter.rule("allow", "com/"),
    url_filter.rule("block", "example.com/en/"),
    url_filter.rule("allow", "www.example.com/en/"),
    url_filter.rule("block", "net/es/"),
    url_filter.rule("block", "net/fr/"),
]


@query
def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on the url of every page."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "url_score")


@query
def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document: counts and digest of the patterns, and all spans."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = pii.with_spans(documents, pii.fit(documents))
    base = F.filter("pii", lambda span: span["base"])
    counts = [pii.count_of(base, kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(pii.joined(base), 256).alias("base_sha256"), pii.joined(F.col("pii")).alias("spans")
    )


@query
def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """What five filters do to every source, in all orders."""
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


ORACLE["op11_filter_audit"] = filter_audit.ORACLE_SQL


@query
def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Leading whitened components of every embedding."""
    embeddings = table(spark, folder, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(embeddings)
    found = whitening.with_whitened(embeddings, model)
    explained = F.lit(model.explained if model else []).cast("array<double>")
    # The outer form keeps Spark from evaluating the function again to test for an entry.
    rows = found.select("vec_id", "whitening.deviation", F.posexplode_outer("whitening.whitened").alias("at", "whitened"))
    return rows.filter("at IS NOT NULL").select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n if model else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )


@query
def op13_substrings(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that stay when passages of 20 words are kept once."""
    found = substrings.deduplicate(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")
