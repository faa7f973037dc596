"""Quality rules of documents and cross-document line frequency, in DataFrame functions only.

Base measures come from the text itself. The line rule counts, per host, in how many distinct
documents a normalised line (lower case, digit runs as 0, white space as one blank) occurs; lines
above the limit are removed, and a document that loses more than half of its characters is
rejected. The limit is a share of the documents of the host, but at least a fixed number, so the
verdict on a host is the same at every size. Copies of a text under ids of their own are documents
of their own.

Lines are hashed and counted on the map side before the shuffle, so a line of a third of all
documents is one row per task. Only lines above the limit are joined back, by broadcast where
their measured size allows it.

Results for edge cases: null text counts as empty, has no words and fails; a null host is a host
of its own; repeated rows are the same document and get equal results; rows without an id are one
document per text; a very long text is one row throughout; an empty table gives an empty one. Only the key, text and host columns are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.sizing import broadcast_if_small
from tablewright.staging import stage

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
# A line in more documents of its host than this, and in more than this percentage of them, is removed.
MAX_DOCUMENTS = 20
MAX_PERCENT = 1
# A document that loses more than this share of its characters is rejected.
MAX_LOSS = 0.5
LEAST_WORDS = 50


def words(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS), lambda word: word != "")


def word_lines(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def with_measures(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed``.

    ``n_repeat_words`` counts the words inside three-word windows that occur twice or more: the
    windows of a text are sorted by hash, so equal ones are neighbours.
    """
    kept = [c for c in df.columns if c not in _MEASURES]
    whole = F.coalesce(F.col(text), F.lit(""))
    cut = df.select(
        *[F.col(f"`{c}`") for c in kept], words(whole).alias("__words"), word_lines(whole).alias("__lines")
    )
    count = F.size("__words")
    windows = F.transform(
        F.sequence(F.lit(0), F.greatest(count - 3, F.lit(0))),
        lambda i: F.struct(
            F.xxhash64(F.get("__words", i), F.get("__words", i + 1), F.get("__words", i + 2)).alias("h"),
            i.alias("i"),
        ),
    )
    windows = F.when(count >= 3, windows).otherwise(F.array().cast("array<struct<h: bigint, i: int>>"))
    ordered = cut.withColumn("__windows", F.sort_array(windows))

    def repeated(window: Column, at: Column) -> Column:
        beside = F.get("__windows", at - 1)["h"].eqNullSafe(window["h"])
        return beside | F.get("__windows", at + 1)["h"].eqNullSafe(window["h"])

    places = F.sort_array(F.transform(F.filter("__windows", repeated), lambda window: window["i"]))
    placed = ordered.withColumn("__places", places)
    covered = F.transform(
        F.col("__places"), lambda place, at: F.least(F.lit(3), F.coalesce(F.get("__places", at + 1) - place, F.lit(3)))
    )
    measured = placed.select(
        *[F.col(f"`{c}`") for c in kept],
        count.cast("long").alias("n_words"),
        F.length(F.regexp_replace(whole, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(whole) - F.length(F.regexp_replace(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(covered, F.lit(0).cast("long"), lambda total, n: total + n).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured.withColumn("base_failed", failed)


_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def normalised_lines(text: Column) -> Column:
    """All lines of a text in the form in which they are compared."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), "[0-9]+", "0")
    plain = F.lower(F.regexp_replace(plain, r"[\x20\x09\x0B-\x0D]+", " "))
    return F.transform(F.split(plain, "\n"), F.trim)


def _rows(df: DataFrame, key: str, text: str, host: str) -> DataFrame:
    """Document, identity of its row and of itself, host and lines."""
    return df.select(
        F.col(key).alias("doc"),
        F.xxhash64(F.col(text), F.col(host), F.col(key)).alias("row"),
        # Ids as they are and hashes of the texts without one can not be taken for each other.
        F.struct(F.col(key).alias("id"), F.when(F.col(key).isNull(), F.xxhash64(F.col(text))).alias("content")).alias("own"),
        F.coalesce(F.col(host).cast("string"), F.lit("\x00")).alias("host"),
        normalised_lines(F.col(text)).alias("lines"),
    )


def frequent_lines(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    max_documents: int = MAX_DOCUMENTS,
    max_percent: int = MAX_PERCENT,
) -> DataFrame:
    """Staged ``host, line`` (a hash) of lines in more documents of a host than the limits allow."""
    hashed = F.array_distinct(F.transform(F.filter("lines", lambda l: l != ""), lambda l: F.xxhash64(l)))
    rows = _rows(df, key, text, host)
    lines = rows.select("host", "own", F.explode(hashed).alias("line"))
    counted = lines.groupBy("host", "line").agg(F.countDistinct("own").alias("n"))
    sizes = rows.groupBy("host").agg(F.countDistinct("own").alias("documents"))
    above = stage(counted.filter(F.col("n") > max_documents), "repeated-lines")
    sized = above.join(broadcast_if_small(stage(sizes, "hosts")), "host")
    frequent = sized.filter(100 * F.col("n") > max_percent * F.col("documents"))
    return stage(frequent.select("host", "line"), "frequent-lines")


def removed_lines(
    df: DataFrame, frequent: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source"
) -> DataFrame:
    """``doc, row, removed, places``: characters lost per document, and the numbers of its lines."""
    cut = F.transform("lines", lambda line, at: F.struct(at.alias("at"), F.xxhash64(line).alias("line"), F.length(line).alias("chars")))
    lines = _rows(df, key, text, host).select("doc", "row", "host", F.inline(F.filter(cut, lambda x: x["chars"] > 0)))
    hit = lines.join(broadcast_if_small(frequent), ["host", "line"], "left_semi")
    # Repeated rows of one document hold each line more than once.
    once = hit.groupBy("doc", "row", "at").agg(F.max("chars").alias("chars"))
    return once.groupBy("doc", "row").agg(
        F.sum("chars").alias("removed"), F.sort_array(F.collect_list("at")).alias("places")
    )


def _joined(df: DataFrame, removed: DataFrame, key: str, text: str, host: str) -> DataFrame:
    row = F.xxhash64(F.col(text), F.col(host), F.col(key))
    left = df.withColumn("__row", row)
    matched = (left["__row"] == removed["__own_row"]) & left[key].eqNullSafe(removed["__own_doc"])
    return left.join(removed, matched, "left").drop("__own_row", "__own_doc", "__row")


def judged(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    max_documents: int = MAX_DOCUMENTS,
    max_percent: int = MAX_PERCENT,
) -> DataFrame:
    """``df`` without its text, with the measures, ``kept`` and ``removed_chars``."""
    chars = F.aggregate(normalised_lines(F.col(text)), F.lit(0).cast("long"), lambda total, l: total + F.length(l))
    slim = df.select(
        F.col(key).alias("doc_id"),
        F.xxhash64(F.col(text), F.col(host), F.col(key)).alias("__row"),
        F.col(text).alias("text"),
        chars.alias("__chars"),
    )
    measured = with_measures(slim).drop("text")
    frequent = frequent_lines(df, key, text, host, max_documents, max_percent)
    removed = removed_lines(df, frequent, key, text, host).drop("places")
    matched = (measured["__row"] == removed["row"]) & measured["doc_id"].eqNullSafe(removed["doc"])
    lost = F.coalesce("removed", F.lit(0))
    return measured.join(removed, matched, "left").select(
        "doc_id",
        *_MEASURES,
        (~F.col("base_failed") & (lost <= MAX_LOSS * F.col("__chars"))).alias("kept"),
        lost.alias("removed_chars"),
    )


def clean(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    max_documents: int = MAX_DOCUMENTS,
    max_percent: int = MAX_PERCENT,
) -> DataFrame:
    """``df`` with the lines above the limits taken out of the text."""
    frequent = frequent_lines(df, key, text, host, max_documents, max_percent)
    removed = removed_lines(df, frequent, key, text, host).toDF("__own_doc", "__own_row", "__removed", "__places")
    joined = _joined(df, removed, key, text, host)
    lines = F.split(F.col(text), "\n")
    left = F.filter(lines, lambda line, at: ~F.array_contains("__places", at))
    rest = F.when(F.col("__places").isNull(), F.col(text)).otherwise(F.array_join(left, "\n"))
    return joined.withColumn(text, rest).select(*[F.col(f"`{c}`") for c in df.columns])


# A document in SQL: its id, or its text if it has none.
_OWN_SQL = "CASE WHEN doc_id IS NULL THEN 't' || t ELSE 'i' || doc_id END"

ORACLE_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{BLANKS}'), lambda x: x <> '') AS w
  FROM documents),
windows AS (
  SELECT rid, i, w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
places AS (
  SELECT DISTINCT rid, unnest([i, i + 1, i + 2]) AS p
  FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT rid, count(*) AS n_repeat_words FROM places GROUP BY rid),
own_lines AS (
  SELECT rid, len(l) - len(list_distinct(l)) AS n_dup_lines
  FROM (SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d)),
lines AS (
  SELECT rid, doc_id, t, source, trim(unnest(string_split(lower(regexp_replace(regexp_replace(
         t, '[0-9]+', '0', 'g'), '[\x20\x09\x0B-\x0D]+', ' ', 'g')), chr(10)))) AS line
  FROM d),
hosts AS (SELECT source, count(DISTINCT {_OWN_SQL}) AS documents FROM d GROUP BY source),
counted AS (
  SELECT repeated.source, line
  FROM (SELECT source, line, count(DISTINCT {_OWN_SQL}) AS n FROM lines WHERE line <> '' GROUP BY source, line) repeated
  JOIN hosts ON hosts.source IS NOT DISTINCT FROM repeated.source
  WHERE n > {MAX_DOCUMENTS} AND 100 * n > {MAX_PERCENT} * documents),
lost AS (
  SELECT rid, sum(length(lines.line)) AS chars,
         sum(CASE WHEN counted.line IS NULL THEN 0 ELSE length(lines.line) END) AS removed
  FROM lines LEFT JOIN counted
    ON lines.line = counted.line AND lines.source IS NOT DISTINCT FROM counted.source
  GROUP BY rid),
base AS (
  SELECT d.doc_id, d.rid, len(w) AS n_words, length(regexp_replace(t, '{BLANKS}', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '{SYMBOLS}', '', 'g')) AS n_symbols,
         n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d JOIN own_lines USING (rid) LEFT JOIN repeats USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words)
         AND removed <= {MAX_LOSS} * chars AS kept,
       CAST(removed AS BIGINT) AS removed_chars
FROM base JOIN lost USING (rid)
"""
