import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from tablewright.llm import pii, queries
from tablewright.staging import stage
from tests.llm.conftest import SMALL
from tests.llm.test_decontamination import PASSAGE
from tests.llm.test_near_duplicates import brute as groups
from tests.llm.test_tokens import expected_pieces, gapless
from tools.compare import bag, duckdb_views


@pytest.fixture(scope="module", autouse=True)
def short_training():
    held, pii.TRAINING_BATCHES = pii.TRAINING_BATCHES, 120
    yield
    pii.TRAINING_BATCHES = held


def test_names():
    assert set(queries.QUERIES) <= set(entry_points.queries())
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14)) and entry_points.queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_queries_with_sql(spark, name):
    folder = "/root/testdata/sf0.01"
    frame = queries.QUERIES[name](spark, folder)
    result = duckdb_views(folder).execute(queries.ORACLE[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == sorted(frame.columns)
    assert bag(frame.columns, frame.collect()) == bag(names, result.fetchall())


def words(text):
    return " ".join("".join(c if c.isalnum() else " " for c in text.lower()).split())


def test_stages_against_brute_force(spark, small):
    docs, kept = small, {}
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, SMALL), name)
        kept[name] = docs
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
    first = kept["language"].select("doc_id", "text").collect()
    assert len(first) == small.count()  # every document has a language
    expected = {key for key, (_, least) in groups(first).items() if key == least}
    second = kept["near_duplicates"].select("doc_id", "text").collect()
    assert {r["doc_id"] for r in second} == expected
    items = [words(r["text"]) for r in queries.table(spark, SMALL, "benchmark").collect()]
    clean = {r["doc_id"] for r in second if not any(item in words(r["text"]) for item in items)}
    third = kept["decontamination"].select("doc_id", "text").collect()
    assert {r["doc_id"] for r in third} == clean
    fourth = dict(kept["pii"].select("doc_id", "text").collect())
    assert set(fourth) == clean and not any(pii.base_spans(text) for text in fourth.values())
    unchanged = [r for r in third if not re.search("[0-9@]", r["text"])]
    assert all(fourth[r["doc_id"]] == r["text"] for r in unchanged)
    rows = kept["packing"].collect()
    found = {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows}
    assert found == expected_pieces(fourth.items(), "word_bpe_49k.json", 1)
    gapless(rows)


def test_odd_tables(spark, odd, tmp_path):
    extra = [(20, "Look: " + PASSAGE, "en", "z"), (21, "Mail me at jo@example.com please, the house is there", None, "z")]
    extra = spark.createDataFrame(extra, "doc_id long, text string, lang string, source string")
    docs = odd.unionByName(extra, allowMissingColumns=True)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    items = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # Without a letter: 1 to 4; copies: 6, a row of 5; a leak: 20.
    assert sorted((r["doc_id"] is not None, r["doc_id"]) for r in rows if r["piece"] == 0) == [
        (False, None), (True, 5), (True, 7), (True, 8), (True, 9), (True, 21),
    ]


def test_empty_tables(spark, odd, tmp_path):
    odd.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    items = spark.createDataFrame([], "item_id long, text string")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_texts_of_several_languages_and_unlearned_scripts_stay(spark):
    english, german = "the house is in the street and there it is ", "der Mann und die Frau sind nicht in dem Haus "
    french = "le chat est dans la maison et les enfants sont "
    rows = [(10 * i + j, text * 5, lang, "a", 1) for i in range(8) for j, (text, lang) in enumerate([(english, "en"), (german, "de"), (french, "fr")])]
    rows += [(90, "Привет мир и люди", None, "a", 1), (91, f"{english}Привет мир и люди в доме {'мир ' * 30}", None, "a", 1)]
    rows += [(92, english * 4 + german * 4 + french * 4, None, "a", 1), (93, "123 ...", None, "a", 1), (94, None, "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in corpus_pipeline.keep_languages(spark, docs, "").collect()}
    assert kept == {r[0] for r in rows} - {93, 94}
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["doc_id"] for r in corpus_pipeline.keep_languages(spark, unlabelled, "").collect()} == kept


def test_rows_of_one_id_and_rows_without_one_count_by_their_text(spark):
    def text(n):
        return " ".join(f"w{n}x{i}" for i in range(40))

    ids = [(5, 0), (5, 0), (5, 1), (5, 2), (6, 2), (4, 3), (5, 3), (None, 4), (None, 4), (None, 4), (None, 5), (7, 5), (None, 6), (-(2**63), 7), (2**63 - 1, 7)]
    rows = [(key, text(n), "en", "a", 1) for key, n in ids] + [(None, "short", "en", "a", 1)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == corpus_pipeline.COLUMNS
    expected = [(5, 0), (5, 1), (5, 2), (4, 3), (None, 4), (7, 5), (None, 6), (-(2**63), 7)]
    found = [(r["doc_id"], r["text"]) for r in kept.collect() if r["text"] != "short"]
    assert sorted(found, key=str) == sorted([(key, text(n)) for key, n in expected], key=str)
