import numpy as np
import pytest

from tablewright.llm import language
from tablewright.llm import text_arrays as ta

EN = "the house and the street of that town with a garden which was there for the people"
DE = "der Garten und die Straße nicht mit einer Stadt welche für das Haus auch schön ist"
RU = "дом и улица в городе где живут люди и сад который был там для них"


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, text, lang) for i, (text, lang) in enumerate([(EN, "en"), (DE, "de"), (RU, "ru")] * 20)]
    return language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def label(spark, model, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return sorted(language.identify(df, model).collect())


def test_runs_stay_inside_texts():
    flat = ta.flatten(["ab c", None, "", "de"])
    starts, ends = ta.runs(ta.letter_table()[flat.codes], flat.bounds)
    assert list(zip(starts, ends)) == [(0, 2), (3, 4), (4, 6)]


def test_best_path_is_the_best_of_all_paths():
    rng = np.random.default_rng(1)
    for _ in range(30):
        n, k = rng.integers(1, 7), rng.integers(2, 4)
        scores = rng.normal(0, 2, (n, k)).astype(np.float32)
        costs = rng.choice([0.0, 1.0, 2.0], n).astype(np.float32)

        def worth(path):
            changes = sum(costs[t] for t in range(1, n) if path[t] != path[t - 1])
            return sum(scores[t, s] for t, s in enumerate(path)) - changes

        best = max(worth(p) for p in np.ndindex(*[k] * n))
        assert worth(language.best_path(scores, costs)) == pytest.approx(best, abs=1e-4)


def test_scripts_narrow_candidates(model):
    scripts = {name: i for i, name in enumerate(language.SCRIPTS)}
    assert list(model.writes[scripts["cyrillic"]]) == [False, False, True]
    assert list(model.writes[scripts["latin"]]) == [True, True, False]


def test_mixed_text_has_spans(spark, model):
    text = f"{EN}. {DE}! {RU}"
    (row,) = label(spark, model, text)
    spans = [(text[s["start"] : s["end"]], s["lang"]) for s in row["lang_spans"]]
    assert spans == [(EN, "en"), (DE, "de"), (RU, "ru")]
    assert 0 < row["lang_score"] < 1


def test_defined_results(spark, model):
    rows = label(spark, model, None, "", "123 !?", "日本語", RU, EN)
    assert [(r["lang_pred"], r["lang_score"]) for r in rows[:3]] == [("und", 0.0)] * 3
    assert rows[0]["lang_spans"] == []
    assert rows[3]["lang_pred"] in model.languages and rows[3]["lang_score"] == 0
    assert [(r["lang_pred"], r["lang_score"]) for r in rows[4:]] == [("ru", 1.0), ("en", 1.0)]


def test_marks_without_a_letter_are_no_language(spark, model):
    """An emoji with its variation selector, a keycap, a lone accent; an accent inside a word."""
    marks = ["\u2764\ufe0f", "1\ufe0f\u20e3 2", "\u0301", "the street \u2764\ufe0f", "Stra\u0308\u00dfe und Garten"]
    rows = label(spark, model, *marks)
    assert [(r["lang_pred"], r["lang_score"]) for r in rows[:3]] == [("und", 0.0)] * 3
    assert [r["lang_pred"] for r in rows[3:]] == ["en", "de"] and rows[3]["lang_score"] == 1.0


def test_odd_and_empty_tables(odd, no_rows):
    model = language.fit(odd)
    found = language.identify(odd, model)
    assert found.count() == odd.count() and set(odd.columns) <= set(found.columns)
    assert language.identify(no_rows, model).count() == 0
    nothing = language.fit(no_rows)
    assert {r["lang_pred"] for r in language.identify(odd, nothing).collect()} == {"und"}


def test_held_out_accuracy(spark):
    from tablewright.llm import queries

    folder = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    joined = queries.op2_language(spark, folder).join(truth, "doc_id").filter("held_out")
    right = joined.filter("lang = lang_pred").count()
    assert joined.count() > 200 and right >= 0.98 * joined.count()
