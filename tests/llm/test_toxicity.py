import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import queries, toxicity


def test_label_model_recovers_voters():
    rng = np.random.default_rng(2)
    label = rng.random(6000) < 0.2
    accuracy = [0.95, 0.9, 0.8, 0.7, 0.65]
    votes = []
    for a in accuracy:
        right = rng.random(6000) < a
        votes.append(np.where(rng.random(6000) < 0.8, np.where(label == right, 1, -1), 0))
    votes += [votes[2].copy(), votes[2].copy()]  # voters that repeat another
    model = toxicity.fit_label_model(np.stack(votes, 1).astype(np.int8), 0.2)
    assert model.accuracies()[:5] == pytest.approx(accuracy, abs=0.08)
    assert model.correlations[2, 5] > 0.9 and model.weights[5] < 0.5 < model.weights[0]
    posterior = model.posterior(np.stack(votes, 1).astype(np.int8))
    assert ((posterior > 0.5) == label).mean() > 0.95


def test_grams_hash_words_and_beginnings():
    _, hashes = toxicity.distinct_grams(["Idiots IDIOT"])
    assert toxicity.gram_of("idiot") in hashes.tolist()
    assert toxicity.gram_of("idiots", 5) in hashes.tolist()
    assert toxicity.gram_of("idiots", 5) == toxicity.gram_of("idiotic", 5) != toxicity.gram_of("idiot")


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    truth = queries.table(spark, folder, "labels").select("doc_id", "toxic")
    rows = queries.op5_toxicity(spark, folder).join(truth, "doc_id").filter("held_out").toPandas()
    toxic, clean = rows[rows.toxic == 1], rows[rows.toxic == 0]
    assert len(toxic) > 100 and toxic.predicted.mean() > 0.8 and clean.predicted.mean() < 0.01
    ranks = np.searchsorted(np.sort(clean.score.to_numpy()), toxic.score.to_numpy())
    assert ranks.mean() / len(clean) > 0.95
    assert rows.score.between(0, 1).all()


def test_odd_and_no_rows(spark, odd, no_rows):
    labelled = spark.createDataFrame([(5, 0, "x"), (6, 0, "x"), (1, 1, "x"), (7, None, "x")], "doc_id long, toxic int, source string")
    model = toxicity.fit(odd.select("doc_id", "text").join(labelled.drop("source"), "doc_id"))
    rows = toxicity.with_score(odd, model).collect()
    scores = {r["doc_id"]: r["toxicity"] for r in rows}
    assert len(rows) == odd.count() and all(0 <= s <= 1 for s in scores.values())
    assert scores[1] == scores[2] and scores[5] == scores[6]
    assert toxicity.with_score(no_rows, model).count() == 0
    nothing = toxicity.fit(no_rows.selectExpr("doc_id", "text", "1 AS toxic"))
    text = spark.createDataFrame([(1, "You are an IDIOT!"), (2, "A nice day")], "doc_id long, text string")
    high, low = [r["toxicity"] for r in sorted(toxicity.with_score(text, nothing).collect())]
    assert high > 0.5 > low


def test_sample_has_one_row_a_key(spark):
    texts = [(1, "b"), (1, "a"), (2, "c"), (3, None), (None, "d"), (4, "e"), (5, "f")]
    marks = [(1, 0), (1, 1), (1, 0), (2, 0), (2, None), (3, 1), (None, 1), (4, 2), (9, 1)]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("toxic", F.lit("x"))
    labels = spark.createDataFrame(marks, "doc_id long, toxic int").withColumn("text", F.lit("y"))
    rows = toxicity.labelled_sample(df, labels).collect()
    assert sorted(map(tuple, rows)) == [(1, "a", 1), (2, "c", 0)]


def test_hot_key_is_not_multiplied(spark):
    df = spark.range(4000).selectExpr("7 AS doc_id", "concat('text ', id) AS text")
    labels = spark.range(4000).selectExpr("7 AS doc_id", "cast(id % 2 AS int) AS toxic")
    assert [tuple(r) for r in toxicity.labelled_sample(df, labels).collect()] == [(7, "text 0", 1)]


def test_sample_is_bounded(spark):
    df = spark.range(5000).selectExpr("id AS doc_id", "'text' AS text")
    labels = spark.range(5000).selectExpr("id AS doc_id", "cast(id % 10 = 0 AS int) AS toxic")
    count = toxicity.labelled_sample(df, labels, max_rows=1000).count()
    assert 850 < count < 1150
    assert toxicity.labelled_sample(df, labels.limit(0)).count() == 0


def test_posterior_by_enumeration():
    """The posterior of every pattern of votes, from the voters' behaviour label by label."""
    rng = np.random.default_rng(3)
    label = rng.random(4000) < 0.3
    rates = [(0.6, 0.1), (0.5, 0.02), (0.3, 0.05)]  # toxic votes on toxic and on clean texts
    cast = np.stack([np.where(rng.random(4000) < np.where(label, hit, wrong), 1, rng.integers(-1, 1, 4000)) for hit, wrong in rates], 1)
    model = toxicity.fit_label_model(cast.astype(np.int8), 0.3)
    patterns = np.array(list(itertools.product((-1, 0, 1), repeat=3)), np.int8)
    for pattern, posterior in zip(patterns, model.posterior(patterns)):
        chances = []
        for value, prior in ((0, 1 - model.prior), (1, model.prior)):
            chance = prior
            for voter, vote in enumerate(pattern):
                chance *= model.behaviour[voter, value, vote + 1] ** model.weights[voter]
            chances.append(chance)
        assert posterior == pytest.approx(chances[1] / sum(chances), rel=1e-9)
    assert ((model.posterior(cast) > 0.5) == label).mean() > 0.8
