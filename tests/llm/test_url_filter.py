import re

import numpy as np
import pytest

from tablewright.llm import queries, url_filter
from tablewright.llm import text_arrays as ta
from tablewright.llm.queries import URL_RULES
from tests.llm.conftest import SMALL


def brute(url):
    match = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda m: m[0].lower(), match[1]), match[2]) if match else ("", "")
    best = None
    for verdict, text in [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]:
        name, _, start = text.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            if best is None or len(text) > len(best[0]):
                best = (text, verdict)
    return host, path, *(best or (None, None))


URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.com/en/x", "https://www.example.com/en/?q=a/b", "http://a.www.example.com/en/1",
    "http://notexample.com/en/1", "http://com/", "http://com", "http://x.net/es", "http://x.net/es/", "http://x.net/fr/a#b", "ftp://x.org/1",
    "http://a.b/://c/d", "://net/fr/", "http://ÄB.net/FR/", "http://x.com?y/en/", "http://x.com#/",
]


def test_hosts_paths_and_rules_against_brute_force(spark):
    rows = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    found = sorted(url_filter.judge(rows, URL_RULES).collect())
    for row, url in zip(found, URLS):
        host, path, rule, verdict = brute(url)
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule), url
        assert row["verdict"] == verdict if verdict else row["verdict"] in ("allow", "block")
    assert [r["verdict"] for r in found[:2]] == ["block", "block"]


def test_model_is_a_distribution(spark):
    rows = [(f"http://good{i}.org/a{i}", "allow") for i in range(40)] + [(f"http://bad{i}.biz/x?{i}", "block") for i in range(40)]
    model = url_filter.fit(spark.createDataFrame(rows, "url string, verdict string"))
    prefix = "http://good1"
    flat = ta.flatten([prefix + chr(c) for c in range(255) if chr(c).lower() == chr(c)] + [prefix])
    for side in (model.accepted, model.rejected):
        logs = side.log_likelihood(flat)
        assert np.exp(logs[:-1] - logs[-1]).sum() == pytest.approx(1, abs=0.05)
    good, bad = model.score(["http://good77.org/a77", "http://bad77.biz/x?77"])
    assert good < model.threshold < bad


def test_calibration_takes_the_best_threshold():
    scores, sides = np.array([-2, -1, 0.2, 0.1, 1, 2.0]), np.array([0, 0, 0, 1, 1, 1])
    threshold = url_filter.calibrate(scores, sides)
    errors = ((scores > threshold) & (sides == 0)).sum() + ((scores <= threshold) & (sides == 1)).sum()
    assert errors == 1
    assert url_filter.calibrate(np.array([1.0]), np.array([1])) == 0


def test_query_covers_every_page(spark):
    rows = queries.op1_url_filter(spark, SMALL).collect()
    urls = {r["page_id"]: r["url"] for r in queries.table(spark, SMALL, "pages").collect()}
    assert len(rows) == len(urls)
    for r in rows:
        host, path, rule, verdict = brute(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or r["verdict"])


def test_clashing_names_and_no_rows(spark):
    df = spark.createDataFrame([("http://x.org/", 1, 2, 3)], "url string, host int, verdict int, rule int")
    (row,) = url_filter.judge(df, URL_RULES).collect()
    assert row["host"] == "x.org" and row["verdict"] == "allow" and row["rule"] is None
    assert url_filter.judge(df.limit(0), URL_RULES).count() == 0


def test_every_decided_url_counts_and_scores_equal_the_local_model(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "KNOWN_GRAMS", 40)  # most grams are joined
    n = 25_000
    urls = spark.range(2 * n).selectExpr(
        "concat(if(id % 2 = 0, 'http://Gut.org/\u00c4', 'http://bad.biz/'), conv(hash(id) & 16777215, 10, 36), '/', id) AS url",
        "if(id % 2 = 0, 'allow', 'block') AS verdict",
    )
    hot = spark.range(9_000).selectExpr("'http://hot.net/x' AS url", "'block' AS verdict")
    unknown = spark.createDataFrame([("http://gut.org/new", None), ("http://bad.biz/new", None)], "url string, verdict string")
    model = url_filter.fit(urls.unionByName(hot).unionByName(unknown))
    scores = {r["url"]: r for r in model.scores.collect()}
    assert len(scores) == 2 * n + 3 and scores["http://hot.net/x"]["n"] == 9_000
    trained = [sum(r["n"] for r in scores.values() if r["side"] == s and not r["held"]) for s in (0, 1)]
    first = model.grams.filter("pair = 'h' AND uses > 0").head()  # every url begins with it
    assert [first["n0"], first["n1"]] >= trained and trained[0] > 0.75 * n
    some = [u for u in list(scores)[:300]] + ["http://hot.net/x", "http://gut.org/new", "http://bad.biz/new"]
    assert model.score(some) == pytest.approx([scores[u]["score"] for u in some], abs=1e-6)
    held = [r for r in scores.values() if r["held"] and r["side"] is not None]
    rows = np.array([r["n"] for r in held])
    exact = url_filter.calibrate(np.array([r["score"] for r in held]), np.array([r["side"] for r in held]), rows)
    assert model.threshold == pytest.approx(exact, abs=2 * url_filter.SCORE_STEP)
    assert scores["http://gut.org/new"]["score"] < model.threshold < scores["http://bad.biz/new"]["score"]


def test_calibration_on_classes():
    scores, sides, rows = np.array([-0.5, 0.5, 1.5]), np.array([0, 1, 0]), np.array([10.0, 3.0, 1.0])
    assert url_filter.calibrate(scores, sides, rows, 1.0) == 0
