import re

import pytest
from pyspark.sql import functions as F

from tablewright.llm import quality, queries
from tests.conftest import plan
from tests.llm.conftest import SMALL


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


TEXTS = [
    None, "", " \n\t", "a b c a b c", "a a a a", "x\nx\n\n \nx \n y#*", "one two three " * 20, "a b c d e f g " * 2 + "h " * 50,
    "é \x0b ñ\x0c<b>|&", "w1\r\nw1\r\nw2", " ".join(f"t{i}" for i in range(60)), "\xa0   x",
]


def test_measures_against_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    rows = sorted(quality.with_measures(df).collect())
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert [tuple(r[n] for n in names) for r in rows] == [brute(text) for text in TEXTS]


def pages(spark, boiler=30):
    own = " ".join(f"own{i}" for i in range(80))
    rows = [(i, f"{own} {i}th\nSubscribe  NOW {i}", "a") for i in range(boiler)]
    rows += [(100 + i, f"only {i} {own[: 40 + i]}\n" + "Much longer boilerplate line of the host\n" * 9, "b") for i in range(25)]
    rows += [(200 + i, own, "c") for i in range(40)]  # copies of one text
    rows += [(None, own, "d") for i in range(40)]  # one document
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_line_frequency_per_host(spark):
    kept = {r["doc_id"]: r for r in quality.judged(pages(spark)).collect()}
    # Digits are alike, so both lines of host a are in all its documents.
    assert all(not kept[i]["kept"] for i in range(30))
    assert all(not kept[100 + i]["kept"] and kept[100 + i]["removed_chars"] > 300 for i in range(25))
    # Copies under ids of their own are documents, those without an id are one.
    assert all(not kept[200 + i]["kept"] and kept[200 + i]["removed_chars"] > 300 for i in range(40))
    assert kept[None]["kept"] and kept[None]["removed_chars"] == 0
    below = {r["doc_id"]: r["removed_chars"] for r in quality.judged(pages(spark, 20)).collect()}
    assert all(below[i] == 0 for i in range(20))


def test_clean_removes_lines(spark):
    cleaned = {r["doc_id"]: r["text"] for r in quality.clean(pages(spark)).collect()}
    assert all("boilerplate" not in cleaned[100 + i] and cleaned[100 + i].startswith(f"only {i}") for i in range(25))
    assert cleaned[0] == "" and cleaned[200] == "" and cleaned[None].startswith("own0 ")


@pytest.mark.parametrize("times", [1, 10])
def test_limit_is_a_share_of_the_host_at_every_size(spark, times):
    """Lines in 1 and 2 percent of a host, and in the 20 documents that always may share one."""
    rows = []
    for i in range(3000 * times):
        shared = "in one percent" if i % 100 == 0 else "in two percent" if i % 50 == 1 else ""
        rows.append((i, f"{shared}\n" + "".join(chr(97 + int(c)) for c in str(i)) + " own", "big"))
    rows += [(-1 - i, "in twenty", "small") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    lost = {r["doc_id"]: r["removed_chars"] for r in quality.judged(df).collect()}
    assert {lost[i] for i in range(0, 3000 * times, 100)} == {0}
    assert {lost[i] for i in range(1, 3000 * times, 50)} == {14}
    assert {lost[-1 - i] for i in range(20)} == {0}


def test_columns_of_the_result(odd):
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert quality.judged(odd).columns == ["doc_id", *measures, "kept", "removed_chars"]


def test_odd_and_no_rows(odd, no_rows):
    rows = quality.judged(odd).collect()
    assert len(rows) == odd.count() and quality.judged(no_rows).count() == 0
    assert {r["doc_id"]: r["base_failed"] for r in rows}[1]
    assert quality.clean(odd).columns == odd.columns and quality.clean(odd).count() == odd.count()


def test_no_python_in_the_plan(spark):
    text = plan(queries.op7_quality(spark, SMALL))
    assert not re.search("Python|Pandas|Arrow|MapIn", text)


def test_repeated_rows_lose_their_lines_once(spark):
    df = pages(spark)
    twice = df.union(df.filter("doc_id = 100"))
    rows = [r for r in quality.judged(twice).collect() if r["doc_id"] == 100]
    assert len(rows) == 2 and rows[0] == rows[1]
    once = [r for r in quality.judged(df).collect() if r["doc_id"] == 100]
    assert rows[0] == once[0]
