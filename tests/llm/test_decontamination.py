import random

import numpy as np
import pytest

from tablewright.llm import decontamination as dc
from tablewright.llm import queries
from tablewright.llm import text_arrays as ta

PASSAGE = (
    "The quick brown fox jumps over the lazy dog while seven wizards mix a potion of strange "
    "herbs, and nobody in the quiet village ever learns what became of the second kettle."
)


def edit_distance_inside(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != c), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def leaks(text, *items):
    return dc.find([text], dc.build_index(list(enumerate(items))))[0]


def test_gram_hashes_tell_grams_apart():
    codes = ta.flatten(["abcabcabcabcabd"]).codes
    hashes = dc.gram_hashes(codes, 10)
    assert len(hashes) == 6 and hashes[0] == hashes[3] and len(set(hashes.tolist())) == 4
    assert len(dc.gram_hashes(codes[:9], 10)) == 0


def test_alignment_is_the_least_edit_distance():
    rng = random.Random(3)
    for _ in range(20):
        pattern = "".join(rng.choice("abcd") for _ in range(12))
        text = list(pattern)
        for _ in range(rng.randrange(3)):
            text[rng.randrange(len(text))] = rng.choice("abcd")
        window = "zz" + "".join(text) + "zz"
        codes = [np.array([[ord(c) for c in x]], np.uint32) for x in (pattern, window)]
        cost, start, end = dc.align(codes[0], np.array([12]), codes[1])
        assert cost[0] == edit_distance_inside(pattern, window)
        assert edit_distance_inside(pattern, window[start[0] : end[0]]) == cost[0]


def test_exact_passage_and_its_place():
    text = "Some words before. " + PASSAGE + " And some after."
    (leak,) = leaks(text, PASSAGE)
    assert text[leak["start"] : leak["end"]] == PASSAGE[:-1] and leak["edits"] == 0


def test_case_punctuation_and_edits_are_found():
    assert leaks(PASSAGE.upper().replace(" ", "\n -- "), PASSAGE)
    edited = PASSAGE.replace("brown", "browm").replace("seven", "sevn").replace("strange", "strangge")
    (leak,) = leaks("Intro: " + edited, PASSAGE)
    assert leak["edits"] >= 1
    assert leaks("Part of it: " + PASSAGE[30:140] + " end", PASSAGE)


def test_what_is_no_leak():
    other = " ".join(reversed(PASSAGE.split()))
    assert not leaks(other, PASSAGE)
    assert not leaks(PASSAGE[:40] + " and then something entirely different", PASSAGE)
    assert not leaks(PASSAGE, "too short", None, "")
    assert dc.find([None, "", "x"], dc.build_index([(1, PASSAGE)])) == [[], [], []]


def test_a_leak_does_not_cross_texts():
    half = len(PASSAGE) // 2 - 40
    found = dc.find([PASSAGE[:half], PASSAGE[half:]], dc.build_index([(1, PASSAGE[half - 32 : half + 32])]))
    assert found == [[], []]


def test_random_edits_within_the_budget_are_always_found():
    rng = random.Random(8)
    index = dc.build_index([(1, PASSAGE)])
    for _ in range(40):
        text = list(PASSAGE)
        for place in rng.sample(range(len(text)), 4):
            text[place] = rng.choice(["", "q", text[place] + "q"])
        assert dc.find(["xyz " * rng.randrange(9) + "".join(text)], index)[0]


def test_items_with_equal_text_and_several_places(spark):
    items = spark.createDataFrame([(1, PASSAGE), (2, PASSAGE.lower()), (3, None)], "item_id long, text string")
    text = PASSAGE + " something else entirely stands here between the two copies of it, quite long " * 3 + PASSAGE
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    for block in (dc.BLOCK_CHARS, 150):
        (row,) = dc.with_leaks(docs, items, block_chars=block).collect()
        assert sorted(x["item_id"] for x in row["leaks"]) == [1, 1, 2, 2]


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.01"

    def words(text):
        return "".join(c if c.isalnum() else " " for c in text.lower()).split()

    docs = [(r["doc_id"], " ".join(words(r["text"]))) for r in queries.table(spark, folder, "documents").collect()]
    items = [(r["item_id"], " ".join(words(r["text"]))) for r in queries.table(spark, folder, "benchmark").collect()]
    expected = {(key, item) for item, passage in items for key, text in docs if passage in text}
    rows = queries.op3_decontamination(spark, folder).collect()
    found = {(r["doc_id"], r["item_id"]) for r in rows}
    assert len(expected) > 10 and expected <= found
    texts, passages = dict(docs), dict(items)
    for key, item in found - expected:
        parts = [passages[item][i : i + 64] for i in range(0, len(passages[item]) - 63, 8)]
        assert min(edit_distance_inside(part, texts[key]) for part in parts) <= 4


def test_odd_and_no_rows(spark, odd, no_rows):
    items = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    assert {len(r["leaks"]) for r in dc.with_leaks(odd, items).collect()} == {0}
    assert dc.with_leaks(no_rows, items).count() == 0
    assert {len(r["leaks"]) for r in dc.with_leaks(odd, items.limit(0)).collect()} == {0}


def test_short_items_are_found_as_they_are(spark, caplog):
    question, chinese = "What is the capital of France?", "\u6cd5\u56fd\u7684\u9996\u90fd\u662f\u54ea\u91cc\uff1f"
    items = [question, chinese, "Pi?", "pi", "...", "thirty one letters of a text ok", PASSAGE]
    text = f"Q: what is -- the CAPITAL of France\n{chinese} A pi, a pie. {PASSAGE}"
    found = {(x["item_id"], text[x["start"] : x["end"]], x["edits"]) for x in leaks(text, *items)}
    assert found == {
        (0, "what is -- the CAPITAL of France", 0), (1, chinese[:-1], 0), (2, "pi", 0), (3, "pi", 0), (6, PASSAGE[:-1], 0),
    }
    index = dc.build_index(list(enumerate(items[:2])))
    halves = ["What is the capital", "of France", "what is the capital of Francesco", None, "somewhat is the capital of france"]
    assert dc.find(halves, index) == [[], [], [], [], []]
    edited = ["so, what is the capitol of France", "what is the capital of Frances", "what is the capitol of Frances"]
    assert [[x["edits"] for x in one] for one in dc.find(edited, index)] == [[1], [1], []]
    # Text without blanks around the item, and an item within a run of letters.
    inside = f"\u8bf7\u95ee{chinese[:-1]}\u5462"
    assert [(x["item_id"], inside[x["start"] : x["end"]]) for x in dc.find([inside], index)[0]] == [(1, chinese[:-1])]
    texts = ["x " * i + question for i in range(5)] + [question + " no"]
    assert [len(one) for one in dc.find(texts, index)] == [1] * 6
    benchmark = spark.createDataFrame([(1, question), (2, PASSAGE), (None, "Pi?")], "item_id long, text string")
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    with caplog.at_level("INFO"):
        (row,) = dc.with_leaks(docs, benchmark).collect()
    assert [x["item_id"] for x in row["leaks"]] == [1, None, 2] and "1 of 3 benchmark items" in caplog.text


def least_edits_between_words(item, text):
    """Edit distance of the item to the nearest run of whole words."""
    words = text.split(" ")
    best = len(item)
    for i in range(len(words)):
        for j in range(i + 1, len(words) + 1):
            run = " ".join(words[i:j])
            if abs(len(run) - len(item)) <= 2:
                row = list(range(len(run) + 1))
                for a in item:
                    last, row[0] = row[0], row[0] + 1
                    for k, b in enumerate(run, 1):
                        last, row[k] = row[k], min(last + (a != b), row[k] + 1, row[k - 1] + 1)
                best = min(best, row[-1])
    return best


@pytest.mark.parametrize("seed", range(3))
def test_short_items_with_an_edit_against_brute_force(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "ab", "abb", "ba", "bab", "cab", "12"]
    texts = [" ".join(rng.choices(vocabulary, k=40)) for _ in range(30)]
    items = set()
    while len(items) < 40:
        words = rng.choice(texts).split(" ")
        at = rng.randrange(30)
        item = " ".join(words[at : at + rng.randrange(4, 10)])
        for _ in range(rng.randrange(3)):
            place = rng.randrange(len(item))
            item = item[:place] + rng.choice(["", "b", "x"]) + item[place + rng.randrange(2) :]
        item = " ".join(item.split())
        if 16 <= len(item) < 32:
            items.add(item)
    items = sorted(items)
    index = dc.build_index(list(enumerate(items)))
    hits = 0
    for text, found in zip(texts, dc.find(texts, index)):
        expected = {i for i, item in enumerate(items) if least_edits_between_words(item, text) <= 1}
        assert {x["item_id"] for x in found} == expected
        hits += len(expected)
    assert hits > 20


def test_short_items_against_brute_force():
    rng = random.Random(5)
    words = [["a", "ab", "b", "ba", "\u00e9", "12"][rng.randrange(6)] for _ in range(400)]
    items = sorted({" ".join(rng.choices(words, k=rng.randrange(1, 5))) for _ in range(40)})
    texts = [" ".join(rng.choices(words, k=30)) for _ in range(20)]
    index = dc.build_index(list(enumerate(items)))
    for text, found in zip(texts, dc.find(texts, index)):
        assert {x["item_id"] for x in found} == {i for i, item in enumerate(items) if f" {item} " in f" {text} "}
