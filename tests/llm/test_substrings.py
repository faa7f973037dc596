import hashlib
import random

import numpy as np
import pytest

from tablewright.llm import fm_index, queries, substrings
from tests.llm.conftest import SMALL


def key_order(row):
    return (row[0] is None, row[0] or 0)


def brute(rows):
    """Expected ``n_words, kept words`` by key; keys are distinct."""
    seen, expected = set(), {}
    for key, text in sorted(rows, key=key_order):
        words = (text or "").encode().split()
        removed = [False] * len(words)
        for start in range(len(words) - 19):
            window = tuple(words[start : start + 20])
            if window in seen:
                removed[start : start + 20] = [True] * 20
            seen.add(window)
        expected[key] = (len(words), b" ".join(w for w, gone in zip(words, removed) if not gone).decode())
    return expected


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = substrings.deduplicate(df, texts=True, **options).collect()
    expected = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        n_words, kept = expected[r["doc_id"]]
        assert (r["n_words"], r["kept"]) == (n_words, kept)
        assert r["n_removed"] == n_words - len(kept.encode().split()) == sum(s["end"] - s["start"] for s in r["removed"])
        assert r["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()


def made(seed, documents=60, vocabulary=40):
    """Texts of few words, put together from shared passages and runs of one word."""
    draw = random.Random(seed)
    names = [f"w{i}" for i in range(vocabulary)]
    passages = [[draw.choice(names) for _ in range(draw.randint(15, 70))] for _ in range(8)]
    rows = []
    for key in range(documents):
        words = []
        for _ in range(draw.randint(0, 5)):
            kind = draw.random()
            if kind < 0.4:
                passage = draw.choice(passages)
                words += passage[draw.randint(0, 5) : len(passage) - draw.randint(0, 5)]
            elif kind < 0.55:
                words += [draw.choice(names[:3])] * draw.randint(1, 60)
            elif kind < 0.65:
                words += names[:2] * draw.randint(1, 30)
            else:
                words += [draw.choice(names) for _ in range(draw.randint(1, 50))]
        rows.append((key, draw.choice([" ", "\n", "\t \r", "  "]).join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    check(spark, made(seed))


def test_many_groups_and_hot_grams(spark, monkeypatch):
    monkeypatch.setattr(substrings, "GROUP_BYTES", 4000)
    monkeypatch.setattr(substrings, "HOT_SEGMENTS", 4)
    check(spark, made(3))


def test_long_text_is_cut(spark, monkeypatch):
    monkeypatch.setattr(substrings, "BLOCK", 64)
    monkeypatch.setattr(substrings.ta, "BATCH_CHARS", 500)
    rows = made(4, documents=12)
    rows.append((99, " ".join(text for _, text in rows)))
    rows.append((98, "x" * 700 + " " + "y" * 300))
    check(spark, rows)


def test_bounds_of_a_window(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [
        (1, f"a b c {passage} d"), (2, f"{passage}"), (3, passage.rsplit(" ", 1)[0]), (4, f"z {passage} {passage}"),
        (5, " ".join(["again"] * 21)), (6, " ".join(["once"] * 20)), (7, passage.replace("p3", "P3")), (8, passage.replace(" ", "\xa0")),
    ]
    check(spark, rows)
    lost = {r["doc_id"]: r["n_removed"] for r in substrings.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert lost == {1: 0, 2: 20, 3: 0, 4: 40, 5: 20, 6: 0, 7: 0, 8: 0}


def test_rows_without_or_with_one_key(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(None, passage), (2, passage), (2, passage), (1, None), (3, ""), (None, passage + " end")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["doc_id"], r["n_words"], r["n_removed"]) for r in substrings.deduplicate(df).collect()]
    expected = [(2, 30, 0), (2, 30, 0), (1, 0, 0), (3, 0, 0), (None, 30, 30), (None, 31, 30)]
    assert sorted(map(str, got)) == sorted(map(str, expected))


def test_odd_and_no_rows(odd, no_rows):
    got = substrings.deduplicate(odd).collect()
    assert len(got) == odd.count() and substrings.deduplicate(no_rows).count() == 0
    lost = {r["doc_id"]: r["n_removed"] / max(1, r["n_words"]) for r in got}
    assert lost[7] > 0.99 and lost[1] == 0


def test_query_against_brute_force(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in small.select("doc_id", "text").collect()]
    # Blanks beyond ASCII are part of words, so lengths are counted in bytes.
    expected = {k: (n, n - len(t.encode().split()), hashlib.sha256(t.encode()).hexdigest()) for k, (n, t) in brute(rows).items()}
    got = queries.op13_substrings(spark, SMALL).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == expected


def sequences(seed, alphabet):
    draw = np.random.default_rng(seed)
    parts = [np.append(draw.integers(1, alphabet, draw.integers(1, 30)), 0) for _ in range(20)]
    return np.concatenate(parts)


@pytest.mark.parametrize("alphabet", [2, 3, 9, 500])
def test_index_finds_every_place(alphabet):
    text = sequences(alphabet, alphabet)
    index = fm_index.FMIndex(text)
    for length in (1, 2, 5):
        starts = np.array([s for s in range(len(text) - length) if (text[s : s + length] > 0).all()])
        places = {}
        for s in starts:
            places.setdefault(tuple(text[s : s + length]), []).append(int(s))
        again, low, high = index.repeated(starts, length)
        expected = [i for i, s in enumerate(starts) if len(places[tuple(text[s : s + length])]) > 1]
        assert again.tolist() == expected
        for i, a, b, least in zip(again, low, high, index.earliest(low, high)):
            found = sorted(index.positions[a:b].tolist())
            assert found == places[tuple(text[starts[i] : starts[i] + length])] and least == found[0]


def test_ranks():
    symbols = np.random.default_rng(5).integers(0, 77, 1000)
    matrix = fm_index.WaveletMatrix(symbols)
    ends = np.arange(1001)
    for symbol in (0, 1, 40, 76):
        counts = np.concatenate([[0], np.cumsum(symbols == symbol)])
        asked = np.full(1001, symbol)
        assert (matrix.rank(asked, ends) - matrix.rank(asked, np.zeros(1001, int)) == counts).all()


def test_equal_windows_have_equal_grams():
    hashes = substrings.mix(np.random.default_rng(6).integers(1, 5, 400).astype(np.uint64))
    starts, windows, gram = substrings.segments(hashes, np.array([0, 130, 130, 140, 400]))
    named, inside = {}, []
    for start, count, name in zip(starts, windows, gram):
        assert 1 <= count <= substrings.WINDOW - substrings.GRAM + 1
        own = [tuple(hashes[start + j : start + j + 20]) for j in range(count)]
        assert len(set(own)) == len(own)
        for window in own:
            assert named.setdefault(window, name) == name
        inside += range(start, start + count)
    assert inside == [*range(0, 111), *range(140, 381)]
