import itertools
import re
from collections import Counter

import numpy as np

from tablewright.llm import filter_audit
from tablewright.llm import text_arrays as ta

LONG = " ".join(f"w{i}" for i in range(210))


def failures(rows):
    """Set of failed filters per row, the plain way."""
    least = {}
    for key, text, _ in rows:
        if key is not None:
            least[text or ""] = min(key, least.get(text or "", key))
    found = []
    for key, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
            "E": key is not None and key > least[text],
        }
        found.append({name for name, bad in failed.items() if bad})
    return found


def brute(rows, labels):
    good = {key for key, quality, _ in labels if quality == 1 and key is not None}
    toxic = {key for key, _, mark in labels if mark == 1 and key is not None}
    failed, expected = failures(rows), {}
    for part in {row[2] or "" for row in rows}:
        own = [(row[0], bad) for row, bad in zip(rows, failed) if (row[2] or "") == part]
        removed_by, table = Counter(), []
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                gone = [one for one in left if name in one[1]]
                left = [one for one in left if name not in one[1]]
                alone = sum(name in bad for _, bad in own)
                unique = sum(bad == {name} for _, bad in own)
                removed_by[name] += len(gone)
                lost = [sum(key in marked for key, _ in gone) for marked in (good, toxic)]
                table.append(((part, "".join(order), step), name, [len(left), len(gone), alone - len(gone), unique, *lost]))
        for at, name, numbers in table:
            expected[at] = (*numbers, removed_by[name])
    return expected


def got(frame):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in frame.collect()}


ROWS = [
    (1, LONG, "a"), (2, LONG, "a"), (3, LONG, "b"), (4, None, "a"), (5, "", None), (6, " \n", ""),
    (7, "x " * 300, "b"), (8, "x " * 300 + "#", "b"), (9, LONG + " ABCDEFGHIJKLMNOPQRSTUVWXYZ" * 2, "a"), (9, LONG, "c"),
    (9, LONG, "c"), (None, LONG, "c"), (None, LONG, "c"), (0, "UPPER CASE & more", "c"), (11, "caf\xe9 \xa0 " * 120, "a"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, None), (4, None, 1), (7, 1, 1), (9, 1, 0), (None, 1, 1), (50, 1, 1), (3, 2, 3)]


def test_against_every_order(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    found = got(filter_audit.audit(df, labels))
    assert found == brute(ROWS, LABELS) and len(found) == 600 * len({row[2] or "" for row in ROWS})


def test_potential_is_the_shapley_value():
    draw = np.random.default_rng(1)
    counts = draw.integers(0, 1000, (3, 32))
    values = filter_audit.coalition_values(counts)[0]
    scaled = filter_audit.potentials(values)
    for player in range(5):
        total = 0
        for order in itertools.permutations(range(5)):
            before = sum(1 << other for other in order[: order.index(player)])
            total += values[before | 1 << player] - values[before]
        assert scaled[31] - scaled[31 ^ 1 << player] == total
    # Efficiency: the values of all players add up to the grand coalition.
    assert sum(scaled[31] - scaled[31 ^ 1 << player] for player in range(5)) == 120 * values[31]


def test_long_texts_in_pieces(monkeypatch):
    text = ("\xa0one two three\n" * 50 + "x" * 90).encode()
    whole = filter_audit.word_counts(text)
    monkeypatch.setattr(ta, "PIECE_BYTES", 64)
    lists = list(ta.word_lists(text, 64))
    assert [word for words in lists for word in words] == text.split() and len(lists) > 5
    assert filter_audit.word_counts(text) == whole


def test_odd_and_no_rows(spark, odd, no_rows):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in odd.collect()]
    assert got(filter_audit.audit(odd, labels)) == brute(rows, LABELS)
    assert filter_audit.audit(no_rows, labels).count() == 0
    assert filter_audit.audit(odd, labels.limit(0)).filter("good_lost > 0 OR toxic_lost > 0").count() == 0
