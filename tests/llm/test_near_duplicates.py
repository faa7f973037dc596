import collections
import random
import re

import numpy as np
import pytest

from tablewright.llm import near_duplicates as nd
from tablewright.llm.components import components


def brute_sets(texts):
    sets = {}
    for key, text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
        sets[key] = grams if len(words) >= 5 else ({tuple(words)} if words else set())
    return sets


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def brute(texts, percent=75):
    sets, holders, common = brute_sets(texts), collections.defaultdict(list), collections.Counter()
    for key, grams in sets.items():
        for gram in grams:
            holders[gram].append(key)
    for keys in holders.values():
        common.update((a, b) for i, a in enumerate(keys) for b in keys[i + 1 :])
    parent = {key: key for key in sets}
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(parent, a), find(parent, b)
            parent[max(a, b)] = min(a, b)
    return {key: (len(sets[key]), find(parent, key)) for key in sets}


def found(df):
    rows = nd.near_duplicates(df).collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows if r["doc_id"] is not None)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}


def test_components_of_random_graphs(spark):
    rng = random.Random(2)
    for nodes, edges in ((40, 30), (60, 90), (30, 5)):
        pairs = [(rng.randrange(nodes), rng.randrange(nodes)) for _ in range(edges)]
        pairs += [(0, 25), (25, 26), (26, 27), (27, 28), (28, 29)]
        parent = {i: i for i in range(nodes)}
        for a, b in pairs:
            a, b = find(parent, a), find(parent, b)
            parent[max(a, b)] = min(a, b)
        expected = {i: find(parent, i) for pair in pairs for i in pair if find(parent, i) != i}
        rows = components(spark.createDataFrame(pairs, "u long, v long")).collect()
        assert {r["node"]: r["component"] for r in rows} == expected and len(rows) == len(expected)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 63, 1400, np.uint64)
    a, b = values[:1000], values[200:1200]  # 800 of 1200
    sketch = nd.signatures(np.concatenate([np.sort(a), np.sort(b)]), np.array([0, 1000, 2000]))
    lanes = sketch.view(np.uint16)
    assert abs((lanes[0] == lanes[1]).mean() - 2 / 3) < 0.13


def test_groups_of_near_copies_with_wide_edits(spark):
    """Chains, hubs and members whose similarity lies about the limit."""
    rng, texts = random.Random(5), []
    for group in range(6):
        base = [f"w{group}_{rng.randrange(400)}" for _ in range(rng.choice([8, 40, 120]))]
        previous = base
        for number in range(25):
            source = previous if group % 2 else base
            words = list(source)
            for _ in range(rng.randrange(0, max(2, len(words) // 12))):
                words[rng.randrange(len(words))] = f"x{rng.randrange(30)}"
            previous = words
            texts.append((len(texts), " ".join(words)))
    rng.shuffle(texts)
    assert found(spark.createDataFrame(texts, "doc_id long, text string")) == brute(texts)


def test_given_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    assert found(rows) == brute([tuple(r) for r in rows.collect()])


def test_edges_of_the_definition(spark):
    texts = [
        (1, "a b c d e f g"), (2, "A B C D E F G"), (3, "a\tb\nc  d e f g"), (4, "é b c d e f g"), (5, "É b c d e f g"),
        (6, "one two"), (7, "two one"), (8, "ONE  two"), (9, ""), (10, None), (11, " \n"), (12, "a b c d e f\xa0g"),
    ]
    expected = brute(texts)
    assert found(spark.createDataFrame(texts, "doc_id long, text string")) == expected
    assert expected[3] == (3, 1) and expected[8] == (1, 6) and expected[9] == (0, 9)


def test_odd_and_no_rows(odd, no_rows):
    rows = nd.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by_key = {r["doc_id"]: r for r in rows}
    assert by_key[6]["component_id"] == 5 and not by_key[6]["kept"]
    assert by_key[None]["component_id"] is None and by_key[None]["kept"]
    assert by_key[7]["n_shingles"] == 3  # a long text of three words again and again
    assert nd.near_duplicates(no_rows).count() == 0
