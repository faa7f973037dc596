"""Encoding, packing, token files and attribution against the tokenizer itself."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablewright.llm import attribution, packing, queries, token_files, tokens
from tablewright.staging import stage
from tests.llm.conftest import SMALL

ODD = [
    None, "", " ", "\n\n", "a  b", "  a", "a\xa0 b", "a  b\n\n c", "<|endoftext|> x", "it's 'S don't",
    "x\x00y z", "é́ ́a", "日本語 テスト  \t\r\n x", "12 345,6 7!!! ...", "😀😀 😀‍ x",
    "A\x0b\x0cB", "x ́ y", "a\n \nb", "   \n   b   ", "İSTANBUL ΣΑΣ ς", "ab\x1cc  d", "naïve Élan", "a≠b",
]
PATHS = {name: public_tokenizers.path(name) for name in ("word_bpe_49k.json", "byte_bpe_50k.json")}
ENCODERS = {}


def plain(name):
    tokenizer = Tokenizer.from_file(PATHS[name])
    tokenizer.encode_special_tokens = True
    return tokenizer


def encoder(name, spans):
    return ENCODERS.setdefault((name, spans), tokens.Encoder(PATHS[name], spans))


@pytest.mark.parametrize("name", PATHS)
@pytest.mark.parametrize("spans", [False, True])
def test_pieces_encode_as_whole_texts(name, spans):
    found, tokenizer = encoder(name, spans).encode(pa.array(ODD)), plain(name)
    for i, text in enumerate(ODD):
        one, own = tokenizer.encode(text or "", add_special_tokens=False), slice(found.bounds[i], found.bounds[i + 1])
        assert found.ids[own].tolist() == one.ids, text
        if spans:
            assert [tuple(s) for s in found.spans[own].tolist()] == one.offsets, text


@pytest.mark.parametrize("name", PATHS)
@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.sampled_from(list("aB é'ñ.,!\n\t 1́ß<(ſK")), max_size=30), max_size=4))
def test_pieces_encode_as_whole_texts_at_random(name, texts):
    found, tokenizer = encoder(name, False).encode(pa.array(texts, pa.string())), plain(name)
    for i, text in enumerate(texts):
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert found.ids[found.bounds[i] : found.bounds[i + 1]].tolist() == expected


def test_a_full_memo_starts_anew(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_PIECES", 3)
    one, tokenizer = tokens.Encoder(PATHS["word_bpe_49k.json"]), plain("word_bpe_49k.json")
    texts = ["the of and a in", "to the of be", "is the"]
    for text in texts:
        assert one.encode(pa.array([text])).ids.tolist() == tokenizer.encode(text).ids


# Packing


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_placement_keeps_every_capacity(rule):
    lengths = np.random.default_rng(3).integers(1, 100, 500)
    sequence, offset = packing.place(lengths, 100, 4, 9900, rule=rule)
    for number in np.unique(sequence):
        own = sequence == number
        assert lengths[own].sum() <= 100 and own.sum() <= 4 and (lengths[own] ** 2).sum() <= 9900
        order = np.argsort(offset[own])
        assert offset[own][order].tolist() == [0, *np.cumsum(lengths[own][order])[:-1]]


def test_placement_is_tight():
    lengths = np.random.default_rng(4).integers(1, 2000, 4000)
    sequence, _ = packing.place(lengths)
    assert len(np.unique(sequence)) <= 1.005 * lengths.sum() / packing.CAPACITY + 1
    with pytest.raises(ValueError):
        packing.place(np.array([5000]))
    assert len(packing.place(np.array([], np.int64))[0]) == 0


def expected_pieces(texts, name, end, capacity=4096):
    tokenizer, found = plain(name), {}
    for key, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")
        for number, start in enumerate(range(0, len(ids), capacity)):
            own = ids[start : start + capacity]
            found[key, number] = (start, len(own), zlib.crc32(own.tobytes()))
    return found


def gapless(rows):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in by_sequence.values():
        held.sort()
        ends = [offset + length for offset, length in held]
        assert [offset for offset, _ in held] == [0, *ends[:-1]] and ends[-1] <= 4096
    return len(by_sequence)


def test_packing_query_against_brute_force(spark, small):
    rows = queries.op4_packing(spark, SMALL).collect()
    found = {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows}
    assert found == expected_pieces(small.select("doc_id", "text").collect(), "word_bpe_49k.json", 1)
    assert gapless(rows) <= sum(r["length"] for r in rows) / 4096 + 2


def test_packing_odd_rows_and_several_groups(odd, no_rows):
    path = PATHS["word_bpe_49k.json"]
    cut = stage(packing.pieces(odd, path, 1), "cut")
    placed = stage(packing.pack(cut, group_pieces=4), "placed")
    rows = placed.collect()
    gapless(rows)
    assert sum(r["piece"] == 0 for r in rows) == odd.count()
    assert max(r["piece"] for r in rows) > 10  # the long text
    whole = packing.sequences(cut, placed).collect()
    assert sum(len(r["ids"]) for r in whole) == 4 * sum(r["length"] for r in rows)
    assert packing.pack_documents(no_rows, path, 1).count() == 0


# Token files


@settings(max_examples=50, deadline=None)
@given(bits=st.integers(1, 32), seed=st.integers(0, 99), count=st.integers(0, 300))
def test_bits_round_trip(bits, seed, count):
    ids = np.random.default_rng(seed).integers(0, 1 << bits, count, dtype=np.uint64)
    words = token_files.pack_bits(ids, bits)
    assert len(words) == -(-count // 64) * bits
    assert (token_files.unpack_bits(words, bits, count) == ids).all()


def test_file_gives_any_range():
    ids = np.random.default_rng(5).integers(0, 50_257, 10_000).astype(np.uint32)
    starts = np.array([0, 1, 1, 9_000, 10_000])
    content = token_files.to_file([4, None, 6, 7], ids, starts, 16, 2, 3, 44)
    file = token_files.TokenFile(content)
    assert (file.bits, file.part, file.number, file.before) == (16, 2, 3, 44)
    assert file.nulls.tolist() == [False, True, False, False] and content.endswith(b"\n")
    for low, high in [(0, 10_000), (4_095, 4_097), (5_000, 5_000), (9_999, 10_000)]:
        assert (file.read(low, high) == ids[low:high]).all()
    assert (file.document(2) == ids[1:9_000]).all()
    with pytest.raises(ValueError):
        token_files.TokenFile(b"\0" * 64)


def test_token_file_query_against_brute_force(spark, small):
    tokenizer, start, expected = plain("byte_bpe_50k.json"), 0, []
    for key, text in sorted(small.select("doc_id", "text").collect()):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        expected.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = queries.op9_token_files(spark, SMALL).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, found.collect())) == expected


def test_token_files_of_odd_and_no_rows(spark, odd, no_rows, tmp_path):
    path = PATHS["byte_bpe_50k.json"]
    token_files.write_token_files(odd, str(tmp_path / "files"), path, 0, file_ids=20)
    read = token_files.with_global_starts(stage(token_files.read_token_files(spark, str(tmp_path / "files")), "read"))
    rows = sorted(read.collect(), key=lambda r: r["start"])
    keys = [r["doc_id"] for r in rows]
    assert keys == [None, 1, 2, 3, 4, 5, 5, 6, 7, 8, 9]
    assert [r["start"] for r in rows] == [0, *np.cumsum([r["n_tokens"] for r in rows])[:-1]]
    assert np.frombuffer(rows[1]["ids"], "<u4").tolist() == [0]
    assert token_files.round_trip(no_rows, path, 0).count() == 0


# Attribution


def brute_counts(spans, sections, rule):
    totals, crossing = np.zeros(len(sections) + 1), np.zeros(len(sections) + 1, int)
    for low, high in spans:
        places = []
        for place in range(low, max(high, low + 1)):
            inside = [i for i, (a, b) in enumerate(sections) if a <= place < b]
            places.append(inside[0] if inside else len(sections))
        order = list(dict.fromkeys(places))
        if rule == "fraction":
            for place in places:
                totals[place] += 1 / len(places)
        elif rule == "majority":
            totals[max(order, key=lambda s: (places.count(s), -order.index(s)))] += 1
        else:
            totals[places[0]] += 1
        if len(order) > 1:
            for s in order:
                crossing[s] += 1
    return totals, crossing


@settings(max_examples=80, deadline=None)
@given(data=st.data(), rule=st.sampled_from(attribution.RULES))
def test_allocation_against_brute_force(data, rule):
    edges = sorted(data.draw(st.lists(st.integers(0, 30), min_size=0, max_size=8)))
    sections = np.array(edges[: len(edges) // 2 * 2], np.int64).reshape(-1, 2)
    cuts = sorted(data.draw(st.sets(st.integers(0, 30), min_size=2, max_size=12)))
    spans = np.array(list(zip(cuts, cuts[1:])), np.int64)
    totals, _ = attribution.allocate(spans, sections, rule)
    expected, _ = brute_counts(spans, sections, rule)
    if rule == "majority":  # parts of the text outside sections are told apart there
        assert totals.sum() == expected.sum()
    else:
        assert totals == pytest.approx(expected)


def test_majority_takes_the_larger_part():
    spans = np.array([[0, 3], [3, 8], [8, 10], [10, 14]])
    sections = np.array([[0, 4], [4, 9], [9, 12]])
    assert attribution.allocate(spans, sections, "majority")[0].tolist() == [1, 2, 1, 0]
    assert attribution.allocate(spans, sections, "start")[0].tolist() == [2, 1, 1, 0]
    assert attribution.allocate(spans, sections, "fraction")[0].tolist() == [1.2, 1.3, 1, 0.5]
    assert attribution.allocate(spans, sections, "start")[1].tolist() == [1, 2, 2, 1]


def test_fields_are_encoded_together(spark):
    df = spark.createDataFrame([("user", None, "hello there")], "role string, name string, said string")
    text, intervals = attribution.fields(F.col("role"), F.col("name"), F.col("said"))
    (row,) = attribution.attribute(df, PATHS["byte_bpe_50k.json"], text, intervals).collect()
    assert [(c["start"], c["end"], c["n_tokens"]) for c in row["token_counts"]] == [(0, 5, 2), (5, 6, 1), (6, 17, 2)]


def test_attribution_query_keeps_every_token(spark, small):
    tokenizer = plain("byte_bpe_50k.json")
    rows = queries.op8_attribution(spark, SMALL).collect()
    totals = {}
    for r in rows:
        totals[r["doc_id"]] = totals.get(r["doc_id"], 0) + r["n_tokens"]
    texts = small.select("doc_id", "text").collect()
    assert totals == {k: len(tokenizer.encode(t, add_special_tokens=False).ids) for k, t in texts}
    assert len(rows) == sum(t.count("\n") + 1 for _, t in texts)


def test_attribution_of_odd_and_no_rows(odd, no_rows):
    path = PATHS["byte_bpe_50k.json"]
    rows = attribution.attribute(odd, path).collect()
    assert len(rows) == odd.count()
    by_key = {r["doc_id"]: r["token_counts"] for r in rows}
    assert [(c["section"], c["n_tokens"]) for c in by_key[1]] == [(0, 0.0)] == [(c["section"], c["n_tokens"]) for c in by_key[2]]
    assert attribution.attribute(no_rows, path).count() == 0
    nothing = attribution.attribute(odd, path, intervals=F.lit(None).cast("array<struct<start:int,end:int>>"))
    assert {len(r["token_counts"]) for r in nothing.filter("text <> ''").collect()} == {1}
    with pytest.raises(ValueError):
        attribution.attribute(odd, path, rule="other")
