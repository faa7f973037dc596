import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablewright.llm import pii, queries, tagger
from tests.llm.conftest import SMALL

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    spans = []
    for kind, pattern in PATTERNS.items():
        for match in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", match[0])
            if kind == "ip" and any(int(part) > 255 for part in match[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            spans.append((kind, *match.span()))
    return spans


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab1234567890@@..-+ ()é", max_size=40))
def test_patterns_against_brute_force(text):
    assert pii.base_spans(text) == brute(text)


def test_known_cases():
    text = "4111 1111 1111 1111, 4111111111111112, 10.0.0.256 10.0.0.1.5 a@b.c@d.e.f +1 (222) 333-4444 + 1"
    assert pii.base_spans(text) == brute(text)
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    long = "9" * 200_000 + "a" * 200_000 + "@" + "b-" * 100_000
    assert pii.base_spans(long) == []


def test_gradient_of_the_tagger():
    rng = np.random.default_rng(1)
    model = tagger.new_tagger(3, 4, 3, rng)
    windows, tags = rng.integers(0, 20, (5, 6)), rng.integers(0, 3, (5, 6))
    _, slope = tagger.gradients(model, windows, tags)
    for field in tagger.Tagger._fields:
        value = getattr(model, field)
        at = tuple(rng.integers(0, s) for s in value.shape)
        if field == "embed":
            at = (int(windows[0, 0]), 1)
        losses = []
        for step in (1e-5, -1e-5):
            moved = value.copy()
            moved[at] += step
            losses.append(tagger.gradients(model._replace(**{field: moved}), windows, tags)[0])
        assert (losses[0] - losses[1]) / 2e-5 == pytest.approx(getattr(slope, field)[at], abs=1e-5), field


def test_decoding_is_the_best_path():
    rng = np.random.default_rng(2)
    model = tagger.new_tagger(3, 4, 3, rng)._replace(trans=rng.normal(0, 1, (3, 3)), first=rng.normal(0, 1, 3))
    windows = rng.integers(0, 20, (4, 5))
    scores, paths = tagger.emissions(model, windows), tagger.decode(model, windows)
    for i in range(4):

        def worth(path):
            moves = sum(model.trans[a, b] for a, b in zip(path, path[1:]))
            return model.first[path[0]] + moves + sum(scores[i, t, s] for t, s in enumerate(path))

        assert worth(paths[i]) == pytest.approx(max(worth(p) for p in np.ndindex(*[3] * 5)))


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_tagger_adds_to_the_patterns(model):
    texts = ["call (171) 555-2028 and on", None, "", "version 2.0 of 3", "no data here", "4111111111111112 is no card"]
    found = [[s["kind"] for s in spans] for spans in pii.all_spans(texts, model)]
    assert found == [["phone"], [], [], [], [], []]


def test_windows_see_data_at_any_place(model):
    padding = "and the then of this that with for " * 4
    texts = [padding[: 7 * i] + " call (171) 555-2028 and on " + padding for i in range(15)]
    spans = [[text[s["start"] : s["end"]] for s in one] for text, one in zip(texts, pii.all_spans(texts, model))]
    assert sum(one == ["(171) 555-2028"] for one in spans) >= 8


def test_a_text_has_the_same_spans_in_any_company(model):
    texts = ["call +1 (222) 333-4444 now", "a@b.example.com", "the 10.1.2.3 of", "(171) 555-2028 " * 9]
    alone = [pii.all_spans([text], model)[0] for text in texts]
    assert pii.all_spans(texts, model) == alone


def test_query_against_brute_force(spark, small):
    rows = {r["doc_id"]: r for r in queries.op10_pii(spark, SMALL).collect()}
    for key, text in small.select("doc_id", "text").collect():
        spans = brute(text)
        joined = ",".join(":".join(map(str, span)) for span in spans)
        row = rows[key]
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [row[f"n_{kind}"] for kind in PATTERNS] == [sum(s[0] == kind for s in spans) for kind in PATTERNS]
        assert set(filter(None, joined.split(","))) <= set(row["spans"].split(","))


def test_redaction_and_odd_rows(spark, odd, no_rows, model):
    df = spark.createDataFrame([(1, "Mail a@b.com or +1 (222) 333-4444."), (2, "nothing")], "doc_id long, text string")
    texts = [r["text"] for r in sorted(pii.redact(df, model).collect())]
    assert texts == ["Mail [EMAIL] or [PHONE].", "nothing"]
    overlap = [{"kind": "card", "start": 2, "end": 6}, {"kind": "phone", "start": 4, "end": 8}]
    assert pii.redacted("0123456789", overlap) == "01[CARD]89"
    rows = pii.redact(odd, model).collect()
    assert len(rows) == odd.count() and {r["doc_id"]: r["text"] for r in rows}[1] is None
    assert pii.with_spans(no_rows, None).count() == 0 and pii.fit(no_rows) is None


OBFUSCATED = ["jane.doe (at) example.org", "jane[at]example.org", "bob.smith(at)mail.example.com"]


def test_addresses_without_digit_or_sign_at_every_placement(model):
    padding = "and the then of this that with for " * 8
    for data in OBFUSCATED:
        texts = [f"{padding[: 24 + i]} {data} {padding}" for i in range(pii.WINDOW)]
        spans = [[text[s["start"] : s["end"]] for s in one] for text, one in zip(texts, pii.all_spans(texts, model))]
        assert sum(one == [data] for one in spans) >= 0.9 * len(texts), data


def test_windows_passed_over_hold_no_valid_span(model, small):
    texts = [r["text"][:4000] for r in small.filter("text IS NOT NULL").orderBy("doc_id").limit(40).collect()]
    texts += ["x " * 30 + data + ".and-a-very-long-domain-that-goes-on-and-on" * 3 + ".org " + "y " * 30 for data in OBFUSCATED]
    texts += ["", "a", "1", "(at", "(at)", "a" * 11 + "1", "long.name." * 9 + "(at)example.com"]

    def accepted(every):
        found = pii.tagged_spans(texts, model, every)
        return [[s for s in spans if pii.valid(s[0], text[s[1] : s[2]].strip())] for text, spans in zip(texts, found)]

    assert accepted(False) == accepted(True) and any(accepted(False))


def test_training_from_texts_with_bracketed_signs_only(spark, monkeypatch):
    monkeypatch.setattr(pii, "TRAINING_BATCHES", 2)
    df = spark.createDataFrame([("jane[at]example.org",)], "text string")
    assert pii.fit(df) is not None
