"""Personal data: exact patterns, and a BiLSTM-CRF tagger that adds to them.

Patterns find e-mail addresses, IP addresses, payment cards and phone numbers in whole texts. The
tagger learns from spans the patterns label in a bounded sample of texts, and from the same kinds
of data written in ways the patterns do not cover (``(at)`` for ``@``, dots in card numbers,
phone numbers without a plus). It reads overlapping windows of every text, and each character
takes its tag from the window in which it lies most centrally, so spans are put together over
windows. A span of the tagger is widened to whole words and added if its digits or parts are valid for its kind and it
overlaps no span of a pattern. What is valid holds a digit, ``@`` or a bracketed ``at``; so the
windows these lie in are decoded, and from there the neighbours, as long as a span goes on. The
spans added are those that decoding every window would add.

Results for edge cases: null and empty texts have no spans; spans count code points, end
exclusive; without a sample to learn from only the patterns count; a text of any length is read
whole; equal texts get equal spans; an empty table gives an empty one. A column named as the
result is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm import tagger
from tablewright.llm import text_arrays as ta

KINDS = ("email", "ip", "card", "phone")
WINDOW = 48
STRIDE = 24
HIDDEN = 32
WIDTH = 16
# Texts with digits or @ that training windows are taken from, and windows of each.
SAMPLE_TEXTS = 2000
WINDOWS_PER_TEXT = 2
MADE_WINDOWS = 2400
TRAINING_BATCHES = 300
DECODED_WINDOWS = 2048

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)++")
# A match can only begin where a run of digits begins, and no run can be shortened.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
# Every span ``valid`` accepts holds one of these; the same in the syntax of Java.
_TRIGGER = r"[0-9@]|[(\[]at[)\]]"


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and (not part or int(part) <= 255)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches; each ``@`` is looked at once, so long runs cost linear time."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        else:
            # Characters before this sign can not be part of a later match.
            end = max(end, at)
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the patterns, by kind and start."""
    found = [("email", *span) for span in emails(text)]
    for match in _IP.finditer(text):
        if all(_byte(part) for part in match[0].split(".")):
            found.append(("ip", *match.span()))
    for match in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", match[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *match.span()))
    for match in _PHONE.finditer(text):
        if 8 <= len(_NOT_DIGIT.sub("", match[0])) <= 15:
            found.append(("phone", *match.span()))
    return found


def valid(kind: str, text: str) -> bool:
    """Whether a tagged span holds what its kind needs."""
    digits = _NOT_DIGIT.sub("", text)
    if kind == "email":
        return bool(re.fullmatch(r"[A-Za-z0-9._%+-]+\s?(@|[(\[]at[)\]])\s?[A-Za-z0-9-]+(\s?\.\s?[A-Za-z0-9-]+)+", text))
    if kind == "ip":
        parts = _NOT_DIGIT.split(text)
        return len(parts) == 4 and all(part and _byte(part) for part in parts)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and bool(re.search(r"[\x20().-]", text)) and not re.search(r"[A-Za-z]", text)


# Tags: 0 outside, then beginning and inside of each kind.
TAGS = 1 + 2 * len(KINDS)


def tags_of(length: int, spans: list[tuple[str, int, int]]) -> np.ndarray:
    tags = np.zeros(length, np.int8)
    for kind, start, end in spans:
        low, high = max(start, 0), min(end, length)
        if low < high:
            tags[low:high] = 2 + 2 * KINDS.index(kind)
            if start >= 0:
                tags[start] = 1 + 2 * KINDS.index(kind)
    return tags


def _with_check_digit(digits: str) -> str:
    return next(digits + last for last in "0123456789" if luhn(digits + last))


def made_span(kind: str, rng: np.random.Generator) -> str:
    """Data of a kind as people also write it."""

    def numbers(count: int) -> str:
        return "".join(rng.choice(list("0123456789"), count))

    def name(low: int, high: int) -> str:
        if rng.random() < 0.5:  # like a word
            return "".join(rng.choice(list(("bcdfghjklmnprstvwxz", "aeiouy")[i % 2])) for i in range(rng.integers(low, high)))
        return "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(low, high)))

    if kind == "email":
        sign = rng.choice(["@", "@", "(at)", " (at) ", "[at]", " @ "])
        return f"{name(2, 8)}{rng.choice(['', '.', '_'])}{numbers(rng.integers(0, 4))}{name(1, 4)}{sign}{name(3, 9)}.{rng.choice(['example.com', 'com', 'org', 'net'])}"
    if kind == "ip":
        return rng.choice([".", ".", " . ", "-"]).join(str(rng.integers(0, 256)) for _ in range(4))
    if kind == "card":
        digits = _with_check_digit(numbers(15))
        sign = rng.choice(["", " ", "-", ".", "/"])
        return sign.join(digits[i : i + 4] for i in range(0, 16, 4))
    area, middle, last = numbers(3), numbers(3), numbers(4)
    return rng.choice([f"+1 ({area}) {middle}-{last}", f"({area}) {middle}-{last}", f"{area}-{middle}-{last}", f"00{numbers(2)} {area} {middle}{last}", f"{area}.{middle}.{last}"])


def training_set(rows: list[tuple[str, list[tuple[str, int, int]]]], seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and tags of the windows, and of windows with made data set into their text."""
    rng = np.random.Generator(np.random.PCG64(seed))
    letter = ta.letter_table()
    examples = [(text, spans) for text, spans in rows]
    plain = [re.sub(r"[0-9@+]+", "", text) for text, _ in rows] or [""]
    for number in range(MADE_WINDOWS):
        context = plain[rng.integers(len(plain))]
        kind = KINDS[number % len(KINDS)]
        data = made_span(kind, rng)
        # Set off by blanks, and also cut by either end of the window.
        start = int(rng.integers(-(len(data) // 2), WINDOW - min(len(data), WINDOW // 2)))
        before = context[: start - 1].rjust(start - 1) + " " if start > 0 else ""
        if rng.random() < 0.3:  # numbers that are no personal data
            data = rng.choice([data[: len(data) // 3], "".join(rng.choice(list("0123456789abcdef"), 24)), f"{rng.integers(100)}.{rng.integers(10)}"])
            spans = []
        else:
            spans = [(kind, start, start + len(data))]
        examples.append((before + data[max(-start, 0) :] + " " + context[max(start, 0) :], spans))
    windows = np.full((len(examples), WINDOW), tagger.PADDING, np.int16)
    tags = np.zeros((len(examples), WINDOW), np.int8)
    for i, (text, spans) in enumerate(examples):
        codes = ta.flatten([text[:WINDOW]]).codes
        windows[i, : len(codes)] = tagger.symbols(codes, letter)
        tags[i] = tags_of(WINDOW, spans)
    return windows, tags


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows around the spans and other digits of each text, with the spans in them."""
    for batch in batches:
        for _, texts in ta.text_slices(batch):
            windows, labels = [], []
            for text in texts:
                spans = base_spans(text)
                marks = [span[1] for span in spans] + [m.start() for m in re.finditer(r"[0-9]+", text)]
                places = np.random.Generator(np.random.PCG64(len(text))).permutation(len(marks))
                places = sorted(places, key=lambda i: i >= len(spans))[:WINDOWS_PER_TEXT]  # spans first
                for i in places:
                    start = max(0, marks[i] - (marks[i] * 7 + i) % (WINDOW // 2))
                    windows.append(text[start : start + WINDOW])
                    inside = [(k, a - start, b - start) for k, a, b in spans if a < start + WINDOW and b > start]
                    labels.append(";".join(f"{k},{a},{b}" for k, a, b in inside))
            yield pa.RecordBatch.from_arrays([pa.array(windows, pa.string()), pa.array(labels, pa.string())], names=["text", "spans"])


def fit(documents: DataFrame, text: str = "text", sample_texts: int = SAMPLE_TEXTS) -> tagger.Tagger | None:
    """Train on windows of about ``sample_texts`` texts that hold digits, ``@`` or ``(at)``."""
    rows = documents.select(F.col(text).alias("text")).filter(F.col("text").rlike(_TRIGGER))
    count = rows.count()
    if not count:
        return None
    share = min(1.0, sample_texts / count)
    drawn = rows.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(share * (1 << 30)))
    # Copies of a text share a hash and are drawn together, so one of each is enough.
    windows = drawn.mapInArrow(_sample, "text string, spans string").distinct().toPandas()
    windows = windows.sort_values(["text", "spans"]).head(2 * sample_texts * WINDOWS_PER_TEXT)
    labelled = [
        (one, [(k, int(a), int(b)) for k, a, b in (x.split(",") for x in spans.split(";") if x)])
        for one, spans in zip(windows["text"], windows["spans"])
    ]
    symbols, tags = training_set(labelled)
    return tagger.train(symbols, tags.astype(np.int64), TAGS, HIDDEN, WIDTH, TRAINING_BATCHES)


def _triggers(codes: np.ndarray) -> np.ndarray:
    """Places of digits, of ``@`` and of the ``a`` of a bracketed ``at``."""
    marks = ((codes >= ord("0")) & (codes <= ord("9"))) | (codes == ord("@"))
    if len(codes) >= 4:
        opens, closes = (np.isin(part, [ord(x) for x in signs]) for part, signs in ((codes[:-3], "(["), (codes[3:], ")]")))
        marks[1:-2] |= opens & (codes[1:-2] == ord("a")) & (codes[2:-1] == ord("t")) & closes
    return np.flatnonzero(marks)


def tagged_spans(texts: list[str], model: tagger.Tagger, every: bool = False) -> list[list[tuple[str, int, int]]]:
    """Spans of the tagger in each text, before any check.

    With ``every`` all windows are decoded, else those that can hold a span ``valid`` accepts.
    """
    flat = ta.flatten(texts)
    found: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    marks = np.arange(len(flat.codes)) if every else _triggers(flat.codes)
    if not len(marks):
        return found
    # Window w of a text covers w * STRIDE up to w * STRIDE + WINDOW and tags the places that no
    # other one holds more centrally: those from MARGIN to MARGIN + STRIDE in it, and in the first
    # window of a text those before as well.
    margin = (WINDOW - STRIDE) // 2
    lengths = np.diff(flat.bounds)
    counts = np.maximum(-(-(lengths - margin) // STRIDE), lengths > 0)
    firsts = np.concatenate([[0], np.cumsum(counts)])
    text = ta.text_of(flat.bounds, marks)
    wanted = np.unique(firsts[text] + np.maximum((marks - flat.bounds[text] - margin) // STRIDE, 0))
    symbols = tagger.symbols(flat.codes, ta.letter_table())
    tag_of = np.zeros(len(flat.codes), np.int8)
    decoded = np.zeros(firsts[-1], bool)
    further = 1
    while len(wanted):
        reaching = []
        for at in range(0, len(wanted), DECODED_WINDOWS):
            some = wanted[at : at + DECODED_WINDOWS]
            text = ta.text_of(firsts, some)
            number = some - firsts[text]
            start, end = flat.bounds[text] + number * STRIDE, flat.bounds[text + 1]
            reach = start[:, None] + np.arange(WINDOW)
            inside = reach < end[:, None]
            tags = tagger.decode(model, np.where(inside, symbols[np.minimum(reach, len(symbols) - 1)], tagger.PADDING))
            low = start + np.where(number > 0, margin, 0)
            high = np.minimum(start + margin + STRIDE, end)
            own = (reach >= low[:, None]) & (reach < high[:, None])
            tag_of[reach[own]] = tags[own]
            # A span that reaches the end of these places, or did not begin in them, goes on.
            steps = np.arange(1, further + 1)
            onward = (tag_of[high - 1] > 0) & (high < end)
            back = (tag_of[low] > 0) & (tag_of[low] % 2 == 0) & (number > 0)
            reaching.append(np.minimum(some[onward, None] + steps, firsts[text[onward] + 1][:, None] - 1).ravel())
            reaching.append(np.maximum(some[back, None] - steps, firsts[text[back]][:, None]).ravel())
        decoded[wanted] = True
        wanted = np.unique(np.concatenate(reaching))
        wanted = wanted[~decoded[wanted]]
        further *= 2
    places = np.flatnonzero(tag_of)
    if not len(places):
        return found
    tags = tag_of[places]
    kind = (tags.astype(np.int64) - 1) // 2
    holder = ta.text_of(flat.bounds, places)
    begins = np.append(True, (kind[1:] != kind[:-1]) | (places[1:] != places[:-1] + 1) | (holder[1:] != holder[:-1]))
    begins |= tags % 2 == 1
    heads = np.flatnonzero(begins)
    tails = np.append(heads[1:], len(places)) - 1
    for head, tail in zip(heads, tails):
        base = flat.bounds[holder[head]]
        found[holder[head]].append((KINDS[kind[head]], int(places[head] - base), int(places[tail] - base) + 1))
    return found


_BEFORE = {"email": re.compile(r"[A-Za-z0-9._%+-]*\Z")}
# The name before a span that begins with its sign.
_SIGN = re.compile(r"\s?(?:@|[(\[]?at[)\]])")
_NAME = re.compile(r"[A-Za-z0-9._%+-]+\s?[(\[]?\Z")
_AFTER = {"email": re.compile(r"(?:[A-Za-z0-9-]|\.(?=[A-Za-z0-9]))*")}


def widened(kind: str, text: str, start: int, end: int) -> tuple[int, int]:
    """The span with the rest of the words it begins and ends in, up to a window on each side."""
    head = text[max(0, start - WINDOW) : start]
    before = _NAME.search(head) if kind == "email" and _SIGN.match(text, start, end) else None
    before = before or _BEFORE.get(kind, re.compile(r"[A-Za-z0-9]*\Z")).search(head)
    after = _AFTER.get(kind, re.compile(r"[A-Za-z0-9]*")).match(text[end : end + WINDOW])
    return start - len(before[0]), end + len(after[0])


def all_spans(texts: list[str | None], model: tagger.Tagger | None) -> list[list[dict]]:
    """Spans of patterns and tagger, by kind and start; ``base`` marks those of patterns."""
    filled = [text or "" for text in texts]
    tagged = tagged_spans(filled, model) if model else [[] for _ in filled]
    result = []
    for text, extra in zip(filled, tagged):
        base = base_spans(text)
        spans = [(KINDS.index(kind), start, end, True) for kind, start, end in base]
        for kind, start, end in extra:
            own = text[start:end]
            start, end = start + len(own) - len(own.lstrip()), end - len(own) + len(own.rstrip())
            for start, end in (widened(kind, text, start, end), (start, end)) if start < end else ():
                free = all(end <= low or high <= start for _, low, high in base)
                if free and valid(kind, text[start:end]):
                    spans.append((KINDS.index(kind), start, end, False))
                    break
        names = ("kind", "start", "end", "base")
        result.append([dict(zip(names, (KINDS[k], start, end, own))) for k, start, end, own in sorted(set(spans))])
    return result


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])
_SPANS_DDL = "array<struct<kind: string, start: int, end: int, base: boolean>>"


def with_spans(df: DataFrame, model: tagger.Tagger | None, text: str = "text") -> DataFrame:
    """``df`` with ``pii``: the spans of personal data in the text."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(_SPANS_DDL)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fitted = shared.value
        for batch in batches:
            rows: list[list[dict]] = []
            for low, high in ta.slices(ta.byte_lengths(batch)):
                rows += all_spans(batch.slice(low, high - low).to_pylist(), fitted)
            yield pa.array(rows, pa.list_(_SPAN))

    return df.withColumn("pii", find(F.col(text)))


def redacted(text: str, spans: list[dict]) -> str:
    """The text with ``[KIND]`` in place of each span; overlapping spans count as the first."""
    parts, at = [], 0
    for span in sorted(spans, key=lambda span: (span["start"], -span["end"])):
        if span["start"] >= at:
            parts += [text[at : span["start"]], f"[{span['kind'].upper()}]"]
        at = max(at, span["end"])
    return "".join([*parts, text[at:]])


def redact(df: DataFrame, model: tagger.Tagger | None, text: str = "text") -> DataFrame:
    """``df`` with the kind of data in place of each span of its text."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def replace(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fitted = shared.value
        for batch in batches:
            parts = []
            for low, high in ta.slices(ta.byte_lengths(batch)):
                texts = batch.slice(low, high - low).to_pylist()
                pairs = zip(texts, all_spans(texts, fitted))
                parts.append(pa.array([redacted(one, held) if held else one for one, held in pairs], pa.string()))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return df.withColumn(text, replace(F.col(text)))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda span: span["kind"] == kind)).cast("long")
