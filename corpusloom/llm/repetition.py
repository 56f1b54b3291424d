"""Repeated content inside one text.

The share is the part of a text's words (characters, for texts of few words) that lie in a
run of fixed length which also starts earlier in the text.  Histogram divergence from a
language's reference can't give that share (a text said twice has the histogram of the text
said once), so it is computed beside it, as a descriptor of looping texts.

Null and blank texts, and texts below the minimum lengths, have no share (null).
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.languages import MOST_SAMPLES, bounded

MIN_WORDS, WORD_RUN = 20, 5
MIN_CHARS, CHAR_RUN = 40, 10
FOUND_SHARE = 0.4
_DROP = re.compile(r"[^\w\s]|_")


def units_of(text: str) -> tuple[str | None, list[str] | str]:
    """('word', words), ('char', letters and digits) or (None, '') of a text."""
    reduced = _DROP.sub("", unicodedata.normalize("NFC", text).casefold())
    words = reduced.split()
    if len(words) >= MIN_WORDS:
        return "word", words
    chars = "".join(words)
    if len(chars) >= MIN_CHARS:
        return "char", chars
    return None, ""


def repeated_share(units, run: int) -> float:
    """Share of units inside a run of `run` units that also starts earlier."""
    n = len(units)
    seen: set = set()
    covered = reach = 0
    if isinstance(units, list):
        grams = zip(*[units[k:] for k in range(run)])
    else:
        grams = (units[k : k + run] for k in range(n - run + 1))
    for k, gram in enumerate(grams):
        if gram in seen:
            covered += k + run - max(k, reach)
            reach = k + run
        else:
            seen.add(gram)
    return covered / n if n else 0.0


def _reps(text: str | None) -> tuple[str | None, float | None]:
    if not text:
        return None, None
    kind, units = units_of(text)
    return kind, None if kind is None else repeated_share(units, WORD_RUN if kind == "word" else CHAR_RUN)


def repetition(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, unit, repeated_share) of each row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_reps(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([k for k, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], [key, "unit", "repeated_share"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, unit string, repeated_share double")


CLASSES = ["Lu", "Ll", "Lo", "Nd", "Zs", "Po", "other"]
COMMON_WORDS = 50


def char_histogram(text: str) -> list[float]:
    """Counts of character classes."""
    kinds = Counter(map(unicodedata.category, text))
    return [*(float(kinds.pop(c, 0)) for c in CLASSES[:-1]), float(sum(kinds.values()))]


def word_counts(text: str) -> Counter:
    return Counter(_DROP.sub("", text.casefold()).split())


def word_histogram(words: Counter, common: list[str]) -> list[float]:
    """Counts of the common words, and of all others together."""
    named = [float(words[w]) for w in common]
    return [*named, sum(words.values()) - sum(named)]


def js_distance(p: list[float], q: list[float]) -> float:
    """Jensen-Shannon distance (base 2) of two histograms; 1.0 if either is empty."""
    sp, sq = sum(p), sum(q)
    if not sp or not sq:
        return 1.0
    total = 0.0
    for a, b in zip(p, q):
        a, b = a / sp, b / sq
        m = (a + b) / 2
        if a:
            total += a * math.log2(a / m) / 2
        if b:
            total += b * math.log2(b / m) / 2
    return math.sqrt(max(0.0, total))


def divergence(df: DataFrame, key: str, text: str, references: DataFrame) -> DataFrame:
    """(key, language, js_chars, js_words) against the nearest language reference.

    references: (language, text), texts of known language, a fixed table of a few hundred
    rows.  Texts below the minimum lengths have nulls.
    """
    known: dict[str, list[str]] = {}
    for language, sample in bounded(references, ["language", "text"], MOST_SAMPLES):
        known.setdefault(language, []).append(sample)
    made = {}
    for language, texts in sorted(known.items()):
        words = word_counts(" ".join(texts))
        common = [w for w, _ in sorted(words.items(), key=lambda x: (-x[1], x[0]))[:COMMON_WORDS]]
        made[language] = (common, char_histogram(" ".join(texts)), word_histogram(words, common))

    def one(t: str | None):
        if not t or units_of(t)[0] is None:
            return None, None, None
        best, own, said = None, char_histogram(t), word_counts(t)
        for language, (common, chars, words) in made.items():
            got = (js_distance(own, chars), js_distance(word_histogram(said, common), words))
            if best is None or sum(got) < sum(best[1:]):
                best = (language, *got)
        return best or (None, None, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [one(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([f[k] for f in found], kind) for k, kind in ((0, pa.string()), (1, pa.float64()), (2, pa.float64()))]], [key, "language", "js_chars", "js_words"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, language string, js_chars double, js_words double")
