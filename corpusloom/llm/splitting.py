"""Ordered pieces of oversized texts.

A recursive hierarchy of separators (section, paragraph, line, sentence, word, character)
cuts a text into the largest units that are within the limit; units are packed greedily, and
each piece repeats up to `overlap` tokens from the end of the one before, cut at a
sentence or word, or between characters where there is neither.  Sizes are those of the pieces' own texts.

Null and empty texts, and texts within the limit, have no pieces.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from corpusloom.llm.bpe import DEFAULT_DIR, DEFAULT_VOCAB, ByteBpe, chunks, encoder

LIMIT, OVERLAP = 1024, 64
#: Tokens from which a pretoken is counted by what is left of it where it is cut.
LARGE = 16
LEVELS = ["section", "paragraph", "line", "sentence", "word", "character"]
#: White space from a line end on, and what a heading begins with: between them sections end.
_SPACE, _LINE_END, _HEADING = re.compile(r"[\r\n]\s++"), re.compile(r"\r\n|\r|\n"), re.compile(r"[ \t]*(?:#{1,6} |\d+[.)] |[IVXLC]+\.? ?[\r\n]|={3,}|-{3,}|\* \* \*)")
#: Where a unit of each level but the first and the last may end.  Runs of marks are only tried where they begin, so that each pattern is linear.
BORDERS = [
    None,
    re.compile(r"(?:\r\n|\r|\n)[ \t]*(?:\r\n|\r|\n)\s*"),
    re.compile(r"[\r\n\u0085  ]+"),
    re.compile(r"(?<![.!?…])[.!?…]++[\"'”’»)\]]*+(?=\s)|[。！？．｡]+[」』”’）]*"),
    re.compile(r"(?<=\S)(?=\s)|(?<=[、，,;；:：])"),
]


def sections(text: str) -> list[int]:
    """Where a line begins with a heading after an empty line."""
    out = []
    for run in _SPACE.finditer(text):
        lines = list(_LINE_END.finditer(text, *run.span()))
        if len(lines) > 1 and _HEADING.match(text, lines[-1].end()):
            out.append(lines[-1].end())
    return out


class _Text:
    """One text with the running count of tokens at its pretokens."""

    def __init__(self, text: str, starts: np.ndarray, sizes: np.ndarray, bpe: ByteBpe, overlap: int = 0):
        self.text, self.bpe, self.overlap = text, bpe, overlap
        self.starts = [*starts.tolist(), len(text)]
        self.sums = [0, *np.cumsum(sizes).tolist()]
        self._borders: dict[int, list[int]] = {}
        self._exact: dict[tuple[int, int], int] = {}

    def size(self, a: int, b: int) -> int:
        """Tokens of text[a:b]: of the pretokens it touches, large ones by what it has of them; never less than the real number."""
        first, last = bisect_right(self.starts, a) - 1, bisect_left(self.starts, b)
        total = self.sums[last] - self.sums[first]
        for k, x, y in ((first, a, min(b, self.starts[first + 1])), (last - 1, max(a, self.starts[last - 1]), b)):
            own = self.sums[k + 1] - self.sums[k]
            if own > LARGE and (x, y) != (self.starts[k], self.starts[k + 1]):
                total += self.exact(x, y) - own
            if last - 1 == first:
                break
        return total

    def exact(self, a: int, b: int) -> int:
        if (a, b) not in self._exact:
            if len(self._exact) > 1000:
                self._exact.clear()
            self._exact[a, b] = int(self.bpe.counts([self.text[a:b]])[0])
        return self._exact[a, b]

    def borders(self, level: int, a: int, b: int) -> list[int]:
        """Where units of a level may end strictly inside text[a:b]."""
        if level >= 3:  # many: only looked for where needed
            return sorted({m.end() for m in BORDERS[level].finditer(self.text, a, min(b + 1, len(self.text)))} - {a, b, b + 1})
        if level not in self._borders:
            self._borders[level] = [m.end() for m in BORDERS[level].finditer(self.text)] if level else sections(self.text)
        marks = self._borders[level]
        return marks[bisect_right(marks, a) : bisect_left(marks, b)]

    def units(self, a: int, b: int, limit: int, level: int = 0) -> list[tuple[int, int, int]]:
        """(from, to, level of its end) of the largest units within the limit, in order."""
        if self.size(a, b) <= limit:
            return [(a, b, level)]
        if level == len(BORDERS):
            return self._characters(a, b, limit - self.overlap)
        cuts = [a, *self.borders(level, a, b), b]
        out: list[tuple[int, int, int]] = []
        for x, y in zip(cuts, cuts[1:]):
            if self.size(x, y) <= limit:
                out.append((x, y, level))
                continue
            out += self.units(x, y, limit, level + 1)
            if y < b:
                out[-1] = (out[-1][0], y, level)
        return out

    def _characters(self, a: int, b: int, limit: int) -> list[tuple[int, int, int]]:
        """Cuts a run without any boundary where a token and a character end together.

        Tokens that stay neighbours stay the right ones, so a cut between two tokens
        leaves both sides with just the tokens they had.
        """
        tokens, places = self._clean_cuts(a, b)
        out, begin, done = [], a, 0
        while begin < b:
            k = int(np.searchsorted(tokens, done + limit, side="right")) - 1
            k = max(k, int(np.searchsorted(tokens, done, side="right")))
            done, end = int(tokens[k]), int(places[k])
            out.append((begin, end, len(BORDERS)))
            begin = end
        return out

    def _clean_cuts(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(number of tokens before, place) of each place in text[a:b], its end included, where a token and a character end together."""
        run = self.text[a:b]
        ids, _ = self.bpe.encode([run])
        raw = np.frombuffer(run.encode(), np.uint8)
        chars = np.concatenate([np.cumsum((raw & 0xC0) != 0x80), [len(run) + 1]])
        ends = np.cumsum(np.array(self.bpe.bytes)[ids])
        tokens = np.flatnonzero(chars[ends] > chars[ends - 1]) + 1  # the next byte begins a character
        return tokens, a + chars[ends[tokens - 1] - 1]

    def overlap_from(self, a: int, b: int, room: int) -> int:
        """Where text[a:b] ends with at most `room` tokens: at a sentence, else a word, else between two characters of a run without either, else nowhere (b)."""
        first = self.starts[max(0, bisect_left(self.sums, self.sums[bisect_left(self.starts, b)] - room))]
        for level in (3, 4):
            for x in self.borders(level, max(first - 1, a), b):
                if x >= first and self.size(x, b) <= room:
                    return x
        last = bisect_left(self.starts, b) - 1
        if room > 0 and self.sums[last + 1] - self.sums[last] > LARGE:
            tokens, places = self._clean_cuts(max(a, self.starts[last], b - room * self.bpe.longest), b)
            for x in places[tokens >= tokens[-1] - room].tolist():
                if a < x < b and self.exact(x, b) <= room:
                    return x
        return b

    def pieces(self, limit: int, overlap: int) -> list[tuple[int, int, int, int]]:
        """(from, to, level of its end, from where it is new) of each piece."""
        out: list[tuple[int, int, int, int]] = []
        begin = fresh = end = 0
        level = 0
        for a, b, kind in self.units(0, len(self.text), limit):
            if end > begin and self.size(begin, b) > limit:
                out.append((begin, end, level, fresh))
                fresh = end
                begin = self.overlap_from(begin, end, overlap)
                while begin < end and self.size(begin, b) > limit:
                    begin = self.overlap_from(begin, end, self.size(begin, end) - 1)
            end, level = b, kind
        if end > begin:
            out.append((begin, end, level, fresh))
        return out


def split_oversized(df: DataFrame, key: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP, directory: str = DEFAULT_DIR, vocab: str = DEFAULT_VOCAB) -> DataFrame:
    """(key, piece_no, start_char, end_char, overlap_chars, n_tokens, ends_at, text) of each text above the limit.

    piece_no counts from 1; offsets are code points; the first overlap_chars of a piece are
    the end of the one before.  Each text is handled where it is read, without a shuffle.
    """
    columns = [key, "piece_no", "start_char", "end_char", "overlap_chars", "n_tokens", "ends_at", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(directory, vocab)
        for batch in batches:
            # a token has at least one byte, so shorter texts needn't be encoded
            lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0)
            large = np.flatnonzero(lengths.to_numpy(zero_copy_only=False) > limit).tolist()
            texts = dict(zip(large, batch.column(1).take(pa.array(large, pa.int64())).to_pylist()))
            for a, b in chunks([texts[k] for k in large]):
                some = large[a:b]
                rows: list[tuple] = []
                for k, (starts, sizes) in zip(some, bpe.word_counts([texts[k] for k in some])):
                    if sizes.sum() <= limit:
                        continue
                    t = _Text(texts[k], starts, sizes, bpe, overlap)
                    found = t.pieces(limit, overlap)
                    sizes = bpe.counts([t.text[x:y] for x, y, _, _ in found]).tolist()
                    rows += [(k, no, x, y, new - x, n, "end" if y == len(t.text) else LEVELS[level], t.text[x:y]) for no, ((x, y, level, new), n) in enumerate(zip(found, sizes), 1)]
                if rows:
                    cols = list(zip(*rows))
                    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(cols[0])), *[pa.array(c, k) for c, k in zip(cols[1:], kinds)]], columns)

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, piece_no int, start_char bigint, end_char bigint, overlap_chars bigint, n_tokens bigint, ends_at string, text string")
