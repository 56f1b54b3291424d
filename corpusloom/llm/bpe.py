"""Exact byte-level BPE in linear time.

A text is cut into pretokens with array operations over its code points (the split
pattern of the published rank files, restated as class-change rules).  Each distinct
pretoken is encoded once per worker by the backtracking encoder: an Aho-Corasick pass
proposes the longest token at every step, and a proposal stands if the pair-compatibility
table allows it beside its left neighbour; otherwise the encoder falls back to the next
shorter token, or drops the neighbour.  A sequence whose neighbours are all compatible is
the only one the merge rules can produce, so the result is exact.

Defined cases: null and empty texts have no ids.  Strings that look like special tokens
are ordinary text.  Lone surrogates can't occur in Spark strings.
"""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache

import numpy as np

DEFAULT_DIR = "/opt/tokenizers"
DEFAULT_VOCAB = "byte_bpe_50k.tiktoken"

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
# Code points with the Unicode property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Endings that the split pattern keeps with their apostrophe.
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]
#: Characters that are handled side by side.
BLOCK = 1 << 20
_SAFE_CUT = re.compile(r"\S(?= \S)|[^\W\d_](?=[^\w\s'])")
#: Stands between pretokens in one automaton pass; no byte.
BREAK = "\u0100"
#: Entries a worker keeps; beyond that it starts anew.  Only speed depends on it.
CACHE_WORDS = 150_000
CACHE_CHARS = 24


@lru_cache(1)
def class_table() -> np.ndarray:
    """Class of every code point: letter, number, white space or other."""
    import unicodedata

    table = np.zeros(0x110000, np.uint8)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind == "L":
            table[cp] = LETTER
        elif kind == "N":
            table[cp] = NUMBER
    table[WHITE_SPACE] = SPACE
    return table


def pretoken_starts(points: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Positions in `points` where a pretoken starts.

    points: code points of several texts, one after the other; begins: where each text
    starts (ascending, no empty text).
    """
    n = len(points)
    kind = class_table()[points]
    first = np.zeros(n, bool)
    first[begins] = True
    last = np.ones(n, bool)
    last[:-1] = first[1:]
    space = kind == SPACE
    blank = points == 0x20
    before = np.empty(n, np.uint8)
    before[0] = 255
    before[1:] = kind[:-1]
    before[first] = 255
    after_blank = np.zeros(n, bool)
    after_blank[1:] = blank[:-1]
    after_blank &= ~first
    # A run of one class starts a pretoken, or has its leading blank start it.
    start = (kind != before) & ~after_blank
    start &= ~space | (before != SPACE)
    # The last white space before something else stands alone or leads the next run.
    lead = np.zeros(n, bool)
    lead[:-1] = space[:-1] & ~space[1:] & ~first[1:]
    start |= lead
    # Contractions: an apostrophe that starts its pretoken takes its ending along.
    marks = np.flatnonzero(start & (points == 0x27) & ~last)
    for m in marks.tolist():
        stop = m + 1
        while stop < n and stop <= m + 2 and not first[stop]:
            stop += 1
        tail = "".join(map(chr, points[m + 1 : stop].tolist()))
        hit = next((c for c in CONTRACTIONS if tail.startswith(c)), None)
        if hit:
            start[m + 1 : m + 1 + len(hit)] = False
            end = m + 1 + len(hit)
            if end < n:
                start[end] |= bool(kind[end] == LETTER)
    return np.flatnonzero(start)


def distinct_spans(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One representative of each distinct span of `points`, and for each span its representative's number.

    Spans are grouped by a 64-bit hash and then compared with their representative point
    by point; a span that only shares the hash represents itself.
    """
    n = len(points)
    powers, inverses = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * powers[:n], out=sums[1:])
    value = (sums[ends] - sums[starts]) * inverses[starts]
    value ^= value >> np.uint64(29)
    _, sample, inverse = np.unique(value, return_index=True, return_inverse=True)
    size = ends - starts
    shift = starts[sample][inverse] - starts
    at = np.arange(starts[0] if len(starts) else 0, n)
    same = points[np.minimum(at + np.repeat(shift, size), n - 1)] == points[at]
    odd = ~np.logical_and.reduceat(same, starts - at[0]) | (size[sample][inverse] != size)
    if odd.any():
        strays = np.flatnonzero(odd)
        inverse[strays] = len(sample) + np.arange(len(strays))
        sample = np.concatenate([sample, strays])
    return sample, inverse


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        base = 0x9E3779B97F4A7C15
        for k, b in enumerate((base, pow(base, -1, 1 << 64))):
            grown = np.full(max(n, 1 << 20), b, np.uint64)
            grown[0] = 1
            _POWERS[k : k + 1] = [np.cumprod(grown)]
    return _POWERS[0], _POWERS[1]


def blocks(text: str) -> list[str]:
    """A long text in blocks, cut where a pretoken ends whatever follows: between a character
    and a lone blank, or between a letter and a mark."""
    out, begin = [], 0
    while len(text) - begin > BLOCK:
        cut, low, high = -1, begin + BLOCK // 2, begin + BLOCK
        while cut < 0 and low < len(text):
            for m in _SAFE_CUT.finditer(text, low, high):
                cut = m.end()
            low, high = high - 1, high + BLOCK
        if cut < 0:
            break
        out.append(text[begin:cut])
        begin = cut
    out.append(text[begin:])
    return out


class ByteBpe:
    """Encoder for one rank file."""

    def __init__(self, path: str):
        import ahocorasick

        self.rank: dict[str, int] = {}
        with open(path, "rb") as lines:
            for line in lines:
                token, number = line.split()
                self.rank[base64.b64decode(token).decode("latin-1")] = int(number)
        self.text = {number: token for token, number in self.rank.items()}
        self.longest = max(map(len, self.rank))
        self.automaton = ahocorasick.Automaton()
        for token, number in self.rank.items():
            self.automaton.add_word(token, number)
        self.automaton.make_automaton()
        most = max(self.text) + 1
        self.shorter = [self._longest_below(self.text.get(k, "")) for k in range(most)]
        self.bytes = [len(self.text.get(k, "")) for k in range(most)]
        self.longest = max(self.bytes)
        self.parts: dict[int, tuple[int, int]] = {}
        self.whole: dict[tuple[int, int], int] = {}
        self.beside: dict[tuple[int, int], bool] = {}
        self._learn_parts()
        self.reset()

    def reset(self) -> None:
        self.index: dict[str, int] = {}
        self.pool = np.empty(1 << 16, np.int32)
        self.used = 0
        self.at = np.empty(1 << 14, np.int64)
        self.size = np.empty(1 << 14, np.int32)
        self.count = 0

    def _longest_below(self, token: str) -> int:
        """The longest token that is a proper prefix, or -1."""
        for n in range(len(token) - 1, 0, -1):
            if (found := self.rank.get(token[:n])) is not None:
                return found
        return -1

    def _learn_parts(self) -> None:
        """The two tokens each token was merged from: the offset table of the merges."""
        for number in sorted(self.text):
            token = self.text[number]
            left = self.shorter[number]
            self.parts[number] = (number, number)
            while left >= 0:
                right = self.rank.get(token[len(self.text[left]) :], number)
                if left < number and right < number and self.fits(left, right, remember=False):
                    self.parts[number] = (left, right)
                    self.whole[left, right] = number
                    break
                left = self.shorter[left]

    def fits(self, left: int, right: int, remember: bool = True) -> bool:
        """Whether the merge rules can leave `left` and `right` side by side.

        They can't if some merge across the border would have come before the merges
        that built the two sides; walk both sides' merges back, latest first.
        """
        known = self.beside.get((left, right)) if remember else None
        if known is not None:
            return known
        a, b, before = left, right, 1 << 40
        fine = True
        while True:
            merged = self.whole.get((a, b))
            if merged is not None and merged < before:
                fine = False
                break
            inner_a, inner_b = self.parts[a][1], self.parts[b][0]
            if inner_a == a and inner_b == b:
                break
            # undo the later of the two merges; of equals, the one on the right, as merges run from the left
            if inner_b == b or (inner_a != a and a > b):
                before, a = a, inner_a
            else:
                before, b = b + 1, inner_b
        if remember:
            if len(self.beside) > 1_000_000:
                self.beside.clear()
            self.beside[left, right] = fine
        return fine

    def encode_pretoken(self, raw: str) -> list[int]:
        """Ids of one pretoken, given as its bytes in latin-1."""
        whole = self.rank.get(raw)
        if whole is not None:
            return [whole]
        out = [number for _, number in self.automaton.iter_long(raw)]
        fits = self.fits
        beside = self.beside.get
        for k in range(1, len(out)):
            known = beside((out[k - 1], out[k]))
            if not (fits(out[k - 1], out[k]) if known is None else known):
                return self._backtrack(raw, out[:k], out[k])
        return out

    def _longest_at(self, raw: str, at: int) -> int:
        rest = raw[at : at + self.longest]
        rank = self.rank.get
        for n in range(self.automaton.longest_prefix(rest), 0, -1):
            found = rank(rest[:n])
            if found is not None:
                return found
        raise AssertionError("every byte is a token")

    def _backtrack(self, raw: str, out: list[int], token: int) -> list[int]:
        """Goes on from `out`, whose neighbours are compatible, with `token` as the next proposal."""
        n = len(raw)
        size, shorter, beside, longest_at = self.bytes, self.shorter, self.beside.get, self._longest_at
        dead: set[int] = set()  # positions from which no compatible rest exists
        at = sum([size[t] for t in out])
        while True:
            end = at + size[token]
            if end not in dead:
                fits = True
                if out:
                    fits = beside((out[-1], token))
                    if fits is None:
                        fits = self.fits(out[-1], token)
                if fits:
                    out.append(token)
                    at = end
                    if at == n:
                        return out
                    token = longest_at(raw, at)
                    continue
            token = shorter[token]
            while token < 0:
                dead.add(at)
                token = out.pop()
                at -= size[token]
                token = shorter[token]

    def encode_pretokens(self, raws: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many pretokens (bytes in latin-1), one after the other, and how many each has.

        One automaton pass proposes the longest tokens of all; the compatibility of each
        distinct pair is looked up once; only pretokens with a pair that doesn't fit are
        gone through again.
        """
        joined = BREAK.join(raws)
        hits = list(self.automaton.iter_long(joined))
        ends = np.fromiter((e for e, _ in hits), np.int64, len(hits))
        ids = np.fromiter((t for _, t in hits), np.int64, len(hits))
        bounds = np.cumsum(np.fromiter(map(len, raws), np.int64, len(raws)) + 1)  # where each is over, with its break
        word = np.searchsorted(bounds, ends, side="right")
        size = np.bincount(word, minlength=len(raws))
        inside = np.flatnonzero(word[1:] == word[:-1])
        pairs, which = np.unique(ids[inside] << 20 | ids[inside + 1], return_inverse=True)
        fits = np.fromiter((self.fits(p >> 20, p & 0xFFFFF) for p in pairs.tolist()), bool, len(pairs))
        wrong = inside[~fits[which]]
        if len(wrong):
            begin = np.cumsum(size) - size
            bad, first = np.unique(word[wrong], return_index=True)
            parts, last = [], 0
            for k, at in zip(bad.tolist(), (wrong[first] + 1).tolist()):
                b = int(begin[k])
                fixed = self._backtrack(raws[k], ids[b:at].tolist(), int(ids[at]))
                parts += [ids[last:b], np.array(fixed, np.int64)]
                last = b + int(size[k])
                size[k] = len(fixed)
            ids = np.concatenate([*parts, ids[last:]])
        return ids, size

    def _learn(self, words: list[str]) -> int:
        """Adds entries for `words` and gives the number of the first."""
        ids, size = self.encode_pretokens([w.encode().decode("latin-1") for w in words])
        k, more, n = self.count, len(words), len(ids)
        if self.used + n > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty(max(len(self.pool), n), np.int32)])
        if k + more > len(self.at):
            room = max(len(self.at), more)
            self.at = np.concatenate([self.at, np.empty(room, np.int64)])
            self.size = np.concatenate([self.size, np.empty(room, np.int32)])
        self.pool[self.used : self.used + n] = ids
        self.at[k : k + more] = self.used + np.cumsum(size) - size
        self.size[k : k + more] = size
        self.used += n
        self.count = k + more
        self.index.update((w, k + j) for j, w in enumerate(words) if len(w) <= CACHE_CHARS)
        return k

    def _words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of non-empty texts: the entry of each pretoken, its start, and where each text begins."""
        if self.count > CACHE_WORDS:
            self.reset()
        size = np.array([len(t) for t in texts], np.int64)
        begins = np.cumsum(size) - size
        parts = [p for t in texts for p in blocks(t)] if size.max() > BLOCK else texts
        entries, starts, done = [], [], 0
        for a, b in chunks(parts, BLOCK):
            entry, start, n = self._block(parts[a:b])
            entries.append(entry)
            starts.append(start + done)
            done += n
        return np.concatenate(entries), np.concatenate(starts), begins

    def _block(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
        """(entry of each pretoken, its start, number of characters) of texts that fit in memory side by side."""
        joined = "".join(texts)
        begins = np.zeros(len(texts), np.int64)
        np.cumsum([len(t) for t in texts[:-1]], out=begins[1:])
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        starts = pretoken_starts(points, begins)
        ends = np.append(starts[1:], len(points))
        sample, inverse = distinct_spans(points, starts, ends)
        get = self.index.get
        words = [joined[a:b] for a, b in zip(starts[sample].tolist(), ends[sample].tolist())]
        entry = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        missed = np.flatnonzero(entry < 0)
        if len(missed):
            entry[missed] = self._learn([words[k] for k in missed.tolist()]) + np.arange(len(missed))
        return entry[inverse], starts, len(joined)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the offsets of each text (one more than texts)."""
        full = [k for k, t in enumerate(texts) if t]
        lengths = np.zeros(len(texts) + 1, np.int64)
        if not full:
            return np.empty(0, np.int32), lengths
        entry, starts, begins = self._words([texts[k] for k in full])
        size = self.size[entry].astype(np.int64)
        offset = np.concatenate([[0], np.cumsum(size)])
        ids = self.pool[np.repeat(self.at[entry] - offset[:-1], size) + np.arange(offset[-1])]
        word_at = np.searchsorted(starts, begins)
        lengths[np.array(full) + 1] = np.add.reduceat(size, word_at)
        return ids, np.cumsum(lengths)

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """Number of ids of each text."""
        full = [k for k, t in enumerate(texts) if t]
        out = np.zeros(len(texts), np.int64)
        if full:
            entry, starts, begins = self._words([texts[k] for k in full])
            out[full] = np.add.reduceat(self.size[entry].astype(np.int64), np.searchsorted(starts, begins))
        return out

    def word_counts(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of non-empty texts: start (in code points) and number of ids of each pretoken."""
        entry, starts, begins = self._words(texts)
        size = self.size[entry].astype(np.int64)
        at = [*np.searchsorted(starts, begins).tolist(), len(starts)]
        return [(starts[a:b] - c, size[a:b]) for a, b, c in zip(at, at[1:], begins.tolist())]

    def decode(self, ids) -> str:
        return "".join(self.text[int(k)] for k in ids).encode("latin-1").decode("utf-8", "replace")


@lru_cache(4)
def encoder(directory: str = DEFAULT_DIR, name: str = DEFAULT_VOCAB) -> ByteBpe:
    """One encoder per worker process and vocabulary."""
    return ByteBpe(os.path.join(directory, name))


def chunks(texts: list[str | None], most_chars: int = 1 << 20):
    """(from, to) of stretches of `texts` of about so many characters; a longer text is a stretch of its own."""
    begin = total = 0
    for k, t in enumerate(texts):
        n = len(t) if t else 0
        if total and total + n > most_chars:
            yield begin, k
            begin, total = k, 0
        total += n
    if begin < len(texts):
        yield begin, len(texts)


def byte_chunks(column, most_bytes: int = 1 << 20):
    """(from, to) of stretches of an Arrow string column of about so many bytes, so that Python holds no more of it at once."""
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < len(ends):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + most_bytes, side="right")))
        yield begin, end
        begin = end
