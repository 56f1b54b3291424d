"""Language of texts and of the runs of mixed texts, by prediction by partial matching.

Each language has a tree of byte contexts of order 0 to ORDER, counted on texts of known
language and then frozen.  A byte's code length is found in the longest context that has
seen it, plus the escapes (method C) from the longer ones, down to a uniform order -1.  With
frozen counts the code length of a byte depends on ORDER + 1 bytes only, so it is looked up
once for each distinct window of a batch.

A text's language has the shortest code.  Where sentences disagree, or the bytes of a sentence
do, the cheapest sequence of languages is sought, with a price for each change that is low
between sentences and high inside one; its runs are the segments of a mixed text.  A sentence is
cut into words if some stretch of it is so much shorter in another language that a change might
pay, whatever its length.  What stands in brackets or quotation marks counts for no language.

The trees are frozen on the driver, once, and broadcast; their size is bounded by that of the
training table, which is checked.

Null and blank texts and texts without letters have no language.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.bpe import LETTER, chunks, class_table

ORDER = 5
#: Bits that a change of language costs between sentences, and inside one.
CHANGE, CHANGE_INSIDE = 14.0, 70.0
#: Letters from which a label is judged, and the lower number for languages written densely.
MIN_LETTERS, MIN_DENSE = 30, 12
DENSE = ["ja", "ko", "zh"]
#: Rows of the training table at most.
MOST_SAMPLES = 100_000

_ASIDE = re.compile(r"\([^()]*\)|\[[^\[\]]*\]|（[^（）]*）|【[^【】]*】|「[^「」]*」|『[^『』]*』|《[^《》]*》|“[^“”]*”|„[^„“”]*[“”]|«[^«»]*»|\"[^\"]*\"|<[^<>]*>|♪[^♪]*♪")
_BOUND = re.compile(r"[.!?…]+[\"'”’»)\]]*\s+|[。！？]+[」』）”]*\s*|[\r\n]+\s*|\s+/\s+")
_STUTTER = re.compile(r"(\S{2,20}?)\1{3,}")
_FRAGMENT = re.compile(r"\s*[^\W\d_\u3040-\u9fff\uac00-\ud7af]*[,;:]?\s*[^\W\d_\u3040-\u9fff\uac00-\ud7af]*[,;:]?\s*")
_WORD = re.compile(r"\s+|(?<=[、，；：])")


class Ppm:
    """Frozen context trees of all languages, as sorted arrays by order."""

    def __init__(self, samples: list[tuple[str, str]], order: int = ORDER):
        self.order = order
        self.names = sorted({language for language, _ in samples})
        counts = [defaultdict(Counter) for _ in self.names]  # (order, context) -> symbols
        place = {n: k for k, n in enumerate(self.names)}
        for language, text in samples:
            raw = b"\n" * order + plain(text).encode()
            seen = counts[place[language]]
            for i in range(order, len(raw)):
                for o in range(order + 1):
                    seen[raw[i - o : i]][raw[i]] += 1
        n = len(self.names)
        tables: list[dict[int, np.ndarray]] = [{} for _ in range(order + 1)]
        escapes: list[dict[int, np.ndarray]] = [{} for _ in range(order + 1)]
        for k, seen in enumerate(counts):
            for context, symbols in seen.items():
                o, total, kinds = len(context), sum(symbols.values()), len(symbols)
                packed = int.from_bytes(context, "big")
                escapes[o].setdefault(packed, np.zeros(n, np.float32))[k] = math.log2((total + kinds) / kinds)
                for symbol, count in symbols.items():
                    row = tables[o].setdefault(packed << 8 | symbol, np.full(n, np.nan, np.float32))
                    row[k] = math.log2((total + kinds) / count)
        self.tables = [self._sorted(t, n) for t in tables]
        self.escapes = [self._sorted(t, n) for t in escapes]

    @staticmethod
    def _sorted(rows: dict[int, np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
        keys = np.array(sorted(rows), np.uint64)
        return keys, np.array([rows[int(k)] for k in keys], np.float32).reshape(len(keys), n)

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in `wanted` that are in `keys`, and where."""
        at = np.searchsorted(keys, wanted)
        at[at == len(keys)] = 0
        hit = np.flatnonzero(keys[at] == wanted)
        return hit, at[hit]

    def costs(self, windows: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each distinct window of ORDER + 1 bytes, for each language."""
        total = np.zeros((len(windows), len(self.names)), np.float32)
        left = np.ones(total.shape, bool)
        for o in range(self.order, -1, -1):
            mask = np.uint64((1 << 8 * (o + 1)) - 1)
            keys, values = self.tables[o]
            hit, at = self._find(keys, windows & mask)
            known = np.zeros(total.shape, bool)
            if len(hit):
                found = values[at]
                ok = ~np.isnan(found) & left[hit]
                total[hit] += np.where(ok, found, 0)
                known[hit] = ok
            left &= ~known
            keys, values = self.escapes[o]
            hit, at = self._find(keys, (windows & mask) >> np.uint64(8))
            if len(hit):
                total[hit] += np.where(left[hit], values[at], 0)
        return total + 8.0 * left

    def bits(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(costs of the distinct windows, for each byte its window, where each text begins), texts joined without their padding."""
        pad = b"\n" * self.order
        joined = np.frombuffer(b"".join(pad + r for r in raws), np.uint8)
        window = np.zeros(len(joined), np.uint64)
        for o in range(self.order + 1):
            window[o:] |= joined[: len(joined) - o].astype(np.uint64) << np.uint64(8 * o)
        size = np.array([len(r) for r in raws], np.int64)
        begin = np.cumsum(size) - size
        inner = np.repeat(np.arange(1, len(raws) + 1) * self.order, size) + np.arange(size.sum())
        distinct, inverse = np.unique(window[inner], return_inverse=True)
        return self.costs(distinct), inverse, begin


def plain(text: str) -> str:
    """The text in lower case without what stands in brackets or quotation marks, unless nothing else has letters."""
    low = unicodedata.normalize("NFC", text.lower())
    bare = _ASIDE.sub(" ", low)
    return bare if any(map(str.isalpha, bare)) else low


def without_loops(text: str) -> str:
    """The text with what is said several times on end said once: words, and stuttered parts of words."""
    parts = _STUTTER.sub(r"\1\1", text)
    spoken = re.findall(r"\s*\S+\s*", parts)
    return "".join(w for k, w in enumerate(spoken) if not k or w != spoken[k - 1])


def units(text: str) -> list[str]:
    """Sentences of a text with the marks and white space after them."""
    cuts = [0, *(m.end() for m in _BOUND.finditer(text))]
    if cuts[-1] < len(text):
        cuts.append(len(text))
    return [text[a:b] for a, b in zip(cuts, cuts[1:]) if b > a]


def best_path(costs: np.ndarray, change: np.ndarray) -> list[int]:
    """Cheapest sequence of languages over units; change[k]: price of a change before unit k."""
    n, m = costs.shape
    back = np.zeros((n, m), np.int64)
    total = costs[0].astype(np.float64)
    own = np.arange(m)
    for k in range(1, n):
        low = int(total.argmin())
        switched = total[low] + change[k]
        stay = total <= switched
        back[k] = np.where(stay, own, low)
        total = np.where(stay, total, switched) + costs[k]
    path = [int(total.argmin())]
    for k in range(n - 1, 0, -1):
        path.append(int(back[k, path[-1]]))
    return path[::-1]


def _block_starts(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where sentences and parts between blanks begin, and in other writing than ASCII every character: all places where a word may begin are among them."""
    before, here = raw[:-1], raw[1:]
    cut = np.zeros(len(raw), bool)
    cut[1:] = (before <= 32) | (here >= 0xC0) | (before >= 0x80) & (here < 0x80)
    cut[starts] = True
    return np.flatnonzero(cut)


def _gain_inside(bits: np.ndarray, opens: np.ndarray, best: np.ndarray) -> np.ndarray:
    """The most bits that another language saves on a stretch of each sentence, against the sentence's best language.

    bits: of each block for each language; opens: each sentence's first block.
    """
    sizes = np.diff(np.append(opens, len(bits)))
    own = bits[np.arange(len(bits)), np.repeat(best, sizes)]
    most = np.zeros(len(sizes))
    for k in range(bits.shape[1]):
        gain = own - bits[:, k]
        before = np.cumsum(gain) - gain
        before -= np.repeat(before[opens], sizes)
        step = np.repeat(np.arange(len(sizes)) * (np.ptp(before) + 1), sizes)  # lowers each sentence below the last, so the running least begins anew
        up = before + gain - (np.minimum.accumulate(before - step) + step)
        most = np.maximum(most, np.maximum.reduceat(up, opens))
    return most


class Identifier:
    def __init__(self, samples: list[tuple[str, str]]):
        self.ppm = Ppm(samples)

    def runs(self, texts: list[str]) -> list[list[tuple[str, float]]]:
        """(language, confidence) of each maximal run of sentences of one language, per non-blank text."""
        parts = [units(plain(t)) or [" "] for t in texts]
        raws = [u.encode() for p in parts for u in p]
        per_text = np.array([len(p) for p in parts])
        sizes = np.array([len(r) for r in raws], np.int64)
        first = np.cumsum(per_text) - per_text
        wholes = [b"".join(raws[a : a + n]) for a, n in zip(first.tolist(), per_text.tolist())]
        table, window, _ = self.ppm.bits(wholes)
        starts = np.cumsum(sizes) - sizes
        blocks = _block_starts(np.frombuffer(b"".join(raws), np.uint8), starts)
        bits = np.empty((len(blocks), len(self.ppm.names)))
        for k, column in enumerate(np.ascontiguousarray(table.T)):
            bits[:, k] = np.add.reduceat(column[window], blocks)
        opens = np.searchsorted(blocks, starts)
        cost = np.add.reduceat(bits, opens)
        total = np.add.reduceat(cost, first)
        best = cost.argmin(1)
        divided = _gain_inside(bits, opens, best) > CHANGE_INSIDE / 2
        settled = np.logical_and.reduceat((best == np.repeat(total.argmin(1), per_text)) & ~divided, first)
        out: list[list[tuple[str, float]]] = []
        for k, done in enumerate(settled.tolist()):
            a, n = int(first[k]), int(per_text[k])
            if not done and (short := without_loops(texts[k])) != texts[k]:
                out += self.runs([short])  # what is said over and over is no sentence of its own
                continue
            out.append([self._run(total[k])] if done else self._search(parts[k], cost[a : a + n], divided[a : a + n], table, window, starts[a : a + n]))
        return out

    def _run(self, bits: np.ndarray) -> tuple[str, float]:
        gap = np.minimum(bits - bits.min(), 60)
        return self.ppm.names[int(bits.argmin())], float(1 / np.exp2(-gap).sum())

    def _search(self, sentences: list[str], cost: np.ndarray, divided: np.ndarray, table: np.ndarray, window: np.ndarray, starts: np.ndarray) -> list[tuple[str, float]]:
        rows, change = [], []
        for k, s in enumerate(sentences):
            change.append(CHANGE)
            if not divided[k]:
                rows.append(np.zeros((1, cost.shape[1])) if _FRAGMENT.fullmatch(s) else cost[k : k + 1])  # a fragment is too little to be a sentence: no evidence
                continue
            cuts = [0, *(m.end() for m in _WORD.finditer(s)), len(s)]
            size = np.array([n for a, b in zip(cuts, cuts[1:]) if (n := len(s[a:b].encode()))])
            at = int(starts[k])
            rows.append(np.add.reduceat(table[window[at : at + int(size.sum())]].astype(np.float64), np.cumsum(size) - size))
            change += [CHANGE_INSIDE] * (len(size) - 1)
        bits = np.concatenate(rows)
        path = best_path(bits, np.array(change))
        out = []
        a = 0
        for b in range(1, len(path) + 1):
            if b == len(path) or path[b] != path[a]:
                name, gap = self.ppm.names[path[a]], bits[a:b].sum(0)
                out.append((name, float(1 / np.exp2(-np.clip(gap - gap[path[a]], -60, 60)).sum())))
                a = b
        return out


def letters(texts: list[str]) -> np.ndarray:
    """Number of Unicode letters of each text (none empty)."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    size = np.array([len(t) for t in texts])
    return np.add.reduceat((class_table()[points] == LETTER).astype(np.int64), np.cumsum(size) - size)


def label_key(label: str) -> str:
    return label.strip().lower().replace("-", "_")


def bounded(df: DataFrame, columns: list[str], most: int) -> list[tuple]:
    """All rows of a fixed table on the driver; more than `most` are an error."""
    rows = df.select(*columns).where(" and ".join(f"{c} is not null" for c in columns)).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows of {columns}")
    return sorted(map(tuple, rows))


def identify(df: DataFrame, key: str, text: str, label: str, samples: DataFrame, aliases: DataFrame) -> DataFrame:
    """(key, segment_no, language, confidence, letters, runs, labelled): the languages of each text with letters.

    segment_no is 0 for a text of one language; the runs of a mixed text are numbered from
    1.  labelled is the language that the label stands for, null for none.  samples and
    aliases are fixed tables of at most MOST_SAMPLES rows.
    """
    names = {label_key(a): language for a, language in bounded(aliases, ["alias", "language"], MOST_SAMPLES)}
    frozen = df.sparkSession.sparkContext.broadcast(Identifier(bounded(samples, ["language", "text"], MOST_SAMPLES)))
    columns = [key, "segment_no", "language", "confidence", "letters", "runs", "labelled"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frozen.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            labels = batch.column(2).to_pylist()
            full = [k for k, t in enumerate(texts) if t and not t.isspace()]
            for a, b in chunks([texts[k] for k in full], 1 << 19):
                some = full[a:b]
                mine = [texts[k] for k in some]
                rows = []
                for k, found, n in zip(some, known.runs(mine), letters(mine).tolist()):
                    if n:
                        stands = names.get(label_key(labels[k])) if labels[k] else None
                        rows += [(k, no if len(found) > 1 else 0, lang, sure, n, len(found), stands) for no, (lang, sure) in enumerate(found, 1)]
                if rows:
                    cols = list(zip(*rows))
                    kinds = [pa.int32(), pa.string(), pa.float64(), pa.int64(), pa.int32(), pa.string()]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(cols[0])), *[pa.array(c, t) for c, t in zip(cols[1:], kinds)]], columns)

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text, label).mapInArrow(run, f"`{key}` {kind}, segment_no int, language string, confidence double, letters bigint, runs int, labelled string")


def label_issues(found: DataFrame, key: str) -> DataFrame:
    """(key, issue, segment_no, language): missing and wrong labels, and the runs of mixed texts."""
    enough = F.col("letters") >= F.when(F.col("language").isin(DENSE), MIN_DENSE).otherwise(MIN_LETTERS)
    issue = F.when(F.col("runs") > 1, "mixed").when(enough & F.col("labelled").isNull(), "missing").when(enough & (F.col("labelled") != F.col("language")), "wrong")
    return found.select(key, issue.alias("issue"), "segment_no", "language").where("issue is not null").distinct()
