"""Texts that were cut by a field limit or a broken transfer.

The corpus's own words form a trie, kept as a table of hashed prefixes, with counts of how
often a word is followed by more and how often by the end of a sentence.  Words stand in it
by themselves and after the word before them (in writing without spaces: runs of four and of
two characters).  A text without a final mark is suspect if its last word is unknown but a
proper prefix of known ones, or known and hardly ever the end of a sentence, or if it ends
in a comma, or if it is as long, in characters, bytes or words, as so many texts of its
source that this length is a field limit.  A text whose last word is a prefix, or that ends at
a limit, is suspect even if it is known nowhere else that more was said.

An exact check follows: a suspect text that equals the sample's own line isn't cut.  Nothing
else is taken from that line; it makes no text suspect.

Null and blank texts are no case.  A text that only lacks its final mark, or trails off
with a dash or an ellipsis, isn't one either (three dots are a mark of the field where texts
pile up at its limit).  Repeated rows count once; texts of any length are read whole.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.hashes import filled
from corpusloom.llm.bpe import chunks
from corpusloom.shared import materialised

#: A word goes on if it was seen so often before more, and at most once in so many cases at the end of a sentence.
SEEN_OFTEN, SELDOM = 10, 200
#: A field limit: so many texts of a source at one length, and their least share of those of about that length.
PILE, PILE_SHARE, NEAR = 5, 0.5, 10
#: Measures of a text's length, and how far below a limit a text may end that the limit cut (a byte limit cuts inside characters).
MEASURES = {"n_chars": 0, "n_bytes": 3, "n_words": 0}
#: Runs of characters that stand for words in writing without spaces.
GRAM, SHORT_GRAM = 4, 2
#: Parts into which the rows of one last word are split.
SALTS = 16
BROKEN = "�"

_ASIDE = re.compile(r"\([^()]*\)|\[[^\[\]]*\]|（[^（）]*）|<[^<>]*>|♪")
_WORD = re.compile(r"[^\W_]+")
_DENSE = re.compile(r"[぀-ヿ㐀-鿿]")
_SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
_FINAL = ".!?。！？"
_TRAILING = "…—–"
_CLOSERS = "」』”»）)]>♪"
#: After these nothing is known of what follows: speech trails off, or a line without marks ends.
_UNKNOWN = _TRAILING + "\r\n-"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = 0xBF58476D1CE4E5B9


def reduced(text: str) -> str:
    """Letters and digits after NFKC and case folding, without sounds in brackets."""
    return "".join(_WORD.findall(folded(_ASIDE.sub(" ", text))))


def folded(text: str) -> str:
    return text.casefold() if text.isascii() else unicodedata.normalize("NFKC", text).casefold()


def words(text: str) -> Iterator[tuple[str, str, int]]:
    """(word before, word, position after it) of a folded text; writing without spaces gives its runs of GRAM and of SHORT_GRAM characters, with nothing before them."""
    before = ""
    for m in _WORD.finditer(text):
        word = m.group()
        if _DENSE.search(word):
            for n in (GRAM, SHORT_GRAM):
                for k in range(max(1, len(word) - n + 1)):
                    yield "", word[k : k + n], m.start() + min(k + n, len(word))
            before = ""
        else:
            yield before, word, m.end()
            before = word


def last_words(text: str) -> tuple[tuple[str, str], tuple[str, str]]:
    """The (word before, word) under which a text's end is looked up: alone, and after the word before it."""
    low = folded(text)
    end = len(low)
    found = []
    for _ in range(2):
        while end and not low[end - 1].isalnum():
            end -= 1
        start = end
        while start and low[start - 1].isalnum():
            start -= 1
        found.append(low[start:end])
        end = start
    last, before = found
    if _DENSE.search(last):
        return ("", last[-GRAM:]), ("", last[-SHORT_GRAM:])
    return ("", last), ("" if _DENSE.search(before) else before, last)


def count_words(texts: list[str]) -> dict[tuple[str, str], list[int]]:
    """(word before, word) -> [how often more follows, how often the end of a sentence]; each word also after '' for any word before.

    A text without marks doesn't show where its sentences end, so its words are known but uncounted.
    """
    found: dict[tuple[str, str], list[int]] = {}
    for text in texts:
        low = folded(text)
        one = int(any(mark in low for mark in _FINAL))
        for before, word, end in words(low):
            rest = low[end : end + 1]
            # nor is anything known about what follows the end of the text, or three dots, which may stand for a cut
            if rest and rest not in _UNKNOWN and not low.startswith("...", end):
                ends = rest in _FINAL
                found.setdefault(("", word), [0, 0])[ends] += one
                if before:
                    found.setdefault((before, word), [0, 0])[ends] += one
    return found


class Keys:
    """64-bit keys of many words and of all their prefixes at once, in time linear in their characters."""

    def __init__(self, befores: list[str], tokens: list[str]):
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.end = np.cumsum(self.size)
        self.start = self.end - self.size
        self.sums, self.power = self._sums(tokens)
        b_size = np.array([len(t) for t in befores], np.int64)
        b_end = np.cumsum(b_size)
        sums, power = self._sums(befores)
        self.context = (sums[b_end] - sums[b_end - b_size]) * power[b_end - b_size] * _BASE + b_size.astype(np.uint64)

    @staticmethod
    def _sums(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        points = np.frombuffer("".join(tokens).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        down = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(len(points), _INVERSE))])
        up = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(len(points), _BASE))])
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(points * down[:-1], dtype=np.uint64)]), up

    def of(self, which: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Keys of the first `length` characters of the words `which`."""
        a = self.start[which]
        hashed = (self.sums[a + length] - self.sums[a]) * self.power[a] + length.astype(np.uint64) * _BASE
        mixed = (hashed ^ (hashed >> np.uint64(29)) ^ (self.context[which] << np.uint64(1))) * np.uint64(_MIX)
        return ((mixed ^ (mixed >> np.uint64(32))) * _BASE).view(np.int64)

    def whole(self) -> np.ndarray:
        return self.of(np.arange(len(self.size)), self.size)


def closed(text: str) -> bool:
    """Whether a text ends with a mark, or with something in brackets or quotation marks."""
    bare = text.rstrip(_SPACES + "\"'”’»」』）)")
    return bare[-1:] in set(_FINAL + _TRAILING) or text.rstrip(_SPACES + ".")[-1:] in set(_CLOSERS)


def features(df: DataFrame) -> DataFrame:
    """(sample_id, dataset_id, last_key, pair_key, n_chars, n_bytes, n_words, closed, dots, comma, broken) of each (sample_id, dataset_id, text)."""
    schema = "sample_id string, dataset_id string, last_key bigint, pair_key bigint, n_chars bigint, n_bytes bigint, n_words bigint, closed boolean, dots boolean, comma boolean, broken boolean"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            bare = [t.rstrip(BROKEN) for t in texts]
            ends = [last_words(t.rstrip(_SPACES + BROKEN)) for t in texts]
            keys = [pa.array(Keys([e[k][0] for e in ends], [e[k][1] for e in ends]).whole()) for k in (0, 1)]
            lengths = [pa.array(x, pa.int64()) for x in ([len(t) for t in texts], [len(b.encode()) for b in bare], [t.count(" ") + 1 for t in texts])]
            marks = [[closed(t) for t in texts], [t.endswith("...") and not t.endswith("....") for t in texts], [t.rstrip(_SPACES)[-1:] in (",", "、", "，") for t in texts], [t.rstrip(_SPACES).endswith(BROKEN) for t in texts]]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *keys, *lengths, *[pa.array(m, pa.bool_()) for m in marks]], names)

    return df.select("sample_id", "dataset_id", "text").mapInArrow(run, schema)


def vocabulary(df: DataFrame) -> DataFrame:
    """(before, word, goes_on, ends) over all texts, counted per batch before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = count_words(batch.column(0).to_pylist())
            pairs = list(found.values())
            yield pa.RecordBatch.from_arrays([*[pa.array([w[k] for w in found], pa.string()) for k in (0, 1)], *[pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)]], ["before", "word", "goes_on", "ends"])

    return df.select("text").mapInArrow(run, "before string, word string, goes_on bigint, ends bigint").groupBy("before", "word").agg(F.sum("goes_on").alias("goes_on"), F.sum("ends").alias("ends"))


def trie(known: DataFrame) -> DataFrame:
    """(key, goes_on, ends) of each word, and (key, null, null) of each proper prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            befores, tokens = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in chunks(tokens, 1 << 18):
                keys, some = Keys(befores[a:b], tokens[a:b]), slice(a, b)
                yield pa.RecordBatch.from_arrays([pa.array(keys.whole()), batch.column(2)[some], batch.column(3)[some]], names)
                which = np.repeat(np.arange(b - a), keys.size - 1)
                length = np.arange(len(which)) - np.repeat(np.cumsum(keys.size - 1) - (keys.size - 1), keys.size - 1) + 1
                none = pa.nulls(len(which), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(keys.of(which, length)), none, none], names)

    names = ["key", "goes_on", "ends"]
    return known.select("before", "word", "goes_on", "ends").mapInArrow(run, "key bigint, goes_on bigint, ends bigint")


def field_limits(found: DataFrame) -> DataFrame:
    """(dataset_id, measure, size): lengths of texts that a field limit of their source explains.

    A limit is a length at which at least PILE texts stand, and PILE_SHARE of all texts that
    are up to NEAR units, or from a hundred units on up to NEAR percent, shorter or longer.  A
    source may have several, and longer texts beside them; one of up to NEAR units can't be
    told from short texts.  Only the distinct lengths of a source are ordered.
    """
    stacked = found.select("dataset_id", F.expr(f"stack({len(MEASURES)}, {', '.join(f'{chr(39)}{m}{chr(39)}, {m}' for m in MEASURES)}) as (measure, size)"))
    sizes = stacked.groupBy("dataset_id", "measure", "size").agg(F.count(F.lit(1)).alias("n"))
    scaled = (100 * F.when(F.col("size") <= 100, F.col("size")).otherwise(100 + F.log(F.col("size") / 100) * (NEAR / math.log(1 + NEAR / 100)))).cast("long")
    of = Window.partitionBy("dataset_id", "measure")
    at = F.lit(0)
    slack = F.lit(0)
    for m, below in MEASURES.items():
        at = F.when(F.col("measure") == m, F.sum("n").over(of.orderBy("size").rangeBetween(-below, 0))).otherwise(at)
        slack = F.when(F.col("measure") == m, below).otherwise(slack)
    sizes = sizes.withColumns({"scaled": scaled, "slack": slack})
    sizes = sizes.withColumns({"at": at, "near": F.sum("n").over(of.orderBy("scaled").rangeBetween(-100 * NEAR, 100 * NEAR))})
    limits = sizes.where((F.col("size") > NEAR) & (F.col("at") >= PILE) & (F.col("at") >= PILE_SHARE * F.col("near")))
    return limits.select("dataset_id", "measure", F.explode(F.sequence(F.col("size") - F.col("slack"), F.col("size"))).alias("size")).distinct()


def _at_limit(limits: DataFrame, found: DataFrame) -> DataFrame:
    """`found` with at_limit; the limits of a source, a few, come as one row of lists."""
    wide = limits.groupBy("dataset_id").agg(*[F.collect_set(F.when(F.col("measure") == m, F.col("size"))).alias(f"at_{m}") for m in MEASURES])
    hit: Column = F.lit(False)
    for m in MEASURES:
        hit = hit | F.coalesce(F.array_contains(f"at_{m}", F.col(m)), F.lit(False))
    return found.join(wide, "dataset_id", "left").withColumn("at_limit", hit).drop(*[f"at_{m}" for m in MEASURES])


def against(texts: DataFrame) -> DataFrame:
    """(sample_id, dataset_id, line): how each (sample_id, dataset_id, text, own) stands to the sample's own line: none, same, short (a proper prefix) or other."""

    def relation(text: str, own: str | None) -> str:
        if own is None or own.isspace() or not own:
            return "none"
        said, full = reduced(text.rstrip(BROKEN)), reduced(own)
        return "same" if said == full else "short" if full.startswith(said) else "other"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(map(relation, batch.column(2).to_pylist(), batch.column(3).to_pylist()), pa.string())], ["sample_id", "dataset_id", "line"])

    return texts.select("sample_id", "dataset_id", "text", "own").mapInArrow(run, "sample_id string, dataset_id string, line string")


def truncated(asr: DataFrame, lines: DataFrame) -> DataFrame:
    """(sample_id, dataset_id, at_limit, unknown_prefix, never_end, open_end, suspect, line, cut) of each recognised text.

    asr: (sample_id, status, dataset_id, text); lines: (sample_id, text).  Rows delivered
    twice count once; line is null where the text isn't suspect.
    """
    ok = asr.where("status = 'ok'").where(filled(F.col("text"))).select("sample_id", "dataset_id", "text").distinct()
    texts = materialised(ok, "recognised")
    found = materialised(features(texts), "endings")
    found = _at_limit(field_limits(found), found).withColumn("no", F.monotonically_increasing_id())
    found = materialised(found.withColumn("open_end", ~F.col("closed") | F.col("broken") | (F.col("dots") & F.col("at_limit"))), "ends")

    asked = found.where("open_end").select("no", F.explode(F.array_distinct(F.array("last_key", "pair_key"))).alias("key"))
    nodes = trie(vocabulary(texts)).join(asked.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.max(F.col("goes_on").isNull()).alias("prefix"), F.sum("goes_on").alias("goes_on"), F.sum("ends").alias("ends"))
    unknown = F.col("prefix") & F.col("goes_on").isNull()
    never = F.coalesce((F.col("goes_on") >= SEEN_OFTEN) & (F.col("ends") * SELDOM <= F.col("goes_on")), F.lit(False))
    told = nodes.select("key", unknown.alias("unknown_prefix"), never.alias("never_end")).where("unknown_prefix or never_end").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    told = asked.withColumn("salt", (F.col("no") % SALTS).cast("int")).join(told, ["key", "salt"]).groupBy("no").agg(F.max("unknown_prefix").alias("unknown_prefix"), F.max("never_end").alias("never_end"))

    judged = found.join(told, "no", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("unknown_prefix", "never_end")})
    evidence = F.col("at_limit") | F.col("broken") | F.col("comma") | F.col("unknown_prefix") | F.col("never_end")
    judged = materialised(judged.withColumn("suspect", F.col("open_end") & evidence).select("no", "sample_id", "dataset_id", "n_chars", "at_limit", "unknown_prefix", "never_end", "open_end", "suspect"), "judged")

    doubted = judged.where("suspect").select("sample_id", "dataset_id").distinct()
    own = lines.join(doubted.select("sample_id"), "sample_id", "left_semi").groupBy("sample_id").agg(F.max("text").alias("own"))
    checked = against(texts.join(doubted, ["sample_id", "dataset_id"], "left_semi").join(own, "sample_id", "left"))
    checked = checked.groupBy("sample_id", "dataset_id").agg(F.max_by("line", F.col("line") != "same").alias("line"))
    return judged.join(checked, ["sample_id", "dataset_id"], "left").select(
        "sample_id", "dataset_id", "at_limit", "unknown_prefix", "never_end", "open_end", "suspect", F.when(F.col("suspect"), F.col("line")).alias("line"), (F.col("suspect") & F.coalesce(F.col("line") != "same", F.lit(True))).alias("cut")
    )


def truncation_rates(judged: DataFrame) -> DataFrame:
    """(dataset_id, samples, cut_samples, share, at_limit_samples) of each source."""
    return judged.groupBy("dataset_id").agg(
        F.count_distinct("sample_id").alias("samples"), F.count_distinct(F.when(F.col("cut"), F.col("sample_id"))).alias("cut_samples"), F.count_distinct(F.when(F.col("cut") & F.col("at_limit"), F.col("sample_id"))).alias("at_limit_samples")
    ).withColumn("share", F.col("cut_samples") / F.col("samples"))
