"""Corpus encoding, container packing and splitting of oversized texts, in tokens of a public tokenizer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.bpe import DEFAULT_DIR, DEFAULT_VOCAB, byte_chunks, encoder


def encode_corpus(df: DataFrame, key: str, text: str, directory: str = DEFAULT_DIR, vocab: str = DEFAULT_VOCAB) -> DataFrame:
    """(key, ids): the ids of each text, without special tokens; null and empty texts have the empty list.

    No shuffle: each partition is encoded where it is read, in stretches of about a
    million characters, so that memory doesn't depend on the partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(directory, vocab)
        for batch in batches:
            for a, b in byte_chunks(batch.column(1)):
                ids, offsets = bpe.encode(batch.column(1)[a:b].to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], names)

    names = [key, "ids"]
    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def token_counts(df: DataFrame, keep: list[str], text: str, directory: str = DEFAULT_DIR, vocab: str = DEFAULT_VOCAB) -> DataFrame:
    """The columns `keep` and n_tokens of each row's text (0 for null and empty texts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(directory, vocab)
        for batch in batches:
            texts = batch.column(len(keep))
            sizes = np.concatenate([bpe.counts(texts[a:b].to_pylist()) for a, b in byte_chunks(texts)] or [np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(sizes, pa.int64())], [*keep, "n_tokens"])

    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return df.select(*keep, F.col(text).alias("__text")).mapInArrow(run, f"{schema}, n_tokens bigint")


# --- containers -----------------------------------------------------------------------

CAPACITY = 2048
#: Items that are packed together.  A group leaves about one open container, so the room
#: lost to grouping is about 1 / (GROUP_ITEMS / items in a container).
GROUP_ITEMS = 8192


def pack_group(items: list[tuple[int, int, int]], capacity: int, source_exclusive: bool = False) -> list[int]:
    """Container number of each item (size, duplicate cluster, source), largest items first.

    Best fit: containers are ordered by what room they have left; a bitmap over the
    residuals finds the tightest ones, and the search goes on to the next residual until a
    container is compatible.  A container never holds two items of one cluster (cluster -1
    conflicts with nothing); containers without the item's source are preferred among
    equally tight ones, or required if `source_exclusive`; the lowest number breaks ties.
    Empty items fit anywhere.  Residuals, clusters and sources each have a bitmap of the
    containers they are true of, so that all equally tight containers are judged at once.
    """
    order = sorted(range(len(items)), key=lambda k: (-items[k][0], items[k][1], k))
    open_at = [0] * (capacity + 1)
    residuals = 0
    holds_cluster: dict[int, int] = {}
    holds_source: dict[int, int] = {}
    at = [0] * len(items)
    made = 0
    for k in order:
        size, cluster, source = items[k]
        taken, seen = holds_cluster.get(cluster, 0), holds_source.get(source, 0)
        mask = residuals >> size << size
        fits = residual = 0
        while mask and not fits:
            residual = (mask & -mask).bit_length() - 1
            mask &= mask - 1
            free = open_at[residual] & ~taken
            fits = free & ~seen or (0 if source_exclusive else free)
        if fits:
            bit = fits & -fits
            open_at[residual] ^= bit
            if not open_at[residual]:
                residuals ^= 1 << residual
        else:
            bit, residual = 1 << made, capacity
            made += 1
        if cluster >= 0:
            holds_cluster[cluster] = taken | bit
        holds_source[source] = seen | bit
        residual -= size
        open_at[residual] |= bit
        residuals |= 1 << residual
        at[k] = bit.bit_length() - 1
    return at


def pack(df: DataFrame, key: str, text: str, source: str, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS, source_exclusive: bool = False, directory: str = DEFAULT_DIR, vocab: str = DEFAULT_VOCAB) -> DataFrame:
    """(key, part, start_token, n_tokens, container_id): the container of each text.

    A text larger than a container fills whole containers and leaves its rest as an item
    (parts are numbered from 1).  Items are packed in groups of about `group_items`, dealt
    out by a hash of the key, so groups are even whatever the skew of sources or copies.
    Null and empty texts take no room and get a container, too.  `key` is unique.
    """
    sized = token_counts(df.select(F.col(key), F.xxhash64(text).alias("__cluster"), F.xxhash64(source).alias("__source"), F.col(text)), [key, "__cluster", "__source"], text, directory, vocab)
    groups = max(1, round(df.count() / group_items))  # no column is read for it
    kind = df.schema[key].dataType.simpleString()

    def run(pdf):
        import pandas as pd

        numbers = {s: k for k, s in enumerate(sorted(set(pdf["__source"].tolist())))}
        clusters: dict[int, int] = {}
        rows, items = [], []
        for name, cluster, source_hash, tokens in pdf.sort_values(["__source", "__cluster", key])[[key, "__cluster", "__source", "n_tokens"]].itertuples(index=False):
            for part, begin in enumerate(range(0, max(tokens, 1), capacity), 1):
                size = min(capacity, tokens - begin)
                # parts of a text are of one cluster, like its copies; only one of them is smaller than a container
                own = clusters.setdefault(cluster, len(clusters)) if tokens else -1
                rows.append((name, part, begin, size))
                items.append((size, own, numbers[source_hash]))
        group = int(pdf["__group"].iloc[0]) if len(pdf) else 0
        at = pack_group(items, capacity, source_exclusive)
        out = pd.DataFrame(rows, columns=[key, "part", "start_token", "n_tokens"])
        out["container_id"] = [(group << 32) + k for k in at]
        return out

    grouped = sized.withColumn("__group", F.pmod(F.xxhash64(key), F.lit(groups)))
    return grouped.groupBy("__group").applyInPandas(run, f"`{key}` {kind}, part int, start_token bigint, n_tokens bigint, container_id bigint")
