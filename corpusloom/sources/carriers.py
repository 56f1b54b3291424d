"""Carriers: recordings whose metadata names shorter pieces, each a candidate for an utterance id."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import digests
from corpusloom.functions.audio import BadAudio, wav_chunks

SCHEMA = "type string, id string, recording_id string, frames long, sample_rate int, short array<struct<id string, rel_start_samples long, rel_end_samples long, text string, language string, speaker string>>"
# Rank of the carrier types; a variant adds one.
PRIORITY = {"short": 0, "long": 2, "dialogue": 4}


def candidates(carriers: DataFrame, metadata: str = "metadata_json", variant: str | None = None) -> DataFrame:
    """One row per piece of each carrier: identity, bounds, rank, semantic hash and what is wrong with its bounds.

    Carriers that aren't sound have one row with `carrier_error` and nothing else; they are
    reported, not dropped.
    """
    keep = [c for c in carriers.columns if c != metadata]
    parsed = carriers.select(*keep, F.from_json(metadata, SCHEMA).alias("m"))
    alone = (F.size("m.short") == 1) & F.coalesce(F.col("m.short")[0]["id"] == F.col("m.id"), F.lit(False))
    error = (
        F.when(F.col("m.type").isNull() | ~F.col("m.type").isin(*PRIORITY), "unknown_carrier_type")
        .when(~F.coalesce((F.col("m.frames") > 0) & (F.col("m.sample_rate") > 0), F.lit(False)), "invalid_timeline")
        .when((F.col("m.type") == "short") & ~F.coalesce(alone, F.lit(False)), "standalone_mismatch")
        .when(F.coalesce(F.col("m.recording_id"), F.lit("")) == "", "missing_identity")
    )
    rows = parsed.withColumn("carrier_error", error).withColumn("s", F.explode_outer(F.when(error.isNull(), F.col("m.short"))))
    a, b = F.col("s.rel_start_samples"), F.col("s.rel_end_samples")
    bounds = F.coalesce((a >= 0) & (a < b) & (b <= F.col("m.frames")), F.lit(False))
    bad = F.when(F.col("s").isNull(), None).when(~bounds, "invalid_short_bounds").when((F.col("m.type") == "short") & ((a != 0) | (b != F.col("m.frames"))), "standalone_short_not_full_carrier")
    rank = F.coalesce(*[F.when(F.col("m.type") == k, v) for k, v in PRIORITY.items()])
    return rows.select(
        *keep, F.col("s.id").alias("short_id"), F.col("m.recording_id").alias("recording_id"), F.col("m.type").alias("carrier_type"), (rank + (F.col(variant).cast("int") if variant else F.lit(0))).alias("priority"),
        a.alias("start"), b.alias("end"), F.col("m.frames").alias("native_frames"), F.col("m.sample_rate").alias("sample_rate"), "s.text", "s.language", "s.speaker", bad.alias("error"), "carrier_error",
        F.when(F.col("s").isNotNull(), digests.digest_of(F.col("m.recording_id"), F.when(F.col("s.text") != "", F.trim("s.text")), F.col("s.language"), F.col("s.speaker"))).alias("semantic_hash"),
    )


def index_differences(members: DataFrame, index: DataFrame) -> DataFrame:
    """(archive, member, problem): an archive's members against its index of (archive, member, n_bytes)."""
    a = members.groupBy("archive", "member").agg(F.count(F.lit(1)).alias("n"), F.max("n_bytes").alias("size"))
    b = index.groupBy("archive", "member").agg(F.count(F.lit(1)).alias("m"), F.max("n_bytes").alias("declared"))
    joined = a.join(b, ["archive", "member"], "full")
    problem = F.when(F.col("n").isNull(), "only_in_index").when(F.col("m").isNull(), "not_in_index").when((F.col("n") > 1) | (F.col("m") > 1), "repeated").when(F.col("size") != F.col("declared"), "size_differs")
    return joined.select("archive", "member", problem.alias("problem")).where("problem is not null")


def crops(carriers: DataFrame, winners: DataFrame, key: str = "member") -> DataFrame:
    """(key, short_id, audio, error): the pieces of each carrier's WAV audio, cut without decoding twice.

    carriers: (key, audio); winners: (key, short_id, start, end).  Every carrier's audio is
    sent once to where its winners are, however many there are.
    """
    schema = f"`{key}` string, short_id string, audio binary, error string"

    def cut(keys, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = []
        raw = bytes(left["audio"].iloc[0]) if len(left) and left["audio"].iloc[0] is not None else None
        for name, a, b in right[["short_id", "start", "end"]].itertuples(index=False):
            try:
                if raw is None:
                    raise BadAudio("missing_carrier")
                rows.append((keys[0], name, crop_wav(raw, int(a), int(b)), None))
            except BadAudio as e:
                rows.append((keys[0], name, None, str(e)))
        return pd.DataFrame(rows, columns=[key, "short_id", "audio", "error"])

    return carriers.select(key, "audio").groupBy(key).cogroup(winners.select(key, "short_id", "start", "end").groupBy(key)).applyInPandas(cut, schema)


def crop_wav(raw: bytes, start: int, end: int) -> bytes:
    """The frames [start, end) of a PCM WAV file as a WAV file."""
    import struct

    chunks = {name: (at, size) for name, at, size in wav_chunks(raw)}
    if b"fmt " not in chunks or b"data" not in chunks:
        raise BadAudio("missing_chunk")
    form = raw[chunks[b"fmt "][0] : sum(chunks[b"fmt "])]
    step = struct.unpack_from("<H", form, 12)[0]
    at, size = chunks[b"data"]
    if not step or not 0 <= start < end <= size // step:
        raise BadAudio("bounds_outside_audio")
    body = raw[at + start * step : at + end * step]
    return b"RIFF" + struct.pack("<I", 20 + len(form) + len(body)) + b"WAVEfmt " + struct.pack("<I", len(form)) + form + b"data" + struct.pack("<I", len(body)) + body


def reject_budget(rows: DataFrame, archive: str = "archive") -> DataFrame:
    """(archive, n_rows, rejected, over): whether an archive lost more pieces than max(16, a quarter)."""
    out = rows.groupBy(archive).agg(F.count(F.lit(1)).alias("n_rows"), F.count("error").alias("rejected"))
    return out.withColumn("over", F.col("rejected") > F.greatest(F.lit(16), F.floor(F.col("n_rows") / 4)))

