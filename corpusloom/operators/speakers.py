"""Speaker turns of a recording: parsing a diariser's reply, and measures over the turns.

Everything works inside the row with higher-order functions, so no row is exploded and
nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REPLY = "struct<segments:array<struct<start:double,end:double,text:string>>>"
LABEL = r"^\s*\[?(S\d+)\]?:?"


def merged(intervals: Column) -> Column:
    """Sorted union of an array of struct(start, end); touching ones are joined, invalid ones dropped.  Null stays null."""
    sound = F.array_sort(F.filter(intervals, lambda x: x["start"].isNotNull() & x["end"].isNotNull() & (x["start"] < x["end"])))
    empty = F.slice(sound, 1, 0)

    def step(acc: Column, x: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        grown = F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))))
        return F.when((F.size(acc) > 0) & (x["start"] <= last["end"]), grown).otherwise(F.concat(acc, F.array(F.struct(x["start"].alias("start"), x["end"].alias("end")))))

    return F.aggregate(sound, empty, step)


def union_length(intervals: Column) -> Column:
    """Total length of the union of an array of struct(start, end): a running maximum, no merge needed."""
    sound = F.array_sort(F.filter(intervals, lambda x: x["start"].isNotNull() & x["end"].isNotNull() & (x["start"] < x["end"])))
    zero = F.struct(F.lit(0).cast("long").alias("total"), F.lit(-(1 << 62)).cast("long").alias("reach"))

    def step(acc: Column, x: Column) -> Column:
        fresh = F.greatest(F.lit(0).cast("long"), x["end"] - F.greatest(x["start"], acc["reach"]))
        return F.struct((acc["total"] + fresh).alias("total"), F.greatest(acc["reach"], x["end"]).alias("reach"))

    return F.aggregate(sound, zero, step, lambda acc: acc["total"])


def spans(turns: Column, speaker: Column | None = None) -> Column:
    """struct(start, end) of the turns, of one speaker or all."""
    own = turns if speaker is None else F.filter(turns, lambda t: t["speaker"] == speaker)
    return F.transform(own, lambda t: F.struct(t["start_sample"].cast("long").alias("start"), t["end_sample"].cast("long").alias("end")))


def overlaps(turns: Column) -> Column:
    """Merged stretches where turns of different speakers overlap; pairs are formed inside the row only."""

    def with_later(t: Column, i: Column) -> Column:
        rest = F.slice(turns, i + 2, F.greatest(F.size(turns), F.lit(1)))
        other = F.filter(rest, lambda u: (u["speaker"] != t["speaker"]) & (u["start_sample"] < t["end_sample"]) & (t["start_sample"] < u["end_sample"]))
        return F.transform(other, lambda u: F.struct(F.greatest(t["start_sample"], u["start_sample"]).cast("long").alias("start"), F.least(t["end_sample"], u["end_sample"]).cast("long").alias("end")))

    return merged(F.flatten(F.transform(turns, with_later)))


def structure(turns: Column, frames: Column) -> Column:
    """struct of measures: speakers, union, overlap, ratios and the overlaps; no turns give zeros and a null share."""
    speakers = F.array_distinct(F.transform(turns, lambda t: t["speaker"]))
    union = union_length(spans(turns))
    over = overlaps(turns)
    overlap = F.aggregate(over, F.lit(0).cast("long"), lambda a, x: a + (x["end"] - x["start"]))
    most = F.coalesce(F.array_max(F.transform(speakers, lambda s: union_length(spans(turns, s)))), F.lit(0).cast("long"))
    return F.struct(
        F.size(speakers).alias("speaker_count"), union.alias("turn_union_samples"), overlap.alias("overlap_samples"), F.try_divide(overlap, frames).alias("overlap_ratio"), F.try_divide(most, union).alias("dominant_speaker_ratio"), over.alias("overlaps")
    )


def parse_reply(body: Column, rate: Column, frames: Column, end_tolerance: float, gap_seconds: float, gap_share: float) -> Column:
    """struct(turns, error_code): a diariser's JSON as sorted turns in samples, or what is wrong with it."""
    parsed = F.from_json(body, REPLY)
    segments = parsed["segments"]
    length = F.try_divide(frames.cast("double"), rate)
    bad = F.exists(
        segments,
        lambda s: ~F.coalesce(s["text"].rlike(LABEL), F.lit(False))
        | s["start"].isNull() | s["end"].isNull() | F.isnan(s["start"]) | F.isnan(s["end"])
        | (s["start"] < 0) | (s["end"] <= s["start"]) | (s["end"] > length + end_tolerance),
    )
    turns = F.array_sort(
        F.transform(
            segments,
            lambda s: F.struct(
                F.least(frames.cast("long"), F.greatest(F.lit(0).cast("long"), F.floor(s["start"] * rate))).alias("start_sample"),
                F.least(frames.cast("long"), F.ceil(s["end"] * rate)).alias("end_sample"),
                F.regexp_extract(s["text"], LABEL, 1).alias("speaker"),
                F.regexp_replace(s["text"], LABEL, "").alias("text"),
            ),
        )
    )
    empty = F.exists(turns, lambda t: t["start_sample"] >= t["end_sample"])
    gap = length - F.array_max(F.transform(turns, lambda t: t["end_sample"])) / rate
    cut = (F.size(turns) > 0) & (gap > F.greatest(F.lit(gap_seconds), length * gap_share))
    code = F.when(segments.isNull() | F.coalesce(bad, F.lit(True)) | F.coalesce(empty, F.lit(False)), "model_invalid_output").when(F.coalesce(cut, F.lit(False)), "output_truncated")
    return F.struct(F.when(code.isNull(), turns).alias("turns"), code.alias("error_code"))
