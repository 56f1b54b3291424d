"""One surviving record for each group of copies.

A single aggregation per group takes the minimum of a ranking struct for the survivor and,
for each attribute, the maximum of a composite struct (has a value, trust of the source,
time, value), so that attributes are filled field by field from the best member that has
them.  Both are partially aggregated before the shuffle, so a group may hold any share of
the rows.  Rows without a key are in no group.  Repeated deliveries of a member change
nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.hashes import digest64, filled

#: Trust of sources that have no priority: below all that have one.
NO_PRIORITY = 1 << 30
FIELDS = ["text", "language", "speaker_id", "recording_id"]
#: What is filled: each entry is one value, so columns that only mean something together come from one member.
FILLED = [("text",), ("language",), ("speaker_id", "speaker_scope"), ("recording_id",), ("text_kind",), ("metadata_json",), ("group_id",), ("parent_sample_id", "segment_start_frame", "segment_end_frame"), ("sample_rate", "channels", "num_frames", "duration_seconds"), ("text_variants",), ("repetition", "repetition_path")]
ID_FILLED = [("recording_id",), ("semantic_hash",), ("carrier_type",), ("language",), ("native_frames", "sample_rate")]
#: What says where and when the survivor itself was found, and is never taken from another member.
OWN = ["dataset_id", "source_key", "source_config", "source_split", "converted_at", "landed_at"]
ID_OWN = ["priority", "scanned_at"]


def present(df: DataFrame, names: list[str | tuple[str, ...]]) -> list:
    """Those of `names` that are columns of `df`; of an entry of several, those it has."""
    if all(isinstance(n, str) for n in names):
        return [n for n in names if n in df.columns]
    return [kept for entry in names if (kept := tuple(n for n in entry if n in df.columns))]


def has_value(df: DataFrame, name: str) -> Column:
    """True for a string that isn't blank, an array with elements, any other value but null."""
    kind = df.schema[name].dataType.simpleString()
    if kind == "string":
        return filled(F.col(name))
    return F.coalesce(F.size(name) > 0, F.lit(False)) if kind.startswith("array") else F.col(name).isNotNull()


def composite(df: DataFrame, entry: tuple[str, ...], order: list[Column]) -> Column:
    """Struct whose maximum over a group holds the value of the best member that has one.

    A member has an entry of several columns if it has the first; more of the others come before `order`.
    """
    has = [has_value(df, n) for n in entry]
    value = F.when(has[0], F.struct(*[F.when(h, F.col(n)).alias(n) for h, n in zip(has, entry)]))
    return F.struct(has[0].alias("has"), sum((h.cast("int") for h in has[1:]), F.lit(0)).alias("more"), *[c.alias(f"o{i}") for i, c in enumerate(order)], value.alias("value"))


def survivors(df: DataFrame, key: Column, member: list[str], rank: list[Column], fields: list[tuple[str, ...]] = (), order: list[Column] = (), own: list[str] = ()) -> DataFrame:
    """(group_key, member, fields, own) of each group of two or more members.

    rank: sort key of a member, smallest wins, with null as no candidate for survivor if
    its first column is null.  fields: attributes to fill, the greatest `order` first.  own:
    attributes of the survivor itself.
    """
    ranked = F.when(rank[0].isNotNull(), F.struct(*[c.alias(f"r{i}") for i, c in enumerate(rank)], *[F.col(m) for m in [*member, *own]]))
    named = F.struct(*[F.col(m) for m in member])
    base = df.select(key.alias("group_key"), ranked.alias("__rank"), named.alias("__member"), *[composite(df, f, order).alias(f"__{f[0]}") for f in fields])
    grouped = base.where(F.col("group_key").isNotNull()).groupBy("group_key").agg(
        F.min("__rank").alias("best"), F.min("__member").alias("low"), F.max("__member").alias("high"), *[F.max(f"__{f[0]}").alias(f"__{f[0]}") for f in fields]
    )
    return grouped.where(F.col("low") != F.col("high")).select("group_key", *[F.col(f"best.{m}").alias(m) for m in member], *[F.col(f"__{f[0]}.value.{n}").alias(n) for f in fields for n in f], *[F.col(f"best.{o}").alias(o) for o in own])


def sample_survivors(selection: DataFrame, datasets: DataFrame, own: list[str] = OWN) -> DataFrame:
    """Survivor of the samples that share their audio, with its fields filled from the whole group.

    Most non-blank fields first, then the more trusted source, the later conversion and the
    smaller id.  Columns that `selection` lacks are left out.  `datasets` is broadcast: it has
    a row per source of the corpus.  own: columns of the survivor itself to keep.
    """
    fields, own = present(selection, FILLED), present(selection, own)
    trust = datasets.groupBy("dataset_id").agg(F.min("priority").alias("__priority"))
    rows = selection.select("sample_id", "audio_sha256", *[n for f in fields for n in f], *dict.fromkeys(["dataset_id", "converted_at", *own])).join(trust, "dataset_id", "left")
    full = sum(filled(F.col(c)).cast("int") for c in FIELDS)
    priority = F.coalesce("__priority", F.lit(NO_PRIORITY))
    age = -F.coalesce(F.unix_micros(F.col("converted_at").cast("timestamp")), F.lit(-(1 << 62)))
    return survivors(rows, digest64(F.col("audio_sha256")), ["sample_id"], [-full, priority, age], fields, [-priority, F.col("converted_at")], own)


def candidate_survivors(ids: DataFrame, fields: list[tuple[str, ...]] = (), own: list[str] = ()) -> DataFrame:
    """Survivor of the candidates of an utterance id: (group_key, archive, row_number, fields, own).

    Groups whose candidates disagree in `semantic_hash`, or without a candidate free of
    error, have none.  fields: attributes to fill from the first candidate that has them, in
    the order that names the survivor, those with an error last; the time of a scan isn't
    part of it, as a candidate delivered again has another.  own: attributes of the survivor
    itself, as first delivered.
    """
    fine = ~filled(F.col("error"))
    priority = F.coalesce(F.col("priority").cast("int"), F.lit(NO_PRIORITY))
    rank = F.when(fine, F.struct(priority.alias("p"), F.col("archive"), F.col("row_number"), *[F.col(o) for o in own]))
    order = [fine, -priority, -F.col("archive"), -F.col("row_number")]
    rows = ids.select("short_id", F.struct("archive", "row_number").alias("__m"), rank.alias("__rank"), F.col("semantic_hash").alias("__h"), *[composite(ids, f, order).alias(f"__{f[0]}") for f in fields])
    grouped = rows.where(F.col("short_id").isNotNull()).groupBy("short_id").agg(
        F.min("__rank").alias("best"), F.min("__m").alias("low"), F.max("__m").alias("high"), F.min("__h").alias("h0"), F.max("__h").alias("h1"), *[F.max(f"__{f[0]}").alias(f"__{f[0]}") for f in fields]
    )
    agreed = F.coalesce(F.col("h0") == F.col("h1"), F.lit(True))
    return grouped.where((F.col("low") != F.col("high")) & agreed & F.col("best").isNotNull()).select(
        F.col("short_id").alias("group_key"), F.col("best.archive").alias("archive"), F.col("best.row_number").alias("row_number"), *[F.col(f"__{f[0]}.value.{n}").alias(n) for f in fields for n in f], *[F.col(f"best.{o}").alias(o) for o in own]
    )


def candidate_records(ids: DataFrame) -> DataFrame:
    """`candidate_survivors` with every attribute of a candidate that `ids` has; `error` is null or blank in all."""
    return candidate_survivors(ids, present(ids, ID_FILLED), present(ids, ID_OWN))
