"""The base table: one row per audio sample, the same 27 columns for every source."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.audio import BadAudio, header
from corpusloom.functions.digests import digest_of, record_revision

VERSION = "1"
# Names of the string columns of the base table.
STRINGS = ["schema_version", "sample_id", "record_revision", "dataset_id", "source_snapshot", "source_key", "source_config", "source_split", "source_locator_json", "recording_id", "group_id", "parent_sample_id", "audio_sha256", "text", "text_kind", "language", "speaker_id", "speaker_scope", "metadata_json"]
VARIANT = T.StructType([T.StructField(n, T.StringType()) for n in ("kind", "text", "language")])
SCHEMA = T.StructType(
    [
        *[T.StructField(n, T.StringType()) for n in STRINGS],
        T.StructField("audio", T.StructType([T.StructField("bytes", T.BinaryType()), T.StructField("path", T.StringType())])),
        T.StructField("sample_rate", T.IntegerType()),
        T.StructField("channels", T.ShortType()),
        T.StructField("num_frames", T.LongType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("segment_start_frame", T.LongType()),
        T.StructField("segment_end_frame", T.LongType()),
        T.StructField("text_variants", T.ArrayType(VARIANT)),
    ]
)


def schema_digest(schema: T.StructType = SCHEMA) -> str:
    """Digest by which drift of a schema is noticed; nullability and field metadata don't count."""
    import hashlib

    return hashlib.sha256(schema.simpleString().encode()).hexdigest()


def audio_header(data: Column) -> Column:
    """struct(sample_rate, channels, num_frames) from the header of a WAV, FLAC, MP3 or OGG file; nulls for other containers and broken files."""

    @F.pandas_udf("sample_rate int, channels smallint, num_frames bigint")
    def run(c: pd.Series) -> pd.DataFrame:
        def one(raw):
            try:
                return header(bytes(raw)) if raw is not None else (None,) * 3
            except BadAudio:
                return (None,) * 3

        return pd.DataFrame([one(raw) for raw in c], columns=["sample_rate", "channels", "num_frames"], dtype="Int64")

    return run(data)


def file_snapshot(path: Column, sha256: Column, scheme: str = "source-file-v1") -> Column:
    """Snapshot of a source file: scheme and digest of its path and content hash."""
    return F.concat(F.lit(f"{scheme}:sha256:"), F.sha2(F.concat(F.lit('{"path":'), F.to_json(F.array(path)), F.lit(',"sha256":"'), sha256, F.lit('"}')), 256))


def base_table(rows: DataFrame, dataset: str, fields: dict[str, str | Column]) -> DataFrame:
    """`rows` as base records; `fields` gives columns or SQL expressions over the source's own columns.

    Needed are source_snapshot, source_key and audio_bytes.  Blank strings become null, a
    kind without its value too; ids and hashes are computed here.
    """
    col = lambda name: (c if isinstance(c := fields[name], Column) else F.expr(c)) if name in fields else F.lit(None)
    text = lambda name: F.when(col(name).cast("string").rlike(r"(?U)\S"), col(name).cast("string"))
    made = rows.select(
        F.lit(VERSION).alias("schema_version"), F.lit(dataset).alias("dataset_id"), F.lit("train").alias("source_split"),
        *[text(n).alias(n) for n in ("source_snapshot", "source_key", "source_config", "source_locator_json", "recording_id", "group_id", "parent_sample_id", "text", "language", "speaker_id")],
        F.coalesce(col("metadata_json"), F.lit("{}")).cast("string").alias("metadata_json"), text("text_kind").alias("__kind"), text("speaker_scope").alias("__scope"),
        col("audio_bytes").cast("binary").alias("__bytes"), text("audio_path").alias("__path"),
        col("segment_start_frame").cast("long").alias("segment_start_frame"), col("segment_end_frame").cast("long").alias("segment_end_frame"),
        F.coalesce(col("text_variants").cast(T.ArrayType(VARIANT)), F.array().cast(T.ArrayType(VARIANT))).alias("text_variants"), audio_header(col("audio_bytes").cast("binary")).alias("__h"),
    )
    filled = made.withColumns({
        "sample_id": digest_of(F.col("dataset_id"), F.col("source_snapshot"), F.col("source_key")),
        "text_kind": F.when(F.col("text").isNotNull(), F.col("__kind")), "speaker_scope": F.when(F.col("speaker_id").isNotNull(), F.col("__scope")),
        "audio_sha256": F.sha2("__bytes", 256), "audio": F.struct(F.col("__bytes").alias("bytes"), F.col("__path").alias("path")),
        "sample_rate": F.col("__h.sample_rate"), "channels": F.col("__h.channels"), "num_frames": F.col("__h.num_frames"),
        "duration_seconds": F.try_divide(F.col("__h.num_frames").cast("double"), F.col("__h.sample_rate")),
        "text_variants": F.filter("text_variants", lambda v: F.coalesce(v["text"].rlike(r"(?U)\S"), F.lit(False))),
    })
    content = [f.name for f in SCHEMA if f.name not in ("record_revision", "audio")]
    return filled.withColumn("record_revision", record_revision(F.struct(*content))).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMA])


def violations(rows: DataFrame) -> Column:
    """What breaks the base table's conventions, as names; empty for a sound record."""
    c = F.col
    known = lambda x: F.coalesce(x, F.lit(False))
    blank = lambda n: known(~c(n).rlike(r"(?U)\S"))
    pair = lambda a, b: c(a).isNull() != c(b).isNull()
    parsed = lambda n: F.try_parse_json(n)
    checks = [(f"blank_{n}", blank(n)) for n in ("text", "text_kind", "language", "speaker_id", "speaker_scope")]
    checks += [("text_without_kind", pair("text", "text_kind")), ("speaker_without_scope", pair("speaker_id", "speaker_scope")), ("incomplete_segment", pair("segment_start_frame", "segment_end_frame"))]
    checks += [("bad_segment", known((c("segment_start_frame") < 0) | (c("segment_start_frame") >= c("segment_end_frame")) | (c("segment_start_frame").isNotNull() & c("parent_sample_id").isNull())))]
    checks += [("bad_split", ~known(c("source_split") == "train")), ("bad_metadata", ~known(F.schema_of_variant(parsed("metadata_json")).startswith("OBJECT")))]
    checks += [("bad_variant", known(F.exists("text_variants", lambda v: ~known(v["kind"].rlike(r"(?U)\S")) | ~known(v["text"].rlike(r"(?U)\S")))))]
    checks += [("bad_timeline", ~known((c("num_frames") > 0) & (c("sample_rate") > 0) & (F.abs(c("duration_seconds") - F.try_divide(c("num_frames"), c("sample_rate"))) < 1e-9)))]
    if "audio" in rows.columns:
        checks += [("audio_hash", ~known(F.sha2("audio.bytes", 256) == c("audio_sha256"))), ("missing_audio", ~known(F.length("audio.bytes") > 0))]
    return F.array_compact(F.array(*[F.when(p, name) for name, p in checks]))

