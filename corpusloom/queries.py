"""Registered queries of the core: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import audio, digests, frames, models, tags
from corpusloom.functions import text as tx
from corpusloom.functions.hashes import digest64
from corpusloom.operators import aggregates as agg
from corpusloom.operators import dedup, features, joins, sets, speakers
from corpusloom.operators import windows as win
from corpusloom.operators.intervals import periods_and_gaps
from corpusloom.oracle import ORACLE  # noqa: F401
from corpusloom.plans import publication
from corpusloom.plans import selection as plan
from corpusloom.plans.rules import Evidence, Rules, decide, dictionary, primary, revision_text, speaker_outcome, text_override, timeline_violations
from corpusloom.sources import base as base_source
from corpusloom.shared import shared_folder
from corpusloom.sources import carriers, files, sinks
from corpusloom.streaming import events as stream
from corpusloom.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _rules() -> Rules:
    return Rules.from_json(plan.DOCUMENT)


def _base(spark, folder):
    return plan.base_rows(table(spark, folder, "selection"))


def _decided(spark, folder):
    return decide(_base(spark, folder), _rules())


def _ok_asr(spark, folder):
    return joins.latest_ok(table(spark, folder, "qwen_asr"), "sample_id").where("status = 'ok'")


def _with_asr(spark, folder):
    """Samples with their recognised text."""
    asr = _ok_asr(spark, folder).select("sample_id", F.col("text").alias("asr_text"), F.col("language").alias("asr_language"))
    return _base(spark, folder).join(asr, "sample_id")


def _turns(spark, folder):
    """Each recording's turns once."""
    rows = joins.latest_ok(table(spark, folder, "speaker_structure"), "sample_id").where("status = 'ok'")
    return rows.select("sample_id", "result.*")


# --- intervals ------------------------------------------------------------------------


@query
def p1_found(spark, folder):
    segments = table(spark, folder, "selection", "parent_sample_id", "segment_start_frame", "segment_end_frame").where("parent_sample_id is not null")
    turns = table(spark, folder, "speaker_structure").where("status = 'ok'").select("sample_id", F.explode("result.turns").alias("t"))
    rows = segments.select(F.lit("segment").alias("entity_kind"), F.col("parent_sample_id").alias("entity_id"), F.lit("").alias("speaker"), F.col("segment_start_frame").alias("a"), F.col("segment_end_frame").alias("b")).unionByName(
        turns.select(F.lit("turn").alias("entity_kind"), F.col("sample_id").alias("entity_id"), F.col("t.speaker").alias("speaker"), F.col("t.start_sample").alias("a"), F.col("t.end_sample").alias("b"))
    )
    return periods_and_gaps(rows, ["entity_kind", "entity_id", "speaker"], "a", "b").withColumnsRenamed({"span_start": "start_frame", "span_end": "end_frame"})


@query
def interval_union(spark, folder):
    spans = speakers.spans(F.col("turns"))
    return _turns(spark, folder).select("sample_id", speakers.union_length(spans).alias("union_frames"), F.size(speakers.merged(spans)).alias("periods"))


@query
def interval_overlaps(spark, folder):
    rows = _turns(spark, folder).select("sample_id", F.explode("turns").alias("t")).select("sample_id", F.col("t.speaker").alias("speaker"), F.col("t.start_sample").alias("a"), F.col("t.end_sample").alias("b")).where("speaker is not null")
    return joins.interval_overlaps(rows, ["sample_id"], "speaker", "a", "b")


@query
def speaker_structure_measures(spark, folder):
    sound = F.filter("turns", lambda t: (t["start_sample"] >= 0) & (t["start_sample"] < t["end_sample"]) & t["speaker"].isNotNull())
    return _turns(spark, folder).withColumn("turns", sound).select("sample_id", speakers.structure(F.col("turns"), F.col("num_frames")).alias("m")).select("sample_id", "m.speaker_count", "m.turn_union_samples", "m.overlap_samples", F.round("m.overlap_ratio", 9).alias("overlap_ratio"), F.round("m.dominant_speaker_ratio", 9).alias("dominant_speaker_ratio"))


@query
def runs_of_mask(spark, folder):
    rows = table(spark, folder, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "v"))
    return win.mask_runs(rows, "vec_id", "pos", F.col("v") > 0)


# --- rules ----------------------------------------------------------------------------


@query
def rule_engine_decisions(spark, folder):
    return _decided(spark, folder).select("sample_id", "selected_language", "reason", "flags")


@query
def reason_histogram(spark, folder):
    return plan.by_reason(_decided(spark, folder))


@query
def flag_bit_counts(spark, folder):
    return plan.flag_counts(_decided(spark, folder))


@query
def rule_engine_with_evidence(spark, folder):
    """All rule families at once: recognised text, repetition, scripts, verification, speakers."""
    rules = Rules(
        reason_priority=[1003, 1001, 2001, 2002, 2003, 2004, 1009, 1007, 1008, 1004, 1005, 1006, 6002, 3001, 3002, 7001], duration=(1.0, 30.0), supported_languages=plan.LANGUAGES,
        language_aliases=_rules().language_aliases, min_effective_characters=3, markup_characters="<>{}[]^\\", dense_languages=["zh", "ja", "ko"], seconds_per_character={"dense": (0.04, 1.0), "other": (0.015, 0.75)},
        repetition={"char_languages": ["zh", "ja", "ko"], "word_min_units": 20, "word_n": 4, "char_min_units": 30, "char_n": 10, "min_count": 3, "min_coverage": 0.8},
        script={"expected": {"zh": ["han"], "ja": ["han", "kana"], "ko": ["hangul"], "ru": ["CYRILLIC"], "default": ["latin"]}, "min_share": 0.5}, asr_labels=tx.LANGUAGE_NAMES, required_speakers=1,
    )
    one = joins.latest_ok(table(spark, folder, "speaker_structure"), "sample_id").select(F.col("sample_id").alias("__s"), F.struct("status", F.col("result.speaker_count").alias("speaker_count")).alias("speakers"))
    rows = plan.with_annotation(_base(spark, folder), table(spark, folder, "qwen_asr")).join(one, F.col("sample_id") == F.col("__s"), "left").drop("__s")
    return decide(rows, rules, Evidence(asr=True, speakers=True)).select("sample_id", "reason", "flags", F.col("repeated.path").alias("repetition_path"))


@query
def selected_rows(spark, folder):
    return plan.select(_base(spark, folder), _rules()).where("reason = 0").groupBy("dataset_id", "selected_language").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("duration_seconds"), 3).alias("seconds"))


@query
def sparse_override(spark, folder):
    rows = _with_asr(spark, folder)
    chosen = F.coalesce(tx.strip(F.col("asr_text")), F.lit(""))
    return rows.select("sample_id", text_override(F.col("text"), chosen, F.lit(True)).alias("selected_text")).where("selected_text is not null")


@query
def revision_as_text(spark, folder):
    rows = joins.latest_ok(table(spark, folder, "qwen_asr"), "sample_id").withColumn("action", F.when(F.col("status") == "ok", F.when(F.col("text").rlike(r"\S"), "replace").otherwise("keep")))
    joined = _base(spark, folder).select("sample_id", F.col("text").alias("base_text")).join(rows, "sample_id")
    return joined.select("sample_id", revision_text(F.col("base_text"), F.col("status"), F.col("action"), F.col("text")).alias("revised_text"))


@query
def alias_language(spark, folder):
    known = table(spark, folder, "language_aliases").select(F.regexp_replace(F.lower(F.trim("alias")), "-", "_").alias("k"), F.col("language").alias("code"))
    rows = table(spark, folder, "selection").select("language", F.regexp_replace(F.lower(F.trim("language")), "-", "_").alias("k"))
    return rows.join(joins.small(known), "k", "left").groupBy("code").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def density_bounds(spark, folder):
    chars = F.length(tx.effective_characters(F.col("text")))
    rows = _base(spark, folder).withColumn("chars", chars).where("chars > 0")
    pace = F.col("duration_seconds") / F.col("chars")
    return rows.select("sample_id", F.col("chars").cast("long").alias("chars"), F.when(pace < 0.015, 1005).when(pace > 0.75, 1006).otherwise(0).alias("reason"))


@query
def markup_flag(spark, folder):
    marked = F.translate("text", "<>{}[]^\\", "") != F.col("text")
    return table(spark, folder, "selection").groupBy("dataset_id").agg(F.count_if(marked).alias("marked"), F.count("text").alias("texts"))


@query
def known_exclusions(spark, folder):
    """Samples of a single frame, and ones beyond 300 seconds, which no rule document admits."""
    return _base(spark, folder).groupBy("dataset_id").agg(F.count_if(F.col("num_frames") == 1).alias("single_frame"), F.count_if(F.col("duration_seconds") > 300).alias("too_long"))


@query
def timeline_checks(spark, folder):
    return agg.array_histogram(_base(spark, folder).withColumn("v", timeline_violations()), "v")


@query
def base_record_violations(spark, folder):
    rows = table(spark, folder, "selection")
    return agg.array_histogram(rows.withColumn("v", base_source.violations(rows)), "v")


@query
def reason_dictionary(spark, folder):
    return dictionary(spark, "reasons").unionByName(dictionary(spark, "flags"))


@query
def speaker_count_outcomes(spark, folder):
    rows = joins.latest_ok(table(spark, folder, "speaker_structure"), "sample_id")
    judged = rows.select(F.struct("status", F.col("result.speaker_count").alias("speaker_count")).alias("speakers"))
    return judged.groupBy(speaker_outcome(1).alias("outcome")).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def primary_reason_order(spark, folder):
    hit = [(F.col("num_frames") < 24000, 3001), (F.col("duration_seconds") > 10, 3002), (F.col("text").isNull(), 1001)]
    return _base(spark, folder).select("sample_id", primary(hit, [1001, 3002]).alias("reason"))


# --- duplicates and candidates --------------------------------------------------------


def _for_groups(spark, folder):
    return _decided(spark, folder).select("sample_id", "dataset_id", "audio_sha256", "reason", "flags", "selected_text", "selected_language")


@query
def exact_dup_groups(spark, folder):
    return dedup.duplicate_groups(_for_groups(spark, folder), _rules().source_priority).select("audio_sha256", "members", "eligible", "conflict", "winner")


@query
def dup_members_with_winner(spark, folder):
    rows = dedup.resolve_duplicates(_for_groups(spark, folder), _rules().source_priority)
    return rows.where("members is not null").select("sample_id", "audio_sha256", "reason", "flags", "winner")


@query
def held_out_propagation(spark, folder):
    rows = dedup.resolve_duplicates(_for_groups(spark, folder), _rules().source_priority)
    return rows.where("members is not null and reason = 7001").groupBy("dataset_id").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def closed_reference_pool(spark, folder):
    rows = _decided(spark, folder).withColumn("utterance", tx.effective_sql(F.lower("selected_text")))
    return dedup.reference_pool(rows, "speaker_id", "utterance", "duration_seconds", 3.0).select("sample_id", "reason", "flags")


@query
def priority_upsert_dedup(spark, folder):
    return dedup.priority_candidates(table(spark, folder, "ids"))


@query
def conservation_counts(spark, folder):
    return dedup.candidate_audit(dedup.priority_candidates(table(spark, folder, "ids")))


@query
def repeated_keys_having(spark, folder):
    return dedup.repeated_keys(table(spark, folder, "selection"), "sample_id")


@query
def identity_audit(spark, folder):
    return dedup.identity_audit(table(spark, folder, "selection"), "sample_id", "source_config")


# --- joins ----------------------------------------------------------------------------


@query
def annotation_align_left(spark, folder):
    found = joins.verified_join(_base(spark, folder).select("sample_id", "dataset_id"), joins.latest_ok(table(spark, folder, "qwen_asr"), "sample_id"), "sample_id")
    return found.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("n_rows"), F.count("matched").alias("annotated"), F.count_if(F.col("matched.status") == "ok").alias("ok"), F.count("problem").alias("problems"))


@query
def latest_attempts(spark, folder):
    return joins.latest_ok(table(spark, folder, "qwen_asr"), "sample_id").select("sample_id", "status", "error_code", "finished_at")


@query
def annotation_structs(spark, folder):
    rows = joins.annotated(_base(spark, folder).select("sample_id"), joins.latest_ok(table(spark, folder, "qwen_asr"), "sample_id"), "sample_id", ["text", "language"], F.col("status") == "ok")
    return rows.select("sample_id", F.col("annotation.status").alias("status"), F.col("annotation.result").isNull().alias("no_result"))


@query
def merge_three_tables(spark, folder):
    tables = {
        "base": _base(spark, folder).select("sample_id", "audio_sha256", "dataset_id", "num_frames"),
        "asr": _ok_asr(spark, folder).select("sample_id", digest64(F.col("audio_sha256")).alias("audio_sha256"), "dataset_id", "text"),
        "turns": _turns(spark, folder).select("sample_id", digest64(F.col("audio_sha256")).alias("audio_sha256"), "speaker_count", "num_frames"),
    }
    merged = joins.merge_features({"base": tables["base"], "asr": tables["asr"]}, "sample_id", ["audio_sha256", "dataset_id"])
    both = merged.join(tables["turns"].select("sample_id", "speaker_count", F.col("num_frames").alias("turn_frames")), "sample_id")
    return both.select("sample_id", "dataset_id", F.size("mismatched").alias("mismatches"), F.length("asr_text").alias("text_length"), "speaker_count", (F.col("turn_frames") - F.col("base_num_frames")).alias("frame_difference"))


@query
def excluded_reason_counts(spark, folder):
    return joins.merge_accounting({"asr": joins.latest_ok(table(spark, folder, "qwen_asr"), "sample_id"), "turns": joins.latest_ok(table(spark, folder, "speaker_structure"), "sample_id")}, "sample_id")


@query
def config_overlap_self_join(spark, folder):
    return joins.shared_keys(table(spark, folder, "selection"), "source_config", "speaker_id")


@query
def reuse_plan(spark, folder):
    old = table(spark, folder, "qwen_asr").select("sample_id", "status", "dataset_id", F.col("source_language").alias("language"))
    return joins.reusable(old, _base(spark, folder).select("sample_id", "dataset_id", "language", "source_config"), "sample_id", ["dataset_id", "language"], "source_config")


@query
def unfinished_work(spark, folder):
    return stream.unfinished(table(spark, folder, "qwen_asr"), "sample_id")


@query
def incremental_inputs(spark, folder):
    done = table(spark, folder, "qwen_asr").where("status = 'ok'")
    return stream.missing_from(_base(spark, folder).select("sample_id", "dataset_id"), done, "sample_id").groupBy("dataset_id").agg(F.count(F.lit(1)).alias("to_do"))


# --- windows --------------------------------------------------------------------------


@query
def per_speaker_topk_hash(spark, folder):
    rows = _base(spark, folder).where("speaker_id is not null and duration_seconds between 1 and 30").select("speaker_id", "sample_id")
    return win.topk_by_hash(rows, "speaker_id", "sample_id", 3, "20261010")


@query
def fragment_offsets(spark, folder):
    return win.running_offsets(_base(spark, folder), "dataset_id")


@query
def fixed_slices(spark, folder):
    return win.slices(_base(spark, folder).select("dataset_id", "sample_id"), "dataset_id", "sample_id", 100).groupBy("dataset_id", "slice_no").agg(F.count(F.lit(1)).alias("n_rows"), F.min("sample_id").alias("first_id"))


@query
def adjacent_segments(spark, folder):
    rows = _base(spark, folder).where("parent_sample_id is not null and segment_start_frame >= 0 and segment_start_frame < segment_end_frame").select("parent_sample_id", "segment_start_frame", "segment_end_frame").distinct()
    return win.islands(rows, "parent_sample_id", "segment_start_frame", "segment_end_frame")


@query
def source_rotation(spark, folder):
    return win.interleaved(_base(spark, folder).select("dataset_id", "sample_id"), "dataset_id", "sample_id")


@query
def spread_sample(spark, folder):
    return win.spread_sample(_base(spark, folder).select("dataset_id", "sample_id"), "dataset_id", "sample_id", 4)


@query
def length_bucket_batches(spark, folder):
    length = frames.resampled_length(F.col("num_frames"), F.col("sample_rate"), 24000)
    rows = _base(spark, folder).where("sample_rate > 0").withColumn("length", length)
    made = win.length_batches(rows, "length", "sample_id", frames.batch_frames(F.col("length")), frames.batch_size(F.col("bucket")))
    return made.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_rows"), F.max("batch_size").alias("batch_size"))


@query
def budget_batches(spark, folder):
    made = win.budget_batches(_base(spark, folder).where("num_frames > 0"), "num_frames", "sample_id", 48_000_000)
    return made.groupBy("salt", "batch_no").agg(F.count(F.lit(1)).alias("n_rows"), F.max("length").alias("longest"))


@query
def window_energy(spark, folder):
    rows = table(spark, folder, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "v"))
    return win.window_energy(rows, "vec_id", "pos", "v", 10).withColumn("energy", F.round("energy", 6))


@query
def edge_levels(spark, folder):
    rows = table(spark, folder, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "v"))
    return win.loud_edges(rows, "vec_id", "pos", "v", 0.5)


# --- text -----------------------------------------------------------------------------


@query
def effective_chars(spark, folder):
    return _base(spark, folder).select("sample_id", tx.effective_characters(F.col("text")).alias("chars"))


@query
def stripped_text(spark, folder):
    return _base(spark, folder).select("sample_id", tx.strip(F.col("text")).alias("stripped"), tx.blank_to_null(F.col("text")).isNull().alias("blank"))


@query
def comparable_text(spark, folder):
    return _base(spark, folder).select("sample_id", tx.comparable(F.col("text"), {"colour": "color"}).alias("form"))


@query
def edit_distance_bounded(spark, folder):
    rows = _with_asr(spark, folder).where("text is not null and asr_text is not null")
    return rows.select("sample_id", tx.edits_within(F.col("text"), F.col("asr_text"), F.lit(5)).alias("edits"))


@query
def verified_text(spark, folder):
    rows = _with_asr(spark, folder)
    variants = F.when(F.col("text").isNotNull(), F.array(F.struct(F.lit("base").alias("kind"), F.col("text").alias("text"), F.col("language").alias("language"))))
    return rows.select("sample_id", tx.verify_text(F.col("asr_text"), variants, "base", (1, 100)).alias("verdict"))


@query
def ngram_repetition(spark, folder):
    rule = {"char_languages": ["zh", "ja", "ko"], "word_min_units": 20, "word_n": 4, "char_min_units": 30, "char_n": 10, "min_count": 3}
    return _base(spark, folder).select("sample_id", tx.repetition(F.col("text"), F.col("language"), rule).alias("r")).select("sample_id", "r.*")


@query
def script_share(spark, folder):
    rule = {"expected": {"zh": ["han"], "ja": ["han", "kana"], "ko": ["hangul"], "ru": ["CYRILLIC"], "default": ["latin"]}}
    return _base(spark, folder).select("sample_id", tx.script_share(F.col("text"), F.col("language"), rule).alias("share"))


@query
def utterance_keys(spark, folder):
    return _base(spark, folder).select("sample_id", tx.utterance_key(F.col("text")).alias("utterance"))


@query
def language_labels(spark, folder):
    rows = _ok_asr(spark, folder)
    return rows.groupBy("language", tx.lookup(F.col("language"), tx.LANGUAGE_NAMES).alias("code")).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def spoken_labels(spark, folder):
    return _base(spark, folder).groupBy(tx.spoken_language(F.lower("language")).alias("spoken")).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def transcript_replies(spark, folder):
    reply = F.concat(F.lit("language "), F.coalesce("language", F.lit("None")), F.lit("<asr_text>"), F.coalesce("text", F.lit("")))
    return _ok_asr(spark, folder).select("sample_id", tx.parse_transcript(reply).alias("p")).select("sample_id", "p.*")


@query
def quoted_speakers(spark, folder):
    return table(spark, folder, "selection").select("speaker_id", tx.quoted(F.col("speaker_id")).alias("quoted")).distinct()


@query
def event_tags(spark, folder):
    """The markup that texts really hold, by the dialect that it is written in."""
    dialect = F.when(F.contains("text", F.lit("<")), "angled").otherwise("bracketed")
    rows = _base(spark, folder).where(F.col("text").rlike(r"[<>\[\]]"))
    return rows.select("sample_id", tags.convert_tags(F.col("text"), dialect).alias("t")).select("sample_id", "t.text", F.array_join("t.target_tags", ",").alias("target_tags"), "t.action", "t.error")


@query
def corpus_cer(spark, folder):
    rows = _with_asr(spark, folder).where("text is not null and asr_text is not null")
    return agg.error_rate(rows, tx.effective_sql(F.lower("text")), tx.effective_sql(F.lower("asr_text")), "dataset_id").withColumn("rate", F.round("rate", 9))


# --- digests, spans and frames --------------------------------------------------------


@query
def sample_digests(spark, folder):
    return _base(spark, folder).select("sample_id", digests.digest_strings(F.col("dataset_id"), F.lit("v1"), F.col("source_key")).alias("digest"))


@query
def text_revisions(spark, folder):
    return _base(spark, folder).select("sample_id", digests.text_revision(F.col("text"), "strip").alias("revision"))


@query
def record_revisions(spark, folder):
    return _base(spark, folder).select("sample_id", digests.record_revision(F.struct("dataset_id", "source_key", "text", "language", "num_frames")).alias("revision"))


@query
def vector_digests(spark, folder):
    return table(spark, folder, "embeddings").select("vec_id", digests.vector_digest(F.col("embedding")).alias("sha256"))


@query
def reference_spans(spark, folder):
    rows = _base(spark, folder).where("sample_rate > 0")
    return rows.select("sample_id", digests.reference_spans(F.col("num_frames"), F.col("sample_rate"), F.col("sample_id"), 7).alias("s")).select("sample_id", "s.*")


@query
def prefix_spans(spark, folder):
    rows = _base(spark, folder).where("sample_rate > 0")
    return rows.select("sample_id", digests.reference_spans(F.col("num_frames"), F.col("sample_rate"), F.col("sample_id"), 7, prefix=True).alias("s")).select("sample_id", "s.*")


@query
def patch_spans(spark, folder):
    rows = _base(spark, folder).where("sample_rate > 0").withColumn("latents", F.floor(F.col("num_frames") * 25 / F.col("sample_rate")))
    return rows.select("sample_id", digests.patch_span(F.col("sample_id"), F.col("latents")).alias("s")).select("sample_id", "s.start", "s.end")


@query
def frame_arithmetic(spark, folder):
    rows = _base(spark, folder).where("sample_rate > 0")
    length = frames.resampled_length(F.col("num_frames"), F.col("sample_rate"), 24000)
    return rows.select("sample_id", length.alias("resampled"), frames.codec_frames(length).alias("codec_frames"), frames.within_tolerance(length - F.floor(F.col("duration_seconds") * 24000), F.lit(24000)).alias("agrees"))


@query
def vector_finite_norm(spark, folder):
    return table(spark, folder, "embeddings").groupBy(frames.valid_vector(F.col("embedding"), 64).alias("valid")).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def nested_array_validate(spark, folder):
    """Turns as pairs of codes, some of which are beyond the 2048 that are allowed."""
    codes = F.transform("turns", lambda t: F.array(F.pmod(t["start_sample"], F.lit(2060)).cast("int"), F.pmod(t["end_sample"], F.lit(2060)).cast("int")))
    return _turns(spark, folder).select("sample_id", frames.valid_codes(codes, F.size("turns"), 2, 2048).alias("valid"))


@query
def lower_percentile(spark, folder):
    return table(spark, folder, "embeddings").select("vec_id", frames.lower_percentile(F.col("embedding"), 0.9).alias("p90"), frames.lower_percentile(F.col("embedding"), 0.5).alias("p50"))


@query
def equivalent_vectors(spark, folder):
    rows = table(spark, folder, "embeddings")
    moved = F.transform("embedding", lambda x: x * F.lit(1.0 + 1e-4).cast("float"))
    return rows.groupBy(frames.equivalent(F.col("embedding"), moved, 0.0, 1e-3).alias("close"), frames.equivalent(F.col("embedding"), moved, 0.0, 1e-6).alias("closer")).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def run_stamps(spark, folder):
    return table(spark, folder, "qwen_asr").where("finished_at is not null").select("sample_id", frames.run_stamp(F.col("finished_at").cast("timestamp")).alias("stamp")).distinct()


@query
def json_score_import(spark, folder):
    score = frames.json_score(F.col("metadata_json"), "$.upstream.dnsmos")
    return _base(spark, folder).select("dataset_id", score.alias("s")).groupBy("dataset_id", "s.status", "s.error_code").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.avg("s.score"), 6).alias("mean_score"))


@query
def metadata_paths(spark, folder):
    rows = _base(spark, folder)
    return rows.groupBy(F.get_json_object("metadata_json", "$.original_split").alias("original_split"), F.get_json_object("metadata_json", "$.upstream.split").alias("upstream_split")).agg(F.count(F.lit(1)).alias("n_rows"))


# --- summaries and sets ---------------------------------------------------------------


@query
def null_empty_audit(spark, folder):
    return agg.null_audit(table(spark, folder, "selection"), ["text", "language", "speaker_id", "group_id", "audio_sha256", "metadata_json", "segment_start_frame", "repetition"])


@query
def pivot_crosscheck(spark, folder):
    return agg.cross_check(table(spark, folder, "qwen_asr"), "dataset_id", "status", ["ok", "failed", "skipped"])


@query
def histogram_quantiles(spark, folder):
    bins = agg.histogram(_base(spark, folder), "duration_seconds", 0.25, "dataset_id")
    return agg.histogram_summary(bins, 0.25, [0.05, 0.5, 0.95], "dataset_id").withColumn("mean", F.round("mean", 6))


@query
def score_summary(spark, folder):
    rows = _base(spark, folder).withColumn("score", F.get_json_object("metadata_json", "$.upstream.dnsmos").cast("double"))
    out = agg.numeric_summary(rows, "score", 1.0, 3.5, "dataset_id")
    return out.withColumn("mean", F.round("mean", 6))


@query
def array_histogram(spark, folder):
    return agg.array_histogram(table(spark, folder, "datasets"), "languages")


@query
def status_coverage(spark, folder):
    return agg.coverage(joins.latest_ok(table(spark, folder, "qwen_asr"), "sample_id"), "status", "dataset_id")


@query
def task_gates(spark, folder):
    return agg.gate(table(spark, folder, "qwen_asr"), "status", 32, "dataset_id")


@query
def ordered_digest(spark, folder):
    rows = win.slices(_base(spark, folder).select("dataset_id", "sample_id"), "dataset_id", "sample_id", 250).withColumn("task", F.concat_ws(":", "dataset_id", "slice_no"))
    return agg.ordered_digest(rows, "task", "sample_id", "sample_id")


@query
def set_fingerprint(spark, folder):
    return agg.set_digest(_base(spark, folder), "sample_id")


@query
def shard_gaps(spark, folder):
    rows = table(spark, folder, "ids").select(F.col("archive").alias("shard"), F.lit(64).alias("total"), F.col("carrier_type"))
    return agg.shard_gaps(rows, "shard", "total", "carrier_type")


@query
def set_equality_both_ways(spark, folder):
    return sets.set_difference(_base(spark, folder), table(spark, folder, "qwen_asr"), "sample_id").groupBy("problem").agg(F.count(F.lit(1)).alias("n_keys"))


@query
def redelivered_rows(spark, folder):
    """Attempts of one annotation that another doesn't have as often, and the other way round."""
    return sets.bag_difference(*[table(spark, folder, name, "sample_id", "status") for name in ("qwen_asr", "speaker_structure")]).select("sample_id", "status", F.col("surplus").cast("long").alias("surplus"))


@query
def inherited_exclusions(spark, folder):
    parent = table(spark, folder, "qwen_asr").where("status = 'failed'").select("sample_id").distinct().withColumn("origin", F.lit("parent"))
    more = table(spark, folder, "speaker_structure").where("status = 'failed'").select("sample_id").distinct().withColumn("origin", F.lit("addition"))
    return sets.inherited(parent, more, "sample_id")


@query
def split_coverage(spark, folder):
    rows = _base(spark, folder).select("sample_id", "sample_rate")
    return sets.covered([rows.where("sample_rate <= 22050"), rows.where("sample_rate >= 22050")], rows, "sample_id").groupBy("problem").agg(F.count(F.lit(1)).alias("n_keys"))


# --- files, audio, models -------------------------------------------------------------


@query
def snapshot_round_trip(spark, folder):
    rows = plan.decision_columns(plan.select(_base(spark, folder), _rules()))
    made = sinks.publish(rows, shared_folder(spark) + "/tables", "decisions", "sample_id", {"rules": 1})
    return made.read(spark).where("selection_reason = 0").agg(F.count(F.lit(1)).alias("selected"))


@query
def selection_publication(spark, folder):
    """Rows of each part of a selection that was published as a whole and opened again."""
    base, root = _base(spark, folder), shared_folder(spark) + f"/selections-{uuid.uuid4().hex}"
    failed = table(spark, folder, "speaker_structure").where("status = 'failed'").select("sample_id", F.lit(105).alias("reason"))
    publication.publish_selection(plan.select(base, _rules()), root, "corpus", _rules(), sinks.pin(base, "sample_id"), failed, plan.text_sources(spark, {"tidebook_en": ("asr", "run-1")}))
    parts = [s.read(spark).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(part).alias("part"), "n_rows") for part, s in publication.open_selection(spark, root, "corpus").items()]
    return functools.reduce(DataFrame.unionByName, parts)


@query
def sample_exclusions(spark, folder):
    """Decisions where recordings whose diarisation failed are listed as excluded, for the text that they have."""
    base = _base(spark, folder)
    failed = table(spark, folder, "speaker_structure").where("status = 'failed'").select("sample_id").distinct()
    listed = base.join(failed, "sample_id").select("sample_id", F.lit(105).alias("reason"), digests.text_revision(F.col("text"), "strip").alias("text_revision"))
    return decide(plan.with_exclusions(base, listed), _rules(), Evidence(sample_exclusion=True)).select("sample_id", "reason", "flags")


@query
def generation_units(spark, folder):
    return _base(spark, folder).groupBy(digests.generation_unit(F.col("text_kind"), F.col("language")).alias("unit")).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def run_throughput(spark, folder):
    rows = table(spark, folder, "qwen_asr").select("dataset_id", "status", (F.col("finished_at") - F.expr("make_dt_interval(0, 0, attempts)")).alias("began"), "finished_at", "request_frames")
    out = agg.throughput(rows, "dataset_id", "status", "began", "finished_at", "request_frames")
    return out.withColumns({"busy_seconds": F.round("busy_seconds", 3), "rows_per_second": F.round("rows_per_second", 6)})


@query
def source_inventory(spark, folder):
    """Files and bytes of the folder by extension; from the listing, so no SQL can check it."""
    return files.inventory(spark, folder).groupBy("extension").agg(F.sum("files").alias("files"), F.sum("n_bytes").alias("n_bytes"))


@query
def placed_rows(spark, folder):
    return files.parquet_rows(spark, f"{folder}/ids.parquet").select("short_id", "archive", "row_number", F.col("_row").alias("row_index"))


def _tone(spark, folder):
    """A small WAV file per embedding: its values as 16-bit samples."""
    body = F.array_join(F.transform("embedding", lambda x: F.concat(F.substring(F.hex(F.pmod(F.round(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x)) * 32000).cast("int"), F.lit(65536)) + 65536), 4, 2), F.substring(F.hex(F.pmod(F.round(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x)) * 32000).cast("int"), F.lit(65536)) + 65536), 2, 2))), "")
    header = "52494646A400000057415645666D74201000000001000100401F0000803E00000200100064617461" + "80000000"
    return table(spark, folder, "embeddings").select("vec_id", F.unhex(F.concat(F.lit(header), body)).alias("audio"))


@query
def audio_statistics(spark, folder):
    found = audio.audio_statistics(_tone(spark, folder), "vec_id", "audio")
    return found.select("vec_id", "status", "sample_rate", "n_frames", *[F.round(c, 6).alias(c) for c in ("peak", "rms", "dc_offset", "bandwidth_hz")])


@query
def audio_containers(spark, folder):
    """Every other vector's file with the first bytes of another container."""
    first = F.element_at(F.array(*[F.lit(m) for m in (b"fLaC", b"OggS", b"caff", b"ID3", b"\xff\xfb", b"none")]), (F.col("vec_id") % 6 + 1).cast("int"))
    audio_ = F.when(F.col("vec_id") % 2 == 0, F.col("audio")).otherwise(F.concat(first, F.col("audio")))
    return _tone(spark, folder).groupBy(audio.container(audio_).alias("container")).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def model_annotation(spark, folder):
    found = models.annotate(_base(spark, folder), "sample_id", "text", models.hashed_embedding(4), "array<double>")
    return found.groupBy("status", "error_code").agg(F.count(F.lit(1)).alias("n_rows"))


# --- features and carriers ------------------------------------------------------------


@query
def selected_metadata(spark, folder):
    base = _base(spark, folder)
    return features.selected_metadata(plan.decision_columns(plan.select(base, _rules())), base)


@query
def status_row_violations(spark, folder):
    rows = table(spark, folder, "qwen_asr")
    checks = [*features.payload_violations("text"), ("blank_payload", F.col("text").isNull() | F.col("text").rlike(r"(?U)\S")), ("unfinished", F.col("finished_at").isNotNull()), ("several_attempts", F.col("attempts") <= 1)]
    return agg.array_histogram(rows.withColumn("v", features.violations(*checks)), "v", "dataset_id")


@query
def task_chains(spark, folder):
    rows = win.slices(_base(spark, folder).select("dataset_id", "sample_id"), "dataset_id", "sample_id", 250).withColumn("task", F.concat_ws(":", "dataset_id", "slice_no"))
    return features.chained_digest(rows, "task", "sample_id", "sample_id", "dataset_id")


@query
def attached_references(spark, folder):
    base = _base(spark, folder).where("sample_rate > 0")
    codec = base.select("sample_id", "audio_sha256", F.col("num_frames").alias("end_frame"), F.col("sample_rate").alias("native_sample_rate"))
    targets = _ok_asr(spark, folder).select("sample_id", F.coalesce(digest64(F.col("audio_sha256")), F.lit("")).alias("audio_sha256"))
    found = features.attach_references(targets, codec, "sample_id", 7, ["audio_sha256"])
    return found.select("sample_id", "problem", "reference.start_step", "reference.end_step")


@query
def carrier_candidates(spark, folder):
    end = F.col("native_frames") + F.col("archive") % 3 - 1
    short = F.array(F.struct(F.col("short_id").alias("id"), F.lit(0).alias("rel_start_samples"), end.alias("rel_end_samples"), F.col("semantic_hash").alias("text"), F.col("language")))
    meta = F.to_json(F.struct(F.col("carrier_type").alias("type"), F.col("short_id").alias("id"), "recording_id", F.col("native_frames").alias("frames"), "sample_rate", short.alias("short")))
    made = carriers.candidates(table(spark, folder, "ids").select("archive", "row_number", meta.alias("metadata_json")))
    return made.groupBy("carrier_type", "priority", "error", "carrier_error").agg(F.count(F.lit(1)).alias("n_rows"))


# --- streams --------------------------------------------------------------------------


def _events(spark, folder):
    return stream.stream_table(spark, f"{folder}/events*.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


@query
def stream_tumbling(spark, folder):
    return stream.run_available(stream.tumbling_counts(_events(spark, folder), "ts", "1 hour", "365 days", "event_type"), "tumbling", "update").groupBy("window_start", "event_type").agg(F.max("n").alias("n"))


@query
def stream_sessions(spark, folder):
    """All sessions, those that are still open when the input ends too."""
    return stream.run_available(stream.sessions(_events(spark, folder), "ts", "30 minutes", "1 hour", "user_id"), "sessions", "complete")


@query
def stream_once(spark, folder):
    return stream.run_available(stream.once(_events(spark, folder), "ts", "3650 days", "event_id").select("event_id", "event_type"), "once")


@query
def stream_stalls(spark, folder):
    return stream.run_available(stream.stalls(_events(spark, folder), "user_id", "ts", 3600, "1 minute"), "stalls")

