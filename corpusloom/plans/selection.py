"""The selection plan: base rows and their evidence, through the rules, to decisions.

One plan from scan to decision: rules are columns of the scan, duplicates and reference pools
one aggregation each.  Nothing is written between the steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.functions.digests import text_revision
from corpusloom.functions.hashes import digest64
from corpusloom.operators.dedup import reference_pool, resolve_duplicates
from corpusloom.operators.joins import latest_ok, small
from corpusloom.plans.rules import Evidence, Rules, decide

# Labels of ten languages.
LANGUAGES = ["de", "en", "es", "fr", "ja", "ko", "nl", "pt", "ru", "zh"]
#: The document that the registered queries use.
DOCUMENT = """{
 "reason_priority": [8002, 103, 105, 101, 1003, 1001, 2001, 2002, 2003, 1007, 1008, 1005, 1006, 3003, 3001, 3002, 3004, 7001],
 "duration": [1.0, 30.0],
 "supported_languages": ["de", "en", "es", "fr", "ja", "ko", "nl", "pt", "ru", "zh"],
 "language_aliases": {"en-US": "en", "en-us": "en", "en_gb": "en", "zh-cn": "zh", "zh_hans": "zh", "de-de": "de", "fr-fr": "fr", "ja-jp": "ja", "ko-kr": "ko", "nl-nl": "nl", "pt-br": "pt", "ru-ru": "ru", "es-es": "es", "es_mx": "es"},
 "min_effective_characters": 3,
 "markup_characters": "<>{}[]^\\\\",
 "dense_languages": ["zh", "ja", "ko"],
 "seconds_per_character": {"dense": [0.04, 1.0], "other": [0.015, 0.75]},
 "sample_rates": {"podwild_yard": 24000},
 "held_out": {"field": "original_split_group", "values": ["dev", "test"]},
 "source_priority": ["tidebook_en", "mls_lantern", "harbor_reader", "quill_speech_zh", "crossmic_en", "papercrane_ja", "hanok_voices", "steppe_radio", "ember_quest_voice", "drift_saga_voice", "delta_dialogues", "podwild_long", "podwild_yard", "nonverb_tags"]
}"""


def base_rows(selection: DataFrame) -> DataFrame:
    """Samples, each delivery once, with hashes in one spelling (empty where none is usable)."""
    rows = selection.drop("landed_at").dropDuplicates(["sample_id"])
    return rows.withColumn("audio_sha256", F.coalesce(digest64(F.col("audio_sha256")), F.lit("")))


def with_annotation(base: DataFrame, attempts: DataFrame) -> DataFrame:
    """`base` with the struct `asr`: the last good attempt of each sample, else its last one."""
    best = latest_ok(attempts, "sample_id").select(F.col("sample_id").alias("__id"), F.struct("status", "error_code", "text", "language", "language_mismatch", "candidate_text", "candidate_response").alias("asr"))
    return base.join(best, F.col("sample_id") == F.col("__id"), "left").drop("__id")


def select(base: DataFrame, rules: Rules, evidence: Evidence = Evidence(), utterance: Column | None = None) -> DataFrame:
    """`base` with the final reason and flags: rules, then duplicates, then reference pools."""
    decided = decide(base, rules, evidence)
    annotated = F.col("asr.status").isNotNull() if evidence.asr else None
    out = resolve_duplicates(decided, rules.source_priority, annotated, rules.keep_variants)
    if rules.reference_seconds is not None:
        keyed = out.withColumn("__utterance", tx.utterance_key(F.col("selected_text")) if utterance is None else utterance)
        out = reference_pool(keyed, "speaker_id", "__utterance", "duration_seconds", rules.reference_seconds).drop("__utterance")
    return out


def with_exclusions(base: DataFrame, exclusions: DataFrame, normalization: str = "strip") -> DataFrame:
    """`base` with exclusion_reasons from (sample_id, reason, text_revision).

    A sample may be excluded for several reasons.  An exclusion that names the revision of
    the text it was made for fails the job if the text is another one by now; a null holds
    for any text.
    """
    listed = exclusions.groupBy(F.col("sample_id").alias("__id")).agg(F.collect_set("reason").alias("__reasons"), F.array_compact(F.collect_set("text_revision")).alias("__revisions"))
    rows = base.join(small(listed), F.col("sample_id") == F.col("__id"), "left")
    stale = (F.size("__revisions") > 0) & (F.coalesce(F.array_size("__revisions"), F.lit(0)) > F.when(F.array_contains("__revisions", text_revision(F.col("text"), normalization)), 1).otherwise(0))
    checked = F.when(F.coalesce(stale, F.lit(False)), F.raise_error(F.concat(F.lit("exclusion of another text: "), F.col("sample_id"))).cast("array<int>")).otherwise(F.coalesce("__reasons", F.array().cast("array<int>")))
    return rows.withColumn("exclusion_reasons", checked).drop("__id", "__reasons", "__revisions")


def text_sources(spark: SparkSession, runs: dict[str, tuple[str, str]]) -> DataFrame:
    """(text_source, kind, run, dataset_id): what the codes of selected texts stand for: 0 the base table, then the annotation run of each dataset."""
    rows = [(0, "base", None, None), *((k, kind, run, dataset) for k, (dataset, (kind, run)) in enumerate(sorted(runs.items()), 1))]
    return spark.createDataFrame(rows, "text_source int, kind string, run string, dataset_id string").coalesce(1)


def decision_columns(selected: DataFrame, *more: str) -> DataFrame:
    """What a selection publishes per row: reason, flags and sparse overrides, and the columns `more`."""
    from corpusloom.plans.rules import text_override

    own = text_override(F.col("text"), F.col("selected_text"), F.col("asr.status").isNotNull() if "asr" in selected.columns else F.lit(False))
    language = F.when(~F.col("selected_language").eqNullSafe(F.col("language")), F.col("selected_language"))
    return selected.select("sample_id", F.col("reason").alias("selection_reason"), F.col("flags").alias("selection_flags"), own.alias("selected_text"), language.alias("selected_language"), *more)


def by_reason(decided: DataFrame) -> DataFrame:
    """(dataset_id, reason, n_rows, seconds)."""
    return decided.groupBy("dataset_id", "reason").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("duration_seconds"), 3).alias("seconds"))


def flag_counts(decided: DataFrame) -> DataFrame:
    """(flag, n_rows) of every flag bit, in one pass."""
    from corpusloom.plans.rules import FLAGS

    one = decided.agg(*[F.count_if(F.col("flags").bitwiseAND(F.lit(1 << k)) != 0).alias(n) for k, n in enumerate(FLAGS)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("flag"), F.col(n).alias("n_rows")) for n in FLAGS])))
