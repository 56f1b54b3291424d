"""Selection rules as data, compiled to Catalyst expressions.

A rule document names bounds, allowed values and priorities.  Compiled, every rule is one
independent predicate that gives a reason code and flag bits; all are evaluated in the scan's
own plan, flags accumulate, and the primary reason is the first code of the document's
priority list that was hit.  A hit code that the list doesn't name leaves the row selected.

Nulls: a predicate that is null is no hit, except where a rule is about missing values.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as tx

# Reason codes and their names.
REASONS = {
    0: "selected", 101: "missing_audio", 102: "decode_failed", 103: "invalid_audio", 104: "invalid_timeline",
    105: "source_timeline_unverified", 1001: "missing_text", 1002: "confirmed_mismatch", 1003: "text_source_unavailable",
    1004: "text_repetition", 1005: "text_too_dense", 1006: "text_too_sparse", 1007: "text_markup", 1008: "asr_chunk_join",
    1009: "text_disagreement", 2001: "missing_language", 2002: "unsupported_language", 2003: "language_evidence_conflict",
    2004: "text_script_mismatch", 3001: "below_duration_policy", 3002: "above_duration_policy", 3003: "below_sample_rate_policy",
    3004: "source_config_not_selected", 3005: "instruction_unavailable", 4001: "duplicate_not_selected",
    4002: "conflicting_duplicate", 5001: "reference_identity_unavailable", 5002: "reference_pair_unavailable",
    6002: "not_single_speaker", 7001: "held_out", 8002: "not_sampled", 65535: "pending",
}
# Names of the flag bits, from bit 0.
FLAGS = [
    "audio_issue", "missing_text", "pairing_issue", "language_policy", "duration_policy", "duplicate_member",
    "duplicate_conflict", "reference_policy", "held_out", "confirmed_exclusion", "source_timeline", "text_policy",
    "language_evidence", "quality_policy", "parent_policy", "speaker_policy", "sample_rate_policy", "source_config_policy",
    "sampling_policy", "instruction_policy",
]
BIT = {name: 1 << k for k, name in enumerate(FLAGS)}
# Version of the dictionaries by the rule family that needs it.
FAMILY_VERSIONS = {"base": 2, "speakers": 5, "verification": 6, "sample_rates": 7, "configs": 8, "sample_list": 9, "instructions": 10}


def present(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


@dataclass(frozen=True)
class Rules:
    """A rule document.  Every part but the duration bounds may be left out."""

    reason_priority: list[int]
    duration: tuple[float, float] = (0.0, float("inf"))
    supported_languages: list[str] = field(default_factory=list)
    language_aliases: dict[str, str] = field(default_factory=dict)
    require_language: bool = True
    min_effective_characters: int | None = None
    markup_characters: str = ""
    dense_languages: list[str] = field(default_factory=list)
    seconds_per_character: dict[str, tuple[float, float]] | None = None
    repetition: dict | None = None
    script: dict | None = None
    asr_labels: dict[str, str] | None = None
    verification: dict | None = None
    held_out: dict | None = None
    sample_rates: dict[str, int] = field(default_factory=dict)
    source_configs: list[str] | None = None
    required_speakers: int | None = None
    source_priority: list[str] = field(default_factory=list)
    reference_seconds: float | None = None
    keep_variants: bool = False

    @classmethod
    def from_json(cls, document: str) -> Rules:
        """Reads a document; unknown names, codes and impossible bounds are errors."""
        raw = json.loads(document)
        unknown = set(raw) - set(cls.__dataclass_fields__)
        if unknown:
            raise ValueError(f"unknown rules: {sorted(unknown)}")
        for name in ("duration",):
            if name in raw:
                raw[name] = tuple(raw[name])
        rules = cls(**raw)
        rules.check()
        return rules

    def check(self) -> None:
        if odd := [c for c in self.reason_priority if c not in REASONS or c in (0, 65535)]:
            raise ValueError(f"unknown reason codes: {odd}")
        if len(set(self.reason_priority)) != len(self.reason_priority):
            raise ValueError("a reason is listed twice")
        if not self.duration[0] <= self.duration[1]:
            raise ValueError("empty duration bounds")
        if self.verification:
            a, b = self.verification["ratio"]
            if not 0 <= a < b:
                raise ValueError("the edit ratio must be in [0, 1)")
        needs = {6002: self.required_speakers, 1009: self.verification, 5002: self.reference_seconds, 3003: self.sample_rates or None, 3004: self.source_configs}
        if missing := [c for c, rule in needs.items() if rule is not None and c not in self.reason_priority]:
            raise ValueError(f"rules without their reason in reason_priority: {missing}")

    def version(self, sample_list: bool = False, instructions: bool = False) -> int:
        """Version of the reason and flag dictionaries: the highest that an active family needs."""
        on = {
            "base": True, "speakers": self.required_speakers, "verification": self.verification, "sample_rates": self.sample_rates,
            "configs": self.source_configs, "sample_list": sample_list, "instructions": instructions,
        }
        return max(v for k, v in FAMILY_VERSIONS.items() if on[k])


@dataclass(frozen=True)
class Evidence:
    """Which optional columns a row carries beside those of the base table."""

    asr: bool = False
    speakers: bool = False
    audio_exclusion: bool = False
    sample_exclusion: bool = False
    sample_list: bool = False
    instruction: bool = False


def chosen_text(asr: bool) -> Column:
    """Text that is judged: the stripped base text, or the stripped text of a successful annotation; never null."""
    own = F.coalesce(tx.strip(F.col("text")), F.lit(""))
    if not asr:
        return own
    return F.when(F.col("asr.status").isNull(), own).when(F.col("asr.status") == "ok", F.coalesce(tx.strip(F.col("asr.text")), F.lit(""))).otherwise("")


def hits(rules: Rules, e: Evidence, language: Column, text: Column, chars: Column) -> list[tuple[Column, int | None, int]]:
    """(predicate, reason code if it gives one, flag bits) of every active rule."""
    c = F.col
    supported = present(language.isin(rules.supported_languages)) if rules.supported_languages else F.lit(True)
    has_language = present(language != "")
    heard = c("asr.status").isNotNull() if e.asr else F.lit(False)
    heard_ok = present(c("asr.status") == "ok") if e.asr else F.lit(False)
    out: list[tuple[Column, int | None, int]] = []
    if e.sample_list:
        out.append((c("listed").isNull(), 8002, BIT["sampling_policy"]))
    if e.audio_exclusion:
        out.append((present(c("audio_excluded")), 103, BIT["audio_issue"] | BIT["confirmed_exclusion"]))
    if e.sample_exclusion:
        out.append((present(F.array_contains("exclusion_reasons", 105)), 105, BIT["source_timeline"]))
        out.append((present(F.array_contains("exclusion_reasons", 1002)), 1002, BIT["pairing_issue"] | BIT["confirmed_exclusion"]))
    out.append((F.coalesce(c("audio_sha256"), F.lit("")) == "", 101, BIT["audio_issue"]))
    unavailable = heard & ~heard_ok
    if e.asr:
        out.append((unavailable, 1003, BIT["missing_text"]))
    short = (text == "") | (F.length(chars) < (rules.min_effective_characters or 0))
    out.append((short & ~unavailable, 1001, 0))
    out.append((short, None, BIT["missing_text"]))
    if rules.supported_languages:
        out.append((~supported & has_language, 2002, BIT["language_policy"]))
        if rules.require_language:
            out.append((~supported & ~has_language, 2001, BIT["language_policy"]))
    if e.asr and rules.asr_labels is not None:
        other = ~(tx.lookup(c("asr.language"), rules.asr_labels).eqNullSafe(language))
        conflict = present(c("asr.language_mismatch")) | c("asr.candidate_text").isNotNull() | c("asr.candidate_response").isNotNull() | other
        out.append((heard_ok & conflict, 2003, BIT["language_policy"] | BIT["language_evidence"]))
    if e.asr and rules.verification:
        v = rules.verification
        verdict = tx.verify_text(text, c("text_variants"), v["kind"], tuple(v["ratio"]), v.get("fold"))
        out.append((heard_ok & (text != "") & (verdict != "agree"), 1009, BIT["text_policy"]))
    if rules.script:
        out.append((supported & present(c("script_share") < rules.script["min_share"]), 2004, BIT["language_policy"] | BIT["language_evidence"]))
    if rules.markup_characters:
        out.append((F.translate(text, rules.markup_characters, "") != text, 1007, BIT["text_policy"]))
    if e.asr:
        out.append((heard & F.contains(text, F.lit("\n")), 1008, BIT["text_policy"]))
    some = F.length(chars) > 0
    if rules.repetition:
        out.append((some & present(c("repeated.coverage") >= rules.repetition["min_coverage"]), 1004, BIT["text_policy"]))
    if rules.seconds_per_character:
        dense = present(language.isin(rules.dense_languages)) if rules.dense_languages else F.lit(False)
        pace = F.try_divide(c("duration_seconds"), F.length(chars))
        bound = lambda k: F.when(dense, F.lit(float(rules.seconds_per_character["dense"][k]))).otherwise(F.lit(float(rules.seconds_per_character["other"][k])))
        out.append((some & present(pace < bound(0)), 1005, BIT["text_policy"]))
        out.append((some & present(pace > bound(1)), 1006, BIT["text_policy"]))
    if rules.held_out:
        value = F.get_json_object("metadata_json", "$." + rules.held_out["field"])
        out.append((present(value.isin(rules.held_out["values"])), 7001, BIT["held_out"]))
    if e.speakers and rules.required_speakers is not None:
        out.append((speaker_outcome(rules.required_speakers) != "passed", 6002, BIT["speaker_policy"]))
    if rules.sample_rates:
        out.append((present(c("sample_rate") < tx.lookup(c("dataset_id"), {k: str(v) for k, v in rules.sample_rates.items()}).cast("int")), 3003, BIT["sample_rate_policy"]))
    out.append((present(c("duration_seconds") < float(rules.duration[0])), 3001, BIT["duration_policy"]))
    out.append((present(c("duration_seconds") > float(rules.duration[1])), 3002, BIT["duration_policy"]))
    if rules.source_configs is not None:
        out.append((~present(c("source_config").isin(rules.source_configs)), 3004, BIT["source_config_policy"]))
    if e.instruction:
        usable = present((c("instruction.status") == "ok") & (c("instruction.action") == "replace") & (F.trim("instruction.text") != ""))
        out.append((~usable, 3005, BIT["instruction_policy"]))
    return out


def speaker_outcome(required: int) -> Column:
    """passed, unavailable or count_0 to count_4 of a diarised row."""
    n = F.col("speakers.speaker_count")
    missing = ~present(F.col("speakers.status") == "ok") | n.isNull()
    return F.when(missing, "unavailable").when(n == required, "passed").otherwise(F.concat(F.lit("count_"), F.least(n, F.lit(4)).cast("string")))


def primary(hit: list[tuple[Column, int]], priority: list[int]) -> Column:
    """First code of the priority list among the hits, or 0: each predicate is evaluated once."""
    place = {code: k for k, code in enumerate(priority)}
    ranks = [F.when(p, place[code]) for p, code in hit if code in place]
    if not ranks:
        return F.lit(0)
    first = ranks[0] if len(ranks) == 1 else F.least(*ranks)
    return F.coalesce(F.try_element_at(F.array(*map(F.lit, priority)), first + 1), F.lit(0))


def decide(rows: DataFrame, rules: Rules, evidence: Evidence = Evidence()) -> DataFrame:
    """`rows` with selected_language, selected_text, effective_chars, reasons, flags and reason.

    The text functions that Spark lacks run in one Arrow step; everything else is one
    projection over the scan.
    """
    language = tx.aliased(F.col("language"), rules.language_aliases)
    df = rows.withColumns({"selected_language": language, "selected_text": chosen_text(evidence.asr)})
    needed = {"effective_chars": tx.effective_characters(F.col("selected_text"))}
    if rules.repetition:
        needed["repeated"] = tx.repetition(F.col("selected_text"), F.col("selected_language"), rules.repetition)
    if rules.script:
        needed["script_share"] = tx.script_share(F.col("selected_text"), F.col("selected_language"), rules.script)
    df = df.withColumns(needed)
    found = hits(rules, evidence, F.col("selected_language"), F.col("selected_text"), F.col("effective_chars"))
    coded = [(p, code) for p, code, _ in found if code is not None]
    flags = F.lit(0)
    for p, _, bits in found:
        flags = flags.bitwiseOR(F.when(p, F.lit(bits)).otherwise(0)) if bits else flags
    return df.withColumns({"reasons": F.array_compact(F.array(*[F.when(p, code) for p, code in coded])), "flags": flags, "reason": primary(coded, rules.reason_priority)})


def timeline_violations() -> Column:
    """What is wrong with a row's timeline, as an array of names; empty if nothing."""
    c = F.col
    checks = [
        ("bad_rate", ~present(c("sample_rate") > 0)),
        ("bad_frames", ~present(c("num_frames") > 0)),
        ("bad_duration", ~present((c("duration_seconds") > 0) & (c("duration_seconds") < float("inf")))),
        ("duration_disagrees", present(F.abs(c("duration_seconds") - F.try_divide(c("num_frames"), c("sample_rate"))) > 1e-9)),
        ("bad_segment", present((c("segment_start_frame") < 0) | (c("segment_start_frame") >= c("segment_end_frame")))),
        ("derived_view", c("parent_sample_id").isNotNull()),
    ]
    return F.array_compact(F.array(*[F.when(p, name) for name, p in checks]))


def text_override(raw: Column, chosen: Column, annotated: Column) -> Column:
    """Text that differs from the base text; null means inherit."""
    return F.when(~chosen.eqNullSafe(raw) & (annotated | raw.isNotNull()), chosen)


def revision_text(base: Column, status: Column, action: Column, text: Column) -> Column:
    """Text of a revision row: keep gives the base text, replace the revised one, not ok nothing; others are an error."""
    return F.when(~present(status == "ok"), None).when(action == "keep", base).when(action == "replace", text).otherwise(F.raise_error(F.concat(F.lit("unknown action: "), F.coalesce(action, F.lit("null")))).cast("string"))


def dictionary(spark, kind: str = "reasons") -> DataFrame:
    """The reason or flag dictionary as a table."""
    rows = [(k, v) for k, v in REASONS.items()] if kind == "reasons" else [(1 << k, v) for k, v in enumerate(FLAGS)]
    return spark.createDataFrame(rows, "code int, name string")
