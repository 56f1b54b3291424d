"""A selection published as a whole: decisions, duplicates, exclusions, dictionaries and one manifest.

The decisions are computed and written once; everything else is read from what was written.
The manifest comes last and is replaced atomically, so readers see a selection with all its
parts or none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.plans.rules import Rules, dictionary
from corpusloom.plans.selection import decision_columns
from corpusloom.sources import sinks

PARTS = ["decisions", "duplicates", "exclusions", "reasons", "flags"]


def publish_selection(selected: DataFrame, root: str, name: str, rules: Rules, base: dict, exclusions: DataFrame | None = None, sources: DataFrame | None = None) -> dict:
    """Publishes a selection below root/name and gives its manifest.

    selected: what `selection.select` makes; base: the pin of the base table (`sinks.pin`).
    Every base row must have a decision: another number of rows is an error.  exclusions:
    (sample_id, reason) that took part; sources: provenance of the texts by code.
    """
    spark = selected.sparkSession
    place = f"{root}/{name}"
    wide = decision_columns(selected, "members", "winner", "audio_sha256", "dataset_id", "duration_seconds")
    made = {"decisions": sinks.publish(wide, place, "decisions", "sample_id")}
    decisions = made["decisions"].read(spark, verify=False)
    if made["decisions"].manifest["rows"] != base["rows"]:
        raise ValueError(f"{made['decisions'].manifest['rows']} decisions for {base['rows']} base rows")
    none = spark.createDataFrame([], "sample_id string, reason int")
    parts = {
        "duplicates": (decisions.where("members is not null").select("audio_sha256", "sample_id", "members", "winner", "selection_reason"), "audio_sha256"),
        "exclusions": ((none if exclusions is None else exclusions).select("sample_id", "reason").distinct(), "sample_id"),
        "reasons": (dictionary(spark, "reasons").coalesce(1), "code"), "flags": (dictionary(spark, "flags").coalesce(1), "code"),
        **({"text_sources": (sources, "text_source")} if sources is not None else {}),
    }
    made |= {part: sinks.publish(df, place, part, key) for part, (df, key) in parts.items()}
    counted = decisions.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("selection_reason") == 0).alias("selected"), F.sum(F.when(F.col("selection_reason") == 0, F.col("duration_seconds"))).alias("seconds")).orderBy("dataset_id")
    manifest = {
        "name": name, "base": base, "dictionary_version": rules.version(), "parts": {part: {"version": s.manifest["version"], "rows": s.manifest["rows"], "fingerprint": s.manifest["fingerprint"]} for part, s in made.items()},
        "coverage": {r["dataset_id"] or "": {"rows": r["rows"], "selected": r["selected"], "seconds": r["seconds"] or 0.0} for r in counted.toLocalIterator()},  # a row per source
    }
    sinks.write_json(spark, f"{place}/selection.json", manifest)
    return manifest


def open_selection(spark: SparkSession, root: str, name: str) -> dict[str, sinks.Snapshot]:
    """The parts of the published selection, by the versions that its manifest names; parts that older manifests lack are left out."""
    manifest = sinks.read_json(spark, f"{root}/{name}/selection.json")
    return {part: sinks.open_snapshot(spark, f"{root}/{name}", part, entry["version"]) for part, entry in manifest["parts"].items()}
