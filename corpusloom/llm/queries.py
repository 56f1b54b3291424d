"""Registered queries of this subpackage: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import repetition as rep
from corpusloom.llm import languages, leakage, splitting, survivors, tokens, truncation
from corpusloom.llm.bpe import DEFAULT_DIR
from corpusloom.tables import table

#: Folder of the public vocabularies.
VOCABULARIES = os.environ.get("CORPUSLOOM_TOKENIZERS", DEFAULT_DIR)


def _languages(spark: SparkSession, folder: str) -> DataFrame:
    return languages.identify(table(spark, folder, "selection"), "sample_id", "text", "language", table(spark, folder, "language_samples"), table(spark, folder, "language_aliases"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return languages.label_issues(_languages(spark, folder), "sample_id")


def p2_languages(spark: SparkSession, folder: str) -> DataFrame:
    return _languages(spark, folder).select("sample_id", "segment_no", "language", "confidence").distinct()


def _truncated(spark: SparkSession, folder: str) -> DataFrame:
    return truncation.truncated(table(spark, folder, "qwen_asr"), table(spark, folder, "selection"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return _truncated(spark, folder).where("cut").select("sample_id").distinct()


def p3_suspects(spark: SparkSession, folder: str) -> DataFrame:
    """What trie and field limits find, before the check against the sample's line, with how the text stands to it."""
    return _truncated(spark, folder).where("suspect").select("sample_id", "line", "cut").distinct()


def p3_rates(spark: SparkSession, folder: str) -> DataFrame:
    return truncation.truncation_rates(_truncated(spark, folder))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    found = leakage.Leaks(table(spark, folder, "selection")).pairs()
    return found.select(F.least("t_sample", "e_sample").alias("sample_id_a"), F.greatest("t_sample", "e_sample").alias("sample_id_b")).distinct()


def p4_counts(spark: SparkSession, folder: str) -> DataFrame:
    return leakage.Leaks(table(spark, folder, "selection")).counts()


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    samples = survivors.sample_survivors(table(spark, folder, "selection"), table(spark, folder, "datasets"), [])
    candidates = survivors.candidate_survivors(table(spark, folder, "ids"))
    return samples.select(F.lit("selection").alias("group_kind"), "group_key", F.col("sample_id").alias("survivor")).unionByName(
        candidates.select(F.lit("ids").alias("group_kind"), "group_key", F.concat_ws(":", "archive", "row_number").alias("survivor"))
    )


def p5_records(spark: SparkSession, folder: str) -> DataFrame:
    """Survivors with all fields; the text variants as JSON."""
    found = survivors.sample_survivors(table(spark, folder, "selection"), table(spark, folder, "datasets"))
    return found.withColumn("text_variants", F.to_json("text_variants", {"ignoreNullFields": "false"}))


def p5_id_records(spark: SparkSession, folder: str) -> DataFrame:
    return survivors.candidate_records(table(spark, folder, "ids"))


def p6_shares(spark: SparkSession, folder: str) -> DataFrame:
    return rep.repetition(table(spark, folder, "selection"), "sample_id", "text").distinct()


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    shares = rep.repetition(table(spark, folder, "selection"), "sample_id", "text")
    return shares.where(F.col("repeated_share") >= rep.FOUND_SHARE).select("sample_id").distinct()


def p6_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return rep.divergence(table(spark, folder, "selection"), "sample_id", "text", table(spark, folder, "language_samples")).distinct()


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.encode_corpus(table(spark, folder, "documents"), "doc_id", "text", VOCABULARIES)


def p8_containers(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.pack(table(spark, folder, "documents"), "doc_id", "text", "source", directory=VOCABULARIES)


def p9_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.split_oversized(table(spark, folder, "documents"), "doc_id", "text", directory=VOCABULARIES)


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return p9_pieces(spark, folder).where("piece_no = 1").select("doc_id")


QUERIES = {f.__name__: f for f in (p2_found, p2_languages, p3_found, p3_suspects, p3_rates, p4_found, p4_counts, p5_found, p5_records, p5_id_records, p6_found, p6_shares, p6_divergence, p7_ids, p8_containers, p9_found, p9_pieces)}
ORACLE: dict[str, str] = {
    "p5_found": r"""
WITH s AS (
  SELECT regexp_replace(lower(audio_sha256), '^\s*sha256:|\s', '', 'g') AS h, sample_id,
    (coalesce(regexp_matches(text, '\S'), false)::int + coalesce(regexp_matches(language, '\S'), false)::int
     + coalesce(regexp_matches(speaker_id, '\S'), false)::int + coalesce(regexp_matches(recording_id, '\S'), false)::int) AS filled,
    coalesce(priority, 1073741824) AS priority, converted_at
  FROM selection LEFT JOIN datasets USING (dataset_id)
), g AS (
  SELECT h, count(DISTINCT sample_id) AS n FROM s WHERE length(h) = 64 AND NOT regexp_matches(h, '^0+$') GROUP BY h
), r AS (
  SELECT h, sample_id, row_number() OVER (PARTITION BY h ORDER BY filled DESC, priority, converted_at DESC NULLS LAST, sample_id) AS k
  FROM s JOIN g USING (h) WHERE n > 1
), c AS (
  SELECT short_id, archive, row_number, min(semantic_hash) AS h0, max(semantic_hash) AS h1, min(priority) AS priority,
    bool_and(error IS NULL OR trim(error) = '') AS fine
  FROM ids WHERE short_id IS NOT NULL GROUP BY ALL
), cg AS (
  SELECT short_id FROM c GROUP BY short_id HAVING count(*) > 1 AND coalesce(min(h0) = max(h1), true)
), cr AS (
  SELECT short_id, archive, row_number, row_number() OVER (PARTITION BY short_id ORDER BY priority NULLS LAST, archive, row_number) AS k
  FROM c JOIN cg USING (short_id) WHERE fine
)
SELECT 'selection' AS group_kind, h AS group_key, sample_id AS survivor FROM r WHERE k = 1
UNION ALL
SELECT 'ids', short_id, archive || ':' || row_number FROM cr WHERE k = 1
""",
}


_SHARES = r"""
WITH f AS (SELECT row_number() OVER () AS id, sample_id, replace(lower(nfc_normalize(text)), 'ß', 'ss') AS t FROM (SELECT DISTINCT sample_id, text FROM selection)),
w AS (SELECT id, sample_id, list_filter(list_transform(regexp_split_to_array(t, '[\s\p{Z}\x{85}\x{1c}-\x{1f}]+'), lambda x: regexp_replace(x, '[^\p{L}\p{N}]', '', 'g')), lambda x: x <> '') AS w, regexp_replace(t, '[^\p{L}\p{N}]', '', 'g') AS c FROM f),
k AS (SELECT *, CASE WHEN c IS NULL THEN NULL WHEN len(w) >= 20 THEN 'word' WHEN length(c) >= 40 THEN 'char' END AS unit FROM w),
u AS (SELECT id, sample_id, unit, CASE unit WHEN 'word' THEN w WHEN 'char' THEN string_split(c, '') END AS u, CASE unit WHEN 'word' THEN 5 ELSE 10 END AS n FROM k),
g AS (SELECT id, n, p, u[p:p + n - 1] AS gram FROM u, unnest(range(1, len(u) - n + 2)) AS t(p) WHERE unit IS NOT NULL),
r AS (SELECT id, n, p FROM (SELECT *, row_number() OVER (PARTITION BY id, gram ORDER BY p) AS k FROM g) WHERE k > 1),
o AS (SELECT id, sum(own) AS own FROM (SELECT id, least(n, coalesce(lead(p) OVER (PARTITION BY id ORDER BY p) - p, n)) AS own FROM r) GROUP BY id),
shares AS (SELECT DISTINCT sample_id, unit, CASE WHEN unit IS NOT NULL THEN coalesce(own, 0)::DOUBLE / len(u) END AS repeated_share FROM u LEFT JOIN o USING (id))
"""


def _filled(c: str) -> str:
    return rf"coalesce(regexp_matches({c}, '[^\s\p{{Z}}\x{{85}}]'), false)"


def _fields(entries: list[tuple[str, ...]], strings: set[str], order: str) -> str:
    """SQL: the columns of each entry from the group's best member that has its first one."""
    out = []
    for entry in entries:
        has = {c: _filled(c) if c in strings else f"coalesce(len({c}) > 0, false)" if c == "text_variants" else f"({c} IS NOT NULL)" for c in entry}
        value = {c: f"CASE WHEN {has[entry[0]]} AND {has[c]} THEN {c} END" for c in entry}
        more = " + ".join(f"{has[c]}::INT" for c in entry[1:]) or "0"
        last = ", ".join(f"{v} DESC NULLS LAST" for v in value.values())
        out += [f"first({value[c]} ORDER BY {has[entry[0]]} DESC, {more} DESC, {order}, {last}) AS {c}" for c in entry]
    return ", ".join(out)


_STRINGS = {"text", "language", "speaker_id", "speaker_scope", "recording_id", "text_kind", "metadata_json", "group_id", "parent_sample_id", "repetition_path", "semantic_hash", "carrier_type"}
_OWN = ", ".join(f"first({c} ORDER BY filled DESC, priority, converted_at DESC NULLS LAST, sample_id, {', '.join(f'{o} NULLS FIRST' for o in survivors.OWN)}) AS {c}" for c in ["sample_id", *survivors.OWN])
_ID_OWN = ", ".join(f"first({c} ORDER BY NOT fine, p, archive, row_number, {', '.join(f'{o} NULLS FIRST' for o in survivors.ID_OWN)}) AS {c}" for c in ["archive", "row_number", *survivors.ID_OWN])
ORACLE |= {
    "p6_shares": f"{_SHARES} SELECT * FROM shares",
    "p6_found": f"{_SHARES} SELECT DISTINCT sample_id FROM shares WHERE repeated_share >= 0.4",
    "p5_records": rf"""
WITH s AS (
  SELECT regexp_replace(lower(audio_sha256), '^\s*sha256:|\s', '', 'g') AS group_key, selection.*,
    {' + '.join(_filled(c) + '::INT' for c in survivors.FIELDS)} AS filled, coalesce(priority, 1073741824) AS priority
  FROM selection LEFT JOIN datasets USING (dataset_id)
)
SELECT * REPLACE (to_json(text_variants)::VARCHAR AS text_variants) FROM (SELECT group_key, {_fields(survivors.FILLED, _STRINGS, 'priority, converted_at DESC NULLS LAST')}, {_OWN}
FROM s WHERE length(group_key) = 64 AND NOT regexp_matches(group_key, '^0+$') GROUP BY group_key HAVING count(DISTINCT sample_id) > 1)
""",
    "p5_id_records": f"""
WITH c AS (SELECT *, NOT {_filled('error')} AS fine, coalesce(priority::INT, 1073741824) AS p FROM ids WHERE short_id IS NOT NULL)
SELECT short_id AS group_key, {_fields(survivors.ID_FILLED, _STRINGS, 'fine DESC, p, archive, row_number')}, {_ID_OWN}
FROM c GROUP BY short_id HAVING count(DISTINCT (archive, row_number)) > 1 AND coalesce(min(semantic_hash) = max(semantic_hash), true) AND bool_or(fine)
""",
}
