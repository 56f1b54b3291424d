"""Named sources: how each corpus is laid out and how its rows become base records.

A source is data: a layout, and SQL expressions over the columns that the layout yields.
Reading any of them gives the base table, so a new corpus is a new entry, not new code.

Columns by layout: parquet has the file's own and _path, _row; json has its fields, _path,
_row, and `audio` where it refers to files; pairs has archive, stem and one binary per kind (JSON
kinds also as `meta`); table has archive, member, the table's columns and `audio`; keyed has
archive, member, key, `audio` and the columns of its sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.sources import files, sides
from corpusloom.sources.base import base_table


@dataclass(frozen=True)
class Side:
    """Rows that say something of audio: by `key`, or by what `on` makes of the audio's key."""

    name: str
    read: Callable[[SparkSession, str], DataFrame]
    needed: bool = True
    on: str = "key"


@dataclass(frozen=True)
class Source:
    name: str
    layout: str
    fields: dict[str, str]
    configs: list[str] = field(default_factory=lambda: ["all"])
    identity: str = "source-file-v1"
    glob: str = "*.parquet"
    archive: str = "tar"
    kinds: dict[str, str] = field(default_factory=dict)
    table: tuple[str, str, tuple[str, ...], str] | None = None
    schema: str = ""
    excluded: str = "false"
    audio: str = ""
    sides: tuple[Side, ...] = ()
    referred: str = ""

    def rows(self, spark: SparkSession, root: str) -> DataFrame:
        """The source's own rows, before mapping."""
        if self.layout == "parquet":
            return files.parquet_rows(spark, root, self.glob)
        if self.layout == "json":
            rows = files.json_array(spark, f"{root}/{self.glob}", self.schema)
            return self._referred(spark, root, rows) if self.referred else rows
        if self.layout == "keyed":
            return self._keyed(spark, root)
        members = files.archive_members(spark, root, self.archive, self.glob)
        if self.layout == "pairs":
            pairs = files.paired(members, self.kinds)
            return pairs.withColumns({f"{n}_json": F.decode(n, "UTF-8") for n, s in self.kinds.items() if s == ".json"} | {f"{n}_text": F.decode(n, "UTF-8") for n, s in self.kinds.items() if s == ".txt"})
        name, sep, columns, at = self.table
        audio = members.select(F.col("archive").alias("__a"), F.col("member").alias("__m"), F.col("content").alias("audio"))
        table = files.table_rows(members, name, sep, list(columns)).withColumn("__at", F.expr(at))
        joined = table.join(audio, (F.col("archive") == F.col("__a")) & (F.col("__at") == F.col("__m")), "left")
        return joined.withColumn("problem", F.when(F.col("audio").isNull(), "missing_audio")).drop("__a", "__m")

    def _referred(self, spark: SparkSession, root: str, rows: DataFrame) -> DataFrame:
        """Rows with the bytes of the file that they refer to; a path that leads elsewhere or to nothing is a problem."""
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/{self.referred.split('/')[0]}").select(files.relative(F.col("path"), root).alias("__path"), F.col("content").alias("audio"))
        at = F.col(self.referred.split("/")[1])
        safe = at.startswith(self.referred.split("/")[0] + "/") & ~at.rlike(r"(^|/)[.][.]?(/|$)|//|\\\\")
        joined = rows.join(found, at == F.col("__path"), "left").drop("__path")
        return joined.withColumn("problem", F.when(~F.coalesce(safe, F.lit(False)), "unsafe_path").when(F.col("audio").isNull(), "missing_audio"))

    def _keyed(self, spark: SparkSession, root: str) -> DataFrame:
        """Audio members with what the sides say of their keys; repeated and missing ones are problems, audio that only a needed side names too."""
        members = files.archive_members(spark, root, self.archive, self.glob, self.audio).where("problem is null")
        rows = members.select("archive", "member", F.regexp_extract("member", self.audio, 1).alias("key"), F.col("content").alias("audio")).withColumn("problem", F.lit(None).cast("string"))
        for side in self.sides:
            known = side.read(spark, root)
            by = ["archive", "key"] if "archive" in known.columns else ["key"]
            held = [c for c in known.columns if c not in by]
            once = known.groupBy(*[F.col(c).alias(f"__{c}") for c in by]).agg(F.count(F.lit(1)).alias("__n"), F.max(F.struct(*held)).alias("__side"))
            same = reduce(lambda a, b: a & b, [(F.col(c) if c == "archive" else F.expr(side.on)) == F.col(f"__{c}") for c in by])
            rows = rows.join(once, same, "full" if side.needed else "left")
            odd = F.when(F.col("audio").isNull(), "missing_audio").when(F.col("__n") > 1, f"repeated_{side.name}").when(F.lit(side.needed) & F.col("__n").isNull(), f"missing_{side.name}")
            rows = rows.withColumns({"problem": F.coalesce("problem", odd), "key": F.coalesce("key", "__key"), **({"archive": F.coalesce("archive", "__archive")} if "archive" in by else {})})
            rows = rows.select(*[c for c in rows.columns if c not in ("__n", "__side", "__key", "__archive")], *[F.col(f"__side.{c}").alias(c) for c in held])
        return rows

    def read(self, spark: SparkSession, root: str, snapshot: str | None = None, config: str | None = None) -> DataFrame:
        """Base records of the source below `root`; unpaired members and excluded rows are left out (see `problems`)."""
        if config is not None and config not in self.configs:
            raise ValueError(f"{self.name} has no config {config!r}; it has {self.configs}")
        rows = self.rows(spark, root)
        if "problem" in rows.columns:
            rows = rows.where("problem is null")
        place = "archive" if "archive" in rows.columns else "_path"
        fields = {"source_snapshot": snapshot and f"'{snapshot}'" or f"concat('{self.identity}:path:', sha2({place}, 256))", **self.fields}
        made = base_table(rows.where(f"not ({self.excluded})"), self.name, fields)
        return made.where(F.col("source_config") == config) if config and config != "all" else made

    def problems(self, spark: SparkSession, root: str) -> DataFrame:
        """(archive, stem or member, problem) of what can't be paired."""
        rows = self.rows(spark, root)
        if "problem" not in rows.columns:
            raise ValueError(f"{self.name} has nothing to pair")
        place = "archive" if "archive" in rows.columns else "_path"
        member = next(c for c in ("stem", "__at", "key", *self.referred.split("/")[1:]) if c in rows.columns)
        return rows.where("problem is not null").select(F.col(place).alias("archive"), F.col(member).alias("member"), "problem")


def _meta(*pairs: str) -> str:
    return "to_json(named_struct(" + ", ".join(pairs) + "), map('ignoreNullFields', 'false'))"


_PARQUET = {"audio_bytes": "audio.bytes", "audio_path": "regexp_extract(audio.path, '([^/]+)$', 1)", "source_locator_json": _meta("'path', _path", "'row', _row")}
_ROW_KEY = {"source_key": "concat(_path, '#row=', _row)"}
# Language names in the voice lines of games.
_GAME_LANGUAGES = "map('Chinese', 'zh', 'English', 'en', 'English(US)', 'en', 'Japanese', 'ja', 'Korean', 'ko', 'chinese', 'zh', 'english', 'en', 'japanese', 'ja', 'korean', 'ko')"


def _game(name: str) -> Source:
    lang = f"try_element_at({_GAME_LANGUAGES}, language)"
    fields = {**_PARQUET, **_ROW_KEY, "text": "transcription", "text_kind": "'source_transcript'", "language": lang, "speaker_id": f"concat('{name}:', {lang}, ':', replace(url_encode(nullif(trim(speaker), '')), '+', '%20'))", "speaker_scope": "'dataset'", "source_config": "'default'", "metadata_json": _meta("'original_split', 'train'", "'upstream_audio_path', audio.path", "'speaker', speaker")}
    return Source(name, "parquet", fields, ["all", "default"])


def _pairs(name: str, audio: str, key: str, extra: dict[str, str] | None = None) -> Source:
    value = lambda k: f"get_json_object(meta_json, '$.{k}')"
    fields = {"source_key": "regexp_extract(stem, '([^/]+)$', 1)", "audio_bytes": "audio", "audio_path": f"concat(regexp_extract(stem, '([^/]+)$', 1), '{audio}')", "text": value("text"), "text_kind": "'source_transcript'", "language": value("language"), "speaker_id": f"concat('{name}:', {value('speaker')})", "speaker_scope": "'dataset'", "metadata_json": "meta_json", "source_locator_json": _meta("'path', archive", "'member', stem")}
    return Source(name, "pairs", {**fields, **(extra or {})}, glob="*.tar", kinds={"audio": audio, "meta": ".json"}, excluded=f"{value(key)} is null or {value(key)} != regexp_extract(stem, '([^/]+)$', 1)")


def _table(name: str, table: tuple[str, str, tuple[str, ...], str], fields: dict[str, str], archive: str = "tar", glob: str = "*.tar*") -> Source:
    base = {"audio_bytes": "audio", "audio_path": "regexp_extract(__at, '([^/]+)$', 1)", "source_config": "'all'", "source_locator_json": _meta("'path', archive", "'member', __at", "'metadata_member', member"), "text_kind": "'source_transcript'", "speaker_scope": "'dataset'"}
    return Source(name, "table", {**base, **fields}, archive=archive, glob=glob, table=table)


def _keyed(name: str, audio: str, known: list[Side], fields: dict[str, str], archive: str = "tar", glob: str = "*.tar.gz", **more) -> Source:
    base = {"source_key": "key", "audio_bytes": "audio", "audio_path": "regexp_extract(member, '([^/]+)$', 1)", "source_config": "'all'", "source_locator_json": _meta("'path', archive", "'member', member"), "text_kind": "'source_transcript'", "speaker_scope": "'dataset'"}
    return Source(name, "keyed", {**base, **fields}, archive=archive, glob=glob, audio=audio, sides=tuple(known), **more)


_UP = lambda k: f"get_json_object(said, '$.{k}')"
# Configurations, and names of the languages, tiers, splits and emotions of sources.
_MLS = "map('english', 'en', 'german', 'de', 'french', 'fr', 'spanish', 'es', 'italian', 'it', 'polish', 'pl', 'dutch', 'nl', 'portuguese', 'pt')"
_MLS_SPLITS = "map('train', 'train', 'dev', 'valid', 'test', 'test')"
_EMOTIONS = "map('高兴', 'happy', '伤心', 'sad', '中性', 'neutral', '生气', 'angry', '惊讶', 'surprised')"
_FLEXI = ["childmandarin", "debatts", "ears", "emilia_en_ds", "emilia_psc", "emilia_zh_ds", "emotion", "expresso", "genshin", "kespeech", "l2", "nvspeech", "starrail", "voxceleb"]
_LANGUAGE_PARTS = "map('EN', 'en', 'ZH', 'zh', 'JA', 'ja', 'KO', 'ko')"
_mls_language = "regexp_extract(archive, '([a-z]+)/[^/]+$', 1)"
_mls_split = f"try_element_at({_MLS_SPLITS}, regexp_extract(archive, '([a-z]+)-[^/]*$', 1))"
_mls_recording = f"concat('mls_sidon:', {_mls_language}, ':recording:', sha2(to_json(array({_UP('original_path')})), 256))"
_tier = "regexp_extract(archive, '(Basic|Standard|Premium)/[^/]+$', 1)"
_take = "split(key, '_S[0-9]')[0]"
_point = "notes[0].text"
KEYED = [
    _keyed("vctk", r"(?:^|/)wav48_silence_trimmed/[^/]+/([^/]+_mic[12])\.flac$", [
        Side("transcript", sides.texts(r"(?:^|/)txt/(?:.*/)?([^/]+)\.txt$", "zip", "*.zip"), needed=False, on="regexp_replace(key, '_mic[12]$', '')"),
        Side("speaker", sides.lines(r"(?:^|/)speaker-info\.txt$", {"key": "if(line_no = 0, null, split(trim(line), ' +')[0])", "info": "to_json(slice(split(trim(line), ' +'), 2, 100))"}, "zip", "*.zip"), needed=False, on="regexp_extract(key, '^([^_]+)_', 1)"),
    ], {"text": "trim(both ' \r\n\t' from said)", "language": "'en'", "speaker_id": "concat('vctk:', regexp_extract(key, '^([^_]+)_', 1))", "recording_id": "concat('vctk:', regexp_replace(key, '_mic[12]$', ''))", "group_id": "concat('vctk:', regexp_replace(key, '_mic[12]$', ''))", "metadata_json": _meta("'original_split', cast(null as string)", "'microphone', right(key, 4)", "'upstream_utterance_id', regexp_replace(key, '_mic[12]$', '')", "'upstream_speaker_info', info", "'missing_transcript', coalesce(trim(both ' \r\n\t' from said), '') = ''")}, "zip", "*.zip"),
    _keyed("hifitts", r"^(.*\.flac)$", [Side("manifest", sides.lines(r"(?:^|/)[0-9]+_manifest_(?:clean|other)_(?:train|dev|test)\.json$", {"key": "concat(regexp_extract(member, '^(.*/)?[^/]*$', 1), get_json_object(line, '$.audio_filepath'))", "said": "line", "manifest": "regexp_extract(member, '([^/]+)$', 1)"}))], {
        "source_key": _UP("audio_filepath"), "text": f"coalesce(nullif({_UP('text_no_preprocessing')}, ''), {_UP('text')})", "language": "'en'", "speaker_id": "concat('hifitts:', split(manifest, '_')[0])", "group_id": f"concat('hifitts:book:', split({_UP('audio_filepath')}, '/')[2])",
        "text_variants": f"array(named_struct('kind', 'source_preprocessed', 'text', {_UP('text')}, 'language', 'en'), named_struct('kind', 'source_normalized', 'text', {_UP('text_normalized')}, 'language', 'en'))", "metadata_json": _meta("'original_split', regexp_extract(manifest, '_([a-z]+)[.]json$', 1)", "'quality_partition', split(manifest, '_')[2]", "'upstream', parse_json(said)"),
    }),
    _keyed("mls_sidon", r"^(.*)\.flac$", [Side("metadata", sides.texts(r"^(.*)\.metadata\.json$"))], {
        "source_key": f"concat({_mls_language}, ':', {_UP('id')})", "text": _UP("transcript"), "language": f"try_element_at({_MLS}, {_mls_language})", "speaker_id": f"concat('mls_sidon:', {_mls_language}, ':', {_UP('speaker_id')})", "speaker_scope": "'dataset_language'", "source_config": _mls_language, "recording_id": _mls_recording, "group_id": _mls_recording,
        "metadata_json": _meta("'upstream', parse_json(said)", f"'original_split', {_mls_split}", f"'original_split_group', {_mls_split}", "'original_archive_split', regexp_extract(archive, '([a-z]+)-[^/]*$', 1)"),
    }, configs=["all", "english", "german", "french", "spanish", "italian", "polish", "dutch", "portuguese"], excluded=f"coalesce({_UP('id')}, '') != regexp_extract(key, '([^/]+)$', 1)"),
    _keyed("wenetspeech4tts", r"/wavs/([^/]+)\.wav$", [
        Side("transcript", sides.texts(r"/txts/([^/]+)\.txt$")), Side("list", sides.listed("filelists/Basic_filelist.lst", {"key": "split(line, '\t')[0]", "listed": "split(line, '\t')[1]"})), Side("score", sides.listed("DNSMOS_P808Scores/Basic_DNSMOS.lst", {"key": "split(trim(line), '[ \t]+')[0]", "dnsmos": "try_cast(split(trim(line), '[ \t]+')[1] as double)"})),
    ], {"text": "regexp_extract(said, '^[^\t]*\t([^\r\n]*)', 1)", "language": "'zh'", "source_config": _tier, "recording_id": f"concat('wenetspeech4tts:', {_take})", "group_id": f"concat('wenetspeech4tts:', {_take})", "metadata_json": _meta("'original_split', cast(null as string)", f"'physical_partition', {_tier}", "'upstream_dnsmos_p808', dnsmos", "'upstream_transcript', said")},
        identity="source-unit-v1", configs=["all", "Basic", "Standard", "Premium"], excluded=f"not endswith(listed, member) or split(said, '\t')[0] != key or not coalesce(dnsmos between 1 and 5, false) or {_tier} = ''"),
    _keyed("smiip_nv", r"^(SMIIP_NV_Up/MIC-[0-9]{4}/[^/]+/MIC-[0-9]{4}_[0-9]{4}\.wav)$", [
        Side("annotation", sides.annotations(r"^SMIIP_NV_Up/MIC-[0-9]{4}/[^/]+/annotation\.txt$", "SMIIP_NV.zip"), needed=False), Side("split", sides.texts(r"^SMIIP_NV_SPK_finetune/spk_(?:train|test)/(MIC-[0-9]{4}_[0-9]{4})\.wav$", "zip", "SMIIP_NV_SPK_finetune.zip", False), on="regexp_extract(key, '([^/]+)[.]wav$', 1)"),
    ], {"source_key": "regexp_extract(key, '([^/]+)[.]wav$', 1)", "text": _point, "text_kind": "'source_transcript_paralinguistic'", "language": "'zh'", "speaker_id": "concat('smiip_nv:', split(key, '/')[1])",
        "text_variants": "transform(slice(notes, 2, 1000), n -> named_struct('kind', concat('source_transcript_paralinguistic_', n.style), 'text', n.text, 'language', 'zh'))", "metadata_json": _meta(f"'emotion', try_element_at({_EMOTIONS}, split(key, '/')[2])", "'annotations', notes", "'text_style', notes[0].style", "'missing_annotation', notes is null", "'original_split', split(text_member, '/')[1]", "'original_split_group', if(split(text_member, '/')[1] = 'spk_test', 'test', 'train')")},
        "zip", "SMIIP_NV.zip", identity="source-unit-v1"),
    Source("flexivoice", "json", {"source_key": "concat(regexp_extract(_path, '([^/]+)[.]json$', 1), ':', _row)", "audio_bytes": "audio", "audio_path": "regexp_extract(wav_path, '([^/]+)$', 1)", "text": "text", "text_kind": "'source_transcript'", "source_config": "regexp_extract(_path, '([^/]+)[.]json$', 1)", "group_id": "concat('flexivoice:audio:', wav_path)",
        "language": f"case when split(wav_path, '/')[1] = 'emilia' then try_element_at({_LANGUAGE_PARTS}, split(wav_path, '/')[2]) when split(wav_path, '/')[1] = 'instruction_data' and split(wav_path, '/')[2] in ('genshin', 'starrail') then try_element_at({_LANGUAGE_PARTS}, try_element_at(split(wav_path, '/'), 4)) end",
        "source_locator_json": _meta("'path', _path", "'row', _row", "'audio_path', wav_path"), "metadata_json": _meta("'instruction', instruction", "'upstream', named_struct('wav_path', wav_path, 'text', text, 'instruction', instruction)")},
        ["all", *_FLEXI], identity="source-unit-v1", glob="resolved_json/*.json", schema="wav_path string, text string, instruction string", referred="audio/wav_path"),
]
_DIR = "regexp_extract(member, '^(.*)/[^/]*$', 1)"
SOURCES: dict[str, Source] = {
    s.name: s
    for s in [
        *KEYED,
        _table("aishell3", ("content.txt", "\t", ("file", "content"), f"concat({_DIR}, '/wav/', substring(file, 1, 7), '/', file)"), {"source_key": "file", "language": "'zh'", "speaker_id": "concat('aishell3:', substring(file, 1, 7))", "text": "array_join(filter(split(content, '\\\\s+'), (x, i) -> i % 2 = 0), '')", "text_variants": "array(named_struct('kind', 'source_pinyin', 'text', array_join(filter(split(content, '\\\\s+'), (x, i) -> i % 2 = 1), ' '), 'language', 'zh'))", "metadata_json": _meta("'original_split', regexp_extract(member, '([^/]+)/[^/]*$', 1)", "'content', content")}),
        _table("ljspeech", ("metadata.csv", "|", ("id", "text", "normalized"), f"concat({_DIR}, '/wavs/', id, '.wav')"), {"source_key": "id", "text": "text", "language": "'en'", "speaker_id": "'ljspeech:LJ'", "group_id": "concat('ljspeech:', split(id, '-')[0])", "text_variants": "array(named_struct('kind', 'source_normalized', 'text', normalized, 'language', 'en'))", "metadata_json": _meta("'original_split', cast(null as string)", "'upstream_id', id")}),
        Source("csemotions", "parquet", {**_PARQUET, **_ROW_KEY, "text": "text", "text_kind": "'source_transcript'", "language": "'zh'", "speaker_id": "concat('csemotions:', speaker)", "speaker_scope": "'dataset'", "metadata_json": _meta("'emotion', emotion", "'original_split', 'train'")}),
        Source("libritts_r", "parquet", {**_PARQUET, "source_key": "id", "text": "text_original", "text_kind": "'source_transcript'", "language": "'en'", "speaker_id": "concat('libritts_r:', speaker_id)", "speaker_scope": "'dataset'", "source_config": "'all'", "recording_id": "concat('libritts_r:', speaker_id, ':', chapter_id)", "group_id": "concat('libritts_r:', speaker_id, ':', chapter_id)", "text_variants": "array(named_struct('kind', 'source_normalized', 'text', text_normalized, 'language', 'en'))", "metadata_json": _meta("'upstream_path', path", "'chapter_id', chapter_id", "'original_split', regexp_extract(_path, '([^/]+)/[^/]+$', 1)")}),
        Source("libriheavy", "parquet", {**_PARQUET, "source_key": "id", "text": "text_original", "text_kind": "'source_book_text'", "language": "'en'", "speaker_id": "concat('libriheavy:', speaker_id)", "speaker_scope": "'dataset'", "source_config": "element_at(split(_path, '/'), -2)", "group_id": "concat('libriheavy:book:', librivox_book_id)", "text_variants": "array(named_struct('kind', 'source_asr', 'text', text_transcription, 'language', 'en'))", "metadata_json": _meta("'original_split', 'train'", "'librivox_book_id', librivox_book_id")}, ["all", "small", "medium", "large"]),
        Source("hifitts2", "parquet", {**_PARQUET, "source_key": "id", "text": "text", "text_kind": "'source_transcript'", "language": "'en'", "speaker_id": "concat('hifitts2:', speaker)", "speaker_scope": "'dataset'", "metadata_json": "metadata"}),
        Source("nonverbaltts", "parquet", {**_PARQUET, "source_key": "index", "text": "`Result`", "text_kind": "'source_transcript_paralinguistic'", "language": "'en'", "speaker_id": "concat('nonverbaltts:', speaker_id)", "speaker_scope": "'dataset'", "source_config": "'default'", "text_variants": "array(named_struct('kind', 'source_asr_paralinguistic', 'text', `Initial text`, 'language', 'en'))", "metadata_json": _meta("'emotion', `Emotion`", "'original_split', regexp_extract(_path, '([^/]+)/[^/]+$', 1)")}, ["all", "default"]),
        Source("nonverbalspeech38k", "parquet", {**_PARQUET, **_ROW_KEY, "text": "text", "text_kind": "'source_transcript_paralinguistic'", "language": "language", "metadata_json": _meta("'original_split', regexp_extract(_path, '([a-z]+)-[0-9]{5}-of', 1)")}),
        Source("disfluencyspeech", "parquet", {**_PARQUET, "source_key": "audio.path", "text": "transcript_annotated", "text_kind": "'source_transcript_paralinguistic'", "language": "'en'", "speaker_id": "'disfluencyspeech:single'", "speaker_scope": "'dataset'", "metadata_json": _meta("'original_split', regexp_extract(_path, '(train|validation|test)-[0-9]{5}-of', 1)")}),
        Source("galgame", "parquet", {**_PARQUET, **_ROW_KEY, "text": "text", "text_kind": "'game_subtitle'", "language": "'ja'", "group_id": "concat('galgame:', element_at(split(_path, '/'), 1))", "metadata_json": _meta("'original_split', 'train'", "'game', element_at(split(_path, '/'), 1)")}),
        _game("genshin_voice"), _game("starrail_voice"), _game("zenless_voice"),
        Source("wutheringwaves", "pairs", {"source_key": "stem", "audio_bytes": "audio", "text": "text_text", "text_kind": "'game_subtitle'", "language": "split(stem, '/')[0]"}, archive="zip", glob="*.zip", kinds={"audio": ".wav", "text": ".txt"}),
        _pairs("emilia", ".mp3", "id"), _pairs("emilia_yodas", ".mp3", "_id"),
        Source("emilia_nv", "pairs", {"source_key": "regexp_extract(stem, '([^/]+)$', 1)", "audio_bytes": "audio", "text": "text_text", "text_kind": "'source_transcript_paralinguistic'", "language": "get_json_object(meta_json, '$.language')", "metadata_json": "meta_json"}, glob="*.tar", kinds={"audio": ".wav", "text": ".txt", "meta": ".json"}),
    ]
}


def source(name: str) -> Source:
    if name not in SOURCES:
        raise ValueError(f"no source {name!r}; there are {sorted(SOURCES)}")
    return SOURCES[name]
