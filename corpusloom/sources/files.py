"""Readers: Parquet rows with their place, JSON arrays, archives of any order, pinned lists.

Each archive is opened by the task that reads it and streamed member by member, whatever its
size.  Members of one stem are paired there while few are waiting; lists and transcripts that
lie elsewhere are joined by key, so arrival order doesn't matter.
"""

from __future__ import annotations

import re
import tarfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MEMBERS = "archive string, member string, n_bytes bigint, content binary, problem string"


def relative(path: Column, root: str) -> Column:
    """Path below `root`, decoded."""
    return F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "^.*?" + root.rstrip("/").replace(".", r"\.") + "/", "")


def parquet_rows(spark: SparkSession, root: str, pattern: str = "*.parquet", excluded: DataFrame | None = None) -> DataFrame:
    """Rows of Parquet files with _path (below root) and _row, without `excluded` (_path, _row).

    Parquet files keep their row order, so a row's index is its place in the source.
    """
    rows = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).parquet(root)
    placed = rows.select("*", relative(F.col("_metadata.file_path"), root).alias("_path"), F.col("_metadata.row_index").alias("_row"))
    return placed.join(excluded, ["_path", "_row"], "left_anti") if excluded is not None else placed


def unmatched_exclusions(rows: DataFrame, excluded: DataFrame) -> DataFrame:
    """Exclusions that name no row of the source: an error of the list."""
    return excluded.join(rows.select("_path", "_row"), ["_path", "_row"], "left_anti")


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of JSON array files with _path and their position _row."""
    docs = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("_path"), F.from_json("value", f"array<struct<{schema}>>").alias("a"))
    return docs.select("_path", F.posexplode("a").alias("_row", "r")).select("_path", F.col("_row").cast("long"), "r.*")


def safe_member(name: str) -> str | None:
    """What is wrong with a member's name, or None."""
    parts = name.split("/")
    return "unsafe_path" if name.startswith("/") or "\\" in name or ".." in parts or not name else None


def _tar(stream) -> Iterator[tuple[str, int, bytes, str | None]]:
    try:
        with tarfile.open(fileobj=stream, mode="r|*") as archive:
            for m in archive:
                if m.isdir():
                    continue
                if not m.isfile():
                    yield m.name, m.size, b"", "unsupported_member"
                    continue
                data = archive.extractfile(m).read()
                yield m.name, m.size, data, safe_member(m.name) or ("truncated" if len(data) != m.size else None)
                archive.members = []
            # a whole archive ends with a block of zeros, which the reader has taken as its last header
            if archive.fileobj.tell() == archive.offset:
                yield "", 0, b"", "missing_terminator"
    except (tarfile.TarError, EOFError, OSError) as e:
        yield "", 0, b"", f"broken_archive:{type(e).__name__}"


def _zip(stream) -> Iterator[tuple[str, int, bytes, str | None]]:
    try:
        with zipfile.ZipFile(stream) as archive:
            for m in archive.infolist():
                if m.is_dir():
                    continue
                # older tools store names in the local code page without saying so
                name = m.filename if m.flag_bits & 0x800 else m.filename.encode("cp437").decode("gbk", "replace")
                yield name, m.file_size, archive.read(m), safe_member(name)
    except (zipfile.BadZipFile, EOFError, OSError) as e:
        yield "", 0, b"", f"broken_archive:{type(e).__name__}"


def opened(path: str):
    """A file of any file system that the workers reach, as a seekable stream."""
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return system.open_input_file(name)


def archive_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(path, length) of archives, each in a task of its own as far as there are tasks."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length").repartition("path")


def archive_members(spark: SparkSession, path: str, kind: str = "tar", glob: str = "*", only: str | None = None) -> DataFrame:
    """(archive, member, n_bytes, content, problem) of the files in tar (also compressed) or zip archives.

    only: a regular expression of the members whose content is wanted; problems are always
    given.
    """
    read = {"tar": _tar, "zip": _zip}[kind]
    wanted = re.compile(only) if only else None
    schema = pa.schema([("archive", pa.string()), ("member", pa.string()), ("n_bytes", pa.int64()), ("content", pa.binary()), ("problem", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with opened(name) as stream:
                    for member, size, data, problem in read(stream):
                        if problem is None and wanted and not wanted.search(member):
                            continue
                        rows.append({"archive": name, "member": member, "n_bytes": size, "content": data, "problem": problem})
                        held += len(data)
                        if held > 16 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return archive_files(spark, path, glob).mapInArrow(run, MEMBERS)


def paired(members: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """(archive, stem, one binary column per kind, problem): members of one stem side by side.

    kinds: column name -> suffix.  problem names an unpaired or repeated member, in any
    arrival order.
    """
    stem, suffix = F.regexp_extract("member", r"^(.*)\.[^./]+$", 1), F.regexp_extract("member", r"(\.[^./]+)$", 1)
    rows = members.where("problem is null").select("archive", stem.alias("stem"), suffix.alias("suffix"), "content").where(F.col("suffix").isin(*kinds.values()))
    grouped = rows.groupBy("archive", "stem").agg(*[F.max(F.when(F.col("suffix") == s, F.col("content"))).alias(n) for n, s in kinds.items()], *[F.count_if(F.col("suffix") == s).alias(f"__{n}") for n, s in kinds.items()])
    problem = F.lit(None).cast("string")
    for n in kinds:
        problem = F.when(F.col(f"__{n}") == 0, f"missing_{n}").when(F.col(f"__{n}") > 1, f"repeated_{n}").otherwise(problem)
    return grouped.withColumn("problem", problem).drop(*[f"__{n}" for n in kinds])


def member_lines(members: DataFrame, name: str) -> DataFrame:
    """(archive, member, line_no, line) of the text members whose file name is `name`; without carriage returns and empty lines."""
    texts = members.where(F.regexp_extract("member", r"([^/]+)$", 1) == name)
    return texts.select("archive", "member", F.posexplode(F.split(F.decode("content", "UTF-8"), "\r?\n")).alias("line_no", "line")).where("line != ''")


def table_rows(members: DataFrame, name: str, sep: str, columns: list[str]) -> DataFrame:
    """Rows of a separated text member, by position; missing fields are null."""
    parts = F.split("line", "\\" + sep if sep in "|." else sep)
    return member_lines(members, name).select("archive", "member", *[F.try_element_at(parts, F.lit(k + 1)).alias(c) for k, c in enumerate(columns)])


def pinned_list(spark: SparkSession, path: str, sha256: str | None = None, rows: int | None = None, sep: str = "\t") -> DataFrame:
    """A separated list with header, pinned by its content hash and number of rows: a mismatch fails the job."""
    table = spark.read.csv(path, sep=sep, header=True)
    if sha256 is not None:
        got = spark.read.format("binaryFile").load(path).select(F.sha2("content", 256)).first()[0]
        if got != sha256:
            raise ValueError(f"{path} has another content than was pinned")
    if rows is not None and (n := table.count()) != rows:
        raise ValueError(f"{path} has {n} rows; {rows} were pinned")
    return table


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """(top, extension, files, n_bytes) of a folder of sources, from the listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    below = relative(F.col("path"), root)
    return files.select(F.split(below, "/")[0].alias("top"), F.lower(F.regexp_extract(below, r"(\.[^./]+)$", 1)).alias("extension"), "length").groupBy("top", "extension").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("n_bytes"))


def interval_list(c: Column) -> Column:
    """`[a, b],[c, d]` as an array of struct(start, end); null if anything else stands there or an interval is reversed."""
    flat = F.regexp_replace(c, r"\s", "")
    found = F.transform(F.regexp_extract_all(flat, F.lit(r"\[([0-9.]+),([0-9.]+)\]"), F.lit(0)), lambda x: F.struct(F.regexp_extract(x, r"\[([0-9.]+),", 1).cast("double").alias("start"), F.regexp_extract(x, r",([0-9.]+)\]", 1).cast("double").alias("end")))
    whole = flat.rlike(r"^(\[[0-9]+(\.[0-9]+)?,[0-9]+(\.[0-9]+)?\](,(?=\[)|$))*$")
    return F.when(whole & ~F.exists(found, lambda x: x["start"] > x["end"]), found)


def shard_of(path: Column) -> Column:
    """struct(split, shard, total) from a file name such as train-00003-of-00010.parquet; nulls for other names."""
    pattern = r"([a-z]+)-(\d{5})-of-(\d{5})\.[a-z]+$"
    part = lambda k: F.nullif(F.regexp_extract(path, pattern, k), F.lit(""))
    return F.struct(part(1).alias("split"), part(2).cast("int").alias("shard"), part(3).cast("int").alias("total"))
