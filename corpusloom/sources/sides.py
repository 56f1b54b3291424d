"""What is known of a corpus's audio from elsewhere: transcripts, manifests and lists, by key.

Each function gives a DataFrame with `key`, with `archive` if its rows belong to the audio of
one archive only, and the columns of its kind.  Reading is by content where archives have to
be opened anyway; only the wanted members' bytes leave the reading task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.sources import files


def decoded(content: Column) -> Column:
    """Text of a member, without a byte order mark."""
    return F.regexp_replace(F.decode(content, "UTF-8"), "^\\ufeff", "")


def texts(pattern: str, kind: str = "tar", glob: str = "*.tar*", same_archive: bool = True):
    """(archive, key, text_member, said): whole text members; the pattern's first group is the key.  Without `same_archive` only (key, text_member) of members of another archive."""

    def read(spark: SparkSession, root: str) -> DataFrame:
        members = files.archive_members(spark, root, kind, glob, pattern).where("problem is null")
        found = members.select("archive", F.regexp_extract("member", pattern, 1).alias("key"), F.col("member").alias("text_member"), decoded(F.col("content")).alias("said"))
        return found if same_archive else found.select("key", "text_member")

    return read


def lines(pattern: str, columns: dict[str, str], kind: str = "tar", glob: str = "*.tar*"):
    """Lines of the text members that the pattern names, as SQL expressions over `member`, `line` and `line_no`; lines without a key are left out."""

    def read(spark: SparkSession, root: str) -> DataFrame:
        members = files.archive_members(spark, root, kind, glob, pattern).where("problem is null")
        split = members.select("archive", "member", F.posexplode(F.split(decoded(F.col("content")), "\r?\n")).alias("line_no", "line")).where(F.trim("line") != "")
        return split.select("archive", *[F.expr(e).alias(n) for n, e in columns.items()]).where("key is not null and key != ''")

    return read


def listed(path: str, columns: dict[str, str]):
    """Lines of a list beside the archives, as SQL expressions over `line`."""

    def read(spark: SparkSession, root: str) -> DataFrame:
        rows = spark.read.text(f"{root}/{path}").select(F.regexp_replace("value", "\r$", "").alias("line")).where(F.trim("line") != "")
        return rows.select(*[F.expr(e).alias(n) for n, e in columns.items()])

    return read


def annotations(pattern: str, glob: str):
    """(archive, key, notes): the annotated lines of each clip of a folder, lines with events at points first.

    A line is `<file> TAB <text> TAB <intervals>`; the number of lines of a clip is small.
    """
    fields = {"key": "regexp_replace(member, '[^/]+$', split(line, '\t')[0])", "said": "trim(split(line, '\t')[1])", "heard": "try_element_at(split(line, '\t'), 3)", "line_no": "line_no", "member": "member"}

    def read(spark: SparkSession, root: str) -> DataFrame:
        rows = lines(pattern, fields, "zip", glob)(spark, root)
        spans = rows.select("archive", "key", F.struct(F.when(F.col("said").rlike("/>|</"), "span").otherwise("point").alias("style"), "line_no", F.col("said").alias("text"), files.interval_list(F.col("heard")).alias("intervals"), "member").alias("note"))
        return spans.groupBy("archive", "key").agg(F.sort_array(F.collect_list("note")).alias("notes"))

    return read

