"""Immutable snapshots with manifests, verified writes, resumable tasks and a failure journal."""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpusloom.shared import hadoop_path
from corpusloom.sources.base import schema_digest


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def write_json(spark: SparkSession, path: str, value: dict) -> None:
    """Written beside its place and renamed, so readers see the old or the new file, never a part."""
    fs, p = hadoop_path(spark, path)
    aside = p.suffix(f".{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    out.write(bytearray(json.dumps(value, sort_keys=True, ensure_ascii=False, indent=1).encode()))
    out.close()
    jvm = spark._jvm
    overwrite = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(aside), fs.makeQualified(p), overwrite)


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).take(1)))


@dataclass(frozen=True)
class Snapshot:
    """A published version of a table."""

    path: str
    manifest: dict

    def read(self, spark: SparkSession, verify: bool = True) -> DataFrame:
        """The pinned table; with `verify`, its number of rows and schema must be those of the manifest."""
        df = spark.read.parquet(f"{self.path}/data")
        if verify and schema_digest(df.schema) != self.manifest["schema_sha256"]:
            raise ValueError(f"{self.path}: the schema isn't the published one")
        if verify and (n := df.count()) != self.manifest["rows"]:
            raise ValueError(f"{self.path}: {n} rows, {self.manifest['rows']} were published")
        return df


def publish(df: DataFrame, root: str, name: str, key: str, sources: dict | None = None, max_rows: int = 1_000_000, sort: bool = True) -> Snapshot:
    """Writes `df` as the next version of a table: stage, read back, compare, rename.

    The staged files are compared with the input by count and an order-free fingerprint of
    key and content, which is taken while the rows are written: the plan runs once, so it
    need not be deterministic.  Rows are sorted by key within files, so that row group
    statistics prune lookups.
    """
    spark = df.sparkSession
    stage, base = f"{root}/_stage/{uuid.uuid4().hex}", f"{root}/{name}"
    seen = Observation()
    made = (df.sortWithinPartitions(key) if sort else df).observe(seen, *_measures(df))
    made.write.option("maxRecordsPerFile", max_rows).option("parquet.bloom.filter.enabled#" + key, "true").parquet(f"{stage}/data")
    back = spark.read.parquet(f"{stage}/data")
    written, found = seen.get, back.agg(*_measures(back)).first().asDict()
    if written != found:
        raise ValueError(f"{name}: what was read back differs from what was written")
    version = next_version(spark, base)
    manifest = {"name": name, "version": version, "rows": found["n"], "fingerprint": f"{found['low'] or 0}:{found['high'] or 0}", "schema_sha256": schema_digest(back.schema), "key": key, "sources": sources or {}, "finished_at": time.strftime("%Y-%m-%dT%H:%M:%S+00:00", time.gmtime())}
    write_json(spark, f"{stage}/manifest.json", manifest)
    fs, target = hadoop_path(spark, f"{base}/v{version}")
    fs.mkdirs(target.getParent())
    if fs.exists(target) or not fs.rename(hadoop_path(spark, stage)[1], target):
        raise OSError(f"{base}/v{version} was published meanwhile")
    return Snapshot(f"{base}/v{version}", manifest)


def _measures(df: DataFrame) -> list[Column]:
    """Count and two sums of hashes of all columns: equal for equal bags of rows, in any order."""
    content = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}) if df.columns else F.lit("")
    return [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(content).cast("decimal(38,0)")).alias("low"), F.sum(F.xxhash64(F.lit("second"), content).cast("decimal(38,0)")).alias("high")]


def pin(df: DataFrame, key: str) -> dict:
    """What names a table's content in plans that depend on it: rows, schema and an order-free fingerprint of its ids."""
    found = df.select(key).agg(*_measures(df.select(key))).first()
    return {"key": key, "rows": found["n"], "schema_sha256": schema_digest(df.schema), "ids": f"{found['low'] or 0}:{found['high'] or 0}"}


def next_version(spark: SparkSession, base: str) -> int:
    fs, p = hadoop_path(spark, base)
    if not fs.exists(p):
        return 1
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return max([0, *(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit())]) + 1


def open_snapshot(spark: SparkSession, root: str, name: str, version: int | None = None) -> Snapshot:
    """A version of a table, or its latest."""
    version = version or next_version(spark, f"{root}/{name}") - 1
    path = f"{root}/{name}/v{version}"
    return Snapshot(path, read_json(spark, f"{path}/manifest.json"))


def remaining_tasks(spark: SparkSession, done_path: str, tasks: DataFrame, key: str) -> DataFrame:
    """Tasks without finished output; the partition folders of the output are the receipts."""
    if not exists(spark, done_path):
        return tasks
    return tasks.join(spark.read.parquet(done_path).select(key).distinct(), key, "left_anti")


def write_tasks(df: DataFrame, path: str, task: str) -> None:
    """Output of tasks, one partition folder each; running a task again replaces its folder only."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(task).parquet(path)


def journal(df: DataFrame, path: str) -> DataFrame:
    """Appends failures (target, code, stage) that the journal doesn't have yet, and gives the journal."""
    spark = df.sparkSession
    fresh = df.select("target", "code", "stage").distinct()
    if exists(spark, path):
        fresh = fresh.join(spark.read.parquet(path), ["target", "code", "stage"], "left_anti")
    fresh.write.mode("append").parquet(path)
    return spark.read.schema("target string, code string, stage string").parquet(path)


def uncommitted(spark: SparkSession, root: str) -> list[str]:
    """Staged folders that no publication has finished; a driver-side listing."""
    fs, p = hadoop_path(spark, f"{root}/_stage")
    return sorted(s.getPath().toString() for s in fs.listStatus(p)) if fs.exists(p) else []
