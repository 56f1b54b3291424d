"""Python workers must be able to import this package."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def reachable(spark: SparkSession) -> SparkSession:
    """Adds the package's folder to the workers' import path, whatever the driver's own path or working folder is.

    Where workers don't see this folder, ship the package with --py-files.
    """
    env = spark.sparkContext.environment
    have = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in have:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *have])
    return spark
