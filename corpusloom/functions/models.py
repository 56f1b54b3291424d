"""Models as injectable batch functions.

The engine holds no weights.  A predictor takes a list of inputs and gives a list of outputs;
the operators around it keep the table semantics: one status row per input, payload null
unless ok, inputs grouped so that a batch stays within its budget.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

Predictor = Callable[[list], list]


def annotate(df: DataFrame, key: str, value: str, make: Callable[[], Predictor], result: str, batch_rows: int = 64) -> DataFrame:
    """(key, status, error_code, result) of each row; `make` builds the predictor once per worker.

    A predictor that raises on a batch is tried row by row; rows that raise are `failed`,
    null inputs are `skipped`.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = make()
        for batch in batches:
            rows = []
            inputs = list(zip(batch[key], batch[value]))
            for a in range(0, len(inputs), batch_rows):
                some = [(k, v) for k, v in inputs[a : a + batch_rows] if v is not None]
                rows += [(k, "skipped", "missing_input", None) for k, v in inputs[a : a + batch_rows] if v is None]
                try:
                    rows += [(k, "ok", None, out) for (k, _), out in zip(some, predict([v for _, v in some]))]
                except Exception:
                    for k, v in some:
                        try:
                            rows.append((k, "ok", None, predict([v])[0]))
                        except Exception as e:
                            rows.append((k, "failed", type(e).__name__, None))
            yield pd.DataFrame(rows, columns=[key, "status", "error_code", "result"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, value).mapInPandas(run, f"`{key}` {kind}, status string, error_code string, result {result}")


def hashed_embedding(size: int = 16) -> Callable[[], Predictor]:
    """A deterministic stand-in for an embedding model: bytes of a hash as numbers in [-1, 1)."""

    def make() -> Predictor:
        return lambda values: [[b / 128.0 - 1.0 for b in hashlib.sha256(str(v).encode()).digest()[:size]] for v in values]

    return make
