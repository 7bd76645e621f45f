"""Tables and contexts out of the store: Parquet, CSV, and a context with its metadata. Files are written by the executors."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from .store import Store


def tables(store: Store, names: Iterable[str], path: str, kind: str = "parquet") -> dict[str, str]:
    """Writes the last version of each table under path; returns where."""
    out = {}
    for name in names:
        out[name] = f"{path.rstrip('/')}/{name}"
        write(store.read(name), out[name], kind)
    return out


def write(df: DataFrame, path: str, kind: str = "parquet") -> None:
    if kind == "csv":
        df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    elif kind in ("parquet", "json", "orc"):
        df.write.mode("overwrite").format(kind).save(path)
    else:
        raise ValueError(f"no format {kind!r}")


def save_context(rows: DataFrame, meta: dict, path: str) -> None:
    """A context (bounded by policy) and what is known about it, side by side."""
    path = path.rstrip("/")
    rows.write.mode("overwrite").parquet(f"{path}/rows")
    spark = rows.sparkSession
    spark.createDataFrame([(json.dumps(meta, default=str, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def load_context(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    path = path.rstrip("/")
    return spark.read.parquet(f"{path}/rows"), json.loads(spark.read.text(f"{path}/meta").first()["value"])
