"""Writers.  Append sinks keep one folder per collection, as tables do."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """CSV with header; write to a fresh path, never over the one being read."""
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def write_map_json(df: DataFrame, key: str, value, path: str) -> str:
    """One ``{key: value}`` object per line, readable by the map readers."""
    entry = F.create_map(F.col(key).cast("string"), value)
    df.select(F.to_json(entry).alias("value")).write.mode("overwrite").text(path)
    return path


def append_documents(df: DataFrame, root: str, collection: str) -> str:
    """Append raw documents to a collection; an empty frame adds nothing."""
    path = f"{root}/{collection}"
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("append").text(path)
    return path


def append_predictions(df: DataFrame, path: str) -> str:
    df.select("title", "predicted_revenue", "success_class", "confidence").write.mode("append").parquet(path)
    return path
