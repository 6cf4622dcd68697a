"""Scans.  Every reader takes an explicit schema; none infers types.

JSON inputs are read as JSON Lines by default, because such files split across
tasks.  ``multiline=True`` reads the older whole-document exports, one task per
file.

Input that does not parse raises an error (``FAILFAST``).  With
``bad="skip"`` it is left out of the rows, and ``rejects`` returns it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee import schemas


MODES = {"fail": "FAILFAST", "skip": "DROPMALFORMED"}


def read_json(spark: SparkSession, path: str, schema, multiline: bool = False, bad: str = "fail") -> DataFrame:
    return spark.read.schema(schema).option("multiLine", multiline).option("mode", MODES[bad]).json(path)


def rejects(spark: SparkSession, path: str, schema, multiline: bool = False) -> DataFrame:
    """(file, bad): every line, or whole document, that does not parse as ``schema`` (struct or map)."""
    lines = spark.read.text(path, wholetext=multiline).where(F.trim("value") != "")
    lines = lines.select(F.col("_metadata.file_path").alias("file"), "value")
    if isinstance(schema, T.MapType):
        parsed = lines.withColumn("doc", F.from_json("value", schema))
        return parsed.where(F.col("doc").isNull()).select("file", F.col("value").alias("bad"))
    marked = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    if multiline:
        marked = T.ArrayType(marked)
    parsed = lines.withColumn("doc", F.from_json("value", marked, {"columnNameOfCorruptRecord": "_bad"}))
    wrong = F.col("doc").isNull() if multiline else F.col("doc._bad").isNotNull()
    return parsed.where(wrong).select("file", F.col("value").alias("bad"))


def arrival() -> Column:
    """Where a row stands in its input: file, block and place.  Select it directly on a file scan."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("place"))


def read_movies(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    return read_json(spark, path, schemas.MOVIE_DETAILS, multiline)


def read_trailers(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    return read_json(spark, path, schemas.TRAILERS, multiline)


def read_sentiment(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    return read_json(spark, path, schemas.SENTIMENT, multiline)


def read_snippets(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    return read_json(spark, path, schemas.SNIPPETS, multiline)


def read_report(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Rows of one or many report documents."""
    documents = read_json(spark, path, schemas.REPORT, multiline)
    return documents.select(F.explode("results").alias("r")).select("r.*")


def _read_map(spark: SparkSession, path: str, schema, multiline: bool, key: str, bad: str = "fail") -> DataFrame:
    lines = spark.read.text(path, wholetext=multiline).select("value", arrival().alias("seq"))
    mode = {"mode": "FAILFAST" if bad == "fail" else "PERMISSIVE"}
    documents = lines.where(F.trim("value") != "").select(F.from_json("value", schema, mode).alias("doc"), "seq")
    return documents.select(F.explode("doc").alias(key, "entry"), "seq")


def read_credits_map(spark: SparkSession, path: str, multiline: bool = False, bad: str = "fail") -> DataFrame:
    """``{movie id: credits}`` objects to one row per movie."""
    return _read_map(spark, path, schemas.CREDITS_MAP, multiline, "movie_id", bad).select("movie_id", "entry.*")


def read_article_map(spark: SparkSession, path: str, multiline: bool = False, bad: str = "fail") -> DataFrame:
    """One row per entry; ``seq`` is where its document stands."""
    return _read_map(spark, path, schemas.ARTICLE_MAP, multiline, "movie_id", bad).select("movie_id", "entry.*", "seq")


def read_series_map(spark: SparkSession, path: str, multiline: bool = False, bad: str = "fail") -> DataFrame:
    """``{title: {timestamp: value}}`` objects to (title, ts, value) rows of text values."""
    titles = _read_map(spark, path, schemas.SERIES_MAP, multiline, "title", bad)
    return titles.select("title", F.explode("entry").alias("ts", "value"))


def read_parquet(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """CSV with a header; quoted values may hold newlines and doubled quotes."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def optional_source(spark: SparkSession, path: str, schema, fmt: str = "json", multiline: bool = False,
                    bad: str = "fail", order: str | None = None) -> DataFrame:
    """The source, or an empty frame of its schema when the path does not exist.

    ``order`` names a column for where each row stands (see ``arrival``).
    """
    seq = [arrival().alias(order)] if order else []
    try:
        reader = spark.read.schema(schema)
        if fmt == "json":
            reader = reader.option("multiLine", multiline).option("mode", MODES[bad])
        return reader.format(fmt).load(path).select("*", *seq)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        empty = spark.createDataFrame([], schema)
        place = "struct<file:string,block:bigint,place:bigint>"
        return empty.withColumn(order, F.lit(None).cast(place)) if order else empty
