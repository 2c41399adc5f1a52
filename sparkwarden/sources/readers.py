"""Scans of logs, lists and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines with a given schema; nothing is inferred."""
    return spark.read.schema(schema).json(path)


def read_tsv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Tab-separated text with a header line and a given schema."""
    return spark.read.schema(schema).option("sep", "\t").option("header", True).csv(path)


def read_closed_files(spark: SparkSession, path: str, schema: StructType | str, prefix: str) -> DataFrame:
    """JSON files whose name begins with ``prefix``, but for the newest of them (still being written), in one scan.

    The name of each row's file is in ``file``; names order by time.
    """
    rows = spark.read.schema(schema).option("pathGlobFilter", f"{prefix}*").json(path).withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    newest = spark.read.format("binaryFile").option("pathGlobFilter", f"{prefix}*").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file")).agg(F.max("file").alias("newest"))
    return rows.join(F.broadcast(newest), F.col("file") < F.col("newest")).drop("newest")


def read_list(spark: SparkSession, path: str, column: str = "value") -> DataFrame:
    """The distinct, non-empty lines of a text file."""
    return spark.read.text(path).select(F.trim("value").alias(column)).where(F.col(column) != "").distinct()


def read_relational(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A query that the database answers, so that its conditions run there."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def read_between(spark: SparkSession, path: str, column: str, low, high) -> DataFrame:
    """Rows of a Parquet event table in a time range; date partitions outside it are not read."""
    return spark.read.parquet(path).where(F.col(column).between(low, high))


def read_svmlight(spark: SparkSession, path: str, features: int) -> DataFrame:
    return spark.read.format("libsvm").option("numFeatures", str(features)).load(path)


def read_magic(spark: SparkSession, path: str, magic: bytes) -> DataFrame:
    """Binary files whose first bytes are ``magic``."""
    return spark.read.format("binaryFile").load(path).where(F.substring("content", 1, len(magic)) == F.lit(bytearray(magic)))
