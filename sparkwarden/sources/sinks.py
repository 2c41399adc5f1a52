"""Messages, tables and their upkeep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwarden.sources.versions import Batches


def messages(df: DataFrame) -> DataFrame:
    """Each row as one JSON ``value``, as a message topic takes it."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def send(df: DataFrame, servers: str, topic: str) -> None:
    messages(df).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def overwrite_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Partitions that ``df`` has are replaced, others stay; each is brought together first, a large one in several files."""
    df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def append_rows(df: DataFrame, path: str, batch: str) -> None:
    """Add a batch of rows; one that is appended again replaces itself."""
    Batches(df.sparkSession, path, df.schema).write(df, batch)


def append_relational(df: DataFrame, url: str, table: str, **options: str) -> None:
    df.write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()


def message_id(*keys: str) -> Column:
    """A stable id from the keys of a row."""
    return F.sha2(F.concat_ws("#", *(F.col(k).cast("string") for k in keys)), 256)


def expired_partitions(partitions: DataFrame, today: str, days: int) -> DataFrame:
    """Date-named partitions older than ``days`` before ``today``; deleting them is left to the caller."""
    return partitions.where(F.to_date("partition") < F.date_sub(F.lit(today).cast("date"), days))
