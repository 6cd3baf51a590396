"""Splits and samples that depend on a row's key, never on its partition."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def hash_bucket(key: str, buckets: int = 100, salt: str = "") -> Column:
    """Bucket 0 .. ``buckets - 1`` from the first 32 bits of the md5 of the key."""
    text = F.concat(F.lit(salt), F.col(key).cast("string")) if salt else F.col(key).cast("string")
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % buckets


def with_split(df: DataFrame, key: str, train_percent: int = 80, name: str = "split") -> DataFrame:
    """Label each row ``train`` or ``test``; the same key always gets the same label."""
    return df.withColumn(name, F.when(hash_bucket(key) < train_percent, "train").otherwise("test"))


def hash_split(df: DataFrame, key: str, train_percent: int = 80) -> tuple[DataFrame, DataFrame]:
    in_train = hash_bucket(key) < train_percent
    return df.filter(in_train), df.filter(~in_train)


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Spark's own split; repeatable only while the partitioning of ``df`` is."""
    return df.randomSplit(list(weights), seed)


def stratified_sample(df: DataFrame, label: str, percents: Mapping[object, int], key: str) -> DataFrame:
    """Keep about ``percents[label]`` per cent of each class, without replacement; unlisted classes drop out."""
    share = F.lit(0)
    for value, percent in percents.items():
        share = F.when(F.col(label) == F.lit(value), F.lit(percent)).otherwise(share)
    return df.filter(hash_bucket(key) < share)


def column_split(df: DataFrame, col: str, train: object = "train", test: object = "test") -> tuple[DataFrame, DataFrame]:
    """Split carried by a column."""
    return df.filter(F.col(col) == train), df.filter(F.col(col) == test)


def union_named(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.unionByName(other)
    return first


def union_positional(first: DataFrame, second: DataFrame) -> DataFrame:
    """Union by position; widths and types must agree, names come from ``first``."""
    types = lambda df: [f.dataType for f in df.schema.fields]
    if types(first) != types(second):
        raise ValueError(f"schemas differ: {first.schema.simpleString()} and {second.schema.simpleString()}")
    return first.union(second)


def spread(df: DataFrame, n: int, *cols: str) -> DataFrame:
    """Repartition into ``n`` parts, by columns when given."""
    return df.repartition(n, *cols)


def widen(df: DataFrame, *cols: str) -> DataFrame:
    """Spread a scanned table by ``cols`` when it has fewer splits than the session has cores.

    A large table has many splits and is left alone; a small file with heavy
    rows would otherwise keep all the work in one task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *cols)
