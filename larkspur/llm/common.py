"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math
from collections.abc import Callable
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from larkspur.session import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the cluster's shared folder and read it back: lineage ends at files that outlive executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def release(df: DataFrame) -> None:
    """Delete the files of a :func:`staged` frame that nothing will read again."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.staged_path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


class Shared:
    """A broadcast value with what each Python worker makes of it once, such as an encoder with its table of words.

    Only the value travels.  What was made lives and goes with the broadcast,
    so a worker that later runs other tasks does not keep it.
    """

    def __init__(self, value: Any, make: Callable[[Any], Any]) -> None:
        self.value, self.make = value, make

    def __getstate__(self) -> dict:
        return {"value": self.value, "make": self.make}

    def made(self) -> Any:
        if "_made" not in self.__dict__:
            self._made = self.make(self.value)
        return self._made


def vocabulary_bytes(path: str) -> bytes:
    """A tokenizer's file, read where the job is built and sent to the tasks (a few MB, whatever the data)."""
    return Path(path).read_bytes()


def usable_vector(vector: str | Column) -> Column:
    """Not null, not empty, no null, NaN or infinite component, and not all zero."""
    v = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce((F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected edge list: one row ``(node, component)`` per node of an edge that joins two nodes.

    ``component`` is the smallest node of the component.  Alternating
    large-star and small-star steps: each round every node points its larger
    neighbours, then itself and its smaller neighbours, at the smallest node
    it sees.  A round is two grouped minima joined back to slim rows, so a hub
    with very many neighbours is pre-aggregated and its rows can be split by
    the skew join.  Each round is written to the shared folder.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    pairs, seen = staged(pairs, "edges"), None
    while True:
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        seen = state
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        last, pairs = pairs, staged(small.filter("u <> v").distinct(), "edges")
        release(last)
