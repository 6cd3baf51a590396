"""The most frequent items, exactly, without shuffling every distinct item.

Counting all items to keep ``k`` of them moves a row per distinct item and task.
Here a first pass counts occurrences per hash bucket, for two hashes: a table
of at most ``2 * buckets`` numbers a group, added up before it moves.  An item
occurs at most as often as the smaller of its two buckets.  Items whose buckets
are both among the fullest are candidates, and one more pass counts just these.

The result is proven, not estimated: if the ``k``-th candidate occurs at least as
often as the bucket total that made a candidate, no other item can replace it.
Groups without that proof get a second count of all items whose buckets reach
the ``k``-th count found, which no item of the answer can miss.  Skewed items need one
round; even ones cost as much as counting everything.

Ties go to the smaller item.  Null items and null groups are counted like others.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from larkspur.session import written

_SMALL = 200_000  # rows of a bucket table that may be broadcast


def _buckets(item: str, buckets: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.col(item), F.lit(salt)), F.lit(buckets)).cast("int") for salt in ("first", "second")]


def bucket_totals(rows: DataFrame, item: str, within: Sequence[str], buckets: int) -> DataFrame:
    """``(*within, which, bucket, total)`` for both hashes."""
    pairs = F.array(*[F.struct(F.lit(i).alias("which"), b.alias("bucket")) for i, b in enumerate(_buckets(item, buckets))])
    return rows.select(*within, F.inline(pairs)).groupBy(*within, "which", "bucket").agg(F.count(F.lit(1)).alias("total"))


def _counted(rows: DataFrame, item: str, within: Sequence[str], hot: DataFrame, buckets: int) -> DataFrame:
    """Exact counts of the items whose buckets are both hot."""
    small = hot.count() <= _SMALL
    for i, bucket in enumerate(_buckets(item, buckets)):
        side = hot.filter(F.col("which") == i).select(*[F.col(c).alias(f"__h_{c}") for c in within], F.col("bucket").alias("__hot"))
        side = F.broadcast(side) if small else side
        rows = rows.withColumn("__bucket", bucket)
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__h_{c}")) for c in within], F.col("__bucket") == F.col("__hot"))
        rows = rows.join(side, same, "left_semi").drop("__bucket")
    return rows.groupBy(*within, item).agg(F.count(F.lit(1)).alias("n"))


def _ranked(counts: DataFrame, item: str, within: Sequence[str], k: int) -> DataFrame:
    order = Window.partitionBy(*within).orderBy(F.desc("n"), item)
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _of_groups(rows: DataFrame, groups: DataFrame, within: Sequence[str], how: str = "inner") -> DataFrame:
    """Rows joined to one row per group; without group columns there is just one."""
    names = {c: f"__g_{c}" for c in within}
    other = groups.withColumnsRenamed(names).withColumn("__one", F.lit(1))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()], F.col("__any") == F.col("__one"))
    return rows.withColumn("__any", F.lit(1)).join(other, same, how).drop("__any", "__one", *names.values())


def heavy_hitters(df: DataFrame, item: str, k: int, within: Sequence[str] = (), buckets: int = 1 << 14, first: int = 4) -> DataFrame:
    """``(*within, item, n, rank)``: the ``k`` most frequent values of ``item``, in the table or per group; ``df`` has a row per occurrence."""
    within, rows = list(within), df.select(*within, item)
    totals = written(bucket_totals(rows, item, within, buckets), "buckets")
    place = F.row_number().over(Window.partitionBy("which", *within).orderBy(F.desc("total")))  # at most ``buckets`` rows a group
    fullest = totals.withColumn("__place", place)
    edge = fullest.filter((F.col("__place") == first * k) & (F.col("which") == 0)).select(*within, F.col("total").alias("__edge"))
    groups = totals.select(*within).distinct() if within else totals.select(F.lit(1).alias("__x")).limit(1).select()
    edges = written(_of_groups(groups, edge, within, "left").withColumn("__edge", F.coalesce("__edge", F.lit(0))), "edges")
    hot = _of_groups(totals, edges, within).filter(F.col("total") >= F.col("__edge")).drop("__edge")
    found = written(_ranked(_counted(rows, item, within, hot, buckets), item, within, k), "candidates")
    last = found.groupBy(*within).agg(F.max(F.when(F.col("rank") == k, F.col("n"))).alias("__kth"))
    judged = _of_groups(edges, last, within, "left")
    open_ = written(judged.filter((F.col("__edge") > 0) & (F.coalesce("__kth", F.lit(0)) < F.col("__edge"))).select(*within, F.coalesce("__kth", F.lit(0)).alias("__kth")), "open")
    if open_.isEmpty():
        return found
    again = _of_groups(totals, open_, within).filter(F.col("total") >= F.col("__kth")).drop("__kth")
    more = _ranked(_counted(rows, item, within, again, buckets), item, within, k)
    return _of_groups(found, open_.drop("__kth"), within, "left_anti").unionByName(more)
