"""Ordered operators that never put one series into one task.

``Window.orderBy`` without a key sorts the whole table in one partition, and
``Window.partitionBy(key)`` does the same to a key that holds a third of the
rows.  Here the total order ``(keys, order columns)`` is cut into contiguous
range buckets of similar size, so one long series spans many tasks:

* one pass over the order columns draws a sample and sizes the table.  A row
  has a level from its hash (level ``l`` with a chance of one in ``2**(l+1)``);
  a partition keeps every row at first and asks for one level more each time
  its rows double, so what it keeps grows with the logarithm of its rows.  All
  rows from some level up form an even sample, and the levels asked for tell
  how many rows there are.  The input is read once for this and once for the
  result;
* an edge is placed every ``spacing`` sampled rows.  Between two edges there
  are at least ``spacing`` rows, and the row ``k`` samples before an edge has
  at least ``k`` rows between itself and the edge.  That makes it a safe start
  for a halo of ``k`` rows without counting anything;
* edges are a directory of two levels: at most ``_COARSE`` coarse edges are a
  literal of the plan, whose size so does not follow the rows, and the edges
  between two coarse ones are a row of a written table, joined by the coarse
  range (broadcast if its measured size is small, else by a shuffle whose heavy
  ranges the skew join cuts).  A row finds its bucket by two binary searches;
* halo rows are copied into the neighbouring bucket by one ``explode``, the
  window runs on ``(bucket, keys)``, and the copies are dropped.

The order columns must identify a row (end them with a unique id).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from larkspur.session import written

_BUCKET, _HALO, _COPY = "__bucket", "__halo", "__copy"
_BUCKET_ROWS = 1_000_000  # rows of a bucket that the number of buckets aims at
_SPACING = 32  # sampled rows between two edges where no frame asks for more
_KEPT = 4_096  # rows of a partition that are kept before the sample thins
_SAMPLE_PART = 200_000  # sampled rows that one task numbers
_COARSE = 256  # edges in the plan
_LONGEST = 10_000_000  # rows of a frame that one task holds; longer ones are differences of running totals
_EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_KINDS = ("low", "at", "high")  # where halos start, buckets start, and halos end

Build = Callable[[WindowSpec], dict[str, Column]]


class Directory(NamedTuple):
    """Coarse edges as sorted literal arrays; ``fine`` has, per range between coarse edges ``at``, the edges of each kind and how many come before."""

    coarse: dict[str, Column]
    n_coarse: int
    fine: DataFrame | None
    n_fine: int


def _sample(keys: DataFrame, order: Sequence[str], kept: int) -> DataFrame:
    """Rows ``(p, level, asked)`` that pass the level their partition asks for at their place in it."""
    drawn = F.xxhash64(*order)
    lowest = drawn.bitwiseAND(F.try_subtract(F.lit(0).cast("long"), drawn))  # a power of two; null for the least long
    level = F.coalesce(F.bit_count(lowest - 1), F.lit(63))  # zeros at the end of the hash
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    asked = F.when(place < kept, 0).otherwise(F.floor(F.log2(place / F.lit(float(kept)))).cast("int") + 1)
    return keys.select(F.struct(*order).alias("p"), level.alias("level"), asked.alias("asked")).filter("level >= asked")


def _numbered(sampled: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """Distinct sampled points ``p`` with their place ``i`` (from 0) in the total order, and the frame held for them.

    Range partitions are numbered inside and shifted by the counts of the
    partitions before, so no task holds more than a partition of the sample.
    """
    parts = max(1, -(-rows // _SAMPLE_PART))
    ranged = sampled.distinct().repartitionByRange(parts, "p").sortWithinPartitions("p")
    local = ranged.withColumn("at", F.monotonically_increasing_id()).withColumns(
        {"part": F.shiftright("at", 33), "at": F.col("at").bitwiseAND(F.lit((1 << 33) - 1))}
    ).persist(StorageLevel.MEMORY_AND_DISK)
    if parts == 1:
        return local.select("p", F.col("at").alias("i")), local
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    shifts = local.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("shift"))
    return local.join(shifts, "part").select("p", (F.col("at") + F.col("shift")).alias("i")), local


def _plan(df: DataFrame, reach: int, buckets: int | None, rows: int) -> tuple[int, int]:
    """Level of the sample and sampled rows between two edges, for a table of about ``rows`` rows."""
    wanted = buckets or max(2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // _BUCKET_ROWS))
    # samples between two edges: four frames, so that halos stay a small share, unless that leaves too few rows for two buckets
    spacing = max(min(4 * reach, rows // 2), reach, 1) if reach > 1 else _SPACING
    if reach <= 1 and rows < wanted * spacing:
        spacing = max(1, rows // wanted)
    return max(1, rows // (wanted * spacing)).bit_length() - 1, max(spacing, rows // wanted)


def _directory(df: DataFrame, order: Sequence[str], before: int, after: int, buckets: int | None) -> Directory | None:
    """Edges of about ``buckets`` ranges.  None if the rows are fewer than a frame reaches, or no two rows differ in the order columns."""
    reach = max(before, after, 1)
    if reach > _LONGEST:
        raise ValueError(f"a frame of {reach} rows must fit into a task, at most {_LONGEST}; use shifted_rows or long_frames")
    held = [_sample(df.select(*order), order, max(_KEPT, 8 * reach)).persist(StorageLevel.MEMORY_AND_DISK)]
    try:
        kept = held[0].groupBy("level").agg(F.count("*").alias("n"), F.sum(F.pow(F.lit(2.0), F.col("asked"))).alias("rows"), F.max("asked").alias("asked")).collect()  # a row per level
        level, per_bucket = _plan(df, reach, buckets, round(sum(r["rows"] for r in kept)))
        level = max([level, *[r["asked"] for r in kept]])
        spacing = max(reach if reach > 1 else 1, per_bucket >> level)
        rows = sum(r["n"] for r in kept if r["level"] >= level)
        numbered, local = _numbered(held[0].filter(F.col("level") >= level).select("p"), rows)
        held.append(local)
        every = max(1, -(-(rows // spacing) // _COARSE))  # edges from one coarse edge to the next
        shifts = dict(zip(_KINDS, (-before, 0, after)))

        def edge(kind: str, step: int = 1) -> Column:
            """The point's number among the edges of its kind (from 1), null if it is none."""
            place = F.col("i") - shifts[kind]
            return F.when((place >= spacing) & (place % (spacing * step) == 0), F.floor(place / spacing))

        spots = [F.collect_list(F.when(edge(k, every).isNotNull(), F.struct(edge(k, every).alias("e"), "p"))).alias(k) for k in _KINDS]
        found = numbered.agg(F.max("i").alias("last"), *spots)
        n_edges = F.floor((F.col("last") + 1 - spacing) / spacing)
        real = [F.sort_array(F.transform(F.filter(k, lambda x: x["e"] <= n_edges), lambda x: x["p"])).alias(k) for k in _KINDS]
        found = found.select(n_edges.alias("n"), F.struct(*real).alias("edges")).select("n", F.to_json("edges", _EXACT).alias("text"), F.size("edges.at").alias("coarse"), "edges")
        row = found.select("n", "text", "coarse").first()
        if row["n"] is None or row["n"] < 1:
            return None
        literal = F.from_json(F.lit(row["text"]), found.schema["edges"].dataType, _EXACT)
        coarse = Directory({k: literal[k] for k in _KINDS}, row["coarse"], None, 0)
        if every == 1:
            return coarse
        # the edges of a kind that lie in a coarse range, in order, and how many lie before
        points = numbered.select("p", F.explode(F.array_compact(F.array(*[F.when(edge(k) <= row["n"], F.struct(F.lit(k).alias("kind"), edge(k).alias("e"))) for k in _KINDS]))).alias("x"))
        placed = _search(points.select("p", "x.*"), F.col("p"), coarse.coarse["at"], coarse.n_coarse, "__range")
        lists = placed.groupBy("__range").agg(*[F.sort_array(F.collect_list(F.when(F.col("kind") == k, F.col("p")))).alias(k) for k in _KINDS])
        earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # a row per coarse range
        counted = lists.select("*", *[F.coalesce(F.sum(F.size(k)).over(earlier), F.lit(0)).cast("int").alias(f"n_{k}") for k in _KINDS])
        fine = written(counted, "edges")
        return coarse._replace(fine=fine, n_fine=fine.agg(F.max(F.greatest(*[F.size(k) for k in _KINDS]))).first()[0])
    finally:
        for frame in held:
            frame.unpersist()


def _search(df: DataFrame, point: Column, array: Column, longest: int, name: str) -> DataFrame:
    """Add how many entries of a sorted array are at or below the point, by binary search.

    One projection per step keeps the search in generated code; a higher-order
    function over the array is interpreted and takes ten times as long.
    """
    df = df.withColumn(name, F.lit(0))
    for jump in [1 << i for i in reversed(range(longest.bit_length()))]:
        df = df.withColumn(name, F.col(name) + F.when(F.get(array, F.col(name) + (jump - 1)) <= point, jump).otherwise(0))
    return df


def _placed(df: DataFrame, directory: Directory, order: Sequence[str], names: dict[str, str]) -> DataFrame:
    """Add, per wanted kind, how many of its edges are at or below the row, under the given name."""
    point = F.struct(*order)
    if directory.fine is None:
        for kind, name in names.items():
            df = _search(df, point, directory.coarse[kind], directory.n_coarse, name)
        return df
    columns = df.columns
    df = _search(df, point, directory.coarse["at"], directory.n_coarse, "__range")
    fine = directory.fine.select("__range", *[c for k in names for c in (F.col(k).alias(f"__{k}"), F.col(f"n_{k}").alias(f"__n_{k}"))])
    df = df.join(fine, "__range", "left")
    for kind, name in names.items():
        df = _search(df, point, F.col(f"__{kind}"), directory.n_fine, name)
    return df.select(*columns, *[(F.col(name) + F.coalesce(f"__n_{kind}", F.lit(0))).alias(name) for kind, name in names.items()])


def range_buckets(
    df: DataFrame,
    order: Sequence[str],
    before: int = 0,
    after: int = 0,
    buckets: int | None = None,
) -> DataFrame:
    """Rows with ``__bucket``; rows near an edge also appear in the neighbour with ``__halo`` true.

    A row belongs to the bucket given by the number of edges at or below it.
    Counting halo starts instead may give the next bucket, counting halo ends
    the previous one; the row is copied to every bucket between the two.
    """
    directory = _directory(df, order, before, after, buckets)
    if directory is None:
        return df.withColumns({_BUCKET: F.lit(0), _HALO: F.lit(False)})
    names = {"at": _BUCKET} | ({"high": "__first"} if after else {}) | ({"low": "__last"} if before else {})
    placed = _placed(df, directory, order, names)
    if not before and not after:
        return placed.withColumn(_HALO, F.lit(False))
    first, last = names.get("high", _BUCKET), names.get("low", _BUCKET)
    return (
        placed.withColumn(_COPY, F.explode(F.sequence(first, last)))
        .withColumn(_HALO, F.col(_COPY) != F.col(_BUCKET))
        .withColumn(_BUCKET, F.col(_COPY))
        .drop(_COPY, "__first", "__last")
    )


def window_columns(
    df: DataFrame,
    build: Build | Sequence[Build],
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    before: int = 0,
    after: int = 0,
    buckets: int | None = None,
) -> DataFrame:
    """Add window columns whose frames reach ``before`` rows back and ``after`` rows ahead.

    ``build`` receives the ordered window and returns ``{name: column}``; a list
    of builders runs in turn, later ones using earlier columns, and ``before`` /
    ``after`` must cover their summed reach.  The result equals the plain
    ``Window.partitionBy(partition_by)`` form.
    """
    order = [*partition_by, *order_by]
    spread = range_buckets(df, order, before, after, buckets)
    window = Window.partitionBy(_BUCKET, *partition_by).orderBy(*order_by)
    for step in [build] if callable(build) else build:
        spread = spread.withColumns(step(window))
    return spread.filter(~F.col(_HALO)).drop(_BUCKET, _HALO)


def running_total(
    df: DataFrame,
    sums: dict[str, Column | str],
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """Add inclusive running sums ``{name: value column}`` over the whole order.

    Sum within the bucket plus the total of the earlier buckets.  Only the key
    that opens a bucket can continue from an earlier one, so the carried totals
    have at most one row per bucket and are small enough to broadcast.
    """
    keys = list(partition_by)
    values = {n: (F.col(c) if isinstance(c, str) else c) for n, c in sums.items()}
    directory = _directory(df, [*keys, *order_by], 0, 0, buckets)
    if directory is None:
        window = Window.partitionBy(*keys).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({n: F.sum(v).over(window) for n, v in values.items()})
    placed = _placed(df, directory, [*keys, *order_by], {"at": _BUCKET})
    totals = placed.groupBy(_BUCKET, *keys).agg(*[F.sum(v).alias(f"__t_{n}") for n, v in values.items()])
    earlier = Window.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        totals.select(
            _BUCKET, *keys, F.count(F.lit(1)).over(earlier).alias("__seen"),
            *[F.sum(f"__t_{n}").over(earlier).alias(f"__c_{n}") for n in values],
        )
        .filter(F.col("__seen") > 0)
        .drop("__seen")
    )
    window = Window.partitionBy(_BUCKET, *keys).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    inside = placed.withColumns({n: F.sum(v).over(window) for n, v in values.items()})
    small = F.broadcast(carried.withColumnsRenamed({c: f"__k_{c}" for c in [_BUCKET, *keys]}))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in [_BUCKET, *keys]])
    out = inside.join(small, same, "left")
    return out.select(
        *df.columns,
        *[(F.col(n) + F.coalesce(F.col(f"__c_{n}"), F.lit(0))).alias(n) for n in values],
    )


def row_numbers(
    df: DataFrame,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    name: str = "row_num",
    buckets: int | None = None,
) -> DataFrame:
    """1-based position in the total order (per key when keys are given)."""
    return running_total(df, {name: F.lit(1).cast("long")}, order_by, partition_by, buckets)


def fits_a_task(reach: int) -> bool:
    """Whether a window that reaches so many rows can be built from halos."""
    return reach <= _LONGEST


def _moved(rows: DataFrame, numbered: DataFrame, columns: dict[str, str], shift: int, keys: Sequence[str], number: str) -> DataFrame:
    """Add the columns of the row ``shift`` places earlier in its key (later, if negative): one join on the place, so no key is hot."""
    names = [f"__k{i}" for i in range(len(keys))]
    other = numbered.select((F.col(number) + shift).alias("__place"), *[F.col(k).alias(n) for k, n in zip(keys, names)], *[F.col(c).alias(n) for n, c in columns.items()])
    same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(other[n]) for k, n in zip(keys, names)], rows[number] == other["__place"])
    return rows.join(other, same, "left").drop("__place", *names)


def shifted_rows(df: DataFrame, columns: dict[str, tuple[str, int]], order_by: Sequence[str], partition_by: Sequence[str] = ()) -> DataFrame:
    """Add ``{name: (column, places)}``, the value so many rows before (after, if negative), however far away.

    Rows are numbered and joined on their numbers; nothing has to lie in one task.
    """
    numbered = written(row_numbers(df, order_by, partition_by, name="__place_of"), "numbered")
    out = numbered
    for shift in dict.fromkeys(s for _, s in columns.values()):
        out = _moved(out, numbered, {n: c for n, (c, s) in columns.items() if s == shift}, shift, partition_by, "__place_of")
    return out.drop("__place_of")


def long_frames(df: DataFrame, col: str, lengths: Sequence[int], order_by: Sequence[str], partition_by: Sequence[str] = ()) -> DataFrame:
    """Add ``__count_n``, ``__mean_n`` and ``__std_n`` of the last ``n`` rows for each length, however long.

    One pass of running totals (count, sum and sum of squares around the
    column's mean, which keeps their digits); a frame is the difference of two
    of them, found by a join on the row number.
    """
    centre = F.coalesce(df.agg(F.avg(F.col(col).cast("double"))).scalar(), F.lit(0.0))
    value = F.col(col).cast("double") - centre
    sums = {"__n": F.lit(1).cast("long"), "__c": F.col(col).isNotNull().cast("long"), "__s": F.coalesce("__x", F.lit(0.0)), "__q": F.coalesce(F.col("__x") * F.col("__x"), F.lit(0.0))}
    totals = written(running_total(df.withColumn("__x", value), sums, order_by, partition_by).drop("__x"), "totals")
    out = totals
    for n in dict.fromkeys(lengths):
        out = _moved(out, totals, {"__c0": "__c", "__s0": "__s", "__q0": "__q"}, n, partition_by, "__n")
        count, total, square = (F.col(f"__{c}") - F.coalesce(f"__{c}0", F.lit(0)) for c in "csq")
        spread = (square - total * total / count) / (count - 1)
        out = out.withColumns({
            f"__count_{n}": count, f"__mean_{n}": F.when(count > 0, total / count + centre), f"__std_{n}": F.when(count > 1, F.sqrt(F.greatest(spread, F.lit(0.0)))),
        }).drop("__c0", "__s0", "__q0")
    return out.drop("__n", "__c", "__s", "__q")
