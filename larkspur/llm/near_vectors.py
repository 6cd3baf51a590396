"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

A rotation of the principal directions is learned on a bounded sample
(``fit_rows`` rows drawn by a hash of the id) so that the signs of a rotated
vector make a balanced binary code.  The code is cut into substrings, once
contiguously and then after shuffles of its bits, and every vector enters one
table per substring; vectors that agree on a substring of one table, but for
one bit at most, and on the label meet in a bucket: besides its own key, a
vector probes the keys with one of its set bits cleared, so that a pair one bit
apart meets once, at the key without the bit.  Substrings are as long as the
logarithm of the largest label's classes asks for, so that chance meetings per
vector stay as many while rows grow; tables are added until a pair at the
threshold would miss all of them with a chance of ``miss`` at most (bits taken
as independent).

Of the vectors that meet, those whose whole codes differ in more bits than a
pair at the threshold would with a chance of one in a million go; this reads
codes alone.  The rest are compared by their original vectors in double
precision, and a pair that meets in several tables counts in the first.

Equal vectors of a label are one class with a multiplicity, so copies are never
paired up.  A bucket of more than ``block`` classes is cut into blocks and each
pair of blocks is a group of its own: no group grows with the data, and all
pairs are still compared.  A task reads its groups in order, many in one batch.
Buckets put out a link count and one edge per class, not their pairs.

Defined cases: vectors that are null, hold null, NaN or infinite components, or
only zeros, or have another length than the most frequent one, and rows with a
null label or id, link with nothing; equal rows count once; an id with several
vectors has the links of all of them and joins their components; a null id gives one row with null
component that is not kept; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from larkspur.llm.common import components, staged
from larkspur.llm.small_world import usable_rows

_TOP_BITS = 64


def learn_rotation(sample: np.ndarray, rounds: int = 50, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection of iterative quantisation: principal directions, then the rotation that brings them nearest to their signs."""
    mean = sample.mean(axis=0)
    centred = sample - mean
    bits = min(sample.shape[1], _TOP_BITS)
    _, axes = np.linalg.eigh(centred.T @ centred)
    main = axes[:, ::-1][:, :bits]
    points = centred @ main
    rotation, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))
    for _ in range(rounds):
        signs = np.where(points @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(signs.T @ points)
        rotation = (left @ right).T
    return mean, main @ rotation


def code_tables(bits: int, classes: int, threshold: float, miss: float = 0.002, seed: int = 0) -> list[list[int]]:
    """Bit positions of each table: as many equal cuts as keys of ``log2(classes)`` bits allow, over as many orders of the bits as ``miss`` asks for."""
    cuts = max(min(2, bits), bits // max(8, math.ceil(math.log2(max(classes, 2)))))
    flip = math.acos(threshold) / math.pi
    stay = lambda k: (1 - flip) ** k + k * flip * (1 - flip) ** (k - 1)  # noqa: E731  # k bits agree but for one
    missed, order, draw, tables = 1.0, np.arange(bits), np.random.default_rng(seed), []
    while missed > miss or len(tables) < 2 * cuts:
        cut = [sorted(map(int, x)) for x in np.array_split(order, cuts)]
        tables += cut
        missed *= math.prod(1 - stay(len(x)) for x in cut)
        order = draw.permutation(bits)
    return tables


def code_distance(bits: int, threshold: float, miss: float = 1e-6) -> int:
    """Bits that a pair at the threshold exceeds with a chance of ``miss`` at most, if bits flip independently."""
    flip, tail, k = math.acos(threshold) / math.pi, 1.0, -1
    while tail > miss and k < bits:
        k += 1
        tail -= math.comb(bits, k) * flip**k * (1 - flip) ** (bits - k)
    return k


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups of rows that arrive sorted by ``keys``, with the starts of their groups and the end."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]).combine_chunks() if rest is not None else table
        if not len(table):
            continue
        columns = [table.column(k).to_numpy() for k in keys]
        starts = np.flatnonzero(np.concatenate([[True], np.any([c[1:] != c[:-1] for c in columns], axis=0)]))
        if len(starts) > 1:
            yield table.slice(0, starts[-1]), starts
        rest = table.slice(starts[-1])
    if rest is not None and len(rest):
        yield rest, np.array([0, len(rest)])


def _met_pairs(table: pa.Table, starts: np.ndarray, tables: list[list[int]], furthest: int, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of the groups that count: of two blocks if the group has two, one of them at home, codes near, and not met in an earlier table."""
    code, home, part, i, j, t = (table.column(c).to_numpy() for c in ("code", "home", "part", "i", "j", "t"))
    masks = [np.int64(np.uint64(sum(1 << b for b in bits)).astype("i8")) for bits in tables]
    sizes = np.diff(starts)
    first = np.repeat(starts[:-1], sizes)
    partners = np.arange(starts[-1]) - first  # each row pairs with the rows of its group before it
    begin, done = 0, np.concatenate([[0], np.cumsum(partners)])
    while begin < len(partners):
        end = max(begin + 1, int(np.searchsorted(done, done[begin] + most, side="right")) - 1)
        counts = partners[begin:end]
        x = np.repeat(np.arange(begin, end), counts)
        y = np.repeat(first[begin:end], counts) + np.arange(len(x)) - np.repeat(done[begin:end] - done[begin], counts)
        apart = code[x] ^ code[y]
        good = (home[x] | home[y]) & ((i[x] == j[x]) | (part[x] != part[y])) & (np.bitwise_count(apart.view("u8")) <= furthest)
        x, y, apart = x[good], y[good], apart[good]
        for earlier, mask in enumerate(masks):
            new = (t[x] <= earlier) | (np.bitwise_count((apart & mask).view("u8")) > 1)
            x, y, apart = x[new], y[new], apart[new]
        yield x, y
        begin = end


def near_vectors(
    df: DataFrame, threshold: float = 0.98, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
    fit_rows: int = 20_000, block: int = 256,
) -> DataFrame:
    """One row per id: ``vec_id, n_links, component_id, kept``."""
    spark = df.sparkSession
    everyone = df.select(F.col(id_column).cast("long").alias("vec_id")).distinct()
    labelled = df.filter(F.col(label_column).isNotNull())
    plain = usable_rows(labelled, id_column, vector_column)  # of the vectors alone, for the common length
    length = plain.select(F.size("v").alias("d")).limit(1).first()
    if length is None:
        return everyone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    raw = labelled.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).alias("label"), F.col(vector_column).cast("array<double>").alias("v"))
    keyed = raw.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))).join(plain.withColumnRenamed("v", "w"), "id").filter("v = w").drop("w")
    members = staged(keyed.select("id", "label", "v", F.xxhash64("label", "v").alias("c")).dropDuplicates(["id", "label", "c"]), "members")
    classes = staged(members.groupBy("c", "label").agg(F.min("id").alias("rep"), F.count("*").alias("n"), F.first("v").alias("v")), "classes")

    total = classes.count()
    share = 1 << 30
    sampled = classes.filter(F.pmod(F.xxhash64("rep"), F.lit(share)) < F.lit(max(1, min(share, share * fit_rows // max(total, 1))))).select("v").limit(2 * fit_rows)
    sample = np.array([r["v"] for r in sampled.collect()] or [r["v"] for r in classes.select("v").limit(1).collect()])
    mean, projection = learn_rotation(sample)
    bits = projection.shape[1]
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0]
    tables, furthest = code_tables(bits, largest, threshold), code_distance(bits, threshold)

    @F.pandas_udf("code long, keys array<long>")
    def codes_of(vectors: pd.Series) -> pd.DataFrame:
        signs = (np.stack(vectors.to_numpy()) - mean) @ projection >= 0
        code = (signs.astype("u8") << np.arange(bits, dtype="u8")).sum(axis=1, dtype="u8").view("i8")
        keys = np.stack([signs[:, t] @ (1 << np.arange(len(t))) for t in tables], axis=1).astype("i8")
        return pd.DataFrame({"code": code, "keys": list(keys)})

    coded = staged(classes.withColumn("codes", codes_of("v")).select("c", "label", "rep", "n", "v", "codes.*"), "codes")
    own = coded.select("c", "label", "code", F.posexplode("keys").alias("t", "key"), F.lit(True).alias("home"))
    set_bits = F.filter(F.array(*[F.col("key").bitwiseAND(F.lit(1 << b)) for b in range(max(map(len, tables)))]), lambda bit: bit > 0)
    probes = own.withColumn("bit", F.explode(set_bits)).select("c", "label", "code", "t", (F.col("key") - F.col("bit")).alias("key"), F.lit(False).alias("home"))
    entries = own.unionByName(probes)
    bucket = ["label", "t", "key"]
    sizes = entries.groupBy(*bucket).agg(F.count("*").alias("size"), F.max("home").alias("used")).filter("size > 1 and used")
    sizes = staged(sizes.select(*bucket, F.ceil(F.col("size") / block).cast("int").alias("parts"), F.monotonically_increasing_id().alias("b")), "buckets")
    dealt = entries.join(sizes, bucket).withColumn("part", F.pmod(F.xxhash64("c", "t"), F.col("parts")).cast("int"))
    paired = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "c", "label", "code", "t", "b", "home", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j")
    )
    group = ("b", "i", "j")
    label_type = classes.schema["label"].dataType.simpleString()
    entry_type = f"c long, label {label_type}, code long, t int, b long, home boolean, part int, i int, j int"

    def near_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _whole_groups(batches, group):
            kept = np.zeros(len(table), bool)
            for x, y in _met_pairs(table, starts, tables, furthest):
                kept[x] = kept[y] = True
            if kept.any():
                yield from table.filter(pa.array(kept)).to_batches()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _whole_groups(batches, group):
            vectors = table.column("v").combine_chunks().flatten().to_numpy().reshape(len(table), -1)
            lengths = np.sqrt((vectors * vectors).sum(1))
            n, reps = table.column("n").to_numpy(), table.column("rep").to_numpy()
            links, root = np.zeros(len(table), "i8"), reps.copy()
            near_x, near_y = [], []
            for x, y in _met_pairs(table, starts, tables, furthest, 1 << 15):
                near = (vectors[x] * vectors[y]).sum(1) / (lengths[x] * lengths[y]) >= threshold
                near_x.append(x[near])
                near_y.append(y[near])
            x, y = np.concatenate([np.zeros(0, "i8"), *near_x]), np.concatenate([np.zeros(0, "i8"), *near_y])
            np.add.at(links, x, n[y])
            np.add.at(links, y, n[x])
            while len(x):  # the smallest representative of each linked part of a group
                least = np.minimum(root[x], root[y])
                if (root[x] == least).all() and (root[y] == least).all():
                    break
                np.minimum.at(root, x, least)
                np.minimum.at(root, y, least)
            found = pa.array(links > 0)
            out = table.select(["c", "label", "rep"]).append_column("links", pa.array(links)).append_column("root", pa.array(root)).filter(found)
            if len(out):
                yield from out.to_batches()

    sort = lambda rows: rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *group).sortWithinPartitions(*group)
    close = staged(sort(paired).mapInArrow(near_codes, entry_type), "close")
    full = close.join(coded.select("c", "label", "rep", "n", "v"), ["c", "label"])
    found = staged(sort(full).mapInArrow(compare, f"c long, label {label_type}, rep long, links long, root long"), "links")

    counts = found.groupBy("c", "label").agg(F.sum("links").alias("links"))
    per_class = classes.select("c", "label", "n").join(counts, ["c", "label"], "left").select("c", "label", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"))
    per_id = members.select("id", "c", "label").join(per_class, ["c", "label"]).groupBy("id").agg(F.sum("links").alias("links"))
    copies = members.select("id", "c", "label").join(classes.select("c", "label", "rep"), ["c", "label"]).select(F.col("id").alias("a"), F.col("rep").alias("b"))
    linked = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")).unionByName(copies))
    out = everyone.join(per_id.withColumnRenamed("id", "vec_id"), "vec_id", "left").join(linked.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))
