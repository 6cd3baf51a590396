"""Packing documents into fixed-length sequences by bin completion.

The packer sees the corpus only as a histogram: how many pieces there are of
each length, at most ``capacity`` rows whatever the data.  Bin completion
(``completion.py``) turns it into fillings with multiplicities, also of bounded
size.  Pieces then find their places in parallel: the rank of a piece among
those of its length, a prefix sum over (length, input split) plus its number
inside the split, tells which bin of which filling is its own.  So a length
that a third of all pieces share is spread over as many groups as there are
splits, and no task or driver sees more than counts.

Defined cases: a null or empty text is a document of the end id alone;
repeated rows are packed as separate pieces; pieces of a null length or one
outside 1..capacity get null places; an empty table gives no rows; columns
named ``sequence_id`` and ``offset`` are replaced, all others stay.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from larkspur.llm.common import Shared, staged, vocabulary_bytes
from larkspur.llm.completion import Plan, complete_bins
from larkspur.llm.words import TextEncoder

_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])
_BATCH_BYTES = 1 << 24


def token_pieces(docs: DataFrame, tokenizer_file: str, end_id: int = 1, capacity: int = 4096, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Ids of each whole text and ``end_id``, cut every ``capacity`` ids: ``doc_id, piece, start, length, ids`` (binary, little-endian 32 bits)."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Shared(vocabulary_bytes(tokenizer_file), TextEncoder))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary.value.made()
        end = np.array([end_id], "<u4")
        rows, held = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids = np.concatenate([encoder.encode(text.as_py()), end])
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    rows.append((doc_id.as_py(), piece, start, len(part), part.tobytes()))
                    held += part.nbytes
                if held > _BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PIECES.types)], schema=_PIECES)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PIECES.types)], schema=_PIECES)

    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return slim.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids binary")


def _places(plan: Plan) -> dict[str, np.ndarray]:
    """Runs of ranks per length, sorted by (length, first rank): where the filling's bins start and where in a bin the copies lie."""
    taken, runs, first_bin = Counter(), [], 0
    for filling, bins in plan:
        at = 0
        slots = defaultdict(list)
        for size in filling:
            slots[size].append(at)
            at += size
        for size, offsets in slots.items():  # copies of one size lie next to each other, as fillings are sorted
            runs.append((size, taken[size], len(offsets), first_bin, offsets[0]))
            taken[size] += bins * len(offsets)
        first_bin += bins
    columns = np.array(sorted(runs), "int64").reshape(-1, 5).T
    return dict(zip(("length", "rank", "copies", "bin", "offset"), columns))


def pack(pieces: DataFrame, capacity: int = 4096, length_column: str = "length", max_nodes: int = 4_000) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a length: few sequences of at most ``capacity``, each gapless from 0.

    ``pieces`` is written once to the shared folder with a row number, since
    ranks must be the same in every later read.  The column names ``__row``,
    ``__split``, ``__length``, ``__base``, ``__n`` and ``__place`` are taken.
    """
    pieces = pieces.drop("sequence_id", "offset")
    length = F.col(length_column).cast("long")
    inside = F.when(length.between(1, capacity), length)
    rows = staged(pieces.withColumns({"__row": F.monotonically_increasing_id(), "__length": inside}), "pieces").withColumn("__split", F.shiftright("__row", 33))
    per_split = rows.filter("__length is not null").groupBy("__length", "__split").agg(F.count("*").alias("__n"))
    histogram = {r[0]: r[1] for r in per_split.groupBy("__length").agg(F.sum("__n")).collect()}  # at most ``capacity`` rows
    plan = _places(complete_bins(histogram, capacity, max_nodes)) if histogram else None
    if plan is None:
        return pieces.withColumns({"sequence_id": F.lit(None).cast("long"), "offset": F.lit(None).cast("long")})
    places = rows.sparkSession.sparkContext.broadcast(plan)

    @F.pandas_udf("sequence_id long, offset long")
    def place(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        p = places.value
        valid = lengths.notna().to_numpy()
        size, rank = lengths.fillna(0).to_numpy("int64"), ranks.fillna(0).to_numpy("int64")
        # runs are sorted by (length, rank): the run of a piece is the last that starts at or before it
        low, high = np.searchsorted(p["length"], size, "left"), np.searchsorted(p["length"], size, "right")
        run = np.minimum(low, len(p["rank"]) - 1)
        step = 1 << int(high.max(initial=1) or 1).bit_length()
        while step:
            reach = run + step
            ok = (reach < high) & (p["rank"][np.minimum(reach, len(p["rank"]) - 1)] <= rank)
            run, step = np.where(ok, reach, run), step >> 1
        inside_run = rank - p["rank"][run]
        out = pd.DataFrame({"sequence_id": p["bin"][run] + inside_run // p["copies"][run], "offset": p["offset"][run] + inside_run % p["copies"][run] * size})
        return out.astype("Int64").where(pd.Series(valid), pd.NA)

    earlier = Window.partitionBy("__length").orderBy("__split").rowsBetween(Window.unboundedPreceding, -1)  # a row per split
    base = per_split.select("__length", "__split", F.coalesce(F.sum("__n").over(earlier), F.lit(0).cast("long")).alias("__base"))
    own = Window.partitionBy("__length", "__split").orderBy("__row")
    ranked = rows.join(base, ["__length", "__split"], "left").withColumn("__n", F.col("__base") + F.row_number().over(own) - 1)
    placed = ranked.withColumn("__place", place("__length", "__n"))
    return placed.select(*pieces.columns, "__place.sequence_id", "__place.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id``, ``ids`` of all pieces in order, and ``doc_ids`` in that order."""
    grouped = packed.filter("sequence_id is not null").groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("p"))
    joined = F.aggregate("p.ids", F.lit(b""), lambda a, b: F.concat(a, b))
    return grouped.select("sequence_id", joined.alias("ids"), F.col("p.doc_id").alias("doc_ids"))
