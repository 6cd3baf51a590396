"""SentencePiece encoding and decoding through a table of distinct chunks.

When no piece of the model has a white-space marker after another character,
no merge can cross the start of a marked word, so the segmentation of a text
is that of its marked words (a run of markers and what follows) one after the
other.  Each task keeps a table of the distinct chunks it has met: a chunk is
segmented once by the library and its ids are joined back by position.  The
same holds at a line break if no piece of several characters contains one.
Models without these properties, and models that normalise text, are applied
to whole texts instead; the ids are the library's either way.

A table of the distinct chunks of the whole corpus, joined back by a shuffle,
would move a row per word: about nine times the input.

Defined cases: null and empty texts give the begin and end ids alone and decode
to the empty text; null ids decode to the empty text; rows keep all their other columns.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from larkspur.llm.common import Shared, vocabulary_bytes
from larkspur.llm.words import WordTable

_MARK = "▁"
_MARKED = re.compile(f"{_MARK}+[^{_MARK}]*")
_MARKED_LINES = re.compile(f"{_MARK}+[^{_MARK}\n]*|\n[^{_MARK}\n]*")
_USER_DEFINED = 4  # piece type in the model file


def _segmented(library: sentencepiece.SentencePieceProcessor, marker: int, chunk: str) -> list[int]:
    if chunk[0] == "\n":  # the library puts a marker in front, which is a piece of its own here
        return library.encode(chunk)[1:]
    if chunk == _MARK:  # before a line break or at the end: the library adds no marker to an empty text
        return [marker]
    return library.encode(chunk[1:].replace(_MARK, " "))  # the library adds the first marker itself


class ChunkEncoder:
    """Whole texts to ids and back; ``chunked`` tells whether the chunk table applies."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2 as model_file

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        proto = model_file.ModelProto.FromString(model)
        rule, pieces = proto.normalizer_spec, [p.piece for p in proto.pieces]
        self.chunked = (
            not rule.precompiled_charsmap and rule.add_dummy_prefix and rule.escape_whitespaces and not rule.remove_extra_whitespaces
            and not proto.trainer_spec.treat_whitespace_as_suffix
            and not any(p.type == _USER_DEFINED for p in proto.pieces)
            and not any(re.search(f"[^{_MARK}]{_MARK}", p) for p in pieces)
        )
        self.cut = (_MARKED if any("\n" in p and len(p) > 1 for p in pieces) else _MARKED_LINES).findall
        library, marker = self.library, self.library.piece_to_id(_MARK)
        # the table refers to the library and not to this object, so that both go as soon as nothing uses them
        self.table = WordTable(lambda chunk: _segmented(library, marker, chunk), "<u4")

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.chunked:
            return np.asarray(self.library.encode(text), "<u4").tobytes()
        return b"".join(map(self.table.__getitem__, self.cut(_MARK + text.replace(" ", _MARK))))

    def decode(self, ids: bytes | None) -> str:
        return self.library.decode(np.frombuffer(ids, "<u4").tolist()) if ids else ""


def with_piece_ids(df: DataFrame, model_file: str, text_column: str = "text", ids_column: str = "ids", ends: bool = True) -> DataFrame:
    """Add the ids of each whole text as little-endian 32-bit numbers, with begin and end ids if ``ends``."""
    model = df.sparkSession.sparkContext.broadcast(Shared(vocabulary_bytes(model_file), ChunkEncoder))

    @F.pandas_udf("binary")
    def encode(texts: pd.Series) -> pd.Series:
        encoder = model.value.made()
        first, last = (np.array([x], "<u4").tobytes() if ends else b"" for x in (encoder.library.bos_id(), encoder.library.eos_id()))
        return pd.Series([first + encoder.encode(t) + last for t in texts])

    return df.withColumn(ids_column, encode(F.col(text_column)))


def with_decoded(df: DataFrame, model_file: str, ids_column: str = "ids", text_column: str = "decoded") -> DataFrame:
    """Add the text that the library decodes from each row's ids."""
    model = df.sparkSession.sparkContext.broadcast(Shared(vocabulary_bytes(model_file), ChunkEncoder))

    @F.pandas_udf("string")
    def decode(ids: pd.Series) -> pd.Series:
        encoder = model.value.made()
        return pd.Series([encoder.decode(x) for x in ids])

    return df.withColumn(text_column, decode(F.col(ids_column)))
