"""Conversations as marked text with a loss mask, and back.

The layout is a template (``templates.py``); the default one writes
``<|im_start|>role``, a line break, the text, ``<|im_end|>`` and a line break
per turn, and marks assistant texts as generated.  Control strings inside a
text cannot end a turn: every ``<|`` of a text or role becomes ``<||``, and a
line break in a role becomes ``<|n>``.  Both are undone by reading, since after
escaping ``<|`` is always followed by ``|`` (or ``n>`` in roles).

Defined cases: turns are ordered by (turn, role, text), nulls first, so ties
and repeated rows have a fixed order and all stay; null roles and texts are
empty; rows with a null id form one conversation with a null id; an empty table
gives no rows; other columns are ignored.  A conversation is one row, so its
turns must fit into a task.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from larkspur.llm.templates import compile_template

DEFAULT_TEMPLATE = (
    "{% for m in messages %}{{ '<|im_start|>' + (m.role | role) + '\\n' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | text }}{% endgeneration %}"
    "{% else %}{{ m.text | text }}{% endif %}{{ '<|im_end|>' + '\\n' }}{% endfor %}"
)
_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)


def escape_text(text: str) -> str:
    return text.replace("<|", "<||")


def unescape_text(text: str) -> str:
    return text.replace("<||", "<|")


def escape_role(role: str) -> str:
    return escape_text(role).replace("\n", "<|n>")


def unescape_role(role: str) -> str:
    return unescape_text(role.replace("<|n>", "\n"))


FILTERS = {"text": escape_text, "role": escape_role}


@lru_cache(maxsize=8)
def _renderer(template: str):
    return compile_template(template, FILTERS)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The ``(role, text)`` pairs that the default layout holds."""
    return [(unescape_role(role), unescape_text(text)) for role, text in _TURN.findall(formatted)]


def format_conversations(rows: DataFrame, template: str = DEFAULT_TEMPLATE, id_column: str = "conv_id") -> DataFrame:
    """One row per conversation: its id, ``formatted`` and ``loss_spans`` (start, end; code points, end exclusive)."""
    _renderer(template)  # a template that cannot be read fails here, not in a task

    @F.pandas_udf("formatted string, loss_spans array<struct<start:long,end:long>>")
    def render(messages: pd.Series) -> pd.DataFrame:
        run = _renderer(template)
        done = [run(messages=[{"role": m["role"], "text": m["text"]} for m in turns]) for turns in messages]
        return pd.DataFrame({"formatted": [text for text, _ in done], "loss_spans": [[{"start": a, "end": b} for a, b in spans] for _, spans in done]})

    empty = F.lit("")
    turn = F.struct(F.col("turn"), F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    conversations = rows.groupBy(F.col(id_column)).agg(F.sort_array(F.collect_list(turn)).alias("messages"))
    return conversations.withColumn("out", render("messages")).select(id_column, "out.formatted", "out.loss_spans")


def read_conversations(formatted: DataFrame) -> DataFrame:
    """Add ``turns`` (role, text) and ``loss_text`` (all text under the mask, unescaped), read from the formatted text."""

    @F.pandas_udf("turns array<struct<role:string,text:string>>, loss_text string")
    def read(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        turns = [[{"role": r, "text": t} for r, t in read_turns(text)] for text in texts]
        loss = ["".join(unescape_text(text[s["start"] : s["end"]]) for s in marked) for text, marked in zip(texts, spans)]
        return pd.DataFrame({"turns": turns, "loss_text": loss})

    return formatted.withColumn("__read", read("formatted", "loss_spans")).select(*formatted.columns, "__read.turns", "__read.loss_text")
