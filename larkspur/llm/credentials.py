"""Secret scan with multipart credential linking, in DataFrame functions only.

Strong parts are reported wherever they stand: ``assign`` (a password, token or
key given a value), ``access`` (access identifiers) and ``hex`` (long
hexadecimal runs).  Weak parts mean little alone: ``user`` (a named account),
``endpoint`` (a URL or an IPv4 address) and ``opaque`` (a run of 20 or more
characters with digits and both cases, outside every strong span).  They are
reported when a complementary part stands within ``scope`` code points: an
``opaque`` secret near an access identifier or user, a ``user`` or an
``endpoint`` near a secret (assign, hex or opaque).

Spans come from one pass of native regular expressions: the pieces between the
matches and the matches themselves, measured in code points.  The link is an
interval join: parts are put into the buckets of ``scope`` code points that
their interval touches, and a semi join on (document, bucket) with the exact
distance finds whether a partner exists.  A bucket holds a bounded stretch of
text, so no key is hot, whatever the document's length.

Defined cases: a null or empty text has no spans; repeated rows have the same
spans each; null ids are documents like others; ties at one start go by the
order of the kinds; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from larkspur.llm.common import staged

#: Fixed patterns.  {20,}, {16,} and {24,} accept the same spans as matching one or more and dropping what is too short.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
USER = r"""(?i)(?:user_?name|user|login|client_?id|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._+-]{2,}"""
ENDPOINT = r"""(?:[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\x20\x09-\x0D"'<>]{3,}|[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?::[0-9]{1,5})?)"""
OPAQUE = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "user", "endpoint", "opaque")
STRONG = KINDS[:3]
_IDENTIFIERS, _SECRETS = ("access", "user"), ("assign", "hex", "opaque")
_BLOCK = 128  # matches of a text that are measured together
_SPANS = "array<struct<at:int,kind:string,start:long,end:long>>"


def _matches(text: Column, pattern: str, kind: str, valued: bool = False, mixed: bool = False) -> Column:
    """Spans of a pattern's matches.  ``valued``: group 2 has 6 or more characters; ``mixed``: digits and letters of both cases."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if valued else whole
    # zipped, so that each array is computed once and not again for every element
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("hit"), value.alias("value"))

    def step(held: Column, piece: Column) -> Column:
        first = held["at"] + F.length(piece["gap"])
        last = first + F.length(piece["hit"])
        keep = F.lit(True)
        if valued:
            keep = F.length(piece["value"]) >= 6
        if mixed:
            keep = piece["hit"].rlike("[0-9]") & piece["hit"].rlike("[A-Z]") & piece["hit"].rlike("[a-z]")
        span = F.array(F.struct(F.lit(KINDS.index(kind)).alias("at"), F.lit(kind).alias("kind"), first.alias("start"), last.alias("end")))
        grown = F.when(keep, F.concat(held["out"], span)).otherwise(held["out"])
        return F.when(piece["hit"].isNull(), held).otherwise(F.struct(last.alias("at"), grown.alias("out")))

    def block(held: Column, part: Column) -> Column:
        """Spans of a few pieces, put into the list as one element: appending copies the list, so it must stay short."""
        inside = F.struct(held["at"].alias("at"), F.array().cast(_SPANS).alias("out"))
        return F.aggregate(part, inside, step, lambda done: F.struct(done["at"].alias("at"), F.concat(held["out"], F.array(done["out"])).alias("out")))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{_SPANS}>").alias("out"))
    cut = lambda p: F.transform(F.sequence(F.lit(0), F.size(p) - 1, F.lit(_BLOCK)), lambda i: F.slice(p, i + 1, F.lit(_BLOCK)))
    # a lambda's variable is computed once, the expression it stands for would be computed for every block
    found = F.get(F.transform(F.array(pieces), lambda p: F.aggregate(cut(p), start, block, lambda held: F.flatten(held["out"]))), F.lit(0))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_SPANS))


def find_parts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row ``doc_id``, ``h`` (hash of the text), ``base`` (strong spans) and ``weak`` (candidates), each an array of (at, kind, start, end)."""
    text = F.coalesce(text_column, F.lit(""))
    strong = F.concat(_matches(text, ASSIGN, "assign", valued=True), _matches(text, ACCESS, "access"), _matches(text, HEX, "hex"))
    weak = F.concat(_matches(text, USER, "user"), _matches(text, ENDPOINT, "endpoint"), _matches(text, OPAQUE, "opaque", mixed=True))
    identity = [F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text, F.col(id_column).isNull()).alias("h")]
    rows = docs.select(*identity, strong.alias("base"), weak.alias("weak"))
    covered = lambda w: F.exists("base", lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"]))
    return rows.withColumn("weak", F.filter("weak", lambda w: (w["kind"] != "opaque") | ~covered(w)))


def linked_parts(parts: DataFrame, scope: int = 200) -> DataFrame:
    """The weak candidates of :func:`find_parts` with a complementary part within ``scope``: ``id, h, at, kind, start, end``."""
    identity = [F.coalesce("doc_id", F.lit(-1).cast("long")).alias("id"), "h"]
    spans = parts.filter(F.size("weak") > 0).select(*identity, F.explode(F.concat("base", "weak")).alias("s")).select("id", "h", "s.*").distinct()

    def near(kinds: tuple[str, ...], partners: tuple[str, ...]) -> DataFrame:
        touched = F.sequence(F.floor(F.col("start") / scope), F.floor(F.col("end") / scope))
        reached = F.sequence(F.floor((F.col("start") - scope) / scope), F.floor((F.col("end") + scope) / scope))
        index = spans.filter(F.col("kind").isin(*partners)).select(
            F.col("id").alias("i"), F.col("h").alias("j"), F.col("start").alias("from"), F.col("end").alias("to"), F.explode(touched).alias("k")
        )
        probe = spans.filter(F.col("kind").isin(*kinds)).withColumn("bucket", F.explode(reached))
        meets = reduce(Column.__and__, [F.col("id") == F.col("i"), F.col("h") == F.col("j"), F.col("bucket") == F.col("k")])
        close = (F.col("from") <= F.col("end") + scope) & (F.col("start") <= F.col("to") + scope)
        return probe.join(index, meets & close, "left_semi").drop("bucket").distinct()

    return near(("opaque",), _IDENTIFIERS).unionByName(near(("user", "endpoint"), _SECRETS))


def find_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", scope: int = 200) -> DataFrame:
    """Per row ``doc_id``, ``base`` (strong spans) and ``spans`` (with the linked weak ones), by start, then kind, then end."""
    parts = staged(find_parts(docs, id_column, text_column), "credential-parts")
    linked = linked_parts(parts, scope).groupBy("id", "h").agg(F.collect_list(F.struct("at", "kind", "start", "end")).alias("linked"))
    same = (F.coalesce(parts["doc_id"], F.lit(-1)) == linked["id"]) & (parts["h"] == linked["h"])
    ordered = lambda spans: F.transform(
        F.sort_array(F.transform(spans, lambda s: F.struct(s["start"], s["at"], s["end"], s["kind"]))), lambda s: F.struct(s["kind"], s["start"], s["end"])
    )
    joined = parts.join(linked, same, "left").select(parts["doc_id"], "base", F.coalesce("linked", F.array().cast(_SPANS)).alias("linked"))
    return joined.select("doc_id", ordered(F.col("base")).alias("base"), ordered(F.concat("base", "linked")).alias("spans"))
