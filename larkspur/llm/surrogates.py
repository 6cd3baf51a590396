"""Personal data replaced by keyed surrogates, in DataFrame functions only.

Entities are e-mail addresses, telephone numbers, IPv4 addresses, payment card
numbers with a valid check digit, social security numbers in the 3-2-4 form,
and names after a title.  An entity's canonical form (lower case, digits only)
gets one surrogate in the whole corpus, so mentions that differ in layout still
refer to the same thing.  A surrogate keeps type and format: letters stay
letters of their script, digits stay digits, a card has its first digit and a
valid check digit, octets keep their length, a mail address its last label, a
telephone number its country code, and a name the gender of its title.  Each
mention is then laid out as the text had it: separators, and all capitals.

Collision checks.  Candidates come from a keyed hash of (type, canonical form,
attempt).  A candidate that another entity claims, or that is itself an entity
of the corpus, is refused, and the entity tries again; the smallest claimant
keeps it.  So distinct entities stay distinct and no surrogate points at a real
one.  Entities left after ``attempts`` rounds, as when a format is used up, get
a bracketed token with a keyed hash.

Only rows with an entity are shuffled; entities travel as slim rows, and the
texts are rebuilt from the pieces between the matches.

Defined cases: null and empty texts, and texts without entities, stay as they
are; repeated rows are all replaced alike; null ids are rows like others; an
empty table gives no rows.  Other columns stay; ``__h``, ``__id`` and
``__pairs`` are taken as names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from larkspur.llm.common import staged

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
#: Fixed: titles with the gender of who bears them.
TITLES = {
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Г-н"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Г-жа"),
    "n": ("Dr", "Prof"),
}
#: Fixed: given names by gender.
GIVEN = {
    "m": ("James", "Peter", "Martin", "Daniel", "Lucas", "Victor", "Oscar", "Simon", "Felix", "Hugo", "Adrian", "Robert", "Julian", "Thomas", "Marco", "Paul"),
    "f": ("Anna", "Maria", "Clara", "Julia", "Sofia", "Laura", "Emma", "Irene", "Helena", "Nora", "Eva", "Lucia", "Martha", "Alice", "Olivia", "Rosa"),
    "n": ("Robin", "Sasha", "Kim", "Alex", "Charlie", "Noel", "Dominique", "Jamie", "Andrea", "Luca", "Jona", "Toni", "Chris", "Mika", "Pat", "Sam"),
}
_SYLLABLES = ("bar", "bel", "den", "dor", "fal", "gan", "hol", "kel", "lan", "mar", "nor", "pel", "ras", "sel", "tor", "var")
_ALPHABETS = (
    "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "абвгдежзиклмнопрстуфхцчшэюя", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ",
    "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
)
_SCRIPTS = ("[0-9]", r"[\p{Ll}&&\p{IsLatin}]", r"[\p{Lu}&&\p{IsLatin}]", r"[\p{Ll}&&\p{IsCyrillic}]", r"[\p{Lu}&&\p{IsCyrillic}]", r"[\p{Ll}&&\p{IsGreek}]", r"[\p{Lu}&&\p{IsGreek}]")

EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}"
IP = rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9]|\.[0-9])"
CARD = r"(?<![0-9.])(?:[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4})(?![0-9])"
PHONE = r"(?<![0-9+])(?:\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}|\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{2,4}\)?){2,4}|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4})(?![0-9])"
SOCIAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_TITLE = "(?:" + "|".join(t for titles in TITLES.values() for t in titles) + r")\.?"
_WORD = r"\p{Lu}[\p{L}'’-]+"
NAME = rf"(?<![\p{{L}}\p{{N}}]){_TITLE} {_WORD}(?: {_WORD})?"
ENTITY = "|".join((EMAIL, PHONE, CARD, IP, SOCIAL, NAME))


def _kind(hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    return (
        F.when(hit.contains("@"), "email").when(hit.rlike(r"^[0-9]{1,3}\.[0-9]{1,3}\."), "ip").when(hit.rlike(r"^\p{L}"), "name")
        .when(hit.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "social").when(hit.rlike(r"^[+(]|^[0-9]{3}-"), "phone")
        .when(_luhn(digits) == 0, "card")
    )


def _luhn(digits: Column) -> Column:
    """Check sum modulo 10 of a number whose last digit is the check digit."""
    size = F.length(digits)
    terms = F.transform(F.sequence(F.lit(1), size), lambda i: _doubled(F.substring(digits, i, F.lit(1)).cast("int"), (size - i) % 2 == 1))
    return F.aggregate(terms, F.lit(0), lambda a, b: a + b) % 10


def _doubled(digit: Column, twice: Column) -> Column:
    return F.when(twice, F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)).otherwise(digit)


def _canonical(kind: Column, hit: Column) -> Column:
    bare = F.regexp_replace(hit, rf"^{_TITLE} ", "")
    gender = F.when(hit.rlike(rf"^(?:{'|'.join(TITLES['m'])})\b"), "m").when(hit.rlike(rf"^(?:{'|'.join(TITLES['f'])})\b"), "f").otherwise("n")
    return (
        F.when(kind == "email", F.lower(hit)).when(kind == "ip", hit).when(kind == "name", F.concat(gender, F.lit(" "), F.lower(bare)))
        .when(kind == "phone", F.regexp_replace(hit, "[^0-9+]", "")).otherwise(F.regexp_replace(hit, "[^0-9]", ""))
    )


def _noise(kind: Column, canonical: Column, key: str, attempt: int, size: Column) -> Column:
    """Keyed hexadecimal digits, two for each of ``size`` characters."""
    message = lambda block: F.sha2(F.concat_ws("|", F.lit(key), F.lit(attempt), block, kind, canonical), 256)
    blocks = F.sequence(F.lit(0), F.floor(size / 32).cast("int"))
    return F.array_join(F.transform(blocks, lambda block: F.sha2(F.concat(F.lit(key), message(block)), 256)), "")


def _byte(noise: Column, i: Column) -> Column:
    return F.conv(F.substring(noise, i * 2 - 1, F.lit(2)), 16, 10).cast("int")


def _substituted(text: Column, noise: Column) -> Column:
    """Every digit and letter replaced within its script and case; other characters stay."""

    def one(i: Column) -> Column:
        c, x = F.substring(text, i, F.lit(1)), _byte(noise, i)
        drawn = [(c.rlike(script), F.substring(F.lit(letters), x % len(letters) + 1, F.lit(1))) for script, letters in zip(_SCRIPTS, _ALPHABETS)]
        return reduce(lambda chain, d: chain.when(*d), drawn[1:], F.when(*drawn[0])).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), one), "")


def _drawn(values: tuple[str, ...], x: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), x % len(values) + 1)


def _surrogate(kind: Column, canonical: Column, noise: Column, attempt: int) -> Column:
    """Surrogate of a canonical form, itself in canonical form but for the case of names."""
    head, last = F.regexp_extract(canonical, r"^(.*)(\.[^.]+)$", 1), F.regexp_extract(canonical, r"^(.*)(\.[^.]+)$", 2)
    email = F.concat(_substituted(head, noise), last)
    octets = F.split(canonical, r"\.")
    span = lambda o: F.element_at(F.array(F.lit(9), F.lit(90), F.lit(156)), F.length(o))
    least = lambda o: F.element_at(F.array(F.lit(1), F.lit(10), F.lit(100)), F.length(o))
    pair = lambda i: _byte(noise, i * 2 + 1) * 256 + _byte(noise, i * 2 + 2)
    ip = F.array_join(F.transform(octets, lambda o, i: (least(o) + pair(i) % span(o)).cast("string")), ".")
    code = F.regexp_extract(canonical, r"^(\+1|\+[0-9]{2}|)", 1)
    rest = F.substring(canonical, F.length(code) + 1, F.length(canonical))
    phone = F.concat(code, (2 + _byte(noise, F.lit(30)) % 8).cast("string"), _substituted(F.substring(rest, F.lit(2), F.length(rest)), noise))
    body = F.concat(F.substring(canonical, 1, 1), _substituted(F.substring(canonical, F.lit(2), F.length(canonical) - 2), noise))
    card = F.concat(body, ((10 - _luhn(F.concat(body, F.lit("0")))) % 10).cast("string"))
    gender, words = F.substring(canonical, 1, 1), F.split(F.substring(canonical, F.lit(3), F.length(canonical)), " ")
    given = reduce(lambda chain, g: chain.when(gender == g, _drawn(GIVEN[g], _byte(noise, F.lit(1)))), ("f", "n"), F.when(gender == "m", _drawn(GIVEN["m"], _byte(noise, F.lit(1)))))
    syllables = F.transform(F.sequence(F.lit(2), F.lit(4 + attempt)), lambda i: _drawn(_SYLLABLES, _byte(noise, i)))
    latin = F.concat_ws(" ", F.when(F.size(words) > 1, given), F.initcap(F.array_join(syllables, "")))
    other = F.initcap(_substituted(F.array_join(words, " "), noise))
    name = F.when(canonical.rlike(r"^.[ ][\p{IsLatin}' ’-]+$"), latin).otherwise(other)
    return F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "phone", phone).when(kind == "card", card).when(kind == "name", name).otherwise(_substituted(canonical, noise))


def _laid_out(kind: Column, hit: Column, surrogate: Column) -> Column:
    """The surrogate in the layout of a mention: separators of numbers, title of a name, all capitals."""
    digits = F.regexp_replace(surrogate, "[^0-9]", "")
    marks = F.split(F.regexp_replace(hit, "[0-9]", "#"), "")
    place = lambda i: F.length(F.regexp_replace(F.substring(hit, F.lit(1), i + 1), "[^0-9]", ""))
    number = F.array_join(F.transform(marks, lambda m, i: F.when(m == "#", F.substring(digits, place(i), F.lit(1))).otherwise(m)), "")
    title = F.regexp_extract(hit, rf"^({_TITLE} )", 1)
    word = F.when(F.upper(hit) == hit, F.upper(surrogate)).otherwise(surrogate)
    named = F.when(F.upper(F.substring(hit, F.length(title) + 1, F.length(hit))) == F.substring(hit, F.length(title) + 1, F.length(hit)), F.upper(surrogate)).otherwise(surrogate)
    laid = F.when(kind == "email", word).when(kind == "name", F.concat(title, named)).when(kind == "ip", surrogate).otherwise(number)
    return F.when(surrogate.startswith("["), surrogate).otherwise(laid)


def entity_surrogates(entities: DataFrame, key: str, attempts: int = 12) -> DataFrame:
    """``kind, canonical, surrogate`` for distinct ``kind, canonical`` rows, after the collision checks."""
    left = staged(entities.select("kind", "canonical").distinct(), "entities")
    real = left.withColumnRenamed("canonical", "surrogate")
    done: DataFrame | None = None
    for attempt in range(attempts):
        noise = _noise(F.col("kind"), F.col("canonical"), key, attempt, F.greatest(F.length("canonical"), F.lit(32)))
        tried = left.withColumn("noise", noise).withColumn("surrogate", _surrogate(F.col("kind"), F.col("canonical"), F.col("noise"), attempt)).drop("noise")
        comparable = tried.withColumn("surrogate", F.when(F.col("kind") == "name", F.lower("surrogate")).otherwise(F.col("surrogate")))
        taken = real.withColumn("surrogate", F.when(F.col("kind") == "name", F.expr("substring(surrogate, 3)")).otherwise(F.col("surrogate")))
        if done is not None:
            taken = taken.unionByName(done.select("kind", F.when(F.col("kind") == "name", F.lower("surrogate")).otherwise(F.col("surrogate")).alias("surrogate")))
        first = comparable.groupBy("kind", "surrogate").agg(F.min("canonical").alias("canonical")).join(taken, ["kind", "surrogate"], "left_anti")
        good = staged(tried.join(first.select("kind", "canonical"), ["kind", "canonical"], "left_semi"), "surrogates")
        done = good if done is None else done.unionByName(good)
        left = staged(left.join(good.select("kind", "canonical"), ["kind", "canonical"], "left_anti"), "entities-left")
        if left.isEmpty():
            return done
    token = F.concat(F.lit("["), F.upper("kind"), F.lit("-"), F.sha2(F.concat(F.lit(key), F.sha2(F.concat_ws("|", F.lit(key), "kind", "canonical"), 256)), 256), F.lit("]"))
    return done.unionByName(left.withColumn("surrogate", token))


def _pieces(text: Column) -> Column:
    """Pieces between the entities with the entity after each (null after the last), in order."""
    return F.arrays_zip(F.split(text, ENTITY, -1).alias("gap"), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)).alias("hit"))


def replace_entities(docs: DataFrame, key: str, id_column: str = "doc_id", text_column: str = "text", count_column: str | None = "n_entities") -> DataFrame:
    """The rows with every entity in ``text_column`` replaced; ``count_column`` adds the number of mentions."""
    text = F.col(text_column)
    holds = F.coalesce(text.rlike(ENTITY), F.lit(False))
    identity = {"__id": F.coalesce(F.col(id_column).cast("long"), F.lit(-1)), "__h": F.xxhash64(text, F.col(id_column).isNull())}
    bearing = docs.filter(holds).withColumns(identity)
    hits = F.array_distinct(F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)))
    mentions = bearing.select("__id", "__h", F.explode(hits).alias("hit")).distinct().withColumn("kind", _kind(F.col("hit"))).filter("kind is not null")
    mentions = staged(mentions.withColumn("canonical", _canonical(F.col("kind"), F.col("hit"))), "mentions")
    known = entity_surrogates(mentions, key)
    laid = mentions.join(known, ["kind", "canonical"]).withColumn("new", _laid_out(F.col("kind"), F.col("hit"), F.col("surrogate")))
    pairs = laid.groupBy("__id", "__h").agg(F.map_from_entries(F.collect_list(F.struct("hit", "new"))).alias("__pairs"))
    joined = bearing.join(pairs, ["__id", "__h"], "left")
    swapped = lambda hit: F.when(F.col("__pairs").isNull(), hit).otherwise(F.coalesce(F.try_element_at(F.col("__pairs"), hit), hit))
    rebuilt = F.array_join(F.transform(_pieces(text), lambda p: F.when(p["hit"].isNull(), p["gap"]).otherwise(F.concat(p["gap"], swapped(p["hit"])))), "")
    counted = F.size(F.filter(F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)), lambda hit: F.coalesce(F.map_contains_key(F.col("__pairs"), hit), F.lit(False))))
    extra = [] if count_column is None else [count_column]
    named = [c for c in docs.columns if c not in extra]
    changed = joined.withColumns({c: counted.cast("long") for c in extra}).withColumn(text_column, rebuilt).select(*named, *extra)
    same = docs.filter(~holds).withColumns({c: F.lit(0).cast("long") for c in extra}).select(*named, *extra)
    return same.unionByName(changed)
