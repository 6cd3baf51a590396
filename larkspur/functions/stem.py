"""Porter's suffix-stripping algorithm (M. F. Porter, 1980) as a SQL expression.

Each step is one ``CASE`` over a token, applied with ``transform`` to a whole
token array, so stemming stays in the JVM and needs no shuffle.  Tokens of one
or two characters are left alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# The algorithm's letter classes and, per step, suffix and replacement.
_C = "[^aeiou][^aeiouy]*"
_V = "[aeiouy][aeiou]*"
MEASURE_OVER_0 = f"^({_C})?{_V}{_C}"
MEASURE_IS_1 = f"^({_C})?{_V}{_C}({_V})?$"
MEASURE_OVER_1 = f"^({_C})?{_V}{_C}{_V}{_C}"
HAS_VOWEL = f"^({_C})?[aeiouy]"
SHORT_ENDING = f"^{_C}[aeiouy][^aeiouwxy]$"
DOUBLE_CONSONANT = "(bb|cc|dd|ff|gg|hh|jj|kk|mm|nn|pp|qq|rr|tt|vv|ww|xx|YY)$"
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble",
    "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate",
    "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al",
    "iviti": "ive", "biliti": "ble", "logi": "log",
}
STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ou", "ism", "ate", "iti",
    "ous", "ive", "ize",
]

_MARK = "~~"  # set when step 1b removed "ed" or "ing", cleared by the repair that follows


def _stem(suffix: str, of: str = "t") -> str:
    return f"left({of}, length({of}) - {len(suffix)})"


def _ends(suffix: str) -> str:
    return f"t like '%{suffix}'"


def porter_steps(test: str) -> list[str]:
    """CASE expressions over a token ``t``, in order; ``test`` names the engine's regex predicate."""

    def match(text: str, pattern: str) -> str:
        return f"{test}({text}, '{pattern}')"

    def replace_if(rules: dict[str, str], measure: str) -> str:
        longest_first = sorted(rules, key=lambda s: (-len(s), s))
        arms = [
            f"when {_ends(s)} then case when {match(_stem(s), measure)} then concat({_stem(s)}, '{rules[s]}') else t end"
            for s in longest_first
        ]
        return f"case when length(t) < 3 then t {' '.join(arms)} else t end"

    first_y = "case when length(t) > 2 and t like 'y%' then concat('Y', right(t, length(t) - 1)) else t end"
    plural = (
        f"case when length(t) < 3 then t when {_ends('sses')} or {_ends('ies')} then {_stem('es')}"
        f" when {_ends('ss')} then t when {_ends('s')} then {_stem('s')} else t end"
    )
    past = (
        f"case when length(t) < 3 then t"
        f" when {_ends('eed')} then case when {match(_stem('eed'), MEASURE_OVER_0)} then {_stem('d')} else t end"
        f" when {_ends('ed')} then case when {match(_stem('ed'), HAS_VOWEL)} then concat({_stem('ed')}, '{_MARK}') else t end"
        f" when {_ends('ing')} then case when {match(_stem('ing'), HAS_VOWEL)} then concat({_stem('ing')}, '{_MARK}') else t end"
        f" else t end"
    )
    bare = _stem(_MARK)
    repair = (
        f"case when not {_ends(_MARK)} then t"
        f" when {match(bare, '(at|bl|iz)$')} then concat({bare}, 'e')"
        f" when {match(bare, DOUBLE_CONSONANT)} then {_stem(_MARK + 'x')}"
        f" when {match(bare, MEASURE_IS_1)} and {match(bare, SHORT_ENDING)} then concat({bare}, 'e')"
        f" else {bare} end"
    )
    final_y = (
        f"case when length(t) > 2 and {_ends('y')} and {match(_stem('y'), HAS_VOWEL)} then concat({_stem('y')}, 'i') else t end"
    )
    ion = f"when {match('t', '(s|t)ion$')} then case when {match(_stem('ion'), MEASURE_OVER_1)} then {_stem('ion')} else t end"
    drop = _last_else(replace_if(dict.fromkeys(STEP_4, ""), MEASURE_OVER_1), ion)
    stem_e = _stem("e")
    final_e = (
        f"case when length(t) > 2 and {_ends('e')} and ({match(stem_e, MEASURE_OVER_1)} or"
        f" ({match(stem_e, MEASURE_IS_1)} and not {match(stem_e, SHORT_ENDING)})) then {stem_e} else t end"
    )
    final_l = f"case when {_ends('ll')} and {match('t', MEASURE_OVER_1)} then {_stem('l')} else t end"
    last_y = "case when t like 'Y%' then concat('y', right(t, length(t) - 1)) else t end"
    return [
        first_y, plural, past, repair, final_y, replace_if(STEP_2, MEASURE_OVER_0), replace_if(STEP_3, MEASURE_OVER_0),
        drop, final_e, final_l, last_y,
    ]


def _last_else(case: str, arm: str) -> str:
    """Add an arm before the closing ``else`` of a CASE."""
    head, _, tail = case.rpartition(" else t end")
    return f"{head} {arm} else t end{tail}"


def stem_tokens(tokens: str) -> Column:
    """Stems of an array column of lower-case tokens, order and length kept."""
    return F.expr(reduce(lambda acc, step: f"transform({acc}, t -> {step})", porter_steps("regexp_like"), tokens))


def stem_token(token: str) -> Column:
    return F.get(stem_tokens(f"array({token})"), F.lit(0))
