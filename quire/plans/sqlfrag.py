"""DuckDB twins of the column expressions in ``quire.functions.text``, used only
to write the oracle SQL that checks each registered query."""

from __future__ import annotations

from ..functions import patterns as P
from ..functions.patterns import sql_str


def word_tokens(text: str) -> str:
    return f"regexp_extract_all({text}, {sql_str(P.WORD_TOKEN)}, 0)"


def alpha_lower(tokens: str) -> str:
    return (f"list_transform(list_filter({tokens}, lambda t: regexp_full_match(t, {sql_str(P.ALPHA)})), "
            f"lambda t: lower(t))")


def ws_tokens(text: str) -> str:
    return f"list_filter(regexp_split_to_array(trim({text}), '\\s+'), lambda t: t <> '')"


def pattern_tokens(text: str) -> str:
    return f"regexp_extract_all(lower({text}), {sql_str(P.PATTERN_TOKEN)}, 0)"


def squash_space(text: str) -> str:
    return f"trim(regexp_replace({text}, '\\s+', ' ', 'g'))"


def sentences(text: str) -> str:
    # the fence is a character no text may hold (a noncharacter)
    marked = f"regexp_replace({text}, {sql_str(P.SENTENCE_END)}, '\\1' || chr(1114111), 'g')"
    return f"list_filter(list_transform(string_split({marked}, chr(1114111)), lambda s: trim(s)), lambda s: s <> '')"


def ratio(num: str, den: str) -> str:
    return f"(({num})::DOUBLE / nullif(({den})::DOUBLE, 0))"


def stable_round(x: str, digits: int) -> str:
    return f"round(({x}) + 1e-9, {digits})"
