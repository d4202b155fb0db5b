"""DuckDB twins of ``quire.operators.text`` expressions (oracle only)."""

from __future__ import annotations

from ..functions import patterns as P
from ..functions.patterns import sql_str
from ..operators import text as T


def _chars(s: str) -> str:
    return sql_str(s)


def replace_many(text: str, mapping: dict[str, str]) -> str:
    if all(len(k) == 1 and len(v) <= 1 for k, v in mapping.items()):
        keys = sorted(mapping, key=lambda k: mapping[k] == "")
        return f"translate({text}, {_chars(''.join(keys))}, {_chars(''.join(mapping[k] for k in keys))})"
    pairs = ", ".join(f"{sql_str(k)}: {sql_str(v)}" for k, v in mapping.items())
    # a fence around every match; fence characters of the text are spelled out first
    spelled = f"replace(replace({text}, chr(2), chr(2) || chr(4)), chr(1), chr(2) || chr(3))"
    fenced = f"regexp_replace({spelled}, {sql_str(T.replace_pattern(mapping))}, chr(1) || '\\1' || chr(1), 'g')"
    swapped = (f"array_to_string(list_transform(string_split({fenced}, chr(1)), "
               f"lambda x, i: CASE WHEN i % 2 = 0 THEN MAP {{{pairs}}}[x] ELSE x END), '')")
    return f"replace(replace({swapped}, chr(2) || chr(3), chr(1)), chr(2) || chr(4), chr(2))"


def ascii_fold(text: str) -> str:
    one = f"translate({text}, {_chars(T.FOLD_FROM)}, {_chars(T.FOLD_TO)})"
    return f"regexp_replace({replace_many(one, T.FOLD_MULTI)}, {sql_str(P.NON_ASCII)}, '', 'g')"


def normalize_text(text: str) -> str:
    low = f"replace(lower({text}), {sql_str(T.BREAK_TAG)}, ' ')"
    return f"regexp_replace({low}, {sql_str(T.PAD_PATTERN)}, ' \\1 ', 'g')"


def remove_punct(tokens: str) -> str:
    kept = f"list_filter({tokens}, lambda t: strpos({sql_str(T.ASCII_PUNCT)}, t) = 0)"
    cleaned = f"list_transform({kept}, lambda t: regexp_replace(t, {sql_str(P.PUNCT_OR_SYMBOL)}, ' ', 'g'))"
    pieces = f"flatten(list_transform({cleaned}, lambda t: regexp_split_to_array(trim(t), ' +')))"
    return f"list_filter({pieces}, lambda t: t <> '')"


def hyphen_core(tokens: str) -> str:
    return (f"list_transform({tokens}, lambda t: CASE WHEN contains(t, '-') "
            f"THEN regexp_extract(t, {sql_str(T.HYPHEN_PATTERN)}, 1) ELSE t END)")


def ngrams(tokens: str, n: int) -> str:
    return (f"list_transform(range(0, len({tokens}) - {n} + 1), "
            f"lambda i: array_to_string({tokens}[i + 1:i + {n}], ' '))")
