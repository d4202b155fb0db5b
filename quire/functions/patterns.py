"""Regular expressions shared by the Spark operators and the DuckDB oracle.

Every pattern here is written in the common subset of Java regex (Spark) and
RE2 (DuckDB): Unicode classes ``\\p{L}``/``\\p{N}``, no look-around, and
explicit capture groups, so the two engines split text identically.
"""

from __future__ import annotations

# Word tokens: letter runs joined by an apostrophe or dash, digit runs, or any
# single other non-space character (punctuation kept as its own token).
WORD_TOKEN = r"\p{L}+(?:['-]\p{L}+)*|\p{N}+|[^\s\p{L}\p{N}]"
# Pure alphabetic token.
ALPHA = r"\p{L}+"
# Token pattern that keeps hyphenated words and digits.
PATTERN_TOKEN = r"[\p{L}\p{N}_-]+"
# Sentence boundary: terminal punctuation followed by white space.
SENTENCE_END = r"([.!?])\s+"
# The same boundary as a cut that consumes the white space only (Spark side).
SENTENCE_GAP = r"(?<=[.!?])\s+"
# Punctuation or symbol character.
PUNCT_OR_SYMBOL = r"[\p{P}\p{S}]"
# The first run of letters, digits and dashes (hyphen rule).
HYPHEN_CORE = r"([0-9A-Za-z-]+)"
# Any character outside ASCII.
NON_ASCII = r"[^\x00-\x7F]"
# Anchor element with its href (quotes included, if any) and inner text.
ANCHOR = r"""(?i)<a(?:\s[^>]*?)?\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)[^>]*>((?s:.*?))</a\s*>"""
# Quotes around an attribute value.
QUOTES = r"""^["']|["']$"""
# First number in a string.
FIRST_NUMBER = r"([0-9]+)"
# Scheme and host of an absolute URL.
URL_ORIGIN = r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)"


def sql_str(s: str) -> str:
    """Quote a Python string as a SQL string literal (both engines)."""
    return "'" + s.replace("'", "''") + "'"
