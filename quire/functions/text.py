"""Column expressions for text: JVM built-ins only, so they stay inside
whole-stage code generation and never leave the executor's JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def word_tokens(text) -> Column:
    """Words, numbers and single punctuation marks, in text order."""
    return F.regexp_extract_all(c(text), F.lit(P.WORD_TOKEN), 0)


def alpha_lower(tokens) -> Column:
    """Keep purely alphabetic tokens, lower-cased."""
    alpha = F.filter(c(tokens), lambda t: t.rlike("^" + P.ALPHA + "$"))
    return F.transform(alpha, lambda t: F.lower(t))


def ws_tokens(text) -> Column:
    """White-space tokens; empty text gives an empty array."""
    return F.filter(F.split(F.trim(c(text)), r"\s+"), lambda t: t != "")


def pattern_tokens(text) -> Column:
    return F.regexp_extract_all(F.lower(c(text)), F.lit(P.PATTERN_TOKEN), 0)


def squash_space(text) -> Column:
    return F.trim(F.regexp_replace(c(text), r"\s+", " "))


def sentences(text) -> Column:
    """Split after ``.``, ``!`` or ``?`` followed by white space."""
    return F.filter(F.transform(F.split(c(text), P.SENTENCE_GAP), lambda s: F.trim(s)), lambda s: s != "")


NUDGE = 1e-9


def stable_round(x, digits: int) -> Column:
    """Round after adding 1e-9.  Ratios of small integers often sit exactly on
    a decimal half (0.5075 = 203/400), where rounding the binary value and
    rounding its shortest decimal form disagree; the nudge moves such values
    off the tie so every engine rounds them up."""
    return F.round(c(x) + F.lit(NUDGE), digits)


def safe_ratio(num, den) -> Column:
    """num / den with null for a zero denominator (ANSI-safe)."""
    return F.try_divide(c(num).cast("double"), c(den).cast("double"))


def explode_rows(arr, *names: str):
    """``explode_outer`` / ``posexplode_outer``; callers drop the null row.

    A plain ``explode`` makes Catalyst infer ``size(arr) > 0`` on the
    generator input and push it below earlier projections with the array
    expression inlined, so a token array built by a regex over the text was
    re-evaluated inside every lambda of the filter.  The outer variants infer
    nothing."""
    if len(names) == 2:
        return F.posexplode_outer(c(arr)).alias(*names)
    return F.explode_outer(c(arr)).alias(*names)
