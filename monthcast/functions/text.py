"""Text expressions: cleaning, keyword flags, lengths, boolean term filters."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: str | Column) -> Column:
    """Lower-case, drop ``http...`` tokens, keep ``[a-z0-9 whitespace -]``,
    collapse whitespace and trim. Null input gives ``''``.

    Two plain replaces: URLs first, then every run of anything but ``a-z``,
    ``0-9`` and ``-`` (whitespace included) becomes one space. Both repeat one
    character class, which Java's engine loops over without recursion, so runs
    of any length are safe. ``(?U)`` makes ``\\S`` Unicode-aware.
    """
    text = F.lower(F.coalesce(_col(c), F.lit("")))
    text = F.regexp_replace(text, r"(?U)http\S+", " ")
    text = F.regexp_replace(text, r"[^a-z0-9\-]+", " ")
    return F.trim(text)


def keyword_column_name(keyword: str) -> str:
    return "kw_" + keyword.replace(" ", "_")


def contains_keyword(c: str | Column, keyword: str) -> Column:
    """1 when ``keyword`` occurs as a case-insensitive substring, else 0.

    Substring semantics on purpose: ``ram`` matches ``program``.
    """
    return F.coalesce(F.lower(_col(c)).contains(keyword.lower()).cast("int"), F.lit(0))


def keyword_flags(c: str | Column, keywords: Sequence[str]) -> dict[str, Column]:
    """One ``kw_*`` flag column per keyword, for ``withColumns``."""
    return {keyword_column_name(k): contains_keyword(c, k) for k in keywords}


def text_length(c: str | Column) -> Column:
    """Length in code points (Python ``len``), as INT."""
    return F.length(_col(c)).cast("int")


def boolean_text_filter(c: str | Column, any_of: Iterable[str], and_any_of: Iterable[str] = (),
                        whole_word: bool = True) -> Column:
    """``(t1 OR t2 ...) AND (u1 OR u2 ...)`` over a text column, case-insensitive.

    With ``whole_word`` each term must sit between word boundaries (phrases
    allowed) and the whole test is ONE regex (a lookahead per group), so the
    text expression is referenced once even after Catalyst substitutes it
    into a pushed-down filter. Otherwise plain substring tests.
    """
    a = [t.lower() for t in any_of]
    b = [t.lower() for t in and_any_of]
    if not a:
        raise ValueError("boolean_text_filter needs at least one term")
    lowered = F.lower(_col(c))
    if whole_word:
        def group(ts):
            return r"(?=.*?\b(?:" + "|".join(re.escape(t) for t in ts) + r")\b)"
        pattern = "(?s)^" + group(a) + (group(b) if b else "")
        return F.coalesce(lowered.rlike(pattern), F.lit(False))

    def any_sub(ts):
        out = None
        for t in ts:
            out = lowered.contains(t) if out is None else (out | lowered.contains(t))
        return out
    cond = any_sub(a) if not b else (any_sub(a) & any_sub(b))
    return F.coalesce(cond, F.lit(False))
