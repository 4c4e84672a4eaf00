"""Text columns: first regex group, guarded numbers, code normalisation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def first_group(text: Column, pattern: str) -> Column:
    """Group 1 of the leftmost match; NULL (not '') when nothing matches.

    ``.`` also matches a newline. The second regex only sees the matched part,
    so the long text is searched once. The pattern must not match empty text.
    """
    dotall = "(?s)" + pattern
    return F.regexp_extract(F.regexp_substr(text, F.lit(dotall)), dotall, 1)


def guarded_number(text: Column) -> Column:
    """Number in the text; NULL when it holds a '*' mask or is not a number."""
    number = F.trim(text).try_cast("decimal(38,10)").cast("double")
    return F.when(~F.contains(text, F.lit("*")), number)


def in_codes(code: Column, codes, normalise: bool = False) -> Column:
    """Exact membership; ``normalise`` trims blanks on both sides first."""
    if normalise:
        return F.trim(code).isin(sorted({c.strip() for c in codes}))
    return code.isin(list(codes))


def any_prefix(code: Column, prefixes) -> Column:
    """True when the code starts with one of the prefixes, grouped by length."""
    by_length: dict[int, list[str]] = {}
    for prefix in prefixes:
        by_length.setdefault(len(prefix), []).append(prefix)
    test = F.lit(False)
    for length, group in sorted(by_length.items()):
        test = test | F.substring(code, 1, length).isin(group)
    return test
