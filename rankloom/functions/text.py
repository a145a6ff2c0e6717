"""Text cleaning and tokens as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space in text input.
WHITESPACE = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def nonempty(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: t != "")


def strip_marks(text: Column) -> Column:
    """Lower case with everything but ASCII letters, digits and space deleted."""
    return F.regexp_replace(F.lower(text), f"[^A-Za-z0-9{WHITESPACE}]+", "")


def review_tokens(text: Column, stopwords: Column | None = None) -> Column:
    """Review tokens without digits and, if given, without an array of stop words."""
    tokens = nonempty(F.split(strip_marks(text), f"[{WHITESPACE}]+"))
    tokens = F.filter(tokens, lambda t: ~t.rlike("[0-9]"))
    if stopwords is not None:
        tokens = F.filter(tokens, lambda t: ~F.array_contains(stopwords, t))
    return tokens


def clean_line(text: Column) -> Column:
    """Drop bracketed parts, lower the case, turn other characters into one blank."""
    plain = F.regexp_replace(text, r"\([^)]*\)", "")
    return F.regexp_replace(F.lower(plain), "[^a-z0-9]+", " ")


def word_tokens(text: Column) -> Column:
    """Words of the cleaned line."""
    return nonempty(F.split(clean_line(text), " "))


def sentences(text: Column) -> Column:
    """Sentences cut at end marks, trimmed and not empty."""
    return nonempty(F.transform(F.split(text, "[.!?]+"), lambda s: F.trim(s)))


def lower_split(text: Column) -> Column:
    return nonempty(F.split(F.lower(text), f"[{WHITESPACE}]+"))


def token_windows(tokens: Column, n: int) -> Column:
    """All runs of ``n`` neighbouring tokens, joined by a blank."""
    runs = F.transform(
        F.sequence(F.lit(1), F.size(tokens) - (n - 1)),
        lambda i: F.array_join(F.slice(tokens, i, n), " "),
    )
    return F.when(F.size(tokens) >= n, runs).otherwise(F.array().cast("array<string>"))


def pad(codes: Column, length: int, filler: int = 1) -> Column:
    """Cut or fill an array of codes to exactly ``length``."""
    return F.slice(F.concat(codes, F.array_repeat(F.lit(filler), length)), 1, length)


def pair_key(field: Column) -> Column:
    return F.split_part(field, F.lit(":"), F.lit(1))


def pair_value(field: Column) -> Column:
    return F.split_part(field, F.lit(":"), F.lit(2))
