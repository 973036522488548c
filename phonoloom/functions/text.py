"""Word counts, phrase scores and fallbacks, as column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

#: White space as a text split on it is understood: every Unicode space and line end.
SPACES = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
OTHER_SPACES = r"[\x{09}-\x{0d}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NOT_WORD = r"([^\p{L}\p{N}_])"


def word_count(text: Column) -> Column:
    """Words between white space; 0 for null and blank texts."""
    return F.coalesce(F.size(F.filter(F.split(text, SPACES + "+"), lambda w: w != "")), F.lit(0))


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor empty, else the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


@F.pandas_udf(T.StringType())
def composed(text: pd.Series) -> pd.Series:
    """A text in NFC; Spark has no expression for it, so texts go through Arrow batches once, at the landing."""
    return text.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))


def padded(text: Column) -> Column:
    """A text in lower case, prepared for :func:`phrase_score`.

    A phrase counts where white space or the start stands before it, and white space, one of ``.,!?;:"`` or the
    end behind. Each space is doubled, so that neighbours don't share one; other white space never stands inside a
    phrase.
    """
    low = F.lower(text)
    low = F.regexp_replace(F.replace(low, F.lit(" "), F.lit("  ")), f"({OTHER_SPACES})", " \n ")
    return F.concat(F.lit(" "), F.regexp_replace(low, r'([.,!?;:"])', r" $1"), F.lit(" "))


def phrase_score(prepared: Column, lexicon: list[tuple[str, float]], cap: int = 2) -> Column:
    """The sum of weight x occurrences, at most ``cap`` for a phrase; ``prepared`` comes from :func:`padded`.

    Literal replacing and counting lengths stays in the JVM and needs no regular expression a phrase.
    """
    phrases = F.array(*[F.struct(F.lit(f" {p.replace(' ', '  ')} ").alias("k"), F.lit(float(w)).alias("w")) for p, w in lexicon])
    times = lambda p: F.least(F.lit(cap), F.floor((F.length(prepared) - F.length(F.replace(prepared, p["k"], F.lit("")))) / F.length(p["k"])))
    return F.when(prepared.isNull(), F.lit(0.0)).otherwise(F.aggregate(phrases, F.lit(0.0), lambda s, p: s + p["w"] * times(p)))


def worded(text: Column) -> Column:
    """A text in lower case with every non-word character set off, prepared for :func:`phrases_present`."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(text), NOT_WORD, " $1 "), F.lit(" "))


def phrases_present(prepared: Column, phrases: list[str]) -> Column:
    """How many of the phrases occur between word boundaries; ``prepared`` comes from :func:`worded`."""
    marks = F.array(*[F.lit(f" {p.replace(' ', '   ')} ") for p in phrases])
    return F.coalesce(F.size(F.filter(marks, lambda p: F.contains(prepared, p))), F.lit(0))


def substrings_present(text: Column, phrases: list[str]) -> Column:
    """How many of the phrases occur anywhere in the text, which is in lower case."""
    return F.coalesce(F.size(F.filter(F.array(*[F.lit(p) for p in phrases]), lambda p: F.contains(text, p))), F.lit(0))
