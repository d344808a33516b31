"""Conditional column expressions: bands, code lists, clipping, flags and scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _chain(pairs, default) -> Column:
    out = None
    for test, value in pairs:
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(default)


def band_below(value: Column, limits: Sequence[tuple[float, str]], rest: str) -> Column:
    """Label of the first limit that ``value`` is below; NULL falls to ``rest``."""
    return _chain([(value < limit, F.lit(label)) for limit, label in limits], F.lit(rest))


def band_from(value: Column, limits: Sequence[tuple[float, str]], rest: str) -> Column:
    """Label of the first limit that ``value`` reaches; NULL falls to ``rest``."""
    return _chain([(value >= limit, F.lit(label)) for limit, label in limits], F.lit(rest))


def band_above(value: Column, limits: Sequence[tuple[float, str]], rest: str) -> Column:
    """Label of the first limit that ``value`` exceeds; NULL falls to ``rest``."""
    return _chain([(value > limit, F.lit(label)) for limit, label in limits], F.lit(rest))


def standardize(value: Column, spellings: Mapping[str, Sequence[str]], unknown: str = "UNKNOWN") -> Column:
    """Code whose list of spellings holds the trimmed, upper-cased value."""
    clean = F.upper(F.trim(value))
    return _chain([(clean.isin(*words), F.lit(code)) for code, words in spellings.items()], F.lit(unknown))


def contains_any(value: Column, words: Sequence[str]) -> Column:
    """Case-blind test for any of the (upper-case) words; NULL gives false."""
    test = F.upper(value).contains(words[0])
    for w in words[1:]:
        test = test | F.upper(value).contains(w)
    return F.coalesce(test, F.lit(False))


def keyword_category(value: Column, rules: Sequence[tuple[str, Sequence[str]]], rest: str) -> Column:
    """Category of the first rule with a word inside ``value``; rule order matters."""
    return _chain([(contains_any(value, words), F.lit(cat)) for cat, words in rules], F.lit(rest))


def blank_to(value: Column, default) -> Column:
    return F.coalesce(F.nullif(F.trim(value), F.lit("")), default if isinstance(default, Column) else F.lit(default))


def clip(value: Column, low: float, high: float) -> Column:
    """Bounded value; NULL becomes ``low``'s side only if the input was not NULL."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def null_outside(value: Column, low: float, high: float) -> Column:
    return F.when(value.between(low, high), value)


def as_negative(value: Column) -> Column:
    return F.when(value > 0, -value).otherwise(value)


def flags(rules: Mapping[str, Column]) -> Column:
    """Names of the rules that hold, in rule order."""
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules.items()]))


def penalty_score(penalties: Sequence[Column], low: float = 0, high: float = 100) -> Column:
    score = F.lit(high)
    for p in penalties:
        score = score - p
    return F.greatest(F.lit(low), F.least(F.lit(high), score))


def holds(test: Column) -> Column:
    """TRUE only if the test is TRUE; NULL counts as a failure."""
    return F.coalesce(test, F.lit(False))


def safe_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / max(whole, 1)."""
    return F.round(part * 100.0 / F.greatest(whole, F.lit(1)), digits)
