"""Ids that arrive as text, numbers that arrive as text, and re-delivered rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A finite decimal number: digits with an optional sign, fraction and exponent.
DECIMAL = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def is_blank(text: Column) -> Column:
    """Null, empty or white space only."""
    return F.coalesce(~text.rlike(r"\S"), F.lit(True))


def read_id(text: Column) -> Column:
    """The whole number that an id text reads as: digits 0-9, surrounding blanks dropped, leading zeros ignored.

    Null for anything else, and for a number beyond 64 bits.
    """
    return F.when(text.rlike(r"^\s*[0-9]+\s*$"), text.try_cast("bigint"))


def read_decimal(text: Column) -> Column:
    """The finite number a text stands for, else null (no nan, inf, units, decimal commas or type suffixes)."""
    value = F.when(text.rlike(DECIMAL), F.trim(F.regexp_replace(text, r"\s", "")).try_cast("double"))
    return F.when(F.abs(value) < float("inf"), value)


def read_word(text: Column) -> Column:
    """A type or role for comparison: without case and surrounding blanks; null if blank."""
    word = F.lower(F.regexp_replace(text, r"^\s+|\s+$", ""))
    return F.when(word != "", word)


def current_rows(df: DataFrame, keys: Sequence[str], order: str = "loaded_at") -> DataFrame:
    """One row per key: the one with the greatest ``order``; a null order comes before every other.

    Ties on ``order`` that differ elsewhere take the greatest of the remaining columns, so the result is the same on
    every run. The maximum is taken in part before the shuffle, so a key delivered very often does not gather its rows
    in one task. Keys may be null and are then one key.
    """
    rest = [c for c in df.columns if c not in keys and c != order]
    best = F.max(F.struct(F.col(order), *[F.col(c) for c in rest])).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in [order, *rest]])
