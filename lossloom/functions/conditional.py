"""Indicators, recodes and precedence rules."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def indicator(condition: Column) -> Column:
    """1 when the condition holds, 0 when it is false or unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def equal_indicator(left: Column, right: Column) -> Column:
    """1 when both sides are known and equal."""
    return indicator(left == right)


def value_indicators(rules: Iterable[tuple[str, object, str]]) -> dict[str, Column]:
    """{new column: 0/1} for each (source column, value, new column) rule."""
    return {new: indicator(F.col(f"`{old}`") == F.lit(value)) for old, value, new in rules}


def only_flag(this: Column, others: Sequence[Column]) -> Column:
    """1 when `this` is positive and every other count is zero."""
    return indicator(reduce(lambda acc, c: acc & (c == 0), others, this > 0))


def recode(column: Column, mapping: Mapping, keep_unmapped: bool = False) -> Column:
    """Replace values by a small literal mapping; unmapped values become null or stay."""
    pairs = [F.lit(item) for pair in mapping.items() for item in pair]
    mapped = F.try_element_at(F.create_map(*pairs), column)
    return F.coalesce(mapped, column) if keep_unmapped else mapped


def party_keyed(party: Column, wanted: str, value: Column, condition: Column | None = None) -> Column:
    """The value when the row belongs to the wanted party (and the condition holds), else 0."""
    test = party == wanted if condition is None else (party == wanted) & condition
    return F.when(test, value).otherwise(F.lit(0))


def exposure_name(own: Column, claimant: Column, insured: Column, party: Column,
                  claimant_party: str | None = None) -> Column:
    """Name of the exposed party: own name, else the claimant's, else the insured's on the insured side.

    With `claimant_party` the claimant's name only stands in on that side.
    """
    use_claimant = own.isNull() & claimant.isNotNull()
    if claimant_party is not None:
        use_claimant = use_claimant & (party == claimant_party)
    use_insured = own.isNull() & claimant.isNull() & (party == "10001")
    return F.when(use_claimant, claimant).when(use_insured, insured).otherwise(own)


def insured_name(own: Column, claimant: Column, insured: Column, party: Column) -> Column:
    """Insured's name; on the insured side a missing one falls back to own, then claimant."""
    return F.coalesce(insured, F.when(party == "10001", F.coalesce(own, claimant)))


def claimant_name(own: Column, claimant: Column, party: Column) -> Column:
    """Claimant's name; on the third-party side the exposure's own name goes first."""
    return F.coalesce(F.when(party == "10002", own), claimant)


def referral_override(referred: Column, status: Column, change: Column) -> Column:
    """Final referral: dropped when already investigated, or rejected before and unchanged since."""
    dropped = (status == "SIU Investigation") | ((status == "Rejected Referral") & (change == 1))
    return F.when((referred == 1) & ~F.coalesce(dropped, F.lit(False)), 1).otherwise(0)


def longer_text(first: Column, fallback: Column, minimum: int = 7) -> Column:
    """`first` unless it is missing or shorter than `minimum` characters."""
    return F.when(first.isNull() | (F.length(first) < minimum), fallback).otherwise(first)
