"""Populations and row filters."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The open-claim population of the automobile job.
LOSS_TYPE = "10001"
LINES_OF_BUSINESS = ("10008", "10014", "10016")
LITIGATED = ("1", "2")
LITIGATED_LABELS = ("In litigation", "Litigation complete")
UNNAMED_PARTIES = ("SUSPENSE POLICY",)
OPEN_END = date(9999, 12, 31)


def not_in_or_null(column: Column, values: Sequence) -> Column:
    """Negative list that keeps rows without a value."""
    return column.isNull() | ~column.isin(*values)


def open_claims(claims: DataFrame) -> DataFrame:
    """Claims still open, of the loss type and lines of business, not in litigation."""
    return claims.filter(
        F.col("CloseDate").isNull()
        & (F.col("LossType") == LOSS_TYPE)
        & F.col("LOBCode").isin(*LINES_OF_BUSINESS)
        & not_in_or_null(F.col("LitigationStatus"), LITIGATED)
    )


def current_records(df: DataFrame, flag: str | None = None, end_column: str | None = None,
                    valid_record: str | None = None, valid_flag: str | None = None, highest_flag: int = 2) -> DataFrame:
    """Current version of slowly changing rows, by flag or by open end date and validity marks."""
    if flag is not None:
        df = df.filter(F.col(flag) == 1)
    if end_column is not None:
        df = df.filter(F.col(end_column) == F.lit(OPEN_END))
    if valid_record is not None:
        df = df.filter(F.col(valid_record) == 1)
    if valid_flag is not None:
        df = df.filter(F.col(valid_flag) <= highest_flag)
    return df


def named(column: Column) -> Column:
    """True for a usable party name, compared without case; never null, so the complement is exact."""
    return column.isNotNull() & ~F.coalesce(F.upper(column).isin(*UNNAMED_PARTIES), F.lit(False))


def split_named(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a usable party name, the others)."""
    return df.filter(named(F.col(name))), df.filter(~named(F.col(name)))


def from_year(column: Column, year: int) -> Column:
    """Year bound as a date range, which a scan can use."""
    return column >= F.lit(date(year, 1, 1))


def in_pairs(df: DataFrame, pairs: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose column pair is listed, e.g. (coverage, exposure type) pairs of a line of business."""
    return df.join(pairs, list(on), "left_semi")
