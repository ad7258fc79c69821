"""Month ranges relative to an explicit ``as_of`` date, and the calendar frame of a range."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F


def month_shift(day: date, months: int) -> date:
    """First day of the month ``months`` after the month of ``day``."""
    index = day.year * 12 + day.month - 1 + months
    return date(index // 12, index % 12 + 1, 1)


@dataclass(frozen=True)
class ClaimsWindow:
    start: date
    end: date

    @property
    def max_lags(self) -> int:
        return (self.end.year - self.start.year) * 12 + self.end.month - self.start.month + 1

    @property
    def preauth_before(self) -> date:
        return month_shift(self.end, 1)


def claims_windows(as_of: date, custom: list[tuple[date, date]] | None = None) -> list[ClaimsWindow]:
    """The custom windows, which must be equally long, or the twelve months before ``as_of``."""
    windows = [ClaimsWindow(*w) for w in custom] if custom else [ClaimsWindow(month_shift(as_of, -12), month_shift(as_of, -1))]
    if len({w.max_lags for w in windows}) > 1:
        raise ValueError("all claims windows need the same number of months")
    return windows


@dataclass(frozen=True)
class InflationWindow:
    training_begin: date
    training_end: date
    forecast_years: int

    @property
    def inference_begin(self) -> date:
        return month_shift(self.training_end, 1)

    @property
    def inference_end(self) -> date:
        return month_shift(self.inference_begin, 12 * self.forecast_years - 1)


# Default begin of the training history and forecast horizon.
INFLATION_TRAINING_BEGIN = date(2016, 1, 1)
INFLATION_FORECAST_YEARS = 3


def inflation_window(
    as_of: date,
    training_begin: date = INFLATION_TRAINING_BEGIN,
    training_end: date | None = None,
    forecast_years: int = INFLATION_FORECAST_YEARS,
) -> InflationWindow:
    return InflationWindow(training_begin, training_end or month_shift(as_of, -1), forecast_years)


def month_calendar(spark: SparkSession, begin: date, end: date) -> DataFrame:
    """One row per month of the closed range."""
    months = F.sequence(F.lit(begin), F.lit(end), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias("month"))


def month_span(df: DataFrame, column: str) -> DataFrame:
    """One row per month from the first to the last date of a column."""
    span = df.agg(F.min(F.to_date(column)).alias("a"), F.max(F.to_date(column)).alias("b"))
    months = F.sequence(F.trunc("a", "MM"), F.trunc("b", "MM"), F.expr("interval 1 month"))
    return span.select(F.explode(months).alias("month"))
