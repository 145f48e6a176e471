"""Dates that are exact to the day, the month or the year, and catalogue years."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from oncolake.schemas import PARTIAL_DATE


def partial_date(value: Column, precision: Column | None = None) -> Column:
    """``struct(value, precision, date)``, null when there is no usable date.

    Precision E or none keeps the day, T the month, M the year; V means the date is a guess and
    drops it.
    """
    day = F.try_to_date(F.substring(F.trim(value), 1, 10), "yyyy-MM-dd")
    precision = F.coalesce(precision, F.lit("E")) if precision is not None else F.lit("E")

    def pick(exact, month, year):
        return F.when(precision == "E", exact).when(precision == "T", month).when(precision == "M", year)

    return F.when(
        day.isNotNull() & precision.isin("E", "T", "M"),
        F.struct(
            day.cast("string").substr(F.lit(1), pick(10, 7, 4)).alias("value"),
            pick("day", "month", "year").alias("precision"),
            day.alias("date"),
        ),
    ).cast(PARTIAL_DATE)


def report_partial_date(element: Column) -> Column:
    """The partial date of a report element that carries its precision as an attribute."""
    return partial_date(element["_VALUE"], element["_Datumsgenauigkeit"])


def year_date(value: Column) -> Column:
    """A year-exact partial date from text that starts with a year."""
    year = F.regexp_extract(F.trim(value), r"^(\d{4})", 1)
    return F.when(
        year != "",
        F.struct(
            year.alias("value"),
            F.lit("year").alias("precision"),
            F.try_to_date(F.concat(year, F.lit("-01-01")), "yyyy-MM-dd").alias("date"),
        ),
    ).cast(PARTIAL_DATE)


def icd_version_year(version: Column) -> Column:
    """The catalogue year of texts like ``10 2023 GM``; null for anything else."""
    return F.nullif(F.regexp_extract(version, r"^10 (20\d{2}) (?:GM|WHO)$", 1), F.lit(""))


def period_of(begins: Column, ends: Column) -> Column:
    """Earliest begin and latest end of two date arrays, nulls ignored."""
    return F.struct(F.array_min(begins).alias("start"), F.array_max(ends).alias("end"))


def german_date(text: Column) -> Column:
    """A ``dd.MM.yyyy`` date; a day past the end of its month means the last day, else null."""
    day, month, year = (F.try_element_at(F.split(text, r"\."), F.lit(i)).cast("int") for i in (1, 2, 3))
    valid = text.rlike(r"^\d{2}\.\d{2}\.\d{4}$") & day.between(1, 31) & month.between(1, 12)
    first = F.make_date(year, month, F.lit(1))
    return F.when(valid & (year > 0), F.least(F.date_add(first, day - 1), F.last_day(first)))
