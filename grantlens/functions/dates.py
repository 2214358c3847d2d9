"""Dates in free form, read by the kinds of their words and numbers.

A text is cut into words and numbers; tables say which words are months and which say nothing (weekdays,
ordinal endings, articles). What is left decides by its kinds alone: a number of four digits is the year, a
named month leaves the other number for the day, and two small numbers are month and day in this order unless
only the other fits. Any other word or number means that the text is no date.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The months' names, and words in dates that say nothing about the day.
MONTHS = "january february march april may june july august september october november december".split()
SILENT = (
    "monday tuesday wednesday thursday friday saturday sunday mon tue tues wed thu thur thurs fri sat sun st nd rd th of the on and in day year ad ce"
).split()
#: Years of two digits from this one on are those of the century before.
TURN = 70


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def month_of(word: Column) -> Column:
    """The number of the month that a word names or shortens to three letters or more, else NULL."""
    places = [F.when(F.lit(name).startswith(word), k + 1) for k, name in enumerate(MONTHS)]
    short = F.coalesce(*places, F.when(word == "sept", 9))
    return F.when(F.length(word) >= 3, short)


def free_date(c: Column) -> Column:
    """The date that a text says in some common order, or NULL. A missing day or month is the first."""
    tokens = F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+|\d+)"), 1)
    return bound(tokens, lambda found: bound(_kinds(found), _date))


def _kinds(tokens: Column) -> Column:
    words = F.filter(tokens, lambda token: ~token.rlike("^[0-9]"))
    numbers = F.filter(tokens, lambda token: token.rlike("^[0-9]"))
    years = F.filter(numbers, lambda token: F.length(token) == 4)
    small = F.transform(F.filter(numbers, lambda token: F.length(token) <= 2), lambda token: token.cast("int"))
    months = F.filter(F.transform(words, month_of), lambda month: month.isNotNull())
    unknown = F.exists(words, lambda word: ~word.isin(SILENT) & month_of(word).isNull())
    odd = F.exists(numbers, lambda token: ~F.length(token).isin(1, 2, 4))
    return F.struct(
        F.get(years, F.lit(0)).cast("int").alias("year"), F.size(years).alias("n_years"), small.alias("small"), F.size(small).alias("n"),
        F.get(months, F.lit(0)).alias("month"), F.size(months).alias("n_months"), (unknown | odd | (F.size(numbers) == 0)).alias("other"),
    )


def _date(k: Column) -> Column:
    def small(nth: int) -> Column:
        return F.get(k["small"], F.lit(nth))

    named, dated = k["n_months"] == 1, k["n_years"] == 1
    last = F.get(k["small"], k["n"] - 1)
    near = last + F.when(last >= TURN, 1900).otherwise(2000)
    # of two small numbers the month comes first, unless it cannot be one
    swapped = (small(0) > 12) & (small(1) <= 12)
    month, day = F.when(swapped, small(1)).otherwise(small(0)), F.when(swapped, small(0)).otherwise(small(1))

    def on(year: Column, month: Column, day: Column) -> Column:
        return F.try_to_date(F.format_string("%04d-%02d-%02d", year, month, day), "yyyy-MM-dd")

    one = F.lit(1)
    return (
        F.when(k["other"] | (k["n_months"] > 1) | (k["n_years"] > 1), None)
        .when(named & dated & (k["n"] == 0), on(k["year"], k["month"], one))
        .when(named & dated & (k["n"] == 1), on(k["year"], k["month"], small(0)))
        .when(named & (k["n_years"] == 0) & (k["n"] == 2), on(near, k["month"], small(0)))
        .when((k["n_months"] == 0) & dated & (k["n"] == 0), on(k["year"], one, one))
        .when((k["n_months"] == 0) & dated & (k["n"] == 1), on(k["year"], small(0), one))
        .when((k["n_months"] == 0) & dated & (k["n"] == 2), on(k["year"], month, day))
        .when((k["n_months"] == 0) & (k["n_years"] == 0) & (k["n"] == 3), on(near, month, day))
    )
