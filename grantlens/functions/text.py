"""Column functions for grant and paper text, dates, amounts and colours.

All are built-in expressions, so they run inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from grantlens.functions.dates import free_date

# Every character a Unicode-aware whitespace class matches, with the
# four information separators that Java's class leaves out.
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"
WHITESPACE_ENDS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"

# The 20 category colours, in palette order.
CATEGORY_PALETTE = (
    "#1f77b4", "#aec7e8", "#ff7f0e", "#ffbb78", "#2ca02c",
    "#98df8a", "#d62728", "#ff9896", "#9467bd", "#c5b0d5",
    "#8c564b", "#c49c94", "#e377c2", "#f7b6d2", "#7f7f7f",
    "#c7c7c7", "#bcbd22", "#dbdb8d", "#17becf", "#9edae5",
)

# Accepted date shapes, each with the pattern that parses it.
DATE_SHAPES = (
    (r"^\d{4} [A-Za-z]{3} \d{1,2}$", "yyyy MMM d"),
    (r"^\d{4} [A-Za-z]{3}$", "yyyy MMM"),
    (r"^\d{4} [A-Za-z]{4,} \d{1,2}$", "yyyy MMMM d"),
    (r"^\d{4} [A-Za-z]{4,}$", "yyyy MMMM"),
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{4}-\d{1,2}$", "yyyy-M"),
    (r"^\d{4}$", "yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "M-d-yyyy"),
)

# A time after the day, with or without fraction and zone; the start of a month range; a leading year.
TIME_OF_DAY = r"T\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?$"
RANGE_START = r"^(\d{4} [A-Za-z]{3})(?:[^A-Za-z]|$)"
YEAR_START = r"^(\d{4})(?: |$)"

# Dates given to rows that have none, or none that parses.
DATE_IF_EMPTY = "1900-01-01"
DATE_IF_UNPARSABLE = "2020-01-01"


def present(c: Column) -> Column:
    """``c`` with the empty string turned into NULL."""
    return F.nullif(c, F.lit(""))


def or_default(c: Column, empty: object, default: object) -> Column:
    """``default`` where ``c`` is NULL or equals ``empty`` (zero or '')."""
    return F.coalesce(F.nullif(c, F.lit(empty)), F.lit(default))


def clean_text(c: Column) -> Column:
    """Whitespace runs become one space, ends are cut, NULL becomes ''."""
    return F.coalesce(F.trim(F.regexp_replace(c, F.lit(WHITESPACE_RUN), F.lit(" "))), F.lit(""))


def strip(c: Column) -> Column:
    """Cut whitespace from both ends only."""
    return F.regexp_replace(c, F.lit(WHITESPACE_ENDS), F.lit(""))


def capitalise_words(c: Column) -> Column:
    """Each whitespace-separated word with an upper first letter and a lower rest."""
    return F.initcap(clean_text(c))


def date_prefix(c: Column) -> Column:
    """The first ten characters, unvalidated; NULL becomes ''."""
    return F.coalesce(F.substring(c, 1, 10), F.lit(""))


def year_start(year: Column) -> Column:
    """1 January of a year as text; NULL stays NULL."""
    return F.concat(year.cast("string"), F.lit("-01-01"))


def parse_date(c: Column, fiscal_year: Column | None = None) -> Column:
    """Text in one of ``DATE_SHAPES``, or else in free form (:func:`dates.free_date`), as ``yyyy-MM-dd``.

    A time of day is left out. Partial dates take the first day of their period, and so do month
    ranges and seasons: of their leading year and, if it is given, month. Empty and unparsable texts
    take 1 January of ``fiscal_year`` where it is given, else a fixed date. The
    shape is tested first, so the parser never has to fail on the other patterns.
    """
    text = F.regexp_replace(F.trim(c), TIME_OF_DAY, "")
    parsed = F.lit(None).cast("date")
    for shape, pattern in reversed(DATE_SHAPES):
        parsed = F.when(text.rlike(shape), F.try_to_date(text, pattern)).otherwise(parsed)
    in_month = F.try_to_date(F.nullif(F.regexp_extract(text, RANGE_START, 1), F.lit("")), "yyyy MMM")
    in_year = F.try_to_date(F.nullif(F.regexp_extract(text, YEAR_START, 1), F.lit("")), "yyyy")
    parsed = F.coalesce(parsed, free_date(text), in_month, in_year)
    year = F.lit(None).cast("string") if fiscal_year is None else year_start(F.nullif(fiscal_year, F.lit(0)))
    fallback = F.when(F.coalesce(c, F.lit("")) == "", F.lit(DATE_IF_EMPTY)).otherwise(F.lit(DATE_IF_UNPARSABLE))
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), year, fallback)


def start_date_or_year(start: Column, fiscal_year: Column) -> Column:
    """The start date if there is one, else 1 January of the year, else ''."""
    return F.coalesce(present(start), year_start(fiscal_year), F.lit(""))


def joined_terms(parts: Sequence[Column], separator: str = "; ") -> Column:
    """The non-empty parts in order, joined by ``separator``."""
    return F.concat_ws(separator, *[present(part) for part in parts])


def amount_size(amount: Column) -> Column:
    """``sqrt(amount) / 100`` for positive amounts, 1 for all others."""
    value = amount.try_cast("double")
    return F.when(value > 0, F.sqrt(value) / F.lit(100.0)).otherwise(F.lit(1.0))


def amount_count(amount: Column) -> Column:
    """The amount cut to a whole number; missing and negative amounts count 0."""
    return F.greatest(F.coalesce(amount.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint")), F.lit(0).cast("bigint"))


def category_colour(categories: Column) -> Column:
    """A palette colour for the first of the ';'-separated categories.

    The index comes from md5, so it is the same in every session.
    """
    first = strip(F.element_at(F.split(categories, ";"), 1))
    index = F.conv(F.substring(F.md5(first), 1, 8), 16, 10).cast("bigint") % F.lit(len(CATEGORY_PALETTE))
    palette = F.array(*[F.lit(colour) for colour in CATEGORY_PALETTE])
    hashed = F.element_at(palette, (index + 1).cast("int"))
    return F.when(present(categories).isNull(), F.lit(CATEGORY_PALETTE[0])).otherwise(hashed)


def author_id(name: Column) -> Column:
    """The first 12 hex digits of the md5 of an author's name."""
    return F.substring(F.md5(name), 1, 12)


def rescale(c: Column, factor: float = 5.5) -> Column:
    """A coordinate times a factor."""
    return c * F.lit(factor)
