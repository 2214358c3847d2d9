"""Text representations of grants, papers and authors."""

from __future__ import annotations

from collections.abc import Mapping
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from grantlens.functions.text import capitalise_words

# The text formats, by version. Braces name columns.
GRANT_TEMPLATES = {
    "v4": "{fiscal_year} | {agency_ic_admin} | {project_title}",
    "v5": "{agency_ic_admin} | {project_title} | {fiscal_year}",
    "v7": "{project_title} | {fiscal_year}",
    "v8": "{project_title}",
    "v9": "{project_title} | {agency_ic_admin}",
    "v10": "{agency_ic_admin} | {project_title}",
    "v11": "{project_title}. Project starts on {project_start_date}, ends on {project_end_date}. {agency_ic_admin}.",
    "v12": "{project_title} | {pref_terms} {spending_categories_desc}",
    "abstract": "{project_title} | {abstract_text} | Project starts on {project_start_date}, ends on {project_end_date}",
    "year_abstract": "{fiscal_year} | {agency_ic_admin} | {activity_code} | {project_title} | {abstract_text}",
    "year_category": "{fiscal_year} | {agency_ic_admin} | {activity_code} | {spending_categories_desc} | {project_title}",
    "title_codes": "{project_title} | {agency_ic_admin} | {activity_code} | {fiscal_year}",
    "terms_dates": "{project_title} | {pref_terms} {spending_categories_desc}. Project starts on {project_start_date}, ends on {project_end_date}. {agency_ic_admin}.",
    "title_dates": "{project_title} | Project starts on {project_start_date}, ends on {project_end_date}.",
}
PAPER_TEMPLATE = "{source} | {title}"
AUTHOR_TEMPLATE = "{source} | {name} | {title}"


def build_text(template: str, columns: Mapping[str, Column] | None = None) -> Column:
    """Fill a template from columns, with '' for a missing value.

    ``columns`` overrides what a name in braces stands for.
    """
    columns = columns or {}
    parts = []
    for literal, field, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field:
            value = columns.get(field, F.col(field))
            parts.append(F.coalesce(value.cast("string"), F.lit("")))
    return F.concat(*parts)


def grant_text(template: str = "abstract", capitalise_title: bool = True) -> Column:
    """A grant row as text, by template name or by a template of one's own."""
    columns = {"project_title": capitalise_words(F.col("project_title"))} if capitalise_title else {}
    return build_text(GRANT_TEMPLATES.get(template, template), columns)


def paper_text(source: Column, title: Column) -> Column:
    return build_text(PAPER_TEMPLATE, {"source": source, "title": title})


def author_text(source: Column, name: Column, title: Column) -> Column:
    return build_text(AUTHOR_TEMPLATE, {"source": source, "name": name, "title": title})
