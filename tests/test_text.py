import hashlib
import math
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from grantlens.functions import templates, text, variants


@pytest.mark.parametrize(
    "given_text, expected",
    [("a  \tb\x1c\n c ", "a b c"), ("", ""), (None, ""), ("　x y\xa0", "x y"), ("\r\n", "")],
)
def test_clean_text(one, given_text, expected):
    assert one(text.clean_text(F.col("c")), "c string", given_text) == expected


@pytest.mark.parametrize(
    "given_text, expected",
    [("HIV-1 o'neil x-RAY 3D", "Hiv-1 O'neil X-ray 3d"), ("  two\twords ", "Two Words"), (None, ""), ("ßa", "Ssa")],
)
def test_capitalise_words(one, given_text, expected):
    assert one(text.capitalise_words(F.col("c")), "c string", given_text) == expected


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8", max_codepoint=0x3001, exclude_characters="\x00")), min_size=40, max_size=60))
def test_cleaning_equals_unicode_whitespace_rules(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, c string")
    cleaned = {row["i"]: row["out"] for row in rows.select("i", text.clean_text(F.col("c")).alias("out")).collect()}
    assert cleaned == {i: re.sub(r"\s+", " ", c).strip() for i, c in enumerate(texts)}


@pytest.mark.parametrize("given_text, expected", [("2023-08-01T00:00:00", "2023-08-01"), ("abc", "abc"), (None, "")])
def test_date_prefix(one, given_text, expected):
    assert one(text.date_prefix(F.col("c")), "c string", given_text) == expected


@pytest.mark.parametrize(
    "given_text, year, expected",
    [
        ("2022 Jun 28", None, "2022-06-28"),
        ("2022 jun 8", None, "2022-06-08"),
        ("2021 Sep", None, "2021-09-01"),
        ("2019", None, "2019-01-01"),
        ("2021-07", None, "2021-07-01"),
        ("2021-07-05", None, "2021-07-05"),
        ("2021-07-05T10:11:12", None, "2021-07-05"),
        ("07/05/2021", None, "2021-07-05"),
        ("7-5-2021", None, "2021-07-05"),
        ("2020 Winter", None, "2020-01-01"),
        ("2021 Sep-Oct", None, "2021-09-01"),
        ("1998 Winter", None, "1998-01-01"),
        ("2019 Dec-2020 Jan", None, "2019-12-01"),
        ("2021 September 3", None, "2021-09-03"),
        ("2021 September", 2018, "2021-09-01"),
        ("2021-09-15T00:00:00Z", None, "2021-09-15"),
        ("2021-09-15T12:00:00.000+02:00", None, "2021-09-15"),
        ("Winter 2020", 2018, "2018-01-01"),
        ("2021-13-40", None, "2020-01-01"),
        ("2020 Winter", 2018, "2020-01-01"),
        ("", None, "1900-01-01"),
        (None, None, "1900-01-01"),
        ("", 2023, "2023-01-01"),
        (None, 2023, "2023-01-01"),
        (None, 0, "1900-01-01"),
    ],
)
def test_parse_date(one, given_text, year, expected):
    column = text.parse_date(F.col("c"), F.col("y"))
    assert one(column, "c string, y int", given_text, year) == expected


@pytest.mark.parametrize(
    "amount, size, count",
    [("444000", math.sqrt(444000) / 100, 444000), ("0", 1.0, 0), ("-5", 1.0, 0), (None, 1.0, 0), ("abc", 1.0, 0), ("12.9", math.sqrt(12.9) / 100, 12)],
)
def test_amounts(one, amount, size, count):
    assert one(text.amount_size(F.col("c")), "c string", amount) == pytest.approx(size)
    assert one(text.amount_count(F.col("c")), "c string", amount) == count


@pytest.mark.parametrize("categories, place", [("Cancer; Aging", 5), ("Aging", 14), (" Aging\t;x", 14), (None, 0), ("", 0)])
def test_category_colour(one, categories, place):
    assert one(text.category_colour(F.col("c")), "c string", categories) == text.CATEGORY_PALETTE[place]


def test_author_id(one):
    assert one(text.author_id(F.col("c")), "c string", "Müller Ü") == hashlib.md5("Müller Ü".encode()).hexdigest()[:12]


def test_joined_terms(one):
    column = text.joined_terms([F.col("a"), F.col("b"), F.col("c")])
    assert one(column, "a string, b string, c string", "x", None, "z") == "x; z"
    assert one(column, "a string, b string, c string", "", "", None) == ""


@pytest.mark.parametrize(
    "start, year, expected", [("2020-02-03", 2019, "2020-02-03"), ("", 2019, "2019-01-01"), (None, None, "")]
)
def test_start_date_or_year(one, start, year, expected):
    assert one(text.start_date_or_year(F.col("s"), F.col("y")), "s string, y int", start, year) == expected


@pytest.mark.parametrize(
    "value, expected",
    [('{"abbreviation":"NIA"}', "NIA"), ('"NCI"', "NCI"), ("5", ""), ("null", ""), ('{"abbreviation":null}', ""), (None, "")],
)
def test_named_text(one, value, expected):
    assert one(variants.named_text(F.parse_json("c")), "c string", value) == expected


def test_joined_names(one):
    people = '[{"full_name":"A B"},{"full_name":""},{"full_name":null},{"full_name":"C  D"}]'
    items = F.try_variant_get(F.parse_json("c"), "$", "array<struct<full_name string>>")
    assert one(variants.joined_names(items, "full_name"), "c string", people) == "A B, C  D"
    assert one(variants.joined_names(items, "full_name"), "c string", "[]") == ""


def test_templates(spark):
    row = spark.createDataFrame(
        [(2020, "NIA", "a  TITLE", "text", None, "2020-01-02", "2021-01-02", "terms", "R01")],
        "fiscal_year int, agency_ic_admin string, project_title string, abstract_text string, "
        "spending_categories_desc string, project_start_date string, project_end_date string, pref_terms string, activity_code string",
    )
    texts = row.select(*[templates.grant_text(name).alias(name) for name in templates.GRANT_TEMPLATES]).first()
    assert texts["v4"] == "2020 | NIA | A Title"
    assert texts["v12"] == "A Title | terms "
    assert texts["abstract"] == "A Title | text | Project starts on 2020-01-02, ends on 2021-01-02"
    plain = row.select(templates.grant_text("{project_title}!", capitalise_title=False).alias("t")).first()["t"]
    assert plain == "a  TITLE!"


@pytest.mark.parametrize(
    "given, expected",
    [
        ("5 March 2019", "2019-03-05"), ("March 5, 2019", "2019-03-05"), ("5th of March, 2019", "2019-03-05"), ("the 1st of Sept 2019", "2019-09-01"),
        ("Tuesday 5 Mar. 2019", "2019-03-05"), ("2019, Mar 22nd", "2019-03-22"), ("25.12.2019", "2019-12-25"), ("12.25.2019", "2019-12-25"),
        ("2019/12/25", "2019-12-25"), ("03/04/2019", "2019-03-04"), ("25-Dec-2019", "2019-12-25"), ("12/25/98", "1998-12-25"), ("5 Mar 07", "2007-03-05"),
        ("MARCH 2019", "2019-03-01"), ("03/2019", "2019-03-01"), ("in may 2019", "2019-05-01"), ("30 Feb 2019", "2020-01-01"), ("5 Smarch 2019", "2020-01-01"),
        ("room 12, 2019", "2020-01-01"), ("20190305", "2020-01-01"), ("123", "2020-01-01"), ("March", "2020-01-01"), ("1 2 3 4 5", "2020-01-01"),
        ("2019 2020", "2019-01-01"), ("ma 5 2019", "2020-01-01"), ("13/14/2019", "2020-01-01"),
    ],
)
def test_dates_in_free_form(one, given, expected):
    assert one(text.parse_date(F.col("c")), "c string", given) == expected
