import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docflow import functions as fn
from docflow import udfs
from docflow.config import default_config
from docflow.markup import inline
from docflow.markup.fixed import GONE

MAPPING = default_config().mapping


def column(spark, make, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(make(F.col("v"))).collect()]


@pytest.mark.parametrize(
    ("raw", "name"),
    [
        ("https://creativecommons.org/licenses/by/4.0/", "CC-BY-4.0"), ("http://CREATIVECOMMONS.org/licenses/by-nc-nd/3.0/deed", "CC-BY-NC-ND-3.0"), ("https://creativecommons.org/publicdomain/zero/1.0/", "CC0-1.0"),
        ("https://creativecommons.org/publicdomain/mark/1.0/", None), ("CC BY 4.0", "CC-BY-4.0"), ("cc-by-sa 3.0", "CC-BY-SA-3.0"), ("CC BYNCND 4.0", "CC-BY-NCND-4.0"), ("CC0 2.0", "CC0-1.0"),
        ("CC BY", "CC-BY"), ("CC BY 4.0x", "CC-BY"), ("CC BY; https://creativecommons.org/licenses/by-nd/4.0/", "CC-BY-ND-4.0"), ("ACC BY 4.0", None), ("", None), (None, None),
    ],
)
def test_license(spark, raw, name):
    assert column(spark, fn.normalize_license, [raw]) == [name]


@pytest.mark.parametrize(
    ("parts", "date"),
    [
        (("2024", "Mar", "5", None), "2024-03-05"), (("2024", "3", None, None), "2024-03"), (("2024", "Winter", "5", None), "2024"), (("2024", None, "5", None), "2024"), (("24", "Mar", "5", None), None),
        ((None, None, None, "2023 Jan-Feb"), "2023-01"), ((None, None, None, "Spring 1999"), "1999"), ((None, None, None, "1499"), None), ((None, None, None, None), None), (("2024", "13", None, None), "2024"),
        (("2024", "December", "99", None), "2024-12-99"),
    ],
)
def test_partial_date(spark, parts, date):
    row = spark.createDataFrame([parts], "y string, m string, d string, f string").select(fn.partial_date(F.col("y"), F.col("m"), F.col("d"), F.col("f")))
    assert row.first()[0] == date


def test_titles(spark):
    cases = [(None, "A title.", "A title"), (None, " [Translated]. ", "Translated"), (None, "[Half", "[Half"), ("Own.", "x", "Own."), ("", "x..", "x."), (None, None, "")]
    rows = spark.createDataFrame([(i, *c[:2]) for i, c in enumerate(cases)], "i int, a string, b string").orderBy("i").select(fn.clean_title(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in rows] == [c[2] for c in cases]


def test_classification(spark):
    types = [["Review", "practice guideline"], ["Letter"], [], None, ["Review"]]
    assert [tuple(r) for r in column(spark, lambda c: fn.doc_type(c, MAPPING), types, "array<string>")] == [("guideline", "source"), ("other", "rule"), ("other", "rule"), ("other", "rule"), ("narrative_review", "source")]
    terms = [["Renal Insufficiency, Chronic"], ["Renal Insufficiency, Chronic", "Renal Dialysis"], ["Kidney Transplantation", "hemofiltration"], [], ["renal dialysis"]]
    assert column(spark, lambda c: fn.modality(c, MAPPING), terms, "array<string>") == [["ckd_non_dialysis"], ["unspecified"], ["hemodialysis", "transplant"], ["unspecified"], ["unspecified"]]
    assert column(spark, lambda c: fn.topics(c, MAPPING), [["Thirst", "Potassium"], [None], ["x"]], "array<string>") == [["potassium", "sodium_fluid"], [], []]
    assert column(spark, lambda c: fn.population(c, MAPPING), [["Child", "Aged"], ["Infant"], ["Adult"], None], "array<string>") == ["mixed", "pediatric", "adult", "unspecified"]
    assert column(spark, fn.language, [["xxx", "ENG"], ["zzz"], None, ["fre", "eng"]], "array<string>") == ["en", None, None, "fr"]


SAMPLES = [f"a ({GONE}, {GONE}) b", f"x {GONE}.", f"[{GONE}; see {GONE}]", f"a{GONE}-{GONE} , b", "1. x", "1) x", "# x", "#x", "- x", "---", "a < b <i>", "a*b_c`d\\", f"({GONE}) ({GONE},c)", "  spaced out \n x "]


def test_text_functions_in_batches(spark):
    assert column(spark, udfs.citation_cleanup, [*SAMPLES, None]) == [*map(inline.tidy, SAMPLES), None]
    assert column(spark, udfs.protect_block_start, [*SAMPLES, None]) == [*map(inline.guard, SAMPLES), None]
    assert column(spark, udfs.escape_markdown, [*SAMPLES, None]) == [*map(inline.escape, SAMPLES), None]


@settings(max_examples=200)
@given(st.text(alphabet=f"ab1. #->*_<([,;)]{GONE}–\n", max_size=30))
def test_tidy_leaves_no_mark_and_is_idempotent(text):
    out = inline.tidy(text)
    assert GONE not in out and out == out.strip() and not re.search(r"\s\s", out)
    assert inline.tidy(out) == out


def test_hash_and_addresses(spark):
    assert column(spark, fn.content_hash, ["", None]) == ["sha256:e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855", None]
    assert column(spark, lambda c: fn.original_uri("gs://b/", c), ["7"]) == ["gs://b/pmid-7.xml"]
