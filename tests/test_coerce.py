"""Text coercion against Python's own number parsing."""

import csv
import io
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from burstline.functions.coerce import (
    csv_field_count,
    is_bad_label,
    lenient_double,
    lenient_label,
    routing_label,
    strict_label,
)

NUMBERS = [
    "0", "1", "-1", "+1", "1.5", ".5", "5.", "1e5", "1E-5", "-1.25e+3", "1_0", "1__0", "_1",
    "1_", "1_0.2_5", " 1.5 ", "\t2\n", "", " ", ".", "e5", "1e", "--1", "+-1", "1.2.3", "abc",
    "nan", "NaN", "+nan", "-NAN", "inf", "-inf", "Infinity", "+INFINITY", "infin", "1d", "1f",
    "1D", "2F", "0x10", "0x1p3", "1,5", "$5", "1 2", "00012", "1e400", "-1e400", "1e-400",
    "179769313486231580793e289", "True", "null",
]
LABELS = ["0", "1", "", " 1 ", "+1", "-1", "1_0", "1.0", "1.5", "abc", "1e0", "0x1", "007", " "]


def python_float(text):
    try:
        return float(text) if text else 0.0
    except ValueError:
        return 0.0


def python_int(text):
    try:
        return int(text)
    except (TypeError, ValueError):
        return None


def same(a, b):
    return a == b or (math.isnan(a) and math.isnan(b))


def evaluate(spark, texts, expression):
    rows = [(i, text) for i, text in enumerate(texts)]
    frame = spark.createDataFrame(rows, "i int, text string")
    out = frame.select("i", expression(F.col("text")).alias("out")).collect()
    return [row.out for row in sorted(out)]


def test_lenient_double_matches_python(spark):
    texts = [*NUMBERS, None]
    actual = evaluate(spark, texts, lenient_double)
    for text, value in zip(texts, actual, strict=True):
        assert same(value, python_float(text)), (text, value, python_float(text))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.one_of(
            st.text(alphabet="0123456789+-._eEdDfFxXnaiNAI ", max_size=12),
            st.floats().map(repr),
            st.floats(width=32).map(str),
        ),
        min_size=200,
        max_size=400,
    )
)
def test_lenient_double_matches_python_on_random_text(spark, texts):
    actual = evaluate(spark, texts, lenient_double)
    for text, value in zip(texts, actual, strict=True):
        assert same(value, python_float(text)), (text, value, python_float(text))


def test_labels(spark):
    assert evaluate(spark, [*LABELS, None], routing_label) == [
        python_int(text) or 0 for text in [*LABELS, None]
    ]
    readable = [text for text in LABELS if text == "" or python_int(text) is not None]
    expected = [python_int(text) or 0 for text in readable]
    assert evaluate(spark, readable, strict_label) == expected
    assert evaluate(spark, readable, lenient_label) == expected
    bad = evaluate(spark, [*LABELS, None], is_bad_label)
    assert bad == [t not in readable for t in LABELS] + [False]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("text", ["abc", "1.0", " "])
def test_strict_label_fails_the_job_in_any_mode(spark, text, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match="unreadable label"):
            evaluate(spark, [text], strict_label)
        assert evaluate(spark, [text], lenient_label) == [None]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_label_too_large_for_the_column_is_null(spark):
    assert evaluate(spark, ["99999999999"], strict_label) == [None]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.lists(st.text(alphabet='ab1," ', max_size=5), min_size=2, max_size=6),
        min_size=100,
        max_size=200,
    )
)
def test_csv_field_count_matches_python_csv(spark, rows):
    lines = []
    for row in rows:
        buffer = io.StringIO()
        csv.writer(buffer, lineterminator="").writerow(row)
        lines.append(buffer.getvalue())
    assert evaluate(spark, lines, csv_field_count) == [len(row) for row in rows]


def test_csv_field_count_of_long_fields(spark):
    lines = ["x" * 200_000 + ",1", '"' + "y," * 100_000 + '",2,3']
    assert evaluate(spark, lines, csv_field_count) == [2, 3]
