"""Column functions against plain Python definitions and hand-written edge rows."""

import datetime as dt
import html
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions import parse, text, vectors


def one_column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"c {kind}")


def apply(spark, function, values, kind="string"):
    return [row[0] for row in one_column(spark, values, kind).select(function(F.col("c"))).collect()]


def python_clean(value):
    if value is None:
        return None
    return re.sub(r"\s+", " ", html.unescape(value)).strip() or None


def test_clean_text_decodes_entities_and_squeezes_space(spark):
    raw = "Great &quot;toy&quot;&nbsp;for   kids.\nWorks\twell."
    assert apply(spark, text.clean_text, [raw, "   ", None]) == ['Great "toy" for kids. Works well.', None, None]


def test_embedding_text_joins_what_is_there(spark):
    rows = [
        ("Great &quot;toy&quot;", "My child&nbsp;loved it.   Works\nwell."),
        ("only summary", None),
        (" ", "only body"),
        ("   ", None),
    ]
    df = spark.createDataFrame(rows, "s string, b string")
    joined = [r[0] for r in df.select(text.embedding_text(F.col("s"), F.col("b"))).collect()]
    assert joined == ['Great "toy". My child loved it. Works well.', "only summary", "only body", None]


PIECES = ["&amp;", "&lt", "&#39;", "&#x1F600;", "&nbsp;", "&notit;", "&", ";", " ", "\t", " ", " ", "​", "x", "é", "\n"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), min_size=1, max_size=40))
def test_clean_text_equals_python(spark, values):
    assert apply(spark, text.clean_text, values) == [python_clean(v) for v in values]


def test_price_is_the_first_plain_number(spark):
    assert apply(spark, parse.parse_price, ["$12.50", "$1,234.56", "", "free", None, "7"]) == [12.5, 1.0, None, None, None, 7.0]


def test_vote_drops_commas_and_fractions(spark):
    got = apply(spark, parse.parse_vote, ["12", "1,045", "", None, "abc", "3.7", "-2", "99999999999"])
    assert got == [12, 1045, None, None, None, 3, -2, None]


def test_review_date_tolerates_short_and_trailing_parts(spark):
    values = ["09 22, 2016", "9 2, 2016", "09 22, 2016 x", "13 40, 2016", "junk", None]
    good = [dt.date(2016, 9, 22), dt.date(2016, 9, 2), dt.date(2016, 9, 22)]
    assert apply(spark, parse.parse_review_date, values) == good + [None] * 3


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dates(dt.date(1970, 1, 1), dt.date(2100, 1, 1)), min_size=1, max_size=30))
def test_review_date_round_trip(spark, days):
    texts = [f"{d.month:02d} {d.day}, {d.year}" for d in days]
    assert apply(spark, parse.parse_review_date, texts) == days


def test_timestamps_never_fail(spark):
    got = apply(spark, parse.parse_timestamp, ["2024-01-02T03:04:05", "2024-01-02 03:04:05", "soon", None])
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5)] * 2 + [None, None]
    assert apply(spark, parse.epoch_to_timestamp, ["86400", "x", None]) == [dt.datetime(1970, 1, 2), None, None]
    assert apply(spark, parse.parse_flag, ["true", "no", "maybe", None]) == [True, False, None, None]


@pytest.mark.parametrize(
    "kind, values, expected",
    [
        ("string", ["a", None], [["a"], [None]]),
        ("array<string>", [["a", None], None, []], [["a", None], [], []]),
        ("array<int>", [[1, 2], None], [["1", "2"], []]),
    ],
)
def test_string_array(spark, kind, values, expected):
    data_type = one_column(spark, [], kind).schema["c"].dataType
    assert apply(spark, lambda c: parse.string_array(c, data_type), values, kind) == expected


def test_array_text_length(spark):
    strings = T.ArrayType(T.StringType())
    values = [["ab", None, "c"], [], None]
    assert apply(spark, lambda c: parse.array_text_length(c, strings), values, "array<string>") == [3, 0, 0]
    assert apply(spark, lambda c: parse.array_text_length(c, T.StringType()), ["abc"]) == [0]


def test_string_map_from_struct_map_and_text(spark):
    df = spark.sql(
        "SELECT named_struct('a', CAST(NULL AS string), 'b', 'x', 'n', 2, 'l', array(1)) AS c "
        "UNION ALL SELECT CAST(NULL AS struct<a: string, b: string, n: int, l: array<int>>)"
    )
    got = [r[0] for r in df.select(parse.string_map(F.col("c"), df.schema["c"].dataType)).collect()]
    assert got == [{"b": "x", "n": "2", "l": "[1]"}, {}]
    as_map = spark.sql("SELECT map('a', 1, 'b', NULL) AS c")
    assert as_map.select(parse.string_map(F.col("c"), as_map.schema["c"].dataType)).first()[0] == {"a": "1"}
    assert apply(spark, lambda c: parse.string_map(c, T.StringType()), ['{"k": "v"}', "broken", None]) == [{"k": "v"}, {}, {}]


def test_review_key_treats_missing_parts_as_empty(spark):
    df = spark.sql("SELECT 'a' AS asin, CAST(NULL AS string) AS r, 5L AS t, 2.0D AS rating, 'a||||5||2.0' AS joined")
    key = parse.review_key(F.col("asin"), F.col("r"), F.col("t"), F.col("rating"))
    assert df.select(key == F.sha2("joined", 256)).first()[0]


def test_json_string_array(spark):
    got = apply(spark, parse.json_string_array, ['["a","b"]', "plain", None, "[]"])
    assert got == [["a", "b"], ["plain"], None, []]


def test_l2_normalize(spark):
    got = apply(spark, vectors.l2_normalize, [[3.0, 4.0], [0.0, 0.0], None], "array<float>")
    assert got[0] == pytest.approx([0.6, 0.8])
    assert got[1:] == [[0.0, 0.0], None]


def test_vector_literal(spark):
    literal = apply(spark, lambda c: vectors.vector_literal(c, 2), [[0.5, -1.0]], "array<float>")
    assert literal == ["[0.5,-1.0]"]
    lenient = apply(spark, lambda c: vectors.vector_literal(c, 2, strict=False), [[0.5], None], "array<float>")
    assert lenient == [None, None]
    for bad in ([0.5], None):
        with pytest.raises(PySparkException, match="vector dimension"):
            apply(spark, lambda c: vectors.vector_literal(c, 2), [bad], "array<float>")


def test_wrong_dimension_ignores_missing_vectors(spark):
    got = apply(spark, lambda c: vectors.has_wrong_dimension(c, 2), [[1.0], [1.0, 2.0], None], "array<float>")
    assert got == [True, False, False]


def test_packed_texts_are_shorter_and_come_back(spark):
    digest = "0123456789abcdef" * 4
    values = [digest, digest.upper(), digest + "0", "R1", "", None, "a" * 31, "ü" * 16, "\x00x", "\x01x"]
    packed = apply(spark, parse.packed, values)
    assert len(packed[0]) == 33 and len({bytes(p) for p in packed if p is not None}) == 9
    assert apply(spark, lambda c: parse.unpacked(parse.packed(c)), values) == values
