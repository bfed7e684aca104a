import hashlib
import hmac
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tierlake import functions as fn


def values(spark, rows, column, schema="v STRING"):
    df = spark.createDataFrame([(r,) for r in rows], schema)
    return [r[0] for r in df.select(column).collect()]


MISSING = [None, "", "   ", "nan", " None ", "NaT", "null", "NULL"]


@pytest.mark.parametrize("as_column", [False, True])
def test_missing_values(spark, as_column):
    source = F.col("v") if as_column else "v"
    assert values(spark, [*MISSING, "Nan", "0"], fn.null_like(source)) == [True] * 8 + [False] * 2
    assert values(spark, [*MISSING, " Nan "], fn.clean_text(source)) == [None] * 8 + ["Nan"]
    assert values(spark, [None, "x"], fn.known_text(source)) == ["DESCONOCIDO", "x"]


def test_timestamps_need_a_full_date(spark):
    rows = ["2026-01-02 03:04:05", "2026-01-02", "2026-01-02T03:04:05Z", "00:00:00", "2026", "abc", "2026-13-40", "nan"]
    stamp = fn.parse_timestamp("v").cast("string")
    assert values(spark, rows, stamp) == [
        "2026-01-02 03:04:05", "2026-01-02 00:00:00", "2026-01-02 03:04:05", None, None, None, None, None,
    ]
    assert values(spark, rows[:1], fn.parse_date("v")) == [date(2026, 1, 2)]


def test_zoned_times_become_utc(spark):
    assert values(spark, ["2026-01-02 03:04:05-05:00"], fn.as_utc("v").cast("string")) == ["2026-01-02 08:04:05"]
    assert values(spark, ["2026-07-02 03:00:00"], fn.as_utc("v", "Europe/Madrid").cast("string")) == ["2026-07-02 01:00:00"]


def test_numbers(spark):
    assert values(spark, ["12.345", " 5 ", "1e3", "", "N/A", None], fn.money("v")) == [
        Decimal("12.35"), Decimal("5.00"), Decimal("1000.00"), None, None, None,
    ]
    assert values(spark, ["1.23456", "nan", "abc"], fn.measure("v")) == [Decimal("1.2346"), None, None]
    documents = ["123.0", "1.23E5", "1.5E0", "00123", "12-A", "9" * 38 + ".0", "nan"]
    assert values(spark, documents, fn.canonical_number("v")) == [
        "123", "123000", "1.5E0", "00123", "12-A", "9" * 38 + ".0", None,
    ]


def test_row_hash_counts_null_as_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x STRING, y STRING")
    hashes = {r[0] for r in df.select(fn.row_hash(["x", "y"])).collect()}
    assert hashes == {"c683fc436ca8cee41e4050cb9ff9b7b1240944b5cab234ad082d69870803eacd"}


def test_derived_values(spark):
    df = spark.createDataFrame([(date(2000, 2, 29),)], "d DATE")
    row = df.select(
        fn.date_key("d").alias("key"),
        fn.age_in_years("d", date(2020, 2, 28)).alias("age"),
        fn.pseudonym(F.lit("abc")).alias("hash"),
        fn.in_domain_or(F.lit("z"), ("a", "b"), "OTRO").alias("other"),
        fn.in_domain_or(F.lit(None).cast("string"), ("a",), "OTRO").alias("none"),
    ).first()
    assert (row.key, row.age, row.other, row.none) == (20000229, 19, "OTRO", None)
    assert row.hash == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"


def test_ratio_is_null_on_zero(spark):
    df = spark.createDataFrame([(1, 3), (1, 0)], "a BIGINT, b BIGINT")
    assert [r[0] for r in df.select(fn.ratio("a", "b", 4)).collect()] == [0.3333, None]


def test_value_shapes(spark):
    rows = ["2026-01-01 00:00:00", "08:30", "12", "1.5", "abc", "nan"]
    assert values(spark, rows, fn.value_shape("v")) == ["date", "time", "integer", "decimal", "text", "missing"]


def test_keyed_pseudonyms_equal_the_published_vector_and_the_library(spark):
    published = "5bdcc146bf60754e6a042426089575c75a003f089d2739839dec58b964ec3843"  # fixed value: RFC 4231, case 2
    assert values(spark, ["what do ya want for nothing?"], fn.keyed_pseudonym("v", b"Jefe")) == [published]
    texts = ["", "1032", "ñandú 😀", None, "x" * 300]
    for key in (b"k", b"\x00\xff" * 32, b"longer than one block " * 9):
        expected = [None if t is None else hmac.new(key, t.encode(), hashlib.sha256).hexdigest() for t in texts]
        assert values(spark, texts, fn.keyed_pseudonym("v", key)) == expected
    assert values(spark, [1032], fn.keyed_pseudonym("v", b"k"), "v INT") == values(spark, ["1032"], fn.keyed_pseudonym("v", b"k"))
    with pytest.raises(ValueError):
        fn.keyed_pseudonym("v", b"")
