from decimal import Decimal

import pytest
from helpers import day
from pyspark.sql import functions as F

from orderlake.functions import scalars as x


def one(spark, column, **values):
    frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return frame.select(column.alias("v")).head()["v"]


@pytest.mark.parametrize(
    "text, expected", [("31.0", 31), ("3.7", 4), (" 12 ", 12), ("x", None), ("", None), ("-2.5", -3), ("1" * 30, None)]
)
def test_try_whole(spark, text, expected):
    assert one(spark, x.try_whole("a"), a=text) == expected


def test_strict_whole_raises(spark):
    assert one(spark, x.to_whole("a"), a="31.0") == 31
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, x.to_whole("a"), a="x")


def test_try_amount_overflow_is_null(spark):
    assert one(spark, x.try_amount("a", 3, 1), a="4.25") == Decimal("4.3")
    assert one(spark, x.try_amount("a", 3, 1), a="123.4") is None


@pytest.mark.parametrize(
    "text, expected", [("100+ ratings", 100), ("₹ 300", 300), ("Too Few Ratings", None), (None, None), ("a12b34", 12)]
)
def test_first_whole(spark, text, expected):
    assert one(spark, x.first_whole(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize(
    "text, expected", [("Indiranagar,Bangalore", "Bangalore"), ("Pune", "Pune"), ("a,b, Delhi ", "Delhi"), ("x,", "x,"), (None, None)]
)
def test_city_of(spark, text, expected):
    assert one(spark, x.city_of(F.lit(text).cast("string"))) == expected


def test_file_date(spark):
    assert one(spark, x.file_date("a"), a="s3://b/raw/orders/dt=2026-09-01/orders.csv") == day("2026-09-01")
    assert one(spark, x.file_date("a"), a="raw/orders/orders.csv") is None
    assert one(spark, x.file_date("a"), a="raw/orders/dt=2026-13-01/orders.csv") is None


def test_ratio(spark):
    assert one(spark, x.ratio(F.lit(1), F.lit(3), 4)) == 0.3333
    assert one(spark, x.ratio(F.lit(1), F.lit(0), 4)) == 0.0
    assert one(spark, x.ratio(F.lit(None).cast("int"), F.lit(0))) is None


def test_strict_greatest_least(spark):
    assert one(spark, x.strict_greatest(F.lit(0), x.strict_least(F.lit(7), F.lit(9)))) == 7
    assert one(spark, x.strict_greatest(F.lit(0), F.lit(None).cast("int"))) is None


def test_days_between_counts_midnights(spark):
    earlier, later = F.lit("2026-01-01 23:59:00").cast("timestamp"), F.lit("2026-01-02 00:01:00").cast("timestamp")
    assert one(spark, x.days_between(earlier, later)) == 1


def test_mask_email(spark):
    assert one(spark, x.mask_email("a"), a="jane.doe@example.com") == "*****@example.com"


def test_cosine(spark):
    def vector(*values):
        return F.array(*[F.lit(float(v)).cast("float") for v in values])

    assert one(spark, x.cosine(vector(1, 0), vector(2, 0))) == pytest.approx(1.0)
    assert one(spark, x.cosine(vector(1, 2), vector(2, 1))) == pytest.approx(0.8)
    assert one(spark, x.cosine(vector(0, 0), vector(2, 1))) is None
    assert one(spark, x.cosine(vector(1, 2, 3), vector(2, 1))) is None


def test_text_or_null(spark):
    for token in ("", "\\N", "NULL"):
        assert one(spark, x.text_or_null("a"), a=token) is None
    assert one(spark, x.text_or_null("a"), a="null") == "null"
