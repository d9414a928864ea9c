from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from orderloom.functions import dates, errors, money, picks, text


def one(spark, column):
    return spark.range(1).select(column).collect()[0][0]


def test_date_keys_and_back(spark):
    day = F.lit(date(2024, 3, 2))
    assert one(spark, dates.date_key(day)) == 20240302
    assert one(spark, dates.month_key(F.lit(20240302))) == 202403
    assert one(spark, dates.key_to_date(F.lit(20240302))) == date(2024, 3, 2)
    assert one(spark, dates.key_to_date(F.lit(0))) is None
    assert one(spark, dates.key_to_date(F.lit(None).cast("int"))) is None


def test_weekdays_count_from_sunday(spark):
    assert one(spark, dates.weekday_number(F.lit(date(2024, 3, 2)))) == 7
    assert one(spark, dates.weekday_number(F.lit(date(2024, 3, 3)))) == 1
    assert one(spark, dates.is_weekend(F.lit(date(2024, 3, 2)))) is True
    assert one(spark, dates.is_weekend(F.lit(date(2024, 3, 4)))) is False


def test_day_arithmetic(spark):
    assert one(spark, dates.days_between(F.lit(date(2024, 3, 1)), F.lit(date(2024, 3, 5)))) == 4
    assert one(spark, dates.add_days(F.lit(date(2024, 3, 1)), -1)) == date(2024, 2, 29)
    moment = F.lit(datetime(2024, 1, 1, 23, 58)).cast("timestamp_ntz")
    assert one(spark, dates.add_minutes(moment, 5)) == datetime(2024, 1, 2, 0, 3)


def test_concatenation_and_null(spark):
    nothing = F.lit(None).cast("string")
    assert one(spark, text.concat_blank_null("a", nothing, F.lit(1))) == "a1"
    assert one(spark, text.concat_null("a", nothing)) is None
    assert one(spark, text.indent(F.lit(2), F.lit("x"))) == "        x"
    assert one(spark, text.left_pad_digits(F.lit(42), 6)) == "000042"
    assert one(spark, text.left_pad_digits(F.lit(1234567), 6)) == "234567"


def test_line_total_keeps_four_decimals(spark):
    total = money.line_total(F.lit(3), F.lit("9.99").cast("decimal(10,2)"), F.lit("0.15").cast("decimal(4,2)"))
    assert one(spark, total) == Decimal("25.4745")
    assert one(spark, money.amount(F.lit("2.345").cast("decimal(10,3)"))) == Decimal("2.35")
    assert one(spark, money.amount(F.lit("-2.345").cast("decimal(10,3)"))) == Decimal("-2.35")


def test_picks_are_even_and_repeatable(spark):
    drawn = spark.range(20000).select(picks.pick(F.col("id"), "x", 5).alias("p"))
    counts = {r["p"]: r["count"] for r in drawn.groupBy("p").count().collect()}
    assert set(counts) == {0, 1, 2, 3, 4} and all(3700 < n < 4300 for n in counts.values())
    assert one(spark, picks.pick(F.lit(7), "a", 1000)) == one(spark, picks.pick(F.lit(7), "a", 1000))


def test_error_messages(spark):
    row = spark.range(1).select(*errors.error_columns("p", F.lit(51001), datetime(2024, 1, 1))).collect()[0]
    assert tuple(row) == ("p", 51001, "Insufficient stock to fulfil this order.", datetime(2024, 1, 1))
