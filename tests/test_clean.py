import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from regiscope.functions import clean, ids
from regiscope.functions.sql import register_functions
from tests.conftest import plan_of


def one(spark, expression):
    return spark.range(1).select(expression).first()[0]


def text(value):
    return F.lit(value).cast("string")


@pytest.mark.parametrize("raw, day", [
    (None, None), ("", None), (" ", None), ("0", None), ("00000000", None), (" 00000000 ", None),
    ("20240229", datetime.date(2024, 2, 29)), ("19700101", datetime.date(1970, 1, 1)),
])
def test_dates(spark, raw, day):
    assert one(spark, clean.parse_date(text(raw))) == day
    register_functions(spark)
    assert spark.range(1).select(text(raw).alias("s")).selectExpr("parse_date(s)").first()[0] == day


@pytest.mark.parametrize("raw", ["20230230", "2023", "abc", "2024022"])
def test_bad_dates(spark, raw):
    assert one(spark, clean.parse_date(text(raw), strict=False)) is None
    with pytest.raises(Exception, match="cannot read date"):
        one(spark, clean.parse_date(text(raw)))


@pytest.mark.parametrize("raw, amount", [
    ("5000,00", "5000.00"), ("0,005", "0.01"), ("-0,005", "-0.01"), ("12", "12.00"), ("", None), (None, None),
])
def test_amounts(spark, raw, amount):
    assert one(spark, clean.to_money(text(raw))) == (None if amount is None else Decimal(amount))


@pytest.mark.parametrize("raw", ["1.234,56", "x", " ", "99999999999999999,00"])
def test_bad_amounts(spark, raw):
    assert one(spark, clean.to_money(text(raw), strict=False)) is None
    with pytest.raises(Exception, match="cannot read amount"):
        one(spark, clean.to_money(text(raw)))


def test_strict_holds_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="cannot read smallint"):
            one(spark, clean.to_number(text("1x"), "smallint"))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


@pytest.mark.parametrize("raw, number", [("007", 7), ("0", 0), ("", None), (None, None), ("-5", -5)])
def test_numbers(spark, raw, number):
    assert one(spark, clean.to_number(text(raw), "smallint")) == number


def test_number_out_of_range(spark):
    assert one(spark, clean.to_number(text("40000"), "smallint", strict=False)) is None
    with pytest.raises(Exception, match="cannot read smallint from '40000'"):
        one(spark, clean.to_number(text("40000"), "smallint"))


@pytest.mark.parametrize("raw, valid", [
    ("12345678", True), ("1234567", False), ("123456789", False), ("1234567a", False),
    ("12345678\n", False), (" 12345678", False), ("", False),
])
def test_base_id_shape(spark, raw, valid):
    assert one(spark, clean.is_base_id(text(raw))) is valid


def test_base_id_pattern_is_a_parameter(spark):
    assert one(spark, clean.is_base_id(text("12AB5678"), r"^[0-9A-Z]{8}\z")) is True


@pytest.mark.parametrize("raw, valid", [("0", True), ("007", True), ("", False), ("x", False), (" 1", False),
                                        ("1\n", False)])
def test_code_shape(spark, raw, valid):
    assert one(spark, clean.is_code(text(raw))) is valid


@pytest.mark.parametrize("raw, state", [("", "??"), ("  ", "??"), (None, "??"), ("SP ", "SP"), ("EX", "EX")])
def test_state(spark, raw, state):
    assert one(spark, clean.state_or_unknown(text(raw))) == state


@pytest.mark.parametrize("area, number, joined", [
    ("11", "30001234", "1130001234"), ("", "", None), (None, "30001234", None), ("", "30001234", "30001234"),
    (" ", " ", None), ("11", None, None),
])
def test_phone(spark, area, number, joined):
    assert one(spark, clean.phone(text(area), text(number))) == joined


@pytest.mark.parametrize("raw, flag", [("S", True), ("s", True), ("N", False), ("n", False), ("", None),
                                       ("X", None), (None, None)])
def test_flags(spark, raw, flag):
    assert one(spark, clean.yes_no(text(raw))) is flag


@pytest.mark.parametrize("raw, cut, digits", [
    ("0", None, None), ("", None, None), (None, None, None),
    ("12345678000195", "12345678000195", "12345678000195"),
    ("12.345.678/0001-95", "12.345.678/000", "12345678000195"),
])
def test_partnership_id(spark, raw, cut, digits):
    assert one(spark, clean.partnership_id(text(raw))) == cut
    assert one(spark, clean.partnership_id(text(raw), digits=True)) == digits


def test_ids_and_labels(spark):
    assert one(spark, clean.digits_only(text("00.000.000/0001-91"))) == "00000000000191"
    assert one(spark, clean.base_id(text("00000000000191"))) == "00000000"
    assert one(spark, clean.month_label(text("/d/2026-01/Empresas0.zip"))) == "2026-01"
    assert one(spark, clean.month_label(text("/d/month=2026-02/x.parquet"))) == "2026-02"
    assert one(spark, clean.month_label(text("/d/2020-01/feeds/2026-02/x.zip"))) == "2026-02"
    assert one(spark, clean.month_label(text("/d/other/x.zip"))) is None
    assert one(spark, clean.without(text("a\u0000b"))) == "ab"


def test_latin9_repair_covers_every_byte(spark):
    raw = bytes(range(0xA0, 0x100))
    fixed = one(spark, clean.latin1_to_latin9(text(raw.decode("iso8859-1"))))
    assert fixed == raw.decode("iso8859-15")


@pytest.mark.parametrize("raw, basico, asked, valid", [
    ("12345678", "12345678", None, True), ("12345678000195", "12345678", "12345678000195", True),
    ("1234567890", None, None, False), ("", None, None, False), (None, None, None, False),
])
def test_split_registry_id(spark, raw, basico, asked, valid):
    assert tuple(one(spark, ids.split_registry_id(text(raw)))) == (basico, asked, valid)


@pytest.mark.parametrize("value, limit", [
    (None, 10), ("", 10), ("abc", 10), ("0", 10), ("-1", 10), ("7", 7), (7, 7), ("201", 200), ("+5", 5),
    (" 5", 10), ("1.5", 10), ("9" * 30, 10),
])
def test_clamp_limit(value, limit):
    assert ids.clamp_limit(value, 10, 200) == limit


def test_eight_digits_read_as_the_pattern_reads_them(spark):
    odd = ["20240229", "20230229", "00000101", "00010101", "99991231", "20241301", "20240100", "2024021\t", "\t20240215", " 20240215 ",
           "2024 215", "+2024021", "-2024021", "+120240101", "202402291", "2024-2-1", "２０２４０２２９", "20240215\n", "abcd0101", "0", None]
    rows = spark.createDataFrame([(t,) for t in odd], "t string")
    raw = F.when(~F.btrim("t").isin(*clean.NO_DATE), F.btrim("t"))
    got = rows.select("t", clean.parse_date(F.col("t"), strict=False).alias("d"), F.try_to_date(raw, clean.DATE_FORMAT).alias("e"))
    assert got.filter(~F.col("d").eqNullSafe(F.col("e"))).select("t", F.col("d").cast("string"), F.col("e").cast("string")).collect() == []


def test_digits_with_any_other_characters(spark):
    odd = ["00.000.000/0001-91", "12345678000195", "", "a1b2", "1 2", "１2", "./-", "1\n2", "€3.", None]
    rows = spark.createDataFrame([(t,) for t in odd], "t string")
    got = rows.select(clean.digits_only(F.col("t")).alias("d"), F.regexp_replace("t", "[^0-9]", "").alias("e")).collect()
    assert [r.d for r in got] == [r.e for r in got]


def test_a_strict_value_is_worked_out_once(spark):
    rows = spark.range(3).select(F.col("id").cast("string").alias("t"))
    assert plan_of(rows.select(clean.parse_date(F.col("t")).alias("d"))).lower().count("gettimestamp") == 1
    assert plan_of(rows.select(clean.to_number(F.col("t"), "smallint").alias("n"))).lower().count("try_cast(") == 1
