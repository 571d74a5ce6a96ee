import datetime as dt

from pyspark.sql import functions as F

from sitebooks.functions import calendar, codes, money, text
from tests.conftest import rows


def one(spark, column, **values):
    """The value of an expression over one row of typed values."""
    frame = spark.range(1).select(*[v.alias(k) for k, v in values.items()])
    return frame.select(column.alias("out")).first()["out"]


def test_inverted_date(spark):
    assert one(spark, calendar.inverted_date(F.col("n")), n=F.lit(79759898)) == dt.date(2024, 1, 1)
    assert one(spark, calendar.inverted_date(F.col("n")), n=F.lit("79759898")) == dt.date(2024, 1, 1)
    assert one(spark, calendar.inverted_date(F.col("n")), n=F.lit(1)) is None


def test_usd_rate(spark):
    df = spark.createDataFrame(
        [("4.0-", "USD"), ("4.0", "USD"), ("0", "USD"), ("-4.0", "EUR"), ("x", "USD"), (None, "USD")],
        "rate string, target string",
    )
    got = [r[0] for r in df.select(money.usd_rate(F.col("rate"), F.col("target"))).collect()]
    assert got == [0.25, 0.25, None, -4.0, None, None]


def test_strip_zero_pair(spark):
    df = spark.createDataFrame([("0012",), ("0123",), ("00",), (None,)], "c string")
    got = [r[0] for r in df.select(codes.strip_zero_pair(F.col("c"))).collect()]
    assert got == ["12", "0123", "", None]


def test_fiscal_period_is_the_previous_month(spark):
    assert one(spark, calendar.fiscal_period(F.col("d")), d=F.lit(dt.date(2024, 1, 15))) == "012.2023"
    assert one(spark, calendar.fiscal_period(F.col("d")), d=F.lit(dt.date(2024, 3, 31))) == "002.2024"


def test_month_names_only(spark):
    labels = [("June",), (" jun ",), ("JUNK",), ("MARGIN",), ("September",), ("",), (None,)]
    df = spark.createDataFrame(labels, "m string")
    assert [r[0] for r in df.select(calendar.month_number(F.col("m"))).collect()] == [6, 6, None, None, 9, None, None]


def test_long_codes_stay_whole(spark):
    df = spark.createDataFrame([("00" + "7" * 1500,)], "c string")
    assert df.select(codes.strip_zero_pair(F.col("c"))).first()[0] == "7" * 1500


def test_months_both_ways(spark):
    df = spark.createDataFrame([("Jan",), ("DEC ",), ("september",), ("FY",), (None,)], "m string")
    number = calendar.month_number(F.col("m"))
    got = [tuple(r) for r in df.select(number, calendar.month_label(number)).collect()]
    assert got == [(1, "JAN"), (12, "DEC"), (9, "SEP"), (None, None), (None, None)]


def test_product_class(spark):
    df = spark.createDataFrame(
        [("frei 2",), ("frei (2)",), ("LXPXG",), (None,), ("AdBlue pump",)], "p string"
    )
    got = [r[0] for r in df.select(codes.product_class(F.col("p"), ("frei (2)", "l.p.g"), "road")).collect()]
    assert got == ["frei 2", "road", "LXPXG", "road", "road"]
    got = [r[0] for r in df.select(codes.product_class(F.col("p"))).collect()]
    assert got[4] == "AdBlue pump" and got[3] == codes.DEFAULT_PRODUCT_CLASS


def test_composite_key_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([("a", 1), ("a", None)], "x string, y int")
    got = [r[0] for r in df.select(codes.composite_key(F.col("x"), F.col("y"))).collect()]
    assert got == ["a1", None]


def test_recode_and_aliases(spark):
    df = spark.createDataFrame([("USA",), ("Peru",), (None,)], "c string")
    got = [r[0] for r in df.select(codes.recode(F.col("c"), codes.COUNTRY_ALIASES)).collect()]
    assert got == ["United States of America", "Peru", None]


def test_year_ranges_reach_the_scan(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    kept = orders.where(calendar.in_year(F.col("o_orderdate"), 1998))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_paths(spark):
    paths = [
        "s3://b/feed/NL/2024/03/part.parquet",
        "file:/x/country=DE/year=2023/month=12/part.parquet",
        "file:/x/part.parquet",
    ]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = rows(df.select(*text.period_from_path(F.col("p"))))
    assert got == [("", None, None), ("DE", 2023, 12), ("NL", 2024, 3)]
    day = spark.createDataFrame([("/a/2024/1/05/f",), ("/a/f",), ("/a/2024/13/41/f",)], "p string")
    got = [r[0] for r in day.select(text.date_from_path(F.col("p"))).collect()]
    assert got == [dt.date(2024, 1, 5), None, None]


def test_queue_and_share(spark):
    df = spark.createDataFrame([(3, 5), (3, 2), (0, 1)], "o int, d int")
    got = [r[0] for r in df.select(money.bounded_queue(F.col("o"), F.col("d"))).collect()]
    assert got == [0, 2, 0]
    assert one(spark, money.share(F.col("a"), F.col("b")), a=F.lit(1), b=F.lit(0)) is None


def test_last_complete_years(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2021, 12, 31),), (dt.datetime(2022, 1, 1),), (dt.datetime(2023, 12, 31, 23),), (dt.datetime(2024, 1, 1),)],
        "t timestamp",
    )
    kept = df.where(calendar.last_complete_years(F.col("t"), dt.date(2024, 5, 1)))
    assert kept.count() == 2
