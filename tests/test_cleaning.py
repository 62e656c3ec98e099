import datetime as dt

from retailflow.functions import (
    digits_to_long,
    full_name,
    mean_of,
    normalize_postal,
    parse_mixed_date,
    ratio_pct,
    segment,
)


def test_mixed_date_layouts(spark):
    rows = [("2023-03-02",), ("03/02/2023",), ("02-03-2023",), ("20230302",), ("invalid",), (None,), ("2023-02-30",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r.d for r in df.select(parse_mixed_date("s").alias("d")).collect()]
    march2 = dt.date(2023, 3, 2)
    assert got == [march2, march2, march2, march2, None, None, None]


def test_separator_decides_day_month_order(spark):
    df = spark.createDataFrame([("02-03-2023",), ("02/03/2023",)], "s string")
    got = [r.d for r in df.select(parse_mixed_date("s").alias("d")).collect()]
    assert got == [dt.date(2023, 3, 2), dt.date(2023, 2, 3)]


def test_phone_digits(spark):
    df = spark.createDataFrame([("(555) 123-4567",), ("n/a",), (None,), ("555.1",)], "p string")
    got = [r.x for r in df.select(digits_to_long("p").alias("x")).collect()]
    assert got == [5551234567, None, None, 5551]


def test_postal_and_names(spark):
    df = spark.createDataFrame([(" ab 1 2 ", "A", "B"), (None, None, "B"), ("x", None, None)], "p string, f string, l string")
    got = df.select(normalize_postal("p").alias("p"), full_name("f", "l").alias("n")).collect()
    assert [(r.p, r.n) for r in got] == [("AB12", "A B"), (None, "B"), ("X", "")]


def test_ratio_and_segment(spark):
    df = spark.createDataFrame(
        [(10.0, 40.0), (5.0, 0.0), (5.0, -2.0), (1.0, None)], "n double, d double"
    )
    got = [r.x for r in df.select(ratio_pct("n", "d").alias("x")).collect()]
    assert got == [25.0, 0.0, 0.0, 0.0]
    seg = spark.createDataFrame([(10000.0,), (9999.99,), (5000.0,), (1000.0,), (999.0,), (None,), (-5.0,)], "v double")
    assert [r.s for r in seg.select(segment("v").alias("s")).collect()] == [
        "VIP", "Premium", "Premium", "Regular", "New", "New", "New",
    ]


def test_mean_skips_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.0,)], "v double")
    assert df.agg(mean_of("v").alias("m")).first().m == 1.5
    empty = spark.createDataFrame([(None,)], "v double")
    assert empty.agg(mean_of("v").alias("m")).first().m is None
