import datetime as dt

import pytest
from pyspark.sql import functions as F

from bantin.functions import dates as D

NBSP = " "


def read(spark, texts, expr, journal="x"):
    df = spark.createDataFrame([(i, journal, t) for i, t in enumerate(texts)], "i int, journal string, t string")
    return [r.d for r in df.select("i", expr.alias("d")).orderBy("i").collect()]


def test_any_style(spark):
    cases = {
        "27/03/2024 14:24": dt.datetime(2024, 3, 27, 14, 24),
        f"27/03/2024 {NBSP} 14:24 (GMT+07:00)": dt.datetime(2024, 3, 27, 14, 24),
        "27/03/2024 14:24 (GMT+07:00)": dt.datetime(2024, 3, 27, 14, 24),
        "7/3/2024 9:05": dt.datetime(2024, 3, 7, 9, 5),
        "27/03/2024": dt.datetime(2024, 3, 27),
        "27/03/2024 14:24:05 +07:00": dt.datetime(2024, 3, 27, 14, 24, 5),
        "27/03/2024 14:24:05 +0700": dt.datetime(2024, 3, 27, 14, 24, 5),
        "2024-03-27T14:24:00+07:00": dt.datetime(2024, 3, 27, 14, 24),
        "2024-03-27T14:24:00Z": dt.datetime(2024, 3, 27, 14, 24),
        "2024-03-27 14:24": dt.datetime(2024, 3, 27, 14, 24),
        "03/04/2024": dt.datetime(2024, 4, 3),
        "1711524245": dt.datetime(2024, 3, 27, 7, 24, 5),
        "  27/03/2024 14:24  ": dt.datetime(2024, 3, 27, 14, 24),
        "31/02/2024": None,
        "27-03-2024": None,
        "junk": None,
        "": None,
        "99999999999999": None,
        None: None,
    }
    assert read(spark, list(cases), D.parse_date_any("t")) == list(cases.values())


def test_offset_can_be_honoured(spark):
    texts = ["27/03/2024 14:24:05 +07:00", "27/03/2024 14:24 (GMT+07:00)", "2024-03-27T14:24:00Z", "27/03/2024 14:24"]
    got = read(spark, texts, D.parse_date_any("t", honour_offset=True))
    assert got == [
        dt.datetime(2024, 3, 27, 7, 24, 5), dt.datetime(2024, 3, 27, 7, 24),
        dt.datetime(2024, 3, 27, 14, 24), dt.datetime(2024, 3, 27, 14, 24),
    ]


MINUTE = dt.datetime(2024, 3, 27, 14, 24)


@pytest.mark.parametrize("route, journal, text, expected", [
    ("stream", "vneconomy", "27/03/2024 14:24 (GMT+07:00)", MINUTE),
    ("stream", "saigontimes", "2024-03-27T14:24:00+07:00", MINUTE),
    ("stream", "vtc", "27/03/2024 14:24:05 +07:00", MINUTE),
    ("stream", "dantri", "2024-03-27 14:24", None),
    ("stream", "laodong", "7/3/2024 9:05", dt.datetime(2024, 3, 7, 9, 5)),
    ("store", "vneconomy", "27/03/2024 14:24", dt.datetime(2024, 3, 27)),
    ("store", "saigontimes", "2024-03-27T14:24:00", dt.datetime(2024, 3, 27)),
    ("store", "saigontimes", "27/03/2024", None),
    ("batch", "dantri", "2024-03-27 14:24", MINUTE),
    ("batch", "diendandoanhnghiep", "27/03/2024 14:24:05", dt.datetime(2024, 3, 27, 14, 24, 5)),
    ("batch", "diendandoanhnghiep", "27/03/2024 14:24", None),
    ("batch", "vtc", "27/03/2024 14:24:05 +0700", dt.datetime(2024, 3, 27, 7, 24, 5)),
    ("batch", "baodautu", " 27/03/2024 14:24 ", MINUTE),
    ("batch", "baodautu", "31/02/2024 14:24", None),
])
def test_routes(spark, route, journal, text, expected):
    assert read(spark, [text], D.parse_date("journal", "t", route), journal) == [expected]


@pytest.mark.parametrize("journal, text, expected", [
    ("baodautu", "27/03/2024 - 14:24", "27/03/2024 14:24"),
    ("vietnamnet", "Wed, 27/03/2024 - 14:24", " 27/03/2024 14:24"),
    ("vneconomy", "14:24 27/03/2024", "27/03/2024 14:24"),
    ("vneconomy", "27/03/2024", None),
    ("diendandoanhnghiep", "27/03/2024, 14:24:05", "27/03/2024 14:24:05"),
    ("nhipcaudautu", "Desk | 27/03/2024 14:24 ", "27/03/2024 14:24"),
    ("nhipcaudautu", "27/03/2024", None),
    ("phapluatdoisong", "T4, 27/03/2024 | 14:24", " 27/03/2024 14:24"),
    ("laodong", "T4, 27/03/2024 14:24", " 27/03/2024 14:24"),
    ("dantri", "2024-03-27 14:24", "2024-03-27 14:24"),
    ("other", "as is", "as is"),
])
def test_date_text(spark, journal, text, expected):
    assert read(spark, [text], D.clean_date_text("journal", "t"), journal) == [expected]


def test_month_day_millis(spark):
    df = spark.createDataFrame([("27/03/2024 14:24",)], "t string").select(D.parse_date_any("t").alias("d"))
    row = df.select(D.year_month("d").alias("m"), D.to_epoch_millis("d").alias("ms")).first()
    assert (row.m, row.ms) == ("2024-03", 1711549440000)


def test_results_do_not_depend_on_the_session_zone(spark):
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
        df = spark.createDataFrame([("27/03/2024 14:24",), ("1711524245",)], "t string")
        shown = df.select(
            F.date_format(D.parse_date_any("t"), "yyyy-MM-dd HH:mm:ss").alias("s"),
            D.to_epoch_millis(D.parse_date_any("t")).alias("ms"),
        ).collect()
        assert [tuple(r) for r in shown] == [("2024-03-27 14:24:00", 1711549440000), ("2024-03-27 07:24:05", 1711524245000)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
