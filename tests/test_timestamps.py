import numpy as np
from pyspark.sql import functions as F

from corpusloom.operators import timestamps as T

SETTINGS = [("a.test", "America/New_York", "mdy"), ("b.test", "Europe/Berlin", "dmy"), ("two.test", "Europe/London", "dmy"), ("two.test", "Asia/Kolkata", "dmy"), ("ind.test", "Asia/Kolkata", "dmy")]


def run(spark, rows, want):
    df = spark.createDataFrame([(i, h, v, "x") for i, (h, v) in enumerate(rows)], "i int, h string, v string, mask string")
    settings = spark.createDataFrame(SETTINGS, "host string, time_zone string, date_order string")
    got = T.normalise(df, F.col("v"), want, T.host_key(F.col("h")), settings).orderBy("i").select("stamp.*", "mask").collect()
    return [(r.normal, r.status) for r in got]


def test_instants(spark):
    rows = [
        ("a.test", "2019-01-05T07:41:40Z"), ("A.TEST", " 2019-01-05t07:41:40z "), ("a.test", "2021-11-07 01:30:00"), ("a.test", "2021-03-14 02:30:00"),
        ("a.test", "2021-11-07 01:30:00 EST"), ("https://www.b.test/x", "29.10.2020 01:29:55"), ("b.test", "3/4/2020 3:05 PM"), ("a.test", "3/4/2020 12:05 AM"),
        (None, "2020-01-01 00:00:00"), (None, "13/04/2020 10:00"), (None, "03/04/2020 10:00"), ("a.test", "1548164855165"), ("a.test", "1556031928.54"),
        ("ind.test", "2021-09-20 10:34:53 IST"), ("a.test", "Wed, 13 Mar 2019 00:20:51 -0600"), ("a.test", "0000-00-00 00:00:00"), ("a.test", "unknown"),
        ("a.test", None), ("a.test", ""), ("a.test", "2019-02-30T00:00:00Z"), ("two.test", "2020-06-01 00:00:00"), ("a.test", "2020-01-01"), ("a.test", "x" * 100_000),
        ("a.test", "20190108T034920Z"), ("a.test", "2019-01-14T15:17-06:00"), ("b.test", "2020-10-25 02:30:00"),
    ]
    got = run(spark, rows, "instant")
    assert [g[0] for g in got] == [
        "2019-01-05T07:41:40Z", "2019-01-05T07:41:40Z", None, None, "2021-11-07T06:30:00Z", "2020-10-29T00:29:55Z", "2020-04-03T13:05:00Z", "2020-03-04T05:05:00Z",
        None, None, None, "2019-01-22T13:47:35Z", "2019-04-23T15:05:28Z", "2021-09-20T05:04:53Z", "2019-03-13T06:20:51Z", None, None, None, None, None, None, None, None,
        "2019-01-08T03:49:20Z", "2019-01-14T21:17:00Z", None,
    ]
    status = [g[1] for g in got]
    assert status[2] == "ambiguous" and status[3] == "nonexistent" and status[8] == "no_zone" and status[9] == "no_zone" and status[10] == "ambiguous"
    assert status[15] == "impossible" and status[16] == "unparsed" and status[17] == status[18] == "empty" and status[19] == "impossible"
    assert status[20] == "no_zone" and status[21] == "no_time" and status[22] == "unparsed" and status[25] == "ambiguous"


def test_dates_and_years(spark):
    rows = [("a.test", v) for v in ("2006-08", "1997-98", "04/2010", "Dec. 1998", "Spring 1999", "March 15th, 1972", "28-Jul-1978", "MAY 22 2004", "[1969]", "c2011", "2013-2014", "5/2/2020", "19970201", "2009.13.01", "undated")]
    assert [g[0] for g in run(spark, rows, "date")] == ["2006-08", None, "2010-04", "1998-12", "1999", "1972-03-15", "1978-07-28", "2004-05-22", "1969", "2011", None, "2020-05-02", "1997-02-01", None, None]
    rows = [("a.test", v) for v in ("１９８７", "MCMXCI", "MMIX", "IIII", "Vol. 28 (1978)", "1993, rev. ed.", "1987.0", "1987.5", "9999", "0", "(2010)", "©1981", "c. 2006", "June 1978")]
    assert [g[0] for g in run(spark, rows, "year")] == ["1987", "1991", "2009", None, "1978", "1993", "1987", None, None, None, "2010", "1981", "2006", "1978"]


def test_zone_tables_match_the_library():
    from datetime import datetime, timezone
    from zoneinfo import ZoneInfo

    tables = T.zone_tables(["Australia/Sydney", "America/New_York", "nowhere"])
    assert set(tables["zones"]) == {"Australia/Sydney", "America/New_York"} and tables["version"]
    rng = np.random.default_rng(1)
    for name, zone in tables["zones"].items():
        utc = rng.integers(0, 2_000_000_000, 500)
        local = np.array([int(t + datetime.fromtimestamp(int(t), timezone.utc).astimezone(ZoneInfo(name)).utcoffset().total_seconds()) for t in utc])
        back, count = T.local_to_utc(zone, local)
        assert (count >= 1).all() and (back[count == 1] == utc[count == 1]).all()


def test_empty_table_and_found(spark):
    empty = spark.createDataFrame([], "i int, h string, v string")
    settings = spark.createDataFrame([], "host string, time_zone string, date_order string")
    assert T.normalise(empty, F.col("v"), "instant", F.col("h"), settings).count() == 0
    stamps = spark.createDataFrame([("date", 1, ("2020", "9999", "2020", "year", "converted")), ("date", 2, (" 2020", "9999", "2020", "year", "converted")), ("date", 3, ("x", "a", None, None, "unparsed"))], "src string, rec_id bigint, stamp struct<value: string, mask: string, normal: string, precision: string, status: string>")
    assert [tuple(r) for r in T.found(stamps).collect()] == [("date", 2, "2020")]
