"""Known inputs with known results."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tradewind.functions import geo, text, times, weblog
from tradewind.operators import patterns


def _events(spark, rows, names):
    """Rows whose last field is epoch seconds, numbered in arrival order."""
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], [*names, "n"])
    return df.withColumn("ts", F.timestamp_seconds("seconds"))


def test_fail_then_success(spark):
    rows = [(1, "192.168.0.1", "fail", 1558430842), (1, "192.168.0.2", "fail", 1558430843),
            (1, "192.168.0.3", "success", 1558430844), (2, "192.168.10.10", "success", 1558430845)]
    df = _events(spark, rows, ["user", "ip", "kind", "seconds"])
    got = patterns.strict_pair(df, "user", "ts", "n", F.col("kind") == "fail",
                               F.col("kind") == "success", 3, keep=["ip", "kind", "seconds"])
    assert [tuple(r) for r in got.collect()] == [(1, "192.168.0.3", "success", 1558430844)]


def test_repeated_message(spark):
    rows = [("1", "x", 1558430840 + s) for s in (2, 3, 5, 10, 11, 12)]
    df = _events(spark, rows, ["user", "msg", "seconds"])
    got = patterns.repeat_match(df, "user", "ts", "n", F.col("msg") == "x", 5, 10, keep=["seconds"])
    assert sorted(tuple(r)[:2] for r in got.collect()) == [("1", 1558430842), ("1", 1558430843)]


def test_within_is_strict(spark):
    df = _events(spark, [("1", "x", 100), ("1", "x", 110)], ["user", "msg", "seconds"])
    same = lambda within: patterns.repeat_match(
        df, "user", "ts", "n", F.col("msg") == "x", 2, within, keep=["seconds"]).count()
    assert (same(10), same(10.000001)) == (0, 1)


def test_same_message_five_times(spark):
    b, s = "beijing", "shanghai"
    order = [("1", b), ("1", b), ("1", b), ("1", b), ("2", s), ("3", b), ("3", b), ("4", b), ("5", s),
             ("4", b), ("5", s), ("5", s), ("5", b), ("6", b), ("6", b), ("6", b), ("5", s), ("6", b),
             ("6", b), ("5", s), ("6", s)]
    df = _events(spark, [(u, m, 1000) for u, m in order], ["user", "msg", "seconds"])
    got = patterns.repeat_match(df, "user", "ts", "n", F.col("msg").isNotNull(), 5, 10,
                                same="msg", keep=["msg", "n"])
    assert [tuple(r)[:3] for r in got.collect()] == [("6", b, 13)]


def test_paid_and_timed_out(spark):
    rows = [(1, "create", 1558430842), (2, "create", 1558430843), (2, "other", 1558430845),
            (2, "pay", 1558430850), (1, "pay", 1558431920)]
    df = _events(spark, rows, ["order", "status", "seconds"])
    got = patterns.followed_by_or_timeout(df, "order", "ts", "n", F.col("status") == "create",
                                          F.col("status") == "pay", 900, keep=["status"])
    assert {r["order"]: r["outcome"] for r in got.collect()} == {1: "timeout", 2: "paid"}


def test_three_steps_and_broken_pairs(spark):
    rows = [("r", "t", 120.0, 0), ("r", "p", 500.0, 1), ("r", "t", 130.0, 2), ("r", "t", 140.0, 3),
            ("r", "t", 150.0, 4)]
    df = _events(spark, rows, ["rack", "k", "value", "seconds"]).select(
        "rack", "ts", F.col("n").alias("event_id"), "value",
        F.when(F.col("k") == "t", "temperature").otherwise("power").alias("kind"))
    warnings = patterns.heat_warnings(df, 100.0)
    assert sorted(r["average"] for r in warnings.collect()) == [135.0, 145.0]
    assert [(r["first_id"], r["second_id"]) for r in patterns.heat_alerts(warnings).collect()] == [(3, 4)]
    hot = F.col("kind") == "temperature"
    three = patterns.sequence_match(
        df, "rack", "ts", "event_id", [patterns.Step(hot)] * 3, 10, keep=["event_id"])
    assert sorted((r["s0"]["event_id"], r["s1"]["event_id"], r["s2"]["event_id"])
                  for r in three.collect()) == [(0, 2, 3), (2, 3, 4)]


LINE = ('2001:980:91c0:1:8d31:a232:25e5:85d 222.68.172.190 - [05/Sep/2010:11:27:50 +0200] '
        '"GET /images/my.jpg HTTP/1.1" 404 23617 "http://www.angularjs.cn/A00n" '
        '"Mozilla/5.0 (Macintosh; U; Intel Mac OS X 10_6_4; nl-nl) AppleWebKit/533.17.8 '
        '(KHTML, like Gecko) Version/5.0.1 Safari/533.17.8"')


def test_log_line(spark):
    lines = [(0, LINE), (1, "not a log line"), (2, None),
             (3, r'- 1.2.3.4 - [05/Sep/2010:23:27:50 +0200] "GET /a" 304 - "-" "a \"quoted\" agent"')]
    rows = {r["n"]: r for r in weblog.parse(
        spark.createDataFrame(lines, "n int, value string"), keep=["n"]).collect()}
    got = rows[0].asDict()
    assert got["uid"] == "2001:980:91c0:1:8d31:a232:25e5:85d" and got["ip"] == "222.68.172.190"
    assert got["requestTime"] == "05/Sep/2010:11:27:50 +0200"
    assert (got["requestMethod"], got["requestUrl"], got["requestProtocol"]) == ("GET", "/images/my.jpg", "HTTP/1.1")
    assert (got["responseStatus"], got["responseBodyBytes"]) == (404, "23617")
    assert got["referDomain"] == "www.angularjs.cn" and got["userAgent"].endswith("Safari/533.17.8")
    assert got["requestDateTime"] == "2010-09-05 09:27:50"
    for n in (1, 2):
        assert all(v is None for k, v in rows[n].asDict().items() if k != "n")
    odd = rows[3]
    assert (odd["uid"], odd["referer"], odd["referDomain"], odd["requestMethod"]) == (None,) * 4
    assert (odd["responseBodyBytes"], odd["userAgent"]) == ("0", r'a \"quoted\" agent')


def test_extended_log_line(spark):
    line = LINE + ' "session=1" "10.0.0.9"'
    got = weblog.parse(spark.createDataFrame([(line,)], "value string"), extended=True).first()
    assert (got["cookie"], got["address"], got["ip"]) == ("session=1", "10.0.0.9", "222.68.172.190")


def test_regions(spark):
    want = {"江苏省无锡市": ("江苏省", "无锡市"), "北京市朝阳区": ("北京市", "朝阳区"), "北京市": ("北京", ""),
            "江苏省": ("江苏省", ""), "美国": ("美国", ""), "省内": ("省", "内"), "": ("", "")}
    df = spark.createDataFrame([(c,) for c in want], "c string")
    got = {r[0]: (r[1], r[2]) for r in df.select("c", *geo.region_split(F.col("c"))).collect()}
    assert got == want


def test_addresses(spark):
    want = {"1.2.3.4": 0x01020304, "255.255.255.255": 0xFFFFFFFF, "1.2.x.4": 0x01020000, "": 0,
            "300.1": (300 & 255) << 24 | 1 << 16, "1..2.3.4": 0x01020304, "1.2.3.4.5": 0x01020304}
    df = spark.createDataFrame([(c,) for c in want] + [(None,)], "c string")
    got = {r[0]: r[1] for r in df.select("c", geo.ip_number(F.col("c"))).collect()}
    assert got == {**want, None: None}
    back = spark.range(1).select(geo.ip_text(F.lit(0xDEADBEEF))).first()[0]
    assert back == "222.173.190.239"


def test_small_functions(spark):
    one = spark.range(1)
    value = lambda c: one.select(c).first()[0]
    assert value(text.zero_pad(F.lit(1000))) == "0000001000"
    assert value(text.zero_pad(F.lit(12345678901))) == "12345678901"
    assert value(text.whole_padded(F.lit(None).cast("double"))) == "0000000000"
    assert value(text.whole_padded(F.lit(12.99))) == "0000000012"
    assert value(times.weekday_label(F.lit("2024-01-28").cast("date"))) == "周日"
    assert value(times.millis_text(F.lit("1558430842000"))) == "2019-05-21 09:27:22"
    assert value(times.millis_text(F.lit("soon"))) is None
    assert value(times.datetime_text(times.log_time(F.lit("05/Sep/2010:13:27:50 +0200")))) == "2010-09-05 11:27:50"
    assert value(times.months_back(F.lit("2024-03-31").cast("date"), 1)) == "2024-02-29"
    assert value(geo.clean_area(F.lit(" CZ88.NET "))) == "本机或本网络"
    assert value(text.counter(F.lit('{"pn": 7, "on": 1.5}'), "pn")) == 7
    assert value(text.counter(F.lit('{"pn": 7, "on": 1.5}'), "on")) == 0
    assert value(text.counter(F.lit(None).cast("string"), "on")) == 0


def test_provinces(spark):
    rows = geo.province_table(spark).collect()
    assert len(rows) == 33 and len({r["name"] for r in rows}) == 33
    # Longitudes of the country lie between 73 and 135 degrees.
    assert all(73 < float(r["lon"]) < 135 and float(r["lat"]) < 54 for r in rows)


def test_status_bands(spark):
    drawn = spark.range(10, 101).select("id", text.status_band(F.col("id")).alias("s"))
    got = {r["id"]: r["s"] for r in drawn.collect()}
    assert [got[i] for i in (10, 11, 14, 15, 22, 23, 24, 30, 50, 51, 95, 96, 98, 100)] == [
        10, 1, 1, 2, 3, 4, 5, 6, 8, 9, 9, 10, 11, 11]


def test_as_of_bounds(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 24), ), (dt.datetime(2024, 1, 17),),
                                (dt.datetime(2024, 1, 16, 23, 59, 59),)], "t timestamp_ntz")
    assert df.filter(times.shifted_week(F.col("t"), "2024-01-31")).count() == 2
