"""The dashboard: all panels in one JSON record, from one pass over each fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import text, times
from tradewind.operators.lookup import lookup_join

_TIME = "__time"


def _panels(dws: DataFrame, as_of) -> DataFrame:
    """The order fact reduced to areas, days and hours, with one column per figure.

    The first aggregate leaves at most areas x days x hours rows; grouping sets then give the
    three breakdowns of that small table without another pass over the fact.
    """
    ts = F.col(_TIME)
    money, count = F.col("totalMoney").cast("decimal(18,2)"), F.col("count")
    within = lambda length: times.since(ts, as_of, length)
    figures = {
        "o1": (within("1 DAY"), count), "o7": (within("7 DAY"), count),
        "o30": (within("30 DAY"), count), "s1": (within("1 DAY"), money),
        "sm": (within("1 MONTH"), money), "sh": (within("1 HOUR"), money),
        "tw": (within("6 DAY"), money), "lw": (times.shifted_week(ts, as_of), money),
    }
    earliest = F.least(times.before(as_of, "1 MONTH"), times.before(as_of, "30 DAY"))
    cells = (dws.filter(ts >= earliest)
             .groupBy("areaId", times.day_key(ts).alias("day"), F.hour(ts).alias("hour"))
             .agg(*[F.sum(F.when(c, v)).alias(n) for n, (c, v) in figures.items()]))
    sums = [F.sum(n).alias(n) for n in figures]
    return cells.groupingSets([["areaId"], ["day"], ["hour"]], "areaId", "day", "hour").agg(
        *sums, F.grouping("areaId").alias("_ga"), F.grouping("day").alias("_gd"),
        F.grouping("hour").alias("_gh"))


def _figure(name: str, kind: str = "bigint") -> Column:
    return F.coalesce(F.col(name).cast(kind), F.lit(0).cast(kind))


def _list(when: Column, *parts: Column) -> Column:
    """Rows of one breakdown as a list: as long as there are areas, days or hours."""
    return F.collect_list(F.when(when, F.struct(*parts)))


def dashboard(dws: DataFrame, areas: DataFrame, visitors: DataFrame, funnel: DataFrame,
              as_of) -> DataFrame:
    """One row, one column `document`.

    `visitors` is `metrics.visitors_on`, `funnel` is `metrics.funnel`: one row each.
    """
    names = areas.select(F.col("id").alias("_area"), F.col("name").alias("areaName"))
    rows = lookup_join(_panels(dws, as_of), names, [("areaId", "_area")], sized_by=[areas])
    by_area, by_day, by_hour = (F.col(g) == 0 for g in ("_ga", "_gd", "_gh"))
    area = [F.col("areaId"), F.col("areaName")]
    lists = rows.agg(
        _list(by_area & F.col("o1").isNotNull(), (-_figure("o1")).alias("rank"), *area,
              _figure("o1").alias("v")).alias("areaOrders"),
        _list(by_area & F.col("s1").isNotNull(), (-_figure("s1", "decimal(28,2)")).alias("rank"),
              *area, _figure("s1").alias("v")).alias("areaSales"),
        _list(by_day, F.col("day"), _figure("o7").alias("orders"), _figure("tw").alias("tw"),
              _figure("lw").alias("lw")).alias("days"),
        _list(by_hour, F.col("hour"), _figure("sh", "double").alias("v")).alias("hours"),
        *[F.sum(F.when(by_area, F.col(n))).alias(n) for n in ("o1", "o7", "o30", "s1", "sm")])

    today = times.as_of_literal(as_of).cast("date")

    def week(field: str, back: int = 0) -> Column:
        """Seven days up to `back` days ago, zero where the list has no such day."""
        def value(i):
            key = times.day_key(F.date_sub(today, (F.lit(6 + back) - i).cast("int")))
            hit = F.filter("days", lambda d: d["day"] == key)
            return F.coalesce(F.get(F.transform(hit, lambda d: d[field]), F.lit(0)),
                              F.lit(0).cast("bigint"))
        return F.transform(F.sequence(F.lit(0), F.lit(6)), value)

    weekdays = F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: times.weekday_label(
        F.date_sub(today, (F.lit(6) - i).cast("int"))))
    hour = lambda i: F.coalesce(F.get(F.transform(
        F.filter("hours", lambda h: h["hour"] == i), lambda h: h["v"]), F.lit(0)), F.lit(0.0))
    hours = F.sequence(F.lit(0), F.lit(23))
    named = lambda rows: F.filter(rows, lambda r: r["areaName"].isNotNull())
    pair = lambda r: F.struct(r["areaName"].alias("name"), r["v"].alias("value"))
    ranked = lambda c: F.sort_array(F.col(c))
    top8 = named(F.slice(ranked("areaOrders"), 1, 8))
    top4 = named(F.slice(ranked("areaSales"), 1, 4))
    counter = lambda label, value: F.struct(F.lit(label).alias("name"),
                                            value.cast("string").alias("value"))
    one_row = lambda df: df.select(F.struct(*df.columns).alias("r")).scalar()
    doc = lists.withColumn("_v", one_row(visitors)).withColumn("_f", one_row(funnel))
    return doc.select(F.to_json(F.struct(
        F.array(counter("PV", F.col("_v.pv")), counter("UV", F.col("_v.uv")),
                counter("总访客数", F.col("_v.ip"))).alias("visitor"),
        F.array(counter("浏览", F.col("_f.browse")), counter("加购物车", F.col("_f.cart")),
                counter("下单", F.col("_f.order")), counter("付款", F.col("_f.pay"))).alias("convert"),
        F.struct(weekdays.alias("xAxis"), week("tw").alias("week"),
                 week("lw", 7).alias("month")).alias("weekSale"),
        F.struct(_figure("o30").alias("mouthOrderNum"), _figure("o7").alias("weekOrderNum"),
                 _figure("o1").alias("dayOrderNum"),
                 # Areas without a name stay in this list as empty objects.
                 F.transform(ranked("areaOrders"), lambda r: F.array(F.when(
                     r["areaName"].isNull(), F.struct(F.lit(None).cast("string").alias("name"),
                                                      F.lit(None).cast("bigint").alias("value")))
                     .otherwise(pair(r)))).alias("data")).alias("orderNum"),
        F.struct(text.whole_padded(F.col("sm")).alias("monthSale"),
                 text.whole_padded(F.col("s1")).alias("daySale"),
                 F.transform(hours, lambda i: i.cast("string")).alias("xAxis"),
                 F.transform(hours, hour).alias("data")).alias("sales"),
        F.transform(top8, pair).alias("top8orderNum"),
        F.struct(weekdays.alias("xAxis"), week("orders").alias("data")).alias("weekOrderFinish"),
        F.struct(F.transform(top4, lambda r: r["areaName"]).alias("area"),
                 F.transform(top4, lambda r: r["v"]).alias("value")).alias("top4sale"),
        F.transform(named(ranked("areaOrders")), lambda r: F.array(pair(r))).alias("chinaMap"),
    )).alias("document"))


_PAIR = "struct<name:string,value:string>"
_SERIES = "xAxis:array<string>,data:array<string>"
_DOCUMENT = (
    f"visitor array<{_PAIR}>, convert array<{_PAIR}>, weekSale struct<xAxis:array<string>,week:array<string>,month:array<string>>, "
    f"orderNum struct<mouthOrderNum:string,weekOrderNum:string,dayOrderNum:string,data:array<array<{_PAIR}>>>, "
    f"sales struct<monthSale:string,daySale:string,{_SERIES}>, top8orderNum array<{_PAIR}>, weekOrderFinish struct<{_SERIES}>, "
    f"top4sale struct<area:array<string>,value:array<string>>, chinaMap array<array<{_PAIR}>>")


def entries(document: DataFrame) -> DataFrame:
    """The document taken apart again: (panel, position, name, value), one row per entry of each panel."""
    d = document.select(F.from_json("document", _DOCUMENT).alias("d")).select("d.*")
    series = lambda names, values: F.zip_with(names, values, lambda n, v: F.struct(n.alias("name"), v.alias("value")))
    one = lambda name, c: F.struct(F.lit(name).alias("name"), F.col(c).alias("value"))
    panels = {
        "visitor": F.col("visitor"), "convert": F.col("convert"),
        "weekSale.week": series(F.col("weekSale.xAxis"), F.col("weekSale.week")),
        "weekSale.month": series(F.col("weekSale.xAxis"), F.col("weekSale.month")),
        "orderNum": F.array(*[one(n, f"orderNum.{n}") for n in ("mouthOrderNum", "weekOrderNum", "dayOrderNum")]),
        "orderNum.data": F.flatten("orderNum.data"),
        "sales": F.array(*[one(n, f"sales.{n}") for n in ("monthSale", "daySale")]),
        "sales.data": series(F.col("sales.xAxis"), F.col("sales.data")),
        "top8orderNum": F.col("top8orderNum"),
        "weekOrderFinish": series(F.col("weekOrderFinish.xAxis"), F.col("weekOrderFinish.data")),
        "top4sale": series(F.col("top4sale.area"), F.col("top4sale.value")),
        "chinaMap": F.flatten("chinaMap"),
    }
    rows = d.select(F.explode(F.array(*[F.struct(F.lit(n).alias("panel"), e.alias("e")) for n, e in panels.items()])).alias("p"))
    return rows.select("p.panel", F.posexplode("p.e").alias("position", "e")).select(
        "panel", "position", "e.name", F.col("e.value").cast("double").alias("value"))
