"""Widening: facts plus everything known about their goods, shop and place.

A missing dimension row gives zero or the empty text, as the wide records declare.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind import schemas
from tradewind.functions import geo, text, times
from tradewind.operators import changefeed, dims, ip_ranges
from tradewind.operators.dims import Dimensions
from tradewind.operators.lookup import lookup_join


def _number(name: str, kind: str = "int") -> Column:
    return F.coalesce(F.col(name).try_cast(kind), F.lit(0).cast(kind))


def _word(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def order_lines(changes: DataFrame, d: Dimensions, *, on_missing: str = "default",
                keep: list[str] | None = None) -> DataFrame:
    """Order-line changes widened by goods, shop, categories, city and region.

    `on_missing="drop"` leaves out lines whose category chain is incomplete.
    """
    if on_missing not in ("default", "drop"):
        raise ValueError(f"on_missing={on_missing!r}")
    lines = changes.select(*(keep or []), *changefeed.typed(schemas.ORDER_LINE), "eventType")
    return widen_lines(lines, d, on_missing=on_missing, keep=keep)


def widen_lines(lines: DataFrame, d: Dimensions, *, on_missing: str = "default",
                keep: list[str] | None = None) -> DataFrame:
    """The same for lines that are typed already."""
    wide = lookup_join(lines, dims.goods_profile(d), [("goodsId", "goodsKey")],
                       sized_by=dims.goods_profile_bound(d))
    if on_missing == "drop":
        wide = wide.filter(F.col("cat3Id").isNotNull() & F.col("cat2Id").isNotNull()
                           & F.col("cat1Id").isNotNull())
    event = ["eventType"] if "eventType" in lines.columns else []
    return wide.select(
        *(keep or []), "ogId", "orderId", "goodsId", "goodsNum", "goodsPrice",
        _word("goodsName").alias("goodsName"), _number("shopKey", "bigint").alias("shopId"),
        _number("cat3Id").alias("goodsThirdCatId"), _word("cat3Name").alias("goodsThirdCatName"),
        _number("cat2Id").alias("goodsSecondCatId"), _word("cat2Name").alias("goodsSecondCatName"),
        _number("cat1Id").alias("goodsFirstCatId"), _word("cat1Name").alias("goodsFirstCatName"),
        _number("areaId").alias("areaId"), _word("shopName").alias("shopName"),
        _word("shopCompany").alias("shopCompany"),
        _number("cityId").alias("cityId"), _word("cityName").alias("cityName"),
        _number("regionId").alias("regionId"), _word("regionName").alias("regionName"), *event)


def goods(changes: DataFrame, d: Dimensions) -> DataFrame:
    """Goods changes widened by shop, categories, shop categories, city and region.

    The two shop categories come out crossed: the id in `shopCatId2` is looked up and shown as
    `shopCatId1`, and the other way round. Consumers rely on that mapping, so it is kept.
    """
    fed = schemas.GOODS_LEADING + schemas.GOODS_MIDDLE + schemas.GOODS_TRAILING
    rows = changes.select(
        *changefeed.typed(fed), F.col("columns")["goodsCatId"].alias("_cat"),
        F.col("columns")["shopId"].try_cast("int").alias("_shop"),
        F.col("columns")["shopCatId1"].alias("_sc1"), F.col("columns")["shopCatId2"].alias("_sc2"))
    shop_cat = lambda n: d.shop_cats.select(
        F.col("catId").alias(f"_scid{n}"), F.col("catName").alias(f"_scname{n}"))
    wide = lookup_join(rows, dims.shop_profile(d).drop("shopCompany"), [("_shop", "shopKey")],
                       sized_by=[d.shops])
    wide = lookup_join(wide, dims.flatten_categories(d.goods_cats), [("_cat", "cat3Id")],
                       sized_by=[d.goods_cats])
    wide = lookup_join(wide, shop_cat(1), [("_sc2", "_scid1")], sized_by=[d.shop_cats])
    wide = lookup_join(wide, shop_cat(2), [("_sc1", "_scid2")], sized_by=[d.shop_cats])
    names = lambda group: [n for n, _ in group]
    return wide.select(
        *names(schemas.GOODS_LEADING), _word("shopName").alias("shopName"),
        *names(schemas.GOODS_MIDDLE),
        _number("cat3Id").alias("goodsThirdCatId"), _word("cat3Name").alias("goodsThirdCatName"),
        _number("cat2Id").alias("goodsSecondCatId"), _word("cat2Name").alias("goodsSecondCatName"),
        _number("cat1Id").alias("goodsFirstCatId"), _word("cat1Name").alias("goodsFirstCatName"),
        _word("_scid1").alias("shopCatId1"), _word("_scname1").alias("shopCatName1"),
        _word("_scid2").alias("shopCatId2"), _word("_scname2").alias("shopCatName2"),
        *names(schemas.GOODS_TRAILING),
        _number("cityId").alias("cityId"), _word("cityName").alias("cityName"),
        _number("regionId").alias("regionId"), _word("regionName").alias("regionName"))


def carts(messages: DataFrame, d: Dimensions, ranges: DataFrame, *, value: str = "value",
          keep: list[str] | None = None) -> DataFrame:
    """Cart messages widened by goods, categories, shop, place of shop and place of visitor.

    All or nothing: unless every goods, category, shop and place row exists, each added column
    stays at its default, the visitor's place included.
    """
    kept = keep or []
    rows = messages.select(*kept, text.parse_cart(F.col(value)).alias("c")).select(
        *kept, "c.goodsId", "c.userId", "c.count", "c.guid",
        times.millis_text(F.col("c.addTime")).alias("addTime"), "c.ip",
        F.col("c.goodsId").try_cast("bigint").alias("_g"))
    wide = lookup_join(rows, dims.goods_profile(d), [("_g", "goodsKey")],
                       sized_by=dims.goods_profile_bound(d))
    wide = ip_ranges.locate(wide, ranges)
    complete = F.lit(True)
    for part in ("shopKey", "cat3Id", "cat2Id", "cat1Id", "cityId", "regionId"):
        complete = complete & F.col(part).isNotNull()
    added = lambda source, kind="string": F.when(complete, source.try_cast(kind)).otherwise(
        F.lit("" if kind == "string" else 0).cast(kind))
    province, city = geo.region_split(F.col("country"))
    return wide.select(
        *kept, "goodsId", "userId", "count", "guid", "addTime", "ip",
        added(F.col("shopPrice"), "double").alias("goodsPrice"),
        added(F.col("goodsName")).alias("goodsName"),
        added(F.col("cat3Name")).alias("goodsCat3"), added(F.col("cat2Name")).alias("goodsCat2"),
        added(F.col("cat1Name")).alias("goodsCat1"),
        added(F.col("shopKey")).alias("shopId"), added(F.col("shopName")).alias("shopName"),
        added(F.col("regionId")).alias("shopProvinceId"),
        added(F.col("regionName")).alias("shopProvinceName"),
        added(F.col("cityId")).alias("shopCityId"), added(F.col("cityName")).alias("shopCityName"),
        added(province).alias("clientProvince"), added(city).alias("clientCity"))


def comments(messages: DataFrame, d: Dimensions, *, value: str = "value",
             keep: list[str] | None = None) -> DataFrame:
    """Comment messages widened by goods name and shop."""
    kept = keep or []
    rows = messages.select(*kept, text.parse_comment(F.col(value)).alias("c")).select(
        *kept, "c.userId", "c.userName", "c.orderGoodsId", "c.starScore", "c.comments",
        text.attachment("c"), times.millis_text(F.col("c.timestamp")).alias("createTime"),
        "c.goodsId", F.col("c.goodsId").try_cast("bigint").alias("_g"))
    named = d.goods.select(F.col("goodsId").alias("_gk"), "goodsName",
                           F.col("shopId").try_cast("bigint").alias("shopId"))
    wide = lookup_join(rows, named, [("_g", "_gk")], sized_by=[d.goods])
    return wide.select(
        *kept, "userId", "userName", "orderGoodsId", "starScore", "comments", "assetsViedoJSON",
        "createTime", "goodsId", _word("goodsName").alias("goodsName"),
        _number("shopId", "bigint").alias("shopId"))


def clicks(lines: DataFrame, ranges: DataFrame, *, value: str = "value",
           keep: list[str] | None = None) -> DataFrame:
    """Access-log lines parsed and placed: province and city of the visitor's address."""
    from tradewind.functions import weblog

    placed = ip_ranges.locate(weblog.parse(lines, value, keep=keep), ranges)
    province, city = geo.region_split(F.col("country"))
    return placed.select(
        *(keep or []), "uid", "ip", "requestTime", "requestMethod", "requestUrl",
        "requestProtocol", "responseStatus", "responseBodyBytes", "referer", "userAgent",
        "referDomain", province.alias("province"), city.alias("city"), "requestDateTime")
