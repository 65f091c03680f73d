"""Dimensions: trees flattened once, and one profile row per goods.

Everything an order line, a cart entry or a comment needs follows from its goods id alone, so
the seven key lookups collapse into one prepared table and a single join on the fact side.
"""

from __future__ import annotations

import copy
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.operators.lookup import lookup_join, one_per_key


@dataclass(frozen=True)
class Dimensions:
    """The dimension tables of the shop."""

    goods: DataFrame
    goods_cats: DataFrame
    shops: DataFrame
    org: DataFrame
    shop_cats: DataFrame | None = None

    def __post_init__(self) -> None:
        """Snapshots may repeat a key; a fact must still meet one row of it."""
        for name, key in (("goods", "goodsId"), ("goods_cats", "catId"), ("shops", "shopId"), ("org", "orgId"), ("shop_cats", "catId")):
            rows = getattr(self, name)
            if rows is not None:
                object.__setattr__(self, name, one_per_key(rows, key))

    def with_goods(self, goods: DataFrame) -> Dimensions:
        """The same with other goods, which have one row a key; nothing is reduced once more."""
        other = copy.copy(self)
        object.__setattr__(other, "goods", goods)
        return other


def flatten_categories(cats: DataFrame) -> DataFrame:
    """Each category with its parent and its parent's parent; absent levels are null."""
    def level(n: int) -> DataFrame:
        return cats.select(F.col("catId").alias(f"cat{n}Id"), F.col("catName").alias(f"cat{n}Name"),
                           F.col("parentId").alias(f"_up{n}"))
    flat = lookup_join(level(3), level(2), [("_up3", "cat2Id")], sized_by=[cats])
    flat = lookup_join(flat, level(1), [("_up2", "cat1Id")], sized_by=[cats])
    return flat.drop("_up3", "_up2", "_up1")


def flatten_orgs(org: DataFrame) -> DataFrame:
    """Each organisation with its parent, as city and region."""
    city = org.select(F.col("orgId").alias("cityId"), F.col("orgName").alias("cityName"),
                      F.col("parentId").alias("_up"))
    region = org.select(F.col("orgId").alias("regionId"), F.col("orgName").alias("regionName"))
    return lookup_join(city, region, [("_up", "regionId")], sized_by=[org]).drop("_up")


def shop_profile(d: Dimensions) -> DataFrame:
    """Each shop with its city and region."""
    rows = d.shops.select(F.col("shopId").alias("shopKey"), "areaId", "shopName", "shopCompany")
    return lookup_join(rows, flatten_orgs(d.org), [("areaId", "cityId")], sized_by=[d.org])


def goods_profile(d: Dimensions) -> DataFrame:
    """One row per goods with its shop, city, region and three category levels.

    Levels that are missing stay null; the widening operators decide what null becomes.
    """
    rows = d.goods.select(
        F.col("goodsId").alias("goodsKey"), "goodsName", "shopPrice",
        F.col("goodsCatId").cast("string").alias("_cat"), F.col("shopId").try_cast("int").alias("_shop"))
    wide = lookup_join(rows, flatten_categories(d.goods_cats), [("_cat", "cat3Id")],
                       sized_by=[d.goods_cats])
    wide = lookup_join(wide, shop_profile(d), [("_shop", "shopKey")], sized_by=[d.shops])
    return wide.drop("_cat", "_shop")


def goods_profile_bound(d: Dimensions) -> list[DataFrame]:
    """Tables whose sizes bound the profile: it has exactly one row per goods."""
    return [d.goods]
