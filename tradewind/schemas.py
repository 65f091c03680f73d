"""Record shapes. Field names, order and types are fixed values: they are the public
contract of the change feed, the messages and the wide records."""

from __future__ import annotations


def ddl(fields: list[tuple[str, str]]) -> str:
    """Fields as schema text, which every reader and parser takes."""
    return ", ".join(f"`{n}` {t}" for n, t in fields)


# One change of one database row; every column value arrives as text.
CHANGE = [
    ("logfileName", "string"), ("logfileOffset", "bigint"), ("executeTime", "bigint"),
    ("schemaName", "string"), ("tableName", "string"), ("eventType", "string"),
    ("columns", "map<string,string>"),
]

# One poll of the change log: entries with before and after images per changed row.
LOG_BATCH = (
    "entries array<struct<entryType:string,logfileName:string,logfileOffset:bigint,"
    "executeTime:bigint,schemaName:string,tableName:string,eventType:string,"
    "rowDatas:array<struct<beforeColumns:array<struct<name:string,value:string>>,"
    "afterColumns:array<struct<name:string,value:string>>>>>>"
)

# Order fact.
ORDER = [
    ("orderId", "bigint"), ("orderNo", "string"), ("userId", "bigint"),
    ("orderStatus", "int"), ("goodsMoney", "double"), ("deliverType", "int"),
    ("deliverMoney", "double"), ("totalMoney", "double"), ("realTotalMoney", "double"),
    ("payType", "int"), ("isPay", "int"), ("areaId", "int"), ("areaIdPath", "string"),
    ("userName", "string"), ("userAddress", "string"), ("userPhone", "string"),
    ("orderScore", "int"), ("isInvoice", "int"), ("invoiceClient", "string"),
    ("orderRemarks", "string"), ("orderSrc", "int"), ("needPay", "double"),
    ("payRand", "int"), ("orderType", "int"), ("isRefund", "int"), ("isAppraise", "int"),
    ("cancelReason", "int"), ("rejectReason", "int"), ("rejectOtherReason", "string"),
    ("isClosed", "int"), ("goodsSearchKeys", "string"), ("orderunique", "string"),
    ("receiveTime", "string"), ("deliveryTime", "string"), ("tradeNo", "string"),
    ("dataFlag", "int"), ("createTime", "string"), ("settlementId", "int"),
    ("commissionFee", "double"), ("scoreMoney", "double"), ("useScore", "int"),
    ("orderCode", "string"), ("extraJson", "string"), ("orderCodeTargetId", "int"),
    ("noticeDeliver", "int"), ("invoiceJson", "string"), ("lockCashMoney", "double"),
    ("payTime", "string"), ("isBatch", "int"), ("totalPayFee", "int"),
    ("isFromCart", "string"),
]

# Order line, before it is widened.
ORDER_LINE = [
    ("ogId", "bigint"), ("orderId", "bigint"), ("goodsId", "bigint"),
    ("goodsNum", "bigint"), ("goodsPrice", "double"),
]

# Goods row as it comes from the feed (all text but the key) and the keys it is widened by.
GOODS_LEADING = [
    ("goodsId", "bigint"), ("goodsSn", "string"), ("productNo", "string"),
    ("goodsName", "string"), ("goodsImg", "string"), ("shopId", "string"),
]
GOODS_MIDDLE = [
    ("goodsType", "string"), ("marketPrice", "string"), ("shopPrice", "string"),
    ("warnStock", "string"), ("goodsStock", "string"), ("goodsUnit", "string"),
    ("goodsTips", "string"), ("isSale", "string"), ("isBest", "string"),
    ("isHot", "string"), ("isNew", "string"), ("isRecom", "string"),
    ("goodsCatIdPath", "string"),
]
GOODS_TRAILING = [
    ("brandId", "string"), ("goodsDesc", "string"), ("goodsStatus", "string"),
    ("saleNum", "string"), ("saleTime", "string"), ("visitNum", "string"),
    ("appraiseNum", "string"), ("isSpec", "string"), ("gallery", "string"),
    ("goodsSeoKeywords", "string"), ("illegalRemarks", "string"), ("dataFlag", "string"),
    ("createTime", "string"), ("isFreeShipping", "string"),
    ("goodsSerachKeywords", "string"), ("modifyTime", "string"),
]

# Messages.
CART = [
    ("goodsId", "string"), ("userId", "string"), ("count", "int"),
    ("guid", "string"), ("addTime", "string"), ("ip", "string"),
]
# The attachment list travels under either of two names; readers accept both.
COMMENT = [
    ("userId", "string"), ("userName", "string"), ("orderGoodsId", "string"),
    ("starScore", "int"), ("comments", "string"), ("assetsViedoJSON", "string"),
    ("imageViedoJSON", "string"), ("goodsId", "string"), ("timestamp", "bigint"),
]

# Dimensions: source table -> (key column, fields).
DIMENSIONS = {
    "goods": ("goodsId", [("goodsId", "bigint"), ("goodsName", "string"),
                          ("shopId", "bigint"), ("goodsCatId", "int"),
                          ("shopPrice", "double")]),
    "goods_cats": ("catId", [("catId", "string"), ("parentId", "string"),
                             ("catName", "string"), ("cat_level", "string")]),
    "shops": ("shopId", [("shopId", "int"), ("areaId", "int"),
                         ("shopName", "string"), ("shopCompany", "string")]),
    "org": ("orgId", [("orgId", "int"), ("parentId", "int"),
                      ("orgName", "string"), ("orgLevel", "int")]),
    "shop_cats": ("catId", [("catId", "string"), ("parentId", "string"),
                            ("catName", "string"), ("catSort", "string")]),
}
