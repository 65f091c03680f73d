"""The registered queries in plain SQL over the same tables, written independently of the
operators: history by ranking, ranges by BETWEEN, sequences by window functions."""

from __future__ import annotations

from tradewind import schemas
from tradewind.functions.text import STATUS_BANDS
from tradewind.functions.times import WEEKDAYS

EV = "TIMESTAMP '2024-01-31 00:00:00'"
OD = "TIMESTAMP '2001-08-02 00:00:00'"
DT = "'%Y-%m-%d %H:%M:%S'"

ORACLES: dict[str, str] = {}


def sql(name: str, body: str, *ctes: str) -> None:
    ORACLES[name] = (f"WITH {', '.join(ctes)} " if ctes else "") + body


def null(fields) -> str:
    kinds = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE"}
    return ", ".join(f"CAST(NULL AS {kinds[t]}) AS {n}" for n, t in fields)


def money(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def weekday(d: str) -> str:
    return f"[{', '.join(repr(w) for w in WEEKDAYS)}][CAST(dayofweek({d}) AS INTEGER) + 1]"


def province(c: str) -> str:
    return (f"CASE WHEN contains(rtrim({c}, '省'), '省') THEN split_part({c}, '省', 1) || '省' "
            f"WHEN contains(rtrim({c}, '市'), '市') THEN split_part({c}, '市', 1) || '市' "
            f"ELSE rtrim({c}, '市') END")


def city(c: str) -> str:
    return (f"CASE WHEN contains(rtrim({c}, '省'), '省') THEN split_part({c}, '省', 2) "
            f"WHEN contains(rtrim({c}, '市'), '市') THEN split_part({c}, '市', 2) ELSE '' END")


# ---- shared views -----------------------------------------------------------------------

GOODS = """goods AS (SELECT p_partkey AS goodsId, p_name AS goodsName,
  p_partkey % (SELECT count(*) FROM supplier) AS shopId,
  CAST(CASE WHEN p_size = 50 THEN 1050 ELSE p_size END AS INTEGER) AS goodsCatId,
  p_retailprice AS shopPrice FROM part)"""
CATS = """goods_cats AS (
  SELECT DISTINCT CAST(p_size AS VARCHAR) AS catId, CAST(100 + p_size % 10 AS VARCHAR) AS parentId,
    'cat-' || p_size AS catName, '3' AS cat_level FROM part
  UNION ALL SELECT DISTINCT CAST(100 + p_size % 10 AS VARCHAR), CAST(200 + p_size % 10 % 3 AS VARCHAR),
    'cat-' || (100 + p_size % 10), '2' FROM part
  UNION ALL SELECT DISTINCT CAST(200 + p_size % 10 % 3 AS VARCHAR), '0',
    'cat-' || (200 + p_size % 10 % 3), '1' FROM part)"""
SHOPS = """shops AS (SELECT CAST(s_suppkey AS INTEGER) AS shopId, s_nationkey AS areaId,
  s_name AS shopName, 'co-' || s_name AS shopCompany FROM supplier)"""
ORG = """org AS (SELECT n_nationkey AS orgId, 1000 + n_regionkey AS parentId, n_name AS orgName, 2 AS orgLevel
  FROM nation UNION ALL SELECT 1000 + r_regionkey, 0, r_name, 1 FROM region)"""
SHOP_CATS = """shop_cats AS (SELECT DISTINCT CAST(p_size % 7 AS VARCHAR) AS catId,
  CAST(p_size % 7 % 2 AS VARCHAR) AS parentId, 'shopcat-' || (p_size % 7) AS catName,
  CAST(p_size % 7 AS VARCHAR) AS catSort FROM part)"""
DIM_CTES = {"goods": GOODS, "goods_cats": CATS, "shops": SHOPS, "org": ORG, "shop_cats": SHOP_CATS}
PROFILE = """profile AS (SELECT g.goodsId, g.goodsName, g.shopPrice, s.shopId, s.areaId, s.shopName, s.shopCompany,
  a.catId AS cat3Id, a.catName AS cat3Name, b.catId AS cat2Id, b.catName AS cat2Name,
  c.catId AS cat1Id, c.catName AS cat1Name, o.orgId AS cityId, o.orgName AS cityName,
  r.orgId AS regionId, r.orgName AS regionName
  FROM goods g LEFT JOIN shops s ON s.shopId = g.shopId
  LEFT JOIN goods_cats a ON a.catId = CAST(g.goodsCatId AS VARCHAR)
  LEFT JOIN goods_cats b ON b.catId = a.parentId LEFT JOIN goods_cats c ON c.catId = b.parentId
  LEFT JOIN org o ON o.orgId = s.areaId LEFT JOIN org r ON r.orgId = o.parentId)"""
DIMS = (GOODS, CATS, SHOPS, ORG, PROFILE)
AREAS = """areas AS (SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name,
  CAST(100 + n_nationkey AS VARCHAR) AS lon, CAST(20 + n_nationkey AS VARCHAR) AS lat FROM nation)"""
RANGES = """ranges AS (SELECT CAST(n_nationkey AS BIGINT) * 171798691 AS lo,
  CAST(n_nationkey AS BIGINT) * 171798691 + 100000000 AS hi,
  CASE n_nationkey % 3 WHEN 0 THEN n_name || '省' || n_name || '市'
    WHEN 1 THEN n_name || '市' || n_name || '区' ELSE n_name END AS country,
  CASE WHEN n_nationkey % 4 = 0 THEN '本机或本网络' ELSE 'area-' || n_name END AS area FROM nation)"""


def dotted(n: str) -> str:
    return (f"CAST(({n}) >> 24 AS VARCHAR) || '.' || (({n}) >> 16 & 255) || '.' || (({n}) >> 8 & 255) "
            f"|| '.' || (({n}) & 255)")


VISITS = f"""numbered AS (SELECT *, ((user_id * 3 + event_id % 3) * 2654435761) % 4294967296 AS num FROM events),
  visits AS (SELECT *, 'u' || user_id AS guid, {dotted('num')} AS ip FROM numbered)"""
PLACED = """placed AS (SELECT v.*, coalesce(r.country, '未知国家') AS country, coalesce(r.area, '未知地区') AS area
  FROM visits v LEFT JOIN ranges r ON v.num BETWEEN r.lo AND r.hi)"""
DWS_E = """dws AS (SELECT ts AS "__time", CAST(user_id % 28 AS INTEGER) AS areaId,
  CASE WHEN event_type = 'purchase' THEN 2 ELSE 0 END AS orderStatus, value AS totalMoney, 1 AS n FROM events)"""
DWS_O = """dws AS (SELECT o_orderdate AS "__time", CAST(o_custkey % 28 AS INTEGER) AS areaId,
  CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 0 END AS orderStatus, o_totalprice AS totalMoney, 1 AS n
  FROM orders WHERE o_orderstatus <> 'P')"""
LINES = """lines AS (SELECT l_orderkey * 10 + l_linenumber AS ogId, l_orderkey AS orderId, l_partkey AS goodsId,
  CAST(l_quantity AS BIGINT) AS goodsNum, l_extendedprice / l_quantity AS goodsPrice,
  CASE l_returnflag WHEN 'A' THEN 'insert' WHEN 'N' THEN 'update' ELSE 'delete' END AS eventType,
  epoch_us(l_shipdate) // 1000 AS executeTime,
  CAST((l_partkey * 100000 + l_suppkey) * 1000 + l_quantity AS BIGINT) AS logfileOffset,
  l_shipdate AS createTime FROM lineitem)"""

# ---- sources, change feed ---------------------------------------------------------------

sql("t8_once_each", "SELECT logfileOffset, eventType, ogId, orderId, goodsId, goodsNum, goodsPrice FROM lines", LINES)
sql("s4_log_flatten", """SELECT 'log.000001' AS logfileName, orderId AS logfileOffset, executeTime, 'shop' AS schemaName,
  'order_goods' AS tableName, eventType, CAST(ogId + shift AS VARCHAR) AS ogId, CAST(goodsId AS VARCHAR) AS goodsId,
  CASE WHEN eventType = 'delete' THEN 'before' ELSE 'after' END AS image
  FROM lines, (VALUES (0), (1000000000)) s(shift)""", LINES)

_LABEL = {"goods": "goodsName", "goods_cats": "catName", "shops": "shopName", "org": "orgName", "shop_cats": "catName"}
for _t, (_key, _fields) in schemas.DIMENSIONS.items():
    _names = [n for n, _ in _fields]
    sql(f"s5_dim_{_t}", f"SELECT {', '.join(_names)} FROM {_t}", DIM_CTES[_t])
    sql(f"x11_json_{_t}", f"SELECT {', '.join(_names)} FROM {_t}", DIM_CTES[_t])
    _cols = ", ".join(f"{n} || '#' || v AS {n}" if n == _LABEL[_t] else n for n in _names)
    _k = f"CAST({_key} AS BIGINT)"
    sql(f"k2_state_{_t}", f"""SELECT {', '.join(_names)} FROM (SELECT {_cols}, op,
      row_number() OVER (PARTITION BY {_key} ORDER BY v DESC) AS rn
      FROM {_t}, (VALUES (1, 'insert'), (2, 'update'), (3, 'delete'), (4, 'insert')) h(v, op)
      WHERE v <= 2 OR (v = 3 AND {_k} % 5 = 0) OR (v = 4 AND {_k} % 10 = 0)) WHERE rn = 1 AND op <> 'delete'""",
        DIM_CTES[_t])

sql("s6_fact_by_sql", "SELECT areaId, orderStatus, count(*) AS orders FROM dws GROUP BY ALL", DWS_O)

WIDE = """coalesce(goodsName, '') AS goodsName, coalesce(CAST(shopId AS BIGINT), 0) AS shopId,
  coalesce(CAST(cat3Id AS INTEGER), 0) AS goodsThirdCatId, coalesce(cat3Name, '') AS goodsThirdCatName,
  coalesce(CAST(cat2Id AS INTEGER), 0) AS goodsSecondCatId, coalesce(cat2Name, '') AS goodsSecondCatName,
  coalesce(CAST(cat1Id AS INTEGER), 0) AS goodsFirstCatId, coalesce(cat1Name, '') AS goodsFirstCatName,
  coalesce(areaId, 0) AS areaId, coalesce(shopName, '') AS shopName, coalesce(shopCompany, '') AS shopCompany,
  coalesce(cityId, 0) AS cityId, coalesce(cityName, '') AS cityName,
  coalesce(regionId, 0) AS regionId, coalesce(regionName, '') AS regionName"""
BASE = "ogId, orderId, l.goodsId AS goodsId, goodsNum, goodsPrice"
LATEST = """latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ogId
  ORDER BY executeTime DESC, logfileOffset DESC) AS rn FROM lines) WHERE rn = 1 AND eventType <> 'delete')"""
_state = f"SELECT {BASE}, {WIDE} FROM latest l LEFT JOIN profile p ON p.goodsId = l.goodsId"
sql("k3_line_state", _state, LINES, LATEST, *DIMS)
sql("k4_line_job", _state, LINES, LATEST, *DIMS)
_wide = f"SELECT {BASE}, {WIDE}, eventType FROM lines l LEFT JOIN profile p ON p.goodsId = l.goodsId"
sql("j1_order_lines", _wide, LINES, *DIMS)
sql("j1_order_lines_drop", _wide + " WHERE cat3Id IS NOT NULL AND cat2Id IS NOT NULL AND cat1Id IS NOT NULL",
    LINES, *DIMS)
_ARRIVAL = """arrival AS (SELECT l_partkey AS arrived, min(l_shipdate) + (l_partkey % 5) * INTERVAL 12 HOUR AS since FROM lineitem
  GROUP BY l_partkey)"""
sql("j1_lines_await_goods", f"""SELECT {BASE}, {WIDE}, eventType FROM lines l LEFT JOIN arrival a ON arrived = l.goodsId
  LEFT JOIN profile p ON p.goodsId = l.goodsId AND (l.goodsId % 3 = 0 OR since <= createTime + INTERVAL 1 DAY)""",
    LINES, _ARRIVAL, *DIMS)
sql("f3_inserted_lines", _wide + " WHERE eventType = 'insert'", LINES, *DIMS)

_EVENT = "CASE WHEN o_orderstatus = 'P' THEN 'update' ELSE 'insert' END"
_STATUS = "CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'P' THEN 1 ELSE 0 END"
sql("k1_order_json_job", f"""SELECT o_orderkey AS orderId, o_custkey AS userId, CAST({_STATUS} AS INTEGER) AS orderStatus,
  o_totalprice AS totalMoney, CAST(o_custkey % 28 AS INTEGER) AS areaId,
  strftime(o_orderdate, {DT}) AS createTime FROM orders WHERE o_orderstatus <> 'P'""")
sql("f1_one_table", f"""SELECT 'orders' AS tableName, {_EVENT} AS eventType, o_orderkey AS logfileOffset,
  CAST(o_orderkey AS VARCHAR) AS orderId FROM orders""")
_ALL_DIMS = " UNION ALL ".join(
    f"SELECT '{t}' AS tableName, CAST({k} AS BIGINT) AS k FROM {t}" for t, (k, _) in schemas.DIMENSIONS.items())
_HISTORY = f"""history AS (SELECT tableName, op AS eventType FROM ({_ALL_DIMS}),
  (VALUES (1, 'insert'), (2, 'update'), (3, 'delete'), (4, 'insert'), (5, 'truncate')) h(v, op)
  WHERE v IN (1, 2, 5) OR (v = 3 AND k % 5 = 0) OR (v = 4 AND k % 10 = 0))"""
sql("f2_dimension_tables", "SELECT tableName, eventType, count(*) AS changes FROM history GROUP BY ALL",
    *DIM_CTES.values(), _HISTORY)
sql("f3_inserts", f"""SELECT o_orderkey AS logfileOffset, 'insert' AS eventType, CAST({_STATUS} AS VARCHAR) AS orderStatus
  FROM orders WHERE o_orderstatus <> 'P'""")
sql("f4_actions", f"""SELECT eventType, CASE WHEN eventType IN ('insert', 'update') THEN 'upsert'
  WHEN eventType = 'delete' THEN 'delete' ELSE 'ignore' END AS action, count(*) AS changes
  FROM (SELECT eventType FROM history UNION ALL SELECT {_EVENT} FROM orders) GROUP BY ALL""",
    *DIM_CTES.values(), _HISTORY)
sql("f5_with_payload", "SELECT logfileOffset, eventType, 5 AS fields FROM lines WHERE eventType <> 'delete'", LINES)
sql("f7_since", f"""SELECT count(*) FILTER ("__time" >= {OD} - INTERVAL 7 DAY) AS week,
  count(*) FILTER ("__time" >= {OD} - INTERVAL 48 HOUR) AS two_days,
  count(*) FILTER ("__time" >= {OD} - INTERVAL 1 MONTH) AS month,
  count(*) FILTER ("__time" >= {OD} - INTERVAL 1 YEAR) AS year FROM dws""", DWS_O)
_LASTWEEK = f'"__time" BETWEEN {EV} - INTERVAL 14 DAY AND {EV} - INTERVAL 7 DAY'
sql("f8_shifted_week", f'SELECT "__time", areaId, totalMoney FROM dws WHERE {_LASTWEEK}', DWS_E)
sql("f9_finished", 'SELECT "__time", areaId, totalMoney FROM dws WHERE orderStatus = 2', DWS_E)

_SET = {
    "orderId": "o_orderkey", "orderNo": "'NO' || o_orderkey", "userId": "o_custkey",
    "orderStatus": f"CAST({_STATUS} AS INTEGER)", "totalMoney": "o_totalprice", "realTotalMoney": "o_totalprice",
    "isPay": "CAST(CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END AS INTEGER)",
    "areaId": "CAST(o_custkey % 28 AS INTEGER)",
    "orderScore": "CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END",
    "createTime": f"strftime(o_orderdate, {DT})", "isFromCart": "CAST(o_orderkey % 2 AS VARCHAR)",
}
sql("f10_order_entity", "SELECT " + ", ".join(
    f"{_SET[n]} AS {n}" if n in _SET else null([(n, t)]) for n, t in schemas.ORDER) + " FROM orders")

# ---- joins ------------------------------------------------------------------------------

_fed = {"goodsSn": "'SN' || g.goodsId", "goodsName": "g.goodsName", "shopId": "CAST(g.shopId AS VARCHAR)",
        "goodsType": "q.p_type", "shopPrice": "CAST(g.shopPrice AS VARCHAR)", "brandId": "q.p_brand",
        "goodsId": "g.goodsId"}
_part = lambda group: ", ".join(f"{_fed[n]} AS {n}" if n in _fed else null([(n, t)]) for n, t in group)
sql("j2_goods", f"""SELECT {_part(schemas.GOODS_LEADING)}, coalesce(p.shopName, '') AS shopName,
  {_part(schemas.GOODS_MIDDLE)},
  coalesce(CAST(cat3Id AS INTEGER), 0) AS goodsThirdCatId, coalesce(cat3Name, '') AS goodsThirdCatName,
  coalesce(CAST(cat2Id AS INTEGER), 0) AS goodsSecondCatId, coalesce(cat2Name, '') AS goodsSecondCatName,
  coalesce(CAST(cat1Id AS INTEGER), 0) AS goodsFirstCatId, coalesce(cat1Name, '') AS goodsFirstCatName,
  coalesce(x.catId, '') AS shopCatId1, coalesce(x.catName, '') AS shopCatName1,
  coalesce(y.catId, '') AS shopCatId2, coalesce(y.catName, '') AS shopCatName2,
  {_part(schemas.GOODS_TRAILING)},
  coalesce(cityId, 0) AS cityId, coalesce(cityName, '') AS cityName,
  coalesce(regionId, 0) AS regionId, coalesce(regionName, '') AS regionName
  FROM goods g JOIN part q ON q.p_partkey = g.goodsId JOIN profile p ON p.goodsId = g.goodsId
  LEFT JOIN shop_cats x ON x.catId = CAST(q.p_size % 2 AS VARCHAR)
  LEFT JOIN shop_cats y ON y.catId = CAST(q.p_size % 7 AS VARCHAR)""", *DIMS, SHOP_CATS)
_OK = "(shopId IS NOT NULL AND cat3Id IS NOT NULL AND cat2Id IS NOT NULL AND cat1Id IS NOT NULL AND cityId IS NOT NULL AND regionId IS NOT NULL)"
_if = lambda x: f"CASE WHEN {_OK} THEN CAST({x} AS VARCHAR) ELSE '' END"
_GOODS_OF = "event_id % (SELECT count(*) + 5 FROM part)"
sql("j3_carts", f"""SELECT event_id, CAST({_GOODS_OF} AS VARCHAR) AS goodsId, CAST(user_id AS VARCHAR) AS userId,
  CAST(1 + event_id % 3 AS INTEGER) AS count, guid, strftime(ts, {DT}) AS addTime, ip,
  CASE WHEN {_OK} THEN shopPrice ELSE 0.0 END AS goodsPrice, {_if('goodsName')} AS goodsName,
  {_if('cat3Name')} AS goodsCat3, {_if('cat2Name')} AS goodsCat2, {_if('cat1Name')} AS goodsCat1,
  {_if('shopId')} AS shopId, {_if('shopName')} AS shopName, {_if('regionId')} AS shopProvinceId,
  {_if('regionName')} AS shopProvinceName, {_if('cityId')} AS shopCityId, {_if('cityName')} AS shopCityName,
  {_if(province('country'))} AS clientProvince, {_if(city('country'))} AS clientCity
  FROM placed v LEFT JOIN profile p ON p.goodsId = v.{_GOODS_OF}""", *DIMS, VISITS, RANGES, PLACED)
_ATTACH = "'[img' || event_id || ']'"
_COMMENT = f"""event_id, CAST(user_id AS VARCHAR) AS userId, guid AS userName, CAST(event_id AS VARCHAR) AS orderGoodsId,
  CAST(1 + event_id % 5 AS INTEGER) AS starScore, event_type AS comments, {_ATTACH} AS assetsViedoJSON"""
sql("j4_comments", f"""SELECT {_COMMENT}, strftime(ts, {DT}) AS createTime, CAST({_GOODS_OF} AS VARCHAR) AS goodsId,
  coalesce(g.goodsName, '') AS goodsName, coalesce(CAST(g.shopId AS BIGINT), 0) AS shopId
  FROM visits v LEFT JOIN goods g ON g.goodsId = v.{_GOODS_OF}""", GOODS, VISITS)
sql("j5_ip_places", "SELECT event_id, ip, country, area FROM placed", VISITS, RANGES, PLACED)
sql("j6_category_tree", """SELECT a.catId AS cat3Id, a.catName AS cat3Name, b.catId AS cat2Id, b.catName AS cat2Name,
  c.catId AS cat1Id, c.catName AS cat1Name FROM goods_cats a LEFT JOIN goods_cats b ON b.catId = a.parentId
  LEFT JOIN goods_cats c ON c.catId = b.parentId""", CATS)
sql("j7_org_tree", """SELECT a.orgId AS cityId, a.orgName AS cityName, b.orgId AS regionId, b.orgName AS regionName
  FROM org a LEFT JOIN org b ON b.orgId = a.parentId""", ORG)
_DAY = f'"__time" >= {EV} - INTERVAL 1 DAY'
_BY_AREA = f"by_area AS (SELECT areaId, count(*) AS orders, {money('totalMoney')} AS sales FROM dws WHERE {_DAY} GROUP BY areaId)"
sql("j8_named_areas", "SELECT areaId, orders, name AS areaName FROM by_area JOIN areas ON id = areaId", DWS_E, AREAS, _BY_AREA)
sql("j8_named_areas_all", "SELECT areaId, orders, name AS areaName FROM by_area LEFT JOIN areas ON id = areaId",
    DWS_E, AREAS, _BY_AREA)
sql("j9_located_areas", """SELECT areaId, orders, name AS areaName, lon, lat FROM by_area LEFT JOIN areas ON id = areaId""",
    DWS_E, AREAS, _BY_AREA)
_BAND = "CASE " + " ".join(f"WHEN drawn >= {lo} THEN {s}" for lo, s in STATUS_BANDS) + " ELSE drawn END"
ORDERS = f"""drawn AS (SELECT *, o_orderkey * 2654435761 % 4294967296 % 91 + 10 AS drawn FROM orders),
  ords AS (SELECT o_orderkey AS orderId, o_custkey AS userId, CAST({_BAND} AS INTEGER) AS orderStatus,
  o_totalprice AS totalMoney, o_totalprice AS realTotalMoney, o_orderdate AS createTime FROM drawn)"""
_REFUND = "refunds AS (SELECT o.orderId AS orderId, l.goodsId AS goodsId FROM lines l RIGHT OUTER JOIN ords o ON l.orderId = o.orderId WHERE o.orderStatus IN (10, 11))"
sql("j11_refund_lines", "SELECT orderId, goodsId FROM refunds", LINES, ORDERS, _REFUND)
sql("j12_line_created", """SELECT ogId, l.orderId AS orderId, goodsId, coalesce(o.createTime, l.createTime) AS createTime
  FROM lines l LEFT JOIN ords o ON o.orderId = l.orderId""", LINES, ORDERS)
sql("j12_refund_money", f"""SELECT r.orderId AS orderId, r.goodsId AS goodsId, coalesce(p.payPrice, -1.0) AS backMoney
  FROM refunds r LEFT JOIN (SELECT orderId, goodsId, {money('goodsPrice * goodsNum')} AS payPrice FROM lines GROUP BY ALL) p
  ON p.orderId = r.orderId AND p.goodsId = r.goodsId""", LINES, ORDERS, _REFUND)

# ---- aggregations -----------------------------------------------------------------------

_ROLLUP = f"""SELECT date_trunc('minute', o_orderdate) AS "__time", CAST(o_custkey % 28 AS INTEGER) AS areaId,
  CAST({_STATUS} AS INTEGER) AS orderStatus, count(*) AS count, {money('o_totalprice')} AS totalMoney
  FROM orders WHERE o_orderstatus <> 'P'"""
sql("a0_order_rollup", _ROLLUP + " GROUP BY ALL")
sql("a0_rollup_stream", _ROLLUP + " GROUP BY ALL")
_DAILY = """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS pv, count(DISTINCT guid) AS uv,
  count(DISTINCT ip) AS ip FROM visits"""
sql("a1_daily_visitors", _DAILY + " GROUP BY 1", VISITS)
sql("a1_visitors_by_sketch", f"""SELECT CAST(d AS INTEGER) AS days, count(ts) AS pv, true AS uv_near, true AS ip_near
  FROM (VALUES (1), (7), (30)) t(d) LEFT JOIN events ON CAST(ts AS DATE) <= CAST({EV} AS DATE)
  AND CAST(ts AS DATE) > CAST({EV} AS DATE) - d GROUP BY d""")
sql("a1_visitors_stream", _DAILY + " GROUP BY 1", VISITS)
sql("a1_visitors_on_day", """SELECT d AS day, count(event_id) AS pv, count(DISTINCT guid) AS uv, count(DISTINCT ip) AS ip
  FROM (VALUES ('2024-01-30'), ('2024-02-10')) t(d) LEFT JOIN visits ON strftime(ts, '%Y-%m-%d') = d GROUP BY d""", VISITS)
_FUNNEL = """f AS (SELECT count(*) FILTER (event_type = 'view') AS browse, count(*) FILTER (event_type = 'click') AS cart,
  count(*) FILTER (event_type = 'signup') AS "order", count(*) FILTER (event_type = 'purchase') AS pay FROM events)"""
sql("a2_funnel", """SELECT browse, cart, "order", pay, round(cart / browse, 6) AS cart_rate,
  round("order" / cart, 6) AS order_rate, round(pay / "order", 6) AS pay_rate FROM f""", _FUNNEL)


def recent(as_of: str, length: str) -> str:
    return f'"__time" >= {as_of} - INTERVAL {length}'


for _n, _as_of, _len, _dws in (
    ("a3_orders_1d", EV, "1 DAY", DWS_E), ("a4_orders_7d", EV, "7 DAY", DWS_E),
    ("a5_orders_30d", OD, "30 DAY", DWS_O), ("a14_orders_month", OD, "1 MONTH", DWS_O),
    ("a15_orders_year", OD, "1 YEAR", DWS_O),
):
    sql(_n, f"SELECT count(*) AS orders FROM dws WHERE {recent(_as_of, _len)}", _dws)
sql("a6_orders_by_area", "SELECT areaId, orders FROM by_area", DWS_E, _BY_AREA)
_SPINE = f"""spine AS (SELECT CAST(i AS INTEGER) AS pos, CAST({EV} AS DATE) - CAST(6 - i AS INTEGER) AS d,
  CAST({EV} AS DATE) - CAST(13 - i AS INTEGER) AS e FROM generate_series(0, 6) g(i))"""
_PER_DAY = lambda where: f"(SELECT CAST(\"__time\" AS DATE) AS d, CAST(trunc({money('totalMoney')}) AS BIGINT) AS s, count(*) AS n FROM dws WHERE {where} GROUP BY 1)"
sql("a7_week_sales", f"""SELECT pos, strftime(spine.d, '%Y-%m-%d') AS day, {weekday('spine.d')} AS weekday,
  coalesce(t.s, 0) AS sales, strftime(spine.e, '%Y-%m-%d') AS last_day, {weekday('spine.e')} AS last_weekday,
  coalesce(l.s, 0) AS last_sales FROM spine LEFT JOIN {_PER_DAY(recent(EV, '6 DAY'))} t ON t.d = spine.d
  LEFT JOIN {_PER_DAY(_LASTWEEK)} l ON l.d = spine.e""", DWS_E, _SPINE)


def padded(x: str) -> str:
    t = f"CAST(CAST(trunc(coalesce({x}, 0)) AS BIGINT) AS VARCHAR)"
    return f"CASE WHEN length({t}) < 10 THEN lpad({t}, 10, '0') ELSE {t} END"


sql("a8_month_sales", f"SELECT {padded(money('totalMoney'))} AS sales FROM dws WHERE {recent(OD, '1 MONTH')}", DWS_O)
sql("a9_day_sales", f"SELECT {padded(money('totalMoney'))} AS sales FROM dws WHERE {recent(EV, '1 DAY')}", DWS_E)
for _n, _len in (("a10_sales_by_hour", "1 HOUR"), ("a10_sales_by_hour_day", "24 HOUR")):
    sql(_n, f"""SELECT CAST(h AS INTEGER) AS hour, coalesce({money('totalMoney')}, 0.0) AS sales
      FROM generate_series(0, 23) g(h) LEFT JOIN dws ON hour("__time") = h AND {recent(EV, _len)} GROUP BY h""", DWS_E)
sql("a11_top_areas", """SELECT areaId, orders, name AS areaName FROM
  (SELECT * FROM by_area ORDER BY orders DESC, areaId LIMIT 8) JOIN areas ON id = areaId""", DWS_E, AREAS, _BY_AREA)
sql("a12_orders_by_day", f"""SELECT pos, strftime(spine.d, '%Y-%m-%d') AS day, {weekday('spine.d')} AS weekday,
  coalesce(t.n, 0) AS orders FROM spine LEFT JOIN {_PER_DAY(recent(EV, '7 DAY'))} t ON t.d = spine.d""", DWS_E, _SPINE)
sql("a13_top_sales", """SELECT areaId, sales, name AS areaName FROM
  (SELECT * FROM by_area ORDER BY sales DESC, areaId LIMIT 4) JOIN areas ON id = areaId""", DWS_E, AREAS, _BY_AREA)
sql("a16_orders_by_time", f'SELECT "__time", count(*) AS orders FROM dws WHERE {recent(EV, "7 DAY")} GROUP BY 1', DWS_E)
sql("a17_orders_by_area_orders", f"SELECT areaId, count(*) AS orders FROM dws WHERE {recent(OD, '30 DAY')} GROUP BY 1", DWS_O)
sql("a18_top_finished_areas", f"""SELECT areaId, count(*) AS orders FROM dws WHERE orderStatus = 2 AND {_DAY}
  GROUP BY 1 ORDER BY orders DESC, areaId LIMIT 10""", DWS_E)
sql("a19_finished_by_day", f"""SELECT CAST(day("__time") AS INTEGER) AS day, count(*) AS orders FROM dws
  WHERE orderStatus = 2 AND {recent(EV, '7 DAY')} GROUP BY 1 ORDER BY orders DESC, 1 LIMIT 10""", DWS_E)
sql("a20_hour_sales", f"""SELECT CAST(hour("__time") AS INTEGER) AS hour, {money('totalMoney')} AS sales FROM dws
  WHERE {recent(EV, '1 HOUR')} GROUP BY 1""", DWS_E)
sql("a20_month_sales", f"SELECT {money('totalMoney')} AS sales FROM dws WHERE {recent(OD, '1 MONTH')}", DWS_O)
sql("a21_year_sales", f"SELECT {money('totalMoney')} AS sales FROM dws WHERE {recent(OD, '1 YEAR')}", DWS_O)
sql("a22_views_per_user", "SELECT user_id, round(sum(value), 4) AS views FROM events GROUP BY 1 ORDER BY 1")
_AMOUNTS = f"""amounts AS (SELECT orderId, {money('goodsPrice * goodsNum')} AS amount FROM lines
  WHERE createTime >= TIMESTAMP '1995-01-01' AND createTime < TIMESTAMP '2001-09-01' GROUP BY 1)"""
sql("a23_order_amounts", "SELECT orderId, amount FROM amounts", LINES, _AMOUNTS)
sql("a23_write_back", """SELECT o.orderId AS orderId, userId, orderStatus, coalesce(amount, totalMoney) AS totalMoney,
  coalesce(amount, realTotalMoney) AS realTotalMoney, createTime FROM ords o LEFT JOIN amounts a ON a.orderId = o.orderId""",
    LINES, ORDERS, _AMOUNTS)
_ONE = lambda agg, where: f"(SELECT {agg} FROM dws WHERE {where})"
_TOP = lambda by, n: f"(SELECT * FROM by_area ORDER BY {by} DESC, areaId LIMIT {n}) t JOIN areas ON id = areaId"
_TXT = lambda x: f"CAST({x} AS VARCHAR)"
_WHOLE = f"CAST(trunc(coalesce({money('totalMoney')}, 0)) AS BIGINT)"
_ON = lambda d, where: f"{where} AND CAST(\"__time\" AS DATE) = DATE '{d}'"
sql("a25_dashboard_fields", f"""SELECT
  {_TXT("(SELECT count(*) FROM visits WHERE CAST(ts AS DATE) = DATE '2024-01-30')")} AS pv,
  {_TXT("(SELECT count(DISTINCT guid) FROM visits WHERE CAST(ts AS DATE) = DATE '2024-01-30')")} AS uv,
  {_TXT("(SELECT count(DISTINCT ip) FROM visits WHERE CAST(ts AS DATE) = DATE '2024-01-30')")} AS visitor_ips,
  {_TXT("(SELECT pay FROM f)")} AS paid,
  {_TXT(_ONE('count(*)', recent(EV, '30 DAY')))} AS month_orders,
  {_TXT(_ONE('count(*)', recent(EV, '7 DAY')))} AS week_orders,
  {_TXT(_ONE('count(*)', recent(EV, '1 DAY')))} AS day_orders,
  {_ONE(padded(money('totalMoney')), recent(EV, '1 MONTH'))} AS month_sale,
  {_ONE(padded(money('totalMoney')), recent(EV, '1 DAY'))} AS day_sale,
  {_TXT(_ONE(_WHOLE, _ON('2024-01-31', recent(EV, '6 DAY'))))} AS this_week_last_day,
  {_TXT(_ONE(_WHOLE, _ON('2024-01-30', recent(EV, '6 DAY'))))} AS this_week_day_6,
  {_TXT(_ONE(_WHOLE, _ON('2024-01-18', _LASTWEEK)))} AS last_week_day_1,
  {_TXT(_ONE('count(*)', _ON('2024-01-28', recent(EV, '7 DAY'))))} AS orders_day_4,
  (SELECT name FROM {_TOP('sales', 4)} ORDER BY sales DESC, areaId LIMIT 1) AS best_area,
  {_TXT(f"(SELECT orders FROM {_TOP('orders', 8)} ORDER BY orders DESC, areaId LIMIT 1)")} AS most_orders""",
    DWS_E, AREAS, _BY_AREA, VISITS, _FUNNEL)
_ENTRY = lambda panel, pos, name, value: f"SELECT '{panel}' AS panel, CAST({pos} AS INTEGER) AS position, {name} AS name, CAST({value} AS DOUBLE) AS value "
_SEEN = lambda agg: f"(SELECT {agg} FROM visits WHERE CAST(ts AS DATE) = DATE '2024-01-30')"
_DAYS = lambda panel, value, where, day: _ENTRY(panel, "pos", weekday("spine.d"), f"coalesce(t.{value}, 0)") + (
    f"FROM spine LEFT JOIN {_PER_DAY(where)} t ON t.d = spine.{day}")
_RANKED = lambda by: f"(SELECT *, row_number() OVER (ORDER BY {by} DESC, areaId) AS r FROM by_area LEFT JOIN areas ON id = areaId)"
_NAMED = lambda panel, by, top: _ENTRY(panel, "row_number() OVER (ORDER BY r) - 1", "name", f"trunc({by})") + (
    f"FROM {_RANKED(by)} WHERE name IS NOT NULL AND r <= {top}")
sql("a25_dashboard", " UNION ALL ".join([
    *[_ENTRY("visitor", i, f"'{n}'", _SEEN(a)) for i, (n, a) in enumerate(
        {"PV": "count(*)", "UV": "count(DISTINCT guid)", "总访客数": "count(DISTINCT ip)"}.items())],
    *[_ENTRY("convert", i, f"'{n}'", f'(SELECT "{c}" FROM f)') for i, (n, c) in enumerate(
        {"浏览": "browse", "加购物车": "cart", "下单": "order", "付款": "pay"}.items())],
    _DAYS("weekSale.week", "s", recent(EV, "6 DAY"), "d"), _DAYS("weekSale.month", "s", _LASTWEEK, "e"),
    *[_ENTRY("orderNum", i, f"'{n}'", _ONE("count(*)", recent(EV, t))) for i, (n, t) in enumerate(
        {"mouthOrderNum": "30 DAY", "weekOrderNum": "7 DAY", "dayOrderNum": "1 DAY"}.items())],
    _ENTRY("orderNum.data", "r - 1", "name", "CASE WHEN name IS NOT NULL THEN orders END") + f"FROM {_RANKED('orders')}",
    *[_ENTRY("sales", i, f"'{n}'", _ONE(_WHOLE, recent(EV, t))) for i, (n, t) in enumerate(
        {"monthSale": "1 MONTH", "daySale": "1 DAY"}.items())],
    _ENTRY("sales.data", "i", "CAST(i AS VARCHAR)", "coalesce(s, 0)") + f"""FROM generate_series(0, 23) g(i) LEFT JOIN
      (SELECT hour("__time") AS h, {money('totalMoney')} AS s FROM dws WHERE {recent(EV, '1 HOUR')} GROUP BY 1) ON h = i""",
    _NAMED("top8orderNum", "orders", 8), _DAYS("weekOrderFinish", "n", recent(EV, "7 DAY"), "d"),
    _NAMED("top4sale", "sales", 4), _NAMED("chinaMap", "orders", 1 << 30)]),
    DWS_E, AREAS, _BY_AREA, VISITS, _FUNNEL, _SPINE)
ORACLES["a25_dashboard_live"] = ORACLES["a25_dashboard"]
sql("a26_orders_per_customer", """SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS position,
  o_orderkey AS value, count(*) OVER (PARTITION BY o_custkey) AS length FROM orders""")
sql("o3_latest_goods", "SELECT goodsId, goodsName FROM goods ORDER BY goodsId DESC LIMIT 10", GOODS)

# ---- scalar functions -------------------------------------------------------------------

_LOGTIME = "strftime(ts, '%d/%b/%Y:%H:%M:%S')"
_LOG = f"""event_id, guid AS uid, ip, {_LOGTIME} || ' +0000' AS requestTime, 'GET' AS requestMethod,
  '/goods/' || event_id || '.html' AS requestUrl, 'HTTP/1.1' AS requestProtocol,
  CAST(CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS INTEGER) AS responseStatus,
  CAST(event_id * 7 AS VARCHAR) AS responseBodyBytes, 'http://www.shop-' || user_id || '.cn/' || event_type AS referer,
  'Mozilla/5.0 (agent ' || user_id || ')' AS userAgent, 'www.shop-' || user_id || '.cn' AS referDomain,
  strftime(ts, {DT}) AS requestDateTime"""
sql("x1_log_fields", f"SELECT {_LOG} FROM visits", VISITS)
sql("x1_extended_fields", f"""SELECT {_LOG}, 'session=' || event_id AS cookie, '10.0.0.' || (event_id % 250) AS address
  FROM visits""", VISITS)
sql("click_log_wide", f"SELECT {_LOG}, {province('country')} AS province, {city('country')} AS city FROM placed",
    VISITS, RANGES, PLACED)
sql("x2_log_time", f"""SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
  ELSE strftime(ts - INTERVAL 2 HOUR, {DT}) END AS at FROM events""")
sql("x4_millis_text", f"SELECT event_id, strftime(ts, {DT}) AS at FROM events")
_SHORT = """cut AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN split_part(country, '省', 1) || '省'
  WHEN 1 THEN split_part(country, '市', 1) || '市' ELSE country END AS c FROM placed)"""
sql("x5_region_split", f"SELECT event_id, {province('c')} AS province, {city('c')} AS city FROM cut", VISITS, RANGES, PLACED, _SHORT)
sql("x6_ip_number", """SELECT event_id, CASE WHEN event_type = 'error' THEN (num >> 16) << 16 ELSE num END AS number
  FROM visits""", VISITS)
_BIG = "CASE WHEN event_type = 'view' THEN event_id + 12345678901 ELSE event_id END"
sql("x7_zero_pad", f"""SELECT event_id, CASE WHEN length(t) < 10 THEN lpad(t, 10, '0') ELSE t END AS padded
  FROM (SELECT event_id, CAST({_BIG} AS VARCHAR) AS t FROM events)""")
sql("x8_weekdays", f"SELECT {weekday('ts')} AS weekday, count(*) AS events FROM events GROUP BY 1")
sql("x9_date_shift", """SELECT o_orderkey, strftime(o_orderdate - INTERVAL 7 DAY, '%Y-%m-%d') AS week_before,
  strftime(o_orderdate - INTERVAL 1 MONTH, '%Y-%m-%d') AS month_before,
  strftime(o_orderdate - INTERVAL 1 YEAR, '%Y-%m-%d') AS year_before FROM orders""")
sql("x10_time_parts", """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, substr(CAST(ts AS VARCHAR), 1, 10) AS day_cut,
  CAST(hour(ts) AS INTEGER) AS hour, CAST(day(ts) AS INTEGER) AS day_of_month FROM events""")
sql("x11_cart_messages", f"""SELECT event_id, CAST({_GOODS_OF} AS VARCHAR) AS goodsId, CAST(user_id AS VARCHAR) AS userId,
  CAST(1 + event_id % 3 AS INTEGER) AS count, guid, CAST(epoch_us(ts) // 1000 AS VARCHAR) AS addTime, ip FROM visits""", VISITS)
sql("x11_comment_messages", f"""SELECT {_COMMENT}, CAST({_GOODS_OF} AS VARCHAR) AS goodsId, epoch_us(ts) // 1000 AS timestamp
  FROM visits""", VISITS)
sql("x12_order_json", f"""SELECT o_orderkey AS orderId, 'NO' || o_orderkey AS orderNo, CAST({_STATUS} AS VARCHAR) AS orderStatus,
  CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE substr(o_orderpriority, 1, 1) END AS orderScore,
  strftime(o_orderdate, {DT}) AS createTime,
  CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 10 ELSE 11 END AS INTEGER) AS fields FROM orders""")
sql("x13_range_search", f"""SELECT {dotted('lo')} AS beginIp, {dotted('hi')} AS endIp, country, area FROM ranges
  WHERE contains(country, '1') OR contains(area, '1')""", RANGES)
sql("x14_clean_area", "SELECT lo AS begin, area FROM ranges", RANGES)
sql("x15_counters", """SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN 0
  ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k, 0 AS absent FROM events""")
sql("x16_status_bands", "SELECT orderId, orderStatus FROM ords", ORDERS)
sql("x17_line_amount", "SELECT ogId, goodsId, round(goodsPrice * goodsNum, 2) AS payPrice FROM lines", LINES)
sql("x18_month_start", f"""SELECT o_orderkey, strftime(o_orderdate, '%Y/%m/%d') AS day,
  strftime(date_trunc('month', o_orderdate), {DT}) AS month FROM orders""")

# ---- patterns ---------------------------------------------------------------------------

_W = "(PARTITION BY user_id ORDER BY ts, event_id)"
sql("c1_fail_then_success", f"""SELECT user_id, nid AS event_id, nts AS ts, nt AS event_type FROM
  (SELECT user_id, event_type, ts, lead(event_id) OVER {_W} AS nid, lead(ts) OVER {_W} AS nts, lead(event_type) OVER {_W} AS nt
   FROM events) WHERE event_type = 'error' AND nt = 'signup' AND nts - ts < INTERVAL 6 HOUR""")
sql("c2a_repeated", f"""SELECT user_id, event_id, ts, last_ts FROM
  (SELECT user_id, event_id, ts, lead(ts, 4) OVER {_W} AS last_ts FROM events WHERE event_type = 'view')
  WHERE epoch_us(last_ts) - epoch_us(ts) < 5 * 86400000000""")
sql("c2b_repeated_same", f"""SELECT user_id, event_id, ts, event_type, last_ts FROM
  (SELECT user_id, event_id, ts, event_type, lead(ts, 2) OVER {_W} AS last_ts, lead(event_type) OVER {_W} AS b,
   lead(event_type, 2) OVER {_W} AS c FROM events WHERE event_type IS NOT NULL)
  WHERE event_type = b AND b = c AND epoch_us(last_ts) - epoch_us(ts) < 2 * 86400000000""")
_PAIRS = """pairs AS (SELECT user_id, event_id, ts, event_type, min(CASE WHEN event_type = 'purchase' THEN ts END)
  OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS p FROM events),
  outcomes AS (SELECT user_id, event_id, ts, CASE WHEN epoch_us(p) - epoch_us(ts) < 43200000000 THEN p END AS paid_ts
  FROM pairs WHERE event_type = 'click')"""
_OUT = "SELECT user_id, event_id, ts, CASE WHEN paid_ts IS NULL THEN 'timeout' ELSE 'paid' END AS outcome, paid_ts FROM outcomes"
sql("c3_paid_or_timeout", _OUT, _PAIRS)
sql("t4_paid_or_timeout_stream", _OUT, _PAIRS)
sql("c4_unpaid_orders", f"""SELECT o_orderkey AS orderId, o_custkey AS userId, o_totalprice AS totalMoney,
  CASE WHEN ok THEN 'paid' ELSE 'timeout' END AS outcome,
  CASE WHEN ok THEN strftime(o_orderdate + to_minutes(o_orderkey % 30), {DT}) END AS paid_at
  FROM (SELECT *, o_orderstatus <> 'P' AND o_orderkey % 30 < 15 AS ok FROM orders)""")
sql("c4_unpaid_orders_job", """SELECT o_orderkey AS orderId, o_custkey AS userId, o_totalprice AS totalMoney,
  CAST(0 AS INTEGER) AS isPay FROM orders WHERE NOT (o_orderstatus <> 'P' AND o_orderkey % 30 < 15)""")
_HEAT = """readings AS (SELECT user_id % 10 AS rack, ts, event_id, event_type IN ('view', 'click', 'purchase') AS warm, value FROM events),
  nexts AS (SELECT rack, ts, value, warm, lead(ts) OVER w AS nts, lead(event_id) OVER w AS nid, lead(warm) OVER w AS nwarm,
    lead(value) OVER w AS nvalue FROM readings WINDOW w AS (PARTITION BY rack ORDER BY ts, event_id)),
  warnings AS (SELECT rack, nts AS ts, nid AS event_id, (value + nvalue) / 2 AS average FROM nexts
    WHERE warm AND nwarm AND value > 50 AND nvalue > 50 AND epoch_us(nts) - epoch_us(ts) < 7200000000)"""
sql("c5a_heat_warnings", "SELECT rack, ts, event_id, round(average, 4) AS average FROM warnings", _HEAT)
sql("c5b_heat_alerts", """SELECT rack, event_id AS first_id, nid AS second_id, nts AS ts FROM
  (SELECT *, lead(ts) OVER w AS nts, lead(event_id) OVER w AS nid, lead(average) OVER w AS navg FROM warnings
   WINDOW w AS (PARTITION BY rack ORDER BY ts, event_id))
  WHERE navg > average AND epoch_us(nts) - epoch_us(ts) < 86400000000""", _HEAT)

# A stream gives what its batch form gives.
for _name in ("c1_fail_then_success", "c2a_repeated", "c2b_repeated_same", "c5a_heat_warnings", "c5b_heat_alerts"):
    ORACLES[f"{_name}_stream"] = ORACLES[_name]
for _name in ("c1_fail_then_success", "c2b_repeated_same", "c3_paid_or_timeout"):
    ORACLES[f"{_name}_bursts"] = ORACLES[_name]
for _name, _of in (("a0_rollup_by_day", "a0_order_rollup"), ("a3_orders_1d_by_day", "a3_orders_1d"), ("a7_week_sales_by_day", "a7_week_sales")):
    ORACLES[_name] = ORACLES[_of]
for _t in schemas.DIMENSIONS:
    ORACLES[f"k2_sync_{_t}"] = ORACLES[f"k2_state_{_t}"]
for _name in ("early", "midway", "late"):
    ORACLES[f"k2_handover_goods_{_name}"] = ORACLES["k2_state_goods"]
ORACLES["j2_goods_job"] = ORACLES["j2_goods"]
for _name, _job in (("j3_carts", "j3_carts_job"), ("j4_comments", "j4_comments_job"), ("click_log_wide", "click_log_job")):
    ORACLES[_job] = f"SELECT * EXCLUDE (event_id) FROM ({ORACLES[_name]})"
sql("s2_dead_letters", f"""SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END AS "logfileOffset",
  CASE WHEN o_orderkey % 7 <> 0 THEN {_EVENT} END AS "eventType", CASE WHEN o_orderkey % 7 = 0 THEN 'broken ' || o_orderkey END AS raw FROM orders""")
