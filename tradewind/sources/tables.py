"""Warehouse tables and the shop-shaped views the registered queries run on.

Each view is a plain projection of whole tables, so its size grows with them. Views that
reference dimensions leave some references dangling (an unknown category, an unknown area) so
that the handling of missing dimension rows is always exercised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions import geo, times

EVENTS_AS_OF = "2024-01-31 00:00:00"
ORDERS_AS_OF = "2001-08-02 00:00:00"
MISSING_CATEGORY = 1050
AREA_IDS = 28


FILES_PER_BATCH = 8


def _path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(_path(root, name))


def stream(spark: SparkSession, root: str, name: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """The same table as a stream of its files, a few in each micro-batch. A table is a folder of parts or one file."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_path(root, name))
    status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)  # raises if there is none
    reader = (spark.readStream.format("parquet").schema(load(spark, root, name).schema)
              .option("maxFilesPerTrigger", files_per_batch))
    if status.isDirectory():
        return reader.load(_path(root, name))
    return reader.option("pathGlobFilter", f"{name}.parquet").load(root)


# ---- dimensions -------------------------------------------------------------------------

def goods(spark, root) -> DataFrame:
    """Goods keyed by part; the largest size points at a category nobody defines."""
    shops = load(spark, root, "supplier").select(F.count("*")).scalar()
    size = F.col("p_size")
    return load(spark, root, "part").select(
        F.col("p_partkey").alias("goodsId"),
        F.col("p_name").alias("goodsName"),
        (F.col("p_partkey") % shops).alias("shopId"),
        F.when(size == 50, MISSING_CATEGORY).otherwise(size).cast("int").alias("goodsCatId"),
        F.col("p_retailprice").alias("shopPrice"),
    )


def goods_cats(spark, root) -> DataFrame:
    """Three levels of categories: sizes, ten groups of sizes, three families."""
    def level(ids: Column, parent: Column, n: str):
        return [ids.cast("string").alias("catId"), parent.cast("string").alias("parentId"),
                F.concat(F.lit("cat-"), ids.cast("string")).alias("catName"),
                F.lit(n).alias("cat_level")]
    sizes = load(spark, root, "part").select("p_size").distinct()
    group = 100 + F.col("p_size") % 10
    family = 200 + F.col("g") % 10 % 3
    groups = sizes.select(group.alias("g")).distinct()
    return (
        sizes.select(*level(F.col("p_size"), group, "3"))
        .unionByName(groups.select(*level(F.col("g"), family, "2")))
        .unionByName(groups.select(family.alias("f")).distinct()
                     .select(*level(F.col("f"), F.lit(0), "1")))
    )


def shops(spark, root) -> DataFrame:
    return load(spark, root, "supplier").select(
        F.col("s_suppkey").cast("int").alias("shopId"),
        F.col("s_nationkey").alias("areaId"),
        F.col("s_name").alias("shopName"),
        F.concat(F.lit("co-"), F.col("s_name")).alias("shopCompany"),
    )


def org(spark, root) -> DataFrame:
    cities = load(spark, root, "nation").select(
        F.col("n_nationkey").alias("orgId"), (1000 + F.col("n_regionkey")).alias("parentId"),
        F.col("n_name").alias("orgName"), F.lit(2).alias("orgLevel"))
    regions = load(spark, root, "region").select(
        (1000 + F.col("r_regionkey")).alias("orgId"), F.lit(0).alias("parentId"),
        F.col("r_name").alias("orgName"), F.lit(1).alias("orgLevel"))
    return cities.unionByName(regions)


def shop_cats(spark, root) -> DataFrame:
    """Shop categories: one per residue of the size, two parents."""
    ids = load(spark, root, "part").select((F.col("p_size") % 7).alias("i")).distinct()
    return ids.select(
        F.col("i").cast("string").alias("catId"),
        (F.col("i") % 2).cast("string").alias("parentId"),
        F.concat(F.lit("shopcat-"), F.col("i").cast("string")).alias("catName"),
        F.col("i").cast("string").alias("catSort"),
    )


DIMENSION_VIEWS = {"goods": goods, "goods_cats": goods_cats, "shops": shops,
                   "org": org, "shop_cats": shop_cats}


def areas(spark, root) -> DataFrame:
    """Area reference; ids 25 and above occur in facts but not here."""
    key = F.col("n_nationkey")
    return load(spark, root, "nation").select(
        key.cast("bigint").alias("id"), F.col("n_name").alias("name"),
        (100 + key).cast("string").alias("lon"), (20 + key).cast("string").alias("lat"))


def ip_ranges(spark, root) -> DataFrame:
    """One address range per nation with gaps between them, places spelt in three ways."""
    key, name = F.col("n_nationkey"), F.col("n_name")
    begin = key.cast("bigint") * 171798691
    country = (
        F.when(key % 3 == 0, F.concat(name, F.lit("省"), name, F.lit("市")))
        .when(key % 3 == 1, F.concat(name, F.lit("市"), name, F.lit("区")))
        .otherwise(name)
    )
    return load(spark, root, "nation").select(
        begin.alias("begin"), (begin + 100000000).alias("end"), country.alias("country"),
        F.when(key % 4 == 0, F.lit(" CZ88.NET")).otherwise(F.concat(F.lit("area-"), name))
        .alias("area"))


# ---- facts ------------------------------------------------------------------------------

def dws_events(spark, root, rows: DataFrame | None = None) -> DataFrame:
    """Hour-level order facts."""
    events = load(spark, root, "events") if rows is None else rows
    return events.select(
        F.col("ts").alias("__time"),
        (F.col("user_id") % AREA_IDS).cast("int").alias("areaId"),
        F.when(F.col("event_type") == "purchase", 2).otherwise(0).alias("orderStatus"),
        F.col("value").alias("totalMoney"),
        F.lit(1).cast("bigint").alias("count"),
    )


def dws_orders(spark, root) -> DataFrame:
    """Day-level order facts: new orders only, as in the change feed below."""
    return load(spark, root, "orders").filter(F.col("o_orderstatus") != "P").select(
        F.col("o_orderdate").alias("__time"),
        (F.col("o_custkey") % AREA_IDS).cast("int").alias("areaId"),
        F.when(F.col("o_orderstatus") == "F", 2).otherwise(0).alias("orderStatus"),
        F.col("o_totalprice").alias("totalMoney"),
        F.lit(1).cast("bigint").alias("count"),
    )


def order_changes(spark, root, rows: DataFrame | None = None) -> DataFrame:
    """Orders as a change feed with text columns; one value is deliberately not a number.

    `rows` replaces the table, for a stream of the same rows.
    """
    o = load(spark, root, "orders") if rows is None else rows
    status = (F.when(F.col("o_orderstatus") == "F", "2")
              .when(F.col("o_orderstatus") == "P", "1").otherwise("0"))
    fields = {
        "orderId": F.col("o_orderkey"), "orderNo": F.concat(F.lit("NO"), F.col("o_orderkey")),
        "userId": F.col("o_custkey"), "orderStatus": status,
        "totalMoney": F.col("o_totalprice"), "realTotalMoney": F.col("o_totalprice"),
        "isPay": F.when(F.col("o_orderstatus") == "O", "0").otherwise("1"),
        "areaId": F.col("o_custkey") % AREA_IDS,
        "orderScore": F.when(F.col("o_orderpriority") == "1-URGENT", "n/a")
        .otherwise(F.substring("o_orderpriority", 1, 1)),
        "createTime": F.date_format("o_orderdate", times.DATETIME),
        "isFromCart": F.col("o_orderkey") % 2,
    }
    event = (F.when(F.col("o_orderstatus") == "P", "update").otherwise("insert"))
    return _changes(o, "orders", event, F.col("o_orderdate"), F.col("o_orderkey"), fields)


def _changes(df, table, event: Column, when: Column, offset: Column, fields: dict) -> DataFrame:
    columns = F.create_map(*[x for k, v in fields.items() for x in (F.lit(k), v.cast("string"))])
    return df.select(
        F.lit("log.000001").alias("logfileName"),
        offset.cast("bigint").alias("logfileOffset"),
        F.floor(times.micros(when) / 1000).cast("bigint").alias("executeTime"),
        F.lit("shop").alias("schemaName"),
        (F.lit(table) if isinstance(table, str) else table).alias("tableName"),
        event.alias("eventType"),
        columns.alias("columns"),
    )


def line_changes(spark, root, rows: DataFrame | None = None) -> DataFrame:
    """Order lines as a change feed: keys repeat, and the return flag picks the operation."""
    l = load(spark, root, "lineitem") if rows is None else rows
    flag = F.col("l_returnflag")
    event = F.when(flag == "A", "insert").when(flag == "N", "update").otherwise("delete")
    fields = {
        "ogId": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        "orderId": F.col("l_orderkey"), "goodsId": F.col("l_partkey"),
        "goodsNum": F.col("l_quantity").cast("bigint"),
        "goodsPrice": F.col("l_extendedprice") / F.col("l_quantity"),
    }
    # The feed has no log position of its own, so every other column takes part in it: the
    # order of changes to one key is total and the same in any engine.
    position = (F.col("l_partkey") * 100000 + F.col("l_suppkey")) * 1000 + F.col("l_quantity")
    return _changes(l, "order_goods", event, F.col("l_shipdate"), position, fields)


def known_goods(spark, root) -> DataFrame:
    """Goods that are in the table when a job begins; all others are announced by the feed."""
    return goods(spark, root).where(F.col("goodsId") % 3 == 0)


def late_goods_feed(spark, root) -> DataFrame:
    """Order-line changes, and the other goods' inserts between them: up to two days behind the first line that names them."""
    lines = line_changes(spark, root)
    first = load(spark, root, "lineitem").groupBy("l_partkey").agg(F.min("l_shipdate").alias("_first"))
    late = goods(spark, root).where(F.col("goodsId") % 3 != 0).join(first, F.col("goodsId") == F.col("l_partkey"))
    names = [c for c in late.columns if c not in ("l_partkey", "_first")]
    when = F.col("_first") + F.make_dt_interval(hours=(F.col("goodsId") % 5 * 12).cast("int"))
    return lines.unionByName(_changes(late, "goods", F.lit("insert"), when, F.col("goodsId"), {c: F.col(c) for c in names}))


def goods_changes(spark, root) -> DataFrame:
    """Goods rows with every column the goods wide record takes from the feed."""
    shops_n = load(spark, root, "supplier").select(F.count("*")).scalar()
    size = F.col("p_size")
    fields = {
        "goodsId": F.col("p_partkey"), "goodsSn": F.concat(F.lit("SN"), F.col("p_partkey")),
        "goodsName": F.col("p_name"), "shopId": F.col("p_partkey") % shops_n,
        "goodsType": F.col("p_type"), "shopPrice": F.col("p_retailprice"),
        "goodsCatId": F.when(size == 50, MISSING_CATEGORY).otherwise(size),
        "shopCatId1": size % 7, "shopCatId2": size % 2, "brandId": F.col("p_brand"),
    }
    return _changes(load(spark, root, "part"), "goods", F.lit("insert"),
                    F.lit("2024-01-01").cast("timestamp_ntz"), F.col("p_partkey"), fields)


def dimension_changes(spark, root) -> DataFrame:
    """All five dimensions, and the order feed, as one change feed.

    Every dimension row is inserted and updated; every fifth is then deleted, and every tenth
    inserted again. An operation the sync does not know closes each history.
    """
    label = {"goods": "goodsName", "goods_cats": "catName", "shops": "shopName",
             "org": "orgName", "shop_cats": "catName"}
    feed = order_changes(spark, root)
    for table, view in DIMENSION_VIEWS.items():
        rows = view(spark, root)
        key = rows.columns[0]
        history = F.array(
            F.struct(F.lit(1).alias("v"), F.lit("insert").alias("op")),
            F.struct(F.lit(2).alias("v"), F.lit("update").alias("op")),
            F.when(F.col(key).cast("bigint") % 5 == 0,
                   F.struct(F.lit(3).alias("v"), F.lit("delete").alias("op"))),
            F.when(F.col(key).cast("bigint") % 10 == 0,
                   F.struct(F.lit(4).alias("v"), F.lit("insert").alias("op"))),
            F.struct(F.lit(5).alias("v"), F.lit("truncate").alias("op")),
        )
        steps = rows.withColumn("h", F.explode(F.filter(history, lambda h: h.isNotNull())))
        fields = {c: F.col(c) for c in rows.columns}
        fields[label[table]] = F.concat(F.col(label[table]), F.lit("#"), F.col("h.v").cast("string"))
        feed = feed.unionByName(_changes(
            steps, table, F.col("h.op"), F.lit("2024-01-01").cast("timestamp_ntz"),
            F.col("h.v"), fields))
    return feed


def log_batches(spark, root) -> DataFrame:
    """Order lines as polls of the change log: transaction marks around a row entry, which
    holds two changed rows with before and after images."""
    image = lambda tag, shift: F.array(
        F.struct(F.lit("ogId").alias("name"),
                 (F.col("l_orderkey") * 10 + F.col("l_linenumber") + shift).cast("string").alias("value")),
        F.struct(F.lit("goodsId").alias("name"), F.col("l_partkey").cast("string").alias("value")),
        F.struct(F.lit("image").alias("name"), F.lit(tag).alias("value")),
    )
    change = lambda shift: F.struct(image("before", shift).alias("beforeColumns"),
                                    image("after", shift).alias("afterColumns"))
    flag = F.col("l_returnflag")
    op = F.when(flag == "A", "INSERT").when(flag == "N", "UPDATE").otherwise("DELETE")
    def entry(kind, *rows):
        body = F.array(*rows) if rows else F.filter(F.array(change(0)), lambda _: F.lit(False))
        return F.struct(
            F.lit(kind).alias("entryType"), F.lit("log.000001").alias("logfileName"),
            F.col("l_orderkey").alias("logfileOffset"),
            F.floor(times.micros(F.col("l_shipdate")) / 1000).cast("bigint").alias("executeTime"),
            F.lit("shop").alias("schemaName"), F.lit("order_goods").alias("tableName"),
            op.alias("eventType"), body.alias("rowDatas"))
    return load(spark, root, "lineitem").select(F.array(
        entry("TRANSACTIONBEGIN"), entry("ROWDATA", change(0), change(1000000000)),
        entry("TRANSACTIONEND")).alias("entries"))


# ---- click stream and messages ----------------------------------------------------------

def payment_changes(spark, root, rows: DataFrame | None = None) -> DataFrame:
    """Each order created unpaid and, unless it stays open, paid up to half an hour later."""
    o = load(spark, root, "orders") if rows is None else rows
    change = lambda paid, shift, n: F.struct(
        F.lit(paid).alias("isPay"), shift.alias("minutes"), F.lit(n).alias("n"))
    steps = F.array(
        change(0, F.lit(0).cast("bigint"), 0),
        F.when(F.col("o_orderstatus") != "P", change(1, F.col("o_orderkey") % 30, 1)))
    steps_of = o.withColumn("s", F.explode(F.filter(steps, lambda s: s.isNotNull())))
    at = F.timestamp_micros(times.micros(F.col("o_orderdate")) + F.col("s.minutes") * 60000000)
    fields = {"orderId": F.col("o_orderkey"), "userId": F.col("o_custkey"),
              "orderStatus": F.lit(0), "isPay": F.col("s.isPay"), "totalMoney": F.col("o_totalprice")}
    return _changes(steps_of, "orders", F.when(F.col("s.n") == 0, "insert").otherwise("update"),
                    at, F.col("o_orderkey") * 2 + F.col("s.n"), fields)


def visits(spark, root, rows: DataFrame | None = None) -> DataFrame:
    """Events with a visitor id and an address."""
    number = ((F.col("user_id") * 3 + F.col("event_id") % 3) * 2654435761) % 4294967296
    events = load(spark, root, "events") if rows is None else rows
    return events.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("guid"),
        geo.ip_text(number).alias("ip"),
    )


def log_lines(spark, root) -> DataFrame:
    """The same visits as access-log text."""
    return visits(spark, root).select("event_id", F.format_string(
        '%s %s - [%s +0000] "GET /goods/%d.html HTTP/1.1" %d %d "http://www.shop-%d.cn/%s" "Mozilla/5.0 (agent %d)"',
        "guid", "ip", F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), "event_id",
        F.when(F.col("event_type") == "error", 500).otherwise(200),
        F.col("event_id") * 7, F.col("user_id"), "event_type", F.col("user_id"),
    ).alias("value"))


def cart_messages(spark, root) -> DataFrame:
    """Cart messages as JSON text. Some name goods that do not exist."""
    v = visits(spark, root)
    n = load(spark, root, "part").select(F.count("*") + 5).scalar()
    return v.select("event_id", F.to_json(F.struct(
        (F.col("event_id") % n).cast("string").alias("goodsId"),
        F.col("user_id").cast("string").alias("userId"),
        (1 + F.col("event_id") % 3).cast("int").alias("count"),
        "guid",
        F.floor(times.micros(F.col("ts")) / 1000).cast("bigint").alias("addTime"),
        "ip",
    )).alias("value"))


def comment_messages(spark, root) -> DataFrame:
    """Comment messages as JSON text; the attachment field comes under both of its names."""
    v = visits(spark, root)
    n = load(spark, root, "part").select(F.count("*") + 5).scalar()
    attachment = F.concat(F.lit("[img"), F.col("event_id").cast("string"), F.lit("]"))
    odd = F.col("event_id") % 2 == 1
    return v.select("event_id", F.to_json(F.struct(
        F.col("user_id").cast("string").alias("userId"), F.col("guid").alias("userName"),
        F.col("event_id").cast("string").alias("orderGoodsId"),
        (1 + F.col("event_id") % 5).cast("int").alias("starScore"),
        F.col("event_type").alias("comments"),
        F.when(odd, attachment).alias("imageViedoJSON"),
        F.when(~odd, attachment).alias("assetsViedoJSON"),
        (F.col("event_id") % n).alias("goodsId"),
        F.floor(times.micros(F.col("ts")) / 1000).cast("bigint").alias("timestamp"),
    )).alias("value"))


def readings(spark, root) -> DataFrame:
    """Sensor readings per rack: temperature or power."""
    warm = F.col("event_type").isin("view", "click", "purchase")
    return load(spark, root, "events").select(
        (F.col("user_id") % 10).alias("rack"), "ts", "event_id",
        F.when(warm, "temperature").otherwise("power").alias("kind"), "value")
