"""Places: dotted addresses, region names, the province reference table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNKNOWN_COUNTRY = "未知国家"
UNKNOWN_AREA = "未知地区"
PLACEHOLDER_AREA = "CZ88.NET"
LOCAL_AREA = "本机或本网络"

# Province reference: id, code, name, longitude, latitude. Fixed values.
PROVINCES = [
    (1, "110000", "北京市", "116.395645", "39.929986"),
    (2, "120000", "天津市", "117.210813", "39.14393"),
    (3, "130000", "河北省", "115.661434", "38.61384"),
    (4, "140000", "山西省", "112.515496", "37.866566"),
    (5, "150000", "内蒙古自治区", "114.415868", "43.468238"),
    (6, "210000", "辽宁省", "122.753592", "41.6216"),
    (7, "220000", "吉林省", "126.262876", "43.678846"),
    (8, "230000", "黑龙江省", "128.047414", "47.356592"),
    (9, "310000", "上海市", "121.487899", "31.249162"),
    (10, "320000", "江苏省", "119.368489", "33.013797"),
    (11, "330000", "浙江省", "119.957202", "29.159494"),
    (12, "340000", "安徽省", "117.216005", "31.859252"),
    (13, "350000", "福建省", "117.984943", "26.050118"),
    (14, "360000", "江西省", "115.676082", "27.757258"),
    (15, "370000", "山东省", "118.527663", "36.09929"),
    (16, "410000", "河南省", "113.486804", "34.157184"),
    (17, "420000", "湖北省", "112.410562", "31.209316"),
    (18, "430000", "湖南省", "111.720664", "27.695864"),
    (19, "440000", "广东省", "113.394818", "23.408004"),
    (20, "450000", "广西壮族自治区", "108.924274", "23.552255"),
    (21, "460000", "海南省", "109.733755", "19.180501"),
    (22, "500000", "重庆市", "106.530635", "29.544606"),
    (23, "510000", "四川省", "102.89916", "0.367481"),
    (24, "520000", "贵州省", "106.734996", "26.902826"),
    (25, "530000", "云南省", "101.592952", "24.864213"),
    (26, "540000", "西藏自治区", "89.137982", "1.367315"),
    (27, "610000", "陕西省", "109.503789", "35.860026"),
    (28, "620000", "甘肃省", "102.457625", "38.103267"),
    (29, "630000", "青海省", "96.202544", "5.499761"),
    (30, "640000", "宁夏回族自治区", "106.155481", "37.321323"),
    (31, "650000", "新疆维吾尔自治区", "85.614899", "2.127001"),
    (32, "810000", "香港特别行政区", "114.186124", "22.293586"),
    (33, "820000", "澳门特别行政区", "113.557519", "22.204118"),
]


def province_table(spark: SparkSession) -> DataFrame:
    rows = [(i, code, "0", 1, name, lon, lat) for i, code, name, lon, lat in PROVINCES]
    return spark.createDataFrame(
        rows, "id bigint, code string, parent string, level int, name string, lon string, lat string"
    )


def ip_number(ip: Column) -> Column:
    """Dotted address to a number. From the first part that is no number on, parts count as 0."""
    def take(seen: Column, part: Column) -> Column:
        number = part.try_cast("int")
        good = seen["good"] & number.isNotNull()
        byte = F.when(good, number.bitwiseAND(F.lit(255))).otherwise(0).cast("bigint")
        taken = F.struct((seen["total"] * 256 + byte).alias("total"),
                         (seen["parts"] + 1).alias("parts"), good.alias("good"))
        return F.when((part == "") | (seen["parts"] == 4), seen).otherwise(taken)

    start = F.struct(F.lit(0).cast("bigint").alias("total"), F.lit(0).alias("parts"),
                     F.lit(True).alias("good"))
    # Parts that are not there at all count as 0 as well.
    place = lambda seen: seen["total"] * F.element_at(
        F.array(*[F.lit(256 ** (4 - n)) for n in range(5)]), seen["parts"] + 1)
    return F.aggregate(F.split(ip, r"\."), start, take, place)


def ip_text(number: Column) -> Column:
    part = lambda shift: F.shiftright(number, shift).bitwiseAND(F.lit(255)).cast("string")
    return F.concat_ws(".", part(24), part(16), part(8), part(0))


def _split_at(country: Column, mark: str) -> tuple[Column, Column, Column]:
    """(does the mark split off a second part, text up to the mark, second part).

    Marks at the very end do not count as a split.
    """
    text = F.rtrim(country, F.lit(mark))
    return (
        F.contains(text, F.lit(mark)),
        F.concat(F.substring_index(text, mark, 1), F.lit(mark)),
        F.substring_index(F.substring_index(text, mark, 2), mark, -1),
    )


def region_split(country: Column) -> tuple[Column, Column]:
    """Place text to (province, city): cut after 省, else after 市, else the whole is a province."""
    by_province, province, city = _split_at(country, "省")
    by_city, municipality, district = _split_at(country, "市")
    whole = F.rtrim(country, F.lit("市"))
    return (
        F.when(by_province, province).when(by_city, municipality).otherwise(whole),
        F.when(by_province, city).when(by_city, district)
        .otherwise(F.when(country.isNotNull(), "")),
    )


def clean_area(area: Column) -> Column:
    """The range library marks local networks with a placeholder; show them as such."""
    return F.when(F.trim(area) == PLACEHOLDER_AREA, LOCAL_AREA).otherwise(area)
